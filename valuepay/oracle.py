"""Independent check: the same queries as ANSI SQL for DuckDB over the driver's tables.

The six source views are the portable SQL of FIXTURES.md; the marts follow the
reference's definitions written directly in SQL (window ``row_number`` for the
tie-broken argMax/any, sorted lists for quantileExact, ``median`` on doubles).
Outputs are cast to BIGINT / DOUBLE / VARCHAR / BOOLEAN / TIMESTAMP; dates are rendered as
ISO strings (``yyyy-MM-dd``), which every client library returns alike.
"""

from __future__ import annotations

# Fixed values, written out here so that a wrong constant of the library shows.
MIN_ROWS = {"orders": 50000, "order_payments": 50000, "order_items": 50000, "customers": 50000,
            "geolocation": 500000, "order_reviews": 50000}
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
SEGMENT_WHALE, SEGMENT_HIGH, SEGMENT_MID, SEGMENT_STANDARD = "Top 5% Whale", "High Value", "Mid Value", "Standard"
CANCELLED_STATUS, ADDRESSABLE_METHOD = "canceled", "credit_card"
_LO, _HI, _ADOPT = 0.05, 0.15, 0.3


def rnd(x: str, n: int) -> str:
    """Round half away from zero through an exact decimal, as double."""
    return f"CAST(round(CAST(({x}) AS DECIMAL(38,6)), {n}) AS DOUBLE)"


def div(num: str, den: str) -> str:
    return f"(CAST(({num}) AS DOUBLE) / NULLIF(CAST(({den}) AS DOUBLE), 0))"


def mean(x: str) -> str:
    return div(f"sum({x})", f"count({x})")


SOURCE_CTES = """
src_orders AS (
  SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
    CASE WHEN o_orderkey % 20 = 7 THEN 'canceled' WHEN o_orderstatus = 'F' THEN 'delivered'
         WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderdate END AS order_purchase_timestamp,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END AS order_approved_at,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + INTERVAL 3 DAY END AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 9 DAY ELSE NULL END AS order_delivered_customer_date,
    o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_date
  FROM orders),
src_order_items AS (
  SELECT CASE WHEN l_orderkey % 50 = 3 THEN concat('X', CAST(l_orderkey AS STRING)) ELSE CAST(l_orderkey AS STRING) END AS order_id,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS INT) AS order_item_id,
    CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id,
    l_shipdate AS shipping_limit_date,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS freight_value
  FROM lineitem),
src_order_payments AS (
  SELECT CASE WHEN l_orderkey % 200 = 11 THEN concat('X', CAST(l_orderkey AS STRING)) ELSE CAST(l_orderkey AS STRING) END AS order_id,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS INT) AS payment_sequential,
    ptype AS payment_type,
    CAST(CASE WHEN ptype = 'credit_card' AND l_quantity > 25 THEN 2 + CAST(l_quantity AS INT) % 9 ELSE 1 END AS SMALLINT) AS payment_installments,
    CASE WHEN l_orderkey % 50 = 9 THEN CAST(100 AS DECIMAL(12,2))
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) + CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS DECIMAL(12,2)) END AS payment_value
  FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 'credit_card' WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'boleto'
         WHEN l_returnflag = 'A' THEN 'voucher' WHEN l_linestatus = 'F' THEN 'debit_card' ELSE 'credit_card' END AS ptype FROM lineitem) t),
src_customers AS (
  SELECT CASE WHEN c_custkey % 40 = 5 THEN concat('X', CAST(c_custkey AS STRING)) ELSE CAST(c_custkey AS STRING) END AS customer_id,
    concat('U', CAST(CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1 ELSE c_custkey END AS STRING)) AS customer_unique_id,
    lpad(CAST(c_nationkey * 100 + c_custkey % 7 AS STRING), 5, '0') AS customer_zip_code_prefix,
    concat(n_name, '-', c_mktsegment) AS customer_city, n_name AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
src_geolocation AS (
  SELECT lpad(CAST(c_nationkey * 100 + c_custkey % 7 AS STRING), 5, '0') AS geolocation_zip_code_prefix,
    CAST(c_nationkey AS DOUBLE) - 20 + CAST(c_custkey % 64 AS DOUBLE) / 64 AS geolocation_lat,
    -40 - CAST(c_nationkey AS DOUBLE) / 2 - CAST(c_custkey % 32 AS DOUBLE) / 32 AS geolocation_lng,
    concat(n_name, '-', c_mktsegment) AS geolocation_city, CASE WHEN c_nationkey = 24 THEN concat(n_name, '*') ELSE n_name END AS geolocation_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
src_order_reviews AS (
  SELECT CAST(event_id AS STRING) AS review_id, CAST(event_id AS STRING) AS order_id,
    CAST(1 + event_id % 5 AS SMALLINT) AS review_score, event_type AS review_comment_title,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END AS review_comment_message,
    ts AS review_creation_date, ts + INTERVAL 2 DAY AS review_answer_timestamp
  FROM events)"""

_TYPES = PAYMENT_TYPES

MART_CTES = f"""
pay AS (
  SELECT order_id, sum(payment_value) AS order_value, max(payment_installments) AS max_installments,
    count(DISTINCT payment_type) AS distinct_payment_methods,
    {", ".join(f"sum(CASE WHEN payment_type = '{t}' THEN payment_value ELSE 0 END) AS {t}_value" for t in _TYPES)}
  FROM src_order_payments GROUP BY order_id),
pay_primary AS (
  SELECT order_id, payment_type AS primary_payment_type FROM (
    SELECT order_id, payment_type, row_number() OVER (PARTITION BY order_id ORDER BY payment_value DESC, payment_sequential) AS rn
    FROM src_order_payments) z WHERE rn = 1),
itm AS (
  SELECT order_id, sum(price) AS items_price, sum(freight_value) AS freight_value, count(*) AS item_count
  FROM src_order_items GROUP BY order_id),
fact AS (
  SELECT o.order_id, o.customer_id, COALESCE(c.customer_unique_id, '') AS customer_unique_id, o.order_status,
    o.order_purchase_timestamp, CAST(o.order_purchase_timestamp AS DATE) AS order_date,
    CAST(date_trunc('month', o.order_purchase_timestamp) AS DATE) AS order_month,
    COALESCE(c.customer_state, '') AS customer_state, COALESCE(c.customer_city, '') AS customer_city,
    COALESCE(c.customer_zip_code_prefix, '') AS customer_zip_code_prefix,
    p.order_value, pp.primary_payment_type, p.max_installments, p.max_installments > 1 AS used_installments,
    p.distinct_payment_methods, p.credit_card_value, p.boleto_value, p.voucher_value, p.debit_card_value,
    COALESCE(i.items_price, 0) AS items_price, COALESCE(i.freight_value, 0) AS freight_value,
    COALESCE(i.item_count, 0) AS item_count
  FROM src_orders o
  JOIN pay p ON p.order_id = o.order_id
  JOIN pay_primary pp ON pp.order_id = o.order_id
  LEFT JOIN itm i ON i.order_id = o.order_id
  LEFT JOIN src_customers c ON o.customer_id = c.customer_id
  WHERE o.order_status <> '{CANCELLED_STATUS}'),
base_all AS (
  SELECT customer_unique_id, count(*) AS frequency, sum(order_value) AS monetary,
    {mean("order_value")} AS avg_order_value, max(order_date) AS last_order_date,
    {mean("CASE WHEN used_installments THEN max_installments END")} AS avg_installments_when_used,
    {div("count_if(used_installments)", "count(*)")} AS installment_order_share
  FROM fact GROUP BY customer_unique_id),
first_loc AS (
  SELECT customer_unique_id, customer_state, customer_city FROM (
    SELECT customer_unique_id, customer_state, customer_city,
      row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp ASC NULLS LAST, order_id) AS rn
    FROM fact) z WHERE rn = 1),
top_pay AS (
  SELECT customer_unique_id, primary_payment_type AS top_payment_type FROM (
    SELECT customer_unique_id, primary_payment_type,
      row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_value DESC, order_date ASC NULLS LAST, order_id) AS rn
    FROM fact) z WHERE rn = 1),
persons AS (SELECT * FROM base_all WHERE customer_unique_id <> ''),
th AS (
  SELECT (SELECT max(last_order_date) FROM base_all) AS max_date,
    list_sort(list(monetary))[CAST(floor(0.90::DOUBLE * count(*)) AS BIGINT) + 1] AS p90,
    list_sort(list(monetary))[CAST(floor(0.95::DOUBLE * count(*)) AS BIGINT) + 1] AS p95,
    median(CAST(monetary AS DOUBLE)) AS med
  FROM persons),
dim AS (
  SELECT b.customer_unique_id, l.customer_state, l.customer_city, b.frequency, b.monetary, b.avg_order_value,
    date_diff('day', b.last_order_date, (SELECT max_date FROM th)) AS recency_days, b.last_order_date,
    b.avg_installments_when_used, b.installment_order_share, t.top_payment_type,
    b.monetary >= (SELECT p95 FROM th) AS is_top5_value, b.monetary >= (SELECT p90 FROM th) AS is_high_value_customer,
    CASE WHEN b.monetary >= (SELECT p95 FROM th) THEN '{SEGMENT_WHALE}'
         WHEN b.monetary >= (SELECT p90 FROM th) THEN '{SEGMENT_HIGH}'
         WHEN b.monetary >= (SELECT med FROM th) THEN '{SEGMENT_MID}' ELSE '{SEGMENT_STANDARD}' END AS value_segment
  FROM persons b JOIN first_loc l ON l.customer_unique_id = b.customer_unique_id
  JOIN top_pay t ON t.customer_unique_id = b.customer_unique_id),
geo_counts AS (
  SELECT geolocation_zip_code_prefix AS zip, geolocation_city AS v, count(*) AS n FROM src_geolocation GROUP BY 1, 2),
geo_states AS (
  SELECT geolocation_zip_code_prefix AS zip, geolocation_state AS v, count(*) AS n FROM src_geolocation GROUP BY 1, 2),
geo_city AS (SELECT zip, v FROM (SELECT zip, v, row_number() OVER (PARTITION BY zip ORDER BY n DESC, v) AS rn FROM geo_counts) z WHERE rn = 1),
geo_state AS (SELECT zip, v FROM (SELECT zip, v, row_number() OVER (PARTITION BY zip ORDER BY n DESC, v) AS rn FROM geo_states) z WHERE rn = 1),
geo AS (
  SELECT g.geolocation_zip_code_prefix AS zip_code_prefix, avg(g.geolocation_lat) AS lat, avg(g.geolocation_lng) AS lng,
    any_value(gc.v) AS city, any_value(gs.v) AS state
  FROM src_geolocation g JOIN geo_city gc ON gc.zip = g.geolocation_zip_code_prefix
  JOIN geo_state gs ON gs.zip = g.geolocation_zip_code_prefix
  GROUP BY g.geolocation_zip_code_prefix),
fd AS (
  SELECT f.*, d.value_segment, d.is_high_value_customer
  FROM fact f JOIN dim d ON d.customer_unique_id = f.customer_unique_id),
profile AS (
  SELECT value_segment, primary_payment_type, count(*) AS order_count,
    count(DISTINCT customer_unique_id) AS customer_count,
    round(sum(order_value), 2) AS total_revenue,
    {rnd(mean("order_value"), 2)} AS avg_order_value,
    {rnd(mean("max_installments"), 2)} AS avg_installments,
    {rnd(mean("CASE WHEN used_installments THEN max_installments END"), 2)} AS avg_installments_when_used,
    {rnd(div("count_if(used_installments)", "count(*)") + " * 100", 1)} AS pct_orders_with_installments
  FROM fd GROUP BY value_segment, primary_payment_type),
centroid AS (SELECT state, avg(lat) AS lat, avg(lng) AS lng FROM geo GROUP BY state),
geo_value AS (
  SELECT s.customer_state, c.lat, c.lng, s.total_customers, s.hvc_customers,
    {rnd(div("s.hvc_customers", "s.total_customers") + " * 100", 2)} AS hvc_penetration_pct,
    round(s.total_revenue, 2) AS total_revenue, round(s.hvc_revenue, 2) AS hvc_revenue,
    {rnd(div("s.hvc_revenue", "s.total_revenue") + " * 100", 1)} AS hvc_revenue_share_pct
  FROM (SELECT customer_state, count(DISTINCT customer_unique_id) AS total_customers,
          count(DISTINCT CASE WHEN is_high_value_customer THEN customer_unique_id END) AS hvc_customers,
          sum(monetary) AS total_revenue,
          sum(CASE WHEN is_high_value_customer THEN monetary ELSE 0 END) AS hvc_revenue
        FROM dim GROUP BY customer_state) s
  LEFT JOIN centroid c ON c.state = s.customer_state),
seg AS (
  SELECT value_segment,
    {mean("CASE WHEN used_installments THEN order_value END")} AS aov_i,
    {mean("CASE WHEN NOT used_installments THEN order_value END")} AS aov_n,
    count_if(NOT used_installments AND primary_payment_type = '{ADDRESSABLE_METHOD}') AS addressable_orders,
    sum(CASE WHEN NOT used_installments AND primary_payment_type = '{ADDRESSABLE_METHOD}' THEN order_value ELSE 0 END) AS addr_rev
  FROM fd GROUP BY value_segment),
uplift AS (
  SELECT value_segment, {rnd("aov_i", 2)} AS aov_installment, {rnd("aov_n", 2)} AS aov_no_installment,
    {rnd("aov_i - aov_n", 2)} AS aov_gap, addressable_orders,
    round(addr_rev, 2) AS current_addressable_revenue,
    {rnd(f"CAST(addressable_orders AS DOUBLE) * {_ADOPT!r}::DOUBLE * greatest(aov_i - aov_n, 0.0)", 2)} AS projected_annual_uplift
  FROM seg)"""

WITH = "WITH " + SOURCE_CTES.strip() + ",\n" + MART_CTES.strip() + "\n"

FACT_SELECT = """SELECT order_id, customer_id, customer_unique_id, order_status, order_purchase_timestamp,
  CAST(order_date AS VARCHAR) AS order_date, CAST(order_month AS VARCHAR) AS order_month,
  customer_state, customer_city, customer_zip_code_prefix,
  CAST(order_value AS DOUBLE) AS order_value, primary_payment_type,
  CAST(max_installments AS BIGINT) AS max_installments, used_installments,
  CAST(distinct_payment_methods AS BIGINT) AS distinct_payment_methods,
  CAST(credit_card_value AS DOUBLE) AS credit_card_value, CAST(boleto_value AS DOUBLE) AS boleto_value,
  CAST(voucher_value AS DOUBLE) AS voucher_value, CAST(debit_card_value AS DOUBLE) AS debit_card_value,
  CAST(items_price AS DOUBLE) AS items_price, CAST(freight_value AS DOUBLE) AS freight_value,
  CAST(item_count AS BIGINT) AS item_count FROM fact"""

DIM_SELECT = """SELECT customer_unique_id, customer_state, customer_city, CAST(frequency AS BIGINT) AS frequency,
  CAST(monetary AS DOUBLE) AS monetary, avg_order_value, CAST(recency_days AS BIGINT) AS recency_days,
  CAST(last_order_date AS VARCHAR) AS last_order_date, avg_installments_when_used,
  installment_order_share, top_payment_type,
  is_top5_value, is_high_value_customer, value_segment FROM dim"""

_MIN_ROWS = MIN_ROWS


def _check(name: str, observed: str, bound: str, passed: str, severity: str = "error") -> str:
    return (f"SELECT '{name}' AS \"check\", CAST(({observed}) AS DOUBLE) AS observed, '{bound}' AS bound, "
            f"COALESCE(({passed}), false) AS passed, '{severity}' AS severity")


def _staging_sql(table: str, cols: list[tuple[str, str]]) -> str:
    out = []
    for name, kind in cols:
        if kind == "s":
            out.append(f"COALESCE({name}, '') AS {name}")
        elif kind == "t":
            out.append(f"date_trunc('second', {name}) AS {name}")
        else:
            out.append(f"CAST({name} AS {kind}) AS {name}")
    return WITH + f"SELECT {', '.join(out)} FROM src_{table}"


_STAGING = {
    "orders": [("order_id", "s"), ("customer_id", "s"), ("order_status", "s"),
               ("order_purchase_timestamp", "t"), ("order_approved_at", "t"),
               ("order_delivered_carrier_date", "t"), ("order_delivered_customer_date", "t"),
               ("order_estimated_delivery_date", "t")],
    "order_payments": [("order_id", "s"), ("payment_sequential", "BIGINT"), ("payment_type", "s"),
                       ("payment_installments", "BIGINT"), ("payment_value", "DOUBLE")],
    "order_items": [("order_id", "s"), ("order_item_id", "BIGINT"), ("product_id", "s"), ("seller_id", "s"),
                    ("shipping_limit_date", "t"), ("price", "DOUBLE"), ("freight_value", "DOUBLE")],
    "customers": [("customer_id", "s"), ("customer_unique_id", "s"), ("customer_zip_code_prefix", "s"),
                  ("customer_city", "s"), ("customer_state", "s")],
    "geolocation": [("geolocation_zip_code_prefix", "s"), ("geolocation_lat", "DOUBLE"),
                    ("geolocation_lng", "DOUBLE"), ("geolocation_city", "s"), ("geolocation_state", "s")],
    "order_reviews": [("review_id", "s"), ("order_id", "s"), ("review_score", "BIGINT"),
                      ("review_comment_title", "s"), ("review_comment_message", "s"),
                      ("review_creation_date", "t"), ("review_answer_timestamp", "t")],
}

_HVC = "is_high_value_customer"


def _q(body: str) -> str:
    return WITH + body


def _acctbal_q() -> str:
    return ("SELECT CAST(count(c_acctbal) AS BIGINT) AS n, "
            "CAST(list_sort(list(c_acctbal))[CAST(floor(0.90::DOUBLE * count(c_acctbal)) AS BIGINT) + 1] AS DOUBLE) AS p90, "
            "CAST(list_sort(list(c_acctbal))[CAST(floor(0.95::DOUBLE * count(c_acctbal)) AS BIGINT) + 1] AS DOUBLE) AS p95 "
            "FROM customer WHERE c_acctbal IS NOT NULL")


SQL: dict[str, str] = {
    "fct_order_payments": _q(FACT_SELECT),
    "fct_from_buckets": _q(FACT_SELECT),
    "dim_customer": _q(DIM_SELECT),
    "dim_geolocation": _q("SELECT zip_code_prefix, lat, lng, city, state FROM geo"),
    "hvc_payment_profile": _q(
        "SELECT value_segment, primary_payment_type, CAST(order_count AS BIGINT) AS order_count, "
        "CAST(customer_count AS BIGINT) AS customer_count, CAST(total_revenue AS DOUBLE) AS total_revenue, "
        "avg_order_value, avg_installments, avg_installments_when_used, pct_orders_with_installments FROM profile"),
    "geo_value": _q(
        "SELECT customer_state, CAST(CAST(lat AS DECIMAL(38,9)) AS DOUBLE) AS lat, "
        "CAST(CAST(lng AS DECIMAL(38,9)) AS DOUBLE) AS lng, CAST(total_customers AS BIGINT) AS total_customers, "
        "CAST(hvc_customers AS BIGINT) AS hvc_customers, hvc_penetration_pct, "
        "CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(hvc_revenue AS DOUBLE) AS hvc_revenue, "
        "hvc_revenue_share_pct FROM geo_value"),
    "payment_uplift": _q(
        "SELECT value_segment, aov_installment, aov_no_installment, aov_gap, "
        "CAST(addressable_orders AS BIGINT) AS addressable_orders, "
        "CAST(current_addressable_revenue AS DOUBLE) AS current_addressable_revenue, "
        "projected_annual_uplift FROM uplift"),
    "card1_kpi": _q(
        f"SELECT CAST(round(sum(CASE WHEN {_HVC} THEN monetary ELSE 0 END), 0) AS DOUBLE) AS hvc_revenue, "
        f"{rnd(div(f'sum(CASE WHEN {_HVC} THEN monetary ELSE 0 END)', 'sum(monetary)') + ' * 100', 1)} AS hvc_revenue_share_pct, "
        f"CAST(count_if({_HVC}) AS BIGINT) AS hvc_count FROM dim"),
    "card2_aov_by_segment": _q(
        f"SELECT value_segment, {rnd(mean('avg_order_value'), 2)} AS avg_order_value, "
        "CAST(count(*) AS BIGINT) AS customers FROM dim GROUP BY value_segment"),
    "card3_payment_mix": _q(
        "SELECT primary_payment_type, CAST(sum(order_count) AS BIGINT) AS orders, "
        "CAST(round(sum(total_revenue), 0) AS DOUBLE) AS revenue FROM profile "
        f"WHERE value_segment IN ('{SEGMENT_WHALE}', '{SEGMENT_HIGH}') GROUP BY primary_payment_type"),
    "card4_installments": _q(
        f"SELECT value_segment, {rnd(mean('pct_orders_with_installments'), 1)} AS pct_orders_with_installments, "
        f"{rnd(mean('avg_installments_when_used'), 2)} AS avg_installments_when_used "
        "FROM profile GROUP BY value_segment"),
    "card5_geo": _q(
        "SELECT customer_state, CAST(total_customers AS BIGINT) AS total_customers, "
        "CAST(hvc_customers AS BIGINT) AS hvc_customers, hvc_penetration_pct, "
        "CAST(round(hvc_revenue, 0) AS DOUBLE) AS hvc_revenue, hvc_revenue_share_pct FROM geo_value"),
    "card6_uplift": _q(
        "SELECT value_segment, aov_no_installment, aov_installment, aov_gap, "
        f"CAST(addressable_orders AS BIGINT) AS addressable_orders, {rnd('projected_annual_uplift', 0)} AS projected_uplift "
        "FROM uplift"),
    "card7_monthly_revenue": _q(
        f"SELECT CAST(order_month AS VARCHAR) AS order_month, "
        f"CAST(round(sum(CASE WHEN {_HVC} THEN order_value ELSE 0 END), 0) AS DOUBLE) AS hvc_revenue, "
        f"CAST(round(sum(CASE WHEN NOT {_HVC} THEN order_value ELSE 0 END), 0) AS DOUBLE) AS other_revenue "
        "FROM fd WHERE order_month IS NOT NULL GROUP BY order_month"),
    "card8_top_cities": _q(
        f"SELECT customer_state, customer_city, CAST(count_if({_HVC}) AS BIGINT) AS hvc_customers, "
        f"CAST(round(sum(CASE WHEN {_HVC} THEN monetary ELSE 0 END), 0) AS DOUBLE) AS hvc_revenue, "
        f"{rnd(mean(f'CASE WHEN {_HVC} THEN avg_order_value END'), 2)} AS hvc_avg_order "
        f"FROM dim WHERE {_HVC} GROUP BY customer_state, customer_city "
        "ORDER BY hvc_revenue DESC, customer_state, customer_city LIMIT 25"),
    "uplift_scenarios": _q(
        "SELECT CAST(a AS BIGINT) AS adoption_pct, CAST(c AS BIGINT) AS capture_pct, "
        f"{rnd('sum(o * (a::DOUBLE / 100) * g * (c::DOUBLE / 100))', 0)} AS projected_uplift, "
        "CAST(sum(CAST(round(o * (a::DOUBLE / 100), 0) AS BIGINT)) AS BIGINT) AS addressable_orders, "
        f"{rnd(f'CASE WHEN sum(o * {_ADOPT!r}::DOUBLE * g) > 0 THEN sum(o * (a::DOUBLE / 100) * g * (c::DOUBLE / 100)) / sum(o * {_ADOPT!r}::DOUBLE * g) * 100 ELSE 0.0 END', 0)} AS pct_of_baseline "
        "FROM (SELECT o, g, a, unnest(range(0, 101, 5)) AS c FROM ("
        "  SELECT CAST(addressable_orders AS DOUBLE) AS o, greatest(aov_gap, 0.0) AS g, "
        "         unnest(range(0, 101, 1)) AS a FROM uplift) s1) s GROUP BY a, c"),
    "staging_customers_reordered": _staging_sql("customers", _STAGING["customers"]),
    "staging_malformed_timestamps": _q(
        "SELECT order_id, CASE WHEN CAST(order_id AS BIGINT) % 7 = 0 THEN NULL "
        "ELSE date_trunc('second', order_purchase_timestamp) END AS order_purchase_timestamp FROM src_orders"),
    "staging_order_reviews_split": _staging_sql("order_reviews", _STAGING["order_reviews"]).replace(
        "COALESCE(review_comment_message, '') AS", "review_comment_title || chr(10) || '\"' || "
        "COALESCE(review_comment_message, '') || '\",' || chr(10) || chr(10) || 'end' AS"),
    "category_translation": "SELECT DISTINCT p_type AS product_category_name, upper(p_type) AS product_category_name_english FROM part",
    "payments_fifth_type": WITH + """, five AS (
  SELECT order_id, payment_sequential, payment_value,
    CASE WHEN payment_sequential % 3 = 2 THEN 'pix' ELSE payment_type END AS payment_type FROM src_order_payments)
SELECT order_id, CAST(sum(payment_value) AS DOUBLE) AS order_value,
  arg_max(payment_type, CAST(payment_value AS DECIMAL(18,2)) * 1000000 - payment_sequential) AS primary_payment_type,
  CAST(count(DISTINCT payment_type) AS BIGINT) AS distinct_payment_methods,
  CAST(sum(CASE WHEN payment_type = 'credit_card' THEN payment_value ELSE 0 END) AS DOUBLE) AS credit_card_value
FROM five GROUP BY order_id""",
    "card8_state": _q(
        f"SELECT customer_state, customer_city, CAST(count(*) AS BIGINT) AS hvc_customers, "
        f"CAST(round(sum(monetary), 0) AS DOUBLE) AS hvc_revenue, {rnd(mean('avg_order_value'), 2)} AS hvc_avg_order "
        f"FROM dim WHERE {_HVC} AND customer_state = 'NATION_7' GROUP BY customer_state, customer_city "
        "ORDER BY hvc_revenue DESC, customer_state, customer_city LIMIT 25"),
    "card_row_order": _q(" UNION ALL ".join(
        f"SELECT '{card}' AS card, CAST({key} AS VARCHAR) AS row_key, "
        f"CAST(row_number() OVER (ORDER BY {order}) - 1 AS BIGINT) AS place FROM {rel}"
        for card, key, order, rel in [
            ("card2", "value_segment", "v DESC, value_segment", f"(SELECT value_segment, {rnd(mean('avg_order_value'), 2)} AS v FROM dim GROUP BY 1) c2"),
            ("card3", "primary_payment_type", "v DESC, primary_payment_type", "(SELECT primary_payment_type, round(sum(total_revenue), 0) AS v FROM profile "
             f"WHERE value_segment IN ('{SEGMENT_WHALE}', '{SEGMENT_HIGH}') GROUP BY 1) c3"),
            ("card4", "value_segment", "v DESC, value_segment", f"(SELECT value_segment, {rnd(mean('pct_orders_with_installments'), 1)} AS v FROM profile GROUP BY 1) c4"),
            ("card5", "customer_state", "round(hvc_revenue, 0) DESC, customer_state", "geo_value"),
            ("card6", "value_segment", f"{rnd('projected_annual_uplift', 0)} DESC, value_segment", "uplift"),
            ("card7", "order_month", "order_month", "(SELECT DISTINCT order_month FROM fd WHERE order_month IS NOT NULL) c7"),
        ])),
    "ranged_lookup": _q(
        "SELECT order_id, customer_unique_id, CAST(order_value AS DOUBLE) AS order_value, CAST(item_count AS BIGINT) AS item_count "
        "FROM fact WHERE order_id BETWEEN '2' AND '3'"),
    "refresh_roundtrip": _q(
        "SELECT 'dim_customer' AS mart, count(*) AS mart_rows, CAST(sum(monetary) AS DOUBLE) AS money FROM dim "
        "UNION ALL SELECT 'dim_geolocation', count(*), NULL FROM geo "
        "UNION ALL SELECT 'fct_order_payments', count(*), CAST(sum(order_value) AS DOUBLE) FROM fact "
        "UNION ALL SELECT 'mart_geo_value', count(*), CAST(sum(hvc_revenue) AS DOUBLE) FROM geo_value "
        "UNION ALL SELECT 'mart_hvc_payment_profile', count(*), CAST(sum(total_revenue) AS DOUBLE) FROM profile "
        "UNION ALL SELECT 'mart_payment_uplift', count(*), CAST(sum(current_addressable_revenue) AS DOUBLE) FROM uplift"),
    "load_metrics": _q(
        " UNION ALL ".join(f"SELECT 'load' AS step, '{t}' AS name, (SELECT count(*) FROM src_{t}) AS n" for t in _MIN_ROWS)
        + " UNION ALL SELECT 'mart', 'fct_order_payments', (SELECT count(*) FROM fact) UNION ALL SELECT 'mart', 'dim_customer', (SELECT count(*) FROM dim)"),
    "source_checks": _q(" UNION ALL ".join(
        f"SELECT '{t}' AS name, '{found}' AS found, CAST({n} AS BIGINT) AS n" for t, found, n in [
            ("orders", "loaded", "(SELECT count(*) FROM src_orders)"), ("customers", "loaded", "(SELECT count(*) FROM src_customers)"),
            ("order_items", "empty", "0"), ("order_payments", "missing", "0"), ("geolocation", "missing", "0"), ("order_reviews", "missing", "0")])),
    "gate_outcomes": _q(
        "SELECT 'accepted' AS gate, CAST(4 AS BIGINT) AS passed, '' AS failing FROM dim HAVING count(*) > 0 "
        "UNION ALL SELECT 'refused', 0, 'hvc_share' FROM dim HAVING count(*) > 0"),
    "verify_counts": _q(
        f"SELECT CAST(count(*) AS BIGINT) AS customers, CAST(count_if({_HVC}) AS BIGINT) AS hvc_customers FROM dim"),
    "dq_min_rows": _q(" UNION ALL ".join(
        _check(f"min_rows:{t}", f"(SELECT count(*) FROM src_{t})", f">= {m}", f"(SELECT count(*) FROM src_{t}) >= {m}")
        for t, m in _MIN_ROWS.items())),
    "dq_orphans": _q(_check(
        "orphan_payments",
        "(SELECT count(*) FROM src_order_payments p WHERE NOT EXISTS (SELECT 1 FROM src_orders o WHERE o.order_id = p.order_id))",
        "logged", "true", "warn")),
    "dq_marts": _q(" UNION ALL ".join([
        _check("fact_not_empty", "(SELECT count(*) FROM fact)", "> 0", "(SELECT count(*) FROM fact) > 0"),
        _check("dim_not_empty", "(SELECT count(*) FROM dim)", "> 0", "(SELECT count(*) FROM dim) > 0"),
        _check("hvc_share", f"(SELECT {div(f'count_if({_HVC})', 'count(*)')} FROM dim)", f"[{_LO}, {_HI}]",
               f"(SELECT {div(f'count_if({_HVC})', 'count(*)')} BETWEEN {_LO} AND {_HI} FROM dim)"),
        _check("no_negative_order_value", "(SELECT count_if(order_value < 0) FROM fact)", "= 0",
               "(SELECT count_if(order_value < 0) = 0 FROM fact)"),
    ])),
    **{f"staging_{t}": _staging_sql(t, cols) for t, cols in _STAGING.items()},
    "agg_argmax_tiebreak": _q(
        "SELECT p.order_id, pp.primary_payment_type, CAST(max(p.payment_value) AS DOUBLE) AS top_payment_value, "
        "CAST(count(*) AS BIGINT) AS payments FROM src_order_payments p "
        "JOIN pay_primary pp ON pp.order_id = p.order_id GROUP BY p.order_id, pp.primary_payment_type"),
    "agg_mode": _q(
        "SELECT g.geolocation_zip_code_prefix, any_value(gc.v) AS city, any_value(gs.v) AS state, "
        "CAST(count(*) AS BIGINT) AS points FROM src_geolocation g "
        "JOIN geo_city gc ON gc.zip = g.geolocation_zip_code_prefix "
        "JOIN geo_state gs ON gs.zip = g.geolocation_zip_code_prefix GROUP BY g.geolocation_zip_code_prefix"),
    "agg_any_first_order": _q("SELECT customer_unique_id, customer_state, customer_city FROM first_loc "
                              "WHERE customer_unique_id <> ''"),
    "agg_sum_if": _q(
        "SELECT customer_state, "
        + ", ".join(f"CAST(sum(CASE WHEN primary_payment_type = '{t}' THEN order_value ELSE 0 END) AS DOUBLE) AS {t}_revenue"
                    for t in _TYPES)
        + ", CAST(sum(CASE WHEN primary_payment_type NOT IN (" + ", ".join(f"'{t}'" for t in _TYPES) + ") "
          "THEN order_value ELSE 0 END) AS DOUBLE) AS other_revenue FROM fact GROUP BY customer_state"),
    "agg_avg_if_empty": _q(
        f"SELECT order_status, {rnd(mean('CASE WHEN used_installments THEN order_value END'), 2)} AS aov_installment, "
        f"{rnd(mean('CASE WHEN item_count = 0 THEN order_value END'), 2)} AS aov_without_items, "
        f"{rnd(mean('CASE WHEN order_value < 0 THEN order_value END'), 2)} AS aov_negative "
        "FROM fact GROUP BY order_status"),
    "agg_count_if": _q(
        "SELECT primary_payment_type, CAST(count_if(used_installments) AS BIGINT) AS with_installments, "
        "CAST(count_if(customer_unique_id = '') AS BIGINT) AS without_customer, "
        "CAST(count_if(order_date IS NULL) AS BIGINT) AS undated, CAST(count(*) AS BIGINT) AS orders "
        "FROM fact GROUP BY primary_payment_type"),
    "agg_count_distinct_if": _q(
        "SELECT customer_state, CAST(count(DISTINCT customer_unique_id) AS BIGINT) AS customers, "
        "CAST(count(DISTINCT CASE WHEN used_installments THEN customer_unique_id END) AS BIGINT) AS customers_with_installments "
        "FROM fact WHERE customer_unique_id <> '' GROUP BY customer_state"),
    "agg_quantile_exact": _acctbal_q(),
    "agg_quantile_exact_bracketed": _acctbal_q(),
    "agg_median": _q(
        "SELECT CAST(count(c_acctbal) AS BIGINT) AS n, median(c_acctbal) AS median_acctbal, "
        "(SELECT med FROM th) AS median_monetary FROM customer"),
    "agg_of_agg": _q("SELECT state, CAST(CAST(lat AS DECIMAL(38,9)) AS DOUBLE) AS lat, "
                     "CAST(CAST(lng AS DECIMAL(38,9)) AS DOUBLE) AS lng FROM centroid"),
    "ratio_percent": _q(
        f"SELECT customer_state, {rnd(div('count_if(used_installments)', 'count(*)') + ' * 100', 1)} AS pct_orders_with_installments, "
        f"{rnd(div('sum(credit_card_value)', 'sum(order_value)') + ' * 100', 2)} AS credit_card_share_pct "
        "FROM fact GROUP BY customer_state"),
    "join_inner_using": _q(
        "SELECT o.order_id, o.order_status, CAST(p.order_value AS DOUBLE) AS order_value "
        "FROM src_orders o JOIN pay p ON p.order_id = o.order_id"),
    "join_left_default_fill": _q(
        "SELECT o.order_id, o.customer_id, CAST(COALESCE(i.items_price, 0) AS DOUBLE) AS items_price, "
        "CAST(COALESCE(i.freight_value, 0) AS DOUBLE) AS freight_value, CAST(COALESCE(i.item_count, 0) AS BIGINT) AS item_count, "
        "COALESCE(c.customer_unique_id, '') AS customer_unique_id, COALESCE(c.customer_state, '') AS customer_state "
        "FROM src_orders o LEFT JOIN itm i ON i.order_id = o.order_id "
        "LEFT JOIN src_customers c ON c.customer_id = o.customer_id"),
    "join_left_anti": _q(
        "SELECT p.order_id, CAST(p.payment_sequential AS BIGINT) AS payment_sequential, p.payment_type, "
        "CAST(p.payment_value AS DOUBLE) AS payment_value FROM src_order_payments p "
        "WHERE NOT EXISTS (SELECT 1 FROM src_orders o WHERE o.order_id = p.order_id)"),
    "scalar_subquery_recency": _q(
        "SELECT customer_unique_id, CAST(max(order_date) AS VARCHAR) AS last_order_date, "
        "CAST(date_diff('day', max(order_date), (SELECT max(order_date) FROM fact)) AS BIGINT) AS recency_days "
        "FROM fact WHERE customer_unique_id <> '' GROUP BY customer_unique_id"),
    "case_segments": _q(
        "SELECT value_segment, CAST(count(*) AS BIGINT) AS customers, CAST(min(monetary) AS DOUBLE) AS min_monetary, "
        "CAST(max(monetary) AS DOUBLE) AS max_monetary, CAST(count_if(is_top5_value) AS BIGINT) AS top5, "
        f"CAST(count_if({_HVC}) AS BIGINT) AS hvc FROM dim GROUP BY value_segment"),
    "date_month_trunc": _q(
        "SELECT CAST(CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS VARCHAR) AS order_month, "
        "CAST(count(*) AS BIGINT) AS orders, "
        "CAST(count(DISTINCT CAST(order_purchase_timestamp AS DATE)) AS BIGINT) AS days_with_orders, "
        "CAST(min(CAST(order_purchase_timestamp AS DATE)) AS VARCHAR) AS first_day FROM src_orders GROUP BY 1"),
    "round_half": _q(
        "SELECT order_id, CAST(payment_sequential AS BIGINT) AS payment_sequential, "
        f"{rnd('CAST(payment_value AS DOUBLE) / 2', 2)} AS half_2, {rnd('CAST(payment_value AS DOUBLE) / 2', 0)} AS half_0, "
        f"{rnd('-(CAST(payment_value AS DOUBLE) / 2)', 1)} AS neg_half_1 FROM src_order_payments"),
    "filter_predicates": _q(
        "SELECT primary_payment_type, order_status, CAST(count(*) AS BIGINT) AS orders, "
        "CAST(sum(order_value) AS DOUBLE) AS revenue FROM fact "
        "WHERE order_status <> 'canceled' AND customer_unique_id <> '' AND order_month IS NOT NULL "
        "AND primary_payment_type IN ('credit_card', 'boleto') AND NOT (order_value < 0) AND used_installments "
        "GROUP BY primary_payment_type, order_status"),
    "topk_cities": _q(
        "SELECT customer_state, customer_city, CAST(count(*) AS BIGINT) AS customers, "
        "CAST(sum(monetary) AS DOUBLE) AS revenue FROM dim GROUP BY customer_state, customer_city "
        "ORDER BY customers DESC, customer_state, customer_city LIMIT 10"),
}

# the same figures, taken by the refresh from file footers and while it writes
SQL["dq_stored_min_rows"] = SQL["dq_min_rows"]
SQL["dq_orphans_observed"] = SQL["dq_orphans"]
