"""Full refresh (L1): validate -> load staging -> staging gate -> marts -> mart gate.

Every layer is written as parquet below one run folder and read back before the
next layer is built: lineage is cut at each table, a lost executor only costs
the tasks of the current layer, and each mart is computed once however many
later marts read it (the fact has four readers).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from valuepay import sinks
from valuepay.plans import marts as M
from valuepay.plans import quality as Q
from valuepay.schemas import MIN_ROWS, SORT_KEYS
from valuepay.session import bounded_tasks, sized_shuffle
from valuepay.sources.csv_source import SourceEmpty, read_source
from valuepay.sources.footers import footer_tables
from valuepay.sources.ranged import RANGES, write_ranged

# Figures the mart gate needs, observed while the mart is written (no second scan).
GATE_METRICS = {
    "fct_order_payments": lambda: [F.count(F.lit(1)).alias("fact_rows"),
                                   F.count_if(F.col("order_value") < 0).alias("negative")],
    "dim_customer": lambda: [F.count(F.lit(1)).alias("dim_rows"),
                             F.count_if(F.col("is_high_value_customer")).alias("hvc")],
}

POINTER_SCHEMA = "entry string, marts map<string,string>"

MART_SORT_KEYS = {
    "dim_geolocation": ("zip_code_prefix",),
    "fct_order_payments": ("order_id",),
    "dim_customer": ("customer_unique_id",),
    "mart_hvc_payment_profile": ("value_segment", "primary_payment_type"),
    "mart_geo_value": ("customer_state",),
    "mart_payment_uplift": ("value_segment",),
}

# Marts whose size grows with the data: these are ranged by their key with ``cluster="ranges"``.
RANGED_MARTS = ("dim_geolocation", "fct_order_payments", "dim_customer")


@dataclass
class RefreshResult:
    staging: dict[str, str] = field(default_factory=dict)    # table -> path
    rows: dict[str, int] = field(default_factory=dict)       # table -> rows loaded
    mart_counts: dict[str, int] = field(default_factory=dict)  # gate figures observed on write
    orphans: int | None = None                               # payments without an order, if observed on write
    marts: dict[str, str] = field(default_factory=dict)      # mart -> path
    metrics: list[tuple[str, str, int]] = field(default_factory=list)
    staging_report: list = field(default_factory=list)
    mart_report: list = field(default_factory=list)
    seconds: dict[str, float] = field(default_factory=dict)  # step -> wall time
    shuffle_partitions: int | None = None                      # initial partitions used
    run_dir: str = ""                                          # this run's folder
    resumed: bool = False                                      # continues an earlier call's run
    reused: list[str] = field(default_factory=list)            # tables that the earlier call had finished

    def has(self, spark: SparkSession, step: str, path: str) -> bool:
        """Whether a resumed run finds the step's table finished; such a table is not built again."""
        if not (self.resumed and sinks.committed(spark, path)):
            return False
        self.reused.append(step)
        return True


def run_concurrently(jobs: Mapping[str, Callable[[], object]], max_workers: int = 4) -> dict[str, object]:
    """Submit independent Spark jobs from a few driver threads; the scheduler interleaves
    their tasks, so one job's straggling tail does not leave the cluster idle."""
    if len(jobs) <= 1 or max_workers <= 1:
        return {k: fn() for k, fn in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(jobs))) as pool:
        futures = {k: pool.submit(fn) for k, fn in jobs.items()}
        return {k: f.result() for k, f in futures.items()}


def load_staging(spark: SparkSession, sources: Mapping[str, DataFrame], out_dir: str,
                 result: RefreshResult, max_workers: int = 4, cluster: bool | str = True) -> dict[str, DataFrame]:
    def load(name: str, df: DataFrame) -> Callable[[], DataFrame]:
        def run() -> DataFrame:
            path = f"{out_dir}/raw/{name}"
            if result.has(spark, f"load:{name}", path):
                kept = sinks.read_table(spark, path)
                result.staging[name], result.rows[name] = path, footer_tables(spark, {name: path})[name].count()
                return kept
            t0 = time.perf_counter()
            # rows counted while writing: the observation sits in the writing (result) stage,
            # where Spark applies each task's update once, so a retried task is not counted twice
            obs = Observation(f"load_{name}")
            sinks.write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), path,
                              SORT_KEYS.get(name, ()) if cluster else ())
            result.seconds[f"load:{name}"] = time.perf_counter() - t0
            result.staging[name] = path
            result.rows[name] = int(obs.get["rows"])
            return sinks.read_table(spark, path)
        return run
    return run_concurrently({name: load(name, df) for name, df in sources.items()}, max_workers)


def build_marts(spark: SparkSession, staged: Mapping[str, DataFrame], out_dir: str,
                result: RefreshResult, max_workers: int = 4, cluster: bool | str = True,
                count_orphans: bool = False) -> dict[str, DataFrame]:
    """Build and write the marts in dependence order, each read back by its consumers;
    marts that do not depend on each other are written concurrently. ``count_orphans``: the payments
    without an order are observed while the fact is written (``result.orphans``)."""
    # ranged files cost one more exchange, and a stage before an exchange may be counted twice after a loss
    orphans = Observation("orphans") if count_orphans and cluster != "ranges" else None

    def put(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{out_dir}/marts/{name}"
        metrics = GATE_METRICS.get(name)
        ranged = cluster == "ranges" and name in RANGED_MARTS
        result.marts[name] = path
        if result.has(spark, f"mart:{name}", f"{path}/{RANGES}" if ranged else path):
            kept = sinks.read_table(spark, path)
            if metrics:
                result.mart_counts.update(kept.agg(*metrics()).first().asDict())
            return kept
        df = build()
        t0 = time.perf_counter()
        obs = Observation(f"mart_{name}") if metrics else None
        df = df.observe(obs, *metrics()) if obs else df
        if ranged:
            write_ranged(df, path, MART_SORT_KEYS[name][0], MART_SORT_KEYS[name])
        else:
            sinks.write_table(df, path, MART_SORT_KEYS[name] if cluster else ())
        if obs:
            result.mart_counts.update({k: int(v) for k, v in obs.get.items()})
        result.seconds[f"mart:{name}"] = time.perf_counter() - t0
        return sinks.read_table(spark, path)

    def layer(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{out_dir}/layers/{name}"
        if not result.has(spark, f"layer:{name}", path):
            t0 = time.perf_counter()
            sinks.write_table(build(), path)
            result.seconds[f"layer:{name}"] = time.perf_counter() - t0
        return sinks.read_table(spark, path)

    first = run_concurrently({
        "dim_geolocation": lambda: put("dim_geolocation", lambda: M.dim_geolocation(staged["geolocation"])),
        "fct_order_payments": lambda: put("fct_order_payments", lambda: M.fct_order_payments(
            staged["orders"], staged["order_payments"], staged["order_items"], staged["customers"], orphans)),
    }, max_workers)
    if orphans and "mart:fct_order_payments" not in result.reused:
        result.orphans = int(orphans.get["orphans"])
    geo, fact = first["dim_geolocation"], first["fct_order_payments"]

    def scored() -> DataFrame:
        base = layer("customer_base", lambda: M.customer_base(fact))
        t0 = time.perf_counter()
        dim = M.dim_customer(fact, base=base)          # runs the threshold passes
        result.seconds["thresholds"] = time.perf_counter() - t0
        return dim

    dim = put("dim_customer", scored)
    rollup = layer("segment_method", lambda: M.segment_method_rollup(fact, dim))
    last = run_concurrently({
        "mart_hvc_payment_profile":
            lambda: put("mart_hvc_payment_profile", lambda: M.mart_hvc_payment_profile(fact, dim, rollup=rollup)),
        "mart_geo_value": lambda: put("mart_geo_value", lambda: M.mart_geo_value(dim, geo)),
        "mart_payment_uplift": lambda: put("mart_payment_uplift", lambda: M.mart_payment_uplift(fact, dim, rollup=rollup)),
    }, max_workers)
    return {"dim_geolocation": geo, "fct_order_payments": fact, "dim_customer": dim, **last}


def refresh(spark: SparkSession, out_dir: str, *, data_dir: str | None = None,
            sources: Mapping[str, DataFrame] | None = None,
            min_rows: Mapping[str, int] = MIN_ROWS, max_workers: int = 4,
            publish_to: str | None = None, cluster: bool | str = True,
            max_orphans: int | None = None, resume: str | None = None) -> RefreshResult:
    """Run the whole pipeline. Sources come from ``<data_dir>/<table>.csv`` or as frames.

    Every call writes below a fresh run folder ``<out_dir>/run=<id>``, so it never touches the
    tables of an earlier run. With ``publish_to``, an entry for this run's marts is added there
    after both gates passed; readers use ``published_marts``, which takes the newest complete
    entry. Entries are only ever added, so at no moment do readers see missing or unchecked
    marts, also when a refresh or the publishing itself fails.

    A call that fails leaves its run folder as it is and names it in a note of the exception. Given
    as ``resume`` with the same sources, the next call goes on there: tables that were written to
    their end are read, the others built, all gates checked again (``RefreshResult.reused`` says
    which were read). Any run that is not published may be deleted, and so may those that
    ``expired_runs`` lists.

    Payments without an order are only logged unless ``max_orphans`` bounds them.
    ``cluster`` sorts every written file on its table key (the reference's layout, for
    row-group skipping by key); turn it off where no reader filters on those keys. With ``"ranges"``
    the growing marts are also ranged by their key across files (``sources.ranged``): one more
    exchange of each, for readers that then open a file or two for a key."""
    if sources is None:
        if data_dir is None:
            raise ValueError("give data_dir or sources")
        # a missing file fails here (S3); parsing and the non-empty check (S4) happen in
        # the one scan that also loads the table, instead of reading every file twice
        sources = {name: read_source(spark, data_dir, name) for name in MIN_ROWS}
    out_dir = resume.rstrip("/") if resume else f"{out_dir.rstrip('/')}/run={run_id()}"
    try:
        with bounded_tasks(spark, sources.values()), sized_shuffle(spark, sources.values()) as partitions:
            result = RefreshResult(shuffle_partitions=partitions, run_dir=out_dir, resumed=resume is not None)
            _run(spark, sources, out_dir, min_rows, max_workers, result, cluster, max_orphans)
        if publish_to is not None:
            publish(spark, result, publish_to)
    except Exception as exc:
        exc.add_note(f"to continue this refresh: resume={out_dir!r}")
        raise
    return result


def run_id() -> str:
    """A new run's name; later runs sort after earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, result: RefreshResult, pointer: str) -> None:
    """Add an entry for a checked run: one row with all its marts (name -> path), appended in one
    committed file. Nothing that is there is changed."""
    spark.createDataFrame([(run_id(), dict(sorted(result.marts.items())))], POINTER_SCHEMA).coalesce(1) \
        .write.mode("append").parquet(pointer)


def published_marts(spark: SparkSession, pointer: str) -> dict[str, DataFrame]:
    """The marts of the last published run (the newest entry; an entry is one row, so it is
    there whole or not at all)."""
    newest = spark.read.schema(POINTER_SCHEMA).parquet(pointer).agg(F.max_by("marts", "entry").alias("marts")).first()["marts"]
    if newest is None:
        raise LookupError(f"nothing published at {pointer}")
    return {name: spark.read.parquet(path) for name, path in newest.items()}


def expired_runs(spark: SparkSession, pointer: str, keep: int = 7) -> list[str]:
    """Run folders of published runs older than the newest ``keep``, which no reader is sent to any more and
    which may be deleted. The entries themselves, one small row for each refresh, stay."""
    entries = spark.read.schema(POINTER_SCHEMA).parquet(pointer).orderBy(F.desc("entry")).select("marts").collect()  # one per refresh
    folders = [next(iter(r["marts"].values())).rsplit("/marts/", 1)[0] for r in entries]
    return [f for f in dict.fromkeys(folders[keep:]) if f not in folders[:keep]]


def _run(spark: SparkSession, sources: Mapping[str, DataFrame], out_dir: str,
         min_rows: Mapping[str, int], max_workers: int, result: RefreshResult,
         cluster: bool | str, max_orphans: int | None = None) -> None:
    staged = load_staging(spark, sources, out_dir, result, max_workers, cluster)
    empty = [name for name, n in result.rows.items() if n == 0]
    if empty:
        raise SourceEmpty(f"empty source: {', '.join(sorted(empty))}")
    result.metrics += [("load", name, n) for name, n in result.rows.items()]
    t0 = time.perf_counter()
    # minimum rows come from the counts observed while loading: decided at once, before
    # any mart is built
    minimums = Q.enforce(Q.min_rows_rows(result.rows, min_rows), "staging gate")
    result.seconds["gate:staging"] = time.perf_counter() - t0
    orphans = Q.orphan_payments(staged["order_payments"], staged["orders"], max_orphans)

    def check_orphans() -> list:
        t1 = time.perf_counter()
        rows = Q.enforce(orphans, "staging gate")
        result.seconds["gate:orphans"] = time.perf_counter() - t1
        return rows

    if max_orphans is not None:
        # an error-level orphan check stops the run before the marts
        result.staging_report = minimums + check_orphans()
        build_marts(spark, staged, out_dir, result, max_workers, cluster)
    else:
        # logged only, it cannot stop the run: counted where the fact joins payments and orders; by the
        # anti-join only where that was not observed (a fact kept from an earlier call, ranged marts)
        build_marts(spark, staged, out_dir, result, max_workers, cluster, count_orphans=True)
        found = check_orphans() if result.orphans is None else Q.enforce(Q.orphan_rows(result.orphans), "staging gate")
        result.staging_report = minimums + found
    t0 = time.perf_counter()
    result.mart_report = Q.enforce(Q.mart_check_rows(**result.mart_counts), "mart gate")
    result.seconds["gate:marts"] = time.perf_counter() - t0
    result.metrics.append(("mart", "fct_order_payments", result.mart_counts["fact_rows"]))
    result.metrics.append(("mart", "dim_customer", result.mart_counts["dim_rows"]))
    sinks.metrics_frame(spark, result.metrics).coalesce(1).write.mode("overwrite") \
        .parquet(f"{out_dir}/metrics")                                   # K5: a few rows
