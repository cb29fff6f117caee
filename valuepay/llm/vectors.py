"""Embedding near-duplicates by sorted projection passes (operator 3).

A pass hashes every vector to one bit per random projection, concatenates the bits into a key, orders all
vectors by it and compares each with a bounded window of neighbours. Pairs missed in one pass are found
in another; the pairs of all passes are united. The number of passes follows from that of the leaders, and
more are added until a round of them finds nothing new.

A window alone would lose links in a large group of near copies. So the first passes collapse: within a
block of neighbours a vector joins the ball of a leader if all its ball lies within half the linking angle
of the leader; members of one ball are then linked with each other by the triangle inequality, without a
pair being written. Collapsing is repeated while it helps. The linking passes order leaders only, and for
two near balls either all pairs of members are linked, or none, or the members are compared in blocks that
write one count per member. Rows stay in proportion to vectors however large a group is.

A large group too loose to collapse would outgrow the windows. So a leader that links with ``DENSE`` others
of one window writes no pairs: it is dense, leaves the order, and the passes go on without it until they
find no other. Every member of a dense ball then meets every vector that can link with it: members belong
to the cell of their nearest pivot, a vector is a candidate of each cell whose pivot lies within the cell's
radius and the linking angle (the triangle inequality again, so none is lost), and members and candidates
are compared in chunks that write one count per vector.

Defined results: a vector that is null, empty, zero, or holds a null or non-finite component links with
nothing and is its own component; vectors of different length never link; equal vectors link; rows with
one id are vectors of their own; ids that are null are passed over in the smallest id of a component; an
empty table gives an empty result; other columns (labels) are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuepay.llm.components import components
from valuepay.session import scratch_path

WINDOW = 256  # neighbours that a vector is compared with, before it
PASSES = 16  # linking passes at least
MISS = 1e-4  # chance of missing an isolated pair at the limit by which the number of passes is set
COLLAPSES = 8  # collapsing passes at most
KEY_BITS = 48
DENSE = 64  # linked leaders in one window from which on a leader is compared exactly
CHUNK = 2048  # members of a ball compared at once
MARGIN = 1e-6  # angle by which balls are kept smaller than proven


def passes_for(leaders: int, link: float) -> int:
    """Passes after which an isolated pair at the linking angle is missed with chance ``MISS``, if signs
    halve the order evenly: a pass finds it when its first signs, down to a window, agree."""
    found = (1 - link / np.pi) ** np.log2(max(leaders / WINDOW, 1))
    return 1 if found > 1 - MISS else int(np.ceil(np.log(MISS) / np.log1p(-found)))


def projections(seed: int, width: int) -> np.ndarray:
    return np.random.default_rng((seed, width)).standard_normal((width, KEY_BITS))


def keys(unit: np.ndarray, seed: int) -> np.ndarray:
    """One sortable key per vector: the signs of its projections, first projection foremost."""
    bits = unit @ projections(seed, unit.shape[1]) > 0
    return bits @ (np.int64(1) << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def with_keys(rows: DataFrame, passes: list[int]) -> DataFrame:
    """Every vector once per pass, with its width and key."""
    fields = rows.schema

    def run(batches):
        for batch in batches:
            width = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
            for w in np.unique(width):
                part = batch.filter(pa.array(width == w)) if (width != w).any() else batch
                x = units(matrix(part.column("v")))
                for p in passes:
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(np.full(len(x), p, np.int32)), pa.array(np.full(len(x), w, np.int32)), pa.array(keys(x, p))],
                        names=[*part.schema.names, "pass", "width", "key"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", pass int, width int, key bigint"
    return rows.mapInArrow(run, schema)


def ordered(rows: DataFrame, passes: list[int]) -> DataFrame:
    """All passes' orders: neighbours by key are neighbours in a partition."""
    columns = ["pass", "width", "key", "uid"]
    return with_keys(rows, passes).repartitionByRange(*columns).sortWithinPartitions(*columns)


def stretches(batch: pa.RecordBatch):
    """Parts of a sorted batch that belong to one pass and one width."""
    tag = batch.column("pass").to_numpy().astype(np.int64) << 32 | batch.column("width").to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(tag)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield int(tag[lo]), batch.slice(lo, hi - lo)


def collapse(rows: DataFrame, seed: int, limit: float) -> DataFrame:
    """One collapsing pass over leaders ``uid, v, radius``: ``uid, leader, v, radius``, where ``v`` and the
    new ``radius`` are set for the rows that stay leaders."""
    def run(batches):
        for batch in batches:
            for _, part in stretches(batch):
                for lo in range(0, part.num_rows, WINDOW):
                    block = part.slice(lo, WINDOW)
                    uid, radius = block.column("uid").to_numpy(), block.column("radius").to_numpy().copy()
                    x = units(matrix(block.column("v")))
                    theta = angle(x @ x.T)
                    leader = np.arange(len(x))
                    free = np.ones(len(x), bool)
                    reach = radius.copy()
                    for i in np.argsort(-radius, kind="stable").tolist():  # balls first, so that they grow
                        if not free[i]:
                            continue
                        free[i] = False
                        far = theta[i] + radius
                        joins = free & (far <= limit)
                        leader[joins] = i
                        free[joins] = False
                        if joins.any():
                            reach[i] = max(reach[i], far[joins].max())
                    stays = leader == np.arange(len(x))
                    yield pa.RecordBatch.from_arrays(
                        [block.column("uid"), pa.array(uid[leader]),
                         pa.array([v if s else None for v, s in zip(block.column("v").to_pylist(), stays)], pa.list_(pa.float64())),
                         pa.array(np.where(stays, reach, 0.0))], names=["uid", "leader", "v", "radius"])

    return ordered(rows, [seed]).mapInArrow(run, "uid bigint, leader bigint, v array<double>, radius double")


def near_pairs(leaders: DataFrame, passes: list[int], link: float) -> DataFrame:
    """Pairs of leaders whose balls may hold linked members: ``a, b`` (a < b), their angle ``theta`` and
    the balls' radii ``ra, rb``. A dense leader has a row with ``b`` null instead of the pairs with those
    before it."""
    def run(batches):
        tag, tail = None, None
        for batch in batches:
            for new_tag, part in stretches(batch):
                if new_tag != tag:
                    tag, tail = new_tag, None
                for lo in range(0, part.num_rows, WINDOW):
                    block = part.slice(lo, WINDOW)
                    own = (block.column("uid").to_numpy(), units(matrix(block.column("v"))), block.column("radius").to_numpy())
                    uid, x, r = own if tail is None else tuple(np.concatenate(z) for z in zip(tail, own))
                    skip = len(uid) - len(own[0])
                    theta = angle(own[1] @ x.T)
                    near = theta <= link + own[2][:, None] + r[None, :] + MARGIN
                    near &= np.arange(len(uid))[None, :] < np.arange(len(own[0]))[:, None] + skip
                    dense = (theta <= link).sum(axis=1) > DENSE  # itself among them
                    near[dense] = False
                    if dense.any():
                        full = own[0][dense]
                        gap = pa.nulls(len(full), pa.float64())
                        yield pa.RecordBatch.from_arrays([pa.array(full), pa.nulls(len(full), pa.int64()), gap, gap, gap],
                                                         names=["a", "b", "theta", "ra", "rb"])
                    i, j = np.nonzero(near)
                    if len(i):
                        flip = own[0][i] > uid[j]
                        pick = lambda m, n: np.where(flip, m, n)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(pick(uid[j], own[0][i])), pa.array(pick(own[0][i], uid[j])), pa.array(theta[i, j]),
                             pa.array(pick(r[j], own[2][i])), pa.array(pick(own[2][i], r[j]))], names=["a", "b", "theta", "ra", "rb"])
                    tail = own if len(own[0]) >= WINDOW else tuple(z[-WINDOW:] for z in (uid, x, r))

    found = ordered(leaders, passes).mapInArrow(run, "a bigint, b bigint, theta double, ra double, rb double")
    return found.groupBy("a", "b").agg(*[F.min(c).alias(c) for c in ("theta", "ra", "rb")])


def compare_members(pairs: DataFrame, members: DataFrame, sizes: DataFrame, cosine: float) -> DataFrame:
    """For undecided pairs of balls: ``a, b, uid, links``, a row for each member with a link to the other
    ball. Balls are compared in chunks of at most about ``CHUNK`` members."""
    parts = sizes.select("ball", F.ceil(F.col("size") / CHUNK).cast("int").alias("parts"))
    sided = pairs.select("a", "b")
    sided = (sided.join(parts.select(F.col("ball").alias("a"), F.col("parts").alias("pa")), "a")
             .join(parts.select(F.col("ball").alias("b"), F.col("parts").alias("pb")), "b"))

    def side(own: str, other: str, left: bool) -> DataFrame:
        chunk = F.pmod(F.xxhash64("uid"), F.col(f"p{own}")).cast("int")
        rows = (sided.join(members.withColumnRenamed("ball", own), own)
                .withColumn("own", chunk).withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col(f"p{other}") - 1))))
        ca, cb = ("own", "theirs") if left else ("theirs", "own")
        return rows.select("a", "b", F.col(ca).alias("ca"), F.col(cb).alias("cb"), F.lit(left).alias("of_a"), "uid", "v")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = rows[rows["of_a"]], rows[~rows["of_a"]]
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": [], "uid": [], "links": []})
        hit = units(np.stack(x["v"].to_numpy())) @ units(np.stack(y["v"].to_numpy())).T >= cosine
        uid = np.concatenate((x["uid"].to_numpy(), y["uid"].to_numpy()))
        links = np.concatenate((hit.sum(axis=1), hit.sum(axis=0)))
        return pd.DataFrame({"a": rows["a"].iloc[0], "b": rows["b"].iloc[0], "uid": uid[links > 0], "links": links[links > 0]})

    return (side("a", "b", True).unionByName(side("b", "a", False)).groupBy("a", "b", "ca", "cb")
            .applyInPandas(run, "a bigint, b bigint, uid bigint, links bigint"))


def apart(x: np.ndarray, cosine: float) -> np.ndarray:
    """Numbers of rows such that every row has one of them at ``cosine`` or more."""
    free, picked = np.ones(len(x), bool), []
    while free.any():
        picked.append(int(free.argmax()))
        free &= x @ x[picked[-1]] < cosine
        free[picked[-1]] = False
    return np.array(picked, int)


def pivots(dense: DataFrame, link: float) -> dict[int, np.ndarray]:
    """Unit vectors, by width, around which the cells of the dense leaders ``v`` lie: those of a partition,
    then those of all, lie more than twice the linking angle apart, so each has ``DENSE`` leaders of its own."""
    cosine = float(np.cos(min(2 * link, np.pi)))

    def spread(x: list[np.ndarray]) -> list[np.ndarray]:
        by_width = [np.stack([v for v in x if len(v) == w]) for w in sorted({len(v) for v in x})]
        return [v for m in by_width for v in m[apart(m, cosine)]]

    def run(batches):
        kept = []
        for batch in batches:
            kept = spread(kept + [units(np.array([v]))[0] for v in batch.column("v").to_pylist()])
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array([v.tolist() for v in kept], pa.list_(pa.float64()))], names=["v"])

    kept = spread([np.array(r["v"]) for r in dense.select("v").mapInArrow(run, "v array<double>").collect()])
    return {w: np.stack([v for v in kept if len(v) == w]) for w in {len(v) for v in kept}}


def of_width(batches):
    """Rows of one vector length at a time."""
    for batch in batches:
        width = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
        for w in np.unique(width).tolist():
            part = batch.filter(pa.array(width == w))
            yield w, part, units(matrix(part.column("v")))


def compare_dense(vectors: DataFrame, around: dict[int, np.ndarray], link: float, cosine: float) -> DataFrame:
    """Links of the vectors ``uid, ball, dense, v`` with the dense ones among them: ``uid, ball, links, root``.
    ``links`` of a dense vector counts all its links, of another those with dense vectors; ``root`` is a ball
    that it is linked with. A vector has a row for each pair of chunks in which it has a link."""
    spark = vectors.sparkSession
    first = dict(zip(around, np.cumsum([0, *[len(p) for p in around.values()]]).tolist()))  # number of a width's first cell

    def nearest(batches):
        for w, part, x in of_width(batches):
            theta = angle(x @ around[w].T)
            yield pa.RecordBatch.from_arrays([pa.array(theta.argmin(axis=1) + first[w]), pa.array(theta.min(axis=1))], names=["cell", "far"])

    reach = {r["cell"]: r["far"] for r in vectors.filter("dense").select("v").mapInArrow(nearest, "cell bigint, far double")
             .groupBy("cell").agg(F.max("far").alias("far")).collect()}

    def deal(batches):
        for w, part, x in of_width(batches):
            if w not in around:
                continue
            theta = angle(x @ around[w].T)
            limit = np.array([reach.get(first[w] + k, -np.inf) for k in range(theta.shape[1])]) + link + MARGIN
            i, cell = np.nonzero(theta <= limit)
            dense = np.flatnonzero(part.column("dense").to_numpy(zero_copy_only=False))
            for rows, cells, own in ((i, cell, False), (dense, theta[dense].argmin(axis=1), True)):
                yield pa.RecordBatch.from_arrays([*part.take(pa.array(rows)).columns, pa.array(cells + first[w]), pa.array(np.full(len(rows), own))],
                                                 names=[*part.schema.names, "cell", "own"])

    path = scratch_path(spark, "vectors-cells")
    vectors.select("uid", "ball", "dense", "v").mapInArrow(
        deal, "uid bigint, ball bigint, dense boolean, v array<double>, cell bigint, own boolean").write.parquet(path)
    dealt = spark.read.parquet(path)
    part = lambda own: F.ceil(F.sum((F.col("own") == own).cast("int")) / CHUNK).cast("int")
    parts = dealt.groupBy("cell").agg(part(True).alias("px"), part(False).alias("py")).filter("px > 0")  # a row per pivot

    def side(own: bool) -> DataFrame:
        mine, theirs, count, other = ("cx", "cy", "px", "py") if own else ("cy", "cx", "py", "px")
        return (dealt.filter(F.col("own") == own).join(F.broadcast(parts), "cell")
                .withColumn(mine, F.pmod(F.xxhash64("uid"), F.col(count)).cast("int"))
                .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .select("cell", "cx", "cy", "own", "uid", "ball", "dense", "v"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = rows[rows["own"]], rows[~rows["own"]]
        if not len(x) or not len(y):
            return pd.DataFrame({"uid": [], "ball": [], "links": [], "root": []})
        hit = units(np.stack(x["v"].to_numpy())) @ units(np.stack(y["v"].to_numpy())).T >= cosine
        hit &= x["uid"].to_numpy()[:, None] != y["uid"].to_numpy()[None, :]
        root_x, root_y = np.full(len(x), -1, np.int64), np.full(len(y), -1, np.int64)
        ball = x["ball"].to_numpy()
        for i in np.flatnonzero(hit.any(axis=1)).tolist():
            if root_x[i] >= 0:
                continue
            new = np.array([i])
            while len(new):  # one step to the other side and back
                root_x[new] = ball[i]
                over = hit[new].any(axis=0) & (root_y < 0)
                root_y[over] = ball[i]
                new = np.flatnonzero(hit[:, over].any(axis=1) & (root_x < 0))
        both = pd.concat((x, y))
        links = np.concatenate((hit.sum(axis=1), np.where(y["dense"], 0, hit.sum(axis=0))))
        root = np.concatenate((root_x, root_y))
        return pd.DataFrame({"uid": both["uid"].to_numpy(), "ball": both["ball"].to_numpy(), "links": links, "root": root})[root >= 0]

    return (side(True).unionByName(side(False)).groupBy("cell", "cx", "cy")
            .applyInPandas(run, "uid bigint, ball bigint, links bigint, root bigint"))


def near_vectors(vectors: DataFrame, cosine: float = 0.95, passes: int = PASSES, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per vector: ``vec_id, n_links`` (other vectors at ``cosine`` or more that were found),
    ``component_id`` (smallest id reachable by links) and ``kept`` (whether that is its own id)."""
    spark = vectors.sparkSession
    link = float(np.arccos(cosine))

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    value = F.col(column).cast("array<double>")
    rows = written(vectors.select(F.col(key).alias("id"), value.alias("v")).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    valid = rows.filter(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)).select("uid", "v", F.lit(0.0).alias("radius"))

    # collapse into balls
    leaders, count, joined = written(valid, "vectors-valid"), None, []
    before = leaders.count()
    for k in range(COLLAPSES):
        step = written(collapse(leaders, 1000 + k, link / 2 - MARGIN), f"vectors-collapse{k}")
        joined.append(step.filter("uid <> leader").select("uid", "leader"))
        leaders = step.filter("uid = leader").select("uid", "v", "radius")
        count = leaders.count()
        if k and count > 0.98 * before:
            break
        before = count
    ball = valid.select("uid", F.col("uid").alias("ball"))
    for step in joined:
        ball = ball.join(step.select(F.col("uid").alias("ball"), "leader"), "ball", "left").select("uid", F.coalesce("leader", "ball").alias("ball"))
    ball = written(ball, "vectors-balls")
    sizes = ball.groupBy("ball").agg(F.count(F.lit(1)).alias("size"))

    # near balls: linked as a whole, or member by member; dense leaders leave the order
    dense, found, tried, more = spark.createDataFrame([], "ball bigint"), None, 0, max(passes, passes_for(count, link))
    while True:
        sparse = leaders.join(dense, leaders["uid"] == dense["ball"], "left_anti")
        new = near_pairs(sparse, list(range(tried, tried + more)), link)
        if found is not None:
            new = new.join(found.select("a", "b"), ["a", "b"], "left_anti")
        new = written(new, f"vectors-pairs{tried}")
        found, tried, more = new if found is None else found.union(new), tried + more, max(4, more // 4) if found is None else more
        full = new.filter("b is null").select(F.col("a").alias("ball"))
        if not full.isEmpty():
            dense = written(dense.union(full), f"vectors-dense{tried}")
        if new.isEmpty():
            break
    pairs = found.filter("b is not null")
    for end in ("a", "b"):
        pairs = pairs.join(dense, pairs[end] == dense["ball"], "left_anti")
    pairs = written(pairs, "vectors-pairs")
    whole = pairs.filter(F.col("theta") + F.col("ra") + F.col("rb") <= (link - MARGIN if cosine < 1 else -1.0))
    undecided = pairs.join(whole.select("a", "b"), ["a", "b"], "left_anti")
    needed = undecided.select(F.col("a").alias("ball")).union(undecided.select(F.col("b").alias("ball"))).distinct()
    members = ball.join(needed, "ball", "left_semi").join(valid.select("uid", "v"), "uid")
    counted = written(compare_members(undecided, members, sizes, cosine), "vectors-counts")

    # members of dense balls: exactly
    crowd = spark.createDataFrame([], "uid bigint, ball bigint, links bigint, root bigint")
    if not dense.isEmpty():
        marked = ball.join(dense.withColumn("dense", F.lit(True)), "ball", "left").withColumn("dense", F.coalesce("dense", F.lit(False)))
        around = pivots(leaders.join(dense, leaders["uid"] == dense["ball"], "left_semi"), link)
        crowd = written(compare_dense(marked.join(valid.select("uid", "v"), "uid"), around, link, cosine), "vectors-crowd")

    both = whole.select("a", "b").union(whole.select(F.col("b").alias("a"), F.col("a").alias("b")))
    of_ball = (both.join(sizes.withColumnRenamed("ball", "b"), "b").groupBy("a").agg(F.sum("size").alias("near"))
               .withColumnRenamed("a", "ball"))
    of_member = counted.groupBy("uid").agg(F.sum("links").alias("some"))
    of_crowd = crowd.groupBy("uid").agg(F.sum("links").alias("crowd"))
    linked = (whole.select("a", "b").union(counted.select("a", "b").distinct())
              .union(crowd.select(F.col("ball").alias("a"), F.col("root").alias("b")).distinct()))
    part = components(linked).select(F.col("id").alias("ball"), F.col("component").alias("root"))

    by_ball = F.col("size") - 1 + F.coalesce("near", F.lit(0)) + F.coalesce("some", F.lit(0))
    found = (ball.join(sizes, "ball").join(of_ball, "ball", "left").join(part, "ball", "left").join(of_member, "uid", "left")
             .join(of_crowd, "uid", "left").join(dense.withColumn("dense", F.lit(True)), "ball", "left")
             .select("uid", F.coalesce("root", "ball").alias("root"),
                     (F.when(F.col("dense"), 0).otherwise(by_ball) + F.coalesce("crowd", F.lit(0))).alias("n_links")))
    named = rows.select("uid", "id").join(found, "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    return named.join(least, "root").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
