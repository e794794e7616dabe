"""Near-duplicate vectors by NN-descent.

Vectors are brought to length one in double precision; equal vectors are one node from the
start. Every node gets a first list of ``k`` neighbours from small blocks: nodes on one side of
a few seeded hyperplanes, for several sets of planes. Then the lists are refined: around each
node its neighbours, and the nodes that have it as a neighbour, are compared with one another
(neighbours of neighbours), and each keeps the nearest it has seen, until few lists change.

Edges of the threshold or more, checked in double precision, are kept. A list that is full of
such edges is saturated and may miss some. It is enlarged: its node gets a second list, of the
nearest nodes outside its own component, found and refined in the same way, until no edge of
the threshold joins two components. Links are not read off the lists: within a component all
pairs are counted exactly, block by block, without being written out. An audit compares a
bounded sample of vectors with all others by brute force; as long as it meets a link between two
components, that link is kept, lists are doubled and refined again, and another sample is drawn.

Hubs, large buckets and large components are cut into blocks of ``BLOCK`` rows. Components are
compared block by block as a whole; a hub's neighbours meet within blocks, which are dealt anew
in every round.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component link
with nothing, and vectors of different lengths do not link with each other; ties are broken by
the smaller node; repeated rows are vectors of their own and link with their copies; an empty
table gives an empty table; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count as numbers

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ludomart.llm.common import components, stored

THRESHOLD = 0.9
NEIGHBOURS = 8
TREES = 6
BLOCK = 512
ROUNDS = 4
AUDIT = 500


def nodes(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, node, v) for each row: the unit vector as bytes of doubles and a hash of it; null
    where the row can link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column("_v").to_pylist():
                v = None
                if x and None not in x:
                    a = np.array(x, np.float64)
                    if np.isfinite(a).all():
                        top = np.abs(a).max()
                        if top > 0:
                            a = a / top
                            v = (a / np.linalg.norm(a)).tobytes()
                out.append(v)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], names=["id", "v"])

    own = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("_v"))
    unit = own.mapInArrow(run, "id bigint, v binary")
    return unit.withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v")))


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """Vectors of one length as rows."""
    raw = b"".join(x.as_py() for x in column)
    return np.frombuffer(raw, np.float64).reshape(len(column), -1).astype(kind, copy=False)


def _by_group(names: list[str], work: Callable[[pa.Table], list[tuple]]) -> Callable:
    """Runs ``work`` on each run of rows that agree in ``names``, over sorted partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            key = np.stack([held.column(c).to_numpy() for c in names], 1)
            change = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            if len(change):
                for lo, hi in zip(np.append(0, change[:-1]), change, strict=True):
                    yield from work(held.slice(lo, hi - lo))
                held = held.slice(change[-1]).combine_chunks()
        if held is not None and held.num_rows:
            yield from work(held)

    return run


EDGE = "a bigint, b bigint, sim double"
# Columns of a point: what two nodes must differ in to be compared, and whether it wants a list.
POINT = ("node", "v", "own", "seeks")


def _edges(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float64())], names=["a", "b", "sim"]
    )


def _best(ids: np.ndarray, x: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """For each row its ``k`` nearest of the block that differ in ``own``, where nearer than its
    floor."""
    rows = np.flatnonzero(floor < 2.0)
    k = min(k, len(ids) - 1)
    if k < 1 or not len(rows):
        return
    sim = x[rows] @ x.T
    sim[own[rows][:, None] == own[None, :]] = -2.0
    near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    val = np.take_along_axis(sim, near, 1)
    i, j = np.nonzero((val > floor[rows][:, None]) & (val > -2.0))
    if len(i):
        yield _edges(ids[rows[i]], ids[near[i, j]], val[i, j].astype(np.float64))


def _start(points: DataFrame, count: int, k: int, trees: int, seed: int) -> DataFrame:
    """First lists of the points that seek, from buckets on one side of seeded hyperplanes."""
    bits = max(0, int(np.ceil(np.log2(max(count, 1) / (BLOCK / 2)))))

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = [len(x.as_py()) // 8 for x in batch.column("v")]
            code = np.zeros((batch.num_rows, trees), np.int64)
            for d in set(sizes):
                at = np.flatnonzero(np.array(sizes) == d)
                if d not in planes:
                    planes[d] = np.random.default_rng(seed + d).standard_normal((d, trees * bits))
                x = _matrix(batch.column("v").take(pa.array(at)))
                side = (x @ planes[d] > 0).reshape(len(at), trees, bits).astype(np.int64)
                code[at] = (side << np.arange(bits)).sum(2)
            for t in range(trees):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in POINT), pa.array(np.full(batch.num_rows, t), pa.int32()), pa.array(code[:, t], pa.int64()), pa.array(sizes, pa.int32())],
                    names=[*POINT, "tree", "bucket", "dim"],
                )

    schema = "node bigint, v binary, own bigint, seeks boolean, tree int, bucket bigint, dim int"
    dealt = points.select(*POINT).mapInArrow(bucket, schema)
    full = dealt.groupBy("tree", "bucket", "dim").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    dealt = dealt.join(stored(full, "buckets"), ["tree", "bucket", "dim"])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node", "tree"), "parts"))
    keys = ["tree", "bucket", "dim", "part"]

    def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
        floor = np.where(t.column("seeks").to_numpy(), -2.0, 2.0)
        yield from _best(t.column("node").to_numpy(), _matrix(t.column("v"), np.float32), t.column("own").to_numpy(), floor, k)

    dealt = dealt.select(*keys, *POINT).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(_by_group(keys, work), EDGE)


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each list, once each."""
    once = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return once.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def _refine(lists: DataFrame, around: DataFrame, points: DataFrame, k: int, turn: int) -> DataFrame:
    """Edges for ``lists`` among the neighbours of each node: those that its list in ``around``
    has, and those whose list there has it."""
    floor = lists.groupBy("a").agg(F.min("sim").alias("least"), F.count("*").alias("n"))
    floor = floor.select(F.col("a").alias("m"), F.when(F.col("n") >= k, F.col("least")).otherwise(-2.0).alias("floor"))
    around = around.select(F.col("a").alias("c"), F.col("b").alias("m")).union(around.select("b", "a")).distinct()
    around = around.union(points.select("node", "node"))
    # A hub's members are dealt to parts; each part is compared within itself.
    parts = around.groupBy("c").agg(F.ceil(F.count("*") / BLOCK).alias("parts")).where("parts > 1")
    around = around.join(stored(parts, "hubs"), "c", "left")
    around = around.withColumn("part", F.pmod(F.xxhash64("m", "c", F.lit(turn)), F.coalesce("parts", F.lit(1))))
    rows = around.join(points.select(F.col("node").alias("m"), "v", "own", "seeks"), "m").join(floor, "m", "left")
    floor = F.when(F.col("seeks"), F.coalesce("floor", F.lit(-2.0))).otherwise(2.0)
    rows = rows.select("c", "part", "m", "v", "own", floor.alias("floor"))

    def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
        if t.num_rows > 1:
            x = _matrix(t.column("v"), np.float32)
            yield from _best(t.column("m").to_numpy(), x, t.column("own").to_numpy(), t.column("floor").to_numpy(), k)

    rows = rows.repartition("c", "part").sortWithinPartitions("c", "part")
    return rows.mapInArrow(_by_group(["c", "part"], work), EDGE)


def _settled(lists: DataFrame, beside: DataFrame | None, points: DataFrame, k: int, rounds: int, turn: int) -> DataFrame:
    """``lists`` refined, over them and the lists ``beside``, until few change."""
    size = lists.agg(F.sum("sim")).first()[0] or 0.0
    for i in range(rounds):
        around = lists if beside is None else lists.union(beside)
        lists = stored(_nearest(lists.union(_refine(lists, around, points, k, turn + i)), k), "lists")
        now = lists.agg(F.sum("sim")).first()[0] or 0.0
        done = now - size <= 0.002 * abs(size)
        size = now
        if done:
            break
    return lists


def _joined(comp: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) after edges between components."""
    ends = edges.select("a", "b")
    for end in ("a", "b"):
        ends = ends.join(comp.toDF(end, f"_{end}"), end).drop(end).withColumnRenamed(f"_{end}", end)
    over = stored(components(ends, "components").toDF("component", "_over"), "components")
    comp = comp.join(over, "component", "left")
    return stored(comp.select("node", F.coalesce("_over", "component").alias("component")), "components")


def _enlarged(
    lists: DataFrame, points: DataFrame, comp: DataFrame, count: int, k: int, trees: int, rounds: int, threshold: float, seed: int
) -> DataFrame:
    """``comp`` when the saturated lists are enlarged by neighbours outside their component,
    until none of the threshold is left."""
    full = lists.groupBy("a").agg(F.min("sim").alias("least"), F.count("*").alias("n"))
    # A margin for single precision: a list too many is harmless.
    full = full.where((F.col("n") >= k) & (F.col("least") >= threshold - 1e-4))
    full = stored(full.select(F.col("a").alias("node"), F.lit(True).alias("_full")), "full")
    if full.isEmpty():
        return comp
    for turn in numbers(1):
        own = points.select("node", "v").join(comp.withColumnRenamed("component", "own"), "node").join(full, "node", "left")
        own = stored(own.select("node", "v", "own", F.coalesce("_full", F.lit(False)).alias("seeks")), "points")
        out = stored(_nearest(_start(own, count, k, trees, seed + 1000 * turn), k), "lists")
        edges = stored(_checked(_settled(out, lists, own, k, rounds, rounds * turn), points, threshold), "near")
        if edges.isEmpty():
            return comp
        comp = _joined(comp, edges)


def _checked(edges: DataFrame, points: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) of the threshold or more in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sim = (_matrix(batch.column("x")) * _matrix(batch.column("y"))).sum(1)
                yield batch.select(["a", "b"]).filter(pa.array(sim >= threshold))

    near = edges.where(F.col("sim") >= threshold - 1e-4)
    near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    own = points.select("node", "v")
    near = near.join(own.toDF("a", "x"), "a").join(own.toDF("b", "y"), "b")
    return near.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _count_links(points: DataFrame, comp: DataFrame, threshold: float) -> DataFrame:
    """(node, links): vectors of other nodes of its component that link with it, copies
    counted; without components of one node."""
    sizes = comp.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("parts"), F.count("*").alias("n"))
    sizes = sizes.where("n > 1").drop("n")
    rows = comp.join(sizes, "component").join(points.select("node", "v", "copies"), "node")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("node"), "parts"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = rows.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")})

    def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
        x = _matrix(t.column("v"))
        ids, copies = t.column("node").to_numpy(), t.column("copies").to_numpy()
        link = x @ x.T >= threshold
        np.fill_diagonal(link, False)
        side = t.column("mine").to_numpy()
        if t.column("i")[0] != t.column("j")[0]:  # pairs within a block are counted in its own group
            link &= side[:, None] != side[None, :]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(link @ copies, pa.int64())], names=["node", "links"])

    keys = ["component", "i", "j"]
    rows = rows.select(*keys, "node", "v", "copies", "mine").repartition(*keys).sortWithinPartitions(*keys)
    counted = rows.mapInArrow(_by_group(keys, work), "node bigint, links bigint")
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def audit(spark: SparkSession, points: DataFrame, comp: DataFrame, threshold: float, queries: int, turn: int = 0) -> DataFrame:
    """Links (a, b) between two components of a sample of at most ``queries`` nodes, those of the
    least hashes, by comparison with all nodes: one for each node and component."""
    own = points.select("node", "v").join(comp, "node")
    rows = own.orderBy(F.xxhash64("node", F.lit(turn)), "node").limit(queries).toArrow()
    sample = [rows.column(c).to_pylist() for c in ("node", "v", "component")]
    shared = spark.sparkContext.broadcast(list(zip(*sample, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                sizes = np.array([len(x.as_py()) for x in part.column("v")])
                for d in set(sizes.tolist()):
                    asked = [x for x in shared.value if len(x[1]) == d]
                    if not asked:
                        continue
                    at = np.flatnonzero(sizes == d)
                    node, component = (part.column(c).to_numpy()[at] for c in ("node", "component"))
                    x = _matrix(part.column("v").take(pa.array(at)))
                    q = np.frombuffer(b"".join(v for _, v, _ in asked), np.float64).reshape(len(asked), -1)
                    apart = np.array([c for _, _, c in asked])[:, None] != component[None, :]
                    i, j = np.nonzero((q @ x.T >= threshold - 1e-9) & apart)
                    # Checked as the edges are, so that the two never disagree.
                    real = (q[i] * x[j]).sum(1) >= threshold if len(i) else np.zeros(0, bool)
                    i, j = i[real], j[real]
                    _, one = np.unique(np.stack([i, component[j]]), axis=1, return_index=True)
                    names = np.array([n for n, _, _ in asked])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[i[one]], pa.int64()), pa.array(component[j[one]], pa.int64()), pa.array(node[j[one]], pa.int64())],
                        names=["a", "component", "b"],
                    )

    missed = own.mapInArrow(run, "a bigint, component bigint, b bigint")
    return stored(missed.groupBy("a", "component").agg(F.min("b").alias("b")).select("a", "b"), "missed")


def link(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = THRESHOLD,
    k: int = NEIGHBOURS,
    trees: int = TREES,
    rounds: int = ROUNDS,
    audit_queries: int = AUDIT,
    seed: int = 6,
) -> DataFrame:
    """(key, n_links, component_id, kept) for each row."""
    spark = df.sparkSession
    own = stored(nodes(df, key, vector), "nodes")
    points = own.where("node IS NOT NULL").groupBy("node")
    points = stored(points.agg(F.first("v").alias("v"), F.count("*").alias("copies"), F.min("id").alias("id")), "points")
    count = points.count()
    alone = points.select("node", "v", F.col("node").alias("own"), F.lit(True).alias("seeks"))
    lists = stored(_nearest(_start(alone, count, k, trees, seed), k), "lists")
    comp = points.select("node", F.col("node").alias("component"))
    for attempt in numbers():
        lists = _settled(lists, None, alone, k, rounds, attempt * rounds)
        comp = _joined(comp, stored(_checked(lists, points, threshold), "near"))
        comp = _enlarged(lists, points, comp, count, k, trees, rounds, threshold, seed + attempt)
        missed = audit(spark, points, comp, threshold, audit_queries, attempt)
        if missed.isEmpty():
            break
        # Each attempt joins two components at least, so the attempts end.
        comp = _joined(comp, missed)
        k *= 2
    links = stored(_count_links(points, comp, threshold), "links")
    named = comp.join(points.select("node", "id"), "node")
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    by_node = points.join(comp, "node", "left").join(least, "component", "left").join(links, "node", "left")
    by_node = by_node.select(
        "node",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    out = own.select("id", "node").join(by_node, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
