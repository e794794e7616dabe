"""The prefix trie of conversations by truncation peeling.

Two conversations share a node at depth d if their first d turns agree in role and text. A turn
is known by the md5 of both, a node by a 128-bit hash of its turns' md5. Conversations are
sorted by their turns and cut into ranges, so that a range holds neighbouring paths and a
conversation with any number of copies is spread over ranges. Each range is peeled from its
largest depth down: the conversations that end there are merged with the nodes that are left
from the depth below, the last turn of all is stripped, and what then agrees becomes one node.
Members, smallest id, children, leaves and saved tokens are summed in the same pass.

Only nodes on the path of a range's first or last conversation can go on in another range. These
two paths, with what the range knows of their nodes, are the rows of the next level, which is
peeled in the same way, in far fewer ranges, until one range is left. Nodes whose parent was
still open then look up its id. The ids of conversations that end in an open node are written as
one text a range and hashed in their order, a piece at a time.

A level's tables are written to the shared folder; a task holds ``TURNS`` turns, or one
conversation if that has more. The driver sees counts only.

Defined results: rows without a conversation id belong to none; a null turn comes first; turns
of equal number are ordered by the md5 of role and text; a null role or text is empty; repeated
rows are turns of their own; a path may be empty and then ends at the root; an empty table has
no nodes; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ludomart.llm.common import stored
from ludomart.llm.words import bytes_of, mix
from ludomart.session import workspace

# Turns that a task peels at once, and entries of open paths that one last task takes.
TURNS = 500_000
LAST_ENTRIES = 500_000
WORDS = r"[^\x20\x09-\x0D]+"

SUMS = ("members", "least", "kids", "leaves", "saved")
OUT = StructType(
    [StructField(c, StringType()) for c in ("kind", "ends_sha256", "ids")]
    + [StructField(c, BinaryType()) for c in ("label", "parent_label", "turn_md5")]
    + [
        StructField(c, LongType())
        for c in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "first")
    ]
    + [StructField("keys", ArrayType(BinaryType())), StructField("words", ArrayType(IntegerType()))]
    + [StructField(c, ArrayType(LongType())) for c in SUMS]
)
NODE = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_md5"]

NO_ID = np.iinfo(np.int64).max
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def turn_key(role: Column, text: Column) -> Column:
    """md5 of role and text, which the length of the role keeps apart."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def paths(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: conv_id, ``keys`` (md5 of each turn in order) and
    ``words`` (words of its text). Texts do not leave the scan."""
    role_, text_ = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    rows = df.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"),
        F.struct(
            F.col(f"`{turn}`").isNotNull().alias("known"),
            F.col(f"`{turn}`").alias("turn"),
            F.unhex(turn_key(role_, text_)).alias("key"),
            F.regexp_count(text_, F.lit(WORDS)).cast("int").alias("words"),
        ).alias("row"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return ordered.select("conv_id", F.col("rows.key").alias("keys"), F.col("rows.words").alias("words"))


class _Range:
    """The rows of a range in order of their paths, as flat arrays with a slot for each depth
    of each row, the root included."""

    def __init__(self, batches: list[pa.RecordBatch], leaf_level: bool):
        data = pa.Table.from_batches(batches).combine_chunks()
        keys = data.column("keys").combine_chunks() if data.num_rows else None
        self.size = keys.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.at = np.cumsum(self.size + 1) - self.size - 1
        slots = int((self.size + 1).sum())
        turn = np.ones(slots, bool)
        turn[self.at] = False
        raw, _ = bytes_of(keys.flatten())
        self.key = np.zeros((slots, 16), np.uint8)
        self.key[turn] = raw.reshape(-1, 16)
        self.words = np.zeros(slots, np.int64)
        self.words[turn] = data.column("words").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.first = data.column("first").to_numpy()
        self.sums = {}
        end = self.at + self.size
        for c in SUMS:
            if leaf_level:  # a conversation counts where it ends
                self.sums[c] = np.full(slots, NO_ID if c == "least" else 0, np.int64)
            else:
                self.sums[c] = data.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        if leaf_level:
            self.sums["members"][end] = 1
            self.sums["least"][end] = self.first
        self.long = np.argsort(-self.size, kind="stable")
        self.depth = int(self.size.max())
        self.label = np.zeros((slots, 2), np.uint64)
        part = np.ascontiguousarray(self.key).view(np.uint64)
        for d in range(1, self.depth + 1):
            i = self.at[self.reaching(d)] + d
            for c, factor in enumerate((_C1, _C2)):
                self.label[i, c] = mix(self.label[i - 1, c] * factor + part[i, c] + np.uint64(d))

    def reaching(self, d: int) -> np.ndarray:
        return self.long[: int(np.searchsorted(-self.size[self.long], -d, side="right"))]


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of 16 bytes as a binary column."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * 16
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())]
    )


def _batch(kind: str, n: int, columns: dict) -> pa.RecordBatch:
    schema = to_arrow_schema(OUT)
    made = {f.name: pa.nulls(n, f.type) for f in schema} | {"kind": pa.array([kind] * n, pa.string())}
    made |= {c: v if isinstance(v, pa.Array) else pa.array(v, schema.field(c).type) for c, v in columns.items()}
    return pa.RecordBatch.from_arrays([made[f.name] for f in schema], schema=schema)


def _peel(r: _Range, leaf_level: bool, last: bool) -> Iterator[pa.RecordBatch]:
    no_sha = hashlib.sha256(b"").hexdigest()
    edges = [0] if len(r.size) == 1 else [0, len(r.size) - 1]
    known = {e: {c: np.full(r.size[e] + 1, NO_ID if c == "least" else 0, np.int64) for c in SUMS} for e in edges}
    by_end = np.argsort(r.size, kind="stable")
    left: dict[str, np.ndarray] | None = None

    def emit(nodes: dict, pick: np.ndarray, depth: int, parent: np.ndarray | None, pending: np.ndarray | None):
        slot = nodes["slot"][pick]
        columns = {
            "depth": np.full(len(slot), depth),
            "conv_id": nodes["least"][pick],
            "n_convs": nodes["members"][pick],
            "n_children": nodes["kids"][pick],
            "n_leaves": nodes["leaves"][pick],
            "saved_tokens": nodes["saved"][pick],
        }
        if leaf_level:
            columns["ends_sha256"] = nodes["sha"][pick].tolist()
        else:
            columns["label"] = _binary(r.label[slot])
        if depth:
            columns["turn_md5"] = _binary(r.key[slot])
            if pending is None:
                columns["parent_conv_id"] = parent
            else:
                columns["parent_label"] = _binary(pending)
        return _batch("node", len(slot), columns)

    for d in range(r.depth, -1, -1):
        if leaf_level:
            lo, hi = np.searchsorted(r.size[by_end], [d, d + 1])
            rows = by_end[lo:hi]
        else:
            rows = r.reaching(d)
        rows = np.sort(rows)
        own = r.at[rows] + d
        n_left = 0 if left is None else len(left["row"])
        row = np.concatenate([left["row"], rows]) if n_left else rows
        item = {c: r.sums[c][own] for c in SUMS}
        if n_left:
            # An open node is counted where its path ends up; its parent is open as well.
            shut = ~left["open"]
            item = {
                "members": np.concatenate([left["members"] * shut, item["members"]]),
                "least": np.concatenate([np.where(shut, left["least"], NO_ID), item["least"]]),
                "kids": np.concatenate([shut.astype(np.int64), item["kids"]]),
                "leaves": np.concatenate([left["leaves"] * shut, item["leaves"]]),
                "saved": np.concatenate([left["saved"] * shut, item["saved"]]),
            }
        order = np.argsort(row, kind="stable")
        slot = r.at[row[order]] + d
        label = r.label[slot]
        new = np.ones(len(slot), bool)
        new[1:] = (label[1:] != label[:-1]).any(axis=1)
        start = np.flatnonzero(new)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        now = {c: (np.minimum if c == "least" else np.add).reduceat(item[c][order], start) for c in SUMS}
        now |= {"row": row[order][start], "slot": slot[start]}
        label = label[start]
        open_ = np.zeros(len(start), bool)
        for e in edges:
            if not last and r.size[e] >= d:
                on = (label == r.label[r.at[e] + d]).all(axis=1) & ~open_
                for c in SUMS:
                    if on.any():
                        known[e][c][d] = now[c][on][0]
                open_ |= on
        now["open"] = open_
        now["leaves"] = np.where(~open_ & (now["kids"] == 0), 1, now["leaves"])
        now["saved"] = now["saved"] + np.where(open_, 0, (now["members"] - 1) * r.words[now["slot"]])
        if n_left:
            up = group[:n_left]
            for pend in (False, True):
                pick = np.flatnonzero(~left["open"] & (open_[up] == pend))
                if len(pick):
                    yield emit(left, pick, d + 1, now["least"][up[pick]], label[up[pick]] if pend else None)
        if leaf_level:
            now["sha"] = np.full(len(start), no_sha, object)
            of = group[n_left:]
            cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])) if len(of) else []
            for a, b in zip(cut, cut[1:], strict=False):
                ids = r.first[rows[a:b]]
                text = ",".join(map(str, ids.tolist()))
                if open_[of[a]]:
                    yield _batch(
                        "ends", 1, {"label": _binary(label[of[a] : of[a] + 1]), "first": ids[:1], "ids": [text]}
                    )
                else:
                    now["sha"][of[a]] = hashlib.sha256(text.encode()).hexdigest()
        left = now
    if last:
        yield emit(left, np.arange(len(left["row"])), 0, None, None)
        return
    for e in edges:
        turns = slice(r.at[e] + 1, r.at[e] + r.size[e] + 1)
        yield _batch(
            "open",
            1,
            {"first": r.first[e : e + 1], "keys": [[k.tobytes() for k in r.key[turns]]], "words": [r.words[turns].tolist()]}
            | {c: [known[e][c].tolist()] for c in SUMS},
        )


def _peeled(rows: DataFrame, leaf_level: bool, last: bool) -> DataFrame:
    """The written result of peeling each partition of ``rows``, sorted by path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from _peel(_Range(held, leaf_level), leaf_level, last)

    spark = rows.sparkSession
    path = workspace(spark, "trie")
    rows.sortWithinPartitions("keys", "first").mapInArrow(run, OUT).write.partitionBy("kind").parquet(path)
    return spark.read.schema(OUT).parquet(path)


def _hashed(ends: DataFrame) -> DataFrame:
    """(label, ends_sha256) over the pieces of each label in order, one piece at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, sha, comma = None, None, b""

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"label": pa.array([label], pa.binary()), "ends_sha256": [sha.hexdigest()]})

        for batch in batches:
            for name, ids in zip(batch.column("label"), batch.column("ids"), strict=True):
                if name.as_py() != label:
                    if sha is not None:
                        yield done()
                    label, sha, comma = name.as_py(), hashlib.sha256(), b""
                sha.update(comma + ids.as_py().encode())
                comma = b","
        if sha is not None:
            yield done()

    pieces = ends.select("label", "first", "ids").repartition("label").sortWithinPartitions("label", "first")
    return pieces.mapInArrow(run, "label BINARY, ends_sha256 STRING")


def nodes(rows: DataFrame, turns: int = TURNS, last_entries: int = LAST_ENTRIES) -> DataFrame:
    """The nodes of the trie over ``rows`` as ``paths`` gives them: depth, conv_id (smallest
    member), parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (of the subtree),
    ends_sha256 (of the ids that end in the node), turn_md5 (of the last turn)."""
    spark = rows.sparkSession
    # Written, as the ranges' bounds are sampled from them first.
    rows = stored(rows.select(F.col("conv_id").alias("first"), "keys", "words"), "paths")
    total = rows.agg(F.sum(F.size("keys") + 1)).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // turns + 1)
    level = _peeled(rows.repartitionByRange(ranges, "keys", "first"), True, False)
    of_kind: Callable[[DataFrame, str], DataFrame] = lambda df, kind: df.where(F.col("kind") == kind)
    done, sha = of_kind(level, "node").select("parent_label", *NODE), _hashed(of_kind(level, "ends"))
    once_open = None
    while True:
        paths_left = of_kind(level, "open").select("first", "keys", "words", *SUMS)
        entries = paths_left.agg(F.sum(F.size("members"))).first()[0] or 0
        last = entries <= last_entries
        # Each level leaves two paths for some hundreds of rows.
        level = _peeled(
            paths_left.repartition(1) if last else paths_left.repartitionByRange(entries // last_entries + 1, "keys", "first"),
            False,
            last,
        )
        found = of_kind(level, "node").select("label", "parent_label", *NODE)
        once_open = found if once_open is None else once_open.unionByName(found)
        if last:
            break
    no_sha = hashlib.sha256(b"").hexdigest()
    once_open = stored(
        once_open.drop("ends_sha256").join(sha, "label", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(no_sha))),
        "once-open",
    )
    ids = once_open.select(F.col("label").alias("parent_label"), F.col("conv_id").alias("parent_conv_id"))
    every = done.unionByName(once_open.drop("label"))
    # Most nodes know their parent; only the others meet a join.
    pending = every.where(F.col("parent_label").isNotNull()).drop("parent_conv_id").join(ids, "parent_label", "left")
    return every.where(F.col("parent_label").isNull()).select(*NODE).unionByName(pending.select(*NODE))
