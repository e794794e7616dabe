"""CSV with newlines in quotes, and arrays of JSON, read by many tasks for each file.

Spark reads such a file in one task, as a range of it does not tell whether it begins inside a
quoted text, or how deep in an array. Here the file is read twice as plain text, in Spark's
ranges. ``_Format.sep`` ends its pieces: the newline for CSV, the closing brace for JSON, so a
record's end is a piece's end. A piece maps the state before it, (inside quotes, depth), to the
state after it: it may turn the first, and adds to the depth what depends on the first.

Pass one composes the maps of all pieces of a range into one row for each range; a file of one
range needs none, and is not opened for it where its name or size shows that it is one. A running composition over the ranges of a file gives the state in which each
one begins. Pass two cuts each range into records, starting from that state, and hands them to ``from_csv`` or
``from_json``. Parts of records that cross a range's border, two for each range at most, are put
together by a shuffle of their own; nothing else is shuffled.

What is broadcast has one entry for each such range, that is for each ``maxPartitionBytes`` of
input at most.
Both passes must see the same ranges: a range that pass one did not see stops the read.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ludomart.sources.readers import json_columns, json_raw, named_columns

# The code for the workers travels by value, as they may lack the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class _Format:
    """``maps`` gives, for pieces, whether each turns the quote state, and what it adds to the
    depth if it begins outside and inside quotes. ``nested``: records end at depth 1 in a file
    that begins with a bracket; else at depth 0. ``clean`` makes a record of joined pieces."""

    sep: str
    maps: Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]
    nested: bool
    clean: Callable[[Column], Column]


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and where each value begins."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def _csv_maps(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw, at = _bytes(column)
    none = np.zeros(len(column), np.int64)
    # A doubled quote turns the state twice, so counting is enough.
    before = np.searchsorted(np.flatnonzero(raw == 0x22), at)
    return np.diff(before) % 2 == 1, none, none


# What a byte means to the scanner of JSON.
_QUOTE, _SLASH, _OPEN, _CLOSE = 1, 2, 3, 4
_MEANS = np.zeros(256, np.uint8)
_MEANS[[0x22, 0x5C]] = _QUOTE, _SLASH
_MEANS[[0x5B, 0x7B]] = _OPEN
_MEANS[[0x5D, 0x7D]] = _CLOSE


def _json_maps(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw, at = _bytes(column)
    means = _MEANS[raw]
    place = np.flatnonzero(means)
    means = means[place]
    quote = means == _QUOTE
    slash = np.flatnonzero(means == _SLASH)
    if len(slash):
        # In a row of backslashes every second one escapes; an escape never crosses a piece,
        # as a backslash cannot stand before a brace.
        head = np.ones(len(slash), bool)
        head[1:] = np.diff(place[slash]) > 1
        nth = np.arange(len(slash))
        escapes = slash[(nth - np.maximum.accumulate(np.where(head, nth, 0))) % 2 == 0]
        after = escapes[escapes + 1 < len(place)]
        after = after[place[after + 1] == place[after] + 1] + 1
        quote[after] = False
    begin = np.searchsorted(place, at)
    total = np.concatenate([[0], np.cumsum(quote)])
    inside = (total[:-1] - np.repeat(total[begin[:-1]], np.diff(begin))) % 2 == 1
    step = (means == _OPEN).astype(np.int64) - (means == _CLOSE)

    def summed(steps: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(steps)])
        return sums[begin[1:]] - sums[begin[:-1]]

    flip = (total[begin[1:]] - total[begin[:-1]]) % 2 == 1
    # The brace that ends the piece counts where it stands outside.
    return flip, summed(step * ~inside) - ~flip, summed(step * inside) - flip


_CSV = _Format("\n", _csv_maps, False, lambda text: F.regexp_replace(text, r"\r$", ""))
_JSON = _Format("}", _json_maps, True, lambda text: F.concat(F.ltrim(text, F.lit("\ufeff \t\r\n[,")), F.lit("}")))


# Endings of compressed text that Hadoop cannot read from the middle.
_ONE_RANGE = r"\.(gz|deflate|snappy|lz4|zst)$"


def _pieces(spark: SparkSession, path: str, form: _Format, recursive: bool, cut: bool = False) -> DataFrame:
    """Pieces of all files, or with ``cut`` of those that have several ranges. Spark leaves a file
    whole that is small, or has one of the endings; a condition on name and size alone keeps it
    from being opened."""
    text = spark.read.option("lineSep", form.sep).option("recursiveFileLookup", recursive).text(path)
    meta = F.col("_metadata")
    if cut:
        conf = spark._jsparkSession.sessionState().conf()
        least = min(conf.filesMaxPartitionBytes(), conf.filesOpenCostInBytes())
        text = text.where((meta["file_size"] > least) & ~meta["file_name"].rlike(_ONE_RANGE))
    start = meta["file_block_start"]
    whole = (start == 0) & (meta["file_block_length"] >= meta["file_size"])
    rows = text.select(meta["file_path"].alias("file"), start.alias("start"), whole.alias("whole"), "value")
    return rows.where("NOT whole") if cut else rows


def _by_range(batch: pa.RecordBatch) -> Iterator[tuple[str, int, bool, pa.Array]]:
    """The stretches of a batch that belong to one range: file, start, whether the range is the
    whole file, pieces."""
    files, starts = batch.column("file").dictionary_encode(), batch.column("start").to_numpy()
    code = files.indices.to_numpy()
    cut = np.flatnonzero((code[1:] != code[:-1]) | (starts[1:] != starts[:-1])) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows], strict=True):
        if b > a:
            file, whole = files.dictionary[int(code[a])].as_py(), batch.column("whole")[a].as_py()
            yield file, int(starts[a]), whole, batch.column("value").slice(a, b - a)


def _level(form: _Format, first: str) -> int:
    return int(form.nested and first.lstrip("\ufeff \t\r\n").startswith("["))


def _states(pieces: DataFrame, form: _Format) -> dict[str, dict[int, tuple[bool, int, int]]]:
    """Pass one, over the pieces of files of several ranges: {file: {start of a range: (inside quotes,
    depth, depth at which records end)}}."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list] = {}
        for batch in batches:
            for file, start, _, values in _by_range(batch):
                flip, outside, inside = form.maps(values)
                odd = (np.cumsum(flip) - flip) % 2 == 1
                own = int(np.where(odd, inside, outside).sum()), int(np.where(odd, outside, inside).sum())
                if (file, start) not in held:
                    held[file, start] = [False, 0, 0, _level(form, values[0].as_py()) if start == 0 else 0]
                row = held[file, start]
                row[1] += own[row[0]]
                row[2] += own[not row[0]]
                row[0] ^= bool(flip.sum() % 2)
        if held:
            names = ("flip", "outside", "inside", "level")
            columns = dict(zip(names, map(list, zip(*held.values(), strict=True)), strict=True))
            yield pa.RecordBatch.from_pydict(
                {"file": [f for f, _ in held], "start": pa.array([s for _, s in held], pa.int64())} | columns
            )

    ranges = pieces.mapInArrow(
        run, "file STRING, start LONG, flip BOOLEAN, outside LONG, inside LONG, level LONG"
    )
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(F.col("flip").cast("int")).over(before), F.lit(0)) % 2 == 1
    ranges = ranges.withColumn("quoted", turned).withColumn("add", F.when(F.col("quoted"), F.col("inside")).otherwise(F.col("outside")))
    rows = ranges.select(
        "file",
        "start",
        "quoted",
        F.coalesce(F.sum("add").over(before), F.lit(0)).alias("depth"),
        F.max("level").over(Window.partitionBy("file")).alias("level"),
        (F.col("quoted") != F.col("flip")).alias("quoted_after"),
        F.lead("start").over(order).isNull().alias("last"),
    ).toArrow()
    out: dict[str, dict[int, tuple[bool, int, int]]] = {}
    for r in rows.to_pylist():
        if r["last"] and r["quoted_after"]:
            raise ValueError(f"quotes of {r['file']} do not pair")
        out.setdefault(r["file"], {})[r["start"]] = (r["quoted"], r["depth"], r["level"])
    return out


_PARTS = "file STRING, value STRING, first BOOLEAN, start LONG, piece INT, opens BOOLEAN, closes BOOLEAN"


def _cutter(form: _Format, states, parts: bool, columns: tuple[str, ...] = ("file", "value", "first")) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pass two: ``columns`` of the whole records of ranges, or with ``parts`` what ranges
    hold of records that cross a border: part 0 or 1 of the range, and whether the record opens
    or closes there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_, held, seen = None, False, [], False
        out: list[tuple] = []

        def part(piece: int, opens: bool, closes: bool):
            if parts:
                out.append((now[0], form.sep.join(held), now[1] == 0 and not seen and opens, now[1], piece, opens, closes))
            held.clear()

        def ended():
            """The end of a range: what is left of its last record, or of one all through it."""
            if now is not None and now[2] and quoted:
                raise ValueError(f"quotes of {now[0]} do not pair")
            if now is not None and held:
                part(0 if open_ else 1, not open_, False)

        def made(file: str | None, values: pa.Array, first: bool) -> pa.RecordBatch:
            made = {"value": values}
            if "file" in columns:
                made["file"] = pa.repeat(pa.scalar(file, pa.string()), len(values))
            if "first" in columns:
                made["first"] = pa.repeat(pa.scalar(first), len(values))
            return pa.RecordBatch.from_arrays([made[c] for c in columns], names=list(columns))

        def crossing() -> pa.RecordBatch:
            names = ["file", "value", "first", "start", "piece", "opens", "closes"]
            kinds = [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()]
            columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for file, start, whole, values in _by_range(batch):
                if now != (file, start, whole):
                    ended()
                    now, held, seen, open_ = (file, start, whole), [], False, False
                    if whole:
                        quoted, depth, level = False, 0, _level(form, values[0].as_py())
                    elif start in states.value.get(file, {}):
                        quoted, depth, level = states.value[file][start]
                        open_ = start > 0 and (quoted or depth != level)
                    else:
                        raise RuntimeError(f"{file} was planned in other ranges than it is read in; read it again")
                flip, outside, inside = form.maps(values)
                after = (np.cumsum(flip) + quoted) % 2 == 1
                deep = depth + np.cumsum(np.where(after ^ flip, inside, outside))
                ends = np.flatnonzero(~after & (deep == level)) + 1
                quoted, depth = bool(after[-1]), int(deep[-1])
                begin = 0
                if len(ends) and (open_ or held):
                    held += values.slice(0, int(ends[0])).to_pylist()
                    if open_:
                        part(0, False, True)
                    else:
                        joined = pa.array([form.sep.join(held)])
                        held = []
                        if not parts:
                            yield made(file, joined, start == 0 and not seen)
                        seen = True
                    open_ = False
                    begin, ends = int(ends[0]), ends[1:]
                if len(ends):
                    starts = np.concatenate([[begin], ends[:-1]])
                    one = ends - starts == 1
                    # Empty lines between records are none.
                    alone = values.take(pa.array(starts[one]))
                    filled = ~np.isin(starts, starts[one][pc.is_in(alone, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)])
                    starts, stops, one = starts[filled], ends[filled], one[filled]
                    if start == 0 and not seen and len(starts):
                        if not parts:
                            yield made(file, pa.array([form.sep.join(values.slice(starts[0], stops[0] - starts[0]).to_pylist())]), True)
                        seen = True
                        starts, stops, one = starts[1:], stops[1:], one[1:]
                    if not parts and len(starts):
                        yield made(file, values.take(pa.array(starts[one])), False)
                        if not one.all():
                            texts = values.to_pylist()
                            more = [form.sep.join(texts[a:b]) for a, b in zip(starts[~one].tolist(), stops[~one].tolist(), strict=True)]
                            yield made(file, pa.array(more, pa.string()), False)
                    begin = int(ends[-1])
                # One text in place of many, for a record over many batches.
                rest = [*held, *values.slice(begin).to_pylist()]
                held = [form.sep.join(rest)] if rest else []
            if parts:
                yield crossing()
        ended()
        if parts:
            yield crossing()

    return run


def _records(spark: SparkSession, path: str, form: _Format, recursive: bool, *columns: str) -> DataFrame:
    """Of every record its text, ``value``, and those of ``file`` and ``first`` (true for a file's
    first record) that are in ``columns``."""
    cut = _pieces(spark, path, form, recursive, cut=True)
    planned = _states(cut, form)
    states = spark.sparkContext.broadcast(planned)
    names = ("value", *columns)
    kinds = {"value": "STRING", "file": "STRING", "first": "BOOLEAN"}
    schema = ", ".join(f"{c} {kinds[c]}" for c in names)
    records = _pieces(spark, path, form, recursive).mapInArrow(_cutter(form, states, False, names), schema)
    if planned:  # else no file has a border
        # Written to no table: a task that runs again reads the same range and cuts it alike.
        parts = cut.mapInArrow(_cutter(form, states, True), _PARTS)
        order = Window.partitionBy("file").orderBy("start", "piece")
        joined = (
            parts.withColumn("record", F.sum(F.col("opens").cast("int")).over(order))
            .groupBy("file", "record")
            .agg(
                F.sort_array(F.collect_list(F.struct("start", "piece", "value"))).alias("all"),
                F.bool_or("first").alias("first"),
                F.bool_or("closes").alias("closed"),
            )
            .where("closed")  # else what follows the last record of a file
            .select("file", F.array_join("all.value", form.sep).alias("value"), "first")
        )
        records = records.unionByName(joined.select(*names))
    return records.withColumn("value", form.clean(F.col("value")))


def read_csv_split(
    spark: SparkSession, path: str, schema: str, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """What ``read_csv`` gives, each file read by as many tasks as it has ranges.

    Quotes stand around a field or are doubled within one; a file whose quotes do not pair
    stops the read, as does one whose header differs. Records end with a newline, or with
    carriage return and newline; files with bare carriage returns are for ``read_csv``.
    """
    options = {"escape": '"', "multiLine": "true"}
    names = spark.read.csv(path, header=True, **options).columns
    fields = ", ".join(f"c{i} STRING" for i in range(len(names)))
    records = _records(spark, path, _CSV, False, "file", "first")
    row = F.from_csv("value", fields, options)
    rows = records.select("file", "first", F.explode(F.array(row)).alias("row"))
    cells = F.array(*[F.lower(F.coalesce(F.col(f"row.c{i}"), F.lit(f"_c{i}"))) for i in range(len(names))])
    header = F.array(*[F.lit(n.lower()) for n in names])
    stop = F.raise_error(F.concat(F.lit("another header in "), F.col("file")))
    rows = rows.where(~F.col("first") | F.when(cells == header, F.lit(False)).otherwise(stop.cast("boolean")))
    text = rows.select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)])
    return named_columns(text, schema, aliases)


def read_json_split(
    spark: SparkSession, path: str, schema: str, recursive: bool = False, file: str | None = None
) -> DataFrame:
    """What ``read_json_arrays`` gives, each file read by as many tasks as it has ranges.

    A file holds an array of objects, one object, or objects one after the other. An object
    that cannot be read is a row of NULLs. ``file`` names a column for the file's path.
    """
    records = _records(spark, path, _JSON, recursive, *(["file"] if file else []))
    kept = [F.col("file").alias(file)] if file else []
    # A record is parsed once: a filter on its fields cannot be pushed below a generator.
    parsed = records.withColumn("row", F.explode(F.array(F.from_json("value", json_raw(schema)))))
    return parsed.select(*json_columns(schema, "row"), *kept)


def read_json_objects(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(file, value): the text of every object of such files, for payloads whose fields are
    not known ahead."""
    return _records(spark, path, _JSON, recursive, "file").select("file", "value")
