"""Writers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Rows per unsplittable landing file, and the most rows and characters gathered into one
# JSON array; a row that is longer is an array of its own.
ROWS_PER_FILE = 5_000
CHARS_PER_FILE = 32 << 20
# The same for packed arrays, which take about a tenth of their characters on the disk: with
# less in a file a read opens more files than it has tasks for.
ROWS_PER_PACKED = 50_000
CHARS_PER_PACKED = 16 << 20
# For text that is written in files of bounded size, each read by one task in any case.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str], metrics: Sequence[Column] = ()
) -> dict[str, int]:
    """Overwrite a Parquet table partitioned by column; the values of ``metrics`` over it.

    Metrics are observed in the stage that writes, where each partition counts once, so that
    nothing has to be read back for them.

    ``rebalance`` brings the rows of a partition value together, so few files are
    written, but AQE splits a value that holds too many rows (a hot month, the
    games without a year) over several tasks; ``repartition`` would not.
    """
    df = df.hint("rebalance", *partition_by)
    seen = Observation()
    if metrics:
        df = df.observe(seen, *metrics)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return seen.get if metrics else {}


def write_csv(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, packed: bool = False) -> None:
    """CSV as ``read_csv`` expects it. CSV with newlines in quotes cannot be split,
    hence the bound on rows per file. ``packed`` files are gzipped."""
    writer = df.write.options(**PACKED) if packed else df.write
    writer.mode("overwrite").option("maxRecordsPerFile", rows_per_file).csv(
        path,
        header=True,
        escape='"',
        quoteAll=True,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_xml(df: DataFrame, path: str, row_tag: str, root_tag: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Gzipped XML documents as ``read_xml`` expects them. One task reads a document, hence the
    bound on its rows."""
    writer = df.write.options(**PACKED).option("maxRecordsPerFile", rows_per_file)
    writer.format("xml").option("rowTag", row_tag).option("rootTag", root_tag).save(path)


def write_json_arrays(
    df: DataFrame,
    path: str,
    rows_per_file: int | None = None,
    folder: str | None = None,
    chars_per_file: int | None = None,
    packed: bool = False,
) -> None:
    """Files with one JSON array each, of ``rows_per_file`` objects and about
    ``chars_per_file`` characters at most; below a folder for each value of the column
    ``folder``, if one is named. ``packed`` files are gzipped.

    Each task joins the rows it has, and holds about ``chars_per_file`` characters of all
    folders for files that are not full. Nothing is shuffled by a row number, which a task
    that runs again after a loss could hand out differently.
    """
    rows_per_file = rows_per_file or (ROWS_PER_PACKED if packed else ROWS_PER_FILE)
    chars_per_file = chars_per_file or (CHARS_PER_PACKED if packed else CHARS_PER_FILE)

    def arrays(texts: pa.Array, last: bool) -> tuple[pa.Array, pa.Array]:
        """The arrays that are full, or all if these are the ``last`` texts, and the texts left."""
        ends = np.cumsum(pc.utf8_length(texts).to_numpy(), dtype=np.int64)
        cuts = [0]
        while cuts[-1] < len(texts):
            lo = cuts[-1]
            most = chars_per_file + (int(ends[lo - 1]) if lo else 0)
            cuts.append(min(lo + rows_per_file, max(lo + 1, int(np.searchsorted(ends, most, side="right")))))
        # Offsets past the end end at the last row.
        offsets = np.minimum(cuts, len(texts))
        if not last:
            offsets = offsets[:-1]
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), texts), ",")
        return pc.binary_join_element_wise("[", joined, "]", ""), texts.slice(int(offsets[-1]))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By folder: texts of files that are not full, and their rows and characters.
        held: dict[str | None, tuple[list[pa.Array], int, int]] = {}

        def filled(name: str | None, last: bool) -> Iterator[pa.RecordBatch]:
            made, rest = arrays(pa.concat_arrays(held.pop(name)[0]), last)
            if len(rest):
                held[name] = [rest], len(rest), pc.sum(pc.utf8_length(rest)).as_py()
            for n in range(len(made)):
                yield pa.RecordBatch.from_arrays(
                    [made.slice(n, 1), pa.array([name], pa.string())], names=["value", "folder"]
                )

        for batch in batches:
            folders = batch.column("folder").dictionary_encode(null_encoding="encode")
            code = folders.indices.to_numpy()
            for i, name in enumerate(folders.dictionary.to_pylist()):
                texts = batch.column("value").take(pa.array(np.flatnonzero(code == i)))
                parts, rows, chars = held.get(name, ([], 0, 0))
                rows, chars = rows + len(texts), chars + pc.sum(pc.utf8_length(texts)).as_py()
                held[name] = [*parts, texts], rows, chars
                if rows > rows_per_file or chars > chars_per_file:
                    yield from filled(name, False)
            while sum(chars for _, _, chars in held.values()) > chars_per_file:
                yield from filled(max(held, key=lambda name: held[name][2]), True)
        for name in list(held):
            yield from filled(name, True)

    name = F.lit("") if folder is None else F.col(folder).cast("string")
    out = df.select(F.to_json(F.struct(*df.columns)).alias("value"), name.alias("folder"))
    out = out.mapInArrow(join, "value STRING, folder STRING")
    if folder is None:
        out = out.drop("folder")
    writer = out.write.options(**PACKED) if packed else out.write
    writer = writer.mode("overwrite").option("maxRecordsPerFile", 1)
    (writer if folder is None else writer.partitionBy("folder")).text(path)
