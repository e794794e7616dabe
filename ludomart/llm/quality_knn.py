"""Quality by votes of the nearest labelled texts in a latent-semantic space.

A text is a row of a term matrix: counts of its byte trigrams (hashed into ``TERMS`` columns),
and marks for its style (how its words repeat, how much of it is capitals, digits or signs, and
so on, each in bins). Counts are damped and weighted by how rare a term is; the truncated
singular value decomposition of the labelled sample gives the latent axes. Each text is compared
with every labelled vector by exact cosine products, block by block, and the ``k`` nearest vote
with their similarity as weight.

The labelled sample is bounded by ``sample_rows`` (lowest md5 of seed and id, so that the choice
does not hang on the layout), and so is what is sent to the tasks: ``sample_rows`` vectors of
``dims`` numbers, and the axes.

Defined results: a null or empty text is the empty row, which is compared like any other;
repeated rows are scored each for itself; rows without a label and labels without a row teach
nothing; with no labels at all the score is 0.5; cosines are in double precision, rounded to 12
places, and ties between neighbours go to the earlier id, as text;
other columns pass through and a column named as a new one is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from ludomart.llm.common import share, shared, with_columns
from ludomart.llm.words import SPACE, bytes_of, words

TERMS = 4096
STYLES, BINS = 8, 8
SAMPLE_ROWS = 4_000
DIMS = 64
NEIGHBOURS = 15
BLOCK_ROWS = 256
STYLE_WEIGHT = 0.35


def counts(texts: pa.Array) -> np.ndarray:
    """(rows, TERMS) counts of hashed byte trigrams, at most 65,535 each."""
    raw, at = bytes_of(texts)
    n = len(at) - 1
    if len(raw) < 3:
        return np.zeros((n, TERMS), np.uint16)
    b = raw.astype(np.uint32)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    code = (code * np.uint32(2654435761)) >> np.uint32(20)
    row = np.repeat(np.arange(n), np.diff(at))
    inside = row[:-2] == row[2:]
    cell = row[:-2][inside] * TERMS + code[inside]
    return np.minimum(np.bincount(cell, minlength=n * TERMS), 65_535).astype(np.uint16).reshape(n, TERMS)


def styles(texts: pa.Array) -> np.ndarray:
    """(rows, STYLES) bins of shares of a text."""
    raw, at = bytes_of(texts)
    n = len(at) - 1
    size = np.maximum(np.diff(at), 1)
    h, first = words(texts, SPACE)
    count = np.diff(first)
    row = np.repeat(np.arange(n), count)
    order = np.lexsort((h, row))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct = np.bincount(row[order][new], minlength=n)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    runs = np.bincount(row[again], minlength=n)
    owner = np.repeat(np.arange(n), np.diff(at))

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner[mask], minlength=n) / size

    upper = share((raw >= 0x41) & (raw <= 0x5A))
    digit = share((raw >= 0x30) & (raw <= 0x39))
    space = share((raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D)))
    line = share(raw == 0x0A)
    word = (raw >= 0x80) | ((raw >= 0x41) & (raw <= 0x5A)) | ((raw >= 0x61) & (raw <= 0x7A))
    sign = 1 - share(word) - digit - space
    few = np.maximum(count, 1)
    # Distinct words fall with length, so the share is taken of a power of it.
    values = [
        distinct / few**0.9, runs / few, upper, digit, sign, space, line * 10, np.log1p(count) / 10,
    ]
    scale = [1.6, 1.0, 1.0, 1.0, 1.5, 2.5, 1.0, 1.0]
    return np.stack(
        [np.clip(np.sqrt(np.clip(v * s, 0, 1)) * BINS, 0, BINS - 1).astype(np.int64) for v, s in zip(values, scale, strict=True)], 1
    )


def matrix(count: np.ndarray, style: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of weighted terms and styles, each part of a fixed length."""
    x = np.log1p(count.astype(np.float32)) * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    s = np.zeros((len(x), STYLES * BINS), np.float32)
    for j in range(STYLES):
        # A bin shares half of itself with its neighbours, so that close values are close.
        for d, w in ((0, 1.0), (-1, 0.5), (1, 0.5)):
            to = style[:, j] + d
            ok = (to >= 0) & (to < BINS)
            s[np.flatnonzero(ok), j * BINS + to[ok]] = w
    return np.concatenate([x, s * STYLE_WEIGHT], 1)


class Model:
    """Latent axes, labelled vectors and their labels."""

    def __init__(self, count: np.ndarray, style: np.ndarray, label: np.ndarray, dims: int, k: int, seed: int) -> None:
        self.k = min(k, len(label))
        self.label = label.astype(np.float32)
        seen = (count > 0).sum(0)
        self.idf = np.log((1 + len(label)) / (1 + seen)).astype(np.float32) + 0.1
        x = matrix(count, style, self.idf)
        # Subspace iteration from a seeded start.
        rng = np.random.default_rng(seed)
        dims = max(1, min(dims, *x.shape))
        q = rng.standard_normal((x.shape[1], min(dims + 16, x.shape[1]))).astype(np.float32)
        for _ in range(4):
            q, _ = np.linalg.qr(x.T @ (x @ q))
        _, _, v = np.linalg.svd(x @ q, full_matrices=False)
        self.axes = np.ascontiguousarray((q @ v.T)[:, :dims], np.float64)
        self.vectors = self.project(x)

    def project(self, x: np.ndarray) -> np.ndarray:
        z = x.astype(np.float64) @ self.axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, texts: pa.Array) -> np.ndarray:
        out = []
        for lo in range(0, len(texts), BLOCK_ROWS):
            part = texts.slice(lo, BLOCK_ROWS)
            z = self.project(matrix(counts(part), styles(part), self.idf))
            # The last bits of a product hang on the shape of the block.
            sim = np.round(z @ self.vectors.T, 12)
            last = np.partition(sim, -self.k, axis=1)[:, -self.k, None]
            above, tied = sim > last, sim == last
            # Of neighbours as far as the last one, the earlier ones.
            above |= tied & (np.cumsum(tied, 1) <= self.k - above.sum(1, keepdims=True))
            near = np.nonzero(above)[1].reshape(len(sim), self.k)
            weight = np.clip(np.take_along_axis(sim, near, 1), 1e-6, None) ** 4
            out.append((weight * self.label[near]).sum(1) / weight.sum(1))
        return np.concatenate(out) if out else np.empty(0)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    dims: int = DIMS,
    k: int = NEIGHBOURS,
    seed: int = 9,
) -> Model | None:
    """A model of at most ``sample_rows`` of the labelled rows given; None without any."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_id").cast("string")))
    ids = (
        labels.where(F.col(label).isNotNull() & F.col(f"`{key}`").isNotNull())
        .groupBy(F.col(f"`{key}`").alias("_id"))
        .agg(F.max(label).cast("int").alias("_label"))
        .orderBy(order, "_id")
        .limit(sample_rows)
    )
    own = docs.select(F.col(f"`{key}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    sample = own.join(F.broadcast(ids), "_id").dropDuplicates(["_id"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                c, s = counts(part.column("_text")), styles(part.column("_text")).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id").cast(pa.string()),
                        part.column("_label"),
                        pa.array([r.tobytes() for r in c], pa.binary()),
                        pa.array([r.tobytes() for r in s], pa.binary()),
                    ],
                    names=["id", "y", "c", "s"],
                )

    rows = sample.mapInArrow(features, "id string, y int, c binary, s binary").toArrow().sort_by("id")
    if not rows.num_rows:
        return None
    c = np.stack([np.frombuffer(x.as_py(), np.uint16) for x in rows.column("c")])
    s = np.stack([np.frombuffer(x.as_py(), np.uint8) for x in rows.column("s")]).astype(np.int64)
    return Model(c, s, rows.column("y").to_numpy(), dims, k, seed)


FIELDS = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or their columns ``keep``) with score and predicted."""
    sent = share(docs.sparkSession, model)

    def make() -> Callable[[pa.RecordBatch], dict[str, pa.Array]]:
        own = shared(sent)

        def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
            p = np.full(part.num_rows, 0.5) if own is None else own.score(part.column(text))
            p = np.clip(p, 0.0, 1.0)
            return {"score": pa.array(p, pa.float64()), "predicted": pa.array((p >= 0.5).astype(np.int32))}

        return work

    return with_columns(docs, text, FIELDS, make, keep)
