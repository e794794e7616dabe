"""Left lookups of dimension values into a fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    columns: Sequence[str],
    *,
    dim_key: str | None = None,
    spread_by: Sequence[str],
) -> DataFrame:
    """Add ``columns`` of ``dim`` to ``fact`` by equality on a text key.

    ``dim`` must be unique on its key, so the fact keeps its row count. No
    broadcast is forced: Spark broadcasts the dimension where its measured size
    is below the threshold, else it sorts and merges and AQE splits partitions
    that a hot key makes too large (only the fact side needs splitting). AQE
    cannot help where the exchange itself is lopsided by NULL keys of two thirds
    of the rows, and those never match, so they are given distinct made-up probe
    values from ``spread_by`` (the fact's own key). A probe that should equal a
    real key by accident is harmless: the value is cleared again.
    """
    probe = F.coalesce(
        F.col(key), F.concat(F.lit("no key "), F.xxhash64(*spread_by).cast("string"))
    )
    right = dim.select(
        F.col(dim_key or key).alias("_dim_key"), *[F.col(c).alias(f"_dim_{c}") for c in columns]
    ).filter(F.col("_dim_key").isNotNull())
    joined = fact.withColumn("_probe", probe).join(right, F.col("_probe") == F.col("_dim_key"), "left")
    return joined.select(
        *[F.col(c) for c in fact.columns],
        *[F.when(F.col(key).isNotNull(), F.col(f"_dim_{c}")).alias(c) for c in columns],
    )
