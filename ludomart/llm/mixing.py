"""Mixing sources to target weights by hierarchical budgets.

Sources form a tree (domain, language, source). A budget of tokens goes down the tree by the
weights of the children; a child takes no more than its subtree can give (its tokens times the
epochs allowed), and what it leaves goes to its siblings first: a node's own budget never
exceeds what its subtree holds, so only what all siblings together cannot give had been moved
to the ancestor's other children. All shares are whole tokens, rounded down.

A leaf's budget is filled from its epochs: whole passes first, then the prefix of the next
pass, whose order is seeded. Where the prefix ends is found in two steps, so that no leaf is
sorted as a whole: tokens are summed by the first bits of the order, and only the rows of the
one cell in which the budget ends are put in order.

Defined results: null levels form a node of their own; a null text has no tokens; rows of one
id go together; an empty table, or a budget of 0, selects nothing; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludomart.llm.common import stored
from ludomart.llm.sharding import HASH_BITS, key_hash

CELL_BITS = 12
NEW = ("n_tokens", "leaf_tokens", "leaf_budget", "copies")
WORD = r"[^\x20\x09-\x0D]+"


def tokens_of(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _fill(nodes: DataFrame, parent: list[str], node: str) -> DataFrame:
    """``nodes`` (cap, weight, budget of the parent) with ``share``: weights are followed
    until a node is full; full nodes are found in order of cap over weight."""
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = group.orderBy(F.col("cap") / F.col("weight"), node)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), zero)
    weights = F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(before), zero)
    nodes = nodes.where("weight > 0").withColumn("_full", F.col("cap") * weights <= F.col("weight") * left)
    full_cap = F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(zero)).over(group)
    open_weight = F.sum(F.when(~F.col("_full"), F.col("weight")).otherwise(zero)).over(group)
    nodes = nodes.withColumns({"_rest": F.col("budget") - full_cap, "_open": open_weight})
    return nodes.withColumn(
        "share", F.when(F.col("_full"), F.col("cap")).otherwise(F.expr("weight * _rest div _open"))
    ).drop("_full", "_rest", "_open")


def budgets(
    leaves: DataFrame, levels: list[str], weights: dict[str, int], budget: int | None, share: float, epochs: int
) -> DataFrame:
    """``leaves`` (levels, tokens) with ``share``, the tokens each is to give.

    ``weights`` maps "level=value" to a whole weight, 1 where it has none. ``budget`` counts
    tokens; if it is None, it is ``share`` of all tokens.
    """
    leaves = leaves.withColumn("cap", F.col("tokens") * epochs)
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else None

    def weight(level: str) -> Column:
        if table is None:
            return F.lit(1).cast("long")
        name = F.concat(F.lit(f"{level}"), F.col(f"_{level}"))
        return F.coalesce(F.element_at(table, name), F.lit(1)).cast("long")

    total = leaves.agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("all"))
    wanted = F.lit(budget).cast("long") if budget is not None else F.floor(F.col("all") * share)
    above = total.select(F.least("cap", wanted).alias("budget"))
    keys: list[str] = []
    for level in levels:
        up, keys = keys, [*keys, f"_{level}"]
        nodes = leaves.groupBy(*keys).agg(F.sum("cap").alias("cap")).withColumn("weight", weight(level))
        # One row of the root joins all its children.
        nodes = nodes.join(above, up) if up else nodes.join(F.broadcast(above))
        above = _fill(nodes, up, keys[-1]).select(*keys, F.col("share").alias("budget"))
    return leaves.drop("cap").join(above.withColumnRenamed("budget", "share"), keys, "left").na.fill(0, ["share"])


def mix(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[str, int] | None = None,
    budget: int | None = None,
    share: float = 1.0,
    epochs: int = 1,
    seed: int = 0,
    key: str = "doc_id",
    text: str = "text",
    tokens: Column | None = None,
) -> DataFrame:
    """``docs`` with n_tokens, leaf_tokens, leaf_budget and copies: how often a row is taken.

    ``levels`` are named expressions from the root down. ``tokens`` replaces the count of
    words. The order of an epoch is md5 of seed, epoch and key.
    """
    count = tokens_of(F.col(f"`{text}`")) if tokens is None else tokens
    names = [f"_{n}" for n in levels]
    node = {f"_{n}": F.coalesce(F.concat(F.lit("="), e.cast("string")), F.lit("-")) for n, e in levels.items()}
    kept = [c for c in docs.columns if c.lower() not in NEW]
    # The columns of the documents travel as one, so that their names meet none of those below.
    docs = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"_{c}") for c in kept]).alias("_row"),
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("_key"),
        *[e.alias(n) for n, e in node.items()],
        count.alias("n_tokens"),
    )
    narrow = stored(docs.select("_key", "n_tokens", *names), "mixing")
    leaves = narrow.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    leaves = budgets(leaves, list(levels), weights or {}, budget, share, epochs)
    leaves = leaves.withColumns(
        {
            "_full": F.when(F.col("tokens") > 0, F.expr("share div tokens")).otherwise(F.lit(0)).cast("long"),
            "_rest": F.when(F.col("tokens") > 0, F.expr("share % tokens")).otherwise(F.lit(0)).cast("long"),
        }
    )
    leaves = stored(leaves, "mixing")

    def order(frame: DataFrame) -> DataFrame:
        text = F.concat_ws(":", F.lit(str(seed)), F.col("_full").cast("string"), "_key")
        frame = frame.withColumn("_h", key_hash(text))
        return frame.withColumn("_cell", F.call_function("shiftright", "_h", F.lit(HASH_BITS - CELL_BITS)))

    rows = order(narrow.join(leaves.select(*names, "_full"), names))
    cells = rows.groupBy(*names, "_cell").agg(F.sum("n_tokens").alias("_sum"))
    run = Window.partitionBy(*names).orderBy("_cell")
    cells = cells.withColumn("_upto", F.sum("_sum").over(run)).join(leaves.select(*names, "_rest"), names)
    # The first cell that goes beyond the budget.
    ends = (
        cells.where("_upto > _rest")
        .groupBy(*names)
        .agg(F.min_by(F.struct("_cell", (F.col("_rest") - F.col("_upto") + F.col("_sum")).alias("_left")), "_cell").alias("_end"))
        .select(*names, F.col("_end._cell").alias("_cell"), F.col("_end._left").alias("_left"))
    )
    last = rows.join(ends, [*names, "_cell"]).withColumn(
        "_sum", F.sum("n_tokens").over(Window.partitionBy(*names).orderBy("_h", "_key"))
    )
    cut = last.where("_sum <= _left").groupBy(*names).agg(F.max(F.struct("_h", "_key")).alias("_cut"))
    leaves = leaves.join(ends.select(*names, F.col("_cell").alias("_end")), names, "left").join(cut, names, "left")
    leaves = stored(leaves, "mixing")
    out = order(docs.join(leaves, names))
    before = F.col("_cell") < F.coalesce("_end", F.lit(1 << CELL_BITS))
    within = F.struct("_h", "_key") <= F.col("_cut")
    taken = (F.col("_rest") > 0) & (before | F.coalesce(within & (F.col("_cell") == F.col("_end")), F.lit(False)))
    out = out.withColumns(
        {
            "leaf_tokens": F.col("tokens"),
            "leaf_budget": F.col("share"),
            "copies": (F.col("_full") + F.when(taken, 1).otherwise(0)).cast("int"),
        }
    )
    own = [F.col("_row").getField(f"_{c}").alias(c) for c in kept]
    return out.select(*own, "n_tokens", "leaf_tokens", "leaf_budget", "copies")


def expand(mixed: DataFrame) -> DataFrame:
    """A row for each copy, with its epoch."""
    return mixed.where("copies > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
