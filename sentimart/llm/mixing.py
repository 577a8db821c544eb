"""Mixing sources to target weights by hierarchical budgeting.

Everything is DataFrame operations.  A token budget runs down the tree
domain - language - source: at each node it is shared among the children
by weight, no child above what its subtree can supply, and what a scarce
child cannot take goes to its siblings; only what a whole subtree cannot
take goes to the siblings of an ancestor.  A leaf then repeats its
documents in whole epochs and fills the rest with a token prefix of one
more epoch in seeded order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, stored

LEVELS = ("domain", "lang", "source")
#: hex digits of the order key that make a bucket (16 bits)
_BUCKET_DIGITS = 4


def _weight(column: str, weights: Mapping[str, int], default: int) -> Column:
    if not weights:
        return F.lit(default).cast("long")
    table = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.col(column)), F.lit(default)).cast("long")


def token_count(text: Column) -> Column:
    """Words (runs without ASCII white space) of a text; null: 0."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")).cast("long")


def _share(children: DataFrame, parents: list[str], child: str) -> DataFrame:
    """Water-filling: ``children`` has the parents' columns, ``child``,
    ``supply``, ``weight`` and the parent's ``budget``; returns it with
    ``budget`` replaced by the child's.

    In order of supply per weight, (budget - supplies before) / (weights
    from here on) is the level that the rest could reach if all before were
    used up; it is largest at the first child that is not used up, so its
    maximum is the level, and a child gets the smaller of its supply and
    weight * level (rounded down)."""
    group = Window.partitionBy(*parents)
    ordered = group.orderBy(F.col("supply") / F.col("weight"), child)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.coalesce(F.sum("supply").over(before), F.lit(0))
    weights = F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    return (children.withColumn("level", left / weights)
            .withColumn("level", F.max("level").over(group))
            .withColumn("budget", F.least("supply", F.floor(F.col("weight") * F.col("level"))).cast("long"))
            .drop("level"))


def leaf_budgets(leaves: DataFrame, budget: Column, weights: Mapping[str, Mapping[str, int]],
                 default_weight: int, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) of the leaves (domain, lang,
    source, tokens), with the total ``budget`` (a column over ``tokens``,
    the sum of all)."""
    # a leaf below a node of weight 0 supplies nothing to those above it
    open_ = [_weight(name, weights.get(name, {}), default_weight) > 0 for name in LEVELS]
    supplied = leaves.withColumn("supply", F.col("tokens") * max_epochs).filter(open_[0] & open_[1] & open_[2])
    total = leaves.agg(F.sum("tokens").alias("tokens")).select(F.coalesce(budget, F.lit(0)).cast("long").alias("budget"))
    above: DataFrame | None = None
    for depth, name in enumerate(LEVELS, 1):
        keys, parents = list(LEVELS[:depth]), list(LEVELS[:depth - 1])
        nodes = supplied.groupBy(*keys).agg(F.sum("supply").alias("supply"))
        nodes = nodes.withColumn("weight", _weight(name, weights.get(name, {}), default_weight))
        if above is None:
            nodes = nodes.join(total.hint("broadcast"), how="left")      # one row
            nodes = _share(nodes.withColumn("root", F.lit(0)), ["root"], name).drop("root")
        else:
            nodes = _share(nodes.join(above, parents), parents, name)
        above = nodes.select(*keys, "budget")
    return leaves.select(*LEVELS, "tokens").join(above, list(LEVELS))


def mix(docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, int]], fraction: float = 0.5,
        max_epochs: int = 3, default_weight: int = 1, seed: int = 42, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, epoch): the documents of
    ``docs`` (doc_id, text, lang, source and what ``domain`` reads) selected
    for a corpus of ``fraction`` of all tokens whose shares follow the
    integer ``weights`` (by level and name; others ``default_weight``, 0
    leaves a node out) as far as ``max_epochs`` passes over each leaf allow.
    A document selected in several epochs has a row for each, from 1.

    A leaf's last epoch takes its documents in the order of
    md5(seed:epoch:doc_id) while their tokens fit.  Hot leaves are not
    gathered: bucket sums of the order key find where the prefix ends, and
    only the one bucket it ends in is summed row by row.

    Tokens are words; rows without tokens or with a null doc_id take no
    part; null lang, source or domain are the name ``unknown``; repeated
    rows are separate documents with one order key (a bucket, and so a task,
    holds the rows of one doc_id in a leaf, without their texts); an empty
    table gives an empty result.  The columns ``keep`` come along."""
    unknown = F.lit("unknown")
    rows = stored(
        docs.select(F.col("doc_id").cast("long"), F.coalesce(domain, unknown).alias("domain"),
                    F.coalesce("lang", unknown).alias("lang"), F.coalesce("source", unknown).alias("source"),
                    token_count(F.col("text")).alias("n_tokens"), *keep)
        .filter("n_tokens > 0 and doc_id is not null"), "tokens")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    budget = F.floor(F.col("tokens") * F.lit(fraction))
    budgets = stored(leaf_budgets(leaves, budget, weights, default_weight, max_epochs)
                     .withColumn("full", F.expr("budget div tokens"))
                     .withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens")), "budgets")
    selected = rows.join(budgets.select(*LEVELS, "full", "rest"), list(LEVELS))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("full") + 1, F.col("doc_id")).cast("binary"))
    partial = (selected.filter("rest > 0").withColumn("order_key", key)
               .withColumn("bucket", F.substring("order_key", 1, _BUCKET_DIGITS)))
    sums = partial.groupBy(*LEVELS, "rest", "bucket").agg(F.sum("n_tokens").alias("tokens"))
    upto = F.sum("tokens").over(Window.partitionBy(*LEVELS).orderBy("bucket")
                                .rowsBetween(Window.unboundedPreceding, 0))
    # the first bucket that does not fit whole; there is one, as rest < tokens
    ends = (sums.withColumn("upto", upto).filter("upto > rest").groupBy(*LEVELS)
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("tokens")).alias("before"))).alias("end")))
    placed = partial.join(stored(ends, "ends"), list(LEVELS))
    columns = ["doc_id", *LEVELS, "n_tokens", (F.col("full") + 1).cast("int").alias("epoch"), *keep]
    inside = placed.filter(F.col("bucket") < F.col("end.bucket")).select(*columns)
    running = F.sum("n_tokens").over(Window.partitionBy(*LEVELS).orderBy("order_key", "n_tokens")
                                     .rowsBetween(Window.unboundedPreceding, 0))
    edge = (placed.filter(F.col("bucket") == F.col("end.bucket")).withColumn("running", running)
            .filter(F.col("end.before") + F.col("running") <= F.col("rest")).select(*columns))
    whole = (selected.filter("full > 0")
             .select("doc_id", *LEVELS, "n_tokens", F.explode(F.sequence(F.lit(1), F.col("full").cast("int"))).alias("epoch"), *keep))
    return whole.unionByName(inside).unionByName(edge)
