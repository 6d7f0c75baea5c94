"""Mixing sources to target weights: hierarchical budgets over domain, language and source, in DataFrame operations.

The budget goes down the tree. At a node it is shared over the children by weight; a child that can give less than its
share (its tokens times MAX_EPOCHS, or the sum of its children) gives all, and the shortage goes to its siblings by
weight. What a whole node lacks, its capacity shows one level up, where its own siblings take it: siblings before
ancestors. All amounts are integers; the tokens left by rounding go one each to the first children by name.

A leaf with a target of k times its tokens and a rest takes every document k times (k epochs), and from the next epoch,
in the order of md5(seed:epoch:doc_id), the shortest prefix that reaches the rest. Prefix sums are taken over BUCKETS
ranges of the hash and then inside the one range that holds the cut, so no task gets a whole leaf.

Defined cases: null domain, language or source are the leaf of the empty name. A document without words has no tokens
and is not selected. A null doc_id counts as an empty one. Repeated rows are separate supply with equal places in the
order; ``mix`` gives each the larger number of copies. An empty table selects nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowloom.llm.common import packed, staged, unpacked, words_of

MAX_EPOCHS = 2
BUCKET_DIGITS = 3  # hexadecimal digits: 4096 ranges
LEVELS = ("domain", "lang", "source")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    """The whole-number weight of a node among its siblings; 1 where none is given."""
    given = weights.get(level) or {}
    if not given:
        return F.lit(1).cast("long")
    table = F.create_map(*[F.lit(x) for pair in given.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.col(level)), F.lit(1)).cast("long")


def shared_out(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """``budget`` of the parent (a column of each child) shared over the children by ``weight`` up to ``capacity``."""
    group = W.partitionBy(*parents) if parents else W.partitionBy(F.lit(0))
    order = group.orderBy(F.col("capacity") / F.col("weight"), name)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    # Tokens times weights exceed a long in large corpora.
    wide = lambda c: c.cast("decimal(38,0)")
    full = wide(F.col("capacity")) * weight_left <= wide(F.col("budget") - before) * F.col("weight")
    df = children.withColumn("full", full)
    df = df.withColumn("rest", F.col("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(group))
    df = df.withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(group))
    df = df.withColumn("target", F.when(F.col("full"), F.col("capacity")).otherwise(F.expr("(cast(rest as decimal(38,0)) * weight) div open")))
    spare = F.col("rest") - F.sum(F.when(~F.col("full"), F.col("target")).otherwise(0)).over(group)
    place = F.row_number().over(W.partitionBy(*parents, "full").orderBy(name))
    df = df.withColumn("spare", spare).withColumn("place", place)
    extra = F.when(~F.col("full") & (F.col("place") <= F.col("spare")), 1).otherwise(0)
    return df.withColumn("target", F.col("target") + extra).drop("full", "rest", "open", "spare", "place", "budget", "weight", "total")


def targets(leaves: DataFrame, weights: dict[str, dict[str, int]], percent: int, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, target): each leaf's part of ``percent`` of all tokens."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    everything = W.partitionBy(F.lit(0))
    nodes = leaves.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
    nodes = nodes.withColumn("total", F.sum("tokens").over(everything)).withColumn("budget", F.expr(f"(total * {int(percent)}) div 100"))
    nodes = shared_out(nodes.withColumn("weight", _weight("domain", weights)), [], "domain")
    for depth in (1, 2):
        up, name = list(LEVELS[:depth]), LEVELS[depth]
        keys = [*up, name]
        below = leaves.groupBy(*keys).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        below = below.join(nodes.select(*up, F.col("target").alias("budget")), up).withColumn("weight", _weight(name, weights))
        nodes = shared_out(below, up, name)
    return nodes.select(*LEVELS, "tokens", "target")


def selection(
    docs: DataFrame, weights: dict[str, dict[str, int]], domain: Column, percent: int = 100, seed: str = "mix", max_epochs: int = MAX_EPOCHS,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, copies) of the documents selected; ``domain`` is over ``docs``."""
    if percent < 0 or any(w <= 0 for level in weights.values() for w in level.values()):
        raise ValueError("percent is not negative and weights are positive whole numbers")
    text_of = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text_of(domain).alias("domain"), text_of(F.col(lang_col)).alias("lang"),
        text_of(F.col(source_col)).alias("source"), F.size(words_of(F.col(text_col))).cast("long").alias("n_tokens"),
    )
    rows = staged(rows.where("n_tokens > 0"), "tokens")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    plan = targets(leaves, weights, percent, max_epochs)
    plan = staged(plan.select(*LEVELS, F.expr("target div tokens").alias("epochs"), F.expr("target % tokens").alias("cut")), "targets")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("epochs").cast("string"), text_of(F.col("doc_id"))).cast("binary"))
    rows = rows.join(plan, list(LEVELS)).withColumn("place", key).withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    sums = rows.groupBy(*LEVELS, "bucket", "cut").agg(F.sum("n_tokens").alias("held"))
    running = W.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("held").over(running), F.lit(0)))
    rows = rows.join(sums.select(*LEVELS, "bucket", "held", "before"), [*LEVELS, "bucket"])
    split = (F.col("before") < F.col("cut")) & (F.col("before") + F.col("held") > F.col("cut"))
    names = ["doc_id", *LEVELS, "n_tokens", "copies"]
    whole = rows.where(~split).withColumn("copies", F.col("epochs") + F.when(F.col("before") < F.col("cut"), 1).otherwise(0))
    inside = W.partitionBy(*LEVELS).orderBy("place", "n_tokens").rowsBetween(W.unboundedPreceding, -1)
    partial = rows.where(split).withColumn("start", F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    partial = partial.withColumn("copies", F.col("epochs") + F.when(F.col("start") < F.col("cut"), 1).otherwise(0))
    return whole.select(*names).union(partial.select(*names)).where("copies > 0")


def mix(docs: DataFrame, weights: dict[str, dict[str, int]], domain: Column, id_col: str = "doc_id", **options) -> DataFrame:
    """The selected rows of ``docs`` with ``n_tokens`` and ``copies``."""
    chosen = selection(docs, weights, domain, id_col=id_col, **options)
    chosen = chosen.groupBy(F.col("doc_id").alias("chosen_id")).agg(F.max("n_tokens").alias("n_tokens"), F.max("copies").alias("copies"))
    rows = packed(docs, id=id_col)
    joined = rows.join(chosen, rows.id.eqNullSafe(chosen.chosen_id))
    return unpacked(joined, {"n_tokens": F.col("n_tokens"), "copies": F.col("copies")})
