"""Mixing sources to target weights by hierarchical budgets, in SQL expressions only.

A token budget flows down the tree domain - language - source.  At every node
it is split among the children by their weights; a child that cannot use its
share (its tokens times the epochs allowed) is filled up and the rest goes to
its siblings, by weight again.  Since a node counts as able to use what its
leaves can, a shortage reaches the siblings of an ancestor only when all
siblings below are full.  All shares are integers and exact.

Each leaf then repeats its documents for the whole epochs its budget holds and
takes a prefix of one more epoch, in an order drawn from the seed and the
number of that epoch: documents as long as their running sum stays within the
budget.  The prefix is found by summing tokens per bucket of the order (256
buckets, and 256 in each), so no leaf, however large, is sorted in one task.

Tokens are words unless the caller names another measure; null and empty texts
have none, and join the prefix if they come before its end.  A null domain,
language or source is a branch of its own, with the name ''.  Rows that repeat
an id stand at one place of the order and are taken or left together.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.lookup import join_per_key
from tidemill.session import cut_lineage

LEVELS = ("domain", "language", "source")
#: A bigint of tokens and a sum of weights (below 10^18): their product is exact in the 38 digits of a decimal.
WIDE, NARROW = "cast({} as decimal(19, 0))", "cast({} as decimal(18, 0))"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _weight(name: Column, weights: Mapping[str, int], default: int) -> Column:
    if not weights:
        return F.lit(default).cast("long")
    table = F.create_map(*[F.lit(x) for item in sorted(weights.items()) for x in item])
    return F.coalesce(table[name], F.lit(default)).cast("long")


def fill(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """``nodes(.., cap, weight, budget)`` with ``alloc``: ``budget`` of the parent split among children of positive weight."""
    within = Window.partitionBy(*[F.col(p) for p in parents] or [F.lit(0)])
    order = [F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).asc_nulls_last(), F.col(name)]
    upto = within.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = within.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = within.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    weighted = F.when(F.col("weight") > 0, F.col("cap")).otherwise(0)
    rest = F.greatest(F.col("budget") - F.coalesce(F.sum(weighted).over(before), F.lit(0)), F.lit(0))
    ranked = nodes.withColumn("_k", F.row_number().over(within.orderBy(*order))).withColumn("_rest", rest).withColumn("_onward", F.sum("weight").over(onward))
    fits = F.expr(f"weight > 0 and {WIDE.format('_rest')} * {NARROW.format('weight')} <= {WIDE.format('cap')} * {NARROW.format('_onward')}")
    first = ranked.withColumn("_first", F.min(F.when(fits, F.col("_k"))).over(within))
    full = F.coalesce(F.col("_k") < F.col("_first"), F.lit(True))
    marked = first.withColumn("_full", full).withColumn("_open", F.when(F.col("_full"), 0).otherwise(F.col("weight")))
    shared = (
        marked.withColumn("_left", F.greatest(F.col("budget") - F.sum(F.when(F.col("_full"), weighted).otherwise(0)).over(within), F.lit(0)))
        .withColumn("_total", F.sum("_open").over(within))
        .withColumn("_running", F.sum("_open").over(upto))
    )
    part = "({} * {}) div _total"
    share = F.expr(f"{part.format(WIDE.format('_left'), NARROW.format('_running'))} - {part.format(WIDE.format('_left'), NARROW.format('_running - _open'))}")
    alloc = F.when(F.col("weight") <= 0, 0).when(F.col("_full"), F.col("cap")).otherwise(F.least(F.coalesce(share, F.lit(0)), F.col("cap")))
    return shared.withColumn("alloc", alloc.cast("long")).drop("_k", "_rest", "_onward", "_first", "_full", "_open", "_left", "_total", "_running")


def leaf_budgets(leaves: DataFrame, budget: Column, weights: Mapping[str, Mapping[str, int]], max_epochs: int, default: int = 1) -> DataFrame:
    """``leaves(domain, language, source, avail)`` with ``alloc``, their share of the total ``budget`` (a column over all leaves)."""
    caps = leaves.withColumn("cap", F.col("avail") * max_epochs)
    total = leaves.agg(F.coalesce(F.sum("avail"), F.lit(0)).alias("total")).select(budget.cast("long").alias("budget"))
    given = total.withColumn("_one", F.lit(1))
    parents: list[str] = []
    for level in LEVELS:
        nodes = caps.groupBy(*parents, level).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(F.col(level), weights.get(level, {}), default))
        nodes = nodes.withColumn("_one", F.lit(1)).join(given, [*parents, "_one"]).drop("_one")
        filled = fill(nodes, parents, level)
        parents = [*parents, level]
        given = filled.select(*parents, F.col("alloc").alias("budget"), F.lit(1).alias("_one"))
    return leaves.join(given.drop("_one"), list(LEVELS)).withColumnRenamed("budget", "alloc")


def mix_sources(
    docs: DataFrame,
    domain: Column,
    budget: Column,
    weights: Mapping[str, Mapping[str, int]] | None = None,
    max_epochs: int = 1,
    seed: int = 0,
    key: str = "doc_id",
    language: str = "lang",
    source: str = "source",
    text: str = "text",
    tokens: Column | None = None,
    epoch: str | None = "epoch",
) -> DataFrame:
    """The chosen rows of ``docs``, one per epoch that takes them, with the number of the epoch in ``epoch`` (None: no such column).

    ``budget`` is a column over ``total``, the tokens of all documents, such as
    ``floor(total / 2)``.  ``weights`` maps each level to integer weights by
    name; names not listed weigh 1.
    """
    as_text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    names = [as_text(domain), as_text(F.col(language)), as_text(F.col(source))]
    leaf = F.to_json(F.array(*names)).alias("_leaf")
    small = docs.select(leaf, *[n.alias(level) for n, level in zip(names, LEVELS, strict=True)], as_text(F.col(key)).alias("id"), (word_count(F.col(text)) if tokens is None else tokens).alias("tokens"))
    small = cut_lineage(small, "mix")
    leaves = small.groupBy("_leaf", *LEVELS).agg(F.sum("tokens").alias("avail"))
    plan = leaf_budgets(leaves, budget, weights or {}, max_epochs)
    plan = cut_lineage(plan.select(
        "_leaf",
        F.expr("if(avail = 0, 0, alloc div avail)").alias("whole"),
        F.expr("if(avail = 0, 0, alloc % avail)").alias("rest"),
    ), "leaves")
    place = lambda id_: F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole"), id_))
    placed = join_per_key(small.select("_leaf", "id", "tokens"), plan.where("rest > 0"), "_leaf", F.col("id")).withColumn("h", place(F.col("id")))
    placed = placed.withColumn("b1", F.substring("h", 1, 2)).withColumn("b2", F.substring("h", 3, 2))

    def boundary(sums: DataFrame, group: list[str], bucket: str) -> DataFrame:
        """The first bucket in which the running sum passes what is left, and what is left before it."""
        upto = Window.partitionBy(*group).orderBy(bucket)
        run = sums.withColumn("run", F.sum("tokens").over(upto)).where("run > rest")
        first = run.groupBy(*group).agg(F.min(F.struct(F.col(bucket), (F.col("rest") - F.col("run") + F.col("tokens")).alias("rest"))).alias("first"))
        return first.select(*group, "first.*")

    fine = cut_lineage(placed.groupBy("_leaf", "rest", "b1", "b2").agg(F.sum("tokens").alias("tokens")), "buckets")
    coarse = boundary(fine.groupBy("_leaf", "rest", "b1").agg(F.sum("tokens").alias("tokens")), ["_leaf"], "b1")
    inner = boundary(fine.drop("rest").join(coarse, ["_leaf", "b1"]), ["_leaf", "b1"], "b2")
    edge = join_per_key(
        placed.select(F.concat_ws(":", "_leaf", "b1", "b2").alias("_edge"), "_leaf", "h", "id", "tokens"),
        inner.select(F.concat_ws(":", "_leaf", "b1", "b2").alias("_edge"), "rest"),
        "_edge",
        F.col("id"),
    )
    passed = edge.withColumn("run", F.sum("tokens").over(Window.partitionBy("_leaf").orderBy("h", "id"))).where("run > rest")
    cuts = passed.groupBy("_leaf").agg(F.min(F.struct("h", "id")).alias("cut"))
    chosen = plan.join(cuts, "_leaf", "left").where("whole > 0 or rest > 0")
    kept = join_per_key(docs.withColumn("_leaf", leaf), chosen.select("_leaf", "whole", "rest", "cut"), "_leaf", as_text(F.col(key)))
    own = as_text(F.col(key))
    more = (F.col("rest") > 0) & F.coalesce(F.struct(place(own).alias("h"), own.alias("id")) < F.col("cut"), F.lit(True))
    epochs = F.col("whole") + more.cast("long")
    repeated = kept.withColumn("_epochs", epochs).where("_epochs > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_epochs").cast("int") - 1)))
    columns = [F.col(c) for c in docs.columns if c != epoch]
    return repeated.select(*columns, *([F.col("_epoch").alias(epoch)] if epoch else []))
