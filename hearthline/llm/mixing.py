"""Mixing sources to target weights by capped water-filling, natively.

Every source asks for its weight's share of the budget but may give at most
``max_epochs`` times its size; what is clamped goes to the others by weight.  The
fixed point is found in closed form: with sources sorted by cap / weight, the
level is the largest of (budget - caps so far) / (weights from here on).

A source's target is then taken as whole repetitions of all its documents and one
fractional repetition: documents in an order set by the seed, until the words are
used up, the last one in part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import NO_WORD, word_count, written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-7"
DIGITS = 3  # hex digits of the order that make a bin: 4096 bins a source


def cyclic_weight(rank: Column, weights: tuple[int, ...] = WEIGHTS) -> Column:
    return F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(rank, F.lit(len(weights))).cast("int"))


def fill_targets(sources: DataFrame, max_epochs: int, budget: Column | None = None) -> DataFrame:
    """``sources`` (source, source_size long, weight int) with their ``target``.

    One row per source, so the two windows without a key see as many rows as there
    are sources.  The budget is the sum of all sizes unless given.  Sizes of 0 get
    a target of 0.
    """
    everything = Window.partitionBy(F.lit(0))
    by_ratio = everything.orderBy("ratio", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    from_here = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything) if budget is None else budget
    capped = sources.withColumn("cap", F.col("source_size") * max_epochs)
    capped = capped.withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    level = capped.withColumn("level", (total - before).cast("double") / from_here)
    level = level.withColumn("level", F.max("level").over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return level.select("source", "source_size", target.alias("target"))


def _drawn(docs: DataFrame, seed: str, *more) -> DataFrame:
    """Sizes and places in the order of the draw."""
    draw = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), draw.alias("draw"), *more)
    return rows.withColumn("bin", F.substring("draw", 1, DIGITS))


def _taken(rows: DataFrame, weights, max_epochs: int) -> DataFrame:
    """``rows`` with source_size, target, whole (repetitions) and part (words of one more)."""
    bins = written(rows.groupBy("source", "bin").agg(F.sum("size").alias("words")), "mix-bins")
    sources = bins.groupBy("source").agg(F.sum("words").alias("source_size"))
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    targets = fill_targets(sources.withColumn("weight", cyclic_weight(rank, weights)), max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("whole", whole).withColumn(
        "rest", (F.floor("target") - F.col("whole") * F.col("source_size")).cast("long")
    )
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = bins.select(
        F.col("source").alias("of"), F.col("bin").alias("at"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start")
    )
    starts = starts.join(targets, F.col("of").eqNullSafe(F.col("source"))).drop("source")
    inside = Window.partitionBy("source", "bin").orderBy("draw", "doc_id", "size")
    before = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    ran = rows.withColumn("before", before)
    joined = ran.join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("bin") == F.col("at")))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start") - F.col("before")))
    return joined.withColumn("part", part)


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target and ``taken`` (words the mix takes).

    Needs doc_id, text, source; other columns are not looked at.  Sources weigh
    ``weights`` in turn, by code point, null last and a source like any other.  A
    null or empty text has size 0 and gives 0 words.  Repeated rows count as often
    as they are there; rows that tie in the order (same id) may swap what they
    give, which leaves the rows as a whole alike.  An empty table gives no rows.

    A source's taken words are its target rounded down, exactly; no document gives
    more than ``max_epochs`` times its size.  No source goes to one task: running
    sums are taken in bins of the order, and added up over the bins.
    """
    found = _taken(written(_drawn(docs, seed), "mix-rows"), weights, max_epochs)
    taken = (F.col("whole") * F.col("size") + F.col("part")).cast("long")
    return found.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: each document as often as it is taken whole, and once more as its
    first words, joined by a space, where it is taken in part.  Documents of which
    nothing is taken, texts without words among them, are not in it."""
    inner = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    found = _taken(_drawn(docs, seed, inner.alias("row")), weights, max_epochs)
    full = F.when(F.col("size") > 0, F.col("whole")).otherwise(0) + F.when(F.col("part") == F.col("size"), F.sign("size")).otherwise(0)
    some = F.when((F.col("part") > 0) & (F.col("part") < F.col("size")), F.col("part")).otherwise(0)
    cut = F.array_repeat(F.lit(0).cast("long"), full.cast("int"))
    cut = F.when(some > 0, F.concat(cut, F.array(some.cast("long")))).otherwise(cut)
    each = found.select("row", F.explode(cut).alias("words"))
    text = F.col(f"row.c{docs.columns.index('text')}")
    first = F.array_join(F.slice(F.filter(F.split(text, NO_WORD), lambda w: w != ""), 1, F.greatest(F.lit(1), F.col("words").cast("int"))), " ")
    columns = []
    for i, name in enumerate(docs.columns):
        column = F.col(f"row.c{i}")
        if name == "text":
            column = F.when(F.col("words") > 0, first).otherwise(column)
        elif name == "n_chars":
            column = F.when(F.col("words") > 0, F.char_length(first).cast(docs.schema[name].dataType)).otherwise(column)
        columns.append(column.alias(name))
    return each.select(*columns)
