"""Quality rules with thresholds that adapt to language and source, natively.

Counts are taken from every whole text by built-in functions, inside its row: no
word is ever a row of its own.  Fixed base rules reject the plainly broken texts.
For all others each measure goes into a quantile sketch per language and source:
a histogram of logarithmic cells, exact counts, so that sketches merge by adding
and do not depend on how rows were dealt.

A measure's limits lie around the median of its group, at a distance that is a
multiple of the distance from the median to the quartile on the other side: junk
that gathers on one side of the median does not widen the limit that is to stop
it.  A group's quartiles are blended with its language's, and these with those of
all documents, by numbers of documents and alike at every size; a group departs
from its language only so far, so that a source full of junk cannot lift its own
limits beyond that.  The limits are joined back and filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import NO_WORD, let, written

WINDOW = 5  # words of a window that counts as repeated
MIN_WORDS = 10
MAX_REPEAT = 20  # per cent of words in repeated windows
CELL = 0.005  # relative width of a sketch cell
SMALLEST = 0.001  # values below count as 0
PRIOR = 200  # documents that the wider group's quartiles count as in a blend
FENCE = 12.0  # limits: times the distance of the median and the opposite quartile
LEAST = 0.01  # of the median: the least such distance
SHIFT = 6.0  # language's distances that a group's median may lie off its language's
WIDER = 2.0  # times its language's: the largest distance of a group
# Rates are smoothed, so that a short text without any symbol or doubled line is
# told from a long one: added to the count and to what it is divided by.
SYMBOL_SMOOTHING = (1, 50)
LINE_SMOOTHING = (1, 5)
# measure: whether it has a lower limit too
MEASURES = {"word_length": True, "symbols": False, "dup_lines": False, "sameness": False}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct")


def repeated_words(hashes: Column) -> Column:
    """Words in ``WINDOW``-word windows that occur twice or more, from the words'
    hashes.  Most texts have none, which one set of windows tells; only the others
    are sorted."""

    def covered(at):
        def add(total, k):
            gap = F.coalesce(F.get(at, k + 1) - F.get(at, k), F.lit(WINDOW))
            return total + F.least(F.lit(WINDOW), gap)

        return F.aggregate(F.sequence(F.lit(0), F.size(at) - 1), F.lit(0), add)

    def positions(pairs):
        def repeated(k):
            def same(other):
                return F.coalesce(F.get(pairs, other)["w"] == F.get(pairs, k)["w"], F.lit(False))

            return same(k - 1) | same(k + 1)

        found = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), repeated)
        return F.sort_array(F.transform(found, lambda k: F.get(pairs, k)["i"]))

    def of_windows(windows):
        pairs = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        some = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(some, let(let(pairs, positions), covered)).otherwise(0)

    def of_hashes(h):
        starts = F.sequence(F.lit(0), F.size(h) - WINDOW)
        windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
        return F.when(F.size(h) >= WINDOW, let(windows, of_windows)).otherwise(0)

    return let(hashes, of_hashes)


def text_counts(text: Column) -> Column:
    """The counts of a text as one struct of longs; a null text counts as empty."""

    def of_words(found):
        return F.struct(
            F.size(found).cast("long").alias("n_words"),
            F.char_length(F.array_join(found, "")).cast("long").alias("word_chars"),
            repeated_words(F.transform(found, lambda w: F.xxhash64(w))).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(found)).cast("long").alias("n_distinct"),
        )

    def of_lines(found):
        return F.struct(
            F.size(found).cast("long").alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
        )

    whole = F.coalesce(text, F.lit(""))
    words = let(F.filter(F.split(whole, NO_WORD), lambda w: w != ""), of_words)
    lines = let(F.filter(F.split(whole, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))), of_lines)
    symbols = F.char_length(whole) - F.char_length(F.translate(whole, "#*$%&|<>", ""))
    return let(
        F.struct(words.alias("w"), lines.alias("x"), symbols.cast("long").alias("s")),
        lambda c: F.struct(
            c["w"]["n_words"].alias("n_words"),
            c["w"]["word_chars"].alias("word_chars"),
            c["s"].alias("n_symbols"),
            c["x"]["n_dup_lines"].alias("n_dup_lines"),
            c["w"]["n_repeat_words"].alias("n_repeat_words"),
            c["x"]["n_lines"].alias("n_lines"),
            c["w"]["n_distinct"].alias("n_distinct"),
        ),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def measure(name: str) -> Column:
    """Characters a word; smoothed rates of symbols and doubled lines; sameness, which
    is 0 where all words of a long text differ and 1 where all are the same."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    if name == "word_length":
        return F.col("word_chars").cast("double") / words
    if name == "symbols":
        return (F.col("n_symbols") + SYMBOL_SMOOTHING[0]).cast("double") / (F.col("n_words") + SYMBOL_SMOOTHING[1])
    if name == "dup_lines":
        return (F.col("n_dup_lines") + LINE_SMOOTHING[0]).cast("double") / (F.col("n_lines") + LINE_SMOOTHING[1])
    return 1 - F.ln(F.greatest(F.col("n_distinct"), F.lit(1))) / F.ln(words + 1)


def sketch_cell(value: Column) -> Column:
    """The cell of a value: null for what counts as 0."""
    return F.when(value >= SMALLEST, F.floor(F.ln(value) / F.ln(F.lit(1 + CELL))).cast("long"))


def sketches(counted: DataFrame) -> DataFrame:
    """lang, source, measure, cell, n of every document that passes the base rules.

    Grows with the groups, at most some 4,000 cells a measure, not with the rows;
    rows are added up before they are shuffled."""
    found = F.array(*[F.struct(F.lit(m).alias("measure"), sketch_cell(measure(m)).alias("cell")) for m in MEASURES])
    cells = counted.where(~base_failed()).select("lang", "source", F.inline(found))
    return cells.groupBy("lang", "source", "measure", "cell").agg(F.count(F.lit(1)).alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """n, q1, q2 and q3 per ``keys`` of a sketch: the lower edges of the cells that hold
    the documents of rank ceil(n / 4), ceil(n / 2) and ceil(3 n / 4)."""
    merged = sketch.groupBy(*keys, "cell").agg(F.sum("n").alias("n"))
    upward = Window.partitionBy(*keys).orderBy(F.col("cell").asc_nulls_first())
    ran = merged.select(
        *keys,
        F.coalesce(F.pow(F.lit(1 + CELL), F.col("cell")), F.lit(0.0)).alias("value"),
        F.sum("n").over(upward.rowsBetween(Window.unboundedPreceding, 0)).alias("up_to"),
        F.sum("n").over(Window.partitionBy(*keys)).alias("all"),
    )
    return ran.groupBy(*keys).agg(
        F.max("all").alias("n"),
        *[F.min(F.when(4 * F.col("up_to") >= k * F.col("all"), F.col("value"))).alias(f"q{k}") for k in (1, 2, 3)],
    )


def limits(sketch: DataFrame, prior: int = PRIOR) -> DataFrame:
    """One row per language and source with ``high_*`` of each measure and ``low_*``
    where it has one.  Null languages and sources are groups like any other."""

    def renamed(frame, prefix):
        return frame.withColumnsRenamed({c: f"{prefix}{c}" for c in frame.columns})

    own = quartiles(sketch, ["lang", "source", "measure"])
    by_lang = renamed(quartiles(sketch, ["lang", "measure"]), "l_")
    overall = renamed(quartiles(sketch, ["measure"]), "a_")
    found = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("measure") == F.col("l_measure")))
    found = found.join(overall, F.col("measure") == F.col("a_measure"))

    def blended(name, count, wider):
        return (F.col(count) * F.col(name) + prior * F.col(wider)) / (F.col(count) + prior)

    found = found.withColumns({f"l_q{k}": blended(f"l_q{k}", "l_n", f"a_q{k}") for k in (1, 2, 3)})
    found = found.withColumns({f"q{k}": blended(f"q{k}", "n", f"l_q{k}") for k in (1, 2, 3)})

    def apart(prefix, upper, lower):
        return F.greatest(F.col(f"{prefix}{upper}") - F.col(f"{prefix}{lower}"), LEAST * F.col(f"{prefix}q2"))

    up, down = apart("l_", "q2", "q1"), apart("l_", "q3", "q2")
    middle = F.least(F.greatest(F.col("q2"), F.col("l_q2") - SHIFT * down), F.col("l_q2") + SHIFT * up)
    found = found.select(
        "lang", "source", "measure",
        (middle + FENCE * F.least(apart("", "q2", "q1"), WIDER * up)).alias("high"),
        (middle - FENCE * F.least(apart("", "q3", "q2"), WIDER * down)).alias("low"),
    )
    columns = []
    for name, has_low in MEASURES.items():
        here = F.col("measure") == name
        columns.append(F.max(F.when(here, F.col("high"))).alias(f"high_{name}"))
        if has_low:
            columns.append(F.max(F.when(here, F.col("low"))).alias(f"low_{name}"))
    return found.groupBy("lang", "source").agg(*columns)


def judged(counted: DataFrame, bounds: DataFrame) -> DataFrame:
    """``counted`` with base_failed and kept.  A group without limits has no document
    that passes the base rules, so none is kept there."""
    bounds = bounds.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = counted.join(
        bounds, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left"
    )
    passes = ~base_failed()
    for name, has_low in MEASURES.items():
        passes &= F.coalesce(measure(name) <= F.col(f"high_{name}"), F.lit(False))
        if has_low:
            passes &= F.coalesce(measure(name) >= F.col(f"low_{name}"), F.lit(False))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", passes).drop(*bounds.columns)


def quality(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document; needs doc_id, text, lang, source.

    Returns doc_id, lang, source, the counts, base_failed and kept.  A null or empty
    text has no words and fails; repeated rows are judged alike and all returned;
    columns of other names are not looked at; an empty table gives no rows.
    """
    rows = docs.select("doc_id", "lang", "source", text_counts(F.col("text")).alias("c")).select("doc_id", "lang", "source", "c.*")
    rows = written(rows, "quality-counts")
    return judged(rows, limits(sketches(rows)))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that ``quality`` keeps, with the columns they came with.

    Texts are counted twice, for the sketches and for the filter, which is less work
    than to shuffle them.  The limits are a table when they are joined, so Spark knows
    how small they are and brings them to the texts.  Nulls, empty texts and repeated
    rows are judged as in ``quality``; very long texts are one row like any other; other
    columns are handed through, whatever their names; an empty table stays empty."""
    inner = F.struct(*[F.col(c) for c in docs.columns])

    def counted(frame):
        # in a generator: filters on the counts would else move below them, with a
        # copy of all that counts for each
        counts = F.explode(F.array(text_counts(F.col("text"))))
        return frame.select(inner.alias("_row"), "lang", "source", counts.alias("_c"))

    sketch = written(sketches(counted(docs).select("lang", "source", "_c.*")), "quality-sketch")
    rows = counted(docs).select("_row", "lang", "source", "_c.*")
    return judged(rows, written(limits(sketch), "quality-limits")).where("kept").select("_row.*")
