"""Benchmark decontamination by a distributed positional inverted index, natively.

The index of a corpus holds one posting per occurrence of a term that the test items
use: row, position, term.  The end of a text is a term of its own, so that lengths are
in the index too, and texts are read once.

A phrase is looked for from its rarest term: its postings, moved back by the term's
offset, are the places where the phrase may start; the list of the second rarest term,
moved by its own offset, is intersected with them, then the third.  Each of these lists
holds only terms that have that rank in some phrase, so frequent words stay out of
them.  What is left are a few places per real match, and all other terms of the phrase
are checked there in one join.  Everything is equality joins of narrow rows; phrases that
several items share are looked for once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import written

TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASE = 10  # words of a window
END = " "  # the end of a text, as a term; no word has a space
FIRST_LISTS = 3  # rarest terms whose lists are intersected one after the other


def terms_of(text: Column) -> Column:
    """Words: runs of 0-9, a-z and all beyond ASCII, A-Z in lower case; null: none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def phrases_of(items: DataFrame, length: int = PHRASE) -> DataFrame:
    """item_id and phrase (array of words): every window of ``length`` words of each
    item, the whole item if it has fewer, nothing if it has none; needs item_id, text."""
    words = items.select("item_id", terms_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (length - 1), F.lit(1)))
    return words.select("item_id", "w", F.explode(starts).alias("i")).select("item_id", F.slice("w", F.col("i"), length).alias("phrase")).distinct()


def numbered_terms(words: DataFrame) -> DataFrame:
    """term (from 0) of each word of a column ``word``, the end of a text among them."""
    ends = words.sparkSession.createDataFrame([(END,)], "word string")
    return words.select("word").distinct().union(ends).select("word", F.monotonically_increasing_id().alias("term"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings of ``docs`` for the words of ``terms`` (word, term), as a table.

    row: number of the document's row; pos: place in it, from 0; term; doc_id: on the
    posting of the end only, whose pos is the number of words.  Needs doc_id, text."""
    texts = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.array_append(terms_of(F.col("text")), F.lit(END)).alias("w"))
    postings = texts.select("doc_id", "row", F.posexplode("w").alias("pos", "word")).join(terms, "word")
    postings = postings.select("row", "pos", "term", F.when(F.col("word") == END, F.col("doc_id")).alias("doc_id"), (F.col("word") == END).alias("end"))
    return written(postings, "phrase-postings")


def ranked_phrases(phrases: DataFrame, index: DataFrame, terms: DataFrame) -> DataFrame:
    """phrase_id, n, rank (from 1, the rarest), offset and term of the distinct phrases
    (phrase_id, phrase) all of whose terms occur in the index."""
    counts = index.where("not end").groupBy("term").agg(F.count(F.lit(1)).alias("times"))
    placed = phrases.select("phrase_id", F.size("phrase").alias("n"), F.posexplode("phrase").alias("offset", "word"))
    placed = placed.join(terms, "word").join(counts, "term")
    of = Window.partitionBy("phrase_id")
    ranked = placed.select(
        "phrase_id",
        "n",
        "offset",
        "term",
        F.row_number().over(of.orderBy("times", "offset")).alias("rank"),
        F.count(F.lit(1)).over(of).alias("known"),
    )
    return ranked.where("known = n").drop("known")


def _list_of(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """Postings of the terms in ``ranked``."""
    return index.where("not end").select("row", "pos", "term").join(ranked.select("term").distinct(), "term", "left_semi")


def find_phrases(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """row, start, phrase_id and n of every place where a phrase occurs."""
    ranked = written(ranked, "phrase-ranked")
    first = ranked.where("rank = 1").select("phrase_id", "n", "offset", "term")
    postings = index.where("not end").select("row", "pos", "term")
    found = postings.join(first, "term").select("row", (F.col("pos") - F.col("offset")).alias("start"), "phrase_id", "n").where("start >= 0")
    for rank in range(2, FIRST_LISTS + 1):
        of_rank = ranked.where(F.col("rank") == rank).select("phrase_id", "offset", "term")
        asked = found.where(F.col("n") >= rank).join(of_rank, "phrase_id").withColumn("pos", F.col("start") + F.col("offset"))
        met = asked.join(_list_of(index, of_rank), ["row", "pos", "term"])
        # shorter phrases have no such term: they are through
        found = written(met.select("row", "start", "phrase_id", "n").union(found.where(F.col("n") < rank)), "phrase-places")
    later = ranked.where(F.col("rank") > FIRST_LISTS).select("phrase_id", "offset", "term")
    rows = written(found.where(F.col("n") > FIRST_LISTS).select("row").distinct(), "phrase-rows")
    lists = _list_of(index, later).join(rows, "row", "left_semi")
    asked = found.where(F.col("n") > FIRST_LISTS).join(later, "phrase_id").withColumn("pos", F.col("start") + F.col("offset"))
    met = asked.join(lists, ["row", "pos", "term"]).groupBy("row", "start", "phrase_id", "n").agg(F.count(F.lit(1)).alias("met"))
    whole = met.where(F.col("met") == F.col("n") - FIRST_LISTS).select("row", "start", "phrase_id", "n")
    return written(whole.union(found.where(F.col("n") <= FIRST_LISTS)), "phrase-matches")


def find_near(index: DataFrame, ranked: DataFrame, within: int) -> DataFrame:
    """row, pos, phrase_id: places of a phrase's rarest term that have each distinct term
    of the phrase, in any order, at most ``within`` words away.

    Positions are cut into cells ``within`` wide, so that this too is an equality join,
    with the cell of a place and the two beside it."""
    ranked = written(ranked.groupBy("phrase_id", "term").agg(F.min("rank").alias("rank")), "phrase-terms")
    first = ranked.where("rank = 1").select("phrase_id", "term")
    postings = index.where("not end").select("row", "pos", "term")
    places = written(postings.join(first, "term").select("row", "pos", "phrase_id"), "phrase-rare-places")
    cell = F.floor(F.col("pos") / F.lit(within))
    asked = places.join(ranked.where("rank > 1").select("phrase_id", "term"), "phrase_id")
    asked = asked.withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    lists = _list_of(index, ranked.where("rank > 1")).join(places.select("row").distinct(), "row", "left_semi")
    lists = lists.select("row", F.col("pos").alias("at"), "term", F.floor(F.col("pos") / F.lit(within)).alias("cell"))
    met = asked.join(lists, ["row", "term", "cell"]).where(F.abs(F.col("at") - F.col("pos")) <= within)
    met = met.select("row", "pos", "phrase_id", "term").distinct().groupBy("row", "pos", "phrase_id").agg(F.count(F.lit(1)).alias("met"))
    needed = ranked.groupBy("phrase_id").agg((F.count(F.lit(1)) - 1).alias("others"))
    joined = places.join(needed, "phrase_id").join(met, ["row", "pos", "phrase_id"], "left")
    return joined.where(F.coalesce("met", F.lit(0)) == F.col("others")).select("row", "pos", "phrase_id")


def covered(matches: DataFrame) -> DataFrame:
    """row and n_hit: words inside any of the places (row, start, n), each once."""
    spans = matches.groupBy("row", "start").agg(F.max("n").alias("n"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    spans = spans.select("row", F.greatest(end - F.greatest("start", reached), F.lit(0)).alias("new"))
    return spans.groupBy("row").agg(F.sum("new").cast("long").alias("n_hit"))


def indexed(docs: DataFrame, items: DataFrame, length: int = PHRASE) -> tuple[DataFrame, ...]:
    """index, ranked phrases and the item_id of each phrase_id."""
    by_item = written(phrases_of(items, length), "phrase-items")
    phrases = by_item.select("phrase").distinct().select(F.monotonically_increasing_id().alias("phrase_id"), "phrase")
    phrases = written(phrases, "phrase-distinct")
    terms = written(numbered_terms(phrases.select(F.explode("phrase").alias("word"))), "phrase-vocabulary")
    index = build_index(docs, terms)
    members = phrases.join(by_item.where("item_id is not null"), "phrase").select("phrase_id", "item_id")
    return index, ranked_phrases(phrases, index, terms), members


def decontaminate(docs: DataFrame, items: DataFrame, length: int = PHRASE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Needs doc_id and text of documents, item_id and text of items.  Null and empty texts
    have no words and are not hit; items without a word match nothing; items without an
    item_id hit words but are not counted.  Repeated rows are judged alike and all
    returned; item_ids of several rows count once.  A text of any length is one row of
    postings per known word.  Columns of other names are not looked at; no items: no
    hits; no documents: no rows.  A document's item_ids, at most all items, are joined in
    one group."""
    index, ranked, members = indexed(docs, items, length)
    matches = find_phrases(index, ranked)
    named = matches.select("row", "phrase_id").distinct().join(members, "phrase_id").groupBy("row")
    ids = F.sort_array(F.collect_set(F.col("item_id").cast("string")))
    named = named.agg(ids.alias("ids")).select("row", F.size("ids").cast("long").alias("n_items"), F.array_join("ids", ",").alias("listed"))
    found = index.where("end").join(covered(matches), "row", "left").join(named, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return found.select(
        "doc_id",
        F.col("pos").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("listed", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def near_matches(docs: DataFrame, items: DataFrame, within: int, length: int = PHRASE) -> DataFrame:
    """doc_id and item_id of documents with all terms of a window of an item, in any
    order, at most ``within`` words from its rarest term; nulls as in ``decontaminate``."""
    index, ranked, members = indexed(docs, items, length)
    near = find_near(index, ranked, within).select("row", "phrase_id").distinct().join(members, "phrase_id")
    return near.join(index.where("end").select("row", "doc_id"), "row").select("doc_id", "item_id").distinct()
