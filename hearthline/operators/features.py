"""Key features of a listing, by a model or by a fixed rule."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions.text import feature_prompt, leading_phrases
from hearthline.sources.tables import find_table, read_table, write_table

# A batch of texts in, one answer per text out.
TextModel = Callable[[pd.Series], pd.Series]


def ask_model(prompt: Column, model: TextModel) -> Column:
    """Send prompts to ``model`` in Arrow batches; null prompts are not sent."""

    def answer(prompts: pd.Series) -> pd.Series:
        asked = prompts.dropna()
        answers = pd.Series(model(asked), index=asked.index, dtype=object) if len(asked) else asked
        return answers.reindex(prompts.index).astype(object).where(lambda s: s.notna(), None)

    # A call costs money: Spark must not make it twice, or reorder around it.
    return F.pandas_udf(answer, "string").asNondeterministic()(prompt)


def top_features(listings: DataFrame, model: TextModel | None = None) -> DataFrame:
    """``propertyId, listingRemarks, top_features``; null remarks give null.

    Without a model the first four phrases of the remarks are taken.  That rule
    is a stand-in, not a language model.
    """
    return with_features(listings, model).select("propertyId", "listingRemarks", "top_features")


def with_features(listings: DataFrame, model: TextModel | None = None) -> DataFrame:
    """Listings with their ``top_features`` as one more column."""
    remarks = F.col("listingRemarks")
    answer = leading_phrases(remarks) if model is None else ask_model(feature_prompt(remarks), model)
    return listings.withColumn("top_features", answer)


def prompt_key(prompt: Column) -> Column:
    return F.sha2(prompt.cast("binary"), 256)


def ask_new_prompts(listings: DataFrame, model: TextModel, answers: str, base: str | None = None) -> None:
    """Ask ``model`` for every distinct prompt of ``listings`` that has no answer yet, and
    append prompt_key and top_features to the table ``answers``.

    Equal remarks, of whatever property, are one prompt and one call, in this run and in
    later ones.  Only keys are compared with the kept answers; a prompt travels once.  A
    run that fails keeps nothing; a task that is lost asks its prompts again.
    """
    spark = listings.sparkSession
    prompt = feature_prompt(F.col("listingRemarks"))
    asked = listings.where(F.col("listingRemarks").isNotNull()).select(prompt_key(prompt).alias("prompt_key"), prompt.alias("prompt"))
    known = find_table(spark, answers, base)
    if known is not None:
        asked = asked.join(known.select("prompt_key"), "prompt_key", "left_anti")
    asked = asked.dropDuplicates(["prompt_key"])
    write_table(asked.select("prompt_key", ask_model(F.col("prompt"), model).alias("top_features")), answers, base)


def with_kept_features(listings: DataFrame, model: TextModel, answers: str, base: str | None = None) -> DataFrame:
    """Listings with ``top_features`` from the kept answers, after asking for what is new.

    A prompt that two runs asked at once has two answers; the lower is taken."""
    ask_new_prompts(listings, model, answers, base)
    kept = read_table(listings.sparkSession, answers, base).groupBy("prompt_key").agg(F.min("top_features").alias("top_features"))
    keyed = listings.withColumn("prompt_key", prompt_key(feature_prompt(F.col("listingRemarks"))))
    return keyed.join(kept, "prompt_key", "left").drop("prompt_key")
