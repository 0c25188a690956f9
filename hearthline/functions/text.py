"""Column expressions over text; all of them run inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthline.model import (
    BODY_PREFIX_LENGTH,
    EMBEDDING_TEMPLATE,
    FEATURE_PROMPT,
    FEATURES_PER_LISTING,
    MISSING_TEXT,
)

JSON_BLANKS = " \t\n\r"
NO_LIMIT = 2147483647


def cut_prefix(raw: Column, length: int = BODY_PREFIX_LENGTH) -> Column:
    """The text behind the prefix, which is cut unread."""
    return F.substring(raw, length + 1, NO_LIMIT)


def object_text(text: Column) -> Column:
    """The text if it opens and closes a brace, else null.

    Throws out error bodies and arrays before any JSON is read; blanks around the
    text must be gone.
    """
    return F.when(text.startswith("{") & text.endswith("}"), text)


def trimmed(text: Column) -> Column:
    """Without blanks around it; a text between braces has none, and trimming goes
    through all characters of it."""
    return F.when(object_text(text).isNotNull(), text).otherwise(F.btrim(text, F.lit(JSON_BLANKS)))


def json_map(text: Column) -> Column:
    """JSON object text -> ``map<string,string>``; null where it is not one."""
    return F.from_json(text, "map<string,string>", {"allowSingleQuotes": "false"})


def error_body(message: Column) -> Column:
    """An error message wrapped as the JSON text kept in place of a body."""
    return F.to_json(F.struct(message.alias("error")))


def is_number(text: Column, kind: str = "double") -> Column:
    """True where the text can be cast: ``double``, or ``numeric`` (10 digits)."""
    target = {"double": "double", "numeric": "decimal(10,0)"}[kind]
    return text.try_cast(target).isNotNull()


def text_or(value: Column, default: str = MISSING_TEXT) -> Column:
    return F.coalesce(value.cast("string"), F.lit(default))


def fill_template(template: str = EMBEDDING_TEMPLATE, default: str = MISSING_TEXT) -> Column:
    """The template as one ``concat``: a literal, then a column, and so on."""
    parts = []
    for index, part in enumerate(re.split(r"\{(\w+)\}", template)):
        if index % 2:
            parts.append(text_or(F.col(part), default))
        elif part:
            parts.append(F.lit(part))
    return F.concat(*parts)


def template_columns(template: str = EMBEDDING_TEMPLATE) -> list[str]:
    return re.findall(r"\{(\w+)\}", template)


def feature_prompt(remarks: Column, prompt: str = FEATURE_PROMPT) -> Column:
    """The text sent to a feature model; null remarks give a null prompt."""
    return F.concat(F.lit(prompt), remarks)


def leading_phrases(remarks: Column, n: int = FEATURES_PER_LISTING) -> Column:
    """The first ``n`` phrases between commas, full stops and line ends.

    A fixed rule that stands in for a language model; it invents nothing and
    gives the same answer every time.
    """
    phrases = F.transform(F.split(remarks, r"[,.\n]"), lambda p: F.trim(p))
    return F.array_join(F.slice(F.filter(phrases, lambda p: p != ""), 1, n), ", ")
