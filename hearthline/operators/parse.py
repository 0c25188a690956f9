"""Response bodies -> typed listing rows, on built-in JSON expressions.

A body is read once, with types.  If all of it could be converted and nothing in
it is a JSON null, a block that came out null was not there, and the homes stand as
read.  Other bodies are read again to cut their array of homes into one JSON text per
home, so that a broken home spoils only itself; each home is then read with types.
Whether a block such as ``price`` is missing (home kept, column null) or present
but not an object (home dropped) cannot be seen in a typed read: for those homes
with a null block, and only for them, the keys are looked up.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions.text import cut_prefix, object_text, trimmed
from hearthline.model import LISTING_COLUMNS, LISTING_FIELDS, NEARBY_HOMES

JSON_OPTIONS = {"allowSingleQuotes": "false"}
BROKEN = "_broken"
# Of the read of whole bodies: what fails in it is read again.
WHOLE_OPTIONS = {**JSON_OPTIONS, "allowNonNumericNumbers": "false", "columnNameOfCorruptRecord": BROKEN}


def _nested_ddl(tree: dict) -> str:
    parts = []
    for name, sub in tree.items():
        kind = f"struct<{_nested_ddl(sub)}>" if isinstance(sub, dict) else sub
        parts.append(f"`{name}`:{kind}")
    return ",".join(parts)


def _home_tree(columns: Collection[str]) -> dict:
    """What to read of a home: every block, but in them only what is asked for."""
    tree: dict = {}
    for name, path, kind in LISTING_FIELDS:
        *blocks, leaf = path.split(".")
        node = tree
        for block in blocks:
            node = node.setdefault(block, {})
        if name in columns:
            node[leaf] = kind
    return tree


BLOCKS = tuple(name for name, sub in _home_tree(()).items() if isinstance(sub, dict))


def _document_ddl(homes_path: str, homes: str) -> str:
    tree: dict | str = homes
    for part in reversed(homes_path.split(".")):
        tree = {part: tree}
    return _nested_ddl(tree)


def _at(document: Column, homes_path: str) -> Column:
    return reduce(lambda node, part: node[part], homes_path.split("."), document)


def home_texts(text: Column, homes_path: str = NEARBY_HOMES) -> Column:
    """The array under ``homes_path`` as one JSON text per element."""
    ddl = f"struct<{_document_ddl(homes_path, 'array<string>')}>"
    return _at(F.from_json(object_text(text), ddl, JSON_OPTIONS), homes_path)


def _may_be_plain(body: Column) -> Column:
    """Without a null, and without half a character pair, which no text can be made of."""
    half = F.contains(body, F.lit("\\u")) & (F.contains(body, F.lit("\\ud")) | F.contains(body, F.lit("\\uD")))
    return ~(F.contains(body, F.lit("null")) | half)


def _plain(document: Column, homes_path: str, columns: Collection[str]) -> Column:
    """Whether a typed read says all of a body: nothing failed, and no home is odd.

    Odd is a position block without a position, as only its keys tell why, and a text
    column with a number beyond all doubles, which is copied with quotes around it.
    """
    texts = [path for name, path, kind in LISTING_FIELDS if name in columns and kind == "string"]

    def odd(home: Column) -> Column:
        spot = home["latLong"]
        text = F.concat_ws("", *[_at(home, path) for path in texts])
        return (spot.isNotNull() & spot["value"].isNull()) | F.contains(text, F.lit('Infinity"'))

    none_odd = ~F.coalesce(F.exists(_at(document, homes_path), odd), F.lit(False))
    return document.isNotNull() & document[BROKEN].isNull() & none_odd


def _homes(body: Column, homes_path: str, columns: Collection[str]) -> Column:
    """The homes of a body as ``home`` and, where they have to be looked at again, ``text``."""
    home_ddl = f"struct<{_nested_ddl(_home_tree(columns))}>"
    document_ddl = f"struct<{_document_ddl(homes_path, f'array<{home_ddl}>')},{BROKEN}:string>"

    def of(document: Column) -> Column:
        no_text = F.array().cast("array<string>").alias("text")
        read = F.arrays_zip(no_text, _at(document, homes_path).alias("home"))
        again = F.transform(
            home_texts(body, homes_path),
            lambda text: F.struct(text.alias("text"), F.from_json(F.when(text.startswith("{"), text), home_ddl, JSON_OPTIONS).alias("home")),
        )
        return F.when(_plain(document, homes_path, columns), read).otherwise(again)

    whole = F.when(_may_be_plain(body), object_text(body))
    # The lambda is what makes Spark read the document once, however often it is looked at.
    return F.flatten(F.transform(F.array(F.from_json(whole, document_ddl, WHOLE_OPTIONS)), of))


def _hoa_tolerated(home: Column) -> Column:
    """A fee block that is a list or a text passes unless it holds ``value``."""
    raw = F.get_json_object(home, "$.hoa")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(home), "$.hoa", "variant"))
    items = F.from_json(raw, "array<string>", JSON_OPTIONS)
    return (
        F.when(kind == "STRING", ~F.contains(raw, F.lit("value")))
        .when(kind.startswith("ARRAY"), ~F.coalesce(F.array_contains(items, "value"), F.lit(False)))
        .otherwise(F.lit(False))
    )


def _sound(home: Column, parsed: Column) -> list[Column]:
    """Conditions that fail where some block is there but is not an object.

    The rare cases sit behind ``when``, not ``|``: Spark computes in advance what
    the two sides of an ``or`` share, and would do the costly part every time.
    """
    keys = F.json_object_keys(home)

    def nulls_absent(*blocks: str) -> Column:
        nulls = F.array_compact(F.array(*[F.when(parsed[b].isNull(), b) for b in blocks]))
        return ~F.coalesce(F.arrays_overlap(nulls, keys), F.lit(True))

    but_fee = [block for block in BLOCKS if block != "hoa"]
    # One level down: the position block holds another object.
    spot = parsed["latLong"]
    spot_keys = F.json_object_keys(F.get_json_object(home, "$.latLong"))
    return [
        home.startswith("{"),
        F.when(nulls_absent(*BLOCKS), True).otherwise(nulls_absent(*but_fee) & _hoa_tolerated(home)),
        F.when(spot.isNull() | spot["value"].isNotNull(), True).otherwise(
            ~F.coalesce(F.array_contains(spot_keys, "value"), F.lit(True))
        ),
    ]


def parse_listings(
    responses: DataFrame,
    homes_path: str = NEARBY_HOMES,
    body: str = "raw_json",
    zipcode: str | None = "zipcode",
    ingested: Column | None = None,
    columns: Collection[str] = LISTING_COLUMNS,
) -> DataFrame:
    """43 listing columns and ``ingestion_timestamp``, one row per sound home.

    ``ingested`` is the time of the parse unless given, e.g. as the response's
    own time.  A body that is null, short, an error or not JSON gives no row.
    The status code is not looked at.  Name the ``columns`` you need: Spark
    does not see through the two reads, so only this spares it the others.
    """
    stamp = F.current_timestamp() if ingested is None else ingested
    area = F.lit(None).cast("string") if zipcode is None else F.col(zipcode)
    bodies = responses.select(
        area.alias("search_zipcode"),
        stamp.alias("ingestion_timestamp"),
        trimmed(cut_prefix(F.col(body))).alias("body"),
    )
    # The reads sit in a generator: a filter moves below a projection and would make
    # Spark read each text twice, but it stays above a generator.
    found = F.explode(_homes(F.col("body"), homes_path, columns)).alias("h")
    homes = bodies.select("search_zipcode", "ingestion_timestamp", found).where("h.home IS NOT NULL")
    for condition in _sound(F.col("h.text"), F.col("h.home")):
        homes = homes.where(F.when(F.col("h.text").isNull(), True).otherwise(condition))
    fields = [F.col(f"h.home.{path}").alias(name) for name, path, _ in LISTING_FIELDS if name in columns]
    area_field = ["search_zipcode"] if "search_zipcode" in columns else []
    return homes.select(*area_field, *fields, "ingestion_timestamp")
