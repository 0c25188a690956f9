"""Frames in the shapes the operators read, derived from the given test tables.

Nothing is grouped here: one area per customer or supplier, one response per
line item, so that no key, however hot, gathers rows in one task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions.text import NO_LIMIT, error_body

PREFIX = "{}&&"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def zip_text(key: Column) -> Column:
    return F.lpad(key.cast("string"), 9, "0")


def _directory(keys: DataFrame, nation: DataFrame, key: str, nation_key: str, stat: str) -> DataFrame:
    return keys.join(nation, F.col(nation_key) == F.col("n_nationkey")).select(
        zip_text(F.col(key)).alias("zip"),
        F.col(stat).alias("lat"),
        (-F.col(stat)).alias("lng"),
        F.col(nation_key).cast("string").alias("state_id"),
        F.replace("n_name", F.lit("_"), F.lit(" ")).alias("state_name"),
        F.when(F.col(key) % 10 != 0, F.col(key) * 37).alias("population"),
        F.col(stat).alias("density"),
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search areas: one per customer."""
    return _directory(
        table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"),
        "c_custkey", "c_nationkey", "c_acctbal",
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location statistics: one row per supplier, the areas homes lie in."""
    return _directory(
        table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"),
        "s_suppkey", "s_nationkey", "s_acctbal",
    )


def _value(column: Column) -> Column:
    return F.struct(column.alias("value"))


def _remarks() -> Column:
    return F.concat(
        F.lit("Part "), F.col("l_partkey").cast("string"), F.lit(", flag "), F.col("l_returnflag"),
        F.lit(". Line "), F.col("l_linenumber").cast("string"), F.lit(", , status "),
        F.col("l_linestatus"), F.lit("\n quiet street, fenced yard"),
    )


def home(price: Column | None = None) -> Column:
    """One home object per line item: every field there in some rows, most in all.

    Line 7 has a zip that is no number."""
    price = F.expr("cast(l_extendedprice as bigint)") if price is None else price
    zipcode = zip_text(F.col("l_suppkey"))
    open_house, line = F.col("l_linestatus") == "O", F.col("l_linenumber").cast("string")
    return F.struct(
        _value(F.concat_ws("-", F.lit("M"), "l_orderkey", "l_linenumber")).alias("mlsId"),
        F.when(F.col("l_linestatus") == "O", "Active").otherwise("Sold").alias("mlsStatus"),
        _value(price).alias("price"),
        F.when(F.col("l_returnflag") != "N", _value(F.col("l_linenumber") * 25)).alias("hoa"),
        _value(F.expr("cast(l_quantity as int) * 100")).alias("sqFt"),
        F.when(F.col("l_returnflag") == "A", _value(F.col("l_linenumber") * 10)).alias("pricePerSqFt"),
        _value(F.lit(7000)).alias("lotSize"),
        F.col("l_linenumber").alias("beds"),
        F.expr("cast(l_linenumber as double) / 2").alias("baths"),
        F.lit(1).alias("fullbaths"),
        F.when(F.col("l_returnflag") != "R", F.col("l_linenumber") % 3).alias("partialBaths"),
        _value(F.concat(F.lit("Ward "), F.col("l_returnflag"))).alias("location"),
        F.lit(1.0).alias("stories"),
        _value(F.struct((F.col("l_tax") + 30).alias("latitude"), (-F.col("l_tax") - 94).alias("longitude"))).alias("latLong"),
        _value(F.concat(F.col("l_orderkey").cast("string"), F.lit(" Main St"))).alias("streetLine"),
        F.concat(F.lit("City "), F.col("l_suppkey").cast("string")).alias("city"),
        F.lit("TX").alias("state"),
        F.when(F.col("l_linenumber") == 7, F.concat(zipcode, F.lit("-1234"))).otherwise(zipcode).alias("zip"),
        _value(zipcode).alias("postalCode"),
        F.lit("US").alias("countryCode"),
        (F.col("l_linenumber") % 4).alias("searchStatus"),
        F.col("l_linenumber").alias("propertyType"),
        (F.col("l_linenumber") + 1).alias("uiPropertyType"),
        (F.col("l_suppkey") % 3).alias("listingType"),
        F.col("l_partkey").alias("propertyId"),
        F.col("l_orderkey").alias("listingId"),
        (F.col("l_suppkey") % 11).alias("dataSourceId"),
        (F.col("l_partkey") % 13).alias("marketId"),
        _value(F.expr("cast(1950 + l_suppkey % 70 as int)")).alias("yearBuilt"),
        F.when(open_house, F.concat(F.lit("May "), line)).alias("openHouseStartFormatted"),
        F.when(open_house, F.concat(F.lit("Open House - "), line)).alias("openHouseEventName"),
        F.concat(F.lit("/TX/home/"), F.col("l_partkey").cast("string")).alias("url"),
        open_house.alias("isHot"),
        (F.col("l_linenumber") % 2 == 0).alias("hasVirtualTour"),
        (F.col("l_linenumber") % 3 == 0).alias("hasVideoTour"),
        (F.col("l_suppkey") % 2 == 0).alias("has3DTour"),
        (F.col("l_suppkey") % 3 == 0).alias("isActiveKeyListing"),
        (F.col("l_partkey") % 5 == 0).alias("isNewConstruction"),
        _remarks().alias("listingRemarks"),
        F.concat(F.lit("https://scan.example/"), F.col("l_orderkey").cast("string")).alias("scanUrl"),
        F.when(open_house, F.concat(F.lit("https://poster.example/"), line)).alias("posterFrameUrl"),
    )


def _number(value: Column) -> Column:
    """As JSON writes a double: what is no number has quotes."""
    quote = F.when(F.abs(value) < float("inf"), "").otherwise('"')
    return F.concat(quote, value.cast("string"), quote)


def _written(template: str, **values: Column) -> Column:
    """The template with ``<name>`` replaced by columns, which need no escaping; null if one is."""
    parts = re.split(r"<(\w+)>", template)
    return F.concat(*[values[part] if at % 2 else F.lit(part) for at, part in enumerate(parts)])


def home_text(price: Column | None = None) -> Column:
    """``home`` as JSON text, its fields in another order, in less time than ``to_json``.

    Fields of one column of the line item are written as one text, which is left out
    where that column is null; objects around a null stay, empty.  All fields are parts of
    one ``concat``, each with its comma, so that no text is copied part by part.  Only what
    holds text of the table goes through ``to_json``, which escapes it.
    """
    price = F.expr("cast(l_extendedprice as bigint)") if price is None else price
    order, part, supplier, line = (F.col(name) for name in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    zipcode, flag, open_house = zip_text(supplier), F.col("l_returnflag"), F.col("l_linestatus") == "O"
    text = {"order": order.cast("string"), "part": part.cast("string"), "line": line.cast("string"), "zip": zipcode}
    nothing = F.lit("")

    def value(name: str, column: Column) -> Column:
        return F.coalesce(_written(f'"{name}":{{"value":<v>}},', v=column.cast("string")), F.lit(f'"{name}":{{}},'))

    def some(template: str, **values: Column) -> Column:
        return F.coalesce(_written(template, **values), nothing)

    escaped = F.to_json(F.struct(
        _value(F.concat(F.lit("Ward "), "l_returnflag")).alias("location"), _remarks().alias("listingRemarks"),
    ))
    return F.concat(
        F.lit('{"mlsId":{"value":"'),
        F.concat_ws("-", F.lit("M"), "l_orderkey", "l_linenumber"),
        F.lit('"},"mlsStatus":"'),
        F.when(open_house, "Active").otherwise("Sold"),
        F.lit('","lotSize":{"value":7000},"fullbaths":1,"stories":1.0,"state":"TX","countryCode":"US",'),
        value("price", price),
        F.when(flag != "N", value("hoa", line * 25)).otherwise(nothing),
        value("sqFt", F.expr("cast(l_quantity as int) * 100")),
        F.when(flag == "A", value("pricePerSqFt", line * 10)).otherwise(nothing),
        F.when(flag != "R", some('"partialBaths":<n>,', n=(line % 3).cast("string"))).otherwise(nothing),
        F.coalesce(
            _written(
                '"latLong":{"value":{"latitude":<lat>,"longitude":<lng>}},',
                lat=_number(F.col("l_tax") + 30), lng=_number(-F.col("l_tax") - 94),
            ),
            F.lit('"latLong":{"value":{}},'),
        ),
        F.coalesce(
            _written(
                '"streetLine":{"value":"<order> Main St"},"listingId":<order>,"scanUrl":"https://scan.example/<order>",', **text
            ),
            F.lit('"streetLine":{},'),
        ),
        F.coalesce(
            _written(
                '"city":"City <supplier>","postalCode":{"value":"<zip>"},"listingType":<type>,"dataSourceId":<source>,'
                '"yearBuilt":{"value":<year>},"has3DTour":<has3d>,"isActiveKeyListing":<active>,',
                **text, supplier=supplier.cast("string"), type=(supplier % 3).cast("string"), source=(supplier % 11).cast("string"),
                year=F.expr("cast(1950 + l_suppkey % 70 as int)").cast("string"),
                has3d=(supplier % 2 == 0).cast("string"), active=(supplier % 3 == 0).cast("string"),
            ),
            F.lit('"postalCode":{},"yearBuilt":{},'),
        ),
        some('"zip":"<zip><more>",', zip=zipcode, more=F.when(line == 7, "-1234").otherwise("")),
        some(
            '"beds":<line>,"baths":<baths>,"searchStatus":<search>,"propertyType":<line>,"uiPropertyType":<ui>,'
            '"hasVirtualTour":<virtual>,"hasVideoTour":<video>,',
            **text, baths=F.expr("cast(l_linenumber as double) / 2").cast("string"), search=(line % 4).cast("string"),
            ui=(line + 1).cast("string"), virtual=(line % 2 == 0).cast("string"), video=(line % 3 == 0).cast("string"),
        ),
        some(
            '"propertyId":<part>,"marketId":<market>,"url":"/TX/home/<part>","isNewConstruction":<new>,',
            **text, market=(part % 13).cast("string"), new=(part % 5 == 0).cast("string"),
        ),
        F.when(
            open_house,
            some(
                '"openHouseStartFormatted":"May <line>","openHouseEventName":"Open House - <line>",'
                '"posterFrameUrl":"https://poster.example/<line>",',
                **text,
            ),
        ).otherwise(nothing),
        some('"isHot":<hot>,', hot=open_house.cast("string")),
        F.substring(escaped, 2, NO_LIMIT),
    )


def _body(homes: Column, path: str) -> Column:
    *outer, leaf = path.split(".")
    head = "".join(f'{{"{part}":' for part in outer) + f'{{"{leaf}":['
    return F.concat(F.lit(PREFIX + head), homes, F.lit("]" + "}" * (len(outer) + 1)))


def body_of(homes: Column, path: str = "payload.homes") -> Column:
    """Prefix and JSON text with ``homes`` (JSON texts) put under ``path``."""
    return _body(F.concat_ws(",", homes), path)


def _response(body: Column, status: Column) -> list[Column]:
    seen = F.col("l_shipdate").cast("timestamp")
    return [
        zip_text(F.col("l_suppkey")).alias("zipcode"),
        F.concat(F.lit("https://api.example/"), F.col("l_orderkey").cast("string")).alias("source_url"),
        body.alias("raw_json"),
        status.cast("int").alias("http_status_code"),
        seen.alias("ingestion_timestamp"),
        F.to_date(seen).alias("processed_date"),
        F.hour(seen).alias("processed_hour"),
    ]


def as_responses(rows: DataFrame, path: str = "payload.homes", homes: Column | None = None) -> DataFrame:
    """Line items -> responses; works on a stream of line items just as well."""
    body = _body(home_text(), path) if homes is None else body_of(homes, path)
    return rows.select(*_response(body, F.lit(200)))


def responses(spark: SparkSession, sf_dir: str, path: str = "payload.homes") -> DataFrame:
    return as_responses(items(spark, sf_dir), path)


def pair_responses(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Two homes per response: the line item's, and the same at half the price."""
    half = F.expr("cast(l_extendedprice as bigint) div 2").cast("string")
    # The price is put into the text: a second object in one projection makes it so
    # long that the JVM no longer compiles it.
    price = F.concat(F.lit('"price":{"value":'), half, F.lit("}"))
    second = F.coalesce(F.regexp_replace("whole", F.lit(r'"price":\{[^}]*\}'), price), F.col("whole"))
    return as_responses(items(spark, sf_dir).withColumn("whole", home_text()), path, F.array(F.col("whole"), second))


def dirty_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every response, with one kind of defect per line number (1 is sound).

    2 error body, 3 cut off, 4 elements that are no homes beside the home,
    5 price null, 6 price missing, 7 single quotes.
    """
    kind = F.col("l_linenumber")
    # The price is cut from the text: a second object in one projection makes it so
    # long that the JVM no longer compiles it.
    bare = F.regexp_replace("whole", r'"price":\{[^}]*\},', "")
    sound = body_of(F.array(F.col("whole")))
    body = (
        F.when(kind == 2, error_body(F.lit("timed out")))
        .when(kind == 3, F.left(sound, F.length(sound) - 20))
        .when(kind == 4, body_of(F.array(F.lit("3"), F.lit("null"), F.col("whole"), F.lit('"x"'), F.lit("[1]"))))
        .when(kind == 5, body_of(F.array(F.concat(F.lit('{"price":null,'), F.substring(bare, 2, NO_LIMIT)))))
        .when(kind == 6, body_of(F.array(bare)))
        .when(kind == 7, body_of(F.array(F.lit("{'propertyId':1}"))))
        .otherwise(sound)
    )
    return items(spark, sf_dir).withColumn("whole", home_text()).select(
        *_response(body, F.when(kind == 2, 500).otherwise(200))
    )


def remarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long free text as listing remarks, one listing per document."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("propertyId"), F.col("text").alias("listingRemarks")
    )
