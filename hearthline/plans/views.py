"""The chain as SQL views: latest listing per property, then its location.

For users who work in SQL.  Each view is declared over the one before; Spark
inlines them, so a query on the last is one plan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

# The columns of the view of latest listings.
VIEW_COLUMNS = (
    "house_mls",
    "mls_status",
    "house_price",
    "hoa",
    "sqft",
    "price_per_sqft",
    "lot_size",
    "beds",
    "baths",
    "fullbaths",
    "partialBaths",
    "location",
    "stories",
    "latitude",
    "longitude",
    "streetLine",
    "city",
    "state",
    "zip",
    "propertyId",
    "yearBuilt",
    "age",
    "url",
    "isHot",
    "hasVirtualTour",
    "hasVideoTour",
    "has3DTour",
    "isNewConstruction",
    "listingRemarks",
)


def latest_listings_view(spark: SparkSession, parsed: DataFrame, as_of: date | None = None) -> DataFrame:
    """Numeric zips only, defaults set, the latest row of each property.

    Of rows with one time the highest MLS number wins, then the highest price, listing
    and searched zip, then a hash over the row.
    """
    day = "current_date()" if as_of is None else f"DATE '{as_of:%Y-%m-%d}'"
    return spark.sql(
        f"""
        WITH ranked AS (
          SELECT * EXCEPT (hoa),
                 `mls#` AS house_mls,
                 coalesce(hoa, '0') AS hoa,
                 extract(YEAR FROM {day}) - yearBuilt AS age,
                 row_number() OVER (
                   PARTITION BY propertyId
                   ORDER BY ingestion_timestamp DESC, `mls#` DESC, house_price DESC, listingId DESC,
                     search_zipcode DESC, xxhash64(*) DESC
                 ) AS newest
          FROM {{parsed}}
          WHERE try_cast(zip AS NUMERIC) IS NOT NULL
        )
        SELECT {", ".join(VIEW_COLUMNS)} FROM ranked WHERE newest = 1
        """,
        parsed=parsed,
    )


def located_listings_view(spark: SparkSession, latest: DataFrame, areas: DataFrame) -> DataFrame:
    """Latest listings with the statistics of their zip."""
    return spark.sql(
        """
        SELECT latest.*, areas.lat AS zip_lat, areas.lng AS zip_lng,
               areas.population AS zip_population, areas.density AS zip_density
        FROM {latest} AS latest JOIN {areas} AS areas ON latest.zip = areas.zip
        """,
        latest=latest,
        areas=areas,
    )


def declare_views(
    spark: SparkSession, parsed: DataFrame, areas: DataFrame, as_of: date | None = None
) -> tuple[str, str]:
    """Register both as temporary views and return their names."""
    names = ("latest_listings", "located_listings")
    latest = latest_listings_view(spark, parsed, as_of)
    latest.createOrReplaceTempView(names[0])
    located_listings_view(spark, latest, areas).createOrReplaceTempView(names[1])
    return names
