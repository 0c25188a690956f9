"""Schemas and fixed texts of the listing data model."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Listing column, its path inside one home object, its type.
# Names and types are the data model; they must stay as they are.
LISTING_FIELDS = (
    ("mls#", "mlsId.value", "string"),
    ("mls_status", "mlsStatus", "string"),
    ("house_price", "price.value", "bigint"),
    ("hoa", "hoa.value", "string"),
    ("sqft", "sqFt.value", "string"),
    ("price_per_sqft", "pricePerSqFt.value", "string"),
    ("lot_size", "lotSize.value", "string"),
    ("beds", "beds", "string"),
    ("baths", "baths", "string"),
    ("fullbaths", "fullbaths", "string"),
    ("partialBaths", "partialBaths", "string"),
    ("location", "location.value", "string"),
    ("stories", "stories", "string"),
    ("latitude", "latLong.value.latitude", "double"),
    ("longitude", "latLong.value.longitude", "double"),
    ("streetLine", "streetLine.value", "string"),
    ("city", "city", "string"),
    ("state", "state", "string"),
    ("zip", "zip", "string"),
    ("postalCode", "postalCode.value", "string"),
    ("countryCode", "countryCode", "string"),
    ("searchStatus", "searchStatus", "int"),
    ("propertyType", "propertyType", "int"),
    ("uiPropertyType", "uiPropertyType", "int"),
    ("listingType", "listingType", "int"),
    ("propertyId", "propertyId", "bigint"),
    ("listingId", "listingId", "bigint"),
    ("dataSourceId", "dataSourceId", "int"),
    ("marketId", "marketId", "int"),
    ("yearBuilt", "yearBuilt.value", "int"),
    ("openHouseStartFormatted", "openHouseStartFormatted", "string"),
    ("openHouseEventName", "openHouseEventName", "string"),
    ("url", "url", "string"),
    ("isHot", "isHot", "boolean"),
    ("hasVirtualTour", "hasVirtualTour", "boolean"),
    ("hasVideoTour", "hasVideoTour", "boolean"),
    ("has3DTour", "has3DTour", "boolean"),
    ("isActiveKeyListing", "isActiveKeyListing", "boolean"),
    ("isNewConstruction", "isNewConstruction", "boolean"),
    ("listingRemarks", "listingRemarks", "string"),
    ("scanUrl", "scanUrl", "string"),
    ("posterFrameUrl", "posterFrameUrl", "string"),
)

# Where the array of homes may lie in a response.
NEARBY_HOMES = "payload.homes"
EXACT_HOMES = "payload.originalHomes.homes"
NEARBY_HOMES_OLD = "payload.nearbyHomes.homes"

# Fixed value: characters in front of the JSON text of a response.
BODY_PREFIX_LENGTH = 4

# Fixed value: the text that is embedded, one hole per listing column.
EMBEDDING_TEMPLATE = (
    "Property Type: {propertyType}. "
    "Located in {location}, {city}, {state}, {countryCode}, ZIP {postalCode}. "
    "Built in {yearBuilt}, approximately {sqft} sqft on a {lot_size} sqft lot "
    "with {beds} bedrooms and {baths} bathrooms ({fullbaths} full, {partialBaths} partial). "
    "Listed price is ${house_price}. "
    "Stories: {stories}. "
    "Additional Features: {top_features}. "
    "Neighborhood population: {zip_population}, density: {zip_density}."
)
MISSING_TEXT = "N/A"

# Fixed value: the instruction put in front of a listing's remarks.
FEATURE_PROMPT = (
    "Extract the top 4 key features from the home description below as a comma-separated list. "
    "Example:\n"
    "Input: Very nice home with Spacious floor plan, Multiple living areas, Desirable location, "
    "Fenced and gated property. "
    "Output should be: Spacious floor plan, Multiple living areas, Desirable location, "
    "Fenced and gated property\n"
)
FEATURES_PER_LISTING = 4

# Workload settings.
AREAS_PER_BATCH = 100
UPSERT_CHUNK = 100
MAX_DAYS_BACK = 20
FIRST_WATERMARK = "1900-01-01 00:00:00"
DATE_HOUR = "yyyy-MM-dd-HH"
BATCH_STAMP = "yyyyMMdd_HHmmss"
# ---------------------------------------------------------------------------

# DDL texts, as readers and casts take them.
AREA_SCHEMA = (
    "zip string, lat double, lng double, state_id string, state_name string, "
    "population bigint, density double"
)
AREA_BATCH_SCHEMA = (
    "zip string, state_id string, state_name string, population string, batch_id string"
)
RESPONSE_SCHEMA = (
    "zipcode string, source_url string, raw_json string, http_status_code int, "
    "ingestion_timestamp timestamp, processed_date date, processed_hour int"
)
CONTROL_SCHEMA = (
    "last_processed_ts timestamp, last_pushed_ts timestamp, batch_id int"
)

LISTING_COLUMNS = ("search_zipcode",) + tuple(name for name, _, _ in LISTING_FIELDS)
