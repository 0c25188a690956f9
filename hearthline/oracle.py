"""SQL over the base tables that each query must agree with, value for value.

None of it goes through JSON, vectors or streams: it states what should come out.
"""

from __future__ import annotations


_ZIP = "lpad(cast({0} AS varchar), 9, '0')"


def _directory(name: str, table: str, prefix: str, key: str, nation: str) -> str:
    return f"""{name} AS (
  SELECT {_ZIP.format(prefix + key)} AS zip, {prefix}acctbal AS lat, -{prefix}acctbal AS lng,
         cast({prefix}{nation} AS varchar) AS state_id, replace(n_name, '_', ' ') AS state_name,
         CASE WHEN {prefix}{key} % 10 <> 0 THEN {prefix}{key} * 37 END AS population,
         {prefix}acctbal AS density
  FROM {table} JOIN nation ON {prefix}{nation} = n_nationkey)"""


_AREAS = _directory("areas", "customer", "c_", "custkey", "nationkey")
_LOCATIONS = _directory("locations", "supplier", "s_", "suppkey", "nationkey")

_PARSED = f"""parsed AS (
  SELECT {_ZIP.format("l_suppkey")} AS search_zipcode,
         'M-' || l_orderkey || '-' || l_linenumber AS mls,
         CASE WHEN l_linestatus = 'O' THEN 'Active' ELSE 'Sold' END AS mls_status,
         cast(trunc(l_extendedprice) AS bigint) AS house_price,
         CASE WHEN l_returnflag <> 'N' THEN cast(l_linenumber * 25 AS varchar) END AS hoa,
         cast(cast(trunc(l_quantity) AS int) * 100 AS varchar) AS sqft,
         CASE WHEN l_returnflag = 'A' THEN cast(l_linenumber * 10 AS varchar) END AS price_per_sqft,
         '7000' AS lot_size,
         cast(l_linenumber AS varchar) AS beds,
         cast(cast(l_linenumber AS double) / 2 AS varchar) AS baths,
         '1' AS fullbaths,
         CASE WHEN l_returnflag <> 'R' THEN cast(l_linenumber % 3 AS varchar) END AS "partialBaths",
         'Ward ' || l_returnflag AS location,
         '1.0' AS stories,
         l_tax + 30 AS latitude,
         -l_tax - 94 AS longitude,
         l_orderkey || ' Main St' AS "streetLine",
         'City ' || l_suppkey AS city,
         'TX' AS state,
         {_ZIP.format("l_suppkey")} || CASE WHEN l_linenumber = 7 THEN '-1234' ELSE '' END AS zip,
         {_ZIP.format("l_suppkey")} AS "postalCode",
         'US' AS "countryCode",
         cast(l_linenumber % 4 AS int) AS "searchStatus",
         l_linenumber AS "propertyType",
         cast(l_linenumber + 1 AS int) AS "uiPropertyType",
         cast(l_suppkey % 3 AS int) AS "listingType",
         l_partkey AS "propertyId",
         l_orderkey AS "listingId",
         cast(l_suppkey % 11 AS int) AS "dataSourceId",
         cast(l_partkey % 13 AS int) AS "marketId",
         cast(1950 + l_suppkey % 70 AS int) AS "yearBuilt",
         CASE WHEN l_linestatus = 'O' THEN 'May ' || l_linenumber END AS "openHouseStartFormatted",
         CASE WHEN l_linestatus = 'O' THEN 'Open House - ' || l_linenumber END AS "openHouseEventName",
         '/TX/home/' || l_partkey AS url,
         l_linestatus = 'O' AS "isHot",
         l_linenumber % 2 = 0 AS "hasVirtualTour",
         l_linenumber % 3 = 0 AS "hasVideoTour",
         l_suppkey % 2 = 0 AS "has3DTour",
         l_suppkey % 3 = 0 AS "isActiveKeyListing",
         l_partkey % 5 = 0 AS "isNewConstruction",
         'Part ' || l_partkey || ', flag ' || l_returnflag || '. Line ' || l_linenumber
           || ', , status ' || l_linestatus || chr(10) || ' quiet street, fenced yard' AS "listingRemarks",
         'https://scan.example/' || l_orderkey AS "scanUrl",
         CASE WHEN l_linestatus = 'O' THEN 'https://poster.example/' || l_linenumber END AS "posterFrameUrl",
         l_shipdate AS ingestion_timestamp,
         l_linenumber AS line
  FROM lineitem)"""

_LATEST = f"""{_PARSED}, latest AS (
  SELECT * EXCLUDE (mls, hoa, line), mls AS house_mls, coalesce(hoa, '0') AS hoa, 2026 - "yearBuilt" AS age,
         'Part ' || "propertyId" || ', flag ' || right(location, 1) || ', Line ' || line
           || ', status ' || CASE WHEN "isHot" THEN 'O' ELSE 'F' END AS top_features
  FROM parsed WHERE try_cast(zip AS double) IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY "propertyId" ORDER BY ingestion_timestamp DESC, mls DESC, house_price DESC) = 1)"""

_LOCATED = f"""{_LATEST}, {_LOCATIONS}, located AS (
  SELECT latest.*, lat AS zip_lat, lng AS zip_lng, population AS zip_population, density AS zip_density
  FROM latest JOIN locations ON latest.zip = locations.zip)"""

_TEXTS = f"""{_LOCATED}, texts AS (
  SELECT "propertyId", ingestion_timestamp,
         'Property Type: ' || "propertyType" || '. Located in ' || location || ', ' || city || ', ' || state
         || ', ' || "countryCode" || ', ZIP ' || "postalCode" || '. Built in ' || "yearBuilt"
         || ', approximately ' || sqft || ' sqft on a ' || lot_size || ' sqft lot with ' || beds
         || ' bedrooms and ' || baths || ' bathrooms (' || fullbaths || ' full, ' || coalesce("partialBaths", 'N/A')
         || ' partial). Listed price is $'
         || house_price || '. Stories: ' || stories || '. Additional Features: ' || top_features
         || '. Neighborhood population: ' || coalesce(cast(zip_population AS varchar), 'N/A')
         || ', density: ' || coalesce(cast(zip_population * 2 AS varchar), 'N/A') || '.' AS embedding_text
  FROM located)"""

_BRIEF = 'search_zipcode, mls, house_price, hoa, baths, zip, "propertyId", "yearBuilt", "isHot"'

_URL_COLUMNS = """zip, state_id, replace(state_name, ' ', '-') AS state_name,
  'https://api.example/search?zip=' || zip AS api_url,
  'https://www.example/zip/' || zip || '/' || state_id || '/' || replace(state_name, ' ', '-') AS refereral_url,
  '2026-01-31-13' AS processed_datehour"""

_SAMPLE = f"""WITH {_AREAS}
SELECT zip, state_id, state_name, {{population}} FROM areas
WHERE population IS NOT NULL ORDER BY md5(zip) LIMIT 100"""

_NOW = """TIMESTAMP '2026-01-31 13:45:00' AS ingestion_timestamp,
  DATE '2026-01-31' AS processed_date, 13 AS processed_hour"""

_TRANSPORTED = f"""WITH {_AREAS}, urls AS (SELECT {_URL_COLUMNS} FROM areas)
SELECT zip AS zipcode, api_url AS source_url,
  CASE WHEN zip LIKE '%3' THEN '{{"error": "timed out: ' || zip || '"}}'
       ELSE '{{}}&&{{"payload": {{"homes": [{{"propertyId": ' || cast(zip AS bigint) || ', "zip": "' || zip
         || '", "url": "' || refereral_url || '", "price": {{"value": ' || cast(zip AS bigint) * 7
         || '}}}}]}}}}' END AS raw_json,
  CASE WHEN zip LIKE '%3' THEN 500 WHEN zip LIKE '%5' THEN 404 ELSE 200 END AS http_status_code,
  {_NOW}
FROM urls"""


def _phrases(text: str) -> str:
    pieces = f"[trim(piece) FOR piece IN string_split_regex({text}, '[,.\\n]')]"
    return f"array_to_string(list_slice([piece FOR piece IN {pieces} IF piece <> ''], 1, 4), ', ')"


def _one_item(order: str) -> str:
    columns = "l_partkey, l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice"
    keys = ", ".join(f"{name} {order}" for name in columns.split(", ")[1:])
    return f"""SELECT {columns} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY {keys}) = 1"""


def _brief(where: str = "", price: str = "house_price") -> str:
    return f"WITH {_PARSED} SELECT {_BRIEF.replace('house_price', price)} FROM parsed {where}"


_REFERENCE = f"""WITH {_PARSED}
SELECT mls AS house_mls, "propertyId", house_price, coalesce(hoa, '0') AS hoa, "yearBuilt",
       2026 - "yearBuilt" AS age, zip
FROM parsed WHERE try_cast(zip AS double) IS NOT NULL"""

_FEATURES = f"SELECT doc_id AS \"propertyId\", {_phrases('text')} AS top_features FROM documents"

# Fixed values, stated here once more so that the SQL does not follow the code.
_PROMPT = (
    "Extract the top 4 key features from the home description below as a comma-separated list. "
    "Example:\n"
    "Input: Very nice home with Spacious floor plan, Multiple living areas, Desirable location, "
    "Fenced and gated property. "
    "Output should be: Spacious floor plan, Multiple living areas, Desirable location, "
    "Fenced and gated property\n"
)
_VIEW = """house_mls, mls_status, house_price, hoa, sqft, price_per_sqft, lot_size, beds, baths, fullbaths,
  "partialBaths", location, stories, latitude, longitude, "streetLine", city, state, zip, "propertyId", "yearBuilt",
  age, url, "isHot", "hasVirtualTour", "hasVideoTour", "has3DTour", "isNewConstruction", "listingRemarks\""""

ORACLE: dict[str, str] = {
    "url_build": f"WITH {_AREAS} SELECT {_URL_COLUMNS} FROM areas",
    "partitioned_write": f"WITH {_AREAS} SELECT {_URL_COLUMNS} FROM areas",
    "sample_by_hash": _SAMPLE.format(population="population"),
    "area_batch_export": _SAMPLE.format(
        population="cast(population AS varchar) AS population, '20260131_134500' AS batch_id"
    ),
    "area_copy": f"WITH {_AREAS} SELECT * FROM areas",
    "fetch_transport": _TRANSPORTED,
    "stream_fetch": _TRANSPORTED,
    "fetch_retried": f"""WITH {_AREAS}, urls AS (SELECT *, cast(zip AS bigint) % 4 AS failures FROM (SELECT {_URL_COLUMNS} FROM areas))
SELECT zip AS zipcode, api_url AS source_url,
  CASE WHEN failures = 3 THEN 'busy' ELSE 'answer ' || failures END AS raw_json,
  CASE WHEN failures = 3 THEN 503 ELSE 200 END AS http_status_code,
  TIMESTAMP '2026-01-31 13:45:00' + to_seconds(CASE failures WHEN 0 THEN 0 WHEN 1 THEN 60 ELSE 180 END) AS ingestion_timestamp,
  cast(least(failures + 1, 3) AS int) AS attempt
FROM urls""",
    "fetch_captured": f"""WITH {_AREAS}, urls AS (SELECT {_URL_COLUMNS} FROM areas), wanted AS (
  SELECT cast(page_id AS varchar) AS zip, url AS api_url FROM pages UNION ALL SELECT zip, api_url FROM urls)
SELECT zip AS zipcode, api_url AS source_url,
  coalesce(html, '{{"error":"no response for ' || api_url || '"}}') AS raw_json,
  CASE WHEN url IS NULL THEN 500 ELSE 200 END AS http_status_code, {_NOW}
FROM wanted LEFT JOIN pages ON api_url = url""",
    "parse_all_columns": f"WITH {_PARSED} SELECT * EXCLUDE (line) FROM parsed",
    "parse_listings_brief": _brief(),
    "parse_old_path": _brief(),
    "stream_parse": _brief(),
    "watermark_parse": _brief(),
    "parse_alt_path": f"""WITH {_PARSED}
SELECT {_BRIEF} FROM parsed UNION ALL
SELECT {_BRIEF.replace("house_price", "house_price // 2 AS house_price")} FROM parsed""",
    "parse_dirty": _brief("WHERE line IN (1, 4, 6)", "CASE WHEN line <> 6 THEN house_price END AS house_price"),
    "json_to_map": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "castable_filter": """WITH listed AS (
  SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN cast(c_custkey AS varchar)
    WHEN 'BUILDING' THEN c_custkey || '-1234' WHEN 'FURNITURE' THEN ''
    WHEN 'HOUSEHOLD' THEN '00' || c_custkey END AS zip FROM customer)
SELECT c_custkey, zip, try_cast(zip AS decimal(10,0)) IS NOT NULL AS numeric_too
FROM listed WHERE try_cast(zip AS double) IS NOT NULL""",
    "clean_defaults": _REFERENCE,
    "latest_per_key": _one_item("DESC"),
    "first_per_key": _one_item("ASC"),
    "any_per_key": """SELECT count(DISTINCT l_partkey) AS kept, count(DISTINCT l_partkey) AS keys,
  count(DISTINCT l_partkey) AS found FROM lineitem""",
    "latest_found_twice": f"""WITH {_LATEST}
SELECT "propertyId", house_mls, '9' || substr(search_zipcode, 2) AS search_zipcode, ingestion_timestamp FROM latest""",
    "store_compact": _one_item("DESC"),
    "push_chunks": """SELECT count(*) AS records, cast(sum(length(text)) AS bigint) AS chars, cast(0 AS bigint) AS too_large
FROM documents""",
    "sample_random": f"""WITH {_AREAS}, sample AS (SELECT least(100, count(*)) AS n FROM areas WHERE population IS NOT NULL)
SELECT n AS areas, n AS different, n AS populated FROM sample""",
    "latest_view": f"WITH {_LATEST} SELECT {_VIEW} FROM latest",
    "join_location": f"""WITH {_LOCATED}
SELECT zip, "propertyId", house_mls, house_price, zip_lat, zip_lng, zip_population, zip_density FROM located""",
    "located_view": f"""WITH {_LOCATED}
SELECT "propertyId", zip, house_price, age, zip_lat, zip_population FROM located""",
    "join_features": f"""WITH {_LATEST}, found AS ({_FEATURES})
SELECT latest."propertyId", house_mls, house_price, found.top_features
FROM latest JOIN found ON latest."propertyId" = found."propertyId\"""",
    "join_features_bucketed": f"""WITH {_LATEST}, found AS ({_FEATURES})
SELECT latest."propertyId", house_mls, house_price, found.top_features
FROM latest JOIN found ON latest."propertyId" = found."propertyId\"""",
    "profile_global": f"""WITH {_PARSED}
SELECT count(*) AS row_count, count(DISTINCT search_zipcode) AS total_zip_codes,
  count(DISTINCT "propertyId") AS total_property, count(DISTINCT "listingId") AS total_listings,
  count(DISTINCT ingestion_timestamp) AS total_run_hour, count(DISTINCT mls) AS mls_count FROM parsed""",
    "profile_daily": f"""WITH {_PARSED}
SELECT cast(ingestion_timestamp AS date) AS extracted_date, count(*) AS total_homes,
  count(DISTINCT mls) AS mls_unique_count, count(DISTINCT search_zipcode) AS search_zip_count,
  count(DISTINCT zip) AS total_zip_of_homes, count(DISTINCT "propertyId") AS total_properties
FROM parsed GROUP BY 1""",
    "profile_rollup": """SELECT cast(year(l_shipdate) AS int) AS extracted_year, count(*) AS total_rows,
  count(DISTINCT l_partkey) AS total_parts, count(DISTINCT l_suppkey) AS total_suppliers FROM lineitem GROUP BY 1""",
    "profile_raw": """SELECT count(*) AS total_rows, count(DISTINCT l_orderkey) AS total_sources,
  count(DISTINCT l_suppkey) AS total_zipcodes FROM lineitem""",
    "profile_located": f"""WITH {_LOCATED}
SELECT count(*) AS row_count, count(DISTINCT zip) AS total_zip_codes,
  count(DISTINCT "propertyId") AS total_property, count(DISTINCT house_mls) AS mls_count FROM located""",
    "status_monitor": """SELECT cast(ts AS date) AS processed_date, cast(hour(ts) AS int) AS processed_hour,
  event_type AS http_status_code, count(*) AS total_rows, count(DISTINCT user_id) AS total_zipcodes
FROM events GROUP BY 1, 2, 3""",
    "status_counts": """SELECT CASE WHEN l_linenumber = 2 THEN 500 ELSE 200 END AS http_status_code,
  count(*) AS total_rows, count(DISTINCT l_suppkey) AS total_zipcodes FROM lineitem GROUP BY 1""",
    "count_by_zip": f"WITH {_LATEST} SELECT zip, count(*) AS row_count FROM latest GROUP BY zip",
    "count_by_time": "SELECT l_shipdate AS ingested, count(*) AS total FROM lineitem GROUP BY 1",
    "distinct_limit": f"WITH {_PARSED} SELECT DISTINCT zip FROM parsed ORDER BY zip LIMIT 10",
    "select_new": """SELECT event_id AS "propertyId", user_id AS area, event_type AS top_features
FROM events WHERE ts >= TIMESTAMP '2024-01-14 06:30:00'""",
    "select_new_first_run": """SELECT event_id AS "propertyId", user_id AS area, event_type AS top_features
FROM events WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-28 09:00:00'""",
    "top_features": _FEATURES,
    "stream_features": _FEATURES,
    "feature_prompts": f"SELECT doc_id AS \"propertyId\", '{_PROMPT}' || text AS prompt FROM documents",
    "model_features": f"""SELECT doc_id AS "propertyId",
  CASE WHEN text IS NOT NULL THEN 'chars ' || ({len(_PROMPT)} + length(text)) END AS top_features
FROM documents""",
    "embedding_text": f'WITH {_TEXTS} SELECT "propertyId", embedding_text FROM texts',
    "vector_records": f'WITH {_TEXTS} SELECT cast("propertyId" AS varchar) AS id, embedding_text FROM texts',
    "vectorize": """WITH words AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM documents),
slots AS (
  SELECT doc_id, cast(cast('0x' || left(md5(word), 8) AS bigint) % 256 AS int) AS slot, count(*) AS n
  FROM words WHERE word <> '' GROUP BY 1, 2),
norms AS (SELECT doc_id, sqrt(cast(sum(n * n) AS double)) AS norm FROM slots GROUP BY 1)
SELECT doc_id, slot, round(cast(cast(n / norm AS real) AS double), 5) AS value FROM slots JOIN norms USING (doc_id)""",
    "upsert_replay": """SELECT cast(d.doc_id AS varchar) AS id,
  CASE WHEN l.doc_id IS NULL THEN source ELSE lang || ':' || n_chars END AS embedding_text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "vector_job": f"""WITH {_TEXTS}
SELECT 256 AS size, count(*) AS records, count(DISTINCT "propertyId") AS ids, cast(sum(length(embedding_text)) AS bigint) AS chars,
  2 AS pushes, DATE '2026-01-31' AS last_day FROM texts""",
    "cosine_topk": """WITH asked AS (
  SELECT vec_id AS query_id, embedding AS wanted FROM embeddings WHERE vec_id % 50 = 0),
scored AS (
  SELECT query_id, vec_id AS id,
    list_cosine_similarity(cast(embedding AS double[]), cast(wanted AS double[])) AS score
  FROM embeddings, asked)
SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS int) AS rank, id,
  round(score, 5) AS score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 5""",
    "stream_urls": f"""WITH {_AREAS}
SELECT {_URL_COLUMNS}, cast(population AS varchar) AS population FROM areas""",
    "stream_dedup": 'SELECT DISTINCT l_partkey AS "propertyId", cast(1 AS bigint) AS kept FROM lineitem WHERE l_linenumber <> 7',
    "stream_dedup_bounded": "SELECT DISTINCT user_id, cast(1 AS bigint) AS kept FROM events",
    "stream_join": f"""WITH {_PARSED}, {_LOCATIONS}
SELECT parsed.zip, mls AS house_mls, "propertyId", house_price, 2026 - "yearBuilt" AS age,
  lat AS zip_lat, population AS zip_population FROM parsed JOIN locations ON parsed.zip = locations.zip""",
    "stream_latest": f'WITH {_LATEST} SELECT "propertyId", house_mls, house_price, zip, age FROM latest',
    "stream_chain": f"""WITH {_AREAS}, urls AS (SELECT {_URL_COLUMNS} FROM areas)
SELECT cast(zip AS bigint) AS "propertyId", zip, cast(zip AS bigint) * 7 AS house_price, refereral_url AS url,
  '0' AS hoa, lat AS zip_lat, population AS zip_population, cast(NULL AS varchar) AS top_features
FROM urls JOIN areas USING (zip) WHERE zip NOT LIKE '%3'""",
    "flagship": f"""WITH {_LATEST}, {_LOCATIONS}
SELECT state_name, count(*) AS homes, cast(sum(house_price) AS bigint) AS total_price, max(house_price) AS max_price
FROM latest JOIN locations ON latest.zip = locations.zip GROUP BY state_name""",
}
# Other ways to the same rows.
ORACLE |= {
    "stream_dedup_keyed": ORACLE["stream_dedup"],
    "stream_join_salted": ORACLE["stream_join"],
    "model_features_kept": ORACLE["model_features"],
}
