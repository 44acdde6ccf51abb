"""SQL that computes what each registered query must return, on the same tables."""

from __future__ import annotations

from registry.tables import RARE_AGENTS, SECOND_BATCH, TOPIC, USER_AGENTS

ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S')"

VIEWS = f"""pv AS (
  SELECT e.event_id, {ISO.format('e.ts')} AS local_time,
         CAST(CAST(regexp_extract(e.props, '([0-9]+)', 1) AS INTEGER) % 5 AS VARCHAR)
           AS product_id,
         CASE WHEN e.user_id % 17 <> 2 THEN CAST(e.user_id % 10 AS VARCHAR) END AS store_id,
         CASE WHEN e.user_id % 23 = 3 THEN NULL
              WHEN e.user_id % 19 = 4 THEN ''
              WHEN e.user_id % 13 = 5 THEN 'direct'
              WHEN e.user_id % 11 = 6 THEN 'https://www.facebook.com/l?u=' || p.url
              WHEN e.user_id % 7 = 1 THEN 'https://www.google.com/search?q=' || e.event_type
              ELSE p.url END AS referrer_url,
         CASE WHEN e.event_id % 29 <> 0 THEN CAST(e.user_id AS VARCHAR) END AS device_id
  FROM events e
  JOIN pages p ON p.page_id = e.user_id % (SELECT count(*) FROM pages))"""

TEXT_VIEWS = """pv AS (
  SELECT event_id, local_time, coalesce(product_id, '') AS product_id,
         coalesce(store_id, '') AS store_id, coalesce(referrer_url, '') AS referrer_url,
         coalesce(device_id, '') AS device_id FROM nv)"""

SHIPPED = f"""pv AS (
  SELECT {ISO.format('CAST(l.l_shipdate AS TIMESTAMP)')} AS local_time,
         CAST(l.l_partkey AS VARCHAR) AS product_id, CAST(s.s_nationkey AS VARCHAR) AS store_id,
         p.url AS referrer_url, CAST(o.o_custkey AS VARCHAR) AS device_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN pages p ON p.page_id = l.l_suppkey % (SELECT count(*) FROM pages))"""

TYPE = """CASE WHEN contains(referrer_url, 'google') THEN 'Search Engine'
              WHEN contains(referrer_url, 'facebook') THEN 'Social Media'
              WHEN contains(referrer_url, 'direct') THEN 'Direct'
              ELSE 'Other' END"""
DOMAIN = "regexp_extract(referrer_url, 'https?://([^/]+)', 1)"


def member(natural: str, key: str) -> str:
    return (f"SELECT CAST(row_number() OVER (ORDER BY {natural}) AS BIGINT) AS {key}, {natural} "
            f"FROM (SELECT DISTINCT {natural} FROM pv WHERE {natural} IS NOT NULL)")


DIMS = f"""
dd AS (SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
              CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
              CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
              CAST(weekofyear(d) AS INTEGER) AS week_of_year,
              CAST(quarter(d) AS INTEGER) AS quarter
       FROM (SELECT TRY_CAST(substr(local_time, 1, 10) AS DATE) AS d FROM pv)
       WHERE d IS NOT NULL),
dp AS (SELECT product_key, product_id, 'Product ' || product_id AS product_name,
              TRUE AS is_active FROM ({member('product_id', 'product_key')})),
dc AS (SELECT country_key, store_id, 'Country ' || store_id AS country_name,
              'Unknown' AS region FROM ({member('store_id', 'country_key')})),
dr AS (SELECT referrer_key, referrer_url, {DOMAIN} AS referrer_domain,
              {TYPE} AS referrer_type FROM ({member('referrer_url', 'referrer_key')})),
dv AS (SELECT device_key, device_id, 'Unknown' AS device_type, 'Unknown' AS browser_info
       FROM ({member('device_id', 'device_key')}))"""

MEASURES = """count(*) AS view_count, count(DISTINCT pv.device_id) AS unique_visitors,
  max(CAST(replace(local_time, 'T', ' ') AS TIMESTAMP)) AS last_view_time,
  min(CAST(replace(local_time, 'T', ' ') AS TIMESTAMP)) AS first_view_time,
  avg(CAST(epoch(CAST(replace(local_time, 'T', ' ') AS TIMESTAMP)) AS BIGINT))
    AS avg_view_timestamp,
  CAST(epoch(max(CAST(replace(local_time, 'T', ' ') AS TIMESTAMP)))
     - epoch(min(CAST(replace(local_time, 'T', ' ') AS TIMESTAMP))) AS BIGINT)
    AS view_duration_seconds"""

FACT = f"""
ft AS (SELECT date_key, product_key, country_key, referrer_key, device_key, {MEASURES}
       FROM pv LEFT JOIN dd ON TRY_CAST(substr(local_time, 1, 10) AS DATE) = dd.date
       LEFT JOIN dp ON pv.product_id = dp.product_id
       LEFT JOIN dc ON pv.store_id = dc.store_id
       LEFT JOIN dr ON pv.referrer_url = dr.referrer_url
       LEFT JOIN dv ON pv.device_id = dv.device_id
       {{where}}
       GROUP BY date_key, product_key, country_key, referrer_key, device_key)"""
LATEST = "WHERE starts_with(local_time, (SELECT max(substr(local_time, 1, 10)) FROM pv))"
ALL_DATES = FACT.format(where="")
LATEST_DATE = FACT.format(where=LATEST)

STAR = f"WITH {VIEWS}, {DIMS}, {ALL_DATES}"
STAR_LATEST = f"WITH {VIEWS}, {DIMS}, {LATEST_DATE}"
STAR_SHIPPED = f"WITH {SHIPPED}, {DIMS}, {ALL_DATES}"
TEXT_PIPELINE = f"WITH {VIEWS.replace('pv AS', 'nv AS', 1)}, {TEXT_VIEWS}"

BY_DATE_PRODUCT = """SELECT dd.date, dp.product_name, CAST(sum(view_count) AS BIGINT) AS total_views,
  CAST(sum(unique_visitors) AS BIGINT) AS total_unique_visitors{extra}
  FROM ft JOIN dd ON ft.date_key = dd.date_key JOIN dp ON ft.product_key = dp.product_key
  GROUP BY dd.date, dp.product_name"""
COUNTRIES = """SELECT country_name, region, CAST(sum(view_count) AS BIGINT) AS total_views
  FROM ft JOIN dc ON ft.country_key = dc.country_key GROUP BY country_name, region
  ORDER BY total_views DESC, country_name, region LIMIT 10"""
TRAFFIC = """SELECT referrer_type, referrer_domain, CAST(sum(view_count) AS BIGINT) AS total_views,
  count(DISTINCT device_key) AS unique_devices
  FROM ft JOIN dr ON ft.referrer_key = dr.referrer_key GROUP BY referrer_type, referrer_domain"""
DISTINCT_DEVICES = ", count(DISTINCT device_key) AS distinct_devices"

NATURAL_FACT = f"""SELECT TRY_CAST(substr(local_time, 1, 10) AS DATE) AS date, product_id, store_id,
  referrer_url, device_id, {MEASURES} FROM pv GROUP BY ALL"""

TIMES = f"""tm AS (SELECT event_id,
  CASE WHEN event_id % 7 = 3 THEN 'zgarbage' WHEN event_id % 11 = 4 THEN ''
       WHEN event_id % 13 = 5 THEN '2024-02-30T10:00:00' WHEN event_id % 17 = 6 THEN NULL
       WHEN event_id % 19 = 7 THEN replace({ISO.format('ts')}, 'T', ' ')
       ELSE {ISO.format('ts')} END AS local_time FROM events)"""

MESSAGES = """msg AS (
  SELECT 0 AS "partition", event_id AS "offset",
    CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 23 = 1 THEN props || ' trailing'
         WHEN event_id % 19 = 2 THEN '  ' || props || chr(10)
         WHEN event_id % 17 = 3 THEN '[' || props || ']'
         WHEN event_id % 13 = 4 THEN substr(props, 1, 5) ELSE props END AS text FROM events
  UNION ALL SELECT 1, doc_id, text FROM documents
  UNION ALL SELECT 2, doc_id, CAST(quality AS VARCHAR) FROM labels
  UNION ALL SELECT 3, conv_id * 1000 + turn, CAST(to_json(text) AS VARCHAR) FROM conversations),
routed AS (SELECT *, CASE WHEN text IS NULL THEN 'error' WHEN NOT json_valid(text) THEN 'raw'
  WHEN json_type(text) = 'OBJECT' THEN 'doc' ELSE 'error' END AS route FROM msg)"""

ENVELOPE = f"""env AS (SELECT *, '{TOPIC}' AS topic, CAST(event_id % 3 AS INTEGER) AS "partition",
  event_id // 3 AS "offset" FROM pv)"""

# Views with odd dates: ``d`` is the date if its year has four digits, ``ts`` the time if any.
SEEDED = """sv AS (SELECT event_id, local_time, product_id, store_id, referrer_url, device_id,
    CASE WHEN year(TRY_CAST(substr(local_time, 1, 10) AS DATE)) <= 9999
      THEN TRY_CAST(substr(local_time, 1, 10) AS DATE) END AS d,
    CASE WHEN event_id % 53 <> 2 THEN TRY_CAST(replace(local_time, 'T', ' ') AS TIMESTAMP) END
      AS ts
  FROM (SELECT * REPLACE (CASE event_id % 53 WHEN 1 THEN '9999-12-31T00:00:00'
      WHEN 2 THEN '300000-1-1' WHEN 3 THEN '5000-01-01' WHEN 4 THEN 'nope'
      WHEN 5 THEN '2024-1-30' ELSE local_time END AS local_time) FROM pv))"""
SEEDED_LATEST = """d = (SELECT max(d) FROM sv WHERE d <= current_date + 1)"""
SEEDED_TEXT = "product_id, store_id, referrer_url, device_id"
SEEDED_COALESCED = ", ".join(f"coalesce({c}, '') AS {c}" for c in SEEDED_TEXT.split(", "))

# Keys of the documents of mixed shape, each with its type if all documents agree on it.
DISCOVERED = """WITH docs AS (SELECT CASE event_id % 6
    WHEN 0 THEN '{"product_id": ' || n || '}' WHEN 1 THEN '{"product_id": ' || n || '.50}'
    WHEN 2 THEN '{"product_id": "p' || n || '"}' WHEN 3 THEN '{"product_id": ' || props || '}'
    WHEN 4 THEN '{"product_id": null}' ELSE props END AS text
  FROM (SELECT event_id, props, regexp_extract(props, '([0-9]+)', 1) AS n FROM events)),
keys AS (SELECT unnest(json_keys(text)) AS key, text FROM docs),
types AS (SELECT key, CASE json_type(text, '$.' || key) WHEN 'UBIGINT' THEN 'BIGINT'
    WHEN 'BIGINT' THEN 'BIGINT' ELSE json_type(text, '$.' || key) END AS type FROM keys),
found AS (SELECT key, CASE WHEN count(DISTINCT type) = 1 THEN min(type) ELSE 'VARIANT' END AS type
  FROM types WHERE type <> 'NULL' GROUP BY key)
SELECT 'OBJECT<' || string_agg(key || ': ' || type, ', ' ORDER BY key) || '>' AS schema FROM found"""

BROKEN = """bf AS (SELECT event_id,
  CASE WHEN event_id % 41 <> 5 THEN CAST(replace(substr(local_time, 1, 10), '-', '') AS INTEGER)
    END AS date_key,
  CASE WHEN event_id % 31 <> 4 THEN CAST(product_id AS BIGINT) END AS product_key,
  CAST(store_id AS BIGINT) AS country_key, CAST(device_id AS BIGINT) AS device_key,
  CASE WHEN event_id % 37 = 6 THEN event_id * 3000000000 ELSE event_id END AS view_count,
  CAST(CASE WHEN event_id % 43 = 7 THEN 123456789012 ELSE event_id END AS DECIMAL(20,3)) AS price
  FROM pv)"""

URLS = r"""cu AS (SELECT page_id, CASE page_id % 9
    WHEN 0 THEN 'http://' || h || '.VN' || r WHEN 1 THEN 'https://' || h || '.vn.shop' || r
    WHEN 2 THEN '//u@' || h || '.fr?q=1' WHEN 3 THEN h || '.de' || r
    WHEN 4 THEN 'http://' || h || '.co.uk:80' || r
    WHEN 5 THEN ' ' || chr(9) || 'http://' || h || '.us#top'
    WHEN 6 THEN 'http://[::1' || r WHEN 7 THEN NULL ELSE url END AS url
  FROM (SELECT page_id, url, regexp_replace(url, '^https?://[^/]*', '') AS r,
               regexp_extract(url, '//([^/]*)', 1) AS h FROM pages)),
hosts AS (SELECT *, string_split(regexp_extract(replace(ltrim(url, ' ' || chr(9)), chr(9), ''),
  '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1), '.') AS parts FROM cu)"""


def agent_oracle(agents=USER_AGENTS, **positions: int) -> str:
    def family(position: int) -> str:
        families = ", ".join(f"'{agent[position]}'" for agent in agents)
        return (f"coalesce(list_extract([{families}], "
                f"CAST(event_id % {len(agents) + 1} AS INTEGER) + 1), 'unknown')")
    columns = ", ".join(f"{family(position)} AS {name}" for name, position in positions.items())
    return f"SELECT event_id, {columns} FROM events"


def device_agents_oracle() -> str:
    def family(position: int) -> str:
        families = ", ".join(f"'{agent[position]}'" for agent in USER_AGENTS)
        return (f"coalesce(list_extract([{families}], CAST(sent % {len(USER_AGENTS) + 1} "
                "AS INTEGER) + 1), 'unknown')")
    # The last template number stands for no user agent at all.
    return f"""{STAR} SELECT dv.device_key, dv.device_id, 'Unknown' AS device_type,
        {family(1)} AS browser_info, {family(2)} AS os_info
        FROM dv LEFT JOIN (SELECT device_id, max(event_id) AS sent FROM pv
          WHERE event_id % {len(USER_AGENTS) + 1} <> {len(USER_AGENTS)} GROUP BY device_id) a
        ON a.device_id = dv.device_id"""


#: Three runs of a thousand messages each.
FIRST_THOUSANDS = f"""WITH {VIEWS}, {ENVELOPE}
    SELECT topic, "partition", "offset" FROM (SELECT *, row_number() OVER (
      ORDER BY topic, "partition", "offset") AS n FROM env) WHERE n <= 3000"""


def oracle_sql() -> dict[str, str]:
    number = "regexp_extract(props, '([0-9]+)', 1)"
    return {
        # sources and ingest
        "src_empty": f"{TEXT_PIPELINE} {NATURAL_FACT}",
        "ingest_bounded": f"""WITH {VIEWS}, {ENVELOPE}
            SELECT topic, "partition", "offset" FROM (SELECT *, row_number() OVER (
              ORDER BY topic, "partition", "offset") AS n FROM env) WHERE n <= 5000""",
        "ingest_resume": f"""WITH {VIEWS}, {ENVELOPE}
            SELECT topic, "partition", max("offset") + 1 AS next_offset FROM (
              SELECT *, row_number() OVER (ORDER BY topic, "partition", "offset") AS n
              FROM env) WHERE n <= 5000 GROUP BY topic, "partition" """,
        "ingest_capped_runs": FIRST_THOUSANDS,
        "bridge_capped_runs": FIRST_THOUSANDS,
        "ingest_capped_to_the_end": f"""WITH {MESSAGES}
            SELECT "partition", "offset", route FROM routed""",
        "landing_compacted": f"""WITH {MESSAGES}
            SELECT "partition", "offset", route FROM routed""",
        "topic_counts": f"""WITH {VIEWS}, {ENVELOPE}
            SELECT topic, "partition", count(*) AS messages, min("offset") AS first_offset,
              max("offset") AS last_offset FROM env GROUP BY topic, "partition" """,
        "dump_scan": f"""{TEXT_PIPELINE}, {ENVELOPE} SELECT concat_ws('-', topic, "partition",
            "offset") AS _id, local_time, product_id, store_id, referrer_url, device_id FROM env""",
        "landing_scan": f"""{TEXT_PIPELINE} SELECT local_time, product_id, store_id, referrer_url,
            device_id FROM pv""",
        "landing_latest": f"""{TEXT_PIPELINE} SELECT local_time, product_id, store_id,
            referrer_url, device_id FROM pv {LATEST}""",
        "warehouse_scan": f"{STAR} SELECT referrer_key, referrer_url FROM dr",
        # normalisation
        "norm_decode": """SELECT event_id, CASE WHEN event_id % 3 = 0
            THEN event_type || chr(65533) || props ELSE event_type || props END AS text
            FROM events""",
        "norm_nested_json": f"""SELECT event_id, '{{"k":' || {number} || '}}' AS props,
            '["' || event_type || '","' || CAST(user_id AS VARCHAR) || '"]' AS tags,
            event_type FROM events""",
        "norm_null_to_empty": f"{TEXT_PIPELINE} SELECT * FROM pv",
        "norm_union_keys": """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
              '' AS page_id, '' AS url, '' AS conv_id, '' AS role FROM events
            UNION ALL SELECT '', '', CAST(page_id AS VARCHAR), url, '', '' FROM pages
            UNION ALL SELECT '', '', '', '', CAST(conv_id AS VARCHAR), role
              FROM conversations""",
        "norm_mixed_type": f"""SELECT event_id, CASE event_id % 6 WHEN 0 THEN {number}
            WHEN 1 THEN {number} || '.5' WHEN 2 THEN 'p' || {number}
            WHEN 3 THEN '{{"k":' || {number} || '}}' ELSE '' END AS product_id FROM events""",
        "norm_discover": DISCOVERED,
        "norm_evolving_keys": f"""SELECT event_id, CASE event_id % 6 WHEN 0 THEN {number}
            WHEN 1 THEN {number} || '.5' WHEN 2 THEN 'p' || {number}
            WHEN 3 THEN '{{"k":' || {number} || '}}' END AS product_id,
            CASE WHEN event_id % 6 = 0 THEN CAST({number} AS BIGINT)
              WHEN event_id % 6 = 1 THEN CAST({number} AS BIGINT) END AS whole_product_id,
            CASE WHEN event_id % 6 = 5 THEN CAST({number} AS BIGINT) END AS k FROM events""",
        "norm_key_registry": DISCOVERED.rpartition("SELECT 'OBJECT<'")[0]
            + "SELECT key, type FROM found",
        "route_json": f'WITH {MESSAGES} SELECT "partition", "offset", route FROM routed',
        "route_outcomes": f"""WITH {MESSAGES}
            SELECT route, count(*) AS messages FROM routed GROUP BY route""",
        # predicates and the report date
        "filter_valid_date": f"""WITH {TIMES} SELECT event_id,
            TRY_CAST(substr(local_time, 1, 10) AS DATE) AS date FROM tm
            WHERE TRY_CAST(substr(local_time, 1, 10) AS DATE) IS NOT NULL""",
        "undated_events": f"""WITH {TIMES} SELECT event_id, local_time FROM tm
            WHERE TRY_CAST(substr(local_time, 1, 10) AS DATE) IS NULL""",
        "report_date": f"""WITH {TIMES} SELECT CAST(max(TRY_CAST(substr(local_time, 1, 10)
            AS DATE)) AS VARCHAR) AS report_date FROM tm""",
        "filter_report_date": f"""WITH {VIEWS} SELECT event_id, local_time FROM pv {LATEST}""",
        "report_date_fallback": f"""WITH {TIMES} SELECT CAST(coalesce(
            max(TRY_CAST(substr(local_time, 1, 10) AS DATE)), DATE '2024-06-30') AS VARCHAR)
            AS report_date FROM tm WHERE TRY_CAST(substr(local_time, 1, 10) AS DATE) IS NULL""",
        "seeded_report_date": f"""WITH {VIEWS}, {SEEDED}
            SELECT event_id, local_time FROM sv WHERE {SEEDED_LATEST}""",
        "seeded_landing_report_date": f"""WITH {VIEWS}, {SEEDED}
            SELECT local_time, coalesce(product_id, '') AS product_id,
              coalesce(store_id, '') AS store_id, coalesce(referrer_url, '') AS referrer_url,
              coalesce(device_id, '') AS device_id FROM sv WHERE {SEEDED_LATEST}""",
        # dimensions
        "dim_date": f"{STAR} SELECT * FROM dd",
        "dim_product": f"{STAR} SELECT * FROM dp",
        "dim_country": f"{STAR} SELECT * FROM dc",
        "dim_referrer": f"{STAR} SELECT * FROM dr",
        "dim_device": f"{STAR} SELECT * FROM dv",
        "dim_device_agents": device_agents_oracle(),
        "dim_referrer_shipped": f"{STAR_SHIPPED} SELECT * FROM dr",
        # facts
        "fact_latest": f"{STAR_LATEST} SELECT * FROM ft",
        "fact_all_dates": f"{STAR} SELECT * FROM ft",
        "fact_shipped": f"{STAR_SHIPPED} SELECT * FROM ft",
        "fact_spread_lookup": f"{STAR} SELECT * FROM ft",
        "fact_missing_members": f"""WITH {VIEWS}, {DIMS.replace(
            "FROM (SELECT DISTINCT device_id FROM pv WHERE device_id IS NOT NULL)",
            "FROM (SELECT DISTINCT device_id FROM pv WHERE device_id IS NOT NULL "
            f"AND local_time < '{SECOND_BATCH}')").replace(
            "FROM (SELECT DISTINCT referrer_url FROM pv WHERE referrer_url IS NOT NULL)",
            "FROM (SELECT DISTINCT referrer_url FROM pv WHERE contains(referrer_url, 'g'))")},
            {ALL_DATES} SELECT * FROM ft""",
        "fact_hash_keys": f"""{STAR} SELECT date_key, view_count, unique_visitors, last_view_time,
            first_view_time, avg_view_timestamp, view_duration_seconds,
            product_key IS NULL AS no_product, country_key IS NULL AS no_country,
            referrer_key IS NULL AS no_referrer, device_key IS NULL AS no_device FROM ft""",
        "fact_key": f"""{STAR} SELECT CAST(date_key AS BIGINT) * 10000000000 + row_number() OVER (
            PARTITION BY date_key ORDER BY product_key NULLS FIRST, country_key NULLS FIRST,
            referrer_key NULLS FIRST, device_key NULLS FIRST) AS fact_key, date_key, product_key,
            country_key, referrer_key, device_key FROM ft""",
        # reports
        "views_by_date_product": f"{STAR} {BY_DATE_PRODUCT.format(extra='')}",
        "views_by_date_product_distinct":
            f"{STAR} {BY_DATE_PRODUCT.format(extra=DISTINCT_DEVICES)}",
        "views_by_date_product_latest": f"{STAR_LATEST} {BY_DATE_PRODUCT.format(extra='')}",
        "top_countries": f"{STAR} {COUNTRIES}",
        "top_countries_latest": f"{STAR_LATEST} {COUNTRIES}",
        "traffic_sources": f"{STAR} {TRAFFIC}",
        "traffic_sources_latest": f"{STAR_LATEST} {TRAFFIC}",
        "traffic_sources_shipped": f"{STAR_SHIPPED} {TRAFFIC}",
        "traffic_sources_approximate": f"""{STAR} SELECT referrer_type, referrer_domain,
            CAST(sum(view_count) AS BIGINT) AS total_views, TRUE AS close
            FROM ft JOIN dr ON ft.referrer_key = dr.referrer_key
            GROUP BY referrer_type, referrer_domain""",
        "devices_between": f"""WITH {VIEWS} SELECT product_id,
            count(DISTINCT device_id) AS devices, TRUE AS close FROM pv
            WHERE substr(local_time, 1, 10) BETWEEN '2024-01-06' AND '2024-01-15'
            GROUP BY product_id""",
        "row_counts": f"""{STAR} SELECT 'dim_date' AS table_name, count(*) AS count FROM dd
            UNION ALL SELECT 'dim_product', count(*) FROM dp
            UNION ALL SELECT 'dim_country', count(*) FROM dc
            UNION ALL SELECT 'dim_referrer', count(*) FROM dr
            UNION ALL SELECT 'dim_device', count(*) FROM dv
            UNION ALL SELECT 'fact_product_views', count(*) FROM ft""",
        # URL and user-agent functions
        "url_country": f"""WITH {URLS} SELECT page_id, CASE
            WHEN url IS NULL OR contains(url, '[') THEN 'unknown'
            WHEN len(parts) >= 2 AND length(parts[-1]) = 2 THEN lower(parts[-1])
            WHEN len(parts) >= 3 AND length(parts[-2]) = 2 THEN lower(parts[-2])
            ELSE 'unknown' END AS country FROM hosts""",
        "ua_browser": agent_oracle(browser=1),
        "ua_os": agent_oracle(os=2),
        "ua_products": agent_oracle(RARE_AGENTS, browser=1, system=2),
        "ua_spread": agent_oracle(RARE_AGENTS, browser=1, system=2),
        # keys
        "key_dense": """SELECT natural_key, CAST(row_number() OVER (ORDER BY natural_key) AS BIGINT)
            AS key FROM (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS natural_key
            FROM orders)""",
        "key_dense_within": """SELECT l_shipdate, l_orderkey, l_linenumber, CAST(row_number() OVER (
            PARTITION BY l_shipdate ORDER BY l_orderkey, l_linenumber) AS BIGINT) AS number
            FROM lineitem""",
        "key_hash": """SELECT natural_key, count(*) AS members FROM (
            SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS natural_key FROM orders)
            GROUP BY natural_key""",
        "key_incremental": f"""WITH {VIEWS}, old AS (SELECT referrer_url, row_number() OVER (
              ORDER BY referrer_url) AS referrer_key FROM (SELECT DISTINCT referrer_url FROM pv
              WHERE referrer_url IS NOT NULL AND local_time < '{SECOND_BATCH}'
                AND product_id = '1')),
            new AS (SELECT referrer_url, row_number() OVER (ORDER BY referrer_url)
              + (SELECT max(referrer_key) FROM old) AS referrer_key
              FROM (SELECT DISTINCT referrer_url FROM pv WHERE referrer_url IS NOT NULL
                AND referrer_url NOT IN (SELECT referrer_url FROM old)))
            SELECT * FROM old UNION ALL SELECT * FROM new""",
        # constraints
        "chk_unique": f"""WITH {VIEWS}, {BROKEN} SELECT date_key, product_key, country_key,
            device_key, count(*) AS rows FROM bf WHERE date_key IS NOT NULL
            AND product_key IS NOT NULL AND country_key IS NOT NULL AND device_key IS NOT NULL
            GROUP BY ALL HAVING count(*) > 1""",
        "chk_not_null": f"""WITH {VIEWS}, {BROKEN} SELECT event_id, date_key, product_key FROM bf
            WHERE date_key IS NULL OR product_key IS NULL""",
        "chk_fk": """SELECT l_orderkey, l_linenumber, suppkey FROM (SELECT l_orderkey, l_linenumber,
            CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS suppkey FROM lineitem)
            WHERE suppkey IS NOT NULL AND suppkey NOT IN (
              SELECT s_suppkey FROM supplier WHERE s_nationkey <> 7)""",
        "chk_length": "SELECT doc_id, length(text) AS length FROM documents WHERE length(text) > 255",
        "chk_narrowing": f"""WITH {VIEWS}, {BROKEN} SELECT event_id, 'view_count' AS column_name
            FROM bf WHERE TRY_CAST(view_count AS INTEGER) IS NULL
            UNION ALL SELECT event_id, 'price' FROM bf
            WHERE TRY_CAST(price AS DECIMAL(10,2)) IS NULL""",
        "chk_url_guard": """SELECT page_id, length(url) > 48 AS quarantined FROM pages""",
        "chk_row_violations": f"""WITH {VIEWS}, {BROKEN} SELECT event_id, broken FROM (
            SELECT event_id, concat_ws('; ',
              CASE WHEN date_key IS NULL THEN 'date_key: null' END,
              CASE WHEN product_key IS NULL THEN 'product_key: null' END,
              CASE WHEN TRY_CAST(view_count AS INTEGER) IS NULL
                THEN 'view_count: does not fit' END) AS broken FROM bf) WHERE broken <> ''""",
        "align_defaults": f"""{STAR} SELECT product_key, product_id, product_name,
            CAST(NULL AS VARCHAR) AS category, CAST(NULL AS DECIMAL(10,2)) AS price, is_active
            FROM dp""",
        "align_fact": f"""{STAR} SELECT date_key, product_key, country_key, referrer_key, device_key,
            CAST(view_count AS INTEGER) AS view_count,
            CAST(unique_visitors AS INTEGER) AS unique_visitors,
            CAST(view_duration_seconds AS INTEGER) AS view_duration_seconds, avg_view_timestamp,
            first_view_time, last_view_time, 'kafka_mongodb' AS data_source,
            CAST(NULL AS VARCHAR) AS batch_id FROM ft""",
        # whole jobs
        "write_partition_overwrite": f"{TEXT_PIPELINE} {NATURAL_FACT}",
        "write_replace": f"{TEXT_PIPELINE} {NATURAL_FACT}",
        "write_bucketed_dimensions": f"{TEXT_PIPELINE} {NATURAL_FACT}",
        "write_interrupted": f"{TEXT_PIPELINE} {NATURAL_FACT}",
        "write_two_runs": f"{TEXT_PIPELINE} {NATURAL_FACT}",
        "write_hash_keys": f"{TEXT_PIPELINE} {NATURAL_FACT}",
        "write_seeded_dates": f"""WITH {VIEWS}, {SEEDED}
            SELECT d AS date, {SEEDED_TEXT}, count(*) AS view_count,
              count(DISTINCT coalesce(device_id, '')) AS unique_visitors,
              max(ts) AS last_view_time, min(ts) AS first_view_time,
              avg(CAST(epoch(ts) AS BIGINT)) AS avg_view_timestamp,
              CAST(epoch(max(ts)) - epoch(min(ts)) AS BIGINT) AS view_duration_seconds
            FROM (SELECT * REPLACE ({SEEDED_COALESCED}) FROM sv) WHERE d IS NOT NULL
            GROUP BY ALL""",
        "write_undated": f"""WITH {VIEWS}, {SEEDED}
            SELECT {SEEDED_TEXT}, count(*) AS views
            FROM (SELECT * REPLACE ({SEEDED_COALESCED}) FROM sv) WHERE d IS NULL GROUP BY ALL""",
        "write_user_agents": f"""WITH {VIEWS} SELECT DISTINCT coalesce(device_id, '') AS device_id,
            CASE CAST(device_id AS BIGINT) % 4 WHEN 0 THEN 'curl' WHEN 1 THEN 'Other'
              WHEN 2 THEN 'Chrome' ELSE 'unknown' END AS browser_info,
            CASE CAST(device_id AS BIGINT) % 4 WHEN 0 THEN 'Other' WHEN 1 THEN 'Other'
              WHEN 2 THEN 'Windows' ELSE 'unknown' END AS os_info FROM pv""",
        "stream_bridge": f"""WITH {VIEWS}, {ENVELOPE} SELECT topic, "partition", "offset",
            local_time, product_id, store_id, referrer_url, device_id FROM env""",
        "stream_dead_letters": f"""WITH {MESSAGES} SELECT "partition", "offset" FROM routed
            WHERE text IS NULL OR NOT json_valid(text)""",
        "stream_landing": f"""WITH {VIEWS}, {ENVELOPE} SELECT topic, "partition", "offset",
            'doc' AS route, local_time, product_id, store_id, referrer_url, device_id,
            CAST(substr(local_time, 1, 10) AS DATE) AS event_date FROM env""",
        "landing_ids": f"""WITH {VIEWS}, {ENVELOPE} SELECT concat_ws('-', topic, "partition",
            "offset") AS _id, topic, "partition", "offset" FROM env""",
        "landing_counts": f"""WITH {MESSAGES}
            SELECT route, count(*) AS messages FROM routed GROUP BY route""",
        "stream_outcomes": f"""WITH {MESSAGES}
            SELECT route, count(*) AS messages FROM routed GROUP BY route""",
        "stream_resume": f"""WITH {MESSAGES}
            SELECT "partition", "offset", route FROM routed""",
        "stream_landing_mixed": f"""WITH {MESSAGES}
            SELECT "partition", "offset", route FROM routed""",
        "stream_star_refresh": f"{TEXT_PIPELINE} {NATURAL_FACT}",
        "stream_refresh_late": f"{TEXT_PIPELINE} {NATURAL_FACT}",
        "stream_refresh_violations": f"""{TEXT_PIPELINE} {NATURAL_FACT.replace(
            "FROM pv", "FROM pv WHERE event_id % 50 <> 7")}""",
    }
