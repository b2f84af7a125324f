"""The catalog's queries as plain SQL over the same tables."""

from __future__ import annotations

NS = "http://example.org/kg/"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
XSD = "http://www.w3.org/2001/XMLSchema#"


def _week(c: str) -> str:
    day = f"(CAST({c} AS DATE) - CAST(dayofweek({c}) AS INTEGER) + 4)"
    return f"isoyear({day}) || '-W' || lpad(CAST(weekofyear({day}) AS VARCHAR), 2, '0')"


_SOURCES = f"""
placed AS (
  SELECT *, 'Nation ' || c_nationkey AS district_canonical, {_week('o_orderdate')} AS epi_week_key
  FROM orders JOIN customer ON o_custkey = c_custkey
), cases AS (
  SELECT o_orderkey AS record_id, district_canonical, epi_week_key, o_orderstatus AS disease,
    CAST(greatest(0, trunc(o_totalprice)) AS BIGINT) AS case_count
  FROM placed
), weather AS (
  SELECT 'Nation ' || s_nationkey AS district_canonical, {_week('l_shipdate')} AS epi_week_key,
    l_quantity AS temperature_c, l_extendedprice AS humidity_pct,
    l_discount AS precipitation_mm, l_tax AS wind_speed_kmh
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
), alerts AS (
  SELECT district_canonical, epi_week_key,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS VARCHAR) END AS alert_id,
    o_orderstatus AS event_type, nullif(c_mktsegment, 'BUILDING') AS severity
  FROM placed WHERE o_orderpriority = '1-URGENT'
), policy AS (
  SELECT p_name || ' ' || p_partkey AS title, p_brand AS status FROM part
), means AS (
  SELECT district_canonical, epi_week_key,
    round(avg(temperature_c), 6) AS avg_temperature_c, round(avg(humidity_pct), 6) AS avg_humidity_pct,
    round(avg(precipitation_mm), 6) AS avg_precipitation_mm, round(avg(wind_speed_kmh), 6) AS avg_wind_speed_kmh
  FROM weather GROUP BY ALL
), events_by_week AS (
  SELECT district_canonical, epi_week_key, count(alert_id) AS disaster_event_count,
    mode(severity ORDER BY severity) AS max_severity, max(severity) AS top_severity,
    string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS event_types
  FROM alerts GROUP BY district_canonical, epi_week_key
), linked AS (
  SELECT c.*, m.* EXCLUDE (district_canonical, epi_week_key),
    e.* EXCLUDE (district_canonical, epi_week_key), coalesce(e.disaster_event_count, 0) > 0 AS has_concurrent_disaster
  FROM cases c LEFT JOIN means m USING (district_canonical, epi_week_key)
    LEFT JOIN events_by_week e USING (district_canonical, epi_week_key)
)"""

_KG_PARTS = {
    "cases": f"""
  SELECT '{NS}district/' || replace(district_canonical, ' ', '_') s, '{RDF_TYPE}' p, '{NS}District' o, 'iri' o_kind, NULL o_datatype FROM cases
  UNION SELECT '{NS}disease/' || disease, '{RDF_TYPE}', '{NS}Disease', 'iri', NULL FROM cases
  UNION SELECT '{NS}district/' || replace(district_canonical, ' ', '_'), '{NS}hasDisease', '{NS}disease/' || disease, 'iri', NULL FROM cases
  UNION SELECT '{NS}district/' || replace(district_canonical, ' ', '_'), '{NS}caseCount', CAST(case_count AS VARCHAR), 'literal', '{XSD}integer' FROM cases""",
    "weather": f"""
  SELECT '{NS}district/' || replace(district_canonical, ' ', '_') s, '{NS}temperature' p, CAST(temperature_c AS VARCHAR) o, 'literal' o_kind, '{XSD}double' o_datatype FROM weather
  UNION SELECT '{NS}district/' || replace(district_canonical, ' ', '_'), '{NS}humidity', CAST(humidity_pct AS VARCHAR), 'literal', '{XSD}double' FROM weather""",
    "alerts": f"""
  SELECT '{NS}disaster/' || event_type s, '{RDF_TYPE}' p, '{NS}Disaster' o, 'iri' o_kind, NULL o_datatype FROM alerts
  UNION SELECT '{NS}district/' || replace(district_canonical, ' ', '_'), '{NS}hasDisaster', '{NS}disaster/' || event_type, 'iri', NULL FROM alerts
  UNION SELECT '{NS}district/' || replace(district_canonical, ' ', '_'), '{NS}severity', severity, 'literal', NULL FROM alerts WHERE severity IS NOT NULL""",
    "policy": f"""
  SELECT '{NS}policy/' || replace(title, ' ', '_') s, '{RDF_TYPE}' p, '{NS}Policy' o, 'iri' o_kind, NULL o_datatype FROM policy
  UNION SELECT '{NS}policy/' || replace(title, ' ', '_'), '{NS}title', title, 'literal', NULL FROM policy
  UNION SELECT '{NS}policy/' || replace(title, ' ', '_'), '{NS}status', status, 'literal', NULL FROM policy""",
}


def _with(body: str) -> str:
    return f"WITH {_SOURCES} {body}"


def _kg(body: str, parts: tuple[str, ...] = ("cases", "weather", "alerts", "policy"), more: str = "") -> str:
    union = " UNION ".join(_KG_PARTS[p] for p in parts)
    return f"WITH {_SOURCES}, kg AS ({union}){more} {body}"


def _local(c: str) -> str:
    return f"split_part({c}, '/', -1)"


_NAMED = f", named AS (SELECT {_local('s')} AS src, {_local('p')} AS label, {_local('o')} AS dst FROM kg)"
_NODES = """
SELECT 'District' AS label, src AS name FROM named WHERE label IN ('hasDisease', 'hasDisaster')
UNION SELECT 'Disease', dst FROM named WHERE label = 'hasDisease'
UNION SELECT 'Disaster', dst FROM named WHERE label = 'hasDisaster'
UNION SELECT 'Policy', src FROM named WHERE label = 'title'"""
_EDGES = """
SELECT DISTINCT 'District' AS src_label, src,
  CASE label WHEN 'hasDisease' THEN 'HAS_DISEASE' ELSE 'HAS_DISASTER' END AS type,
  CASE label WHEN 'hasDisease' THEN 'Disease' ELSE 'Disaster' END AS dst_label, dst
FROM named WHERE label IN ('hasDisease', 'hasDisaster')"""

# Spellings by turn with what they resolve to: raw, canonical, province, matched, lat, lon.
_SPELLED = """
spelling(turn, raw, canonical, province, matched, lat, lon) AS (VALUES
  (0, 'D.G Khan', 'Dera Ghazi Khan', 'Punjab', true, 30.0321374::DOUBLE, 70.6401114::DOUBLE),
  (1, 'dg-khan', 'Dera Ghazi Khan', 'Punjab', true, 30.0321374, 70.6401114),
  (2, 'R. Y  Khan', 'Rahim Yar Khan', 'Punjab', true, 28.4225413, 70.3034237),
  (3, 'RAHIMYARKHAN', 'Rahim Yar Khan', 'Punjab', true, 28.4225413, 70.3034237),
  (4, 'Lahore City', 'Lahore', 'Punjab', true, 31.5497, 74.3436),
  (5, 'pindi', 'Rawalpindi', 'Punjab', true, NULL, NULL),
  (6, 'm.b_din', 'Mandi Bahauddin', 'Punjab', true, NULL, NULL),
  (7, 'isb,', 'Islamabad', 'Islamabad Capital Territory', true, 33.6844, 73.0479),
  (8, '', 'UNKNOWN', 'UNKNOWN', false, NULL, NULL),
  (9, NULL, 'UNKNOWN', 'UNKNOWN', false, NULL, NULL),
  (10, 'unknown o''place', 'Unknown O''Place', 'UNKNOWN', false, NULL, NULL),
  (11, '...', 'Dera Ghazi Khan', 'Punjab', true, 30.0321374, 70.6401114),
  (12, 'tehsil ', 'Tehsil ', 'UNKNOWN', false, NULL, NULL)
), spelled AS (
  SELECT c_custkey, raw || CASE WHEN turn = 12 THEN c_name ELSE '' END AS raw,
    canonical || CASE WHEN turn = 12 THEN c_name ELSE '' END AS canonical, province, matched, lat, lon
  FROM customer JOIN spelling ON turn = c_custkey % 13
)"""

_PART_RAW = """
SELECT p_partkey, ' ' || upper(split_part(p_name, ' ', 1)) || sep || split_part(p_name, ' ', 2) AS raw,
  split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, sep
FROM (SELECT *, CASE p_partkey % 4 WHEN 0 THEN ' ' WHEN 1 THEN '.' WHEN 2 THEN '-' ELSE '  ' END AS sep FROM part)"""


def _long_date(c: str) -> str:
    return f"strftime({c}, '%d %B %Y')"


_TURTLE = f"""
, terms AS (
  SELECT s, CASE WHEN p = '{RDF_TYPE}' THEN 'a' ELSE replace(p, '{NS}', 'ex:') END AS verb,
    CASE WHEN o_kind = 'iri' AND contains(o[{len(NS) + 1}:], '/') THEN '<' || o || '>'
         WHEN o_kind = 'iri' THEN replace(o, '{NS}', 'ex:')
         WHEN o_datatype = '{XSD}double' THEN regexp_replace(format('{{:.14e}}', CAST(o AS DOUBLE)), '\\.?0*e', 'e')
         WHEN o_datatype IS NOT NULL THEN o
         ELSE '"' || o || '"' END AS term
  FROM kg
)
"""

# Awkward characters by document, as in the catalog.
_AWKWARD = """CASE doc_id % 8 WHEN 0 THEN chr(133) WHEN 1 THEN chr(8232) WHEN 2 THEN chr(12) WHEN 3 THEN '>' WHEN 4 THEN '"'
  WHEN 5 THEN chr(92) WHEN 6 THEN chr(10) || chr(9) || chr(11) ELSE chr(92) || chr(10) || chr(1) END"""


def _policies(title: str, status: str, source: str) -> str:
    s = f"'{NS}policy/' || replace({title}, ' ', '_') AS s"
    return f"""SELECT {s}, '{RDF_TYPE}' AS p, '{NS}Policy' AS o, 'iri' AS o_kind, CAST(NULL AS VARCHAR) AS o_datatype FROM {source}
      UNION SELECT {s}, '{NS}title', {title}, 'literal', NULL FROM {source}
      UNION SELECT {s}, '{NS}status', {status}, 'literal', NULL FROM {source} WHERE text IS NOT NULL"""


ORACLE: dict[str, str] = {
    "link_sources": _with("SELECT * EXCLUDE (top_severity) FROM linked"),
    "link_ranked": _with(
        "SELECT record_id, disaster_event_count, top_severity AS max_severity, has_concurrent_disaster FROM linked"
    ),
    "link_no_alerts": _with(
        """SELECT c.*, m.* EXCLUDE (district_canonical, epi_week_key), CAST(NULL AS BIGINT) AS disaster_event_count,
        CAST(NULL AS VARCHAR) AS max_severity, CAST(NULL AS VARCHAR) AS event_types, false AS has_concurrent_disaster
        FROM cases c LEFT JOIN means m USING (district_canonical, epi_week_key)"""
    ),
    "weekly_means": _with("SELECT * FROM means"),
    "weekly_alerts": _with("SELECT * EXCLUDE (top_severity) FROM events_by_week"),
    "linked_sample": _with(
        """SELECT district_canonical, epi_week_key, disease, case_count, avg_temperature_c, avg_precipitation_mm,
        disaster_event_count, max_severity, has_concurrent_disaster FROM linked ORDER BY ALL LIMIT 10"""
    ),
    "epi_week": f"""
        SELECT o_orderkey, CAST(split_part(k, '-W', 1) AS INTEGER) AS epi_year,
          CAST(split_part(k, '-W', 2) AS INTEGER) AS epi_week, k AS epi_week_key
        FROM (SELECT o_orderkey, {_week('o_orderdate')} AS k FROM orders)""",
    "epi_week_mmwr": """
        SELECT o_orderkey, CAST(year(we) AS INTEGER) AS epi_year, CAST(ceil(dayofyear(we) / 7.0) AS INTEGER) AS epi_week,
          year(we) || '-W' || lpad(CAST(CAST(ceil(dayofyear(we) / 7.0) AS INTEGER) AS VARCHAR), 2, '0') AS epi_week_key
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER) + 3 AS we FROM orders)""",
    "epi_week_from_text": f"""
        SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 3 THEN {_week('o_orderdate')} END AS epi_week_key FROM orders""",
    "split_week_key": f"""
        SELECT o_orderkey, k AS epi_week_key, CAST(split_part(k, '-W', 1) AS INTEGER) AS epi_year,
          CAST(split_part(k, '-W', 2) AS INTEGER) AS epi_week
        FROM (SELECT o_orderkey, {_week('o_orderdate')} AS k FROM orders)""",
    "month_key": """
        SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS report_month,
          CAST(year(o_orderdate) AS INTEGER) AS report_year, strftime(o_orderdate, '%Y-%m') AS report_month_label
        FROM orders""",
    "extract_temporal_key": f"""
        SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 5 THEN '2000-W01' ELSE {_week('o_orderdate')} END AS temporal_key
        FROM orders""",
    "extract_relative_key": f"""
        SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 7 THEN {_week("DATE '1997-03-05'")} WHEN f = 7 THEN 'none' ELSE {_week('named')} END AS temporal_key
        FROM (SELECT o_orderkey, f, CASE f WHEN 0 THEN d - 1 WHEN 1 THEN d - 7 WHEN 2 THEN d - 2 WHEN 3 THEN d - (isodow(d) - 1)::INT
            WHEN 4 THEN d - ((isodow(d) + 2) % 7 + 1)::INT WHEN 5 THEN d + ((13 - isodow(d)) % 7 + 1)::INT WHEN 6 THEN d - 21 ELSE d END AS named
          FROM (SELECT o_orderkey, o_orderkey % 9 AS f, o_orderdate::DATE AS d FROM orders))""",
    "alert_sentences": f"""
        SELECT o_orderkey, upper(o_orderstatus) || ' reported in ' || o_orderpriority || ' on ' ||
          {_long_date('o_orderdate')} || '; severity minor.' AS description FROM orders""",
    "parse_events": """
        SELECT event_id, CASE WHEN event_id % 10 = 2 THEN 'none' ELSE event_type END AS event_type,
          CASE WHEN event_id % 10 NOT IN (1, 2) THEN value END AS value,
          CASE WHEN event_id % 10 NOT IN (1, 2) THEN CAST(json_extract(props, '$.k') AS INTEGER) ELSE -1 END AS k
        FROM events WHERE event_id % 10 <> 0""",
    "quarantine": """
        SELECT CASE WHEN event_id % 10 IN (0, 2) THEN 'bad' ELSE 'good' END AS kind, count(*) AS n FROM events GROUP BY ALL""",
    "flatten_weather": """
        SELECT l_orderkey, l_linenumber, l_quantity AS temperature_c, l_extendedprice AS humidity_pct,
          l_tax AS wind_speed_kmh, CASE WHEN l_linenumber > 1 THEN l_discount ELSE 0.0 END AS precipitation_mm
        FROM lineitem""",
    "to_messages": "SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders",
    "json_map": """
        SELECT c_custkey, unnest([lower(c_name) || '|pakistan', 'home']) AS key,
          c_nationkey + 0.5::DOUBLE AS lat, c_acctbal AS lon FROM customer""",
    "feed_items": """
        SELECT doc_id, source, CAST(n AS INTEGER) AS position,
          CASE WHEN n = 0 THEN text ELSE lang || ' ' || n || ' & <more>' END AS title,
          CASE WHEN n % 2 = 0 THEN 'http://example.org/' || CASE WHEN n = 0 THEN 0 ELSE doc_id END ELSE '' END AS link,
          CASE WHEN n = 0 THEN 'Tue, 30 Jun 2026' ELSE '' END AS published
        FROM documents, range(7) r(n)""",
    "json_map_round_trip": """
        SELECT lower(c_name) || '|pakistan' AS key, c_nationkey + 0.5 + CASE WHEN c_custkey % 3 = 0 THEN 200 ELSE 0 END::DOUBLE AS lat, c_acctbal::DOUBLE AS lon
        FROM customer""",
    "feed_rejected": """
        SELECT doc_id, CAST(CASE doc_id % 7 WHEN 0 THEN 7 WHEN 1 THEN 2 WHEN 4 THEN 1 ELSE 0 END AS BIGINT) AS items,
          CASE doc_id % 7 WHEN 1 THEN 'unreadable' WHEN 2 THEN 'unreadable' WHEN 3 THEN 'no feed' WHEN 5 THEN 'empty' END AS reason,
          CAST(CASE doc_id % 7 WHEN 1 THEN 2 WHEN 2 THEN 0 WHEN 3 THEN 0 WHEN 5 THEN 0 END AS INTEGER) AS saved
        FROM documents WHERE doc_id % 7 <> 6""",
    "news_items": """
        SELECT source, CASE WHEN n = 0 THEN text ELSE lang || ' ' || n || ' & <more>' END AS title,
          CASE WHEN n % 2 = 0 THEN 'http://example.org/' || CASE WHEN n = 0 THEN 0 ELSE doc_id END ELSE '' END AS link,
          CASE WHEN n = 0 THEN 'Tue, 30 Jun 2026' ELSE '' END AS published
        FROM documents, range(5) r(n)""",
    "top_n_per_source": """
        SELECT source, doc_id, text FROM documents
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 5""",
    "normalize_name": f"SELECT p_partkey, lower(a) || ' ' || b AS norm, lower(a) || b AS tight FROM ({_PART_RAW})",
    "title_name": f"""
        SELECT p_partkey, upper(a[1]) || lower(a[2:]) || sep || upper(b[1]) || lower(b[2:]) AS title FROM ({_PART_RAW})""",
    "resolve_names": f"WITH {_SPELLED} SELECT * EXCLUDE (lat, lon) FROM spelled",
    "resolve_names_by_joins": """
        WITH dictionary AS (
          SELECT p_name AS alias, min(p_partkey) AS rank, min(p_brand) AS province FROM part GROUP BY 1
        ), named AS (
          SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, ' ', '')
            WHEN 2 THEN 'the ' || p_name || ' set' || p_partkey WHEN 3 THEN split_part(p_name, ' ', 1)
            ELSE 'zz' || p_partkey END AS raw FROM part
        ), best AS (
          SELECT n.raw, coalesce(
              arg_min(d.alias, d.rank) FILTER (lower(n.raw) = d.alias),
              arg_min(d.alias, d.rank) FILTER (replace(lower(n.raw), ' ', '') = replace(d.alias, ' ', '')),
              arg_min(d.alias, d.rank) FILTER (contains(lower(n.raw), d.alias) OR contains(d.alias, lower(n.raw)))) AS alias
          FROM (SELECT DISTINCT raw FROM named) n, dictionary d GROUP BY n.raw
        )
        SELECT p_partkey, raw, coalesce(upper(alias), upper(raw[1]) || raw[2:]) AS canonical,
          coalesce(province, 'UNKNOWN') AS province, alias IS NOT NULL AS matched
        FROM named JOIN best USING (raw) LEFT JOIN dictionary USING (alias)""",
    "geocode": """
        SELECT c_custkey, ' Nation_' || c_nationkey AS place,
          CASE WHEN c_nationkey < 15 THEN c_nationkey * 1.5::DOUBLE
               WHEN c_nationkey < 20 THEN c_nationkey * 1.5::DOUBLE + 100 END AS lat,
          CASE WHEN c_nationkey < 20 THEN 70.25::DOUBLE END AS lon,
          CASE WHEN c_nationkey < 15 THEN 'cache' WHEN c_nationkey < 20 THEN 'settings_fallback' ELSE 'unresolved' END AS geocode_source
        FROM customer""",
    "geocode_duplicates": """
        SELECT c_custkey, 'Nation_' || c_nationkey AS place,
          CASE WHEN c_nationkey < 20 THEN first_value(c_acctbal) OVER w END AS lat,
          CASE WHEN c_nationkey < 20 THEN CAST(first_value(c_custkey) OVER w AS DOUBLE) END AS lon,
          CASE WHEN c_nationkey < 15 THEN 'cache' WHEN c_nationkey < 20 THEN 'settings_fallback' ELSE 'unresolved' END AS geocode_source
        FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey)""",
    "upsert_by_key": """
        SELECT s_suppkey, amount, seq FROM (
          SELECT s_suppkey, s_acctbal AS amount, 0::BIGINT AS seq, 0 AS age FROM supplier
          UNION ALL
          SELECT l_suppkey, l_extendedprice, l_orderkey * 1000000 + l_partkey * 10 + l_linenumber, 1 FROM lineitem WHERE l_returnflag = 'R')
        QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY age DESC, seq DESC) = 1""",
    "surveillance_records": f"""
        WITH {_SPELLED}
        SELECT o_orderkey, 'NIH_PAKISTAN' AS source, raw AS district, canonical AS district_canonical, province, lat, lon,
          o_orderstatus AS disease, CAST(trunc(o_totalprice) AS INTEGER) AS case_count, {_week('o_orderdate')} AS epi_week_key
        FROM orders JOIN spelled ON o_custkey = c_custkey""",
    "alert_records": f"""
        SELECT o_orderkey, upper(o_orderstatus) || ' reported in ' || o_orderkey || ' on ' || {_long_date('o_orderdate')} ||
            '; severity ' || o_orderpriority || '.' AS description, k AS extracted_temporal_key,
          CAST(split_part(k, '-W', 1) AS INTEGER) AS epi_year, CAST(split_part(k, '-W', 2) AS INTEGER) AS epi_week,
          strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000000+00:00') AS issued_at, 13 AS id_length
        FROM (SELECT *, {_week('o_orderdate')} AS k FROM orders)""",
    "total_by": _with("SELECT district_canonical, CAST(sum(case_count) AS BIGINT) AS cases FROM cases GROUP BY 1"),
    "mean_by": _with("SELECT district_canonical, round(avg(temperature_c), 6) AS temp FROM weather GROUP BY 1"),
    "count_by": _with("SELECT district_canonical, count(*) AS alerts FROM alerts GROUP BY 1"),
    "ingestion_metrics": """
        SELECT source, day, a AS records_attempted, s AS records_succeeded, a - s AS records_failed,
          CAST(format('{:.3f}', s / a) AS DOUBLE) AS success_rate, CASE WHEN a > s THEN 'value too small' ELSE '' END AS errors
        FROM (SELECT event_type AS source, CAST(ts AS DATE) AS day, count(*) AS a, count(*) FILTER (value > 5) AS s
              FROM events GROUP BY 1, 2)""",
    "summarize_metrics": """
        SELECT event_type AS source, count(DISTINCT CAST(ts AS DATE)) AS runs, count(*) AS records_attempted,
          count(*) FILTER (value > 5) AS records_succeeded FROM events GROUP BY 1""",
    "harmonize_week": f"""
        SELECT CAST(event_id AS VARCHAR) AS record_id, 'events' AS source, event_type AS district,
          CAST(NULL AS VARCHAR) AS district_canonical, props AS disease, CAST(user_id AS INTEGER) AS case_count,
          value AS idsr_compliance_pct, {_week('ts')} AS epi_week_key FROM events""",
    "harmonize_compacted": f"""
        SELECT CAST(event_id AS VARCHAR) AS record_id, 'events' AS source, event_type AS district, CAST(user_id AS INTEGER) AS case_count,
          {_week('ts')} AS epi_week_key FROM events""",
    "harmonize_restart": f"""
        SELECT {_week('ts')} AS epi_week_key, count(*) AS n, count(DISTINCT event_id) AS records, (SELECT count(*) FROM events) AS logged
        FROM events GROUP BY 1""",
    "harmonize_month": """
        SELECT CAST(o_orderkey AS VARCHAR) AS record_id, o_orderpriority AS title, CAST(month(o_orderdate) AS INTEGER) AS report_month,
          strftime(o_orderdate, '%Y-%m') AS report_month_label, unnest([o_orderstatus, o_orderpriority]) AS sector FROM orders""",
    "harmonize_plain": """
        SELECT source, text AS title, CAST(doc_id AS VARCHAR) AS link, '' AS published FROM documents""",
    "write_table": "SELECT * FROM orders",
    "with_record_id": """
        SELECT 'orders' AS source, o_orderkey, h AS record_id, 'NDMA-' || upper(h[:8]) AS alert_id
        FROM (SELECT o_orderkey, sha256(concat_ws(chr(31), '=' || o_orderkey, '=' || o_orderstatus, '=' || o_orderpriority)) AS h FROM orders)""",
    "triples": _kg("SELECT * FROM kg"),
    "triple_count": _kg("SELECT count(*) AS triples FROM kg"),
    "policy_status": _with("SELECT DISTINCT replace(title, ' ', '_') AS policy, status FROM policy"),
    "bgp": _kg(
        f"""SELECT a.s AS place, a.o AS disease, b.o AS disaster FROM kg a
        JOIN kg c ON c.s = a.o AND c.p = '{RDF_TYPE}' AND c.o = '{NS}Disease'
        JOIN kg b ON b.s = a.s AND b.p = '{NS}hasDisaster' WHERE a.p = '{NS}hasDisease'"""
    ),
    "bgp_reordered": _kg(
        f"""SELECT a.s AS place, a.o AS disease, b.o AS disaster FROM kg a
        JOIN kg c ON c.s = a.o AND c.p = '{RDF_TYPE}' AND c.o = '{NS}Disease'
        JOIN kg b ON b.s = a.s AND b.p = '{NS}hasDisaster' WHERE a.p = '{NS}hasDisease'"""
    ),
    "triples_merged": _kg("SELECT * FROM kg"),
    "ntriples_round_trip": _kg("SELECT * FROM kg"),
    "ntriples_text": _policies("CAST(doc_id AS VARCHAR)", "text", "documents"),
    "ntriples_hard_text": _policies("doc_id || a || 'x'", "a || text || a", f"(SELECT *, {_AWKWARD} AS a FROM documents)"),
    "ntriples_rejected": r"""
        SELECT CASE WHEN k = 4 THEN '_:b' || doc_id WHEN k IN (3, 5) THEN 'http://x/' || doc_id ELSE '' END AS s,
          CASE k WHEN 0 THEN '<http://x/' || doc_id || '> <http://x/p> "no end .' WHEN 2 THEN '<http://x/' || doc_id || '> <http://x/p> "\q" .'
            WHEN 3 THEN chr(128512) || 'é"' WHEN 4 THEN '_:c' ELSE 'http://x/>' END AS o,
          CASE WHEN k IN (0, 2) THEN 'rejected' ELSE 'read' END AS kind
        FROM (SELECT doc_id, doc_id % 6 AS k FROM documents) WHERE k <> 1""",
    "bgp_literal": _with(
        f"SELECT DISTINCT '{NS}district/' || replace(district_canonical, ' ', '_') AS place FROM weather WHERE temperature_c = 25"
    ),
    "turtle_blocks": _kg("SELECT s, '<' || s || '> ' || verb || ' ' || term || ' .' AS value FROM terms", more=_TURTLE),
    "rdfxml_rows": _kg(
        f"""SELECT s, CASE WHEN p = '{RDF_TYPE}' THEN 'rdf:type' ELSE replace(p, '{NS}', 'ex:') END AS tag,
          CASE WHEN o_kind = 'iri' THEN o END AS resource, o_datatype AS datatype, CASE WHEN o_kind <> 'iri' THEN o END AS value FROM kg"""
    ),
    "property_nodes": _kg(_NODES, more=_NAMED),
    "property_edges": _kg(_EDGES, more=_NAMED),
    "property_graph_round_trip": _kg(
        """SELECT label, name, count(e) AS degree FROM nodes LEFT JOIN (
          SELECT src_label AS label, src AS name, 1 AS e FROM edges UNION ALL SELECT dst_label, dst, 1 FROM edges
        ) USING (label, name) GROUP BY label, name""",
        more=f"{_NAMED}, nodes AS ({_NODES}), edges AS ({_EDGES})",
    ),
    "edge_table": _kg("SELECT src, dst, max(label) AS label FROM named GROUP BY src, dst", more=_NAMED),
    "graph_nodes": _kg("SELECT src AS name FROM named UNION SELECT dst FROM named", more=_NAMED),
}
