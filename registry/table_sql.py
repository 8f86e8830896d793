"""SQL for the operator and check queries, written for DuckDB."""

from __future__ import annotations

from registry.compare import finish
from registry.fare_sql import query

_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _pivot() -> str:
    cells = []
    for p in _PRIORITIES:
        cells.append(f"count(*) FILTER (o_orderpriority = '{p}') AS \"{p}\"")
        cells.append(f"coalesce(sum(o_totalprice) FILTER (o_orderpriority = '{p}'), 0) "
                     f"AS \"{p}_total\"")
    rounded = " ".join(f'"{p}_total"'.replace(" ", "~") for p in _PRIORITIES)
    inner = f"SELECT o_orderstatus, {', '.join(cells)} FROM orders GROUP BY 1"
    return finish(inner, rounded).replace("~", " ")


def _range_check(source: str, keys: str, range_ok: str, next_ok: str, range_name: str,
                 next_name: str, key_column: str) -> str:
    """Ranges sorted into one list per key and read beside that list without its first entry.

    The names of the result's columns are the check's contract (fixed values).
    """
    group = f"GROUP BY {keys}" if keys else ""
    own = f"{keys}," if keys else ""
    shown = f"{', '.join(k.strip() for k in keys.split(','))}," if keys else ""
    return f"""
    WITH lists AS (
        SELECT {own} list({{'lo': lower_bound, 'hi': upper_bound}} ORDER BY lower_bound, upper_bound) AS ranges
        FROM ({source}) {group}),
    neighbours AS (
        SELECT {shown} unnest(ranges) AS here, unnest(list_append(ranges[2:], NULL)) AS after,
            unnest(range(len(ranges) - 1, -1, -1)) AS behind FROM lists),
    bounds AS (
        SELECT {shown} here.lo AS lower_bound, here.hi AS upper_bound, after.lo AS next_lower_bound,
            behind = 0 AS is_last_record FROM neighbours),
    verdicts AS (
        SELECT *, ({range_ok}) IS NOT DISTINCT FROM true AS {range_name},
            CASE WHEN ({next_ok}) IS NULL THEN is_last_record ELSE ({next_ok}) END AS {next_name} FROM bounds)
    SELECT {key_column} lower_bound, upper_bound, next_lower_bound, is_last_record, {range_name}, {next_name},
        count(*) AS n_rows
    FROM verdicts WHERE NOT {range_name} OR NOT {next_name} GROUP BY ALL"""


_FARE_CHECKS = """
SELECT * FROM (VALUES
    ('unique_code', 'carrier_mapping', 0), ('not_null_code', 'carrier_mapping', 0),
    ('not_null_name', 'carrier_mapping', 0), ('unique_iata_code', 'airport_geo', 0),
    ('not_null_iata_code', 'airport_geo', 0), ('not_null_lat_deg', 'airport_geo', 0),
    ('not_null_lon_deg', 'airport_geo', 0), ('unique_first_letter', 'fare_bucket_map', 0),
    ('not_null_first_letter', 'fare_bucket_map', 0), ('not_null_fare_bucket', 'fare_bucket_map', 0),
    ('accepted_values_fare_bucket', 'fare_bucket_map', 0)) v("check", relation, failures)
UNION ALL SELECT 'equal_rowcount', 'stg_fare_searches', abs((SELECT count(*) FROM stg)
    - (SELECT count(*) FROM fares WHERE totalfare IS NOT NULL AND flight_date >= search_date))
UNION ALL SELECT 'not_null_legid', 'stg_fare_searches', count(*) FROM stg WHERE legid IS NULL
UNION ALL SELECT 'not_null_total_miles', 'stg_fare_searches', count(*) FROM stg
    WHERE total_miles IS NULL
UNION ALL SELECT 'not_null_usd_per_mi', 'stg_fare_searches', count(*) FROM stg
    WHERE usd_per_mi IS NULL
UNION ALL SELECT 'unique_legid', 'stg_fare_searches', count(*) FROM (
    SELECT legid FROM stg WHERE legid IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'accepted_values_seats_flag', 'stg_fare_searches', count(DISTINCT seats_flag)
    FROM stg WHERE seats_flag NOT IN ('sold_out', 'scarce', '9plus')
UNION ALL SELECT 'not_null_route', 'stg_route_stats', count(*) FROM bench WHERE route IS NULL
UNION ALL SELECT 'not_null_fare_bucket', 'stg_route_stats', count(*) FROM bench
    WHERE fare_bucket IS NULL
"""


def _boundaries() -> str:
    parts = ("year", "quarter", "month", "week", "day", "hour", "minute", "second")
    diffs = ", ".join(
        f"date_diff('{p}', date_trunc('{p}', o_orderdate), date_trunc('{p}', later)) AS {p}s"
        for p in parts)
    return f"""SELECT o_orderkey, {diffs} FROM (
        SELECT *, o_orderdate + to_minutes(CAST((o_orderkey * 37) % 900000 - 200000 AS BIGINT))
            AS later FROM orders)"""


def _parties(where: str, key: str) -> str:
    return f"""
    SELECT 'customer' AS source_relation, {key.format('c_custkey')} AS party_key, c_name AS name,
        c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS INTEGER) AS nation
    FROM customer WHERE c_acctbal {where}
    UNION ALL
    SELECT 'supplier', {key.format('s_suppkey')}, s_name, s_acctbal, NULL, s_nationkey
    FROM supplier WHERE s_acctbal {where}"""


def table_oracles() -> dict[str, str]:
    truncated = ", ".join(
        f"CAST(date_trunc('{p}', ts) AS TIMESTAMP) AS {p}_start"
        for p in ("year", "quarter", "month", "week", "day", "hour", "minute"))
    rest = "regexp_replace(url, '^(http|https)://', '')"
    return {
        "pivot_orders_by_priority": _pivot(),
        "unpivot_part_attributes": """
            SELECT p_partkey, 'p_brand' AS attribute, p_brand AS content FROM part
            UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
            UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part
            UNION ALL SELECT p_partkey, 'p_retailprice', CAST(p_retailprice AS VARCHAR) FROM part""",
        "union_relations_parties": finish(
            _parties("> 0", "CAST({} AS VARCHAR)"), "balance"),
        "union_tables_by_prefix": finish(f"""
            SELECT 'fareflow_party_' || source_relation AS source_relation, party_key, name, balance
            FROM ({_parties('IS NOT NULL', '{}')})""", "balance"),
        "dedup_latest_order_per_customer": finish("""
            SELECT * FROM orders QUALIFY row_number() OVER (
                PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""", "o_totalprice"),
        "column_values_by_frequency": """
            SELECT event_type AS value, count(*) AS n_rows FROM events WHERE value >= 10 GROUP BY 1""",
        "date_spine_daily_orders": finish("""
            SELECT CAST(d AS DATE) AS date_day, count(o_orderkey) AS n_orders,
                coalesce(sum(o_totalprice), 0) AS total_price
            FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE),
                INTERVAL 1 DAY)) AS d FROM orders)
            LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY 1""",
            "total_price"),
        "series_line_numbers": """
            SELECT i AS generated_number, nullif(count(l_linenumber), 0) AS n_lines
            FROM (SELECT unnest(range(1, max(l_linenumber) + 4)) AS i FROM lineitem) LEFT JOIN lineitem ON l_linenumber = i GROUP BY 1""",
        "star_except_customer": """
            SELECT c_custkey AS the_c_custkey_x, c_nationkey AS the_c_nationkey_x,
                c_mktsegment AS the_c_mktsegment_x FROM customer""",
        "nullcheck_customer": finish("""
            SELECT c_custkey, c_name, c_nationkey, c_acctbal,
                nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment FROM customer""", "c_acctbal"),
        "except_intersect_nations": """
            WITH buyers AS (SELECT c_nationkey AS nation, CAST(floor(c_acctbal / 1000) AS BIGINT) AS thousands FROM customer),
            sellers AS (SELECT s_nationkey, CAST(floor(s_acctbal / 1000) AS BIGINT) FROM supplier)
            SELECT *, 'buyers only' AS part FROM (FROM buyers EXCEPT FROM sellers)
            UNION ALL SELECT *, 'both' FROM (FROM buyers INTERSECT FROM sellers)""",
        "group_by_first_columns": finish("""
            SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity FROM lineitem
            GROUP BY 1, 2""", "quantity"),
        "listagg_types_per_brand": """
            SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types,
                string_agg(p_type, '_|_' ORDER BY p_partkey) FILTER (by_key <= 3) AS first_types,
                string_agg(p_name, '; ' ORDER BY p_retailprice, p_partkey, p_name)
                    FILTER (by_price <= 4) AS cheapest
            FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS by_key,
                    row_number() OVER (PARTITION BY p_brand
                        ORDER BY p_retailprice, p_partkey, p_name) AS by_price FROM part)
            GROUP BY 1""",
        "any_value_bool_or_events": finish("""
            SELECT user_id, 'user ' || user_id AS label,
                bool_or(event_type = 'purchase' AND value > 50) AS big_buyer,
                count(*) FILTER (event_type = 'error') AS n_errors,
                avg(value) FILTER (event_type = 'view') AS mean_view
            FROM events GROUP BY user_id""", "mean_view"),
        "global_percentile_price": finish("""
            SELECT quantile_cont(l_extendedprice, 0.5) AS p50,
                quantile_cont(l_extendedprice, 0.9) AS p90,
                quantile_cont(l_extendedprice, 0.95) AS p95,
                quantile_cont(l_extendedprice, 0.97) AS p97, max(l_extendedprice) AS top,
                count(l_extendedprice) AS n_prices FROM lineitem""", "p50 p90 p95 p97 top"),
        "dear_orders": finish("""
            SELECT o_orderkey, o_totalprice, p97 FROM orders,
                (SELECT quantile_cont(o_totalprice, 0.97) AS p97 FROM orders)
            WHERE o_totalprice > p97""", "o_totalprice p97"),
        "percentiles_by_flag": finish("""
            SELECT l_returnflag, l_suppkey, quantile_cont(l_extendedprice, 0.5) AS median_price,
                quantile_cont(l_extendedprice, 0.95) AS p95_price,
                quantile_cont(l_extendedprice * (1 - l_discount), 0.5) AS median_net
            FROM lineitem GROUP BY 1, 2""", "median_price p95_price median_net"),
        "width_bucket_prices": """
            SELECT CAST(CASE WHEN l_extendedprice < 10000 THEN 0 WHEN l_extendedprice >= 90000 THEN 9
                ELSE floor((l_extendedprice - 10000) / 10000) + 1 END AS BIGINT) AS bucket,
                count(*) AS n_lines FROM lineitem GROUP BY 1""",
        "surrogate_key_orders": """
            SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS one_field,
                md5(o_custkey || '-' || CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END
                    || '-' || o_orderpriority) AS three_fields FROM orders""",
        "safe_add_lineitem": finish("""
            SELECT l_returnflag, sum(l_discount + l_tax + l_quantity) AS safe_total,
                count(*) FILTER (l_discount <> 0 AND l_tax <> 0) AS both_present
            FROM lineitem GROUP BY 1""", "safe_total"),
        "url_breakdown_pages": f"""
            SELECT page_id, regexp_extract({rest}, '^[^/?]*') AS host,
                CASE WHEN position('/' IN {rest}) > 0
                    THEN split_part(substr({rest}, position('/' IN {rest}) + 1), '?', 1)
                    WHEN position('?' IN {rest}) > 0 THEN '' ELSE {rest} END AS path,
                nullif(regexp_extract(url, 'page=([^&]*)', 1), '') AS page,
                nullif(regexp_extract(url, 'ref=([^&]*)', 1), '') AS ref
            FROM pages""",
        "text_functions_events": """
            SELECT event_id, CAST(length(event_type) AS INTEGER) AS type_length,
                CAST(strpos(event_type, 'r') AS INTEGER) AS r_at,
                replace(event_type, 'e', '') AS no_e, right(props, 4) AS props_end,
                TRY_CAST(regexp_extract(props, ': ([^}]*)', 1) AS INTEGER) AS k,
                TRY_CAST(event_type AS INTEGER) AS not_a_number,
                CASE WHEN value > 50 THEN 'true' WHEN value <= 50 THEN 'false' END AS is_large,
                event_type || '#' || nullif(user_id, 8) AS label,
                md5(CAST(event_id AS VARCHAR)) AS hashed FROM events""",
        "array_functions_embeddings": """
            SELECT vec_id, '[' || vec_id || ',' || label || ']' AS pair,
                '[' || vec_id || ',' || label || ',' || (vec_id + 1) || ']' AS appended,
                '[' || vec_id || ',' || label || ',' || vec_id || ',' || label || ']' AS joined,
                CASE WHEN label IS NULL THEN 0 WHEN label = 0 THEN 1 ELSE 2 END AS n_present
            FROM embeddings""",
        "datediff_boundaries_orders": _boundaries(),
        "date_parts_events": f"""
            SELECT event_id, {truncated}, ts + INTERVAL 1 MONTH AS next_month,
                ts - INTERVAL 5 HOUR AS earlier FROM events""",
        "last_day_orders": """
            SELECT o_orderkey, last_day(o_orderdate) AS month_end,
                CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)
                    AS quarter_end,
                make_date(year(o_orderdate), 12, 31) AS year_end FROM orders""",
        "haversine_routes": query("stg", """
            SELECT origin, destination, n_bookings, miles, miles * 1.60934 AS km FROM (
                SELECT origin, destination, n_bookings, 2 * 3961.0 * asin(sqrt(
                    pow(sin(radians((d.lat_deg - o.lat_deg) / 2)), 2) + cos(radians(o.lat_deg))
                    * cos(radians(d.lat_deg)) * pow(sin(radians((d.lon_deg - o.lon_deg) / 2)), 2)))
                    AS miles
                FROM (SELECT origin, destination, count(*) AS n_bookings FROM stg GROUP BY ALL)
                LEFT JOIN airports o ON origin = o.iata_code
                LEFT JOIN airports d ON destination = d.iata_code)""", "miles km"),
        "period_load_events": """
            SELECT event_id, ts, event_type FROM events
            WHERE ts > TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-25'""",
        "dq_not_null": query("stg", """
            SELECT legid, route, total_miles FROM stg WHERE usd_per_mi IS NULL""", "total_miles"),
        "dq_unique": """
            SELECT o_custkey AS value, count(*) AS n_rows FROM orders
            WHERE o_orderstatus <> 'P' GROUP BY 1 HAVING count(*) > 1""",
        "dq_unique_combination": """
            SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2
            HAVING count(*) > 1""",
        "dq_accepted_values": """
            SELECT o_orderstatus AS value, count(*) AS n_rows FROM orders
            WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 1""",
        "dq_not_accepted_values": """
            SELECT event_type AS value, count(*) AS n_rows FROM events
            WHERE event_type IN ('error', 'refund') GROUP BY 1""",
        "dq_accepted_range": finish("""
            SELECT l_orderkey, l_linenumber, l_partkey, l_discount FROM lineitem
            WHERE NOT (l_discount > 0 AND l_discount < 0.1)""", "l_discount"),
        "dq_expression_is_true": finish("""
            SELECT o_orderkey, o_totalprice FROM orders
            WHERE o_orderstatus = 'F' AND NOT (o_totalprice > 50000)""", "o_totalprice"),
        "dq_at_least_one": """
            SELECT count(nullif(value, value)) AS n_values FROM events
            HAVING count(nullif(value, value)) = 0""",
        "dq_not_constant": """
            SELECT CAST(min(len(embedding)) AS INTEGER) AS only_value FROM embeddings
            HAVING count(DISTINCT len(embedding)) = 1""",
        "dq_not_null_proportion": query("stg", """
            SELECT count(usd_per_mi) / CAST(count(*) AS DOUBLE) AS not_null_proportion FROM stg
            HAVING count(usd_per_mi) / CAST(count(*) AS DOUBLE) < 0.99""", "not_null_proportion"),
        "dq_recency": """
            SELECT max(ts) AS most_recent, TIMESTAMP '2024-02-08' AS threshold FROM events
            HAVING max(ts) < TIMESTAMP '2024-02-08'""",
        "dq_equal_rowcount": """
            SELECT a AS count_a, b AS count_b, abs(a - b) AS diff_count FROM (SELECT
                (SELECT count(*) FROM orders) AS a, (SELECT count(*) FROM lineitem) AS b)""",
        "dq_fewer_rows_than": """
            SELECT a AS count_a, b AS count_b,
                CASE WHEN a > b THEN a - b WHEN a = b THEN 1 ELSE 0 END AS row_count_delta
            FROM (SELECT (SELECT count(*) FROM lineitem) AS a, (SELECT count(*) FROM orders) AS b)""",
        "dq_equality": """
            WITH c AS (SELECT c_nationkey AS nation, c_acctbal > 0 AS in_credit FROM customer),
            s AS (SELECT s_nationkey AS nation, s_acctbal > 0 AS in_credit FROM supplier)
            SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM c EXCEPT SELECT * FROM s)
            UNION ALL
            SELECT 'b_minus_a', * FROM (SELECT * FROM s EXCEPT SELECT * FROM c)""",
        "dq_equality_strict": """
            SELECT CASE WHEN coalesce(a, 0) > coalesce(b, 0) THEN 'a_minus_b' ELSE 'b_minus_a' END AS which_diff, nation
            FROM (SELECT c_nationkey AS nation, count(*) AS a FROM customer GROUP BY 1)
            FULL JOIN (SELECT s_nationkey AS nation, count(*) AS b FROM supplier GROUP BY 1) USING (nation)
            WHERE coalesce(a, 0) <> coalesce(b, 0)""",
        "dq_helpers": """
            SELECT 'not_empty_string' AS "check", 'customer' AS relation, count(*) AS failures
            FROM customer WHERE c_mktsegment = 'MACHINERY'
            UNION ALL SELECT 'columns_equal', 'lineitem', count(*) FROM lineitem
            WHERE l_discount IS DISTINCT FROM CASE WHEN l_tax <> 0.02 THEN l_tax END
            UNION ALL SELECT kind, name, (SELECT count(*) FROM customer) FROM (VALUES ('missing_column', 'c_phone'),
                ('excess_column', 'c_acctbal'), ('excess_column', 'c_mktsegment'), ('excess_column', 'c_nationkey')) v(kind, name)""",
        "dq_recency_now": """
            SELECT max(ts) AS most_recent, true AS is_current FROM events
            HAVING max(ts) < CAST(now() AT TIME ZONE 'UTC' AS TIMESTAMP) - INTERVAL 1 DAY""",
        "column_values_of_tables": """
            SELECT o_orderstatus, count(*) AS n_orders, true AS listed, o_orderstatus IN ('F', 'none') AS in_default
            FROM orders GROUP BY 1""",
        "dq_cardinality_equality": """
            WITH c AS (SELECT c_nationkey AS value, count(*) AS num_rows FROM customer GROUP BY 1),
            s AS (SELECT s_nationkey AS value, count(*) AS num_rows FROM supplier GROUP BY 1)
            SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM c EXCEPT SELECT * FROM s)
            UNION ALL
            SELECT 'b_minus_a', * FROM (SELECT * FROM s EXCEPT SELECT * FROM c)""",
        "dq_relationships_where": """
            SELECT o_custkey AS id, count(*) AS n_rows FROM orders
            WHERE o_totalprice > 100000 AND o_custkey IS NOT NULL AND o_custkey NOT IN (
                SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1""",
        "dq_sequential_values": """
            SELECT day, previous_day, count(*) AS n_rows FROM (
                SELECT day, lag(day) OVER (ORDER BY day) AS previous_day
                FROM (SELECT CAST(o_orderdate AS DATE) AS day FROM orders))
            WHERE previous_day IS NOT NULL AND day <> previous_day + 1 GROUP BY 1, 2""",
        "dq_sequential_numbers": """
            SELECT l_suppkey, previous_l_suppkey, count(*) AS n_rows FROM (
                SELECT l_suppkey, lag(l_suppkey) OVER (ORDER BY l_suppkey) AS previous_l_suppkey
                FROM lineitem)
            WHERE previous_l_suppkey IS NOT NULL AND l_suppkey <> previous_l_suppkey + 1
            GROUP BY 1, 2""",
        "dq_mutually_exclusive_ranges": _range_check(
            """SELECT o_custkey AS partition_by_col, CAST(o_orderdate AS DATE) AS lower_bound,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) AS upper_bound
               FROM orders""",
            "partition_by_col", "lower_bound < upper_bound", "upper_bound <= next_lower_bound",
            "lower_bound_less_than_upper_bound",
            "upper_bound_less_than_or_equal_to_next_lower_bound", "partition_by_col,"),
        "dq_mutually_exclusive_ranges_unpartitioned": _range_check(
            """SELECT o_orderkey AS lower_bound, o_orderkey + o_custkey % 3 AS upper_bound
               FROM orders""",
            "", "lower_bound <= upper_bound", "upper_bound = next_lower_bound",
            "lower_bound_less_than_or_equal_to_upper_bound",
            "upper_bound_equal_to_next_lower_bound", ""),
        "dq_fare_tables": query("bench", _FARE_CHECKS),
    }
