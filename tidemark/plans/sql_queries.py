"""Queries of the SQL surface: checked by the gateway's rules, planned by Catalyst.

Each entry is (Spark SQL, DuckDB SQL); None means the same text runs on both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import readonly
from tidemark.plans.lateral import ordered_first

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

SQL: dict[str, tuple[str, str | None]] = {
    "sql_filter_project": (
        "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE l_quantity > 45 AND l_shipdate < TIMESTAMP '1996-01-01 00:00:00'", None),
    "sql_pricing_summary": (
        """SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
           round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus""", None),
    "sql_join_inner": (
        """SELECT n_name, r_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name""", None),
    "sql_join_left": (
        "SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey", None),
    "sql_join_right": (
        "SELECT n_nationkey, count(c_custkey) AS customers FROM customer RIGHT JOIN nation ON c_nationkey = n_nationkey AND c_acctbal > 9000 GROUP BY n_nationkey", None),
    "sql_join_full": (
        """SELECT a.k AS left_key, b.k AS right_key FROM (SELECT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' GROUP BY o_custkey) a
           FULL JOIN (SELECT c_custkey AS k FROM customer WHERE c_mktsegment = 'BUILDING') b ON a.k = b.k""", None),
    "sql_join_semi": (
        "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')", None),
    "sql_join_anti": (
        "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 200000)", None),
    "sql_join_cross": (
        "SELECT a.r_name AS a_name, b.r_name AS b_name FROM region a CROSS JOIN region b", None),
    "sql_join_theta": (
        """SELECT a.n_name AS a_name, count(*) AS later FROM nation a JOIN nation b ON a.n_name < b.n_name AND a.n_regionkey <> b.n_regionkey GROUP BY a.n_name""", None),
    "sql_join_using": (
        "SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id) WHERE toxic = 1", None),
    "sql_interval_join": (
        """SELECT a.event_id, count(b.event_id) AS near FROM events a LEFT JOIN events b ON a.user_id = b.user_id AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 1 HOUR
           WHERE a.event_type = 'purchase' GROUP BY a.event_id""", None),
    "sql_asof": (
        """SELECT event_id, user_id, last_click FROM (
             SELECT event_id, user_id, event_type, last_value(CASE WHEN event_type = 'click' THEN event_id END) IGNORE NULLS
               OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_click FROM events) x
           WHERE event_type = 'purchase'""",
        """SELECT event_id, user_id, last_click FROM (
             SELECT event_id, user_id, event_type, last_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS)
               OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_click FROM events) x
           WHERE event_type = 'purchase'"""),
    "sql_group_agg": (
        """SELECT o_orderstatus, o_orderpriority, count(*) AS n, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date, round(sum(o_totalprice), 2) AS total
           FROM orders GROUP BY o_orderstatus, o_orderpriority HAVING count(*) > 1""", None),
    "sql_agg_filter": (
        """SELECT l_shipmode_key, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(DISTINCT l_suppkey) AS suppliers
           FROM (SELECT l_linenumber AS l_shipmode_key, l_returnflag, l_suppkey FROM lineitem) x GROUP BY l_shipmode_key""", None),
    "sql_statistics": (
        "SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_discount), 8) AS var, median(l_quantity) AS mid FROM lineitem GROUP BY l_returnflag", None),
    "sql_distinct": ("SELECT DISTINCT p_brand, p_type FROM part", None),
    "sql_count_distinct": ("SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY o_orderpriority", None),
    "sql_grouping_sets": (
        "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())", None),
    "sql_rollup": ("SELECT n_regionkey, n_nationkey, count(*) AS n FROM nation GROUP BY ROLLUP (n_regionkey, n_nationkey)", None),
    "sql_cube": ("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)", None),
    "sql_window_rank": (
        """SELECT o_orderkey, rank() OVER w AS rk, dense_rank() OVER w AS drk, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn,
           ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS quarter FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority)""", None),
    "sql_window_lag_lead": (
        """SELECT event_id, lag(event_id) OVER w AS before_id, lead(event_id, 2) OVER w AS after_id, first_value(event_id) OVER w AS first_id
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""", None),
    "sql_window_running_sum": (
        """SELECT o_orderkey, CAST(sum(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running FROM orders""", None),
    "sql_window_range_frame": (
        """SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS last_day FROM events""", None),
    "sql_topk": ("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25", None),
    "sql_topk_per_group": (
        """SELECT p_brand, p_partkey, rn FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) x WHERE rn <= 3""", None),
    "sql_limit_offset": ("SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 20 OFFSET 40", None),
    "sql_union": ("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier", None),
    "sql_union_all": ("SELECT k, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) x GROUP BY k", None),
    "sql_intersect": ("SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 5000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal < 0", None),
    "sql_except": ("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000", None),
    "sql_intersect_all": ("SELECT o_orderstatus AS k FROM orders WHERE o_totalprice > 100000 INTERSECT ALL SELECT o_orderstatus FROM orders WHERE o_totalprice < 150000", None),
    "sql_union_by_name": (
        "SELECT c_custkey AS k, c_nationkey AS nation FROM customer UNION ALL SELECT * FROM (SELECT k, nation FROM (SELECT s_nationkey AS nation, s_suppkey AS k FROM supplier) y) z",
        "SELECT c_custkey AS k, c_nationkey AS nation FROM customer UNION ALL BY NAME SELECT s_nationkey AS nation, s_suppkey AS k FROM supplier"),
    "sql_approx_distinct": (
        """SELECT o_orderpriority, abs(approx_count_distinct(o_custkey, 0.01) - count(DISTINCT o_custkey)) <= 0.05 * count(DISTINCT o_custkey) AS near FROM orders GROUP BY o_orderpriority""",
        "SELECT DISTINCT o_orderpriority, true AS near FROM orders"),
    "sql_percentiles": (
        """SELECT l_returnflag, percentile(l_extendedprice, 0.25) AS exact_quarter, percentile_approx(l_quantity, 0.5, 100000) BETWEEN 1 AND 50 AS inside FROM lineitem GROUP BY l_returnflag""",
        "SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS exact_quarter, true AS inside FROM lineitem GROUP BY l_returnflag"),
    "sql_struct_map": (
        """SELECT event_type, m['last'] AS last_id, s.user_id AS last_user, CAST(size(map_keys(m)) AS BIGINT) AS n FROM (
             SELECT event_type, map('first', min(event_id), 'last', max(event_id)) AS m, max(struct(event_id, user_id)) AS s FROM events GROUP BY event_type) x""",
        """SELECT event_type, m['last'] AS last_id, s.user_id AS last_user, CAST(len(map_keys(m)) AS BIGINT) AS n FROM (
             SELECT event_type, MAP {'first': min(event_id), 'last': max(event_id)} AS m, max({'event_id': event_id, 'user_id': user_id}) AS s FROM events GROUP BY event_type) x"""),
    "sql_from_json": (
        """SELECT event_id, from_json(props, 'k BIGINT').k AS k, to_json(named_struct('id', event_id, 'kind', event_type)) AS j FROM events""",
        """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(to_json({'id': event_id, 'kind': event_type}) AS VARCHAR) AS j FROM events"""),
    "sql_grouping_id": (
        """SELECT n_regionkey, n_nationkey, CAST(grouping_id(n_regionkey, n_nationkey) AS BIGINT) AS level, count(*) AS n FROM nation GROUP BY ROLLUP (n_regionkey, n_nationkey)""",
        """SELECT n_regionkey, n_nationkey, CAST(grouping_id(n_regionkey, n_nationkey) AS BIGINT) AS level, count(*) AS n FROM nation GROUP BY ROLLUP (n_regionkey, n_nationkey)"""),
    "sql_except_all": ("SELECT o_orderstatus AS k FROM orders EXCEPT ALL SELECT o_orderstatus FROM orders WHERE o_orderkey > 10", None),
    "sql_cte": (
        """WITH big AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey), best AS (SELECT max(n) AS n FROM big)
           SELECT o_custkey, big.n AS n FROM big JOIN best ON big.n = best.n""", None),
    "sql_recursive_cte": ("WITH RECURSIVE t(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM t WHERE n < 20) SELECT n FROM t", None),
    "sql_correlated": (
        "SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT avg(i.o_totalprice) * 1.8 FROM orders i WHERE i.o_custkey = o.o_custkey)", None),
    "sql_in_subquery": ("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)", None),
    "sql_lateral": (
        """SELECT c_custkey, x.o_orderkey AS last_order FROM customer, LATERAL (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) x""", None),
    "sql_pivot": (
        """SELECT * FROM (SELECT l_returnflag, l_linestatus, l_orderkey FROM lineitem) PIVOT (count(l_orderkey) FOR l_linestatus IN ('O' AS open_lines, 'F' AS full_lines))""",
        """SELECT l_returnflag, count(l_orderkey) FILTER (WHERE l_linestatus = 'O') AS open_lines, count(l_orderkey) FILTER (WHERE l_linestatus = 'F') AS full_lines
           FROM lineitem GROUP BY l_returnflag"""),
    "sql_unpivot": (
        "SELECT s_suppkey, measure, amount FROM (SELECT s_suppkey, s_acctbal, CAST(s_nationkey AS DOUBLE) AS s_nation FROM supplier) UNPIVOT (amount FOR measure IN (s_acctbal, s_nation))",
        """SELECT s_suppkey, 's_acctbal' AS measure, s_acctbal AS amount FROM supplier UNION ALL SELECT s_suppkey, 's_nation', CAST(s_nationkey AS DOUBLE) FROM supplier"""),
    "sql_values": ("SELECT id, name FROM (VALUES (1, 'a'), (2, 'b'), (3, NULL)) AS t(id, name)", None),
    "sql_case_coalesce": (
        """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS seg FROM customer""", None),
    "sql_string_funcs": (
        """SELECT p_partkey, upper(p_name) AS u, substring(p_brand, 1, 5) AS s, length(p_type) AS n, replace(p_name, ' ', '_') AS r, concat(p_brand, ':', p_type) AS c,
           p_type LIKE '%BRASS' AS brass, lpad(p_brand, 12, '*') AS l, regexp_replace(p_name, '[aeiou]', '') AS v, trim(concat('  ', p_brand, ' ')) AS t FROM part""",
        """SELECT p_partkey, upper(p_name) AS u, substring(p_brand, 1, 5) AS s, CAST(length(p_type) AS INTEGER) AS n, replace(p_name, ' ', '_') AS r, concat(p_brand, ':', p_type) AS c,
           p_type LIKE '%BRASS' AS brass, lpad(p_brand, 12, '*') AS l, regexp_replace(p_name, '[aeiou]', '', 'g') AS v, trim(concat('  ', p_brand, ' ')) AS t FROM part"""),
    "sql_date_funcs": (
        """SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, date_trunc('month', o_orderdate) AS mon,
           CAST(datediff(DATE '2000-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS d, o_orderdate + INTERVAL 3 DAY AS later, CAST(extract(QUARTER FROM o_orderdate) AS BIGINT) AS q FROM orders""",
        """SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS mon,
           date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS d, o_orderdate + INTERVAL 3 DAY AS later, extract(QUARTER FROM o_orderdate) AS q FROM orders"""),
    "sql_math_funcs": (
        """SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_quantity / 7) AS BIGINT) AS f, l_partkey % 7 AS m, abs(l_discount - 0.05) AS a, CAST(l_orderkey div 10 AS BIGINT) AS i,
           power(l_linenumber, 2) AS p, greatest(l_linenumber, 3) AS g, round(sqrt(l_quantity), 6) AS s FROM lineitem""",
        """SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_quantity / 7) AS BIGINT) AS f, l_partkey % 7 AS m, abs(l_discount - 0.05) AS a, CAST(l_orderkey // 10 AS BIGINT) AS i,
           power(l_linenumber, 2) AS p, greatest(l_linenumber, 3) AS g, round(sqrt(l_quantity), 6) AS s FROM lineitem"""),
    "sql_array_funcs": (
        """SELECT vec_id, CAST(size(embedding) AS BIGINT) AS n, element_at(embedding, 1) AS first_value, array_max(embedding) AS top, CAST(size(filter(embedding, x -> x > 0)) AS BIGINT) AS positive FROM embeddings""",
        """SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n, embedding[1] AS first_value, list_max(embedding) AS top, CAST(len(list_filter(embedding, lambda x: x > 0)) AS BIGINT) AS positive FROM embeddings"""),
    "sql_explode": (
        "SELECT label, CAST(count(*) AS BIGINT) AS n FROM (SELECT label, explode(embedding) AS x FROM embeddings) t WHERE x > 0 GROUP BY label",
        "SELECT label, count(*) AS n FROM (SELECT label, unnest(embedding) AS x FROM embeddings) t WHERE x > 0 GROUP BY label"),
    "sql_json_funcs": (
        "SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM events", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"),
    "sql_string_agg": (
        "SELECT n_regionkey, concat_ws(',', sort_array(collect_list(n_name))) AS names FROM nation GROUP BY n_regionkey",
        "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey"),
    "sql_max_by": ("SELECT o_custkey, max_by(o_orderkey, o_orderkey) AS last_order FROM orders GROUP BY o_custkey", None),
    "sql_tumbling": (
        "SELECT window.start AS start, event_type, count(*) AS n FROM events GROUP BY window(ts, '1 hour'), event_type",
        "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL"),
    "sql_sliding": (
        "SELECT window.start AS start, count(*) AS n FROM events GROUP BY window(ts, '2 hours', '1 hour')",
        """SELECT start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS start FROM events) GROUP BY start"""),
    "sql_session": (
        """SELECT user_id, session_window.start AS start, count(*) AS n FROM events GROUP BY user_id, session_window(ts, '30 minutes')""",
        """SELECT user_id, min(ts) AS start, count(*) AS n FROM (
             SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts >= before + INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session
             FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)) GROUP BY user_id, session"""),
}


def register(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The statement, after the gateway's check, over the tables it names."""
    readonly.check(spark, text)
    register(spark, sf_dir, [t for t in TABLES if t in text])
    return ordered_first(spark.sql(text))


def queries() -> dict:
    return {name: (lambda spark, sf_dir, text=text: run(spark, sf_dir, text)) for name, (text, _) in SQL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: other or text for name, (text, other) in SQL.items()}
