"""Independent SQL (DuckDB dialect) for the registered queries, over the same
tables. Allocation oracles use the textbook forms — a running-sum window for
non-negative amounts and a recursive CTE that applies the sequential rule row
by row for signed amounts — not the scan the library uses."""

from __future__ import annotations

LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"
D2 = "DECIMAL(18,2)"

ORACLE_SQL: dict[str, str] = {
    "sum_of": f"""
        SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, COALESCE(CAST(s.s AS DOUBLE), 0.0) AS billed
        FROM orders o LEFT JOIN (SELECT l_orderkey, SUM(CAST(l_extendedprice AS {D2})) AS s
                                 FROM lineitem GROUP BY l_orderkey) s ON o.o_orderkey = s.l_orderkey""",
    "sum_of_filtered": f"""
        SELECT o.o_orderkey, o.o_custkey, COALESCE(CAST(s.s AS DOUBLE), 0.0) AS billed_r
        FROM orders o LEFT JOIN (SELECT l_orderkey, SUM(CAST(l_extendedprice AS {D2})) AS s
                                 FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) s
          ON o.o_orderkey = s.l_orderkey""",
    "avg_of": """
        SELECT o.o_orderkey, o.o_custkey, COALESCE(ROUND(s.a, 6), 0.0) AS avg_qty
        FROM orders o LEFT JOIN (SELECT l_orderkey, AVG(l_quantity) AS a FROM lineitem GROUP BY l_orderkey) s
          ON o.o_orderkey = s.l_orderkey""",
    "lookup_one": f"""
        SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
               COALESCE(CAST(CAST(p.p_retailprice AS {D2}) * CAST(l.l_quantity AS {D2}) AS DOUBLE), 0.0) AS list_value
        FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    "lookup_multi_key": f"""
        WITH st AS (SELECT o_custkey, o_orderstatus, SUM(CAST(o_totalprice AS {D2})) AS st_total
                    FROM orders GROUP BY o_custkey, o_orderstatus)
        SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus,
               COALESCE(ROUND(CAST(o.o_totalprice AS {D2}) / st.st_total, 6), 0.0) AS share
        FROM orders o LEFT JOIN st ON o.o_custkey = st.o_custkey AND o.o_orderstatus = st.o_orderstatus""",
    "sum_global": f"""
        SELECT r_regionkey, r_name,
               COALESCE((SELECT CAST(SUM(CAST(c_acctbal AS {D2})) AS DOUBLE) FROM customer), 0.0) AS total_bal
        FROM region""",
    "list_of": f"""
        SELECT o.o_orderkey, o.o_custkey, s.lines
        FROM orders o LEFT JOIN (
            SELECT l_orderkey, STRING_AGG(CAST(l_linenumber AS VARCHAR), ',' ORDER BY {LINE_ORDER}) AS lines
            FROM lineitem GROUP BY l_orderkey) s ON o.o_orderkey = s.l_orderkey""",
    "list_fn": """
        SELECT o.o_orderkey, COALESCE(s.max_qty, 0.0) AS max_qty, COALESCE(s.min_price, 0.0) AS min_price,
               COALESCE(s.n_lines, 0) AS n_lines, COALESCE(s.sumsq_qty, 0.0) AS sumsq_qty
        FROM orders o LEFT JOIN (
            SELECT l_orderkey, MAX(l_quantity) AS max_qty, MIN(l_extendedprice) AS min_price,
                   COUNT(*) AS n_lines, SUM(l_quantity * l_quantity) AS sumsq_qty
            FROM lineitem GROUP BY l_orderkey) s ON o.o_orderkey = s.l_orderkey""",
    "list_as_objects": f"""
        SELECT l_orderkey AS o_orderkey,
               CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) - 1 AS INTEGER) AS pos,
               CAST(l_linenumber AS VARCHAR) AS line, CAST(l_partkey AS VARCHAR) AS part
        FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""",
    "self_chain": f"""
        WITH t AS (
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_tax,
                   CAST(CAST(l_extendedprice AS {D2}) * (1 - CAST(l_discount AS {D2})) AS DECIMAL(20,4)) AS net
            FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(net AS DOUBLE) AS net,
               CAST(CAST(net * (1 + CAST(l_tax AS {D2})) AS DECIMAL(24,6)) AS DOUBLE) AS gross
        FROM t""",
    "multi_input": f"""
        SELECT o.o_orderkey, o.o_custkey,
               COALESCE(CAST(c.c_acctbal AS {D2}) - s.sp + s.aq, 0.0) AS score
        FROM orders o
        LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN (SELECT l_orderkey, SUM(CAST(l_extendedprice AS {D2})) AS sp, AVG(l_quantity) AS aq
                   FROM lineitem GROUP BY l_orderkey) s ON o.o_orderkey = s.l_orderkey""",
    "formula_chain": f"""
        WITH li AS (
            SELECT l_orderkey,
                   CAST(CAST(l_extendedprice AS {D2}) * (1 - CAST(l_discount AS {D2})) AS DECIMAL(20,4)) AS net
            FROM lineitem),
        b AS (SELECT l_orderkey, SUM(net) AS billed FROM li GROUP BY l_orderkey),
        o AS (
            SELECT o.o_orderkey, o.o_custkey,
                   CASE WHEN o.o_orderstatus = 'F'
                        THEN CAST(CAST(o.o_totalprice AS {D2}) - COALESCE(CAST(b.billed AS DECIMAL(24,4)), 0)
                                  AS DECIMAL(24,4))
                        ELSE CAST(0 AS DECIMAL(24,4)) END AS gap
            FROM orders o LEFT JOIN b ON o.o_orderkey = b.l_orderkey),
        x AS (SELECT o_custkey, SUM(gap) AS e, AVG(gap) AS a FROM o GROUP BY o_custkey)
        SELECT c.c_custkey, COALESCE(CAST(CAST(x.e AS DECIMAL(28,4)) AS DOUBLE), 0.0) AS exposure,
               COALESCE(ROUND(x.a, 8), 0.0) AS avg_gap
        FROM customer c LEFT JOIN x ON c.c_custkey = x.o_custkey""",
    "formula_chain_checkpointed": f"""
        WITH li AS (
            SELECT l_orderkey,
                   CAST(CAST(l_extendedprice AS {D2}) * (1 - CAST(l_discount AS {D2})) AS DECIMAL(20,4)) AS net
            FROM lineitem),
        b AS (SELECT l_orderkey, SUM(net) AS billed FROM li GROUP BY l_orderkey),
        o AS (
            SELECT o.o_orderkey, o.o_custkey,
                   CASE WHEN o.o_orderstatus = 'F'
                        THEN CAST(CAST(o.o_totalprice AS {D2}) - COALESCE(CAST(b.billed AS DECIMAL(24,4)), 0)
                                  AS DECIMAL(24,4))
                        ELSE CAST(0 AS DECIMAL(24,4)) END AS gap
            FROM orders o LEFT JOIN b ON o.o_orderkey = b.l_orderkey),
        x AS (SELECT o_custkey, SUM(gap) AS e, AVG(gap) AS a FROM o GROUP BY o_custkey)
        SELECT c.c_custkey, COALESCE(CAST(CAST(x.e AS DECIMAL(28,4)) AS DOUBLE), 0.0) AS exposure,
               COALESCE(ROUND(x.a, 8), 0.0) AS avg_gap
        FROM customer c LEFT JOIN x ON c.c_custkey = x.o_custkey""",
    "formula_filter": f"""
        SELECT c.c_custkey, c.c_mktsegment,
               CAST(CASE WHEN c.c_mktsegment = 'BUILDING' AND s.s IS NOT NULL
                         THEN CAST(CAST(c.c_acctbal AS {D2}) + s.s * 0.001 AS {D2})
                         ELSE CAST(c.c_acctbal AS {D2}) END AS DOUBLE) AS c_acctbal
        FROM customer c LEFT JOIN (SELECT o_custkey, SUM(CAST(o_totalprice AS {D2})) AS s
                                   FROM orders GROUP BY o_custkey) s ON c.c_custkey = s.o_custkey""",
    "constant_formula": """
        SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey = 3 THEN 100.0 ELSE c_acctbal END AS c_acctbal
        FROM customer""",
    "waterfall": f"""
        WITH t AS (SELECT c_custkey, MIN(CAST(CAST(c_acctbal AS {D2}) * 500 AS {D2})) AS total
                   FROM customer WHERE c_acctbal >= 0 GROUP BY c_custkey),
        i AS (
            SELECT o_orderkey, o_custkey, CAST(o_totalprice AS {D2}) AS amt,
                   COALESCE(SUM(CAST(o_totalprice AS {D2})) OVER (
                       PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev,
                   ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS pos,
                   COUNT(*) OVER (PARTITION BY o_custkey) AS n
            FROM orders)
        SELECT i.o_orderkey, i.o_custkey,
               CAST(CASE WHEN i.pos = i.n THEN GREATEST(COALESCE(t.total, 0) - i.prev, 0)
                         ELSE LEAST(i.amt, GREATEST(COALESCE(t.total, 0) - i.prev, 0)) END AS DOUBLE) AS allocated,
               i.pos AS allocated_position, i.pos = i.n AS allocated_is_last
        FROM i LEFT JOIN t ON t.c_custkey = i.o_custkey""",
    "cogroup_pair": f"""
        WITH t AS (SELECT c_custkey, MIN(CAST(CAST(c_acctbal AS {D2}) * 500 AS {D2})) AS total
                   FROM customer WHERE c_acctbal >= 0 GROUP BY c_custkey)
        SELECT o.o_orderkey, o.o_custkey, CAST(t.total AS DOUBLE) AS cg_total,
               CAST(COALESCE(SUM(CAST(o.o_totalprice AS {D2})) OVER (
                   PARTITION BY o.o_custkey ORDER BY o.o_orderdate DESC, o.o_orderkey DESC
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS cg_before,
               ROW_NUMBER() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate DESC, o.o_orderkey DESC)
                   AS cg_position,
               ROW_NUMBER() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate DESC, o.o_orderkey DESC)
                   = COUNT(*) OVER (PARTITION BY o.o_custkey) AS cg_is_last
        FROM orders o LEFT JOIN t ON t.c_custkey = o.o_custkey""",
    "waterfall_fold": f"""
        WITH RECURSIVE t AS (
            SELECT c_custkey, CAST(CAST(c_acctbal AS {D2}) * 500 AS {D2}) AS total
            FROM customer),
        i AS (
            SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS {D2}) - 250000 AS {D2}) AS amt,
                   ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS pos,
                   COUNT(*) OVER (PARTITION BY o_custkey) AS n
            FROM orders),
        r(o_custkey, pos, rem) AS (
            SELECT i.o_custkey, i.pos, CAST(COALESCE(t.total, 0) AS DECIMAL(38,2))
            FROM i LEFT JOIN t ON t.c_custkey = i.o_custkey WHERE i.pos = 1
            UNION ALL
            SELECT r.o_custkey, r.pos + 1,
                   CAST(CASE WHEN i.amt >= r.rem THEN 0 ELSE r.rem - i.amt END AS DECIMAL(38,2))
            FROM r JOIN i ON i.o_custkey = r.o_custkey AND i.pos = r.pos
            WHERE r.pos < i.n)
        SELECT i.o_orderkey, i.o_custkey,
               CAST(CASE WHEN i.pos = i.n THEN r.rem WHEN i.amt >= r.rem THEN r.rem ELSE i.amt END AS DOUBLE)
                   AS allocated,
               i.pos AS allocated_position, i.pos = i.n AS allocated_is_last
        FROM i JOIN r ON r.o_custkey = i.o_custkey AND r.pos = i.pos""",
    "json_scan_sum": """
        SELECT event_type, COUNT(*) AS n, CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
               CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sum_value
        FROM events GROUP BY event_type""",
    "waterfall_json": """
        WITH t AS (SELECT CAST(user_id AS VARCHAR) AS g, CAST(FLOOR(SUM(CAST(value AS DECIMAL(18,2)))) AS BIGINT) AS total
                   FROM events GROUP BY user_id),
        i AS (
            SELECT CAST(user_id AS VARCHAR) AS g, CAST(event_id AS VARCHAR) AS c,
                   CAST(json_extract_string(props, '$.k') AS BIGINT) AS amt
            FROM events),
        s AS (
            SELECT g, c, amt,
                   COALESCE(SUM(amt) OVER (PARTITION BY g ORDER BY c DESC
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev,
                   ROW_NUMBER() OVER (PARTITION BY g ORDER BY c DESC) AS pos,
                   COUNT(*) OVER (PARTITION BY g) AS n
            FROM i)
        SELECT s.g AS user_id, s.c AS event_id,
               CAST(CASE WHEN s.pos = s.n THEN GREATEST(COALESCE(t.total, 0) - s.prev, 0)
                         ELSE LEAST(s.amt, GREATEST(COALESCE(t.total, 0) - s.prev, 0)) END AS BIGINT) AS allocated
        FROM s LEFT JOIN t ON t.g = s.g""",
    "scan_project": """
        SELECT l_orderkey AS id, l_partkey, l_quantity AS eng, CAST(2.0 AS DOUBLE) AS const_eng
        FROM lineitem WHERE l_returnflag = 'A'""",
    "param_script": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderdate BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' AND o_orderstatus = 'F'""",
    "normalise_types": f"""
        SELECT sha256('{{"o_orderkey":' || CAST(o_orderkey AS VARCHAR) || '}}') AS row_id,
               CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS DOUBLE) AS cust_no,
               CAST(CAST(o_totalprice AS {D2}) AS DOUBLE) AS price,
               strftime(o_orderdate, '%Y%m%d%H%M%S') AS order_time, o_orderstatus AS status, CAST(0 AS DOUBLE) AS settled
        FROM orders""",
    "attach_old_id": """
        SELECT c.c_custkey, c.c_nationkey, t.row_key AS old_id
        FROM customer c LEFT JOIN (SELECT c_custkey, c_nationkey, 'C' || CAST(c_custkey AS VARCHAR) AS row_key
                                   FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)) t
          ON c.c_custkey = t.c_custkey AND c.c_nationkey = t.c_nationkey""",
    "dup_keys": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "in_list_join": """
        SELECT c.c_custkey, n.n_name, r.r_name
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey
        WHERE r.r_name IN ('ASIA', 'EUROPE')""",
    "nested_left_join": """
        SELECT c.c_custkey, COALESCE(x.n_lines, 0) AS n_lines, COALESCE(x.qty, 0.0) AS qty
        FROM customer c LEFT JOIN (
            SELECT o.o_custkey, COUNT(*) AS n_lines, SUM(l.l_quantity) AS qty
            FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
            WHERE l.l_returnflag = 'R' GROUP BY o.o_custkey) x ON c.c_custkey = x.o_custkey""",
    "three_way_join": """
        SELECT l.l_orderkey, l.l_linenumber, c.c_name, o.o_orderstatus, l.l_extendedprice
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey""",
    "distinct_expr": """
        SELECT DISTINCT family, family || '_G' AS guid, CAST(0 AS BIGINT) AS eng
        FROM (SELECT CASE WHEN position(' ' IN p_name) = 0 THEN p_name
                          ELSE left(p_name, length(p_name) - position(' ' IN reverse(p_name))) END AS family
              FROM part)""",
    "first_per_key": """
        SELECT user_id, event_type, value FROM (
            SELECT user_id, event_type, value,
                   ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
        WHERE rn = 1""",
    "text_scan": f"""
        SELECT o_orderstatus AS status, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS {D2})) AS DOUBLE) AS total
        FROM orders GROUP BY o_orderstatus""",
    "json_map": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "string_fns": """
        SELECT p_partkey,
               CASE WHEN position(' ' IN p_name) = 0 THEN p_name
                    ELSE left(p_name, length(p_name) - position(' ' IN reverse(p_name))) END AS family,
               p_brand || '1' AS brand1, p_brand AS brand_back
        FROM part""",
    "date_fns": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d%H%M%S') AS ts_text, strftime(o_orderdate, '%Y%m') AS ym,
               strptime(strftime(o_orderdate, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S') = o_orderdate AS roundtrip,
               CAST(date_diff('day', DATE '1970-01-01', CAST(date_trunc('month', o_orderdate) AS DATE)) AS INTEGER)
                   AS month_days,
               strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') = o_orderdate
                   AS sec_roundtrip
        FROM orders""",
    "hash_bucket_portable": """
        SELECT CAST((('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15))::BIGINT) % 50 AS INTEGER) AS bucket,
               COUNT(*) AS n
        FROM orders GROUP BY 1""",
    "udf_scalar": """
        WITH c AS (SELECT p_partkey, list_transform(range(1, length(p_name) + 1), lambda i: ascii(p_name[i])) AS v,
                          length(p_name) AS n FROM part)
        SELECT p_partkey, CAST((1 + coalesce(list_sum(v), 0)) % 65521
               + 65536 * ((n + coalesce(list_sum(list_transform(range(1, n + 1), lambda i: (n - i + 1) * v[i])), 0)) % 65521) AS BIGINT)
               AS checksum
        FROM c""",
    "udaf_group": """
        SELECT l_orderkey, ROUND(EXP(AVG(LN(l_quantity))), 6) AS qty_mean FROM lineitem GROUP BY l_orderkey""",
    "hash_bucket": "SELECT COUNT(*) AS n_rows, true AS in_range FROM orders",
    "avg_global": f"""
        SELECT r_regionkey, r_name,
               (SELECT CAST(ROUND(AVG(CAST(c_acctbal AS {D2})), 6) AS DOUBLE) FROM customer) AS avg_bal
        FROM region""",
    "lookup_global": """
        SELECT c_custkey, c_nationkey, (SELECT r_regionkey FROM region WHERE r_name = 'ASIA') AS asia FROM customer""",
    "lookup_filtered_dup": """
        SELECT o_orderkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'F' THEN coalesce(p + p * 2, 0.0) ELSE 0.0 END AS x
        FROM orders LEFT JOIN (SELECT l_orderkey, MAX(l_extendedprice) AS p FROM lineitem GROUP BY l_orderkey)
          ON o_orderkey = l_orderkey""",
    "filter_fractional": """
        SELECT c_custkey, c_nationkey, 0 AS a, CAST(c_nationkey = 3 AS INTEGER) AS b, CAST(c_nationkey = 3 AS INTEGER) AS c
        FROM customer""",
    "normalise_nulls": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderkey % 3 AS DOUBLE) AS num,
               CASE WHEN o_orderstatus <> 'F' THEN CAST(CAST(o_totalprice AS {D2}) AS DOUBLE) ELSE 0.0 END AS price,
               CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y%m%d%H%M%S') END AS day,
               nullif(o_orderstatus, 'P') AS status
        FROM orders""",
    "upsert_dates": """
        SELECT CASE WHEN o_orderstatus = 'F' THEN 'S' || CAST(o_orderkey AS VARCHAR) END AS id,
               CAST(o_orderkey AS VARCHAR) AS order_no, o_orderdate AS day, o_totalprice AS price,
               CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey
        FROM orders""",
    "save_overwrite": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "save_allocation": f"""
        WITH RECURSIVE b AS (
            SELECT l_orderkey, SUM(CAST(CAST(l_extendedprice AS {D2}) * (1 - CAST(l_discount AS {D2})) AS DECIMAL(20,4))) AS billed
            FROM lineitem GROUP BY l_orderkey),
        i AS (
            SELECT o_orderkey, o_custkey,
                   CAST(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS {D2}) - COALESCE(billed, 0) ELSE 0 END AS {D2}) AS amt,
                   ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS pos,
                   COUNT(*) OVER (PARTITION BY o_custkey) AS n
            FROM orders LEFT JOIN b ON o_orderkey = l_orderkey),
        t AS (SELECT c_custkey, CAST(CAST(c_acctbal AS {D2}) * 100 AS {D2}) AS total FROM customer),
        r(o_custkey, pos, rem) AS (
            SELECT i.o_custkey, i.pos, CAST(COALESCE(t.total, 0) AS DECIMAL(38,2))
            FROM i LEFT JOIN t ON t.c_custkey = i.o_custkey WHERE i.pos = 1
            UNION ALL
            SELECT r.o_custkey, r.pos + 1,
                   CAST(CASE WHEN i.amt >= r.rem THEN 0 ELSE r.rem - i.amt END AS DECIMAL(38,2))
            FROM r JOIN i ON i.o_custkey = r.o_custkey AND i.pos = r.pos
            WHERE r.pos < i.n)
        SELECT i.o_orderkey, i.o_custkey, CAST(i.amt AS DOUBLE) AS amt,
               CAST(CASE WHEN i.pos = i.n THEN r.rem WHEN i.amt >= r.rem THEN r.rem ELSE i.amt END AS DOUBLE) AS allocated
        FROM i JOIN r ON r.o_custkey = i.o_custkey AND r.pos = i.pos""",
    "upsert_split": f"""
        WITH s AS (SELECT o_custkey, SUM(CAST(o_totalprice AS {D2})) AS s FROM orders GROUP BY o_custkey),
        chg AS (
            SELECT c.c_custkey, c.c_name, c.c_mktsegment,
                   CASE WHEN c.c_mktsegment = 'BUILDING' AND s.s IS NOT NULL
                        THEN CAST(CAST(c.c_acctbal AS {D2}) + s.s * 0.001 AS {D2})
                        ELSE CAST(c.c_acctbal AS {D2}) END AS bal
            FROM customer c LEFT JOIN s ON c.c_custkey = s.o_custkey)
        SELECT CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'update' ELSE 'insert' END AS action,
               c_custkey AS cust_id, c_name AS name, CAST(bal AS DOUBLE) AS balance
        FROM chg""",
    "upsert_merge": f"""
        WITH s AS (SELECT o_custkey, SUM(CAST(o_totalprice AS {D2})) AS s FROM orders GROUP BY o_custkey)
        SELECT c.c_custkey AS cust_id, c.c_name AS name,
               CAST(CASE WHEN c.c_mktsegment = 'BUILDING' AND s.s IS NOT NULL
                         THEN CAST(CAST(c.c_acctbal AS {D2}) + s.s * 0.001 AS {D2})
                         ELSE CAST(c.c_acctbal AS {D2}) END AS DOUBLE) AS balance
        FROM customer c LEFT JOIN s ON c.c_custkey = s.o_custkey""",
    "ordered_topk": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
        ORDER BY l_extendedprice DESC, l_orderkey, {LINE_ORDER} LIMIT 10""",
}

ORACLE_SQL["save_changed_roundtrip"] = ORACLE_SQL["formula_chain"]
