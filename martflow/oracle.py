"""The registered queries as SQL over the plain test tables."""

from __future__ import annotations

# The tables read as warehouse records, as ``adapt.py`` reads them.
CTES = {
    "ev": """
        SELECT event_id, epoch_us(ts) // 1000 AS ts, user_id, event_type, value,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events""",
    "lg": """
        SELECT event_id, ts, k, value, event_type,
               CAST(user_id AS VARCHAR) AS mid,
               'v' || (k % 3) AS vc, 'ch' || (k % 4) AS ch, 'ar' || (k % 5) AS ar,
               CASE WHEN event_type IN ('signup', 'view') THEN '1' ELSE '0' END AS is_new,
               CASE event_type WHEN 'click' THEN 'good_detail' WHEN 'view' THEN 'home'
                    WHEN 'signup' THEN 'home' WHEN 'purchase' THEN 'payment' END AS page_id,
               CASE WHEN event_type IN ('signup', 'error') THEN NULL
                    WHEN event_type = 'view' AND k < 30 THEN '' ELSE 'prev' END AS last_page_id,
               CASE WHEN event_type = 'click'
                    THEN CAST(user_id * 14 + k % 14 AS VARCHAR) END AS item,
               CASE WHEN k > 0 AND event_type <> 'error'
                    THEN CAST(floor(value) AS BIGINT) END AS during_time,
               user_id * 14 + k % 14 AS sku
        FROM ev""",
    "pg": "SELECT * FROM lg WHERE event_type <> 'error'",
    "first_day": """
        SELECT mid, strftime(epoch_ms(min(ts)), '%Y%m%d') AS first_day
        FROM lg WHERE is_new = '1' GROUP BY mid""",
    "fx": """
        SELECT lg.* EXCLUDE (is_new),
               CASE WHEN is_new = '1' AND first_day <> strftime(epoch_ms(ts), '%Y%m%d')
                    THEN '0' ELSE is_new END AS is_new
        FROM lg LEFT JOIN first_day USING (mid)""",
    "entries": "SELECT * FROM pg WHERE coalesce(last_page_id, '') = ''",
    "uv": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY mid, strftime(epoch_ms(ts), '%Y%m%d') ORDER BY ts, event_id) AS rn
            FROM entries) WHERE rn = 1""",
    "uj": """
        SELECT * EXCLUDE (next_ts) FROM (
            SELECT *, lead(ts) OVER (PARTITION BY mid ORDER BY ts, event_id) AS next_ts FROM pg)
        WHERE coalesce(last_page_id, '') = ''
          AND (next_ts IS NULL OR next_ts - ts >= 21600000)""",
    "vm": """
        SELECT event_id, vc, ch, ar, is_new, 0 AS uv_ct, 1 AS pv_ct,
               CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS sv_ct, 0 AS uj_ct,
               coalesce(during_time, 0) AS dur_sum, ts FROM pg
        UNION ALL SELECT event_id, vc, ch, ar, is_new, 1, 0, 0, 0, 0, ts FROM uv
        UNION ALL SELECT event_id, vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts FROM uj""",
    "vs": """
        SELECT strftime(epoch_ms(day_ms), '%Y-%m-%d %H:%M:%S') AS stt,
               strftime(epoch_ms(day_ms + 86400000), '%Y-%m-%d %H:%M:%S') AS edt,
               vc, ch, ar, is_new,
               CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
               CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct,
               CAST(sum(dur_sum) AS BIGINT) AS dur_sum, min(ts) AS ts
        FROM (SELECT vm.* EXCLUDE (is_new), fx.is_new, vm.ts // 86400000 * 86400000 AS day_ms
              FROM vm JOIN fx USING (event_id))
        GROUP BY day_ms, vc, ch, ar, is_new""",
    "env": """
        SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS id, 'n' || k AS name,
               CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS amount,
               CASE event_type WHEN 'signup' THEN 'insert' WHEN 'view' THEN 'read'
                    WHEN 'error' THEN 'delete' ELSE 'update' END AS type,
               CASE WHEN k % 2 = 0 THEN 'user_info' ELSE 'sku_info' END AS tbl
        FROM ev""",
    "chg": """
        SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS id, k, event_type,
               CASE WHEN event_type = 'click' THEN CASE WHEN k >= 10 THEN 'u' || k END
                    WHEN event_type <> 'error' THEN 'n' || k END AS name,
               CASE WHEN event_type NOT IN ('click', 'error')
                    THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS amount,
               CASE k % 4 WHEN 0 THEN 'user_info' WHEN 1 THEN 'sku_info'
                    WHEN 2 THEN 'order_info' ELSE 'cart_info' END AS tbl,
               CASE event_type WHEN 'view' THEN 'bootstrap-insert' WHEN 'click' THEN 'update'
                    WHEN 'error' THEN 'delete' ELSE 'insert' END AS type
        FROM ev WHERE k <> 99 AND (k NOT IN (97, 98) OR event_type = 'error')""",
    "rules": """
        SELECT * FROM (VALUES
            ('user_info', 'insert', 'hbase', 'dim_user_info', 'id,name'),
            ('user_info', 'update', 'hbase', 'dim_user_info', 'id,name'),
            ('user_info', 'delete', 'hbase', 'dim_user_info', 'id,name'),
            ('sku_info', 'delete', 'hbase', 'dim_sku_info', 'id,name,amount'),
            ('sku_info', 'insert', 'hbase', 'dim_sku_info', 'id,name,amount'),
            ('order_info', 'insert', 'kafka', 'dwd_order_info', ''),
            ('order_info', 'update', 'kafka', 'dwd_order_update', 'id,amount'))
        AS r(tbl, type, sink_type, sink_table, sink_columns)""",
    "routed": """
        SELECT seq, c.tbl, r.type, sink_type, sink_table, sink_columns, event_type, id, name, amount
        FROM chg c JOIN rules r ON c.tbl = r.tbl
         AND CASE c.type WHEN 'bootstrap-insert' THEN 'insert' ELSE c.type END = r.type""",
    "ow": """
        SELECT l_orderkey * 10 + l_linenumber AS detail_id, o_orderkey AS order_id,
               l_partkey + 50 AS sku_id, CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price,
               CAST(l_quantity AS BIGINT) AS sku_num, 'from order' AS sku_name,
               o_custkey % 27 AS province_id, o_orderstatus AS order_status,
               o_custkey + 20 AS user_id, CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
               CAST(0 AS DECIMAL(16,2)) AS activity_reduce_amount,
               CAST(o_orderkey % 7 AS DECIMAL(16,2)) AS coupon_reduce_amount,
               CAST(o_totalprice AS DECIMAL(16,2)) + o_orderkey % 7 AS original_total_amount,
               CAST(o_orderkey % 20 AS DECIMAL(16,2)) AS feight_fee,
               CAST(NULL AS DECIMAL(16,2)) AS split_feight_fee, CAST(NULL AS VARCHAR) AS expire_time,
               CAST(l_tax AS DECIMAL(16,2)) AS split_activity_amount,
               CAST(l_discount AS DECIMAL(16,2)) AS split_coupon_amount,
               CAST(l_extendedprice AS DECIMAL(16,2)) AS split_total_amount,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
               strftime(o_orderdate + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS operate_time,
               strftime(o_orderdate, '%Y-%m-%d') AS create_date,
               strftime(o_orderdate, '%H') AS create_hour, o_orderdate, o_custkey, l_partkey
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        WHERE l_shipdate BETWEEN o_orderdate - INTERVAL 90 DAY AND o_orderdate + INTERVAL 90 DAY""",
    "sku": """
        SELECT p_partkey AS id, p_name AS sku_name,
               CAST(p_retailprice AS DECIMAL(16,2)) AS sku_price, p_size + 3 AS spu_id,
               CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) AS tm_id,
               ascii(p_type) + length(p_type) AS category3_id,
               p_brand AS tm_name, p_type AS category3_name,
               (SELECT DISTINCT 'SPU ' || s.p_size FROM part s
                WHERE s.p_size = part.p_size + 3) AS spu_name
        FROM part""",
    "pw": """
        SELECT o.o_orderkey + 1000000000 AS payment_id, o.o_orderkey AS order_id,
               o.o_custkey + 20 AS user_id,
               CAST(o.o_totalprice AS DECIMAL(16,2)) - 1 AS total_amount,
               o.o_orderpriority AS subject, '1101' AS payment_type,
               strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS payment_create_time,
               strftime(o.o_orderdate + to_seconds(o.o_orderkey % 3600), '%Y-%m-%d %H:%M:%S')
                   AS callback_time,
               ow.create_time AS order_create_time,
               ow.* EXCLUDE (order_id, user_id, total_amount, create_time, operate_time,
                             create_date, create_hour, expire_time, o_orderdate, o_custkey,
                             l_partkey)
        FROM orders o JOIN ow ON o.o_orderkey = ow.order_id
        WHERE o.o_orderstatus = 'F'
          AND ow.o_orderdate BETWEEN o.o_orderdate + to_seconds(o.o_orderkey % 3600)
                                     - INTERVAL 1800 SECOND
                                 AND o.o_orderdate + to_seconds(o.o_orderkey % 3600)""",
    "pm": """
        SELECT CAST(item AS BIGINT) AS sku_id, ts, 'click' AS kind, NULL AS order_id, 1 AS n,
               0 AS good, NULL AS amount FROM pg WHERE page_id = 'good_detail'
        UNION ALL SELECT sku, ts, 'display', NULL, 1, 0, NULL FROM pg
                  WHERE event_type IN ('view', 'click')
        UNION ALL SELECT sku_id, epoch_ms(o_orderdate), 'order', order_id, sku_num, 0,
                  split_total_amount FROM ow
        UNION ALL SELECT sku_id, epoch_ms(CAST(order_create_time AS TIMESTAMP)), 'paid', order_id,
                  1, 0, split_total_amount FROM pw
        UNION ALL SELECT sku, ts // 1000 * 1000, 'cart', NULL, 1, 0, NULL FROM lg
                  WHERE event_type = 'view'
        UNION ALL SELECT sku, ts // 1000 * 1000, 'favor', NULL, 1, 0, NULL FROM lg
                  WHERE event_type = 'signup'
        UNION ALL SELECT l_partkey + 50, epoch_ms(l_shipdate), 'refund', l_orderkey, 1, 0,
                  CASE WHEN l_discount > 0 THEN CAST(l_extendedprice AS DECIMAL(16,2)) END
                  FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL SELECT sku, ts // 1000 * 1000, 'comment', NULL, 1,
                  CASE WHEN k < 50 THEN 1 ELSE 0 END, NULL FROM lg
                  WHERE event_type = 'purchase'""",
    "ps": """
        SELECT strftime(epoch_ms(day_ms), '%Y-%m-%d %H:%M:%S') AS stt,
               strftime(epoch_ms(day_ms + 86400000), '%Y-%m-%d %H:%M:%S') AS edt, sku_id,
               CAST(coalesce(sum(n) FILTER (WHERE kind = 'display'), 0) AS BIGINT) AS display_ct,
               CAST(coalesce(sum(n) FILTER (WHERE kind = 'click'), 0) AS BIGINT) AS click_ct,
               CAST(coalesce(sum(n) FILTER (WHERE kind = 'favor'), 0) AS BIGINT) AS favor_ct,
               CAST(coalesce(sum(n) FILTER (WHERE kind = 'cart'), 0) AS BIGINT) AS cart_ct,
               CAST(coalesce(sum(n) FILTER (WHERE kind = 'order'), 0) AS BIGINT) AS order_sku_num,
               coalesce(sum(amount) FILTER (WHERE kind = 'order'), 0) AS order_amount,
               count(DISTINCT order_id) FILTER (WHERE kind = 'order') AS order_ct,
               coalesce(sum(amount) FILTER (WHERE kind = 'paid'), 0) AS payment_amount,
               count(DISTINCT order_id) FILTER (WHERE kind = 'paid') AS paid_order_ct,
               count(DISTINCT order_id) FILTER (WHERE kind = 'refund') AS refund_order_ct,
               coalesce(sum(amount) FILTER (WHERE kind = 'refund'), 0) AS refund_amount,
               CAST(coalesce(sum(n) FILTER (WHERE kind = 'comment'), 0) AS BIGINT) AS comment_ct,
               CAST(sum(good) AS BIGINT) AS good_comment_ct, min(ts) AS ts
        FROM (SELECT *, ts // 86400000 * 86400000 AS day_ms FROM pm) GROUP BY day_ms, sku_id""",
    "ops": """
        SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stt, ow.sku_id,
               sum(split_total_amount) AS order_amount, count(DISTINCT order_id) AS order_ct,
               CAST(sum(sku_num) AS BIGINT) AS order_sku_num, any_value(s.sku_name) AS sku_name,
               any_value(sku_price) AS sku_price, any_value(spu_id) AS spu_id,
               any_value(tm_id) AS tm_id, any_value(category3_id) AS category3_id,
               any_value(spu_name) AS spu_name, any_value(tm_name) AS tm_name,
               any_value(category3_name) AS category3_name
        FROM ow LEFT JOIN sku s ON ow.sku_id = s.id GROUP BY o_orderdate, ow.sku_id""",
    "owp": """
        SELECT ow.*, n_name AS province_name,
               CAST(n_nationkey + 100 AS VARCHAR) AS area_code, 'R' || n_regionkey AS iso_code,
               'R-' || n_nationkey AS iso_3166_2
        FROM ow LEFT JOIN nation ON province_id = n_nationkey""",
    "kw": """
        SELECT keyword, ts FROM (
            SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS keyword,
                   1704067200000 + (conv_id * 7 + turn) * 1000 AS ts
            FROM conversations WHERE role = 'user') WHERE keyword <> ''""",
}

_LOG = "event_id, mid, vc, ch, ar, is_new, page_id, last_page_id, item, during_time, ts"

_BODIES = {
    "parse_events": f"""
        SELECT {_LOG}, CASE WHEN event_type IN ('view', 'click', 'error') THEN 2 ELSE 0 END AS displays
        FROM lg WHERE NOT coalesce(during_time < 1, FALSE)""",
    "parse_rejects": "SELECT event_id FROM lg WHERE during_time < 1",
    "fix_is_new": "SELECT event_id, mid, is_new, ts FROM fx",
    "split_start": """
        SELECT event_id, 'icon' AS entry, CAST(k AS VARCHAR) AS loading
        FROM lg WHERE event_type = 'error'""",
    "split_page": f"SELECT {_LOG} FROM pg",
    "split_display": """
        SELECT CAST(sku AS VARCHAR) AS item, 'sku_id' AS item_type, page_id
        FROM pg WHERE event_type IN ('view', 'click')
        UNION ALL SELECT CAST(k AS VARCHAR), 'activity_id', page_id
        FROM pg WHERE event_type IN ('view', 'click')""",
    "session_entries": f"SELECT {_LOG} FROM entries",
    "unique_visit": f"SELECT {_LOG} FROM uv",
    "user_jump": f"SELECT {_LOG} FROM uj",
    "visitor_union": "SELECT * EXCLUDE (event_id) FROM vm",
    "visitor_stats": "SELECT * FROM vs",
    "cdc_normalize": """
        SELECT seq, 'shop' AS database, tbl AS "table", type,
               CASE WHEN type = 'delete' THEN 0 ELSE 3 END AS fields,
               CASE WHEN type <> 'delete' THEN id END AS id,
               CASE WHEN type <> 'delete' THEN name END AS name,
               CASE WHEN type <> 'delete' THEN amount END AS amount FROM env""",
    "cdc_latest": """
        SELECT tbl AS "table", id, type, name, amount FROM (
            SELECT *, row_number() OVER (PARTITION BY tbl, id ORDER BY seq DESC) AS rn FROM env)
        WHERE rn = 1 AND type <> 'delete'""",
    "change_filter": """SELECT seq, tbl AS "table", type FROM chg""",
    "route_changes": """
        SELECT seq, tbl AS "table", type, sink_type, sink_table, 'id' AS sink_pk,
               CASE WHEN type = 'delete' THEN 0 WHEN sink_table = 'dwd_order_update' THEN 1
                    WHEN sink_table = 'dim_user_info' THEN 2 ELSE 3 END AS fields
        FROM routed""",
    "route_changes_as_of": """
        WITH half AS (SELECT max(event_id) // 2 AS half FROM events),
        all_rules AS (
            SELECT tbl, type AS op, sink_type, sink_table FROM rules
            UNION ALL SELECT 'cart_info', 'insert', 'clickhouse', 'ck_cart_info'),
        typed AS (
            SELECT * REPLACE (CASE type WHEN 'bootstrap-insert' THEN 'insert' ELSE type END AS type)
            FROM chg),
        versions AS (
            SELECT r.* REPLACE (
                       CASE WHEN l.late AND r.tbl = 'order_info' AND r.op = 'update'
                            THEN 'dwd_later' ELSE sink_table END AS sink_table),
                   l.late AND r.tbl = 'user_info' AND r.op = 'update' AS id_only,
                   CASE WHEN l.late THEN half ELSE 0 END AS since,
                   CASE WHEN NOT l.late THEN half END AS until
            FROM all_rules r, half, (VALUES (false), (true)) l(late)
            WHERE NOT (l.late AND r.tbl = 'sku_info' AND r.op = 'delete')
              AND NOT (NOT l.late AND r.tbl = 'order_info' AND r.op = 'insert')),
        met AS (
            SELECT c.*, v.* EXCLUDE (tbl, op)
            FROM typed c JOIN versions v ON c.tbl = v.tbl AND c.type = v.op
              AND c.seq >= v.since AND (v.until IS NULL OR c.seq < v.until))
        SELECT seq, tbl AS "table", sink_type, sink_table,
               CASE WHEN type = 'delete' THEN 0 WHEN sink_table IN ('dwd_order_update', 'dwd_later') THEN 1
                    WHEN id_only THEN 1 WHEN sink_table = 'dim_user_info' THEN 2 ELSE 3 END AS fields
        FROM met WHERE sink_type IN ('hbase', 'kafka')
        UNION ALL
        SELECT seq, tbl, NULL, NULL, CASE type WHEN 'delete' THEN 0 WHEN 'update' THEN 2 ELSE 3 END
        FROM typed c SEMI JOIN all_rules r ON c.tbl = r.tbl AND c.type = r.op
        ANTI JOIN met USING (seq)""",
    "cdc_handover": """
        SELECT tbl AS "table", id, name, amount FROM (
            SELECT *, row_number() OVER (PARTITION BY tbl, id ORDER BY seq DESC) AS rn FROM env)
        WHERE rn = 1 AND type <> 'delete'""",
    "dim_point_lookup": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey + 50 AS sku_id,
               coalesce(p_name, 'from order') AS sku_name, CAST(p_size + 3 AS VARCHAR) AS spu_id
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey + 50""",
    "project_columns": """
        SELECT seq, CASE WHEN type <> 'delete' THEN id END AS id,
               CASE WHEN sink_table <> 'dwd_order_update' THEN name END AS name,
               CASE WHEN sink_table <> 'dim_user_info' THEN amount END AS amount
        FROM routed""",
    "dim_upsert": """
        SELECT sink_table, id,
               arg_max(coalesce(name, ''), seq) AS name,
               CASE WHEN sink_table = 'dim_sku_info' THEN arg_max(amount, seq) END AS amount
        FROM (SELECT *, coalesce(max(seq) FILTER (WHERE type = 'delete')
                                 OVER (PARTITION BY sink_table, id), -1) AS gone
              FROM routed WHERE sink_type = 'hbase')
        WHERE type <> 'delete' AND seq > gone GROUP BY sink_table, id""",
    "to_json_rows": """
        SELECT 'dwd_order_refund_info' AS topic,
               '{"sku_id":' || (l_partkey + 50) || ',"order_id":' || l_orderkey
               || CASE WHEN l_discount > 0 THEN ',"refund_amount":'
                       || CAST(l_extendedprice AS DECIMAL(16,2)) ELSE '' END
               || ',"create_time":"' || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || '"}' AS value
        FROM lineitem WHERE l_returnflag = 'R'""",
    "order_wide": "SELECT * EXCLUDE (o_orderdate, o_custkey, l_partkey) FROM ow",
    "order_wide_user": """
        SELECT detail_id, sku_id, order_price, user_id,
               date_diff('year', born, DATE '2024-06-01')
                 - CASE WHEN strftime(DATE '2024-06-01', '%m%d') < strftime(born, '%m%d')
                        THEN 1 ELSE 0 END AS user_age,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'F' WHEN c_custkey IS NOT NULL THEN 'M' END
                 AS user_gender
        FROM ow LEFT JOIN (
            SELECT *, CASE WHEN c_nationkey <> 7 THEN
                DATE '1950-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) END AS born
            FROM customer) u ON ow.user_id = u.c_custkey""",
    "order_wide_dims": """
        SELECT detail_id, order_price, ow.sku_id, coalesce(s.sku_name, ow.sku_name) AS sku_name,
               province_id, n_name AS province_name,
               CAST(n_nationkey + 100 AS VARCHAR) AS province_area_code,
               'R' || n_regionkey AS province_iso_code, 'R-' || n_nationkey AS province_3166_2_code,
               spu_id, tm_id, category3_id, spu_name, tm_name, category3_name
        FROM ow LEFT JOIN sku s ON ow.sku_id = s.id LEFT JOIN nation ON province_id = n_nationkey""",
    "dim_lookup_multi": """
        SELECT s_suppkey, segment, nation, (
            SELECT c_name FROM customer WHERE c_mktsegment = segment AND c_nationkey = nation
            ORDER BY c_custkey LIMIT 1) AS contact
        FROM (SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN 'BUILDING' ELSE 'NOBODY' END AS segment,
                     s_nationkey + 2 AS nation FROM supplier)""",
    "payment_wide": "SELECT * FROM pw",
    "order_wide_merge": """
        SELECT coalesce(l.detail_id, r.detail_id) AS detail_id, l.order_id,
               coalesce(l.order_status, CASE WHEN r.detail_id IS NOT NULL THEN 'other' END)
                 AS order_status,
               coalesce(l.create_time, r.create_time) AS create_time,
               coalesce(CASE WHEN l.order_status = 'O' THEN l.total_amount END, r.total_amount)
                 AS total_amount,
               coalesce(l.user_id, r.user_id) AS user_id, coalesce(l.sku_id, r.sku_id) AS sku_id,
               coalesce(l.sku_num, r.sku_num) AS sku_num, l.split_total_amount
        FROM (SELECT * FROM one WHERE order_status <> 'P') l
        FULL JOIN (SELECT * FROM one WHERE total_amount > 150000) r ON l.detail_id = r.detail_id""",
    "province_stats": """
        SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stt,
               strftime(o_orderdate + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS edt,
               province_id, province_name, area_code, iso_code, iso_3166_2,
               sum(split_total_amount) AS order_amount, count(DISTINCT order_id) AS order_count,
               epoch_ms(o_orderdate) AS ts
        FROM owp GROUP BY ALL""",
    "product_clicks": """
        SELECT CAST(item AS BIGINT) AS sku_id, ts, CAST(1 AS BIGINT) AS click_ct
        FROM pg WHERE page_id = 'good_detail'""",
    "product_displays": """
        SELECT sku AS sku_id, ts, CAST(1 AS BIGINT) AS display_ct
        FROM pg WHERE event_type IN ('view', 'click')""",
    "product_stats": "SELECT * FROM ps",
    "product_stats_dims": """
        SELECT ps.*, s.* EXCLUDE (id) FROM ps LEFT JOIN sku s ON ps.sku_id = s.id""",
    "keyword_tokens": "SELECT keyword, ts FROM kw",
    "keyword_lateral": "SELECT keyword, ts FROM kw",
    # Places of a run from the right; the best of each is kept in front of those behind it.
    "keyword_segments": """
        WITH RECURSIVE dict AS (
            SELECT keyword AS word, count(*) AS weight FROM kw WHERE length(keyword) <= 4 GROUP BY 1),
        held AS (SELECT map(list(word), list(weight)) AS m FROM dict),
        dp AS (
            SELECT DISTINCT keyword AS run, length(keyword) AS p,
                   [{'u': 0::BIGINT, 'w': 0::BIGINT, 's': 0::BIGINT, 'l': 0::BIGINT}] AS best FROM kw
            UNION ALL
            SELECT run, p - 1, list_prepend(list_sort(list_concat(
                [{'u': best[1].u + 1, 'w': best[1].w, 's': best[1].s, 'l': 0::BIGINT}],
                list_transform(
                    list_filter(range(1, least(4, length(run) - p + 1) + 1),
                                lambda k: m[substr(run, p, k)] IS NOT NULL),
                    lambda k: {'u': best[k].u, 'w': best[k].w + 1,
                               's': best[k].s - m[substr(run, p, k)], 'l': -k})))[1], best)
            FROM dp, held WHERE p > 0),
        walk AS (
            SELECT run, best, CAST(1 AS BIGINT) AS place FROM dp WHERE p = 0
            UNION ALL
            SELECT run, best, place + greatest(1, -best[place].l) FROM walk WHERE place <= length(run)),
        steps AS (SELECT run, place, -best[place].l AS size FROM walk WHERE place <= length(run)),
        pieces AS (
            SELECT run, place, size FROM steps WHERE size > 0
            UNION ALL
            SELECT run, min(place), count(*) FROM (
                SELECT run, place, place - row_number() OVER (PARTITION BY run ORDER BY place) AS gap
                FROM steps WHERE size = 0) GROUP BY run, gap)
        SELECT substr(run, place, size) AS keyword, ts FROM kw JOIN pieces ON run = keyword""",
    "keyword_stats": """
        SELECT keyword, count(*) AS ct, 'SEARCH' AS source,
               strftime(epoch_ms(ts // 10000 * 10000), '%Y-%m-%d %H:%M:%S') AS stt,
               strftime(epoch_ms(ts // 10000 * 10000 + 10000), '%Y-%m-%d %H:%M:%S') AS edt,
               min(ts) AS ts
        FROM kw GROUP BY keyword, kw.ts // 10000""",
    "stream_fix_is_new": "SELECT mid, is_new, ts FROM fx",
    "stream_unique_visit": f"SELECT {_LOG} FROM uv",
    "stream_user_jump": f"SELECT {_LOG} FROM uj",
    "stream_visitor_stats": """
        SELECT strftime(epoch_ms(day_ms), '%Y-%m-%d %H:%M:%S') AS stt,
               strftime(epoch_ms(day_ms + 86400000), '%Y-%m-%d %H:%M:%S') AS edt,
               vc, ch, ar, is_new, CAST(sum(uv_ct) AS BIGINT) AS uv_ct,
               CAST(sum(pv_ct) AS BIGINT) AS pv_ct, CAST(sum(sv_ct) AS BIGINT) AS sv_ct,
               CAST(sum(uj_ct) AS BIGINT) AS uj_ct, CAST(sum(dur_sum) AS BIGINT) AS dur_sum,
               min(ts) AS ts
        FROM (SELECT *, ts // 86400000 * 86400000 AS day_ms FROM vm)
        GROUP BY day_ms, vc, ch, ar, is_new""",
    "stream_order_wide": "SELECT * EXCLUDE (o_orderdate, o_custkey, l_partkey) FROM ow",
    "stream_product_stats": "SELECT * FROM ps",
    "stream_keyword_stats": """
        SELECT keyword, count(*) AS ct, 'SEARCH' AS source,
               strftime(epoch_ms(slot), '%Y-%m-%d %H:%M:%S') AS stt,
               strftime(epoch_ms(slot + 10000), '%Y-%m-%d %H:%M:%S') AS edt, min(ts) AS ts
        FROM (SELECT keyword, ts, ts // 10000 * 10000 AS slot FROM kw)
        GROUP BY keyword, slot""",
    "time_functions": """
        SELECT event_id, strftime(epoch_ms(ts), '%Y-%m-%d %H:%M:%S') AS text,
               ts // 1000 * 1000 AS millis, strftime(epoch_ms(ts), '%Y%m%d') AS day,
               CAST(strftime(epoch_ms(ts), '%Y%m%d') AS INTEGER) AS day_number,
               strftime(epoch_ms(ts), '%Y-%m-%d %H:%M:%S') AS from_seconds, ts // 1000 AS seconds
        FROM ev""",
    "report_gmv": """
        SELECT sum(order_amount) AS order_amount FROM ops WHERE stt = '1999-12-11 00:00:00'""",
    "report_top_brand": """
        SELECT tm_id, tm_name, sum(order_amount) AS order_amount
        FROM ops WHERE stt = '1999-12-11 00:00:00' GROUP BY ops.tm_id, tm_name
        HAVING sum(order_amount) > 0 ORDER BY order_amount DESC, tm_id LIMIT 20""",
    "report_top_category": """
        SELECT category3_id, category3_name,
               sum(order_amount) AS order_amount
        FROM ops WHERE stt = '1999-12-11 00:00:00' GROUP BY ops.category3_id, category3_name
        HAVING sum(order_amount) > 0 ORDER BY order_amount DESC, category3_id LIMIT 10""",
    "report_province": """
        SELECT province_id, province_name, sum(split_total_amount) AS order_amount
        FROM owp WHERE o_orderdate = TIMESTAMP '1999-12-11' GROUP BY 1, 2""",
    "report_visitor": """
        SELECT is_new, CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
               CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct,
               CAST(sum(dur_sum) AS BIGINT) AS dur_sum
        FROM vs WHERE stt = '2024-01-15 00:00:00' GROUP BY is_new""",
    "report_visitor_ratios": """
        SELECT *,
               CASE WHEN sv_ct = 0 THEN 0 ELSE
                 (uj_ct * 10000 * 2 + sv_ct) // (2 * sv_ct) / 100 END AS uj_rate,
               CASE WHEN sv_ct = 0 THEN 0 ELSE
                 ((dur_sum * 2 + sv_ct) // (2 * sv_ct) + 50) // 100 / 10 END AS dur_per_sv,
               CASE WHEN sv_ct = 0 THEN 0 ELSE
                 (pv_ct * 100 * 2 + sv_ct) // (2 * sv_ct) / 100 END AS pv_per_sv
        FROM (SELECT is_new, CAST(sum(uv_ct) AS BIGINT) AS uv_ct,
                     CAST(sum(pv_ct) AS BIGINT) AS pv_ct, CAST(sum(sv_ct) AS BIGINT) AS sv_ct,
                     CAST(sum(uj_ct) AS BIGINT) AS uj_ct, CAST(sum(dur_sum) AS BIGINT) AS dur_sum
              FROM vs WHERE stt = '2024-01-15 00:00:00' GROUP BY is_new)""",
}

CTES["one"] = """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY detail_id
                ORDER BY sku_id, split_total_amount, sku_num) AS rn FROM ow) WHERE rn = 1"""

# Result columns that are decimals in either engine.
_AMOUNTS = {
    "order_wide": [
        "order_price", "total_amount", "activity_reduce_amount", "coupon_reduce_amount",
        "original_total_amount", "feight_fee", "split_activity_amount", "split_coupon_amount",
        "split_total_amount", "split_feight_fee",
    ],
    "order_wide_user": ["order_price"],
    "order_wide_dims": ["order_price"],
    "order_wide_merge": ["total_amount", "split_total_amount"],
    "province_stats": ["order_amount"],
    "product_stats": ["order_amount", "payment_amount", "refund_amount"],
    "product_stats_dims": ["order_amount", "payment_amount", "refund_amount", "sku_price"],
    "stream_product_stats": ["order_amount", "payment_amount", "refund_amount"],
    "report_gmv": ["order_amount"],
    "report_top_brand": ["order_amount"],
    "report_top_category": ["order_amount"],
    "report_province": ["order_amount"],
    "report_visitor_ratios": ["uj_rate", "dur_per_sv", "pv_per_sv"],
}
_AMOUNTS["payment_wide"] = _AMOUNTS["stream_order_wide"] = _AMOUNTS["order_wide"]


def sql(name: str) -> str:
    """One statement: the readings of the tables, then the query itself."""
    with_clause = ",\n".join(f"    {cte} AS ({body})" for cte, body in CTES.items())
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _AMOUNTS.get(name, []))
    columns = f"* REPLACE ({casts})" if casts else "*"
    return f"WITH\n{with_clause}\nSELECT {columns} FROM ({_BODIES[name]}) AS result"


ORACLE = {name: sql(name) for name in _BODIES}
