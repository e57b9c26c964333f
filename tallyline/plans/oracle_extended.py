"""Independent SQL for the queries in `extended`."""

from __future__ import annotations

from tallyline.plans.extended import CLV_TEST, CLV_TRAIN, CSV_TABLES
from tallyline.plans.oracle import ORACLE, _dbl, _int, _ratio, _sql, _txt

# Blocks of a full run that other registered queries compute alike; the rest is counted below.
_SAME_ROWS = {
    "executive_kpis": "executive_kpis", "monthly_trend": "monthly_trend", "rfm_segments": "rfm_summary",
    "geographic": "geographic_performance", "category_performance": "category_performance", "abc_summary": "product_abc_summary",
    "top_products": "product_abc_top", "channel_mix": "channel_mix", "forecast": "revenue_forecast",
    "quality_score": "quality_score", "meta": "run_meta", "customer_features": "customer_features",
    "items_enriched": "items_enriched", "marketing_by_channel": "marketing_by_channel", "marketing_funnel": "marketing_funnel",
    "returns_summary": "returns_summary", "returns_by_reason": "returns_by_reason",
}


def _category_sets() -> str:
    """Orders as bit masks of their categories, and every set of categories as a mask."""
    return """
        cats AS MATERIALIZED (SELECT category, CAST(1 AS BIGINT) << CAST(ROW_NUMBER() OVER (ORDER BY category) - 1 AS INTEGER) AS bit
                 FROM (SELECT DISTINCT p_type AS category FROM part) c),
        masks AS MATERIALIZED (SELECT order_id, CAST(SUM(bit) AS BIGINT) AS mask FROM (
                 SELECT DISTINCT l_orderkey AS order_id, p_type AS category FROM lineitem JOIN part ON p_partkey = l_partkey) x
                 JOIN cats USING (category) GROUP BY 1),
        sets AS MATERIALIZED (SELECT s.mask, COUNT(*) AS n FROM (SELECT unnest(range(1, CAST(1 AS BIGINT) << (SELECT CAST(COUNT(*) AS INTEGER) FROM cats))) AS mask) s
                 JOIN masks m ON m.mask & s.mask = s.mask GROUP BY 1
                 HAVING COUNT(*) >= GREATEST(2, (SELECT COUNT(*) FROM masks) // 100)),
        named AS (SELECT s.mask, s.n, string_agg(category, ' + ' ORDER BY category) AS items FROM sets s JOIN cats ON s.mask & bit = bit GROUP BY 1, 2)"""


def _reallocation(share: int = 20, growth: int = 50) -> str:
    return f"""
        WITH c AS (SELECT channel, CAST(SUM(budget_usd) * 100 AS HUGEINT) AS s, CAST(SUM(revenue_usd) * 100 AS HUGEINT) AS r
                   FROM (SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, 'channel-' || (CAST(json_extract(props, '$.k') AS INTEGER) % 8) AS channel,
                                COALESCE(SUM(CAST(value AS DECIMAL(12,2))) FILTER (event_type = 'click'), 0) AS budget_usd,
                                COALESCE(SUM(CAST(value AS DECIMAL(12,2))) FILTER (event_type = 'purchase'), 0) AS revenue_usd
                         FROM events GROUP BY 1, 2) e WHERE channel IS NOT NULL GROUP BY 1),
        t AS (SELECT channel, s, r, s * {share} // 100 AS t FROM c WHERE s > 0),
        a AS (SELECT *, SUM(t) OVER () AS pool, SUM(s) OVER () AS alls, SUM(r) OVER () AS allr FROM t),
        w AS (SELECT *, CASE WHEN r * alls > allr * s THEN r * 1000000 // s ELSE 0 END AS w FROM a),
        m AS (SELECT *, CASE WHEN w > 0 THEN s * {growth} // 100 ELSE 0 END AS room FROM w),
        -- the level at which the pool runs out, tried for every number of full channels
        o AS (SELECT *, ROW_NUMBER() OVER (ORDER BY CAST(room AS DOUBLE) / CAST(w AS DOUBLE), channel) AS i FROM m WHERE w > 0),
        k AS (SELECT COALESCE(MIN(f), (SELECT COUNT(*) FROM o)) AS full_until FROM (
              SELECT x.i - 1 AS f FROM o x WHERE NOT (x.pool - (SELECT COALESCE(SUM(room), 0) FROM o y WHERE y.i < x.i) > 0
                  AND (x.pool - (SELECT COALESCE(SUM(room), 0) FROM o y WHERE y.i < x.i)) * x.w
                      >= x.room * (SELECT SUM(w) FROM o y WHERE y.i >= x.i))) z),
        g AS (SELECT m.*, COALESCE(o.i <= full_until, FALSE) AS is_full, full_until FROM m LEFT JOIN o USING (channel) CROSS JOIN k),
        l AS (SELECT *, GREATEST(pool - SUM(CASE WHEN is_full THEN room ELSE 0 END) OVER (), 0) AS remaining,
                     SUM(CASE WHEN is_full THEN 0 ELSE w END) OVER () AS wo FROM g),
        b AS (SELECT *, CASE WHEN is_full THEN room WHEN wo > 0 THEN remaining * w // wo ELSE 0 END AS low,
                     CASE WHEN is_full OR w = 0 OR wo = 0 THEN -1 ELSE (remaining * w) % wo END AS rest FROM l),
        d AS (SELECT *, CASE WHEN wo > 0 THEN remaining - SUM(CASE WHEN is_full THEN 0 ELSE low END) OVER () ELSE 0 END AS odd,
                     ROW_NUMBER() OVER (ORDER BY rest DESC, channel) AS rr FROM b),
        e AS (SELECT *, low + CASE WHEN rest >= 0 AND rr <= odd THEN 1 ELSE 0 END AS given FROM d),
        u AS (SELECT *, pool - SUM(given) OVER () AS unused FROM e),
        v AS (SELECT *, CASE WHEN pool > 0 THEN unused * t // pool ELSE 0 END AS back, CASE WHEN pool > 0 THEN (unused * t) % pool ELSE 0 END AS back_rest FROM u),
        x AS (SELECT *, ROW_NUMBER() OVER (ORDER BY back_rest DESC, channel) AS br, unused - SUM(back) OVER () AS back_odd FROM v),
        y AS (SELECT channel, s, r, given, t - back - CASE WHEN br <= back_odd THEN 1 ELSE 0 END AS taken FROM x)
        SELECT channel, CAST(s AS DOUBLE) / 100 AS spend, CAST(taken AS DOUBLE) / 100 AS taken, CAST(given AS DOUBLE) / 100 AS given,
               CAST(s - taken + given AS DOUBLE) / 100 AS new_spend,
               ROUND(CAST(r AS DOUBLE) / 100 * CAST(s - taken + given AS DOUBLE) / CAST(s AS DOUBLE), 2) AS expected_revenue FROM y"""


def _eligible(obs: str) -> str:
    return f"""SELECT customer_id FROM rev WHERE order_date <= DATE '{obs}' GROUP BY 1 HAVING DATE '{obs}' - MAX(order_date) <= 365"""


def _clv() -> str:
    ahead = """COALESCE((SELECT SUM(total_amount) FROM rev r WHERE r.customer_id = e.customer_id
                AND r.order_date > DATE '{0}' AND r.order_date <= DATE '{0}' + 183), 0)"""
    sides = [f"""SELECT c.customer_segment, {_dbl(ahead.format(obs))} AS y FROM ({_eligible(obs)}) e LEFT JOIN customers c ON c.customer_id = e.customer_id"""
             for obs in (CLV_TRAIN, CLV_TEST)]
    return f"""
        SELECT customer_segment, COALESCE(n_train, 0) AS n_train, COALESCE(n_test, 0) AS n_test,
               ROUND(err, 2) AS mean_error, COALESCE(n_test, 0) > 0 AS has_model_error
        FROM (SELECT customer_segment, COUNT(*) AS n_train, AVG(y) AS m FROM ({sides[0]}) a GROUP BY 1) t
        LEFT JOIN (SELECT b.customer_segment, COUNT(*) AS n_test, SUM(ABS(b.y - z.m)) / COUNT(*) AS err FROM ({sides[1]}) b
                   LEFT JOIN (SELECT customer_segment, AVG(y) AS m FROM ({sides[0]}) a GROUP BY 1) z USING (customer_segment) GROUP BY 1) q
        USING (customer_segment)"""


def _build() -> dict[str, str]:
    q = {}
    q["basket_pairs"] = f"""
        SELECT first, second, n_orders, {_ratio('n_orders', 'k', 1, None)} AS support, {_ratio('n_orders', 'a.n', 1, None)} AS confidence,
               {_ratio('n_orders * k', 'a.n * b.n', 1, None)} AS lift
        FROM (SELECT x.product_id AS first, y.product_id AS second, COUNT(*) AS n_orders FROM
              (SELECT DISTINCT order_id, product_id FROM lines) x JOIN (SELECT DISTINCT order_id, product_id FROM lines) y
              ON x.order_id = y.order_id AND x.product_id < y.product_id GROUP BY 1, 2 HAVING COUNT(*) >= 2) p
        JOIN (SELECT product_id, COUNT(DISTINCT order_id) AS n FROM lines GROUP BY 1) a ON a.product_id = first
        JOIN (SELECT product_id, COUNT(DISTINCT order_id) AS n FROM lines GROUP BY 1) b ON b.product_id = second
        CROSS JOIN (SELECT COUNT(DISTINCT order_id) AS k FROM lines) z"""
    q["key_map"] = """
        SELECT c_custkey AS customer_id, CAST(ROW_NUMBER() OVER (ORDER BY (c_acctbal < 0) DESC, c_custkey) AS BIGINT) AS sk FROM customer"""
    q["audit_time"] = "SELECT COUNT(*) AS n_rows, COUNT(*) AS n_touched, COUNT(*) AS n_fresh FROM part"
    q["distinct_rollup"] = " UNION ALL ".join(
        f"SELECT '{unit}' AS unit, {_txt(f'CAST(date_trunc({chr(39)}{unit}{chr(39)}, ts) AS DATE)')} AS period, COUNT(DISTINCT user_id) AS users, TRUE AS is_close "
        "FROM events GROUP BY 2" for unit in ("month", "quarter"))
    q["anomaly_flags"] = f"""
        SELECT channel, {_txt('month')} AS month, {_dbl('revenue')} AS revenue, m AS baseline,
               CASE WHEN lo <> hi THEN ROUND((x - m) / sd, 4) END AS deviation,
               CASE WHEN lo = hi THEN x <> m ELSE ABS(x - m) > 2.0 * sd END AS is_anomaly
        FROM (SELECT *, {_dbl('revenue')} AS x, CASE WHEN k = 6 THEN {_dbl('s')} / 6 END AS m, CASE WHEN k = 6 THEN sdev END AS sd,
                     CASE WHEN k = 6 THEN low END AS lo, CASE WHEN k = 6 THEN high END AS hi FROM (
              SELECT *, COUNT(revenue) OVER w AS k, SUM(revenue) OVER w AS s, STDDEV_SAMP({_dbl('revenue')}) OVER w AS sdev,
                     MIN(revenue) OVER w AS low, MAX(revenue) OVER w AS high FROM (
                SELECT channel, CAST(date_trunc('month', order_date) AS DATE) AS month, SUM(total_amount) AS revenue FROM ords GROUP BY 1, 2) a
              WINDOW w AS (PARTITION BY channel ORDER BY month ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)) b) c"""
    q["clv_regression"] = _clv()
    q["stream_daily_windows"] = f"""
        SELECT {_txt('day')} AS order_date, COUNT(DISTINCT user_id) AS order_count, COUNT(*) AS units_sold, {_dbl('SUM(v)')} AS revenue,
               CAST(0 AS BIGINT) AS late_rows
        FROM (SELECT CAST(ts AS DATE) AS day, user_id, CAST(value AS DECIMAL(12,2)) AS v
              FROM events WHERE event_type = 'purchase') x GROUP BY day"""
    q["stream_upsert_buckets"] = """
        SELECT o_custkey, MAX(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1"""
    sources = {"dim_customers": "customers", "dim_products": "products", "dim_stores": "supplier", "fact_orders": "ords",
               "fact_reviews": "reviews", "fact_returns": "returned"}
    q["csv_all_tables"] = " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows FROM {sources[n]}" for n in CSV_TABLES)
    q["csv_other_header"] = f"""
        SELECT {_txt('CAST(ts AS DATE)')} AS traffic_date, COUNT(DISTINCT user_id) AS visitors, COUNT(*) AS sessions FROM events GROUP BY 1"""
    bad = "order_id % 97 = 0 OR order_id % 101 = 0"
    q["reconciled_load"] = f"""
        SELECT 'fact_orders' AS table_name, COUNT(*) AS source_rows, COUNT(*) FILTER (NOT ({bad})) AS landed,
               COUNT(*) FILTER ({bad}) AS quarantined, TRUE AS reconciled FROM ords"""
    q["table_statistics"] = " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, MIN({c}) AS low, MAX({c}) AS high, COUNT(*) - COUNT({c}) AS n_null FROM orders"
        for name, c in (("order_id", "o_orderkey"), ("customer_id", "o_custkey")))
    q["model_round_trip"] = "SELECT COUNT(*) AS n_customers, COUNT(*) AS n_equal FROM risk"
    built = {name: _sql(body) for name, body in q.items()}

    built["budget_reallocation"] = _reallocation()
    built["basket_sets"] = f"WITH {_category_sets()} SELECT items, n AS n_orders FROM named"
    built["basket_rules"] = f"""WITH {_category_sets()}
        SELECT a.items AS antecedent, c.category AS consequent, s.n AS n_orders, {_ratio('s.n', 'k', 1, None)} AS support,
               {_ratio('s.n', 'a.n', 1, None)} AS confidence, {_ratio('s.n * k', 'a.n * d.n', 1, None)} AS lift
        FROM sets s JOIN cats c ON s.mask & c.bit = c.bit AND s.mask <> c.bit JOIN named a ON a.mask = s.mask - c.bit
        JOIN sets d ON d.mask = c.bit CROSS JOIN (SELECT COUNT(*) AS k FROM masks) z"""
    blocks = [f"SELECT '{block}' AS block, COUNT(*) AS n_rows FROM ({ORACLE[name]}) q" for block, name in _SAME_ROWS.items()]
    blocks.append("SELECT 'products_sold', 1")
    common = """
        SELECT driver FROM (SELECT DISTINCT 'spend' AS driver, CAST(date_trunc('month', day) AS DATE) AS m FROM (
              SELECT MIN(CAST(ts AS DATE)) AS day FROM events GROUP BY json_extract(props, '$.k')) f
            UNION ALL SELECT DISTINCT 'visitors', CAST(date_trunc('month', ts) AS DATE) FROM events) d
        JOIN monthly r ON CAST(r.m AS DATE) = d.m GROUP BY 1 HAVING COUNT(*) >= 4"""
    blocks.append(f"SELECT 'correlations', COUNT(*) FROM ({_sql(common)}) q")
    blocks.append(f"SELECT 'cohort_retention', COUNT(*) FROM ({ORACLE['cohort_retention']}) q")
    blocks.append(f"SELECT 'quality_checks', COUNT(*) - 1 FROM ({ORACLE['quality_report']}) q")
    built["all_blocks"] = "SELECT block, " + _int("n_rows") + " AS n_rows FROM (" + " UNION ALL ".join(blocks) + ") z"
    return built


EXTENDED: dict[str, str] = _build()
ORACLE.update(EXTENDED)
