"""Independent SQL for the registered queries, in DuckDB's dialect.

Amounts are exact decimals until the last step. Where the result is rounded, the double
quotient is moved by 1e-9 first: it lifts exact ties, which decimal division rounds half
up, without reaching any other value.
"""

from __future__ import annotations

from tallyline.plans.catalogue import AS_OF, FUTURE_FROM, OBS, SCD_DAY
from tallyline.sources.bindings import ONLINE_PRIORITY, PROMISED_DAYS, REORDER_POINT


def _rnd(x: str, digits: int = 2) -> str:
    return f"ROUND(({x}) + 1e-9 * SIGN({x}), {digits})"


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _ratio(num: str, den: str, scale: int = 1, digits: int | None = 2) -> str:
    x = f"({_dbl(num)} * {scale}.0 / NULLIF({_dbl(den)}, 0))"
    return x if digits is None else _rnd(x, digits)


def _txt(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _int(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


# Canonical frames, in dependency order.
FRAMES = {
    "customers": """
        SELECT c_custkey AS customer_id,
               split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) AS customer_name,
               n_name AS country, r_name AS acquisition_channel, c_mktsegment AS customer_segment,
               CAST(floor(c_acctbal / 100) AS INTEGER) AS age, c_acctbal > 5000 AS is_loyalty_member,
               c_acctbal AS balance
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN region ON r_regionkey = n_regionkey""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               p_size AS subcategory, p_brand AS brand,
               CAST(CAST(p_retailprice AS DECIMAL(12,2)) + p_size AS DECIMAL(12,2)) AS unit_price,
               CAST(p_retailprice AS DECIMAL(12,2)) AS unit_cost FROM part""",
    "ords": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               o_orderpriority AS channel,
               CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Shipped' WHEN 'P' THEN 'Cancelled' END AS order_status,
               CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount FROM orders""",
    "rev": "SELECT * FROM ords WHERE order_status IN ('Completed', 'Shipped')",
    "signed": """
        SELECT c.*, s.signup_date FROM customers c LEFT JOIN
        (SELECT customer_id, MIN(order_date) AS signup_date FROM ords GROUP BY 1) s USING (customer_id)""",
    "lines": """
        SELECT l_orderkey || '-' || l_linenumber AS order_item_id, l_orderkey AS order_id,
               l_partkey AS product_id, l_suppkey AS store_id, CAST(l_quantity AS INTEGER) AS quantity,
               CAST(ROUND(l_extendedprice / l_quantity + 1e-9, 2) AS DECIMAL(12,2)) AS unit_price,
               CAST(l_discount AS DECIMAL(5,4)) AS discount_pct,
               CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(5,4))), 2) AS DECIMAL(12,2)) AS line_revenue,
               CAST(l_shipdate AS DATE) AS ship_date, l_returnflag AS return_flag, l_linestatus AS line_status
        FROM lineitem""",
    "items": """
        SELECT l.*, CAST(p.unit_cost * l.quantity AS DECIMAL(12,2)) AS line_cost,
               CAST(l.line_revenue - p.unit_cost * l.quantity AS DECIMAL(12,2)) AS line_profit
        FROM lines l LEFT JOIN products p USING (product_id)""",
    "dated": "SELECT i.*, o.order_date FROM items i JOIN ords o USING (order_id)",
    "returned": """
        SELECT l.order_item_id AS return_id, l.order_id, l.ship_date AS return_date, p.category AS return_reason,
               l.line_revenue AS refund_amount, l.line_status = 'F' AS restocked
        FROM lines l LEFT JOIN products p USING (product_id) WHERE l.return_flag = 'R'""",
    "inventory": f"""
        SELECT l_suppkey AS store_id, l_partkey AS product_id, CAST(SUM(l_quantity) AS BIGINT) AS stock_on_hand,
               {REORDER_POINT} AS reorder_point FROM lineitem GROUP BY 1, 2""",
    "reviews": """
        SELECT l_orderkey || '-' || l_linenumber AS review_id, l_partkey AS product_id,
               CASE l_returnflag WHEN 'N' THEN 5 WHEN 'A' THEN 3 WHEN 'R' THEN 1 END AS rating FROM lineitem""",
    "campaigns": """
        SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS campaign_id,
               'channel-' || (CAST(json_extract(props, '$.k') AS INTEGER) % 8) AS channel,
               COALESCE(SUM(CAST(value AS DECIMAL(12,2))) FILTER (event_type = 'click'), 0) AS budget_usd,
               COALESCE(SUM(CAST(value AS DECIMAL(12,2))) FILTER (event_type = 'purchase'), 0) AS revenue_usd,
               COUNT(*) FILTER (event_type = 'view') AS impressions,
               COUNT(*) FILTER (event_type = 'click') AS clicks,
               COUNT(*) FILTER (event_type = 'purchase') AS conversions
        FROM events GROUP BY 1, 2""",
    "stocked": """
        SELECT o.*, COALESCE(s.store, 'ONLINE') AS store_id FROM ords o LEFT JOIN
        (SELECT l_orderkey AS order_id, CAST(MIN(l_suppkey) AS VARCHAR) AS store FROM lineitem GROUP BY 1) s
        USING (order_id)""",
    "enriched": """
        SELECT i.*, o.customer_id, o.channel, o.order_status, p.category, p.brand
        FROM items i JOIN rev o USING (order_id) LEFT JOIN products p USING (product_id)""",
    # features and scores
    "bought": """
        SELECT customer_id, COUNT(DISTINCT order_id) AS frequency, SUM(total_amount) AS monetary,
               COUNT(total_amount) AS amounts, MIN(order_date) AS first_order, MAX(order_date) AS last_order
        FROM rev GROUP BY 1""",
    "base": """
        SELECT c.customer_id, COALESCE(b.frequency, 0) AS frequency, COALESCE(b.monetary, 0) AS monetary,
               COALESCE(CAST(b.monetary AS DOUBLE) * 1.0 / CAST(b.amounts AS DOUBLE), 0) AS avg_order_value,
               b.first_order, b.last_order,
               COALESCE(d.day - b.last_order, d.day - c.signup_date) AS recency_days,
               d.day - c.signup_date AS tenure_days
        FROM signed c LEFT JOIN bought b USING (customer_id)
        CROSS JOIN (SELECT MAX(order_date) + 1 AS day FROM rev) d""",
    "placed": """
        SELECT *, COUNT(*) OVER () AS n, ROW_NUMBER() OVER (ORDER BY recency_days, customer_id) AS rr,
               ROW_NUMBER() OVER (ORDER BY frequency, customer_id) AS rf,
               ROW_NUMBER() OVER (ORDER BY monetary, customer_id) AS rm FROM base WHERE frequency > 0""",
    "scored": """
        SELECT b.*, CASE WHEN n IS NULL THEN 0 ELSE 6 - greatest(1, (5 * (rr - 1) + n - 2) // (n - 1)) END AS R,
               CASE WHEN n IS NULL THEN 0 ELSE greatest(1, (5 * (rf - 1) + n - 2) // (n - 1)) END AS F,
               CASE WHEN n IS NULL THEN 0 ELSE greatest(1, (5 * (rm - 1) + n - 2) // (n - 1)) END AS M
        FROM base b LEFT JOIN placed p USING (customer_id)""",
    "features": """
        SELECT *, R + F + M AS rfm_score,
               CASE WHEN frequency = 0 THEN 'Never Purchased'
                    WHEN R >= 4 AND F >= 4 AND M >= 4 THEN 'Champions'
                    WHEN R >= 3 AND F >= 3 AND M >= 4 THEN 'Loyal Customers'
                    WHEN R >= 4 AND F <= 2 THEN 'New Customers'
                    WHEN R >= 3 AND F >= 3 THEN 'Potential Loyalists'
                    WHEN R <= 2 AND F >= 3 AND M >= 3 THEN 'At Risk'
                    WHEN R <= 2 AND M >= 4 THEN 'Can''t Lose Them'
                    WHEN R <= 2 AND F <= 2 THEN 'Hibernating'
                    ELSE 'Needs Attention' END AS rfm_segment FROM scored""",
    "monthly": """
        SELECT date_trunc('month', order_date) AS m, SUM(total_amount) AS revenue, COUNT(DISTINCT order_id) AS orders
        FROM rev GROUP BY 1""",
    "item_months": "SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, SUM(line_revenue) AS revenue FROM dated GROUP BY 1",
    # churn
    "past": f"SELECT * FROM rev WHERE order_date <= DATE '{OBS}'",
    "churn_base": f"""
        SELECT a.customer_id, a.recency_days, a.frequency, a.monetary, a.avg_order_value, a.tenure_days,
               COALESCE(d.k, 0) AS distinct_categories, COALESCE(t.k, 0) AS n_returns, c.age, c.country,
               c.acquisition_channel, c.customer_segment, CAST(c.is_loyalty_member AS VARCHAR) AS is_loyalty_member
        FROM (SELECT customer_id, DATE '{OBS}' - MAX(order_date) AS recency_days,
                     COUNT(DISTINCT order_id) AS frequency, SUM(total_amount) AS monetary,
                     CAST(SUM(total_amount) AS DOUBLE) / CAST(COUNT(total_amount) AS DOUBLE) AS avg_order_value,
                     DATE '{OBS}' - MIN(order_date) AS tenure_days FROM past GROUP BY 1) a
        LEFT JOIN (SELECT customer_id, COUNT(DISTINCT category) AS k FROM lines JOIN past USING (order_id)
                   JOIN products USING (product_id) GROUP BY 1) d USING (customer_id)
        LEFT JOIN (SELECT customer_id, COUNT(*) AS k FROM returned JOIN past USING (order_id)
                   WHERE return_date <= DATE '{OBS}' GROUP BY 1) t USING (customer_id)
        LEFT JOIN customers c USING (customer_id)
        WHERE a.recency_days <= 365""",
    "labelled": f"""
        SELECT b.*, CASE WHEN EXISTS (SELECT 1 FROM rev r WHERE r.customer_id = b.customer_id
                     AND r.order_date > DATE '{OBS}' AND r.order_date <= DATE '{OBS}' + 183)
                    THEN 0 ELSE 1 END AS churned FROM churn_base b""",
    "risk": "SELECT customer_id, churned, monetary, recency_days / 365.0::DOUBLE AS p FROM labelled",
    "thresholds": """
        SELECT p, SUM(churned) AS pos, SUM(1 - churned) AS neg FROM risk GROUP BY 1""",
    "scan": """
        SELECT p, pos, neg, ROW_NUMBER() OVER (ORDER BY p DESC) AS rn, COUNT(*) OVER () AS m,
               SUM(pos) OVER (ORDER BY p DESC) AS tp, SUM(neg) OVER (ORDER BY p DESC) AS fp,
               SUM(pos) OVER () AS np, SUM(neg) OVER () AS nn FROM thresholds""",
}


def _closure(names: set[str]) -> list[str]:
    needed = set(names)
    for name in reversed(list(FRAMES)):
        if name in needed:
            needed |= _mentioned(FRAMES[name])
    return [n for n in FRAMES if n in needed]


def _mentioned(sql: str) -> set[str]:
    words = set()
    tokens = sql.replace("(", " ").replace(")", " ").replace(",", " ").split()
    for before, word in zip(tokens, tokens[1:]):
        if before.upper() in ("FROM", "JOIN") and word in FRAMES:
            words.add(word)
    return words


def _sql(body: str) -> str:
    """The body with the canonical frames it mentions as common table expressions."""
    ctes = [f"{name} AS ({FRAMES[name]})" for name in _closure(_mentioned(body))]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def _customer_sales(where: str = "") -> str:
    return f"""(SELECT o.customer_id, COUNT(DISTINCT o.order_id) AS total_orders, SUM(l.line_revenue) AS revenue,
        MIN(o.order_date) AS first_purchase, MAX(o.order_date) AS last_purchase
        FROM ords o JOIN lines l ON l.order_id = o.order_id {where} GROUP BY 1)"""


def _count_check(check: str, family: str, scanned: str, failed: str, source: str) -> str:
    return f"SELECT '{check}' AS \"check\", '{family}' AS family, {scanned} AS s, {failed} AS f FROM {source}"


def _gate() -> str:
    critical = {"dim_customers": ("signed", ["customer_id", "country", "signup_date"]),
                "dim_products": ("products", ["product_id", "category", "unit_price", "unit_cost"]),
                "fact_orders": ("ords", ["order_id", "customer_id", "order_date", "total_amount"]),
                "fact_order_items": ("lines", ["order_id", "product_id", "quantity", "line_revenue"])}
    parts = [_count_check(f"{t}.{c} not null", "completeness", "COUNT(*)", f"COUNT(*) - COUNT({c})", src)
             for t, (src, cols) in critical.items() for c in cols]
    for table, src, key in [("dim_customers", "signed", "customer_id"), ("dim_products", "products", "product_id"),
                            ("dim_stores", "supplier", "s_suppkey"), ("fact_orders", "ords", "order_id"),
                            ("fact_order_items", "lines", "order_item_id")]:
        name = "store_id" if table == "dim_stores" else key
        parts.append(_count_check(f"{table}.{name} unique", "uniqueness", "COUNT(*)",
                                  f"COUNT(*) - COUNT(DISTINCT {key})", src))
    for child, src, fk, parent, psrc, pk, shown in [
            ("fact_orders", "ords", "customer_id", "dim_customers", "signed", "customer_id", "customer_id"),
            ("fact_orders", "stocked", "store_id", "dim_stores", "supplier", "s_suppkey", "store_id"),
            ("fact_order_items", "lines", "store_id", "dim_stores", "supplier", "s_suppkey", "store_id"),
            ("fact_order_items", "lines", "order_id", "fact_orders", "ords", "order_id", "order_id"),
            ("fact_order_items", "lines", "product_id", "dim_products", "products", "product_id", "product_id"),
            ("fact_returns", "returned", "order_id", "fact_orders", "ords", "order_id", "order_id"),
            ("fact_reviews", "reviews", "product_id", "dim_products", "products", "product_id", "product_id")]:
        parts.append(
            f"SELECT '{child}.{fk} -> {parent}.{shown}' AS \"check\", 'referential_integrity' AS family, "
            f"COUNT(*) AS s, COUNT(*) FILTER (CAST(x.{fk} AS VARCHAR) NOT IN "
            f"(SELECT CAST(y.{pk} AS VARCHAR) FROM {psrc} y)) AS f FROM {src} x WHERE x.{fk} IS NOT NULL "
            f"AND UPPER(CAST(x.{fk} AS VARCHAR)) NOT IN ('ONLINE', 'N/A', 'NONE', 'UNKNOWN', '')")
    for check, src, bad in [("fact_orders.total_amount >= 0", "ords", "total_amount < 0"),
                            ("fact_order_items.quantity > 0", "lines", "quantity <= 0"),
                            ("dim_products price > cost", "products", "unit_price <= unit_cost"),
                            ("dim_customers.age in [18,100]", "signed", "age < 18 OR age > 100"),
                            ("fact_reviews.rating in [1,5]", "reviews", "rating < 1 OR rating > 5")]:
        parts.append(_count_check(check, "validity", "COUNT(*)", f"COUNT(*) FILTER ({bad})", src))
    parts.append("SELECT 'every order has >=1 line item' AS \"check\", 'consistency' AS family, "
                 "COUNT(DISTINCT order_id) AS s, COUNT(DISTINCT order_id) FILTER "
                 "(order_id NOT IN (SELECT l_orderkey FROM lineitem)) AS f FROM ords")
    return (f"SELECT \"check\", family, {_int('s')} AS records_scanned, {_int('f')} AS records_failed, "
            f"COALESCE({_ratio('f', 's', 100, 4)}, 0) AS failure_rate_pct, f = 0 AS passed FROM ("
            + " UNION ALL ".join(parts) + ") q")


def _yoy(n: int, dense: bool = False) -> str:
    if dense:
        before = f"(SELECT b.revenue FROM monthly b WHERE b.m = a.m - INTERVAL {n} MONTH)"
    else:
        before = f"LAG(a.revenue, {n}) OVER (ORDER BY a.m)"
    return f"(({_dbl('a.revenue')} / {_dbl(before)}) - 1) * 100"


def _monthly(dense: bool) -> str:
    return f"""SELECT {_txt("CAST(a.m AS DATE)")} AS month, {_dbl("a.revenue")} AS revenue, {_int("a.orders")} AS orders,
        {_yoy(12, dense)} AS revenue_yoy_pct, {_yoy(1, dense)} AS revenue_mom_pct FROM monthly a"""


def _cohort(periods: int) -> str:
    return f"""
    (WITH sizes AS (SELECT CAST(date_trunc('month', signup_date) AS DATE) AS cohort, COUNT(*) AS n
                    FROM signed WHERE signup_date IS NOT NULL GROUP BY 1),
     act AS (SELECT CAST(date_trunc('month', s.signup_date) AS DATE) AS cohort,
                    (year(o.order_date) * 12 + month(o.order_date)) - (year(s.signup_date) * 12 + month(s.signup_date)) AS period,
                    COUNT(DISTINCT o.customer_id) AS k
             FROM rev o JOIN signed s USING (customer_id) GROUP BY 1, 2 HAVING period BETWEEN 0 AND {periods - 1})
     SELECT z.cohort, z.n AS cohort_size, p.period,
            CASE WHEN z.cohort IN (SELECT cohort FROM act) THEN COALESCE(a.k, 0) END AS active_customers
     FROM (SELECT * FROM sizes ORDER BY cohort DESC LIMIT 12) z
     CROSS JOIN (SELECT DISTINCT period FROM act) p
     LEFT JOIN act a ON a.cohort = z.cohort AND a.period = p.period)"""


def _forecast(series: str, keys: list[str]) -> str:
    k = "".join(f"{c}, " for c in keys)
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    on = " AND ".join([f"{{0}}.{c} = {{1}}.{c}" for c in keys]) or "TRUE"
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    sk = "".join(f"p.{c}, " for c in keys)
    fk = "".join(f"f.{c}, " for c in keys)
    return f"""
    SELECT {fk}strftime(f.last_m + to_months(CAST(h.h AS INTEGER)), '%Y-%m') AS month,
           ROUND(GREATEST((f.b + f.a * (f.n - 1 + h.h)) * COALESCE(s.factor, 1.0), 0.0), 2) AS revenue_forecast,
           'forecast' AS type
    FROM (SELECT {k}regr_slope(y, x) AS a, regr_intercept(y, x) AS b, COUNT(*) AS n, MAX(m) AS last_m
          FROM (SELECT {k}m, y, ROW_NUMBER() OVER ({part}ORDER BY m) - 1 AS x FROM {series}) q {group}) f
    CROSS JOIN range(1, 7) h(h)
    LEFT JOIN (SELECT {sk}month(p.m) AS mm, AVG(p.y / (g.b + g.a * p.x)) AS factor
               FROM (SELECT {k}m, y, ROW_NUMBER() OVER ({part}ORDER BY m) - 1 AS x FROM {series}) p
               JOIN (SELECT {k}regr_slope(y, x) AS a, regr_intercept(y, x) AS b
                     FROM (SELECT {k}m, y, ROW_NUMBER() OVER ({part}ORDER BY m) - 1 AS x FROM {series}) q {group}) g
               ON {on.format('p', 'g')} GROUP BY {sk}month(p.m)) s
    ON {on.format('f', 's')} AND s.mm = month(f.last_m + to_months(CAST(h.h AS INTEGER)))"""


def _tops(k: int) -> str:
    return f"ORDER BY revenue DESC, product_id LIMIT {k}"


def _build() -> dict[str, str]:
    share = lambda x: _ratio(x, f"SUM({x}) OVER ()", 100)
    q: dict[str, str] = {}

    # derivations
    q["dim_date"] = f"""
        SELECT {_txt('CAST(d AS DATE)')} AS full_date, {_int("strftime(d, '%Y%m%d')")} AS date_sk,
               {_int('isodow(d)')} AS day_of_week, dayname(d) AS day_name, {_int('day(d)')} AS day_of_month,
               {_int('dayofyear(d)')} AS day_of_year, {_int('week(d)')} AS week_of_year,
               {_int('month(d)')} AS month_num, monthname(d) AS month_name, {_int('quarter(d)')} AS quarter,
               {_int('year(d)')} AS year, isodow(d) IN (6, 7) AS is_weekend,
               {_int('CASE WHEN month(d) >= 2 THEN year(d) ELSE year(d) - 1 END')} AS fiscal_year,
               {_int('ceil(month(d) / 3.0)')} AS fiscal_quarter, {_int('COALESCE(k, 0)')} AS n_orders
        FROM (SELECT unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders) x
        LEFT JOIN (SELECT o_orderdate, COUNT(*) AS k FROM orders GROUP BY 1) y ON y.o_orderdate = x.d"""
    q["line_money"] = f"""
        SELECT order_item_id, product_id, {_dbl('rv')} AS line_revenue, {_dbl('cost')} AS line_cost,
               {_dbl('rv - cost')} AS line_profit FROM (
        SELECT order_item_id, product_id, ROUND(l.unit_price * quantity * (1 - discount_pct), 2) AS rv,
               p.unit_cost * quantity AS cost FROM lines l JOIN products p USING (product_id)) x"""
    q["order_total_rollup"] = f"""
        SELECT o.order_id, COALESCE({_dbl('SUM(l.line_revenue)')}, 0) AS total_amount
        FROM ords o LEFT JOIN lines l USING (order_id) GROUP BY 1"""
    q["product_margin"] = f"SELECT product_id, {_ratio('unit_price - unit_cost', 'unit_price', 100)} AS margin_pct FROM products"
    q["stock_status"] = """
        SELECT store_id, product_id, stock_on_hand, CASE WHEN stock_on_hand = 0 THEN 'Out of Stock'
               WHEN stock_on_hand < reorder_point THEN 'Low Stock' ELSE 'In Stock' END AS stock_status FROM inventory"""
    q["shipping_delay"] = f"""
        SELECT channel AS carrier, COUNT(*) AS shipments, COUNT(*) FILTER (ship_date - order_date > {PROMISED_DAYS}) AS delayed,
               CAST(COUNT(*) FILTER (ship_date - order_date > {PROMISED_DAYS}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100 AS delay_rate_pct
        FROM lines JOIN ords USING (order_id) GROUP BY 1"""
    q["campaign_rates"] = f"""
        SELECT {_int('campaign_id')} AS campaign_id, {_ratio('clicks', 'impressions', 100, 3)} AS ctr_pct,
               {_ratio('conversions', 'greatest(clicks, 1)', 100, 3)} AS conversion_rate_pct,
               {_ratio('revenue_usd', 'budget_usd')} AS roas FROM campaigns"""
    q["rating_sentiment"] = f"""
        SELECT {_int('rating')} AS rating, CASE WHEN rating IN (1, 2) THEN 'Negative' WHEN rating = 3 THEN 'Neutral'
               ELSE 'Positive' END AS sentiment, COUNT(*) AS n_reviews FROM reviews GROUP BY 1, 2"""
    q["tenure_band"] = f"""
        SELECT customer_id, {_int('d')} AS tenure_days, {_int("CASE WHEN d < 90 THEN 0 WHEN d < 365 THEN 1 WHEN d < 730 THEN 2 WHEN d >= 730 THEN 3 END")} AS tenure_band
        FROM (SELECT customer_id, DATE '{AS_OF}' - signup_date AS d FROM signed) x"""
    q["standardize_text"] = """
        SELECT p_partkey AS product_id, upper(p_type[1]) || lower(p_type[2:]) AS category FROM part"""
    q["surrogate_keys"] = """
        SELECT COUNT(*) AS n_rows, COUNT(DISTINCT c_custkey) AS n_keys, COUNT(DISTINCT c_custkey) AS n_surrogates FROM customer"""
    versions = f"""(
        SELECT customer_id, customer_segment, country, DATE '1995-01-01' AS effective_date,
               CASE WHEN balance < 0 THEN DATE '{SCD_DAY}' END AS expiry_date, NOT (balance < 0) AS is_current
        FROM signed WHERE signup_date < DATE '{SCD_DAY}'
        UNION ALL
        SELECT customer_id, CASE WHEN balance < 0 THEN 'DELINQUENT' ELSE customer_segment END, country,
               DATE '{SCD_DAY}', NULL, TRUE
        FROM signed WHERE balance < 0 OR signup_date >= DATE '{SCD_DAY}' OR signup_date IS NULL)"""
    q["scd2_apply"] = f"""
        SELECT customer_id, customer_segment, country, {_txt('effective_date')} AS effective_date,
               {_txt('expiry_date')} AS expiry_date, is_current FROM {versions} v"""
    q["scd2_asof"] = f"""
        SELECT v.customer_segment, COUNT(*) AS n_orders, {_dbl('SUM(o.total_amount)')} AS revenue
        FROM ords o LEFT JOIN {versions} v ON v.customer_id = o.customer_id AND o.order_date >= v.effective_date
             AND (v.expiry_date IS NULL OR o.order_date < v.expiry_date) GROUP BY 1"""

    # filters, existence joins, sets
    q["revenue_orders"] = f"""
        SELECT order_id, customer_id, {_txt('order_date')} AS order_date, channel, order_status,
               {_dbl('total_amount')} AS total_amount FROM rev"""
    q["orders_not_cancelled"] = "SELECT order_id, order_status FROM ords WHERE order_status <> 'Cancelled'"
    q["pit_split"] = f"""
        SELECT order_id, customer_id, {_txt('order_date')} AS order_date,
               CASE WHEN order_date <= DATE '{OBS}' THEN 'history' ELSE 'future' END AS side
        FROM ords WHERE order_date <= DATE '{OBS}' + 183"""
    q["eligibility"] = f"""
        SELECT 'payable' AS subset, COUNT(*) AS n_rows FROM ords WHERE order_status <> 'Cancelled'
        UNION ALL SELECT 'shippable', COUNT(*) FROM rev WHERE channel = '{ONLINE_PRIORITY}'
        UNION ALL SELECT 'returnable', COUNT(*) FROM lines WHERE order_id IN (SELECT order_id FROM ords WHERE order_status = 'Cancelled')"""
    q["semi_join_items"] = f"""
        SELECT order_item_id, order_id, product_id, {_dbl('line_revenue')} AS line_revenue FROM lines
        WHERE order_id IN (SELECT order_id FROM rev)"""
    q["set_except_orders"] = "SELECT o_orderkey AS order_id FROM orders EXCEPT SELECT l_orderkey FROM lineitem"
    q["dq_duplicate_keys"] = "SELECT order_item_id, COUNT(*) AS n_rows FROM lines GROUP BY 1 HAVING COUNT(*) > 1"
    q["dq_orphan_items"] = """
        SELECT l.order_item_id, l.order_id FROM lines l LEFT JOIN rev o ON o.order_id = l.order_id WHERE o.order_id IS NULL"""
    q["dq_invalid_values"] = """
        SELECT order_item_id AS key, CASE WHEN line_revenue < 0 THEN 'negative revenue' WHEN quantity <= 0 THEN 'non-positive quantity'
               ELSE 'sold at a loss' END AS reason FROM items WHERE line_revenue < 0 OR quantity <= 0 OR line_profit < 0
        UNION ALL SELECT CAST(customer_id AS VARCHAR), 'age out of range' FROM customers WHERE age < 13 OR age > 100
        UNION ALL SELECT CAST(product_id AS VARCHAR), CASE WHEN unit_price <= 0 THEN 'non-positive price' ELSE 'negative cost' END
        FROM products WHERE unit_price <= 0 OR unit_cost < 0"""
    q["dq_orders_without_items"] = """
        SELECT o_orderkey AS order_id FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL"""
    q["dq_future_dated"] = f"SELECT order_id, {_txt('order_date')} AS order_date FROM ords WHERE order_date > DATE '{FUTURE_FROM}'"
    q["dq_amount_outliers"] = """
        SELECT o_orderkey AS order_id, o_totalprice AS total_amount FROM orders
        WHERE o_totalprice > (SELECT AVG(o_totalprice) + 1.5 * STDDEV_SAMP(o_totalprice) FROM orders)"""
    q["dq_null_audit"] = """
        SELECT COUNT(*) FILTER (o.order_id IS NULL) AS null_order_id, COUNT(*) FILTER (customer_id IS NULL) AS null_customer_id,
               COUNT(*) FILTER (order_date IS NULL) AS null_order_date, COUNT(*) FILTER (t IS NULL) AS null_line_total
        FROM ords o LEFT JOIN (SELECT order_id, SUM(line_revenue) AS t FROM lines GROUP BY 1) l ON l.order_id = o.order_id"""

    # global order
    q["prefix_scan"] = f"""
        SELECT order_id, {_dbl('total_amount')} AS total_amount, ROW_NUMBER() OVER w AS row_number,
               ROW_NUMBER() OVER w AS running_count, {_dbl('SUM(total_amount) OVER (w ROWS UNBOUNDED PRECEDING)')} AS running_total_amount
        FROM ords WINDOW w AS (ORDER BY total_amount DESC, order_id)"""
    q["rank_within_channel"] = f"""
        SELECT order_id, channel, {_dbl('total_amount')} AS total_amount,
               RANK() OVER (PARTITION BY channel ORDER BY total_amount DESC) AS rank FROM ords"""
    q["top_products_per_category"] = f"""
        SELECT product_id, {_dbl('revenue')} AS revenue, category, position FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY revenue DESC, product_id) AS position FROM (
        SELECT product_id, category, SUM(line_revenue) AS revenue FROM lines JOIN products USING (product_id) GROUP BY 1, 2) a) b
        WHERE position <= 3"""
    q["quantile_score"] = f"""
        SELECT order_id, {_dbl('total_amount')} AS total_amount, {_txt('order_date')} AS order_date,
               {_int('greatest(1, (5 * (rn - 1) + n - 2) // (n - 1))')} AS amount_band FROM (
        SELECT *, ROW_NUMBER() OVER (ORDER BY total_amount, order_id) AS rn, COUNT(*) OVER () AS n FROM ords) x"""

    # sales
    q["top_customers"] = f"""
        SELECT c.customer_id, customer_name, country, customer_segment, total_orders, {_dbl('revenue')} AS lifetime_revenue,
               {_ratio('revenue', 'total_orders')} AS avg_order_value
        FROM customers c JOIN {_customer_sales("WHERE o.order_status NOT IN ('Cancelled')")} s USING (customer_id)
        ORDER BY revenue DESC, c.customer_id LIMIT 20"""
    q["top_products_ranked"] = f"""
        SELECT product_id, product_name, category, {_dbl('total_revenue')} AS total_revenue, {_int('units_sold')} AS units_sold,
               rank_in_category, rank_overall FROM (
        SELECT *, RANK() OVER (PARTITION BY category ORDER BY total_revenue DESC) AS rank_in_category,
               RANK() OVER (ORDER BY total_revenue DESC) AS rank_overall FROM (
        SELECT p.product_id, p.product_name, p.category, SUM(line_revenue) AS total_revenue, SUM(quantity) AS units_sold
        FROM lines l JOIN products p USING (product_id) GROUP BY 1, 2, 3) a) b WHERE rank_overall <= 20"""
    q["monthly_revenue_mom"] = f"""
        SELECT {_txt('month')} AS month, {_dbl('revenue')} AS revenue, {_dbl('prev')} AS prev_month_revenue,
               {_ratio('revenue - prev', 'prev', 100)} AS mom_growth_pct
        FROM (SELECT *, LAG(revenue) OVER (ORDER BY month) AS prev FROM item_months) x"""
    q["quarterly_revenue_yoy"] = f"""
        SELECT {_int('yr')} AS yr, {_int('qtr')} AS qtr, {_dbl('revenue')} AS revenue, {_dbl('prev')} AS revenue_same_qtr_prior_year,
               {_ratio('revenue - prev', 'prev', 100)} AS yoy_growth_pct
        FROM (SELECT *, LAG(revenue) OVER (PARTITION BY qtr ORDER BY yr) AS prev FROM (
              SELECT year(order_date) AS yr, quarter(order_date) AS qtr, SUM(line_revenue) AS revenue FROM dated GROUP BY 1, 2) a) b"""
    q["monthly_retention"] = f"""
        SELECT {_txt('month')} AS month, a AS active_customers, r AS retained_from_prior_month,
               {_ratio('r', 'LAG(a) OVER (ORDER BY month)', 100)} AS retention_rate_pct FROM (
        SELECT c.month, COUNT(DISTINCT c.customer_id) AS a, COUNT(DISTINCT p.customer_id) AS r
        FROM (SELECT DISTINCT CAST(date_trunc('month', order_date) AS DATE) AS month, customer_id FROM ords WHERE order_status <> 'Cancelled') c
        LEFT JOIN (SELECT DISTINCT CAST(date_trunc('month', order_date) AS DATE) AS month, customer_id FROM ords WHERE order_status <> 'Cancelled') p
        ON p.customer_id = c.customer_id AND p.month = c.month - INTERVAL 1 MONTH GROUP BY 1) x"""
    clv = _ratio("revenue", "greatest(last_purchase - first_purchase, 1)", 365)
    q["customer_clv"] = f"""
        SELECT c.customer_id, customer_segment, {_txt('first_purchase')} AS first_purchase, {_txt('last_purchase')} AS last_purchase,
               {_int('last_purchase - first_purchase')} AS customer_lifespan_days, total_orders, {_dbl('revenue')} AS total_revenue,
               {_ratio('revenue', 'total_orders')} AS avg_order_value, {clv} AS estimated_annualized_clv
        FROM customers c JOIN {_customer_sales()} s USING (customer_id)"""
    q["inventory_turnover"] = f"""
        SELECT product_id, product_name, category, {_dbl('COALESCE(cogs, 0)')} AS total_cogs,
               {_dbl('unit_cost * stock')} / places AS avg_inventory_value,
               {_rnd(f"{_dbl('cogs')} * places / {_dbl('unit_cost * stock')}")} AS inventory_turnover_ratio
        FROM products JOIN (SELECT product_id, CAST(SUM(stock_on_hand) AS BIGINT) AS stock, COUNT(*) AS places FROM inventory GROUP BY 1) s USING (product_id)
        LEFT JOIN (SELECT product_id, SUM(line_cost) AS cogs FROM items GROUP BY 1) c USING (product_id)
        WHERE unit_cost * stock > 0 ORDER BY inventory_turnover_ratio DESC, product_id LIMIT 50"""
    q["basket_size_by_channel"] = f"""
        SELECT channel, COUNT(DISTINCT order_id) AS total_orders, COUNT(*) AS total_line_items,
               {_ratio('COUNT(*)', 'COUNT(DISTINCT order_id)')} AS avg_basket_size,
               {_ratio('SUM(line_revenue)', 'COUNT(DISTINCT order_id)')} AS avg_order_value
        FROM ords JOIN lines USING (order_id) GROUP BY 1"""
    q["category_margin"] = f"""
        SELECT category, {_dbl('SUM(line_revenue)')} AS revenue, {_dbl('SUM(line_cost)')} AS cost, {_dbl('SUM(line_profit)')} AS profit,
               {_ratio('SUM(line_profit)', 'SUM(line_revenue)', 100)} AS margin_pct
        FROM items JOIN products USING (product_id) GROUP BY 1"""
    q["regional_sales"] = f"""
        SELECT country, COUNT(DISTINCT o.order_id) AS total_orders, COUNT(DISTINCT c.customer_id) AS unique_customers,
               {_dbl('SUM(line_revenue)')} AS total_revenue, {_ratio('SUM(line_revenue)', 'COUNT(DISTINCT o.order_id)')} AS avg_order_value
        FROM customers c JOIN ords o ON o.customer_id = c.customer_id JOIN lines l ON l.order_id = o.order_id GROUP BY 1"""
    q["product_pareto"] = f"""
        SELECT product_id, product_name, {_dbl('revenue')} AS revenue, {_ratio('running', 'grand', 100)} AS cumulative_revenue_pct,
               {_ratio('rn', 'n', 100)} AS cumulative_product_pct,
               CASE WHEN {_dbl('running')} / {_dbl('grand')} <= 0.80 THEN 'A' WHEN {_dbl('running')} / {_dbl('grand')} <= 0.95 THEN 'B' ELSE 'C' END AS abc_class
        FROM (SELECT *, SUM(revenue) OVER (ORDER BY revenue DESC) AS running, SUM(revenue) OVER () AS grand,
                     ROW_NUMBER() OVER (ORDER BY revenue DESC, product_id) AS rn, COUNT(*) OVER () AS n FROM (
              SELECT product_id, product_name, SUM(line_revenue) AS revenue FROM lines JOIN products USING (product_id) GROUP BY 1, 2) a) b"""
    q["rolling_3mo_revenue"] = f"""
        SELECT {_txt('month')} AS month, {_dbl('revenue')} AS revenue, {_ratio('s', 'k')} AS rolling_avg
        FROM (SELECT *, SUM(revenue) OVER w AS s, COUNT(*) OVER w AS k FROM item_months
              WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) x"""
    q["order_summary"] = f"""
        SELECT o.order_id, {_txt('o.order_date')} AS order_date, c.customer_id, c.customer_segment, c.country AS customer_country,
               o.channel, o.order_status, {_dbl('o.total_amount')} AS total_amount, COUNT(i.order_item_id) AS line_item_count,
               {_dbl('SUM(i.line_profit)')} AS total_profit
        FROM ords o JOIN customers c ON c.customer_id = o.customer_id LEFT JOIN items i ON i.order_id = o.order_id
        GROUP BY o.order_id, o.order_date, c.customer_id, c.customer_segment, c.country, o.channel, o.order_status, o.total_amount"""
    q["product_performance"] = f"""
        SELECT p.product_id, product_name, category, {_int('subcategory')} AS subcategory, brand, {_int('units')} AS units_sold,
               {_dbl('revenue')} AS total_revenue, {_dbl('profit')} AS total_profit, {_ratio('stars', 'rated')} AS avg_rating,
               {_int('COALESCE(k, 0)')} AS review_count
        FROM products p LEFT JOIN (SELECT product_id, SUM(quantity) AS units, SUM(line_revenue) AS revenue, SUM(line_profit) AS profit
                                   FROM items GROUP BY 1) s USING (product_id)
        LEFT JOIN (SELECT product_id, SUM(rating) AS stars, COUNT(rating) AS rated, COUNT(DISTINCT review_id) AS k FROM reviews GROUP BY 1) r USING (product_id)"""
    q["store_performance"] = f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name, n_name AS country, r_name AS city,
               COUNT(DISTINCT o.order_id) AS total_orders, {_dbl('SUM(l.line_revenue)')} AS total_revenue,
               {_ratio('SUM(l.line_revenue)', 'COUNT(DISTINCT o.order_id)')} AS avg_order_value
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
        LEFT JOIN stocked o ON o.store_id = CAST(s_suppkey AS VARCHAR) LEFT JOIN lines l ON l.order_id = o.order_id GROUP BY 1, 2, 3, 4"""
    q["daily_sales_summary"] = f"""
        SELECT {_txt('order_date')} AS order_date, COUNT(DISTINCT order_id) AS order_count, {_int('SUM(quantity)')} AS units_sold,
               {_dbl('SUM(line_revenue)')} AS revenue, {_dbl('SUM(line_profit)')} AS profit FROM dated GROUP BY order_date"""
    rfm = _customer_sales("WHERE o.order_status <> 'Cancelled'")
    q["customer_rfm_base"] = f"""
        SELECT customer_id, {_txt('last_purchase')} AS last_order_date, {_int(f"DATE '{AS_OF}' - last_purchase")} AS recency_days,
               total_orders AS frequency, {_dbl('revenue')} AS monetary FROM {rfm} s"""
    q["refresh_all"] = f"""
        SELECT 'daily_sales_summary' AS table_name, COUNT(DISTINCT order_date) AS n_rows, {_dbl('SUM(line_revenue)')} AS revenue FROM dated
        UNION ALL SELECT 'customer_rfm_base', COUNT(*), {_dbl('SUM(revenue)')} FROM {rfm} s"""
    q["customer_clv_lookup"] = f"""
        SELECT c.customer_id, total_orders, {_dbl('revenue')} AS total_revenue, {_ratio('revenue', 'total_orders')} AS avg_order_value,
               {clv} AS estimated_annual_clv FROM customers c JOIN {_customer_sales()} s USING (customer_id) WHERE c.customer_id = 7"""

    # quality gate
    gate = _gate()
    q["quality_report"] = gate
    q["quality_score"] = f"""
        SELECT {_rnd("GREATEST(0.0, 100.0 - COALESCE(SUM(LEAST(failure_rate_pct, 100.0)) FILTER (NOT passed), 0) / COUNT(*))")} AS score,
               COUNT(*) AS checks_total, COUNT(*) FILTER (passed) AS checks_passed, COUNT(*) FILTER (NOT passed) AS checks_failed
        FROM ({gate}) g"""

    # features and blocks
    q["customer_features"] = f"""
        SELECT customer_id, {_int('recency_days')} AS recency_days, {_int('frequency')} AS frequency, {_dbl('monetary')} AS monetary,
               avg_order_value, {_txt('first_order')} AS first_order, {_txt('last_order')} AS last_order, {_int('tenure_days')} AS tenure_days,
               {_int('R')} AS "R", {_int('F')} AS "F", {_int('M')} AS "M", {_int('rfm_score')} AS rfm_score, rfm_segment FROM features"""
    q["rfm_summary"] = f"""
        SELECT *, {share('total_revenue')} AS revenue_share_pct FROM (
        SELECT rfm_segment, COUNT(*) AS customers, {_ratio('SUM(recency_days)', 'COUNT(recency_days)')} AS avg_recency_days,
               {_ratio('SUM(frequency)', 'COUNT(*)')} AS avg_frequency, {_dbl('SUM(monetary)')} AS total_revenue,
               {_ratio('SUM(monetary)', 'COUNT(*)')} AS avg_monetary FROM features GROUP BY 1) x"""
    q["cohort_retention"] = f"""
        SELECT {_txt('cohort')} AS cohort, {_int('cohort_size')} AS cohort_size, {_int('period')} AS period,
               {_int('active_customers')} AS active_customers, {_ratio('active_customers', 'cohort_size', 100, 1)} AS retention_pct
        FROM {_cohort(12)} x"""
    cells = ", ".join(f"MAX({_ratio('active_customers', 'cohort_size', 100, 1)}) FILTER (period = {i}) AS period_{i}" for i in range(6))
    filled = ", ".join(f"CASE WHEN t IS NOT NULL THEN COALESCE(period_{i}, 0) END AS period_{i}" for i in range(6))
    q["cohort_matrix"] = f"""
        SELECT cohort, cohort_size, {filled} FROM (
        SELECT {_txt('cohort')} AS cohort, {_int('cohort_size')} AS cohort_size, MAX(active_customers) AS t, {cells} FROM {_cohort(6)} x GROUP BY 1, 2) y"""
    q["monthly_revenue"] = _monthly(False)
    q["monthly_revenue_dense"] = _monthly(True)
    q["monthly_trend"] = f"""
        SELECT strftime(a.m, '%Y-%m') AS month, {_dbl('a.revenue')} AS revenue, {_int('a.orders')} AS orders,
               ROUND({_yoy(12)}, 2) AS revenue_yoy_pct, ROUND({_yoy(1)}, 2) AS revenue_mom_pct FROM monthly a"""
    q["items_enriched"] = f"""
        SELECT order_item_id, order_id, customer_id, channel, order_status, product_id, category, brand, {_int('quantity')} AS quantity,
               {_dbl('line_revenue')} AS line_revenue, {_dbl('line_profit')} AS line_profit FROM enriched"""
    q["executive_kpis"] = f"""
        SELECT {_dbl('e.r')} AS total_revenue, {_dbl('e.p')} AS gross_profit, {_ratio('e.p', 'e.r', 100, None)} AS gross_margin_pct,
               o.n AS total_orders, o.c AS unique_customers, {_ratio('e.r', 'o.n', 1, None)} AS avg_order_value,
               CAST(h.again AS DOUBLE) / CAST(h.k AS DOUBLE) * 100 AS repeat_purchase_rate_pct,
               {_ratio('b.k', 'o.n', 100, None)} AS return_rate_pct, y.yoy AS revenue_yoy_pct, o.lo AS date_start, o.hi AS date_end
        FROM (SELECT SUM(line_revenue) AS r, SUM(line_profit) AS p FROM enriched) e,
             (SELECT COUNT(DISTINCT order_id) AS n, COUNT(DISTINCT customer_id) AS c, {_txt('MIN(order_date)')} AS lo, {_txt('MAX(order_date)')} AS hi FROM rev) o,
             (SELECT COUNT(*) FILTER (n > 1) AS again, COUNT(*) AS k FROM (SELECT customer_id, COUNT(DISTINCT order_id) AS n FROM rev GROUP BY 1) z) h,
             (SELECT COUNT(DISTINCT order_id) AS k FROM returned) b,
             (SELECT ({_dbl('v')} / {_dbl('before')} - 1) * 100 AS yoy FROM (
                SELECT yr, v, LAG(v) OVER (ORDER BY yr) AS before FROM (SELECT year(order_date) AS yr, SUM(total_amount) AS v FROM rev GROUP BY 1) u) w
              ORDER BY yr DESC LIMIT 1) y"""
    q["geographic_performance"] = f"""
        SELECT *, {share('revenue')} AS revenue_share_pct FROM (
        SELECT country, {_dbl('SUM(total_amount)')} AS revenue, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers,
               {_ratio('SUM(total_amount)', 'COUNT(DISTINCT order_id)')} AS avg_order_value,
               {_ratio('SUM(total_amount)', 'COUNT(DISTINCT customer_id)')} AS revenue_per_customer
        FROM rev JOIN customers USING (customer_id) GROUP BY 1) x"""
    category = f"""
        SELECT *, {share('revenue')} AS revenue_share_pct FROM (
        SELECT category, {_dbl('SUM(line_revenue)')} AS revenue, {_dbl('SUM(line_profit)')} AS profit, {_int('SUM(quantity)')} AS units,
               {_ratio('SUM(line_profit)', 'SUM(line_revenue)', 100)} AS margin_pct FROM enriched GROUP BY 1) x"""
    q["category_performance"] = category
    q["report_round_trip"] = category
    sold = """(SELECT product_id, p.product_name, p.category, SUM(line_revenue) AS revenue, SUM(line_profit) AS profit
               FROM enriched e JOIN products p USING (product_id) GROUP BY 1, 2, 3)"""
    reached = (f"({_dbl('SUM(revenue) OVER (ORDER BY revenue DESC, product_id ROWS UNBOUNDED PRECEDING)')} * 100.0 / "
               f"{_dbl('SUM(revenue) OVER ()')})")
    classified = f"""
        (SELECT product_id, product_name, category, revenue, profit, c AS cum_revenue_pct,
                CASE WHEN c <= 80 THEN 'A' WHEN c <= 95 THEN 'B' ELSE 'C' END AS abc_class
         FROM (SELECT *, {reached} AS c FROM {sold} s) t)"""
    q["product_abc"] = f"""
        SELECT product_id, product_name, category, {_dbl('revenue')} AS revenue, {_dbl('profit')} AS profit, cum_revenue_pct, abc_class FROM {classified} k"""
    q["product_abc_summary"] = f"""
        SELECT abc_class, products, {_dbl('revenue')} AS revenue, {share('products')} AS product_share_pct, {share('revenue')} AS revenue_share_pct
        FROM (SELECT abc_class, COUNT(*) AS products, SUM(revenue) AS revenue FROM {classified} k GROUP BY 1) x"""
    q["product_abc_top"] = f"""
        SELECT product_id, product_name, category, {_dbl('revenue')} AS revenue, {_dbl('profit')} AS profit FROM (SELECT * FROM {sold} s {_tops(10)}) t"""
    q["channel_mix"] = f"""
        SELECT *, {share('revenue')} AS revenue_share_pct FROM (
        SELECT channel, {_dbl('SUM(total_amount)')} AS revenue, COUNT(DISTINCT order_id) AS orders,
               {_ratio('SUM(total_amount)', 'COUNT(DISTINCT order_id)')} AS avg_order_value FROM rev GROUP BY 1) x"""
    sums = ("SUM(budget_usd) AS spend, SUM(revenue_usd) AS revenue, CAST(SUM(impressions) AS BIGINT) AS impressions, "
            "CAST(SUM(clicks) AS BIGINT) AS clicks, CAST(SUM(conversions) AS BIGINT) AS conversions")
    q["marketing_by_channel"] = f"""
        SELECT channel, {_dbl('spend')} AS spend, {_dbl('revenue')} AS revenue, impressions, clicks, conversions, campaigns,
               {_ratio('revenue', 'spend')} AS roas, {_ratio('clicks', 'impressions', 100)} AS ctr_pct, {_ratio('conversions', 'clicks', 100)} AS cvr_pct
        FROM (SELECT channel, {sums}, COUNT(campaign_id) AS campaigns FROM campaigns GROUP BY 1) x"""
    q["marketing_funnel"] = f"""
        SELECT impressions, clicks, conversions, {_dbl('spend')} AS total_spend, {_dbl('revenue')} AS total_revenue,
               {_ratio('revenue', 'spend')} AS blended_roas FROM (SELECT {sums} FROM campaigns) x"""
    q["returns_summary"] = f"""
        SELECT COUNT(*) AS total_returns, {_dbl('SUM(refund_amount)')} AS total_refunds,
               {_ratio('COUNT(*) FILTER (restocked)', 'COUNT(*)', 100)} AS restock_rate_pct FROM returned"""
    q["returns_by_reason"] = f"""
        SELECT return_reason, returns, refund_amount, {share('returns')} AS share_pct FROM (
        SELECT return_reason, COUNT(*) AS returns, {_dbl('SUM(refund_amount)')} AS refund_amount FROM returned GROUP BY 1) x"""
    q["revenue_forecast"] = _forecast(f"(SELECT m, {_dbl('revenue')} AS y FROM monthly) src", [])
    q["revenue_forecast_by_category"] = _forecast(
        f"""(SELECT category, date_trunc('month', order_date) AS m, {_dbl('SUM(line_revenue)')} AS y
             FROM dated JOIN products USING (product_id) GROUP BY 1, 2) src""", ["category"])
    q["driver_correlations"] = f"""
        SELECT driver, ROUND(corr(revenue, value), 3) AS correlation, COUNT(*) AS periods FROM (
        SELECT CAST(ts AS DATE) AS day, {_dbl("SUM(CAST(value AS DECIMAL(12,2))) FILTER (event_type = 'purchase')")} AS revenue FROM events GROUP BY 1) r
        JOIN (SELECT CAST(ts AS DATE) AS day, 'Marketing spend' AS driver, {_dbl("SUM(CAST(value AS DECIMAL(12,2))) FILTER (event_type = 'click')")} AS value FROM events GROUP BY 1
              UNION ALL SELECT CAST(ts AS DATE), 'Website visitors', {_dbl('COUNT(DISTINCT user_id)')} FROM events GROUP BY 1) d USING (day)
        WHERE revenue IS NOT NULL AND value IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 3"""
    q["linear_trend"] = f"""
        SELECT channel, ROUND(regr_slope(y, x), 2) AS slope, ROUND(regr_intercept(y, x), 0) AS intercept, COUNT(*) AS n FROM (
        SELECT channel, year(order_date) * 12 + month(order_date) AS x, {_dbl('SUM(total_amount)')} AS y FROM ords GROUP BY 1, 2) q GROUP BY 1"""
    q["correlate"] = f"""
        SELECT return_flag, ROUND(corr(quantity, {_dbl('line_revenue')}), 3) AS correlation, COUNT(*) AS periods FROM lines GROUP BY 1"""
    q["customer_clv_sql"] = q["customer_clv_lookup"]
    given = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
             "embeddings", "pages", "benchmark", "labels", "conversations")
    counts = " + ".join(f"(SELECT COUNT(*) FROM {t})" for t in given)
    q["run_meta"] = f"SELECT {len(given)}::BIGINT AS tables_loaded, CAST({counts} AS BIGINT) AS rows_scanned"

    # sources and sinks
    q["csv_round_trip"] = f"""
        SELECT {_txt('order_id')} AS order_id, {_txt('customer_id')} AS customer_id, {_txt('order_date')} AS order_date, order_status,
               {_dbl('total_amount')} AS total_amount FROM ords"""
    landed = {"dim_customers": "customer", "dim_products": "part", "dim_stores": "supplier", "fact_orders": "orders",
              "fact_order_items": "lineitem JOIN orders ON l_orderkey = o_orderkey",
              "fact_returns": "lineitem WHERE l_returnflag = 'R'", "fact_reviews": "lineitem",
              "fact_inventory": "(SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) x",
              "fact_marketing_campaigns": "(SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) x",
              "fact_website_traffic": "(SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) x"}
    q["land_tables"] = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS n_rows FROM {source}" for name, source in landed.items())
    q["year_partitions"] = f"""
        SELECT CASE WHEN year(order_date) BETWEEN 1996 AND 2000 THEN CAST(year(order_date) AS VARCHAR) ELSE 'default' END AS order_year,
               COUNT(*) AS n_orders, {_dbl('SUM(total_amount)')} AS revenue FROM ords GROUP BY 1"""

    # churn
    q["churn_features"] = f"""
        SELECT customer_id, {_int('recency_days')} AS recency_days, frequency, {_dbl('monetary')} AS monetary, avg_order_value,
               {_int('tenure_days')} AS tenure_days, distinct_categories, n_returns, {_int('age')} AS age, country, acquisition_channel,
               customer_segment, is_loyalty_member FROM churn_base"""
    q["churn_labels"] = f"SELECT customer_id, {_int('churned')} AS churned FROM labelled"
    q["stratified_split"] = f"""
        SELECT {_int('churned')} AS churned, t.is_test, {_int('CASE WHEN t.is_test THEN ROUND(k * 0.25) ELSE k - ROUND(k * 0.25) END')} AS n_rows
        FROM (SELECT churned, COUNT(*) AS k FROM labelled GROUP BY 1) x CROSS JOIN (SELECT TRUE AS is_test UNION ALL SELECT FALSE) t"""
    q["evaluate"] = f"""
        SELECT ROUND(a.auc, 4) AS roc_auc, ROUND(a.ap, 4) AS pr_auc, ROUND(COALESCE(c.tp / NULLIF({_dbl('c.tp + c.fp')}, 0), 0), 4) AS precision,
               ROUND(c.tp / {_dbl('c.tp + c.fn')}, 4) AS recall, ROUND(2 * c.tp / {_dbl('2 * c.tp + c.fp + c.fn')}, 4) AS f1,
               ROUND((c.tp + c.fn) / {_dbl('c.n')}, 4) AS baseline_churn_rate, c.tn, c.fp, c.fn, c.tp
        FROM (SELECT SUM({_dbl('pos')} * (nn - fp + neg / 2.0)) / MAX({_dbl('np')} * nn) AS auc,
                     SUM(pos / {_dbl('np')} * (tp / {_dbl('tp + fp')})) AS ap FROM scan) a,
             (SELECT COUNT(*) AS n, COUNT(*) FILTER (churned = 0 AND p < 0.5) AS tn, COUNT(*) FILTER (churned = 0 AND p >= 0.5) AS fp,
                     COUNT(*) FILTER (churned = 1 AND p < 0.5) AS fn, COUNT(*) FILTER (churned = 1 AND p >= 0.5) AS tp FROM risk) c"""
    q["roc_curve"] = f"""
        SELECT 0::BIGINT AS point, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
        UNION ALL SELECT rn, ROUND({_dbl('fp')} / nn, 4), ROUND({_dbl('tp')} / np, 4) FROM scan
        WHERE rn % greatest(1, m // 60) = 0 OR rn = m"""
    q["decile_lift"] = f"""
        SELECT {_int('d')} AS decile, ROUND(COALESCE({_dbl('s')} / k, 0), 4) AS churn_rate, ROUND(COALESCE({_dbl('s')} / k / base, 0), 2) AS lift
        FROM range(1, 11) g(d) LEFT JOIN (
          SELECT (10 * rn + n - 1) // n AS decile, SUM(churned) AS s, COUNT(*) AS k FROM (
            SELECT *, ROW_NUMBER() OVER (ORDER BY p DESC, customer_id) AS rn, COUNT(*) OVER () AS n FROM risk) a GROUP BY 1) b ON b.decile = g.d
        CROSS JOIN (SELECT AVG({_dbl('churned')}) AS base FROM risk) z"""
    q["risk_tier_summary"] = f"""
        SELECT risk_tier, COUNT(customer_id) AS customers, COALESCE({_dbl('SUM(monetary)')}, 0) AS monetary,
               COALESCE({_dbl("SUM(monetary) FILTER (tier IN ('High', 'Critical'))")}, 0) AS revenue_at_risk
        FROM (SELECT unnest(['Low', 'Medium', 'High', 'Critical', 'Total']) AS risk_tier) w LEFT JOIN (
          SELECT *, CASE WHEN p <= 0.3 THEN 'Low' WHEN p <= 0.6 THEN 'Medium' WHEN p <= 0.8 THEN 'High' ELSE 'Critical' END AS tier FROM risk) t
          ON risk_tier = tier OR risk_tier = 'Total' GROUP BY 1"""
    q["score_checks"] = """
        SELECT COUNT(*) AS n_scored, COUNT(*) AS n_customers, COUNT(*) AS n_probabilities, COUNT(*) AS n_in_a_tier FROM risk"""
    q["null_order_bands"] = f"""
        SELECT {_int('band')} AS band, COUNT(*) AS n_orders, COUNT(amount) AS n_amounts FROM (
          SELECT amount, greatest(1, (5 * (rn - 1) + n - 2) // (n - 1)) AS band FROM (
            SELECT amount, ROW_NUMBER() OVER (ORDER BY amount NULLS FIRST, o_orderkey) AS rn, COUNT(*) OVER () AS n FROM (
              SELECT o_orderkey, CASE WHEN o_orderkey % 10 != 0 THEN o_totalprice END AS amount FROM orders) a) b) c GROUP BY 1"""

    # streaming
    q["stream_daily_sales"] = f"""
        SELECT {_txt('day')} AS order_date, COUNT(DISTINCT user_id) AS order_count, COUNT(*) AS units_sold, {_dbl('SUM(v)')} AS revenue
        FROM (SELECT CAST(ts AS DATE) AS day, user_id, CAST(value AS DECIMAL(12,2)) AS v
              FROM events WHERE event_type = 'purchase') x GROUP BY day"""
    q["stream_validate"] = f"""
        SELECT CASE WHEN l_extendedprice < 0 THEN 'negative revenue' WHEN l_quantity <= 0 THEN 'non-positive quantity'
                    WHEN l_discount > 0.09 THEN 'discount too high' ELSE 'accepted' END AS outcome, COUNT(*) AS n_rows,
               {_dbl('SUM(CAST(l_extendedprice AS DECIMAL(12,2)))')} AS line_revenue FROM lineitem GROUP BY 1"""
    q["stream_upsert"] = """
        SELECT o_custkey, MAX(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1"""
    return {name: _sql(body) for name, body in q.items()}


ORACLE: dict[str, str] = _build()
