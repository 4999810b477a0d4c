"""The same results in DuckDB SQL over the star-schema tables, to check against.

Written apart from the operators: tables are rebuilt as CTEs, money is whole cents,
joins fan out as they may, and rounding is integer arithmetic.
"""

from __future__ import annotations

# What follows is spelled out here and not taken from the operators, so that a wrong rule
# there can't match itself. Fixed values.

# Segment; lowest and highest score of recency, frequency and money. The first that fits.
_SEGMENTS = """
    (0, 'Champions', 4, 5, 4, 5, 4, 5),
    (1, 'Can''t Lose Them', 1, 2, 4, 5, 4, 5),
    (2, 'Need Attention', 3, 3, 3, 3, 3, 3),
    (3, 'At Risk', 1, 2, 3, 5, 3, 5),
    (4, 'Loyal Customers', 1, 5, 3, 5, 3, 5),
    (5, 'Potential Loyalists', 3, 5, 2, 5, 2, 5),
    (6, 'New Customers', 4, 5, 1, 2, 1, 5),
    (7, 'Promising', 3, 5, 1, 2, 1, 2),
    (8, 'Lost', 1, 1, 1, 1, 1, 1),
    (9, 'About to Sleep', 2, 2, 2, 5, 1, 5),
    (10, 'Hibernating', 1, 2, 1, 2, 1, 5)"""

_KEYS = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_reviews": ["review_id"],
    "product_category_translation": ["product_category_name"],
}

_REFERENCES = [
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("order_items", "seller_id", "sellers"),
    ("order_payments", "order_id", "orders"),
    ("order_reviews", "order_id", "orders"),
]

_NOT_NULL = {
    "customers": [
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
        "customer_state",
    ],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp"],
    "products": ["product_id"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "order_items": [
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
        "price", "freight_value",
    ],
    "order_payments": [
        "order_id", "payment_sequential", "payment_type", "payment_installments",
        "payment_value",
    ],
    "order_reviews": [
        "review_id", "order_id", "review_score", "review_creation_date",
        "review_answer_timestamp",
    ],
    "product_category_translation": ["product_category_name", "product_category_name_english"],
}

_LENGTHS = {
    "customers": {
        "customer_id": 32, "customer_unique_id": 32, "customer_zip_code_prefix": 10,
        "customer_city": 100, "customer_state": 2,
    },
    "orders": {
        "order_id": 32, "customer_id": 32, "order_status": 20,
    },
    "products": {
        "product_id": 32, "product_category_name": 100,
    },
    "sellers": {
        "seller_id": 32, "seller_zip_code_prefix": 10, "seller_city": 100, "seller_state":
        2,
    },
    "order_items": {
        "order_id": 32, "product_id": 32, "seller_id": 32,
    },
    "order_payments": {
        "order_id": 32, "payment_type": 30,
    },
    "order_reviews": {
        "review_id": 32, "order_id": 32,
    },
    "product_category_translation": {
        "product_category_name": 100, "product_category_name_english": 100,
    },
}

_CTES = {
    "m_orders": """
        SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
            CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                WHEN 'P' THEN 'canceled' END AS order_status,
            o_orderdate AS order_purchase_timestamp,
            o_orderdate + to_days(1) AS order_approved_at,
            CAST(NULL AS TIMESTAMP) AS order_delivered_carrier_date,
            CASE WHEN o_orderstatus = 'F' AND o_orderkey % 50 <> 0
                THEN o_orderdate + to_hours(o_orderkey * 7919 % 900)
                END AS order_delivered_customer_date,
            o_orderdate + to_days(20) AS order_estimated_delivery_date
        FROM orders""",
    "m_customers": """
        SELECT o_orderkey AS customer_id, o_custkey * 8 + o_orderkey % 8 AS customer_unique_id,
            lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
            c_mktsegment AS customer_city, n_name AS customer_state
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey""",
    "m_payments": """
        SELECT o_orderkey AS order_id, 1 AS payment_sequential,
            CASE WHEN o_orderkey % 4 = 0 THEN 'boleto' ELSE 'credit_card' END AS payment_type,
            CAST(1 + o_orderkey % 10 AS INTEGER) AS payment_installments,
            CAST(round(o_totalprice * 100) AS BIGINT) // 500 AS cents
        FROM orders WHERE o_orderkey % 97 <> 0
        UNION ALL
        SELECT o_orderkey, 2, 'voucher', CAST(1 + o_orderkey % 10 AS INTEGER),
            o_orderkey % 500 * 100
        FROM orders WHERE o_orderkey % 20 = 0""",
    "m_reviews": """
        SELECT o_orderkey AS review_id, o_orderkey AS order_id,
            CASE WHEN o_orderkey * 31 % 100 < 58 THEN 5 WHEN o_orderkey * 31 % 100 < 77 THEN 4
                WHEN o_orderkey * 31 % 100 < 85 THEN 3 WHEN o_orderkey * 31 % 100 < 88 THEN 2
                ELSE 1 END AS review_score,
            o_orderdate AS review_creation_date, o_orderdate AS review_answer_timestamp
        FROM orders WHERE o_orderkey % 113 <> 0
        UNION ALL
        SELECT o_orderkey, o_orderkey, 1, o_orderdate, o_orderdate
        FROM orders WHERE o_orderkey % 50 = 7""",
    "m_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
            l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
            CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents,
            CAST(round(l_quantity * 100) AS BIGINT) AS freight_cents
        FROM lineitem""",
    "m_products": """
        SELECT p_partkey AS product_id,
            CASE WHEN p_partkey % 50 <> 0
                THEN lower(p_type) || '_' || split_part(p_name, ' ', 2)
                END AS product_category_name
        FROM part""",
    "m_sellers": """
        SELECT s_suppkey AS seller_id,
            lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
            s_name AS seller_city, n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "m_translation": """
        SELECT DISTINCT product_category_name,
            upper(product_category_name) AS product_category_name_english
        FROM m_products WHERE product_category_name LIKE '%g%'""",
    "paid": """
        SELECT customer_unique_id, order_id, order_purchase_timestamp, sum(cents) AS cents
        FROM m_payments JOIN m_orders USING (order_id) JOIN m_customers USING (customer_id)
        GROUP BY ALL""",
    "totals": """
        SELECT customer_unique_id, count(*) AS orders, sum(cents) AS cents,
            max(order_purchase_timestamp) AS last_order
        FROM paid GROUP BY customer_unique_id""",
    "today": "SELECT max(order_purchase_timestamp) AS today FROM m_orders",
    "scored": """
        SELECT customer_unique_id, orders, cents,
            CAST(extract(day FROM (today - last_order)) AS INTEGER) AS recency_days,
            6 - ntile(5) OVER (ORDER BY recency_days, customer_unique_id) AS r,
            ntile(5) OVER (ORDER BY orders, customer_unique_id) AS f,
            ntile(5) OVER (ORDER BY cents, customer_unique_id) AS m
        FROM totals, today""",
    "rules": f"SELECT * FROM (VALUES {_SEGMENTS}) AS x(rank, label, r1, r2, f1, f2, m1, m2)",
    "segments": f"""
        SELECT scored.*, coalesce(arg_min(label, rank), 'Others') AS segment
        FROM scored LEFT JOIN rules ON r BETWEEN r1 AND r2 AND f BETWEEN f1 AND f2
            AND m BETWEEN m1 AND m2
        GROUP BY ALL""",
    "person_months": """
        SELECT DISTINCT customer_unique_id,
            year(order_purchase_timestamp) * 12 + month(order_purchase_timestamp) - 1 AS m
        FROM m_orders JOIN m_customers USING (customer_id)""",
    "cohorts": """
        SELECT first AS cohort, m - first AS months_since, size AS cohort_size,
            count(*) AS active, {rate} AS retention_rate
        FROM person_months
        JOIN (SELECT customer_unique_id, min(m) AS first FROM person_months GROUP BY 1)
            USING (customer_unique_id)
        JOIN (SELECT first AS f, count(*) AS size FROM
                (SELECT min(m) AS first FROM person_months GROUP BY customer_unique_id) GROUP BY 1)
            ON f = first
        GROUP BY first, m, size""",
    "gaps": """
        SELECT customer_unique_id, order_purchase_timestamp AS bought,
            extract(day FROM (bought - lag(bought) OVER (PARTITION BY customer_unique_id
                ORDER BY bought, order_id))) AS gap
        FROM m_orders JOIN m_customers USING (customer_id)""",
    "cadence": """
        SELECT customer_unique_id, count(*) AS order_count, {gap} AS avg_days_between,
            max(bought) AS last_order_date,
            CAST(extract(day FROM (any_value(today) - max(bought))) AS INTEGER) AS days_since_last
        FROM gaps, today GROUP BY customer_unique_id HAVING count(gap) > 0""",
    "churn": """
        SELECT *, CAST((CAST(avg_days_between * 10 AS BIGINT) * 3 + 1) // 2 AS DECIMAL(17,0))
                * CAST(0.1 AS DECIMAL(2,1)) AS churn_threshold,
            days_since_last * 10 > (CAST(avg_days_between * 10 AS BIGINT) * 3 + 1) // 2
                AS is_churned
        FROM cadence""",
    "delivered": f"""
        SELECT order_id, CAST(extract(day FROM (order_delivered_customer_date
                - order_estimated_delivery_date)) AS INTEGER) AS delta, review_score,
            CASE WHEN delta < 0 THEN 'Early' WHEN delta = 0 THEN 'On-Time'
                WHEN delta <= 7 THEN 'Late (1–7 days)' ELSE 'Late (>7 days)' END AS bucket
        FROM m_orders LEFT JOIN m_reviews USING (order_id)
        WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL""",
    "by_delivery": """
        SELECT bucket AS delivery_bucket, count(*) AS order_count, {share} AS pct_of_total,
            {delta} AS avg_delta_days, {score} AS avg_review_score,
            CAST(min(review_score) AS DECIMAL(18,2)) AS min_review,
            CAST(max(review_score) AS DECIMAL(18,2)) AS max_review
        FROM delivered GROUP BY bucket""",
}


def _round(total: str, count: str, digits: int, scale: int = 0) -> str:
    """``total / 10^scale / count`` rounded half away from zero, as DECIMAL(18, digits)."""
    total, count = f"CAST({total} AS HUGEINT)", f"CAST({count} AS HUGEINT)"
    up, down = 10**digits, 10**scale
    whole = (
        f"sign({total}) * ((2 * abs({total}) * {up} + {count} * {down})"
        f" // (2 * {count} * {down}))"
    )
    unit = f"CAST(1e-{digits} AS DECIMAL({digits + 1},{digits}))"
    return f"CAST(CAST({whole} AS DECIMAL(18,0)) * {unit} AS DECIMAL(18,{digits}))"


def _money(cents: str, precision: int = 20) -> str:
    return (
        f"CAST(CAST({cents} AS DECIMAL({precision},0)) * CAST(0.01 AS DECIMAL(2,2))"
        f" AS DECIMAL({precision},2))"
    )


_CTES["cohorts"] = _CTES["cohorts"].format(rate=_round("count(*) * 100", "size", 2))
_CTES["cadence"] = _CTES["cadence"].format(gap=_round("sum(gap)", "count(gap)", 1))
_CTES["by_delivery"] = _CTES["by_delivery"].format(
    share=_round("count(*) * 100", "sum(count(*)) OVER ()", 1),
    delta=_round("sum(delta)", "count(*)", 1),
    score=_round("sum(review_score)", "count(review_score)", 2),
)


def _query(body: str) -> str:
    """``body`` after the CTEs it names, and those they name."""
    wanted, text = [], body
    for name in reversed(_CTES):
        if name in text:
            wanted.insert(0, name)
            text += _CTES[name]
    ctes = ",\n".join(f"{name} AS ({_CTES[name]})" for name in wanted)
    return f"WITH {ctes}\n{body}"


_RFM_COLUMNS = f"""recency_days, orders AS frequency, {_money('cents')} AS monetary,
    CAST(r AS INTEGER) AS r_score, CAST(f AS INTEGER) AS f_score,
    CAST(m AS INTEGER) AS m_score, segment"""
_MEAN_SPEND = _round("sum(cents)", "count(*)", 0, scale=2)
_CHURN_COLUMNS = """customer_unique_id, order_count, avg_days_between, last_order_date,
    days_since_last, CAST(churn_threshold AS DECIMAL(18,1)) AS churn_threshold, is_churned"""

_SPARK_NAMES = {
    "customers": "m_customers", "orders": "m_orders", "products": "m_products",
    "sellers": "m_sellers", "order_items": "m_items", "order_payments": "m_payments",
    "order_reviews": "m_reviews", "product_category_translation": "m_translation",
}


def _row_counts() -> str:
    """Counts of the star schema's own tables, by the rules that derive the marketplace's."""
    expected = {
        "customers": "SELECT count(*) FROM orders",
        "orders": "SELECT count(*) FROM orders",
        "order_items": "SELECT count(*) FROM lineitem",
        "order_payments": "SELECT count(*) FILTER (WHERE o_orderkey % 97 <> 0)"
        " + count(*) FILTER (WHERE o_orderkey % 20 = 0) FROM orders",
        "order_reviews": "SELECT count(*) FILTER (WHERE o_orderkey % 113 <> 0)"
        " + count(*) FILTER (WHERE o_orderkey % 50 = 7) FROM orders",
        "products": "SELECT count(*) FROM part",
        "sellers": "SELECT count(*) FROM supplier",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count,"
        + (f" ({expected[name]}) AS expected, count(*) = ({expected[name]}) AS matches"
           if name in expected else
           " CAST(NULL AS BIGINT) AS expected, CAST(NULL AS BOOLEAN) AS matches")
        + f" FROM {cte}"
        for name, cte in _SPARK_NAMES.items()
    )


def _duplicates() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{','.join(key)}' AS key_columns,"
        f" count(*) AS n_dup_keys FROM (SELECT {', '.join(key)} FROM {_SPARK_NAMES[name]}"
        f" GROUP BY ALL HAVING count(*) > 1)"
        for name, key in _KEYS.items()
    )


def _orphans() -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}.{column}' AS fk, count(*) AS n_orphans FROM {_SPARK_NAMES[table]}"
        f" WHERE {column} NOT IN (SELECT {column} FROM {_SPARK_NAMES[parent]})"
        for table, column, parent in _REFERENCES
    )


_CENTS = {
    "price": "price_cents", "freight_value": "freight_cents", "payment_value": "cents",
}


def _columns(tests: dict[str, dict[str, str]], result: str) -> str:
    """How many rows meet each column's test; ``{c}`` is the column."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{column}' AS column_name,"
        f" count(*) FILTER (WHERE {test.format(c=_CENTS.get(column, column))})"
        f" AS {result} FROM {_SPARK_NAMES[name]}"
        for name, columns in tests.items() for column, test in columns.items()
    )


# First and last month of orders in the star schema, at any scale factor: year, month.
_FIRST_MONTH, _LAST_MONTH = (1992, 1), (1998, 7)


def _matrix() -> str:
    (year, month), (last_year, last_month) = _FIRST_MONTH, _LAST_MONTH
    months = (last_year - year) * 12 + last_month - month + 1
    columns = ", ".join(
        f"CAST(coalesce(max(retention_rate) FILTER (WHERE months_since = {n}), 0)"
        f" AS DECIMAL(18,2)) AS M{n}"
        for n in range(months)
    )
    return f"""SELECT printf('%04d-%02d', cohort // 12, cohort % 12 + 1) AS cohort, {columns}
        FROM cohorts WHERE cohort_size >= 50 GROUP BY cohort"""


def _seller_performance() -> str:
    return f"""
        SELECT *, CASE
            WHEN avg_review >= 4 AND avg_delivery_delta_days < 0 THEN '★ Star Seller'
            WHEN avg_review >= global_avg_review AND avg_delivery_delta_days <= global_avg_delta
                THEN '● Above Average'
            WHEN avg_review < 3 OR avg_delivery_delta_days > 10 THEN '▼ Underperformer'
            ELSE '■ Average' END AS performance_tier
        FROM (SELECT *,
            {_round("sum(avg_review * 100) OVER ()", "count(avg_review) OVER ()", 2, scale=2)}
                AS global_avg_review,
            {_round("sum(avg_delivery_delta_days * 10) OVER ()",
                    "count(avg_delivery_delta_days) OVER ()", 1, scale=1)} AS global_avg_delta
            FROM (SELECT seller_id, seller_city, seller_state, count(*) AS items_sold,
                count(DISTINCT order_id) AS distinct_orders,
                count(DISTINCT customer_unique_id) AS unique_customers,
                {_money("sum(price_cents)")} AS total_revenue,
                {_round("sum(review_score)", "count(review_score)", 2)} AS avg_review,
                {_round("sum(delta)", "count(delta)", 1)} AS avg_delivery_delta_days
                FROM (SELECT *, extract(day FROM (order_delivered_customer_date
                        - order_estimated_delivery_date)) AS delta
                    FROM m_items JOIN m_orders USING (order_id)
                    JOIN m_customers USING (customer_id) JOIN m_sellers USING (seller_id)
                    LEFT JOIN m_reviews USING (order_id) WHERE order_status = 'delivered')
                GROUP BY ALL HAVING count(*) >= 30))"""


def _order_value_tiers() -> str:
    labels = ["Low (<R$50)", "Medium (R$50–200)", "High (R$200–500)", "Premium (>R$500)"]
    return f"""
        SELECT CASE WHEN value < 5000 THEN '{labels[0]}' WHEN value < 20000 THEN '{labels[1]}'
                WHEN value < 50000 THEN '{labels[2]}' ELSE '{labels[3]}' END AS value_tier,
            CAST(count(*) AS BIGINT) AS order_count,
            {_round("sum(value)", "count(*)", 2, scale=2)} AS avg_order_value,
            {_round("sum(review_score)", "count(review_score)", 2)} AS avg_review_score
        FROM (SELECT order_id, sum(cents) AS value FROM m_payments GROUP BY 1)
        LEFT JOIN m_reviews USING (order_id) GROUP BY 1"""


def _ltv_histogram() -> str:
    return f"""
        SELECT CAST(bucket AS INTEGER) AS bucket,
            {_round("lo * 50 + (bucket - 1) * (hi - lo)", "50", 0, scale=2)} AS bin_lo,
            {_round("lo * 50 + bucket * (hi - lo)", "50", 0, scale=2)} AS bin_hi,
            count(*) AS customers
        FROM (SELECT lo, hi, (cents - lo) * 50 // (hi + 1 - lo) + 1 AS bucket FROM totals,
            (SELECT min(cents) AS lo, max(cents) AS hi FROM totals))
        GROUP BY bucket, lo, hi"""


def _ltv_stats() -> str:
    return f"""
        SELECT {_round("sum(cents) FILTER (WHERE middle)", "count(*) FILTER (WHERE middle)", 0, 2)}
                AS median,
            {_MEAN_SPEND} AS mean, {_round("max(cents)", "1", 0, scale=2)} AS max,
            count(*) FILTER (WHERE orders > 1) AS multi_order
        FROM (SELECT *, row_number() OVER (ORDER BY cents) AS place, count(*) OVER () AS n,
            place IN ((n + 1) // 2, (n + 2) // 2) AS middle FROM totals)"""


def oracles() -> dict[str, str]:
    """Query key to SQL."""
    everybody = "count(*)"
    churned = "count(*) FILTER (WHERE is_churned)"
    active = "count(*) FILTER (WHERE NOT is_churned)"
    details = f"""
        SELECT order_id, order_purchase_timestamp, order_status, customer_unique_id,
            customer_state, order_item_id, product_id,
            coalesce(product_category_name_english, product_category_name, 'unknown')
                AS product_category_english,
            {_money('price_cents', 10)} AS price, {_money('freight_cents', 10)}
                AS freight_value, review_score
        FROM m_items JOIN m_orders USING (order_id) JOIN m_customers USING (customer_id)
        JOIN m_products USING (product_id)
        LEFT JOIN m_translation USING (product_category_name)
        LEFT JOIN m_reviews USING (order_id)"""
    bodies = {
        "total_revenue": f"SELECT {_money('sum(cents)')} AS total_revenue FROM m_payments",
        "total_orders": "SELECT count(DISTINCT order_id) AS total_orders FROM m_orders",
        "top_products": f"""
            SELECT product_id, count(*) AS units_sold,
                {_money('sum(price_cents)')} AS total_product_revenue
            FROM m_items GROUP BY product_id ORDER BY units_sold DESC, product_id LIMIT 10""",
        "orders_by_state": """
            SELECT customer_state, count(*) AS order_count
            FROM m_customers JOIN m_orders USING (customer_id) GROUP BY customer_state""",
        "avg_review_score": f"""
            SELECT {_round('sum(review_score)', 'count(*)', 2)} AS avg_review_score,
                count(*) AS total_reviews FROM m_reviews""",
        "orders_in_range": """
            SELECT order_id, order_purchase_timestamp, order_status FROM m_orders
            WHERE CAST(order_purchase_timestamp AS DATE) BETWEEN '1998-01-01' AND '1998-03-31'
            ORDER BY order_purchase_timestamp, order_id LIMIT 20""",
        "orders_by_status": """
            SELECT order_status, count(*) AS order_count FROM m_orders GROUP BY 1""",
        "categories_like": """
            SELECT DISTINCT product_category_name FROM m_products
            WHERE contains(lower(product_category_name), 'promo')""",
        "top_payments": f"""
            SELECT order_id, payment_type, payment_installments,
                {_money('cents', 10)} AS payment_value
            FROM m_payments ORDER BY cents DESC, order_id, payment_sequential LIMIT 5""",
        "state_revenue_summary": f"""
            SELECT customer_state, count(DISTINCT order_id) AS total_orders,
                {_money('sum(cents)')} AS total_revenue,
                {_round('sum(cents)', 'count(*)', 2, scale=2)} AS avg_payment,
                {_money('min(cents)', 10)} AS min_payment,
                {_money('max(cents)', 10)} AS max_payment
            FROM m_payments JOIN m_orders USING (order_id) JOIN m_customers USING (customer_id)
            GROUP BY customer_state""",
        "monthly_orders": """
            SELECT make_date(year(bought), month(bought), 1) AS order_month, count(*) AS order_count
            FROM (SELECT order_purchase_timestamp AS bought FROM m_orders) GROUP BY 1""",
        "review_distribution": f"""
            SELECT review_score, n AS review_count,
                {_round('n * 100', '(SELECT count(*) FROM m_reviews)', 1)} AS pct_of_total
            FROM (SELECT review_score, count(*) AS n FROM m_reviews GROUP BY 1)""",
        "order_details": f"""{details}
            ORDER BY order_purchase_timestamp DESC, order_id, order_item_id, review_score,
                product_id, price, freight_value LIMIT 20""",
        "order_details_full": details,
        "underperforming_sellers": f"""
            SELECT seller_id, count(DISTINCT order_id) AS total_orders, count(*) AS items_sold,
                {_round('sum(review_score)', 'count(*)', 2)} AS avg_review_score,
                {_money('sum(price_cents)')} AS total_revenue
            FROM m_items JOIN m_orders USING (order_id) JOIN m_reviews USING (order_id)
            GROUP BY seller_id HAVING count(*) >= 500 AND sum(review_score) < 4 * count(*)""",
        "above_average_spenders": f"""
            SELECT customer_unique_id, orders AS order_count, {_money('cents')} AS lifetime_spend
            FROM totals, (SELECT sum(cents) AS total, count(*) AS n FROM totals)
            WHERE cents * n > total ORDER BY cents DESC, customer_unique_id LIMIT 20""",
        "order_value_tiers": _order_value_tiers(),
        "seller_performance": _seller_performance(),
        "cohort_retention": """
            SELECT make_date(cohort // 12, cohort % 12 + 1, 1) AS cohort_month, cohort_size,
                CAST(months_since AS INTEGER) AS months_since, active AS active_customers,
                retention_rate FROM cohorts""",
        "customer_ltv": f"""
            SELECT customer_unique_id, order_id, order_purchase_timestamp,
                {_money('cents')} AS order_revenue,
                {_money('sum(cents) OVER person')} AS cumulative_revenue,
                count(*) OVER person AS order_sequence
            FROM paid WINDOW person AS (PARTITION BY customer_unique_id
                ORDER BY order_purchase_timestamp, order_id ROWS UNBOUNDED PRECEDING)""",
        "rfm_segments": f"SELECT customer_unique_id, {_RFM_COLUMNS} FROM segments",
        "churn_risk": f"SELECT {_CHURN_COLUMNS} FROM churn",
        "delivery_performance": "SELECT * FROM by_delivery",
        "rfm_segment_counts": f"""
            SELECT segment, count(*) AS count, {_MEAN_SPEND} AS avg_monetary
            FROM segments GROUP BY segment""",
        "rfm_totals": f"SELECT count(*) AS total, {_MEAN_SPEND} AS avg_monetary FROM totals",
        "rfm_headline": f"""
            SELECT count(*) AS total_customers,
                count(*) FILTER (WHERE segment = 'Champions') AS champions,
                count(*) FILTER (WHERE segment = 'At Risk' OR segment = 'Hibernating'
                    OR segment = 'About to Sleep') AS at_risk,
                {_MEAN_SPEND} AS avg_monetary FROM segments""",
        "rfm_sample": f"""
            SELECT {_RFM_COLUMNS} FROM segments
            ORDER BY md5('42:' || customer_unique_id), customer_unique_id LIMIT 5000""",
        "ltv_histogram": _ltv_histogram(),
        "ltv_stats": _ltv_stats(),
        "ltv_top_customers": f"""
            SELECT customer_unique_id, orders AS order_sequence,
                {_money('cents')} AS cumulative_revenue
            FROM totals ORDER BY cents DESC, customer_unique_id LIMIT 20""",
        "cohort_matrix": _matrix(),
        "cohort_headline": f"""
            SELECT count(*) FILTER (WHERE months_since = 0) AS total_cohorts,
                {_round('sum(cohort_size) FILTER (WHERE months_since = 0)',
                        'count(*) FILTER (WHERE months_since = 0)', 0)} AS avg_cohort_size,
                coalesce({_round('sum(retention_rate * 100) FILTER (WHERE months_since = 1)',
                                 'count(*) FILTER (WHERE months_since = 1)', 1, scale=2)}, 0)
                    AS avg_m1_retention,
                CAST(max(months_since) AS INTEGER) AS max_months
            FROM cohorts WHERE cohort_size >= 50""",
        "churn_headline": f"""
            SELECT {everybody} AS repeat_customers, {active} AS active,
                {_round(f'100 * {active}', everybody, 0)} AS active_pct, {churned} AS churned,
                {_round(f'100 * {churned}', everybody, 0)} AS churned_pct,
                {_round('sum(avg_days_between * 10)', everybody, 0, scale=1)} AS avg_cadence_days
            FROM churn""",
        "churn_histogram": """
            SELECT CAST((days_since_last - lo) * 50 // (hi + 1 - lo) + 1 AS INTEGER) AS bucket,
                is_churned, count(*) AS customers
            FROM churn, (SELECT min(days_since_last) AS lo, max(days_since_last) AS hi FROM churn)
            GROUP BY ALL""",
        "churn_customers": f"""
            SELECT {_CHURN_COLUMNS} FROM churn
            ORDER BY days_since_last DESC, customer_unique_id LIMIT 200""",
        "delivery_headline": f"""
            SELECT CAST(sum(order_count) AS BIGINT) AS delivered_orders,
                coalesce(max(pct_of_total) FILTER (WHERE delivery_bucket = 'Early'), 0)
                    AS early_pct,
                coalesce(max(avg_review_score)
                    FILTER (WHERE delivery_bucket = 'Late (>7 days)'), 0)
                    AS very_late_avg_review,
                max(avg_delta_days) FILTER (WHERE delivery_bucket = 'Early')
                    AS early_avg_delta_days
            FROM by_delivery""",
        "row_count_validation": _row_counts(),
        "key_uniqueness": _duplicates(),
        "referential_integrity": _orphans(),
        "null_checks": _columns(
            {n: dict.fromkeys(columns, "{c} IS NULL") for n, columns in _NOT_NULL.items()},
            "n_null",
        ),
        "sparse_months": """
            SELECT make_date(year(bought), month(bought), 1) AS order_month, count(*) AS order_count
            FROM (SELECT order_purchase_timestamp AS bought FROM m_orders) GROUP BY 1
            HAVING count(*) < 185""",
        "length_checks": _columns(
            {name: {column: f"length(CAST({{c}} AS VARCHAR)) > {length}"
                    for column, length in columns.items()}
             for name, columns in _LENGTHS.items()},
            "n_long",
        ),
    }
    bodies["load_csv"] = bodies["load_parquet"] = bodies["state_revenue_summary"]
    bodies["load_bucketed"] = bodies["order_value_tiers"]
    bodies["load_checks"] = f"""
        SELECT 'rows' AS check_name, table_name, '' AS column_name, row_count AS n
        FROM ({bodies["row_count_validation"]})
        UNION ALL SELECT 'nulls', table_name, column_name, n_null FROM ({bodies["null_checks"]})
        UNION ALL SELECT 'long', table_name, column_name, n_long FROM ({bodies["length_checks"]})"""
    bodies["integrity"] = f"""
        SELECT 'keys' AS check_name, table_name || '.' || key_columns AS name, n_dup_keys AS n
        FROM ({_duplicates()})
        UNION ALL SELECT 'references', fk, n_orphans FROM ({_orphans()})"""
    bodies["read_views"] = """
        SELECT 'v_cohort_retention' AS view_name, '' AS item, count(*) AS n_rows,
            CAST(sum(active) AS BIGINT) AS total FROM cohorts
        UNION ALL
        SELECT 'v_clv', '', count(*), CAST(sum(running) AS BIGINT) FROM (
            SELECT sum(cents) OVER (PARTITION BY customer_unique_id
                ORDER BY order_purchase_timestamp, order_id ROWS UNBOUNDED PRECEDING) AS running
            FROM paid)
        UNION ALL
        SELECT 'v_rfm_segments', segment, count(*), CAST(sum(cents) AS BIGINT)
        FROM segments GROUP BY segment
        UNION ALL
        SELECT 'v_churn_risk', CAST(is_churned AS VARCHAR), count(*),
            CAST(sum(days_since_last) AS BIGINT)
        FROM churn GROUP BY is_churned
        UNION ALL
        SELECT 'v_delivery_performance', delivery_bucket, order_count,
            CAST(avg_review_score * 100 AS BIGINT)
        FROM by_delivery"""
    return {key: _query(body) for key, body in bodies.items()}
