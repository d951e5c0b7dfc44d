"""Checking SQL for the cleaning jobs, written from what each dirty row must become."""

from __future__ import annotations

from marketloom.plans.sqlparts import CTES, big, money


def title(text: str) -> str:
    """Upper case after every non-letter."""
    return (
        f"array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN regexp_extract_all({text}, "
        "'[A-Za-z]+|[^A-Za-z]+')], '')"
    )


COUNTRY = f"CASE k % 5 WHEN 0 THEN 'USA' WHEN 1 THEN 'UK' WHEN 2 THEN 'UAE' ELSE {title('country')} END"
CITY = (
    "CASE WHEN k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0 THEN NULL WHEN k % 3 = 1 THEN 'O''Neil-Town' "
    f"ELSE {title('city')} END"
)
PAYMENT = f"CASE k % 5 WHEN 0 THEN 'Upi' WHEN 1 THEN 'Cod' WHEN 2 THEN NULL ELSE {title('payment_method')} END"
CATEGORY = "CASE WHEN k % 20 = 0 THEN NULL WHEN k % 21 = 0 THEN '' ELSE " + title("category") + " END"
DISCOUNT = "CAST(coalesce(discount, 0) AS DOUBLE) / 100"

CTES.update({
    "ok_customers": "SELECT * FROM m_customers WHERE k % 31 <> 0 AND k % 41 <> 0",
    "ok_orders": """SELECT o.* FROM m_orders o WHERE k % 71 <> 0 AND k % 73 <> 0 AND k % 79 <> 0
        AND customer_id IN (SELECT customer_id FROM ok_customers)""",
    "ok_items": """SELECT * FROM m_items WHERE pk % 61 <> 0 AND sk % 40 NOT IN (7, 8)
        AND order_id IN (SELECT order_id FROM ok_orders)""",
    "ok_events": """SELECT * FROM m_events WHERE k % 59 <> 0 AND k % 43 <> 0 AND k % 47 <> 0
        AND customer_id IN (SELECT customer_id FROM ok_customers)""",
    "ok_marketing": """SELECT day, channel, campaign, CASE WHEN impressions % 37 = 0 THEN 0 ELSE spend END AS spend,
            impressions, clicks, conversions
        FROM m_marketing WHERE impressions % 41 <> 0 AND impressions % 43 <> 0 AND impressions % 47 <> 0""",
    "ok_payments": """SELECT * FROM m_payments WHERE CAST(substr(payment_id, 2) AS BIGINT) % 61 <> 0
        AND CAST(substr(payment_id, 2) AS BIGINT) % 67 <> 0 AND order_id IN (SELECT order_id FROM ok_orders)""",
    "ok_returns": """SELECT * FROM m_returns WHERE refund % 61 <> 0
        AND order_id IN (SELECT order_id FROM ok_orders)""",
    "ok_experiments": """SELECT * FROM m_experiments WHERE CAST(substr(customer_id, 2) AS BIGINT) % 61 <> 0
        AND CAST(substr(customer_id, 2) AS BIGINT) % 67 <> 0""",
    "typed_products": f"""SELECT *, {CATEGORY} AS kind, coalesce(price <= 0 AND k % 89 <> 0, FALSE) AS bad_price
        FROM m_products""",
    # Medians in half cents, rounded half up to cents.
    "cost_medians": """SELECT kind, (CAST(quantile_cont(CAST(cost AS DOUBLE), 0.5) * 2 AS BIGINT) + 1) // 2 AS cost
        FROM typed_products WHERE cost IS NOT NULL AND kind IS NOT NULL GROUP BY kind""",
    "cost_median": """SELECT (CAST(quantile_cont(CAST(cost AS DOUBLE), 0.5) * 2 AS BIGINT) + 1) // 2 AS cost
        FROM typed_products WHERE cost IS NOT NULL""",
    "costed": """SELECT p.*, coalesce(p.cost, c.cost, (SELECT cost FROM cost_median)) AS full_cost
        FROM typed_products p LEFT JOIN cost_medians c ON c.kind = p.kind""",
})

PIPELINES: dict[str, str] = {
    "CT1": f"""SELECT customer_id, customer_name, signup_date, {COUNTRY} AS country, coalesce({CITY}, 'Unknown') AS city,
        CASE WHEN k % 23 = 0 THEN 'Unknown' ELSE device END AS device, channel AS acquisition_channel,
        CASE WHEN k % 29 = 0 THEN 'Unclassified' ELSE segment END AS customer_segment FROM ok_customers""",
    "CT2": f"""SELECT product_id, product_name, kind AS category, subcategory,
        CASE WHEN k % 33 <> 0 THEN brand END AS brand, {money('full_cost')} AS cost,
        CASE WHEN k % 89 <> 0 THEN {money('price')} END AS selling_price, estimated AS cost_is_estimated,
        bad_price AS price_is_invalid FROM costed""",
    "CT3": f"""SELECT order_id, customer_id, stamp AS order_date, status AS order_status, {PAYMENT} AS payment_method,
        {DISCOUNT} AS discount, CASE WHEN k % 17 = 0 THEN 0.0::DOUBLE ELSE CAST(shipping AS DOUBLE) END AS shipping_cost
        FROM ok_orders""",
    "CT4": f"""SELECT item_id AS order_item_id, order_id, product_id, {big('qty')} AS quantity,
        {money('unit')} AS unit_price, {money('line')} AS line_total FROM ok_items""",
    "CT5": """SELECT event_id, customer_id, ts AS event_timestamp, name AS event_name, session_id, product_id
        FROM ok_events""",
    "CT6": f"""SELECT day AS date, channel, campaign, {money('spend')} AS spend, {big('impressions')} AS impressions,
        {big('clicks')} AS clicks, {big('conversions')} AS conversions FROM ok_marketing""",
    "CT7": f"""SELECT payment_id, order_id, {money('amount')} AS amount, 'Success' AS payment_status,
        stamp AS payment_date FROM ok_payments""",
    "CT8": f"""SELECT return_id, order_id, customer_id, product_id, day AS return_date,
        CASE WHEN refund % 7 = 0 THEN 'Not Specified' ELSE reason END AS return_reason, {money('refund')}
        AS refund_amount FROM ok_returns""",
    "CT9": f"""SELECT experiment_id, customer_id, variant, day AS experiment_date, {big('converted')} AS converted,
        CAST(revenue AS DOUBLE) AS revenue FROM ok_experiments""",
}

_RAW_ROWS = {
    "customers": "count(*) + count(*) FILTER (k % 50 = 0) + count(*) FILTER (k % 53 = 0) AS n FROM m_customers",
    "products": "count(*) + count(*) FILTER (k % 50 = 0) AS n FROM m_products",
    "orders": "count(*) + count(*) FILTER (k % 50 = 0) AS n FROM m_orders",
    "order_items": "count(*) + count(*) FILTER ((pk + sk) % 50 = 0) AS n FROM m_items",
    "payments": "count(*) + count(*) FILTER (CAST(substr(payment_id, 2) AS BIGINT) % 50 = 0) AS n FROM m_payments",
    "returns": "count(*) + count(*) FILTER (refund % 50 = 0) AS n FROM m_returns",
    "marketing_campaigns": "count(*) + count(*) FILTER (impressions % 50 = 0) AS n FROM m_marketing",
    "web_events": "count(*) + count(*) FILTER (k % 50 = 0) AS n FROM m_events",
    "experiments": "count(*) + count(*) FILTER (CAST(substr(customer_id, 2) AS BIGINT) % 50 = 0) AS n "
                   "FROM m_experiments",
}
_CLEAN_ROWS = {
    "customers": "ok_customers", "products": "m_products", "orders": "ok_orders", "order_items": "ok_items",
    "payments": "ok_payments", "returns": "ok_returns", "marketing_campaigns": "ok_marketing",
    "web_events": "ok_events", "experiments": "ok_experiments",
}
_MAPPED = {
    "customers": "m_customers", "products": "m_products", "orders": "m_orders", "order_items": "m_items",
    "payments": "m_payments", "returns": "m_returns", "marketing_campaigns": "m_marketing",
    "web_events": "m_events", "experiments": "m_experiments",
}
_DAYS = {
    "customers": "signup_date", "orders": "CAST(stamp AS DATE)", "payments": "CAST(stamp AS DATE)", "returns": "day",
    "marketing_campaigns": "day", "web_events": "CAST(ts AS DATE)", "experiments": "day",
}


def _union(lines: list[str]) -> str:
    return " UNION ALL ".join(lines)


RULES: dict[str, str] = {
    "C1": """SELECT channel, count(*) AS rows_left FROM m_marketing GROUP BY channel""",
    "C2": """SELECT order_id, CASE WHEN k % 79 = 0 THEN 'Unknown' ELSE status END AS order_status FROM m_orders""",
    "C3": """SELECT customer_id, CASE WHEN k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0 THEN NULL
        WHEN k % 3 = 1 THEN 'o''neil-town' ELSE lower(city) END AS city,
        CASE WHEN k % 23 <> 0 THEN device END AS device FROM m_customers""",
    "C4": f"""SELECT customer_id, CASE k % 5 WHEN 0 THEN 'Usa' WHEN 1 THEN 'Uk' WHEN 2 THEN 'Uae' ELSE {title('country')}
        END AS country, {CITY} AS city FROM m_customers""",
    "C5": f"SELECT customer_id, {COUNTRY} AS country FROM m_customers",
    "C6": f"""SELECT customer_id, coalesce({CITY}, 'Unknown') AS city,
        CASE WHEN k % 23 = 0 THEN 'Unknown' ELSE device END AS device,
        CASE WHEN k % 29 = 0 THEN 'Unclassified' ELSE segment END AS customer_segment FROM m_customers""",
    "C7": f"""SELECT order_id, {DISCOUNT} AS discount,
        CASE WHEN k % 17 = 0 THEN 0.0::DOUBLE ELSE CAST(shipping AS DOUBLE) END AS shipping_cost FROM m_orders""",
    "C8": "SELECT customer_id, signup_date FROM ok_customers",
    "C9": """SELECT order_id, customer_id FROM m_orders WHERE k % 71 <> 0
        AND customer_id IN (SELECT customer_id FROM ok_customers)""",
    "C10": "SELECT order_id, status AS order_status FROM m_orders WHERE k % 79 <> 0",
    "C11": "SELECT product_id, estimated AS cost_is_estimated FROM m_products",
    "C12": f"SELECT product_id, {money('full_cost')} AS cost FROM costed",
    "C13": "SELECT product_id, bad_price AS price_is_invalid FROM typed_products",
    "C14": f"SELECT item_id AS order_item_id, {big('qty')} AS quantity FROM m_items WHERE sk % 40 NOT IN (7, 8)",
    "C15": f"""SELECT item_id AS order_item_id, CASE WHEN sk % 40 = 7 THEN 0.0::DOUBLE
        WHEN sk % 40 = 8 THEN {money('-unit')} ELSE {money('line')} END AS line_total FROM m_items""",
    "C16": f"""SELECT day AS date, channel, {big('clicks')} AS clicks FROM m_marketing
        WHERE impressions % 41 <> 0 AND impressions % 43 <> 0 AND impressions % 47 <> 0""",
    "C17": f"""SELECT payment_id, {money('amount')} AS amount FROM m_payments
        WHERE CAST(substr(payment_id, 2) AS BIGINT) % 67 <> 0""",
    "C18": _union([
        f"SELECT '{t}' AS table_name, (SELECT {_RAW_ROWS[t]}) AS raw_rows, (SELECT count(*) FROM {_CLEAN_ROWS[t]}) "
        "AS clean_rows" for t in _RAW_ROWS
    ]),
}

# Per table the rules that leave rows out, in order: number, reason, and what is true of the rows that stay besides.
_STEPS = {
    "customers": [("C2", "repeated customer_id", "TRUE"), ("C8", "signup_date is no date", "k % 31 <> 0 AND k % 41 <> 0")],
    "products": [("C2", "repeated product_id", "TRUE")],
    "orders": [
        ("C2", "repeated order_id", "TRUE"), ("C8", "order_date is no date", "k % 73 <> 0"),
        ("C9", "customer_id is unknown", "k % 71 <> 0 AND customer_id IN (SELECT customer_id FROM ok_customers)"),
        ("C10", "order_status is not listed", "k % 79 <> 0"),
    ],
    "order_items": [
        ("C2", "repeated order_item_id", "TRUE"), ("C9", "order_id is unknown", "order_id IN (SELECT order_id FROM ok_orders)"),
        ("C9", "product_id is unknown", "pk % 61 <> 0"), ("C14", "quantity is not positive", "sk % 40 NOT IN (7, 8)"),
    ],
    "web_events": [
        ("C2", "repeated event_id", "TRUE"), ("C8", "event_timestamp is no date", "k % 43 <> 0"),
        ("C9", "customer_id is unknown", "k % 59 <> 0 AND customer_id IN (SELECT customer_id FROM ok_customers)"),
        ("C10", "event_name is not listed", "k % 47 <> 0"),
    ],
    "marketing_campaigns": [
        ("C1", "repeated row", "TRUE"), ("C8", "date is no date", "impressions % 41 <> 0"),
        ("C16", "more clicks than impressions or conversions than clicks", "impressions % 43 <> 0 AND impressions % 47 <> 0"),
    ],
    "payments": [
        ("C2", "repeated payment_id", "TRUE"), ("C9", "order_id is unknown", "order_id IN (SELECT order_id FROM ok_orders)"),
        ("C8", "payment_date is no date", "CAST(substr(payment_id, 2) AS BIGINT) % 61 <> 0"),
        ("C17", "amount is negative", "CAST(substr(payment_id, 2) AS BIGINT) % 67 <> 0"),
    ],
    "returns": [
        ("C2", "repeated return_id", "TRUE"), ("C9", "order_id is unknown", "order_id IN (SELECT order_id FROM ok_orders)"),
        ("C8", "return_date is no date", "refund % 61 <> 0"),
    ],
    "experiments": [
        ("C1", "repeated row", "TRUE"), ("C8", "experiment_date is no date", "CAST(substr(customer_id, 2) AS BIGINT) % 61 <> 0"),
        ("C10", "variant is not listed", "CAST(substr(customer_id, 2) AS BIGINT) % 67 <> 0"),
    ],
}


def _rule_rows(table: str) -> str:
    lines, before, stay = [], f"(SELECT {_RAW_ROWS[table]})", []
    for step, (rule, reason, condition) in enumerate(_STEPS[table], 1):
        stay.append(f"({condition})")
        after = f"(SELECT count(*) FROM {_MAPPED[table]} WHERE {' AND '.join(stay)})"
        lines.append(
            f"SELECT '{table}' AS table_name, CAST({step} AS BIGINT) AS step, '{rule}' AS rule, '{reason}' AS reason, {before} AS rows_in, {after} AS rows_out"
        )
        before = after
    return _union(lines)


RULES["C18_rules"] = _union([_rule_rows(t) for t in _STEPS])

SOURCES: dict[str, str] = {
    "S1": _union([f"SELECT '{t}' AS table_name, (SELECT {sql}) AS total_rows" for t, sql in _RAW_ROWS.items()]),
    "S2": _union([
        f"SELECT '{t}' AS table_name, count(*) AS total_rows, min({d}) AS first_day, max({d}) AS last_day "
        f"FROM {_MAPPED[t]}" for t, d in _DAYS.items()
    ]),
    "S3": _union([f"SELECT '{t}' AS table_name, count(*) AS total_rows FROM {c}" for t, c in _MAPPED.items()]),
}
SOURCES["S4"] = SOURCES["S3"]
SOURCES["S1_quarantine"] = _union([
    "SELECT 'customers' AS table_name, 'surplus fields' AS reason, customer_id || ',a,b,c,d,e,f,g,h' AS text FROM m_customers WHERE k % 97 = 0",
    "SELECT 'customers', 'missing fields', customer_id || ',a' FROM m_customers WHERE k % 89 = 0 AND k % 97 <> 0",
    *[f"SELECT '{t}', 'rows kept', CAST((SELECT {sql}) AS VARCHAR)" for t, sql in _RAW_ROWS.items()],
])

# Per table its columns in order: the mapped expression, decimals as unscaled numbers.
_VALUES = {
    "customers": dict(
        customer_id="customer_id", customer_name="customer_name", signup_date="signup_date", country="country", city="city",
        device="device", acquisition_channel="channel", customer_segment="segment"),
    "products": dict(
        product_id="product_id", product_name="product_name", category="category", subcategory="subcategory", brand="brand",
        cost="cost", selling_price="price", cost_is_estimated="estimated", price_is_invalid="invalid"),
    "orders": dict(
        order_id="order_id", customer_id="customer_id", order_date="stamp", order_status="status",
        payment_method="payment_method", discount="discount * 100", shipping_cost="shipping * 100"),
    "order_items": dict(
        order_item_id="item_id", order_id="order_id", product_id="product_id", quantity="qty", unit_price="unit",
        line_total="line"),
    "payments": dict(
        payment_id="payment_id", order_id="order_id", amount="amount", payment_status="'Success'", payment_date="stamp"),
    "returns": dict(
        return_id="return_id", order_id="order_id", customer_id="customer_id", product_id="product_id", return_date="day",
        return_reason="reason", refund_amount="refund"),
    "marketing_campaigns": dict(
        date="day", channel="channel", campaign="campaign", spend="spend", impressions="impressions", clicks="clicks",
        conversions="conversions"),
    "web_events": dict(
        event_id="event_id", customer_id="customer_id", event_timestamp="ts", event_name="name", session_id="session_id",
        product_id="product_id"),
    "experiments": dict(
        experiment_id="experiment_id", customer_id="customer_id", variant="variant", experiment_date="day",
        converted="converted", revenue="revenue * 100"),
}
_STAMPS = ("order_date", "payment_date", "event_timestamp")


def _column_digests(table: str) -> str:
    texts = {
        c: f"strftime(CAST({x} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')" if c in _STAMPS else f"CAST({x} AS VARCHAR)"
        for c, x in _VALUES[table].items()
    }
    texts["*"] = "concat_ws('|', " + ", ".join(f"coalesce({t}, '<null>')" for t in texts.values()) + ")"
    return _union([
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count({t}) AS values_there, "
        f"CAST(coalesce(sum(CAST('0x' || substr(md5({t}), 1, 7) AS BIGINT)), 0) AS BIGINT) AS digest FROM {_MAPPED[table]}"
        for c, t in texts.items()
    ])


SOURCES["S2_columns"] = _union([_column_digests(t) for t in _VALUES])
SOURCES["S3_columns"] = SOURCES["S2_columns"]
