"""Checking SQL for exploration, anomalies, forecast, churn model, report and boards."""

from __future__ import annotations

from marketloom.operators.evidence import ROUTES, SECTIONS
from marketloom.plans.sql_views import EDGES, VIEWS
from marketloom.plans.sqlparts import CTES, RECURSIVE, big, money, net, net2, ratio

def _filled(source: str, day: str, value: str) -> str:
    return f"""SELECT CAST(d AS DATE) AS day, coalesce(v, 0) AS v
        FROM (SELECT unnest(generate_series(min({day})::TIMESTAMP, max({day})::TIMESTAMP, INTERVAL 1 DAY)) AS d
              FROM {source})
        LEFT JOIN (SELECT {day} AS sold_day, {value} AS v FROM {source} GROUP BY 1) ON sold_day = CAST(d AS DATE)"""


def _z(series: str, unit: int) -> str:
    return f"""SELECT day, v, CASE WHEN c >= 15 AND sd > 0 THEN (x - mu) / sd END AS z
        FROM (SELECT day, v, CAST(v AS DOUBLE) / {unit} AS x, count(*) OVER w AS c,
                     avg(CAST(v AS DOUBLE) / {unit}) OVER w AS mu, stddev_samp(CAST(v AS DOUBLE) / {unit}) OVER w AS sd
              FROM {series} WINDOW w AS (ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))"""


# Least squares in SQL: normal equations over 19 columns (day index in thousands), Gauss-Jordan elimination.
def _normal(rows: str) -> str:
    return f"""SELECT 0 AS s, list(r ORDER BY j) AS m FROM (SELECT j, list(v ORDER BY k) AS r FROM (
            SELECT j, k, sum(x[j] * (CASE WHEN k = 20 THEN y ELSE x[k] END)) AS v
            FROM {rows}, range(1, 20) a(j), range(1, 21) b(k) GROUP BY j, k) GROUP BY j)"""


def _eliminate(name: str, start: str) -> str:
    return f"""SELECT s, m FROM {start} UNION ALL SELECT s + 1, [CASE WHEN i = s + 1 THEN [v / m[i][i] FOR v IN m[i]]
            ELSE [m[i][j] - m[i][s + 1] * m[s + 1][j] / m[s + 1][s + 1] FOR j IN range(1, 21)] END
            FOR i IN range(1, 20)] FROM {name} WHERE s < 19"""


_X = """[1.0, i / 1000.0] || [CAST(isodow(day) = d + 1 AS INT)::DOUBLE FOR d IN range(1, 7)]
    || [CAST(month(day) = q AS INT)::DOUBLE FOR q IN range(2, 13)]"""
_DOT = "list_sum([x[j] * c[j] FOR j IN range(1, 20)])"

RECURSIVE.update({"fit_part", "fit_all"})
CTES.update({
    "rev_day": _filled("sold", "day", "sum(net4)"),
    "vol_day": _filled("paid", "day", "count(*)"),
    "ads_day": _filled("m_marketing", "day", "sum(spend)"),
    "ref_day": _filled("m_returns", "day", "sum(refund)"),
    "rev_z": _z("rev_day", 10000),
    "vol_z": _z("vol_day", 1),
    "ads_z": _z("ads_day", 100),
    "ref_z": _z("ref_day", 100),
    "low_day": "SELECT * FROM rev_z WHERE abs(z) > 2.5 ORDER BY z, day LIMIT 1",
    "trend_day": f"""SELECT day, i, y, {_X} AS x, max(i) OVER () + 1 - 60 AS split
        FROM (SELECT day, CAST(row_number() OVER (ORDER BY day) - 1 AS BIGINT) AS i, CAST(v AS DOUBLE) / 10000 AS y
              FROM rev_day)""",
    "old_day": "SELECT * FROM trend_day WHERE i < split",
    "eq_part": _normal("old_day"),
    "eq_all": _normal("trend_day"),
    "fit_part": _eliminate("fit_part", "eq_part"),
    "fit_all": _eliminate("fit_all", "eq_all"),
    "held_out": f"""SELECT day, y, {_DOT} AS p FROM trend_day,
        (SELECT [m[i][20] FOR i IN range(1, 20)] AS c FROM fit_part WHERE s = 19) WHERE i >= split""",
    "sigma": "SELECT stddev_pop(y - p) AS sd FROM held_out",
    "ahead": f"""SELECT day, n, greatest({_DOT}, 0) AS p FROM (SELECT *, {_X} AS x FROM (
            SELECT CAST(last_day + CAST(n AS INTEGER) AS DATE) AS day, n, last_i + n AS i
            FROM (SELECT max(day) AS last_day, max(i) AS last_i FROM trend_day), range(1, 91) t(n))),
        (SELECT [m[i][20] FOR i IN range(1, 20)] AS c FROM fit_all WHERE s = 19)""",
    "session_use": """SELECT customer_id, session_id, bool_or(name = 'add_to_cart') AS cart,
        bool_or(name = 'purchase') AS bought FROM m_events WHERE session_id <> 'UNKNOWN_SESSION' GROUP BY 1, 2""",
    "visits": """SELECT customer_id, count(*) AS sessions, count(*) FILTER (cart AND NOT bought) AS left_carts
        FROM session_use GROUP BY 1""",
    "sent_back": "SELECT customer_id, count(*) AS returns FROM m_returns GROUP BY 1",
    "habit": """SELECT customer_id, count(*) AS orders,
        CAST(count(*) FILTER (coalesce(discount, 0) > 0) AS DOUBLE) / count(*) AS usage FROM paid GROUP BY 1""",
    "feat": """SELECT r.customer_id, r.recency AS days, h.orders AS freq, r.net4,
        CAST(r.net4 AS DOUBLE) / 10000 / r.orders AS aov, coalesce(sessions, 0) AS sessions,
        coalesce(left_carts, 0) AS left_carts, coalesce(returns, 0) AS returns, usage,
        CAST(r.recency > 90 AS BIGINT) AS churned
        FROM rfm24 r JOIN habit h USING (customer_id) LEFT JOIN visits USING (customer_id)
        LEFT JOIN sent_back USING (customer_id)""",
    "feat_split": """SELECT *, row_number() OVER (PARTITION BY churned ORDER BY md5(customer_id || ':42'), customer_id)
        <= floor(count(*) OVER (PARTITION BY churned) * 0.25 + 0.5) AS is_test FROM feat""",
    "ruled": """SELECT customer_id, churned, net4,
        least(1.0::DOUBLE, round(0.15::DOUBLE * returns, 4)) AS p FROM feat""",
    "cells": """SELECT count(*) FILTER (churned = 0 AND p <= 0.5)::DOUBLE AS a, count(*) FILTER (churned = 0 AND p > 0.5)
        ::DOUBLE AS b, count(*) FILTER (churned = 1 AND p <= 0.5)::DOUBLE AS c, count(*) FILTER (churned = 1 AND p > 0.5)
        ::DOUBLE AS d FROM ruled""",
    "curve": """SELECT p, pos, neg, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp,
        sum(pos) OVER () AS np, sum(neg) OVER () AS nn
        FROM (SELECT p, sum(churned) AS pos, sum(1 - churned) AS neg FROM ruled GROUP BY p)""",
    "banded": """SELECT *, CASE WHEN p > 0.6 THEN 'High Risk' WHEN p > 0.3 THEN 'Medium Risk' WHEN p > 0 THEN 'Low Risk' END
        AS band FROM ruled""",
    "urgent": """SELECT * FROM banded WHERE band = 'High Risk'
        AND CAST(net4 AS DOUBLE) > (SELECT quantile_cont(CAST(net4 AS DOUBLE), 0.5) FROM banded)""",
    "named_sales": f"{EDGES['R5']}",
    "performance": f"{VIEWS['H1']}",
    "month_total": VIEWS["A2"],
    "months": """SELECT t.order_month AS month, m.net4, total_orders AS orders, spend, people,
        CASE WHEN people > 0 THEN CAST((2 * spend + people) // (2 * people) AS BIGINT) END AS cac
        FROM month_total t JOIN month_net m ON m.month = t.order_month
        LEFT JOIN (SELECT CAST(date_trunc('month', day) AS DATE) AS sm, sum(spend) AS spend FROM m_marketing GROUP BY 1)
          ON sm = t.order_month
        LEFT JOIN (SELECT CAST(date_trunc('month', signup_date) AS DATE) AS pm, count(*) AS people FROM m_customers
                   GROUP BY 1) ON pm = t.order_month""",
    "month_steps": f"""SELECT month AS order_month, {net('net4')} AS net_revenue,
        {ratio('100 * (net4 - net4_0)', 'net4_0')} AS revenue_change_pct, orders AS total_orders,
        {ratio('100 * (orders - orders_0)', 'orders_0')} AS orders_change_pct, CAST(cac AS DOUBLE) / 100 AS cac,
        {ratio('100 * (cac - cac_0)', 'cac_0')} AS cac_change_pct
        FROM (SELECT *, lag(net4) OVER w AS net4_0, lag(orders) OVER w AS orders_0, lag(cac) OVER w AS cac_0
              FROM months WINDOW w AS (ORDER BY month))""",
    "headline": f"""SELECT {net2('sum(net4)')} AS total_revenue, (SELECT count(*) FROM paid) AS total_orders,
        {ratio('sum(net4)', '10000 * count(*)')} AS aov, (SELECT count(*) FROM m_customers) AS total_customers,
        (SELECT {money('sum(spend)')} FROM m_marketing) AS total_spend,
        (SELECT {money('sum(refund)')} FROM m_returns) AS total_refunds,
        (SELECT {ratio('sum(spend)', '100 * (SELECT count(*) FROM m_customers)')} FROM m_marketing) AS overall_cac
        FROM basket""",
})

ANALYSIS: dict[str, str] = {
    "EX1": f"""SELECT item_id AS order_item_id, order_id, customer_id, product_id, day AS order_day,
        {big('qty')} AS quantity, {money('line')} AS line_total, {net('net4')} AS net_value FROM sold""",
    "EX2": f"SELECT month AS order_month, {net('net4')} AS net_revenue FROM month_net",
    "EX3": f"""SELECT status AS order_status, count(*) AS orders,
        {ratio('100 * count(*)', '(SELECT count(*) FROM m_orders)', 1)} AS pct_of_total FROM m_orders GROUP BY status""",
    "EX4": "SELECT channel AS acquisition_channel, people AS customers FROM signups_by_channel",
    "EX5": f"""SELECT {ratio('sum(net4)', '10000 * count(*)')} AS mean_order_value,
        {ratio('CAST(quantile_cont(CAST(net4 AS DOUBLE), 0.5) * 2 AS BIGINT)', '20000')} AS median_order_value FROM basket""",
    "EX6": """SELECT b AS bin, round(lo + (hi - lo) / 50 * b, 2) AS bin_start,
        round(lo + (hi - lo) / 50 * (b + 1), 2) AS bin_end, coalesce(n, 0) AS orders
        FROM range(0, 50) t(b), (SELECT min(v) AS lo, max(v) AS hi FROM small_orders)
        LEFT JOIN (SELECT CAST(least(floor((v - l) * 50 / (h - l)), 49) AS BIGINT) AS place, count(*) AS n
                   FROM small_orders, (SELECT min(v) AS l, max(v) AS h FROM small_orders) GROUP BY 1) ON place = b""",
    "EX7": f"""SELECT category, {net('net4')} AS revenue, {ratio('100 * net4', 'total')} AS share_pct
        FROM (SELECT category, sum(net4) AS net4, sum(sum(net4)) OVER () AS total
              FROM sold JOIN m_products USING (product_id) WHERE category IS NOT NULL GROUP BY category)""",
    "EX8": "SELECT device, count(*) AS orders FROM paid JOIN m_customers USING (customer_id) GROUP BY device",
    "EX9": f"""SELECT (SELECT count(*) FROM m_customers) AS customers, (SELECT count(*) FROM paid) AS completed_orders,
        {net2('sum(net4)')} AS net_revenue, {ratio('sum(net4)', '10000 * count(*)')} AS aov,
        {ratio('CAST(quantile_cont(CAST(net4 AS DOUBLE), 0.5) * 2 AS BIGINT)', '20000')} AS median_order_value,
        (SELECT min(day) FROM m_orders) AS first_day, (SELECT max(day) FROM m_orders) AS last_day FROM basket""",
    "N1": f"""SELECT day AS order_day, {net('v')} AS revenue, round(z, 4) AS z_score,
        coalesce(abs(z) > 2.5, FALSE) AS is_anomaly FROM rev_z""",
    "N2": f"SELECT day AS order_day, {net('v')} AS revenue, round(z, 4) AS z_score FROM rev_z WHERE abs(z) > 2.5",
    "N3": f"SELECT day AS order_day, {big('v')} AS order_count, round(z, 4) AS z_score FROM vol_z WHERE abs(z) > 2.5",
    "N4": f"SELECT day AS date, {money('v')} AS spend, round(z, 4) AS z_score FROM ads_z WHERE abs(z) > 2.5",
    "N5": f"""SELECT day AS return_date, {money('v')} AS refund_amount, round(z, 4) AS z_score FROM ref_z
        WHERE abs(z) > 2.5""",
    "N6": f"""SELECT l.day AS order_day, {net('l.v')} AS revenue, round(l.z, 4) AS z_score, round(o.z, 4) AS orders_z_score,
        CASE WHEN o.day IS NULL THEN NULL WHEN o.z < -2.5 THEN 'traffic or conversion'
             ELSE 'order value, discounts or product mix' END AS hint
        FROM low_day l LEFT JOIN vol_z o ON o.day = l.day""",
    "N7": " UNION ALL ".join(
        f"SELECT '{name}' AS metric, count(*) FILTER (abs(z) > 2.5) AS anomaly_days FROM {cte}"
        for name, cte in (("revenue", "rev_z"), ("order_volume", "vol_z"), ("marketing_spend", "ads_z"),
                          ("refunds", "ref_z"))
    ),
    "T1": f"SELECT day AS order_day, {net('v')} AS revenue FROM rev_day",
    "T2": """SELECT day AS order_day, i AS day_index, CAST(isodow(day) - 1 AS BIGINT) AS day_of_week,
        CAST(month(day) AS BIGINT) AS month FROM trend_day""",
    "T3": "SELECT day AS order_day, " + ", ".join(
        [f"CAST(isodow(day) = {d + 1} AS BIGINT) AS dow_{d}" for d in range(1, 7)]
        + [f"CAST(month(day) = {q} AS BIGINT) AS month_{q}" for q in range(2, 13)]
    ) + " FROM trend_day",
    "T4": "SELECT day AS order_day, round(y, 0) AS revenue, round(p, 0) AS prediction FROM held_out",
    "T5": """SELECT round(avg(abs(y - p)), 1) AS mae,
        round(avg(abs(y - p) / y) FILTER (y <> 0) * 100, 4) AS mape_pct FROM held_out""",
    "T6": "SELECT round(sd, 1) AS residual_sigma FROM sigma",
    "T7": "SELECT day AS order_day, round(p, 0) AS forecast_revenue FROM ahead",
    "T8": """SELECT day AS order_day, round(p, 0) AS forecast_revenue, round(greatest(p - 1.96 * sd, 0), 0) AS lower_bound,
        round(p + 1.96 * sd, 0) AS upper_bound FROM ahead, sigma""",
    "T9": """SELECT round(sum(p) FILTER (n <= 30), 0) AS next_30_days, round(sum(p) FILTER (n <= 60), 0) AS next_60_days,
        round(sum(p), 0) AS next_90_days FROM ahead""",
    "K1": "SELECT customer_id FROM buyer",
    "K2": "SELECT customer_id, days AS days_since_last_purchase FROM feat",
    "K3": "SELECT customer_id, freq AS purchase_frequency FROM feat",
    "K4": f"SELECT customer_id, {net('net4')} AS total_spend FROM feat",
    "K5": "SELECT customer_id, aov AS avg_order_value FROM feat",
    "K6": "SELECT customer_id, sessions AS number_of_sessions FROM visits",
    "K7": "SELECT customer_id, left_carts AS cart_abandonment FROM visits",
    "K8": "SELECT customer_id, returns FROM sent_back",
    "K9": "SELECT customer_id, round(usage, 6) AS discount_usage FROM feat",
    "K10": f"""SELECT customer_id, days AS days_since_last_purchase, freq AS purchase_frequency, {net('net4')} AS total_spend,
        aov AS avg_order_value, sessions AS number_of_sessions, left_carts AS cart_abandonment, returns,
        round(usage, 6) AS discount_usage, churned FROM feat""",
    "K11": "SELECT customer_id, churned, is_test FROM feat_split",
    "K12": "SELECT customer_id, is_test, " + ", ".join(
        f"round(({c} - avg({c}) FILTER (NOT is_test) OVER ()) / stddev_pop({c}) FILTER (NOT is_test) OVER (), 6) AS {n}"
        for c, n in (
            ("CAST(freq AS DOUBLE)", "purchase_frequency"), ("CAST(net4 AS DOUBLE) / 10000", "total_spend"),
            ("aov", "avg_order_value"), ("CAST(sessions AS DOUBLE)", "number_of_sessions"),
            ("CAST(left_carts AS DOUBLE)", "cart_abandonment"), ("CAST(returns AS DOUBLE)", "returns"),
            ("usage", "discount_usage"),
        )
    ) + " FROM feat_split",
    "K15": """SELECT class, round(pr, 6) AS precision, round(re, 6) AS recall, round(f, 6) AS f1_score,
        CAST(n AS BIGINT) AS support FROM (
          SELECT 'Active' AS class, a / (a + c) AS pr, a / (a + b) AS re, 2 * a / (2 * a + b + c) AS f, a + b AS n FROM cells
          UNION ALL SELECT 'Churned', d / (b + d), d / (c + d), 2 * d / (2 * d + b + c), c + d FROM cells
          UNION ALL SELECT 'accuracy', NULL, NULL, (a + d) / (a + b + c + d), a + b + c + d FROM cells
          UNION ALL SELECT 'macro avg', (a / (a + c) + d / (b + d)) / 2, (a / (a + b) + d / (c + d)) / 2,
            (2 * a / (2 * a + b + c) + 2 * d / (2 * d + b + c)) / 2, a + b + c + d FROM cells
          UNION ALL SELECT 'weighted avg', (a / (a + c) * (a + b) + d / (b + d) * (c + d)) / (a + b + c + d),
            (a + d) / (a + b + c + d),
            (2 * a / (2 * a + b + c) * (a + b) + 2 * d / (2 * d + b + c) * (c + d)) / (a + b + c + d),
            a + b + c + d FROM cells)""",
    "K16": "SELECT round(CAST(sum(neg * (2 * tp - pos)) AS DOUBLE) / (2 * max(np) * max(nn)), 6) AS roc_auc FROM curve",
    "K17": """SELECT round(sum(CAST(pos AS DOUBLE) / np * (CAST(tp AS DOUBLE) / (tp + fp))), 6) AS average_precision
        FROM curve""",
    "K18": f"""SELECT 'Active' AS actual, {big('a')} AS predicted_active, {big('b')} AS predicted_churned FROM cells
        UNION ALL SELECT 'Churned', {big('c')}, {big('d')} FROM cells""",
    "K19": """SELECT p AS threshold, round(CAST(fp AS DOUBLE) / nn, 6) AS fpr, round(CAST(tp AS DOUBLE) / np, 6) AS tpr
        FROM curve UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE""",
    "K19_precision_recall": """SELECT p AS threshold, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision,
        round(CAST(tp AS DOUBLE) / np, 6) AS recall FROM curve UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE""",
    "K21": "SELECT customer_id, p AS churn_probability, band AS risk_segment FROM banded",
    "K22": f"SELECT customer_id, {net('net4')} AS total_spend, p AS churn_probability FROM urgent",
    "K23": """SELECT 'customers_with_purchase_history' AS item, count(*) AS customers FROM banded
        UNION ALL SELECT 'risk_segment: ' || coalesce(band, 'none'), count(*) FROM banded GROUP BY band
        UNION ALL SELECT 'high_value_high_risk_customers', count(*) FROM urgent""",
    "P1": "SELECT * FROM headline",
    "P2": f"""SELECT (SELECT {ratio('100 * sum(churned)', 'count(*)')} FROM feat) AS churn_rate_pct,
        (SELECT coalesce({net2('sum(net4)')}, 0) FROM urgent) AS high_risk_value,
        round(sum(p) FILTER (n <= 30), 0) AS next_30_days, round(sum(p) FILTER (n <= 60), 0) AS next_60_days,
        round(sum(p), 0) AS next_90_days FROM ahead""",
    "P3": f"""SELECT {ratio("100 * count(*) FILTER (status IN ('Cancelled', 'Pending'))", 'count(*)', 1)}
        AS cancelled_or_pending_pct FROM m_orders""",
    "P4": f"""SELECT segment AS rfm_segment, n AS num_customers, CAST(c AS DOUBLE) / 100 AS total_monetary,
        {ratio('100 * c', 'total', 1)} AS revenue_pct, avg_recency_days
        FROM (SELECT segment, count(*) AS n, (sum(net4) + 50) // 100 AS c, sum((sum(net4) + 50) // 100) OVER () AS total,
                     {ratio('sum(recency)', 'count(*)')} AS avg_recency_days FROM rfm_edge_named GROUP BY segment)""",
    "P4_top_two": f"""SELECT {ratio('100 * sum(n) FILTER (top)', 'sum(n)', 1)} AS customers_pct,
        {ratio('100 * sum(c) FILTER (top)', 'sum(c)', 1)} AS revenue_pct
        FROM (SELECT segment IN ('Champions', 'Loyal Customers') AS top, count(*) AS n, (sum(net4) + 50) // 100 AS c
              FROM rfm_edge_named GROUP BY segment)""",
    "P5": f"SELECT day AS order_day, {net('v')} AS revenue, round(z, 4) AS z_score FROM low_day",
    "P7": """SELECT channel AS section, customer_id, line AS row_json FROM (
          SELECT *, sum(length(line)) OVER w + 2 + 2 * greatest(row_number() OVER w - 2, 0) AS size
          FROM (SELECT channel, customer_id, '{"customer_id":"' || customer_id || '","total_orders":' || orders || '}' AS line
                FROM buyer JOIN m_customers USING (customer_id))
          WINDOW w AS (PARTITION BY channel ORDER BY customer_id ROWS UNBOUNDED PRECEDING)) WHERE size <= 4000""",
    "M1": "SELECT * FROM month_steps ORDER BY order_month DESC LIMIT 1",
    "M1_all_months": "SELECT * FROM month_steps",
    "M2": f"""SELECT category, {money('sum(revenue)')} AS revenue, {ratio('100 * sum(coalesce(n, 0))', 'sum(units)')}
        AS return_rate_pct
        FROM shelf s LEFT JOIN (SELECT product_id, count(*) AS n FROM m_returns GROUP BY 1) r
          ON r.product_id = s.product_id GROUP BY category""",
    "M3": f"SELECT {ratio('100 * sum(margin)', 'sum(revenue)')} AS gross_margin_pct FROM shelf",
}
CTES["small_orders"] = """SELECT v FROM (SELECT CAST(net4 AS DOUBLE) / 10000 AS v FROM basket)
    WHERE v < (SELECT quantile_cont(CAST(net4 AS DOUBLE) / 10000, 0.99) FROM basket)"""


def _long(item: str, label: str, value: str, source: str, digits: int = 2) -> str:
    return (
        f"SELECT '{item}' AS item, CAST({label} AS VARCHAR) AS label, round(CAST({value} AS DOUBLE), {digits}) AS value "
        f"FROM {source}"
    )


_ALL = "'all'"
CTES.update({
    "by_category": VIEWS["H3"], "by_reason": VIEWS["H4"], "pairs": VIEWS["H5"], "channel_board": VIEWS["F4"],
    "channel_cost": VIEWS["F1"], "device_board": VIEWS["C3v"], "step_board": VIEWS["C2v"], "retention": VIEWS["D1"],
    "status_board": VIEWS["G2"],
    "value_cost": f"""SELECT {ratio('net4', '100 * buyers * cac')} AS v FROM (
        SELECT sum(net4) AS net4, sum(buyers) AS buyers,
               (SELECT CAST(round(overall_cac * 100) AS BIGINT) FROM headline) AS cac FROM sales_by_channel)""",
    "place": f"""SELECT country || ' / ' || city AS place, {net2('sum(net4)')} AS revenue, count(*) AS buyers
        FROM buyer JOIN m_customers USING (customer_id) GROUP BY country, city""",
    "segment_money": f"""SELECT segment, {net2('sum(net4)')} AS revenue FROM buyer JOIN m_customers USING (customer_id)
        GROUP BY segment""",
    "channel_money": f"SELECT channel, {net2('net4')} AS revenue FROM sales_by_channel",
    "signup_month": VIEWS["B1"],
})
ANALYSIS["M4"] = " UNION ALL ".join([
    *[_long(c, _ALL, c, "headline") for c in
      ("total_revenue", "total_orders", "total_customers", "aov", "overall_cac")],
    _long("gross_margin_pct", _ALL, "gross_margin_pct", f"({ANALYSIS['M3']})"),
    _long("clv_to_cac", _ALL, "v", "value_cost"),
    _long("new_customers", "signup_month.signup_month", "new_customers", "signup_month"),
    _long("revenue_growth_pct", "order_month", "revenue_change_pct", "month_steps"),
    _long("revenue_by_channel", "channel", "revenue", "channel_money"),
    _long("revenue_by_category", "category", "revenue", "by_category"),
])
ANALYSIS["M5"] = " UNION ALL ".join([
    _long("revenue_by_segment", "segment", "revenue", "segment_money"),
    _long("revenue_by_place", "place.place", "revenue", "place"),
    _long("buyers_by_place", "place.place", "buyers", "place"),
    _long("repeat_customers", _ALL, "count(*) FILTER (orders > 1)", "idle"),
    _long("customers_by_churn_status", "churn_status", "count(*)", "status_board GROUP BY churn_status"),
    _long("month_1_retention_pct", "cohort_month", "retention_pct", "retention WHERE month_number = 1"),
])
ANALYSIS["M6"] = " UNION ALL ".join([
    *[_long(c, "channel", c, "channel_board", 3) for c in
      ("total_spend", "attributed_revenue", "ctr_pct", "conversion_rate_pct", "roas")],
    _long("cac", "channel", "cac", "channel_cost"),
    _long("device_conversion_pct", "device", "conversion_pct", "device_board"),
    _long("overall_conversion_pct", _ALL, "overall_conversion_pct", "step_board"),
])
ANALYSIS["M7"] = " UNION ALL ".join([
    *[_long(c, "product_id", c, "performance") for c in
      ("revenue", "gross_margin", "margin_pct", "units_sold", "return_rate_pct")],
    _long("revenue_by_category", "category", "revenue", "by_category"),
    _long("returns_by_reason", "return_reason", "num_returns", "by_reason"),
    _long("bought_together", "product_a_name || ' + ' || product_b_name", "times_bought_together", "pairs"),
])
# One row per word and section that it asks for.
_ASKED = ", ".join(f"('{word}', '{section}')" for words, sections in ROUTES for word in words for section in sections)
_ORDER = "list_position([" + ", ".join(f"'{s}'" for s in SECTIONS) + "], section)"
ANALYSIS["P8"] = f"""
    SELECT conv_id, turn, coalesce(string_agg(section, ',' ORDER BY {_ORDER}), '{",".join(SECTIONS)}') AS sections
    FROM (SELECT DISTINCT place, conv_id, turn, section
          FROM (SELECT row_number() OVER () AS place, conv_id, CAST(turn AS BIGINT) AS turn, lower(text) AS question
                FROM conversations)
          LEFT JOIN (VALUES {_ASKED}) AS asked(word, section) ON contains(question, word))
    GROUP BY place, conv_id, turn"""
