"""The star-schema and event tables of ``TESTDATA.md`` seen as the nine shop tables (``FIXTURES.md`` 2).

All rules are integer arithmetic on single rows, so any engine reproduces them to the digit. Nothing is
broadcast by hint: the nation and region joins are left to Spark's own size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketloom.schemas import CLEAN
from marketloom.shop import Shop

# Vocabularies of the shop tables.
DEVICES = ("Mobile", "Desktop", "Tablet", "Unknown")
CHANNELS = (
    "Google Ads", "Meta Ads", "YouTube Ads", "Email", "Organic Search", "Affiliate", "Referral", "Direct",
)
REASONS = ("Defective", "Wrong Item", "Size Issue", "Not as Described", "Changed Mind", "Not Specified")
EVENT_NAMES = {
    "view": "page_view", "click": "product_view", "signup": "add_to_cart", "error": "checkout",
    "purchase": "purchase",
}
EXPERIMENT = "EXP001_checkout_redesign"

# Schemas of the files, so that no query opens a file only to learn its columns.
FILES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def key_text(prefix: str, key: str) -> str:
    return f"concat('{prefix}', lpad(cast({key} AS string), 12, '0'))"


def cents(amount: str) -> str:
    """Rounded half up. Spark rounds doubles by way of big decimals; away from halves any rounding gives the same."""
    value = f"({amount} * 100)"
    return f"CASE WHEN abs({value} - rint({value})) < 0.25 THEN cast(rint({value}) AS bigint) ELSE cast(round({value}) AS bigint) END"


def from_cents(value: str, kind: str = "decimal(12,2)") -> str:
    return f"cast(cast({value} AS decimal(15,0)) * 0.01 AS {kind})"


def pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast({index} AS int) + 1)"


class StarTables:
    """Lazy mapping of one test-data folder; each method gives one shop table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(FILES[name]).parquet(f"{self.folder}/{name}.parquet")

    def customers(self) -> DataFrame:
        places = self.read("nation").join(self.read("region").withColumnRenamed("r_regionkey", "n_regionkey"),
                                          "n_regionkey")
        named = self.read("customer").withColumnRenamed("c_nationkey", "n_nationkey").join(places, "n_nationkey")
        return named.selectExpr(
            f"{key_text('C', 'c_custkey')} AS customer_id",
            "c_name AS customer_name",
            "date_add(DATE'1995-01-01', cast(c_custkey * 37 % 1800 AS int)) AS signup_date",
            "n_name AS country",
            "r_name AS city",
            f"{pick(DEVICES, 'c_custkey % 4')} AS device",
            f"{pick(CHANNELS, 'n_nationkey % 8')} AS acquisition_channel",
            "c_mktsegment AS customer_segment",
        )

    def products(self) -> DataFrame:
        """Missing costs stay missing here; filling them is the work of the cleaning job."""
        price = cents("p_retailprice")
        return self.read("part").selectExpr(
            f"{key_text('P', 'p_partkey')} AS product_id",
            "p_name AS product_name",
            "p_type AS category",
            "concat('Size ', cast(p_size AS string)) AS subcategory",
            "p_brand AS brand",
            f"CASE WHEN p_partkey % 25 <> 0 THEN {from_cents(f'{price} * 6 div 10')} END AS cost",
            f"CASE WHEN p_partkey % 97 = 0 THEN cast(-1 AS decimal(12,2)) ELSE {from_cents(price)} END AS selling_price",
            "p_partkey % 25 = 0 AS cost_is_estimated",
            "p_partkey % 97 = 0 AS price_is_invalid",
        )

    def orders(self) -> DataFrame:
        return self.read("orders").selectExpr(
            f"{key_text('O', 'o_orderkey')} AS order_id",
            f"{key_text('C', 'o_custkey')} AS customer_id",
            "o_orderdate AS order_date",
            "CASE WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'O' THEN 'Pending' "
            "WHEN o_orderkey % 2 = 0 THEN 'Cancelled' ELSE 'Returned' END AS order_status",
            "o_orderpriority AS payment_method",
            f"CASE WHEN o_orderkey % 11 <> 0 THEN {from_cents('o_orderkey % 4 * 5', 'decimal(6,4)')} END AS discount",
            "cast(o_orderkey % 10 + 5 AS decimal(12,2)) AS shipping_cost",
        )

    def items_with_line(self) -> DataFrame:
        """Order items together with the columns that only the returns need."""
        quantity = "cast(l_quantity AS int)"
        unit = f"CASE WHEN l_partkey % 150 = 7 THEN 0 ELSE {cents('l_extendedprice')} div {quantity} END"
        priced = self.read("lineitem").selectExpr("*", f"{quantity} AS quantity", f"{unit} AS unit_cents")
        return priced.selectExpr(
            f"concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, {cents('l_extendedprice')}) AS order_item_id",
            f"{key_text('O', 'l_orderkey')} AS order_id",
            f"{key_text('P', 'l_partkey')} AS product_id",
            "quantity",
            f"{from_cents('unit_cents')} AS unit_price",
            f"{from_cents('unit_cents * quantity')} AS line_total",
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate",
        )

    def order_items(self) -> DataFrame:
        return self.items_with_line().select(*CLEAN["order_items"].names)

    def payments(self) -> DataFrame:
        from marketloom.operators.base import order_facts

        return order_facts(self.shop()).selectExpr(
            "regexp_replace(order_id, '^O', 'Y') AS payment_id",
            "order_id",
            "cast(round(net + shipping_cost, 2) AS decimal(18,2)) AS amount",
            "'Success' AS payment_status",
            "order_date AS payment_date",
        )

    def returns(self) -> DataFrame:
        items = self.items_with_line().filter(
            "l_returnflag = 'R' AND (l_partkey + l_suppkey + l_linenumber) % 4 = 0"
        )
        # By the number of the order, which sorts faster than its text.
        buyers = self.read("orders").selectExpr("o_orderkey AS l_orderkey", f"{key_text('C', 'o_custkey')} AS customer_id")
        return items.join(buyers, "l_orderkey").selectExpr(
            "concat('R', order_item_id) AS return_id",
            "order_id", "customer_id", "product_id",
            "cast(l_shipdate AS date) AS return_date",
            f"{pick(REASONS, 'l_suppkey % 6')} AS return_reason",
            "line_total AS refund_amount",
        )

    def marketing_campaigns(self) -> DataFrame:
        """Orders are added up per customer and day before they meet the customers."""
        from pyspark.sql import functions as F

        per_customer = self.read("orders").groupBy(
            F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("date")
        ).agg(
            F.count("*").alias("n"),
            F.expr("sum(o_orderkey % 97)").alias("extra_spend"),
            F.expr("sum(o_orderkey % 500)").alias("extra_impressions"),
        )
        channels = self.read("customer").selectExpr("c_custkey", f"{pick(CHANNELS, 'c_nationkey % 8')} AS channel")
        daily = per_customer.join(channels, "c_custkey").groupBy("date", "channel").agg(
            F.expr("cast(sum(n) * 40 + sum(extra_spend) AS decimal(12,2))").alias("spend"),
            F.expr("sum(n) * 1000 + sum(extra_impressions)").alias("impressions"),
        )
        return daily.selectExpr(
            "date", "channel",
            "concat_ws(' ', channel, year(date)) AS campaign",
            "spend",
            "cast(impressions AS int) AS impressions",
            "cast(impressions div 40 AS int) AS clicks",
            "cast(impressions div 40 div 24 AS int) AS conversions",
        )

    def web_events(self) -> DataFrame:
        names = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, name in EVENT_NAMES.items())
        return self.read("events").selectExpr(
            f"{key_text('E', 'event_id')} AS event_id",
            f"{key_text('C', 'user_id')} AS customer_id",
            "ts AS event_timestamp",
            f"CASE event_type {names} END AS event_name",
            "CASE WHEN event_id % 100 = 0 THEN 'UNKNOWN_SESSION' "
            "ELSE concat_ws('-', 'S', user_id, date_format(ts, 'yyyyMMdd')) END AS session_id",
            f"CASE WHEN event_type IN ('click', 'signup') THEN {key_text('P', 'event_id % 200')} END AS product_id",
        )

    def experiments(self) -> DataFrame:
        drawn = self.read("customer").selectExpr("c_custkey AS k", "c_custkey div 2 % 2 = 1 AS treated")
        return drawn.selectExpr(
            "k", "treated", "cast(k * 7919 % 1000 < CASE WHEN treated THEN 141 ELSE 118 END AS int) AS converted"
        ).selectExpr(
            f"'{EXPERIMENT}' AS experiment_id",
            f"{key_text('C', 'k')} AS customer_id",
            "CASE WHEN treated THEN 'treatment' ELSE 'control' END AS variant",
            "date_add(DATE'2000-06-01', cast(k % 30 AS int)) AS experiment_date",
            "converted",
            "cast(converted * (k % 5000 + 1000) AS decimal(12,2)) AS revenue",
        )

    def shop(self) -> Shop:
        return Shop(self.spark, lambda name: getattr(self, name)())


def star_shop(spark: SparkSession, folder: str) -> Shop:
    return StarTables(spark, folder).shop()
