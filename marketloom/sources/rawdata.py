"""Raw, dirty text versions of the mapped test tables: every rule of the cleaning jobs meets rows it must act on.

Which rows are dirty follows from their keys; ``FIXTURES.md`` lists the rules. ``_seq`` is the copy number, which
is the file order among rows of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketloom.operators.cleaning import Cleaning
from marketloom.sources.testdata import StarTables, cents


def _number(identifier: str) -> Column:
    """The key inside an identifier of one letter and digits."""
    return F.substring(identifier, 2, 12).cast("bigint")


def _copies(df: DataFrame, *conditions: Column) -> DataFrame:
    """Each row once, and once more per condition it meets; ``_seq`` counts the copies from 0."""

    def numbers(copies: tuple[int, ...], number: int) -> Column:
        """The copies' numbers; the arrays are constants, one for each set of conditions that a row can meet."""
        if number > len(conditions):
            return F.array(*[F.lit(c) for c in copies])
        return F.when(conditions[number - 1], numbers((*copies, number), number + 1)).otherwise(numbers(copies, number + 1))

    return df.withColumn("_seq", F.explode(numbers((0,), 1)))


def _every(n: int, k: str = "_k") -> Column:
    return F.col(k) % n == 0


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


class RawTables:
    def __init__(self, spark: SparkSession, folder: str):
        self.clean = StarTables(spark, folder)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def customers(self) -> DataFrame:
        base = self.clean.customers().withColumn("_k", _number("customer_id"))
        # copy 1 repeats the whole row, copy 2 repeats the key with another name
        rows = _copies(base, _every(50), _every(53))
        iso = _text("signup_date")
        return rows.select(
            "_seq", "customer_id",
            F.when(F.col("_seq") == 2, "Changed").otherwise(F.col("customer_name")).alias("customer_name"),
            F.when(_every(31), "not a date").when(_every(41), F.lit(None).cast("string"))
            .when(_every(37), F.date_format("signup_date", "MM/dd/yyyy")).otherwise(iso).alias("signup_date"),
            F.when(F.col("_k") % 5 == 0, "usa").when(F.col("_k") % 5 == 1, " UK ").when(F.col("_k") % 5 == 2, "uae")
            .when(F.col("_k") % 5 == 3, F.concat(F.lit("  "), F.lower("country"), F.lit(" ")))
            .otherwise(F.col("country")).alias("country"),
            F.when(_every(11), F.lit(None).cast("string")).when(_every(13), " nan").when(_every(17), "   ")
            .when(F.col("_k") % 3 == 1, "o'neil-town").otherwise(F.lower("city")).alias("city"),
            F.when(~_every(23), F.concat(F.lit(" "), "device")).alias("device"),
            F.concat("acquisition_channel", F.lit(" ")).alias("acquisition_channel"),
            F.when(~_every(29), F.col("customer_segment")).alias("customer_segment"),
        )

    def products(self) -> DataFrame:
        base = self.clean.products().withColumn("_k", _number("product_id"))
        rows = _copies(base, _every(50))
        return rows.select(
            "_seq", "product_id",
            F.when(F.col("_seq") == 1, "Changed").otherwise(F.col("product_name")).alias("product_name"),
            F.when(_every(20), F.lit(None).cast("string")).when(_every(21), "   ")
            .when(_every(22), F.concat(F.lit(" "), F.lower("category"))).otherwise(F.lower("category"))
            .alias("category"),
            F.lower("subcategory").alias("subcategory"),
            F.when(_every(33), "nan").otherwise(F.col("brand")).alias("brand"),
            _text("cost").alias("cost"),
            F.when(_every(89), F.lit(None).cast("string")).otherwise(_text("selling_price")).alias("selling_price"),
        )

    def orders(self) -> DataFrame:
        base = self.clean.orders().withColumn("_k", _number("order_id"))
        rows = _copies(base, _every(50))
        return rows.select(
            "_seq", "order_id",
            F.when(_every(71), "C-none").otherwise(F.col("customer_id")).alias("customer_id"),
            F.when(_every(73), "bad date").otherwise(F.date_format("order_date", "yyyy-MM-dd HH:mm:ss"))
            .alias("order_date"),
            F.when(_every(79), "Unknown").when(F.col("_seq") == 1, "Pending").otherwise(F.col("order_status"))
            .alias("order_status"),
            F.when(F.col("_k") % 5 == 0, " upi ").when(F.col("_k") % 5 == 1, "COD")
            .when(F.col("_k") % 5 > 2, F.col("payment_method")).alias("payment_method"),
            _text("discount").alias("discount"),
            F.when(~_every(17), _text("shipping_cost")).alias("shipping_cost"),
        )

    def order_items(self) -> DataFrame:
        again = (F.col("l_partkey") + F.col("l_suppkey")) % 50 == 0
        rows = _copies(self.clean.items_with_line(), again)
        return rows.select(
            "_seq", "order_item_id", "order_id",
            F.when(_every(61, "l_partkey"), "P-none").otherwise(F.col("product_id")).alias("product_id"),
            F.when(F.col("_seq") == 1, "99").when(F.col("l_suppkey") % 40 == 7, "0")
            .when(F.col("l_suppkey") % 40 == 8, "-1")
            .when(F.col("l_suppkey") % 40 == 9, F.concat(_text("quantity"), F.lit(".0")))
            .otherwise(_text("quantity")).alias("quantity"),
            _text("unit_price").alias("unit_price"),
        )

    def web_events(self) -> DataFrame:
        base = self.clean.web_events().withColumn("_k", _number("event_id"))
        rows = _copies(base, _every(50))
        return rows.select(
            "_seq", "event_id",
            F.when(_every(59), "C-none").otherwise(F.col("customer_id")).alias("customer_id"),
            F.when(_every(43), "bad").otherwise(F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
            .alias("event_timestamp"),
            F.when(_every(47), "scroll").when(F.col("_seq") == 1, "login").otherwise(F.col("event_name"))
            .alias("event_name"),
            F.when(~_every(100), F.col("session_id")).alias("session_id"),
            "product_id",
        )

    def marketing_campaigns(self) -> DataFrame:
        base = self.clean.marketing_campaigns().withColumn("_k", F.col("impressions"))
        rows = _copies(base, _every(50))
        return rows.select(
            "_seq",
            F.when(_every(41), "bad").otherwise(_text("date")).alias("date"),
            "channel", "campaign",
            F.when(~_every(37), _text("spend")).alias("spend"),
            F.when(_every(3), F.concat(_text("impressions"), F.lit(".0"))).otherwise(_text("impressions")).alias("impressions"),
            F.when(_every(43), _text(F.col("impressions") + 1)).otherwise(_text("clicks")).alias("clicks"),
            F.when(_every(47), _text(F.col("clicks") + 1)).otherwise(_text("conversions")).alias("conversions"),
        )

    def payments(self) -> DataFrame:
        base = self.clean.payments().withColumn("_k", _number("payment_id"))
        rows = _copies(base, _every(50))
        return rows.select(
            "_seq", "payment_id", "order_id",
            F.when(F.col("_seq") == 1, "1.00").when(_every(67), "-5.00").otherwise(_text("amount")).alias("amount"),
            "payment_status",
            F.when(_every(61), "bad").otherwise(F.date_format("payment_date", "yyyy-MM-dd HH:mm:ss"))
            .alias("payment_date"),
        )

    def returns(self) -> DataFrame:
        base = self.clean.returns().withColumn("_k", F.expr(cents("refund_amount")))
        rows = _copies(base, _every(50))
        return rows.select(
            "_seq", "return_id", "order_id", "customer_id", "product_id",
            F.when(_every(61), "bad").otherwise(_text("return_date")).alias("return_date"),
            F.when(F.col("_seq") == 1, "Changed").when(~_every(7), F.col("return_reason")).alias("return_reason"),
            _text("refund_amount").alias("refund_amount"),
        )

    def experiments(self) -> DataFrame:
        base = self.clean.experiments().withColumn("_k", _number("customer_id"))
        rows = _copies(base, _every(50))
        return rows.select(
            "_seq", "experiment_id", "customer_id",
            F.when(_every(67), "holdout").otherwise(F.col("variant")).alias("variant"),
            F.when(_every(61), "bad").otherwise(_text("experiment_date")).alias("experiment_date"),
            _text("converted").alias("converted"), _text("revenue").alias("revenue"),
        )


def star_cleaning(spark: SparkSession, folder: str) -> Cleaning:
    return Cleaning(RawTables(spark, folder).table)
