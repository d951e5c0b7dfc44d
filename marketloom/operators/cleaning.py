"""From raw text tables to the nine cleaned ones: single rules (C1–C18) and pipelines (CT1–CT9).

A raw table has its columns as text and ``_seq``, the place of a row in its file. Rules take and give DataFrames
and compose with ``transform``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from marketloom.functions.dates import parse_timestamp
from marketloom.functions.text import null_if_in, strip, title_case
from marketloom.operators.base import UNKNOWN_SESSION
from marketloom.operators.ranking import exact_percentiles
from marketloom.schemas import AMOUNT, CLEAN, FRACTION, MONEY, TABLES
from marketloom.session import input_bytes, side_by_side
from marketloom.shop import Shop

Rule = Callable[[DataFrame], DataFrame]

# Allowed vocabularies, fill texts and country spellings.
STATUSES = ("Completed", "Cancelled", "Returned", "Pending")
EVENTS = ("page_view", "product_view", "add_to_cart", "checkout", "purchase", "login", "wishlist")
VARIANTS = ("control", "treatment")
COUNTRY_SPELLINGS = {"Usa": "USA", "Uk": "UK", "Uae": "UAE"}
CUSTOMER_LABELS = {"city": "Unknown", "device": "Unknown", "customer_segment": "Unclassified"}
NO_REASON = "Not Specified"
CUSTOMER_TEXTS = ("country", "city", "device", "acquisition_channel", "customer_segment")
PRODUCT_TEXTS = ("category", "subcategory", "brand")

# Tables with parents, in the order in which they are stored when disk is to be saved: a parent before its children, and
# order_items, whose rows are shuffled most often (by their key and for each of two parents), while little is stored.
CHILDREN = ("orders", "order_items", "payments", "returns", "web_events")
PARTS = {"order_items": 4}
PART_BYTES = 32 << 20
"""A part is of no less input than that."""


# ---- Rules ---------------------------------------------------------------------------------------------


def drops(number: str, reason: str) -> Callable[[Rule], Rule]:
    """Marks a rule that leaves rows out, with its number and why these go."""

    def mark(rule: Rule) -> Rule:
        rule.number, rule.reason = number, reason
        return rule

    return mark


@drops("C1", "repeated row")
def drop_repeated_rows(df: DataFrame) -> DataFrame:
    """Of rows equal in every column but their place, one."""
    return df.dropDuplicates([c for c in df.columns if c != "_seq"])


def keep_first(key: str) -> Rule:
    """Per key the first row of the file. Spark limits each map task to one row per key before the shuffle.

    Rows are sorted by the key's hash first: a sort compares texts that begin alike in full, and numbers at once.
    """

    @drops("C2", f"repeated {key}")
    def rule(df: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(F.xxhash64(key), key).orderBy("_seq"))
        return df.withColumn("_place", place).filter("_place = 1").drop("_place")

    rule.key = key
    return rule


def clean_texts(*columns: str) -> Rule:
    """Trimmed, with blank and ``nan`` as null."""
    return lambda df: df.withColumns({c: null_if_in(strip(F.col(c)), "nan", "") for c in columns})


def title_texts(*columns: str) -> Rule:
    """C4."""
    return lambda df: df.withColumns({c: title_case(F.col(c)) for c in columns})


def titled_or_null(*columns: str) -> Rule:
    """C4 where missing texts were spelled out before: trimmed, title case, ``Nan`` as null; blank stays blank."""
    return lambda df: df.withColumns({c: null_if_in(title_case(strip(F.col(c))), "Nan") for c in columns})


def respell_countries(df: DataFrame) -> DataFrame:
    """C5."""
    return df.replace(COUNTRY_SPELLINGS, subset=["country"])


def fill_labels(labels: dict[str, str]) -> Rule:
    """C6."""
    return lambda df: df.fillna(labels)


def whole_number(column: str, kind: str) -> Column:
    """A whole number however it is spelled: ``2``, ``2.0``, ``2e0``; anything else is null."""
    exact = F.col(column).try_cast("decimal(38,9)")
    # Plain digits, the usual spelling, need no decimal.
    return F.coalesce(F.col(column).try_cast(kind), F.when(exact == F.floor(exact), exact).try_cast(kind))


def numbers(**kinds) -> Rule:
    """Text to number; text that is no number becomes null."""
    return lambda df: df.withColumns({
        c: whole_number(c, kind) if kind in ("int", "bigint") else F.col(c).try_cast(kind) for c, kind in kinds.items()
    })


def zero_if_missing(*columns: str) -> Rule:
    """C7."""
    return lambda df: df.withColumns({c: F.coalesce(c, F.lit(0).cast(df.schema[c].dataType)) for c in columns})


def valid_time(column: str, kind: str = "timestamp_ntz") -> Rule:
    """Parsed; rows whose text is no date are dropped."""
    return drops("C8", f"{column} is no date")(lambda df: df.withColumn(column, parse_timestamp(F.col(column)).cast(kind)).filter(
        F.col(column).isNotNull()
    ))


def with_parent(parent: DataFrame, key: str) -> Rule:
    """Rows whose key exists in the cleaned parent table. They meet by the key's hash and the key, as in ``keep_first``."""

    @drops("C9", f"{key} is unknown")
    def rule(df: DataFrame) -> DataFrame:
        hashed = {"_hash": F.xxhash64(key)}
        return df.withColumns(hashed).join(parent.select(key).withColumns(hashed), ["_hash", key], "left_semi").drop("_hash")

    return rule


def listed(column: str, values: tuple[str, ...]) -> Rule:
    """C10."""
    return drops("C10", f"{column} is not listed")(lambda df: df.filter(F.col(column).isin(*values)))


def flag_missing_cost(df: DataFrame) -> DataFrame:
    """C11."""
    return df.withColumn("cost_is_estimated", F.col("cost").isNull())


def fill_cost(df: DataFrame) -> DataFrame:
    """The category's exact median, else the overall one; no category takes the overall median."""
    known = df.filter("cost IS NOT NULL").select(
        "cost", F.inline(F.array(
            F.struct(F.lit(False).alias("overall"), F.col("category").alias("scope")),
            F.struct(F.lit(True).alias("overall"), F.lit(None).cast("string").alias("scope")),
        ))
    )
    medians = exact_percentiles(
        known.filter("overall OR scope IS NOT NULL"), ["overall", "scope"], "cost", {"median": 0.5}
    ).withColumn("median", F.round(F.col("median").cast("decimal(18,6)"), 2).cast(MONEY))
    by_category = medians.filter("NOT overall").select(
        F.col("scope").alias("category"), F.col("median").alias("_category_median")
    )
    overall = medians.filter("overall").agg(F.max("median")).scalar()
    return df.join(by_category, "category", "left").withColumn(
        "cost", F.coalesce("cost", "_category_median", overall)
    ).drop("_category_median")


def flag_invalid_price(df: DataFrame) -> DataFrame:
    """A missing price is not flagged."""
    return df.withColumn("price_is_invalid", F.coalesce(F.col("selling_price") <= 0, F.lit(False)))


@drops("C14", "quantity is not positive")
def positive_quantity(df: DataFrame) -> DataFrame:
    """C14."""
    return df.filter("quantity > 0")


def add_line_total(df: DataFrame) -> DataFrame:
    """C15."""
    return df.withColumn("line_total", (F.col("quantity") * F.col("unit_price")).cast(MONEY))


@drops("C16", "more clicks than impressions or conversions than clicks")
def plausible_clicks(df: DataFrame) -> DataFrame:
    """C16."""
    return df.filter("clicks <= impressions AND conversions <= clicks")


@drops("C17", "amount is negative")
def no_negative_amount(df: DataFrame) -> DataFrame:
    """C17."""
    return df.filter("amount >= 0")


# ---- Pipelines -----------------------------------------------------------------------------------------


def in_parts(name: str, raw: DataFrame) -> int:
    """In how many parts a table is stored; a fixed number on large input, so that reading it again grows with the input only."""
    most = PARTS.get(name, 1)
    return max(1, min(most, input_bytes(raw) // PART_BYTES)) if most > 1 else 1


class Cleaning:
    """The nine pipelines over raw tables; a child table reads the keys of its cleaned parents.

    With ``keep`` (a function that stores a DataFrame and gives it back) every table is cleaned once, however
    many children it has.
    """

    def __init__(
        self, raw: Callable[[str], DataFrame], keep: Callable[[DataFrame, str], DataFrame] | None = None, counting: bool = False,
        parts: Callable[[str, DataFrame], int] | None = None,
    ):
        self.raw = raw
        self._keep = keep
        self._counting = counting
        self._parts = parts
        self._done: dict[str, DataFrame] = {}
        self._locks = {name: Lock() for name in TABLES}
        # Per table that is stored in parts: the part at hand and the number of parts.
        self._part: dict[str, tuple[int, int]] = {}
        # Per table and part: its raw rows, then (rule, rows left) for every rule that leaves rows out.
        self._seen: dict[str, dict[int, list[tuple[Rule | None, Observation]]]] = {name: {} for name in TABLES}

    def keeping(
        self, keep: Callable[[DataFrame, str], DataFrame], counting: bool = False, parts: Callable[[str, DataFrame], int] | None = None,
    ) -> "Cleaning":
        """``counting`` counts rows per rule in the passes that store the tables, for ``rule_audit``.

        A session in which rows were counted so can't run plans that send the session to tasks, as some of Spark's do:
        the raw tables should come from a session of their own (``spark.newSession()``).

        ``parts`` saves disk: tables with parents are stored one after another, each in so many parts (asked with its name and
        its raw rows) by the hash of its key. Each row is in one part, and all rows of a key in the same, so that the parts make
        up the table; the raw table is read once per part, and one part's shuffles are on disk at a time. ``keep`` is called per part.
        """
        return Cleaning(self.raw, keep, counting, parts)

    def _run(self, table: str, *rules: Rule) -> DataFrame:
        """The raw table after ``rules``; in a counting run rows are counted on the way, in the pass that stores the table."""
        df, seen = self.raw(table), []
        part, parts = self._part.get(table, (0, 1))
        if parts > 1:
            df = df.filter(F.pmod(F.xxhash64(rules[0].key), F.lit(parts)) == part)

        def counted(df: DataFrame, rule: Rule | None) -> DataFrame:
            if not self._counting or part in self._seen[table]:
                return df
            seen.append((rule, Observation(f"{table}-{len(seen)}-{id(seen)}")))
            return df.observe(seen[-1][1], F.count(F.lit(1)).alias("rows"))

        df = counted(df, None)
        for rule in rules:
            df = rule(df)
            if hasattr(rule, "reason"):
                df = counted(df, rule)
        self._seen[table].setdefault(part, seen)
        return df

    def _finished(self, table: str, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CLEAN[table]])

    def customers(self) -> DataFrame:
        # Rows equal in every column share their customer_id, so keeping the first per id drops them too.
        return self._finished("customers", self._run(
            "customers", keep_first("customer_id"), clean_texts(*CUSTOMER_TEXTS), title_texts("country", "city"),
            respell_countries, fill_labels(CUSTOMER_LABELS), valid_time("signup_date", "date"),
        ))

    def product_rows(self) -> DataFrame:
        return self._run("products", keep_first("product_id"))

    def products(self) -> DataFrame:
        # Blank texts are emptied before trimming, so a text of blanks only stays as "".
        def empty_to_null(df: DataFrame) -> DataFrame:
            return df.withColumns({c: null_if_in(F.col(c), "nan", "") for c in PRODUCT_TEXTS})

        rules = (
            empty_to_null, titled_or_null(*PRODUCT_TEXTS), numbers(cost=MONEY, selling_price=MONEY),
            flag_missing_cost, fill_cost, flag_invalid_price,
        )
        return self._finished("products", reduce(DataFrame.transform, rules, self.product_rows()))

    def orders(self) -> DataFrame:
        return self._finished("orders", self._run(
            "orders", keep_first("order_id"), valid_time("order_date"),
            with_parent(self.table("customers"), "customer_id"), titled_or_null("payment_method"),
            numbers(discount=FRACTION, shipping_cost=MONEY), zero_if_missing("discount", "shipping_cost"),
            listed("order_status", STATUSES),
        ))

    def order_items(self) -> DataFrame:
        # Cleaning leaves out no product but repeated ones, so a stored table has the same keys.
        products = self.table("products") if self._keep else self.product_rows()
        return self._finished("order_items", self._run(
            # Numbers first: they are shorter than their texts when rows are shuffled to their parents.
            "order_items", keep_first("order_item_id"), numbers(quantity="int", unit_price=MONEY),
            with_parent(self.table("orders"), "order_id"), with_parent(products, "product_id"),
            positive_quantity, add_line_total,
        ))

    def web_events(self) -> DataFrame:
        return self._finished("web_events", self._run(
            "web_events", keep_first("event_id"), valid_time("event_timestamp"),
            with_parent(self.table("customers"), "customer_id"), fill_labels({"session_id": UNKNOWN_SESSION}),
            listed("event_name", EVENTS),
        ))

    def marketing_campaigns(self) -> DataFrame:
        return self._finished("marketing_campaigns", self._run(
            "marketing_campaigns", drop_repeated_rows, valid_time("date", "date"),
            numbers(spend=MONEY, impressions="int", clicks="int", conversions="int"), zero_if_missing("spend"),
            plausible_clicks,
        ))

    def payments(self) -> DataFrame:
        return self._finished("payments", self._run(
            "payments", keep_first("payment_id"), with_parent(self.table("orders"), "order_id"),
            valid_time("payment_date"), numbers(amount=AMOUNT), no_negative_amount,
        ))

    def returns(self) -> DataFrame:
        return self._finished("returns", self._run(
            "returns", keep_first("return_id"), with_parent(self.table("orders"), "order_id"),
            valid_time("return_date", "date"), fill_labels({"return_reason": NO_REASON}),
        ))

    def experiments(self) -> DataFrame:
        return self._finished("experiments", self._run(
            "experiments", drop_repeated_rows, valid_time("experiment_date", "date"),
            listed("variant", VARIANTS), numbers(converted="int"),
        ))

    def table(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._done:
                self._done[name] = reduce(DataFrame.unionAll, self._cleaned(name))
            return self._done[name]

    def _cleaned(self, name: str) -> Iterator[DataFrame]:
        """The cleaned table, in as many parts as it is stored in."""
        parts = self._parts(name, self.raw(name)) if self._parts and self._keep and name in CHILDREN else 1
        for part in range(parts):
            self._part[name] = part, parts
            cleaned = getattr(self, name)()
            del self._part[name]
            yield self._keep(cleaned, name) if self._keep else cleaned

    def tables(self) -> dict[str, DataFrame]:
        """All cleaned tables; those that are stored are so side by side, a child once its parents are there."""
        if self._parts:
            side_by_side(self.table, [name for name in TABLES if name not in CHILDREN])
            for name in CHILDREN:
                self.table(name)
        return dict(zip(TABLES, side_by_side(self.table, TABLES)))

    def shop(self, spark) -> Shop:
        return Shop(spark, self.table)

    def rule_audit(self, spark: SparkSession) -> DataFrame:
        """C18 in detail: per table and rule that leaves rows out, the rows before and after, and why they go.

        Needs a counting run. Counts are metrics of the pass that stores a table, so nothing is read for them a second time. A
        task that runs again after its executor was lost counts again: the counts are a report, the tables don't rest on
        them. The last count of a table is compared with the rows that were stored.
        """
        lines = []
        for name, kept in self.tables().items():
            # Per step its counts in all parts of the table.
            counts = [(seen[0][0], sum(left.get["rows"] for _, left in seen)) for seen in zip(*self._seen[name].values())]
            before = counts[0][1]
            for step, (rule, left) in enumerate(counts[1:], 1):
                lines.append((name, step, rule.number, rule.reason, before, left))
                before = left
            stored = kept.count()
            if before != stored:
                raise RuntimeError(f"{name}: {before} rows were counted and {stored} stored; some task ran twice")
        return spark.createDataFrame(lines, "table_name string, step int, rule string, reason string, rows_in bigint, rows_out bigint")

    def audit(self) -> DataFrame:
        """Rows before and after, per table."""
        lines = []
        for name, kept in self.tables().items():
            after = kept.agg(F.count("*")).scalar()
            lines.append(self.raw(name).agg(F.count("*").alias("raw_rows")).select(
                F.lit(name).alias("table_name"), "raw_rows", after.alias("clean_rows")
            ))
        return reduce(DataFrame.unionByName, lines)
