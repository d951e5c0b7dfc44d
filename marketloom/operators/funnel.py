"""Web funnel: how many sessions reach each stage (C1v–C5v)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketloom.functions.numeric import percent
from marketloom.operators.base import UNKNOWN_SESSION
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop

# The stages in order.
STAGES = ("page_view", "product_view", "add_to_cart", "checkout", "purchase")


def known_sessions(shop: Shop) -> DataFrame:
    """Events with a real session; the placeholder would be one giant key and leaves before any shuffle."""
    return shop.web_events.filter(F.col("session_id") != UNKNOWN_SESSION)


def reached(stage: str) -> Column:
    return F.max((F.col("event_name") == stage).cast("int")).alias(stage)


def visits(shop: Shop) -> DataFrame:
    """One row per session and customer with the stages reached."""
    return shop.shared("visits", lambda: known_sessions(shop).groupBy("session_id", "customer_id").agg(*[reached(s) for s in STAGES]))


def stage_totals(shop: Shop) -> DataFrame:
    sessions = visits(shop).groupBy("session_id").agg(*[F.max(s).alias(s) for s in STAGES])
    return sessions.agg(*[F.sum(s).alias(s) for s in STAGES])


def sessions_per_stage(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return stage_totals(shop).select(
        *[F.col(stage).alias(f"step{i}_{stage}") for i, stage in enumerate(STAGES, 1)]
    )


def step_conversion(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    view, product, cart, checkout, purchase = (F.col(s) for s in STAGES)
    return stage_totals(shop).select(
        *[F.col(s).alias(f"n_{s}") for s in STAGES],
        percent(product, view).alias("pv_to_productview_pct"),
        percent(cart, product).alias("productview_to_cart_pct"),
        percent(checkout, cart).alias("cart_to_checkout_pct"),
        percent(purchase, checkout).alias("checkout_to_purchase_pct"),
        percent(purchase, view).alias("overall_conversion_pct"),
    )


def _conversion_by(shop: Shop, attribute: str) -> DataFrame:
    """Events shrink to one row per session and customer before the customers are joined."""
    per_session = (
        visits(shop).join(shop.customers.select("customer_id", attribute), "customer_id")
        .groupBy("session_id", attribute)
        .agg(F.max("page_view").alias("page_view"), F.max("purchase").alias("purchase"))
    )
    return per_session.groupBy(attribute).agg(
        F.sum("page_view").alias("sessions"),
        F.sum("purchase").alias("purchases"),
        percent(F.sum("purchase"), F.sum("page_view")).alias("conversion_pct"),
    )


def device_conversion(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return _conversion_by(shop, "device")


def channel_conversion(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return _conversion_by(shop, "acquisition_channel")


def drop_off(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    steps = [
        F.struct(F.lit(f"{a} -> {b}").alias("stage"), (F.col(a) - F.col(b)).alias("sessions_lost"))
        for a, b in zip(STAGES, STAGES[1:])
    ]
    return stage_totals(shop).select(F.inline(F.array(*steps)))
