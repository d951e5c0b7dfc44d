"""The nine tables an operator works on, resolved by name and only when asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketloom.schemas import CLEAN, TABLES


class Shop:
    """Gives ``shop.orders``, ``shop.customers`` … as DataFrames; each is built on first use."""

    def __init__(self, spark: SparkSession, read: Callable[[str], DataFrame]):
        self.spark = spark
        self._read = read
        self._known: dict[str, DataFrame] = {}
        self._keep: Callable[[DataFrame, str], DataFrame] | None = None
        self._kept_names: tuple[str, ...] = ()
        self._shared: dict[tuple, DataFrame] = {}

    def keeping(self, keep: Callable[[DataFrame, str], DataFrame], *names: str) -> "Shop":
        """The same tables, with results that several analyses share computed once and stored by ``keep``.

        ``names`` limits this to some of the shared results; a shop that keeps already stays as it is.
        """
        if self._keep is not None:
            return self
        other = Shop(self.spark, self.table)
        other._keep, other._kept_names = keep, names
        return other

    def shared(self, name: str, build: Callable[[], DataFrame], *settings) -> DataFrame:
        """The result of ``build``; in a keeping shop the stored one, told apart by name and settings."""
        if self._keep is None or (self._kept_names and name not in self._kept_names):
            return build()
        key = (name, *settings)
        if key not in self._shared:
            self._shared[key] = self._keep(build(), name)
        return self._shared[key]

    @classmethod
    def of_frames(cls, spark: SparkSession, frames: dict[str, DataFrame]) -> "Shop":
        return cls(spark, frames.__getitem__)

    @classmethod
    def of_parquet(cls, spark: SparkSession, folder: str) -> "Shop":
        return cls(spark, lambda name: spark.read.schema(CLEAN[name]).parquet(f"{folder}/{name}"))

    def table(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._read(name)
        return self._known[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)
