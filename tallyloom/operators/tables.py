"""The cleaned tables as one bundle, either computed from raw or read back."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators.clean import CLEANERS, complete_categories

# Tables whose cleaners can leave columns out.
LARGE = ("customers", "orders", "order_items", "order_reviews")


class RetailTables:
    """Cleaned tables by name; a table is only planned when something asks for it."""

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._load_lean: Callable[[str, tuple[str, ...]], DataFrame] | None = None
        self._planned: dict[str, DataFrame] = {}

    @classmethod
    def from_raw(cls, raw: Mapping[str, Callable[[], DataFrame] | DataFrame]) -> RetailTables:
        """Clean on demand; categories are completed with those that products use."""

        def cleaned(name: str) -> DataFrame:
            source = raw[name]
            return CLEANERS[name](source() if callable(source) else source)

        tables = cls(cleaned)

        def load(name: str) -> DataFrame:
            if name == "categories":
                return complete_categories(cleaned(name), tables.products)
            return cleaned(name)

        def lean(name: str, columns: tuple[str, ...]) -> DataFrame:
            source = raw[name]
            return CLEANERS[name](source() if callable(source) else source, columns)

        tables._load = load
        tables._load_lean = lean
        return tables

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> RetailTables:
        return cls(lambda name: spark.read.parquet(f"{root}/{name}"))

    def _table(self, name: str) -> DataFrame:
        if name not in self._planned:
            self._planned[name] = self._load(name)
        return self._planned[name]

    def lean(self, name: str, *columns: str) -> DataFrame:
        """At least the keys and these columns of a table, with the same values as in the whole one."""
        if self._load_lean is None or name not in LARGE:
            return self._table(name)
        at = f"{name}: {', '.join(sorted(columns))}"
        if at not in self._planned:
            self._planned[at] = self._load_lean(name, columns)
        return self._planned[at]

    @property
    def categories(self) -> DataFrame:
        return self._table("categories")

    @property
    def customers(self) -> DataFrame:
        return self._table("customers")

    @property
    def sellers(self) -> DataFrame:
        return self._table("sellers")

    @property
    def products(self) -> DataFrame:
        return self._table("products")

    @property
    def orders(self) -> DataFrame:
        return self._table("orders")

    @property
    def order_items(self) -> DataFrame:
        return self._table("order_items")

    @property
    def order_payments(self) -> DataFrame:
        return self._table("order_payments")

    @property
    def order_reviews(self) -> DataFrame:
        return self._table("order_reviews")
