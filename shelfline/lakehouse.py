"""Bronze, Silver and Gold tables as lazily built DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from shelfline.functions.dialect import date_lit
from shelfline.sources import files, star_schema

# Reporting date of the star-schema test tables: their last order date.
STAR_SCHEMA_AS_OF = dt.date(2001, 8, 1)


class Lakehouse:
    """The tables of one pipeline run, built on first use.

    ``as_of`` is the reporting date that statuses, ages and recencies are measured at; it is a parameter so that a
    run can be repeated.
    """

    def __init__(self, spark: SparkSession, read_bronze: Callable[[str], DataFrame], as_of: dt.date):
        self.spark = spark
        self.as_of = as_of
        self._read_bronze = read_bronze
        self._tables: dict[tuple[str, str], DataFrame] = {}
        self._written: set[tuple[str, str]] = set()

    @classmethod
    def from_star_schema(cls, spark: SparkSession, folder: str, as_of: dt.date = STAR_SCHEMA_AS_OF) -> Lakehouse:
        return cls(spark, lambda table: star_schema.read_bronze(spark, folder, table), as_of)

    @classmethod
    def from_files(cls, spark: SparkSession, folder: str, as_of: dt.date, layouts: Mapping[str, str] | None = None) -> Lakehouse:
        """Over raw files; ``layouts`` overrides the record layouts that ``schemas`` declares, table by table."""
        return cls(spark, lambda table: files.read_bronze(spark, folder, table, layouts), as_of)

    @classmethod
    def from_loaded(cls, spark: SparkSession, folder: str, as_of: dt.date) -> Lakehouse:
        """Over the Parquet folders that the incremental load fills, one named after each Bronze table."""
        return cls(spark, lambda table: files.accepted(spark.read.parquet(f"{folder.rstrip('/')}/{table}")), as_of)

    @classmethod
    def from_frames(cls, spark: SparkSession, as_of: dt.date, **tables: DataFrame) -> Lakehouse:
        """Use given DataFrames: Bronze names as Bronze tables, Silver names as already cleaned ones."""
        lake = cls(spark, tables.__getitem__, as_of)
        lake._tables = {("silver", name): df for name, df in tables.items() if name.endswith("_clean")}
        return lake

    @property
    def today(self) -> Column:
        return date_lit(self.as_of)

    def bronze(self, name: str) -> DataFrame:
        return self._once("bronze", name, lambda: self._read_bronze(name))

    def silver(self, name: str) -> DataFrame:
        from shelfline.plans.silver import TABLES

        source, clean = TABLES[name]
        return self._once("silver", name, lambda: clean(self.bronze(source), self.today))

    def gold(self, name: str) -> DataFrame:
        from shelfline.plans.gold import TABLES

        return self._once("gold", name, lambda: TABLES[name](self))

    def use(self, layer: str, name: str, df: DataFrame) -> None:
        """Serve this layer's table from ``df``, for example its written copy."""
        self._tables[layer, name] = df
        self._written.add((layer, name))

    def written(self, layer: str, name: str) -> DataFrame | None:
        """The table given to ``use``, or None: for tables that only save work where they exist."""
        return self._tables[layer, name] if (layer, name) in self._written else None

    def _once(self, layer: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if (layer, name) not in self._tables:
            self._tables[layer, name] = build()
        return self._tables[layer, name]
