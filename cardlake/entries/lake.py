"""Tables the registered queries work on: raw, curated and star tables of one sample folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.plans import warehouse
from cardlake.plans.curation import write_curated
from cardlake.sources.datasets import write_dataset
from cardlake.sources.sample_raw import sample_raw, sample_table
from cardlake.sources.shared import fresh_path, scratch

CALENDAR = ("1995-01-01", "2002-12-31")
QUERIES: dict[str, Callable] = {}


class Lake:
    """Curated and star tables are written to the shared folder when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._written: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return sample_table(self.spark, self.sf_dir, name)

    def raw(self, source: str) -> DataFrame:
        return sample_raw(self.spark, self.sf_dir, source)

    def path(self, label: str) -> str:
        return fresh_path(self.spark, label)

    def curated(self, source: str) -> DataFrame:
        return self._once(source, lambda path: write_curated(source, self.raw(source), path)[0])

    def star(self, name: str) -> DataFrame:
        return self._once(name, lambda path: write_dataset(self._build(name), path))

    def _build(self, name: str) -> DataFrame:
        if name == "dim_organizations":
            return warehouse.dim_organizations(self.curated("orgs"))
        if name == "dim_users":
            return warehouse.dim_users(self.curated("users"), self.curated("cards"))
        if name == "dim_cards":
            return warehouse.dim_cards(self.curated("cards"))
        if name == "dim_merchants":
            return warehouse.dim_merchants(self.curated("transactions"))
        if name == "dim_dates":
            return warehouse.dim_dates(self.spark, *CALENDAR)
        if name == "fact_transactions":
            dims = [self.star(d) for d in ("dim_cards", "dim_organizations", "dim_merchants")]
            return warehouse.fact_transactions(self.curated("transactions"), *dims)
        if name == "fact_clearing":
            return warehouse.fact_clearing(
                self.curated("clearing"), self.star("fact_transactions")
            )
        raise KeyError(name)

    def _once(self, name: str, write: Callable[[str], DataFrame]) -> DataFrame:
        if name not in self._written:
            with scratch(self.spark):
                self._written[name] = write(self.path(name))
        return self._written[name]


_lakes: dict[tuple[str, str], Lake] = {}


def lake_of(spark: SparkSession, sf_dir: str) -> Lake:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _lakes:
        _lakes[key] = Lake(spark, sf_dir.rstrip("/"))
    return _lakes[key]


def query(key: str):
    """Register a query under a key."""

    def register(build: Callable[[Lake], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"registered twice: {key}")
        QUERIES[key] = build
        return build

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Output types that any engine has: BIGINT, DOUBLE, BOOLEAN and text."""
    columns = []
    for field in df.schema:
        kind, c = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("decimal", "float"):
            c = c.cast("double")
        elif kind in ("integer", "short", "byte"):
            c = c.cast("bigint")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        columns.append(c.alias(field.name))
    return df.select(*columns)
