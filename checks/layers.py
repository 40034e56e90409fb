"""Layer tables the queries share, each written once per session and input folder."""

from __future__ import annotations

from functools import partial
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

from checks.observations import TIE_BREAKERS, rank_observations
from rankhouse.fixed_values import ReasonRules
from rankhouse.plans.features import FEATURES, OVER_NEWEST, author_reason
from rankhouse.plans.layers import Warehouse
from rankhouse.sources.staging import fresh_path
from rankhouse.sources.tables import create_database, read_layer

# Titles of the test tables are English.
HOT_KEYWORDS = "red|hot|small"
REASON_RULES = ReasonRules(hot_keywords=HOT_KEYWORDS)
CHECKED_FEATURES = {**FEATURES, "ads_author_reason": partial(author_reason, rules=REASON_RULES)}

_building = RLock()
_warehouses: dict[tuple[str, str], tuple[Warehouse, set[str]]] = {}


def new_warehouse(spark: SparkSession, sf_dir: str, database: str, **options) -> Warehouse:
    return Warehouse(
        spark,
        source=lambda: rank_observations(spark, sf_dir),
        database=database,
        location=fresh_path(spark, database),
        clean_options={"tie_breakers": TIE_BREAKERS},
        features=CHECKED_FEATURES,
        **options,
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    with _building:
        return _built_table(spark, sf_dir, name)


def _built_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        warehouse = new_warehouse(spark, sf_dir, f"rankhouse_{len(_warehouses)}")
        create_database(spark, warehouse.database, warehouse.location)
        _warehouses[key] = warehouse, set()
    warehouse, written = _warehouses[key]
    if name not in written:
        if name == "dwd_rank_facts":
            _built_table(spark, sf_dir, "ods_rank_facts")
        elif name == "dwd_newest_facts" or name.startswith("ads_"):
            _built_table(spark, sf_dir, "dwd_newest_facts" if name in OVER_NEWEST else "dwd_rank_facts")
        dict(warehouse.ods() + warehouse.dwd() + warehouse.ads())[name]()
        written.add(name)
    return read_layer(spark, warehouse.table(name))


def ods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer."""
    return _table(spark, sf_dir, "ods_rank_facts")


def dwd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned layer, bucketed by book."""
    return _table(spark, sf_dir, "dwd_rank_facts")


def newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of every book, narrow and bucketed."""
    return _table(spark, sf_dir, "dwd_newest_facts")


def ads(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A feature table."""
    return _table(spark, sf_dir, name)
