"""Registry of queries."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Lazily read tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        raise AttributeError(name)


@dataclass(frozen=True)
class Plan:
    name: str
    build: Callable[[Tables], DataFrame]
    covers: tuple[str, ...]
    sql: str | None = None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


PLANS: dict[str, Plan] = {}

_MODULES = (
    "tables", "cleaning", "joins", "aggregates", "windows", "reshape", "scoring", "flags",
    "headtohead", "fits", "material", "genotype", "grid", "binning", "advancement", "fitted", "portfolio", "attribution",
)


def plan(covers: str, sql: str | None = None):
    """Register a query under its function's name; ``covers`` lists operator ids."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if build.__name__ in PLANS:
            raise ValueError(f"duplicate plan {build.__name__}")
        PLANS[build.__name__] = Plan(build.__name__, build, tuple(covers.split()), sql)
        return build

    return register


def load_all() -> dict[str, Plan]:
    for name in _MODULES:
        importlib.import_module(f"trialspark.plans.{name}")
    return PLANS
