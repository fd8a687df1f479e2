"""Query registry: name -> (Spark plan over a build, optional independent SQL oracle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from godown.plans.oracle import q as oracle_statement

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def portable(df: DataFrame) -> DataFrame:
    """Cast outputs to types every engine shares: dates as ISO text, decimals as double, integers as long."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType | T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.IntegerType | T.ShortType | T.ByteType):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    """Register ``fn(build) -> DataFrame`` under ``name``; ``sql`` is the SELECT after the oracle prelude."""
    def deco(fn):
        REGISTRY[name] = (fn, oracle_statement(sql) if sql else None)
        return fn
    return deco


_BUILDS: dict[tuple[str, str], object] = {}


def build_for(spark: SparkSession, sf_dir: str):
    """One build per application and data folder, so queries share its kept tables until ``release``."""
    from godown.plans.build import Pipeline
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILDS:
        _BUILDS[key] = Pipeline(spark, sf_dir)
    return _BUILDS[key]


def release(spark: SparkSession, sf_dir: str | None = None) -> None:
    """Forget the builds of this application (of one folder, or all): kept tables are given up, changed data is read anew."""
    for key in [k for k in _BUILDS if k[0] == spark.sparkContext.applicationId and sf_dir in (None, k[1])]:
        _BUILDS.pop(key).release()


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = REGISTRY[name][0]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(build_for(spark, sf_dir)))

    run.__name__ = name
    return run
