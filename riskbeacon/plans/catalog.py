"""Registry of named queries: a Spark builder and (when SQL can express it) a
DuckDB oracle string. ``__spark_entry__`` exposes both maps.

Conventions shared by both sides: every computed column is aliased, doubles
are rounded to 6 decimals, counts are BIGINT, dates are DATE or
``yyyy-MM-dd`` strings.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


@dataclass
class QuerySpec:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: list[str] = field(default_factory=list)
    bench: bool = False


REGISTRY: dict[str, QuerySpec] = {}


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def sql_rounded(sql: str, doubles: list[str], digits: int = 6) -> str:
    if not doubles:
        return sql
    rep = ", ".join(f'round(CAST("{c}" AS DOUBLE), {digits}) AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) q"


def register(name: str, sql: str | None = None, doubles: list[str] | None = None, bench: bool = False):
    def deco(fn):
        def build(spark, sf_dir, _fn=fn):
            return round_doubles(_fn(spark, sf_dir))
        REGISTRY[name] = QuerySpec(name, build, sql_rounded(sql, doubles or []) if sql else None,
                                   list(doubles or []), bench)
        return fn
    return deco


def load_all() -> dict[str, QuerySpec]:
    # Importing the query modules fills the registry.
    from riskbeacon.plans import queries  # noqa: F401
    return REGISTRY
