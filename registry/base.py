"""Registration of queries together with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import fixtures as fx
from tinderbox import schemas
from tinderbox.functions.scalars import r6
from tinderbox.plans.silver import Dictionaries
from tinderbox.session import tune
from tinderbox.sources import dictionaries as dic

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where it can be stated, the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def ev(spark: SparkSession, d: str) -> DataFrame:
    return fx.view(spark, d, fx.EV)


def bronze(spark: SparkSession, d: str, spread: bool = False) -> DataFrame:
    return fx.view(spark, d, fx.BRONZE_EVENTS, spread)


def dicts(spark: SparkSession, d: str) -> Dictionaries:
    return Dictionaries(
        fips_country=fx.view(spark, d, fx.FIPS),
        cameo_event=fx.view(spark, d, fx.EVENT_CODE),
        quad_classes=dic.quad_classes(spark),
        cameo_actor_type=fx.view(spark, d, fx.ACTOR_TYPE),
        geo_type=dic.geo_types(spark),
        cameo_country=fx.view(spark, d, fx.ACTOR_COUNTRY),
    )


def rounded(df: DataFrame) -> DataFrame:
    """Floating columns as doubles with six digits, the form both engines are compared in."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        is_float = f.dataType.typeName() in ("float", "double")
        out.append(r6(c.cast("double")).alias(f.name) if is_float else c)
    return df.select(*out)


def R(expr: str) -> str:
    """SQL text of `rounded` for one expression."""
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0e0)"


def _values(rows: list[tuple], names: str) -> str:
    body = ", ".join(f"({k}, '{v}')" for k, v in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({names})"


EV_SQL = f"ev AS ({fx.duck(fx.EV)})"
BRONZE_SQL = f"b AS ({fx.duck(fx.BRONZE_EVENTS)})"
DICT_SQL = f"""
fips AS ({fx.duck(fx.FIPS)}), codes AS ({fx.duck(fx.EVENT_CODE)}),
atype AS ({fx.duck(fx.ACTOR_TYPE)}), acountry AS ({fx.duck(fx.ACTOR_COUNTRY)}),
quad AS ({_values(schemas.QUAD_CLASSES, 'quad_class, ev_desc')}),
gtype AS ({_values(schemas.GEO_TYPES, 'geo_type, geo_type_desc')})"""
