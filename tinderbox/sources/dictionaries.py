"""Code dictionaries: two columns, code and description."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tinderbox import schemas
from tinderbox.operators.enrich import unique_codes


@dataclass(frozen=True)
class DictionarySpec:
    """Names of a dictionary's columns and how its raw file looks."""

    key: str
    value: str
    header: tuple[str, str] | None
    sep: str = "\t"
    key_type: str = "string"


# File layouts. Codes stay text because of their leading zeros.
DICTIONARIES = {
    "quad_classes": DictionarySpec(
        "quad_class", "ev_desc", ("QUADCLASS", "DESCRIPTION"), ",", "int"
    ),
    "cameo_event": DictionarySpec("ev_code", "ev_desc", ("CAMEOEVENTCODE", "EVENTDESCRIPTION")),
    "cameo_actor_type": DictionarySpec("a_type_code", "a_type_desc", ("CODE", "LABEL")),
    "fips_country": DictionarySpec("fips_country_code", "country_name", None),
    "cameo_country": DictionarySpec("cameo_country_code", "country_name", ("CODE", "LABEL")),
    "geo_type": DictionarySpec("geo_type", "geo_type_desc", ("GEO_TYPE", "DESCRIPTION"), ",", "int"),
}


def _read(spark: SparkSession, path: str, spec: DictionarySpec, sep: str) -> DataFrame:
    schema = f"{spec.key} string, {spec.value} string"
    reader = spark.read.schema(schema).option("sep", sep).option("quote", '"')
    return reader.csv(path).withColumn("__pos", F.monotonically_increasing_id())


def standardize(
    spark: SparkSession, name: str, path: str, amend_path: str | None = None
) -> DataFrame:
    """Raw dictionary file (plus amendments, which come last) -> unique codes.

    The header row, where there is one, must read as declared.
    """
    spec = DICTIONARIES[name]
    rows = _read(spark, path, spec, spec.sep)
    if spec.header is not None:
        found = rows.orderBy("__pos").first()
        if found is None or (found[0], found[1]) != spec.header:
            raise ValueError(f"{name}: header is {found and tuple(found[:2])}, not {spec.header}")
        rows = rows.where(~((F.col(spec.key) == spec.header[0]) & (F.col(spec.value) == spec.header[1])))
    if amend_path is not None:
        extra = _read(spark, amend_path, spec, ",")
        names = extra.orderBy("__pos").first()
        if names is None or (names[0], names[1]) != (spec.key, spec.value):
            raise ValueError(f"{name}: amendment must have columns {spec.key}, {spec.value}")
        later = F.col("__pos") + F.lit(2**62)
        extra = extra.where(F.col(spec.key) != spec.key).withColumn("__pos", later)
        rows = rows.unionByName(extra)
    unique = unique_codes(rows, spec.key, spec.value, "__pos")
    return unique.withColumn(spec.key, F.col(spec.key).try_cast(spec.key_type))


def load(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Standardized dictionary (quoted, comma-separated, with header)."""
    spec = DICTIONARIES[name]
    rows = (
        spark.read.schema(f"{spec.key} string, {spec.value} string")
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )
    return rows.withColumn(spec.key, F.col(spec.key).try_cast(spec.key_type))


def _stated(spark: SparkSession, rows: list[tuple[int, str]], key: str, value: str) -> DataFrame:
    """A relation of known size, so that a join with it never shuffles the other side."""
    body = ", ".join(f"({int(k)}, '{v}')" for k, v in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({key}, {value})")


def quad_classes(spark: SparkSession) -> DataFrame:
    return _stated(spark, schemas.QUAD_CLASSES, "quad_class", "ev_desc")


def geo_types(spark: SparkSession) -> DataFrame:
    return _stated(spark, schemas.GEO_TYPES, "geo_type", "geo_type_desc")
