"""Windows, names, schemas, tolerant values, header checks and file samples over the given tables."""

from __future__ import annotations

import re
from datetime import date

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import functions as F

from registry import fixtures as fx
from registry.base import EV_SQL, R, ev, query, rounded
from tinderbox.functions import scalars
from tinderbox.operators import sampling
from tinderbox.operators import windows as W
from tinderbox.schemas import rename_all, struct_from_rows
from tinderbox.session import new_dir
from tinderbox.sources import delimited, dictionaries, tables

_NOW = date(2024, 1, 20)
_WINDOWS = {
    "given": W.job_window("2024-01-03", "2024-01-05", 9, _NOW), "lookback": W.job_window(None, "2024-01-05", "7", _NOW),
    "today": W.job_window("", None, "", _NOW), "values": W.window_from_values(None, date(2024, 1, 12), None, _NOW),
    "since": W.window_from_values(date(2024, 1, 15), None, 3, _NOW), "back": W.window_from_values(None, None, 4, _NOW),
}


@query(
    "job_windows",
    f"""WITH {EV_SQL}, w(way, low, high) AS (VALUES ('given', DATE '2024-01-03', DATE '2024-01-05'),
      ('lookback', DATE '2024-01-13', DATE '2024-01-20'), ('today', DATE '2024-01-20', DATE '2024-01-20'),
      ('values', DATE '2024-01-19', DATE '2024-01-12'), ('since', DATE '2024-01-15', DATE '2024-01-20'),
      ('back', DATE '2024-01-16', DATE '2024-01-20'))
    SELECT way, date_added, count(*) AS n FROM ev JOIN w ON date_added BETWEEN low AND high GROUP BY 1, 2""",
)
def _(spark, d):
    days = ev(spark, d).groupBy("date_added").agg(F.count(F.lit(1)).alias("n"))
    out = None
    for way, (low, high) in _WINDOWS.items():
        part = W.in_window(days, "date_added", low, high).select(F.lit(way).alias("way"), "date_added", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "renamed_columns",
    """SELECT event_id AS global_event_id, user_id AS actor1_country_code, event_type AS action_geo_adm1_code,
      value AS tone, 1 AS is_root_event FROM events""",
)
def _(spark, d):
    """Names from a header in capitals, one of them by hand."""
    raw = fx.table(spark, d, "events").select(
        F.col("event_id").alias("GlobalEventID"), F.col("user_id").alias("Actor1CountryCode"),
        F.col("event_type").alias("ActionGeo_ADM1Code"), F.col("value").alias("AvgTone"), F.lit(1).alias("IsRootEvent"),
    )
    return raw.toDF(*rename_all(raw.columns, {"AvgTone": "tone"}))


_SCHEMA_ROWS = [
    {"column": "OrderKey", "col_renamed": "", "data_type": "INTEGER"},
    {"column": "OrderStatus", "col_renamed": "status", "data_type": "STRING"},
    {"column": "TotalPrice", "col_renamed": None, "data_type": "FLOAT"},
]


@query(
    "schema_from_rows",
    f"SELECT CAST(o_orderkey AS BIGINT) AS order_key, o_orderstatus AS status, {R('o_totalprice')} AS total_price FROM orders",
)
def _(spark, d):
    """A folder of lines, read with the schema that rows of a schema file describe."""
    folder = new_dir(spark, "orders")
    rows = fx.table(spark, d, "orders").select(F.concat_ws("\t", "o_orderkey", "o_orderstatus", "o_totalprice"))
    rows.write.text(folder)
    read = delimited.scan(spark, folder, struct_from_rows(_SCHEMA_ROWS))
    return rounded(read.withColumn("order_key", F.col("order_key").cast("long")))


_CELL = """CASE event_id % 6 WHEN 0 THEN CAST(event_id AS {s}) WHEN 1 THEN ' -' || CAST(user_id AS {s}) || ' '
  WHEN 2 THEN event_type WHEN 3 THEN '' WHEN 4 THEN CAST(event_id AS {s}) || '0000000000000000000' END"""


@query(
    "int_or_default",
    f"""WITH c AS (SELECT event_id, {_CELL.format(s='VARCHAR')} AS cell FROM events)
    SELECT event_id, try_cast(trim(cell) AS BIGINT) AS plain, coalesce(try_cast(trim(cell) AS BIGINT), -1) AS filled,
      cell IS NOT NULL AND cell <> '' AS is_filled FROM c""",
)
def _(spark, d):
    cells = fx.table(spark, d, "events").select("event_id", F.expr(_CELL.format(s="STRING")).alias("cell"))
    return cells.select(
        "event_id", scalars.int_or(F.col("cell")).alias("plain"), scalars.int_or(F.col("cell"), -1).alias("filled"),
        scalars.filled(F.col("cell")).alias("is_filled"),
    )


_MAYBE = "CASE event_id % 4 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN NULL ELSE value END"


@query("present_values", f"SELECT event_type, count(*) FILTER (x IS NOT NULL AND NOT isnan(x)) AS n FROM (SELECT event_type, {_MAYBE} AS x FROM events) GROUP BY 1")
def _(spark, d):
    rows = fx.table(spark, d, "events").select("event_type", F.expr(_MAYBE).alias("x"))
    return rows.groupBy("event_type").agg(F.count_if(scalars.present(F.col("x"))).alias("n"))


@query(
    "dictionary_headers",
    """SELECT name, code, description FROM (SELECT n_name AS code, CAST(n_regionkey AS VARCHAR) AS description FROM nation),
      (VALUES ('cameo_actor_type'), ('cameo_country')) AS t(name)
    UNION ALL SELECT 'cameo_event', 'refused', 'ValueError'""",
)
def _(spark, d):
    """Raw files of three dictionaries under one header, which is declared for two of them."""
    folder = new_dir(spark, "dictionary")
    rows = fx.table(spark, d, "nation").select(F.concat_ws("\t", "n_name", "n_regionkey").alias("line"), F.lit(1).alias("at"))
    first = spark.range(1).select(F.lit("CODE\tLABEL").alias("line"), F.lit(0).alias("at"))
    rows.unionByName(first).coalesce(1).sortWithinPartitions("at", "line").select("line").write.text(folder)
    out = []
    for name in ("cameo_actor_type", "cameo_country", "cameo_event"):
        try:
            read = dictionaries.standardize(spark, name, folder)
            out.append(read.toDF("code", "description").select(F.lit(name).alias("name"), "code", "description"))
        except ValueError as err:
            out.append(spark.range(1).select(F.lit(name).alias("name"), F.lit("refused").alias("code"), F.lit(type(err).__name__).alias("description")))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(
    "file_sample",
    f"""WITH {EV_SQL} SELECT date_added, count(*) AS n FROM ev
      WHERE date_added BETWEEN DATE '2024-01-06' AND DATE '2024-01-15' GROUP BY 1""",
)
def _(spark, d):
    """Files of five days each, named by first and last day; those with a bound from the 7th to the 13th are sampled whole."""
    folder = new_dir(spark, "samples")
    store, base = pafs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", folder))
    store.create_dir(base)

    def write(batches):
        for pdf in batches:
            for first, part in pdf.groupby("first"):
                days = [date.fromordinal(first + k).strftime("%Y%m%d") for k in (0, 4)]
                # A batch is at most one part of a window, so its file carries the smallest id too.
                name = f"{base}/{'-'.join(days)}.export.{part['ev_id'].min()}.parquet"
                pq.write_table(pa.Table.from_pandas(part[["ev_id", "date_added"]], preserve_index=False), name, filesystem=store)
            yield pdf[["ev_id"]]

    start = date(2024, 1, 1).toordinal()
    day = F.datediff("date_added", F.lit(date(2024, 1, 1)))
    first = (F.lit(start) + F.floor(day / 5) * 5).cast("int").alias("first")
    rows = ev(spark, d).select("ev_id", "date_added", first).repartition("first")
    rows.mapInPandas(write, "ev_id long").write.format("noop").mode("overwrite").save()
    sample = tables.sample_files(spark, folder, "export", date(2024, 1, 7), date(2024, 1, 13), 1.0)
    return sample.groupBy("date_added").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sample_fraction_bounds",
    "SELECT event_type, count(*) AS n, true AS near_a_tenth, true AS repeatable, CAST(0 AS BIGINT) AS strangers FROM events GROUP BY 1",
)
def _(spark, d):
    """A tenth of each type, give or take six standard deviations; the same rows again; no others."""
    events = fx.table(spark, d, "events").select("event_id", "event_type")
    drawn, again = (sampling.sample_fraction(events, 0.1, seed=5).select("event_id", F.lit(1).alias(c)) for c in ("a", "b"))
    both = drawn.join(again, "event_id", "full")
    strangers = both.join(events, "event_id", "left_anti").agg(F.count(F.lit(1))).scalar()
    marked = events.join(both, "event_id", "left")
    n, k = F.count(F.lit(1)), F.count("a")
    return marked.groupBy("event_type").agg(
        n.alias("n"), (F.abs(k - n * 0.1) <= 6 * F.sqrt(n * 0.09)).alias("near_a_tenth"),
        F.every(F.col("a").eqNullSafe(F.col("b"))).alias("repeatable"),
    ).withColumn("strangers", strangers)
