"""Table jobs and file-based variants: what they leave behind, read back."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from registry import fixtures as fx
from registry.base import BRONZE_SQL, EV_SQL, R, bronze, dicts, ev, query, rounded
from registry.storage import _BASE, _CATALOG_CTE, _listing
from tinderbox.operators import embedding
from tinderbox.plans import daily, silver
from tinderbox.session import new_dir
from tinderbox.sinks import writers
from tinderbox.sources import catalog, tables


@query(
    "listed_counts",
    f"""WITH b AS ({fx.duck(fx.BRONZE_COUNTS)})
    SELECT strptime(CAST(pub_date AS VARCHAR), '%Y%m%d')::DATE AS pub_date, num_articles, count_type,
      {R('reported_count')} AS reported_count, object_type, geo_id, geo_full_name, geo_country_code, geo_feat_id,
      {R('geo_lat')} AS geo_lat, {R('geo_lon')} AS geo_lon,
      array_to_string(list_transform(string_split(event_ids, ','), lambda x: coalesce(try_cast(x AS BIGINT), -1)), '|') AS event_ids,
      replace(sources, ';', '|') AS sources, replace(source_urls, '<UDIV>', '|') AS source_urls FROM b""",
)
def _(spark, d):
    rows = silver.listed_counts(fx.view(spark, d, fx.BRONZE_COUNTS)).drop("geo_adm1_code")
    lists = {c: F.array_join(F.col(c).cast("array<string>"), "|") for c in ("event_ids", "sources", "source_urls")}
    return rounded(rows.withColumns(lists))


@query(
    "dated_events",
    f"""WITH {BRONZE_SQL} SELECT ev_id, strptime(CAST(ev_date AS VARCHAR), '%Y%m%d')::DATE AS ev_date,
      strptime(CAST(date_added AS VARCHAR), '%Y%m%d')::DATE AS date_added, ev_code, source_url FROM b""",
)
def _(spark, d):
    return silver.dated_events(bronze(spark, d)).select("ev_id", "ev_date", "date_added", "ev_code", "source_url")


@query(
    "training_windows",
    f"""WITH {BRONZE_SQL}, e AS (SELECT ev_id, strptime(CAST(date_added AS VARCHAR), '%Y%m%d')::DATE AS day FROM b)
    SELECT DATE '1970-01-01' + CAST(floor((day - DATE '1970-01-01') / 10) * 10 AS INTEGER) AS window_start,
      count(*) AS n, CAST(sum(ev_id) AS BIGINT) AS ids, 8 AS dim FROM e GROUP BY 1""",
)
def _(spark, d):
    """The whole extract (a fraction of 1), as its folders hold it."""
    path = new_dir(spark, "training")
    events = silver.silver_events(bronze(spark, d), dicts(spark, d))
    daily.training_extract(events, path, embedding.hashed_words(8), 1.0)
    return spark.read.parquet(path).groupBy("window_start").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ev_id").alias("ids"), F.max(F.size("svp_embedding")).alias("dim")
    )


@query(
    "catalog_cache",
    f"""WITH {_CATALOG_CTE}, n AS (SELECT 'events' AS event_type, 2 AS loads)
    SELECT date_str, filename, size_mb, md5, full_url, event_type, loads FROM cat JOIN n USING (event_type)""",
)
def _(spark, d):
    """Read at once, after two hours and after four: loaded twice."""
    path, loads = new_dir(spark, "catalog"), []

    def load():
        loads.append(1)
        return catalog.parse_listing(_listing(spark, d), "events", _BASE)

    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    for hours in (0, 2, 4):
        files = catalog.cached_catalog(spark, path, load, start + timedelta(hours=hours))
    return files.withColumn("loads", F.lit(len(loads)))


@query(
    "table_exports",
    f"""WITH {EV_SQL}, c AS (SELECT country, count(*) AS n FROM ev GROUP BY 1)
    SELECT way, country, n FROM c, (VALUES ('swapped'), ('external'), ('exported'), ('stamped')) AS w(way)""",
)
def _(spark, d):
    """One table swapped in twice, registered from outside, exported from a view and dumped with a stamp."""
    counts = ev(spark, d).groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    tag = uuid.uuid4().hex
    for rows in (counts.where("n < 0"), counts):
        writers.swap_table(rows, f"swapped_{tag}")
    outside = new_dir(spark, "external")
    counts.write.parquet(outside)
    writers.external_table(spark, f"external_{tag}", outside, {"country": ("string", "its name"), "n": ("bigint", "events")})
    writers.refresh(spark, f"external_{tag}")
    counts.createOrReplaceTempView(f"view_{tag}")
    exported = new_dir(spark, "exported")
    writers.export_view(spark, f"view_{tag}", exported)
    stamped = writers.dump_stamped(counts, new_dir(spark, "stamped"), "counts")
    ways = {"swapped": f"swapped_{tag}", "external": f"external_{tag}", "exported": exported, "stamped": stamped}
    frames = [tables.scan_table(spark, where).select(F.lit(way).alias("way"), "country", "n") for way, where in ways.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
