"""Top-k, dedupe, frequencies and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import fixtures as fx
from registry.base import EV_SQL, R, bronze, ev, query, rounded
from registry.indicators import HEAT_CTE, hot_events
from tinderbox.operators import aggregates as A
from tinderbox.operators import frequency as Q
from tinderbox.operators import ranking as K
from tinderbox.operators import sampling as S
from tinderbox.functions.scalars import split_list
from tinderbox.plans import gold

_TOP = f"""{HEAT_CTE}, u AS (SELECT *, row_number() OVER (PARTITION BY date_added, geo_zone, source_url
      ORDER BY heat_indicator DESC, ev_id) AS per_url FROM heat WHERE geo_zone IS NOT NULL AND geo_zone <> ''),
  z AS (SELECT *, row_number() OVER (PARTITION BY date_added, geo_zone
      ORDER BY heat_indicator DESC, ev_id) AS heat_rank FROM u WHERE per_url = 1),
  top AS (SELECT * FROM z WHERE heat_rank <= 3)"""


@query(
    "top_heated",
    f"""WITH {_TOP} SELECT date_added, geo_zone, source_url, ev_id,
      {R('heat_indicator')} AS heat_indicator, CAST(heat_rank AS BIGINT) AS heat_rank FROM top""",
)
def _(spark, d):
    top = K.hottest_events(hot_events(spark, d), 3)
    return rounded(
        top.select("date_added", "geo_zone", "source_url", "ev_id", "heat_indicator", "heat_rank")
    )


@query(
    "top_heated_urls",
    f"""WITH {_TOP}, f AS (SELECT *, row_number() OVER (PARTITION BY source_url
        ORDER BY heat_indicator DESC, ev_id) AS rn FROM top)
    SELECT source_url, date_added, geo_zone, ev_id, {R('heat_indicator')} AS heat_indicator,
      substr(sha256(source_url), 1, 32) AS url_hash FROM f WHERE rn = 1""",
)
def _(spark, d):
    top = K.hottest_urls(hot_events(spark, d), 3)
    return rounded(
        top.select("source_url", "date_added", "geo_zone", "ev_id", "heat_indicator", "url_hash")
    )


@query(
    "url_wishlist",
    f"""WITH g AS ({fx.duck(fx.BRONZE_GKG)}),
    x AS (SELECT event_id, pub_date, num_articles,
        unnest(list_distinct(string_split(source_urls, '<UDIV>'))) AS url FROM g),
    r AS (SELECT *, substr(sha256(url), 1, 32) AS url_hash, row_number() OVER (
        PARTITION BY url ORDER BY pub_date DESC, event_id DESC) AS rn FROM x)
    SELECT url_hash, url, event_id, pub_date, num_articles FROM r WHERE rn = 1""",
)
def _(spark, d):
    records = fx.view(spark, d, fx.BRONZE_GKG).select(
        "event_id", "pub_date", "num_articles",
        split_list(F.col("source_urls"), "<UDIV>").alias("source_urls"),
    )
    return K.url_wishlist(records, "source_urls", [F.col("pub_date").desc(), F.col("event_id").desc()])


_NAMES = f"n AS (SELECT action_geo_full_name AS geo_full_name, count(*) AS cnt FROM ({fx.duck(fx.BRONZE_EVENTS)}) GROUP BY 1)"


def _names(spark, d):
    return A.partition_counts(
        bronze(spark, d).withColumnRenamed("action_geo_full_name", "geo_full_name"), "geo_full_name"
    )


@query(
    "top_geo_names",
    f"""WITH {_NAMES} SELECT geo_full_name, cnt FROM n
    ORDER BY cnt DESC, geo_full_name NULLS FIRST LIMIT 20""",
)
def _(spark, d):
    return K.top_by_count(_names(spark, d), "geo_full_name", 20)


@query(
    "cum_coverage",
    f"""WITH {_NAMES}, m AS (SELECT * FROM n WHERE geo_full_name IS NOT NULL)
    SELECT geo_full_name, cnt, {R('cnt / (SELECT sum(cnt) FROM m)')} AS fraction,
      {R('''sum(cnt) OVER (ORDER BY cnt DESC, substr(md5(geo_full_name), 1, 3), geo_full_name
        ROWS UNBOUNDED PRECEDING) / (SELECT sum(cnt) FROM m)''')} AS fraction_cumsum FROM m""",
)
def _(spark, d):
    known = _names(spark, d).where("geo_full_name IS NOT NULL")
    return rounded(Q.cumulative_share(known, "geo_full_name"))


@query(
    "place_name_table",
    f"""WITH {_NAMES}, t AS (SELECT *, coalesce('=' || geo_full_name, 'null') AS k FROM n)
    SELECT geo_full_name, cnt, {R('ln(1 + cnt)')} AS log_1p_cnt, {R('cnt / sum(cnt) OVER ()')} AS fraction,
      {R("""sum(cnt) OVER (ORDER BY cnt DESC, substr(md5(k), 1, 3), k ROWS UNBOUNDED PRECEDING)
        / sum(cnt) OVER ()""")} AS fraction_cumsum FROM t""",
)
def _(spark, d):
    return rounded(gold.place_names(bronze(spark, d)))


@query(
    "word_coverage",
    f"""WITH w AS (SELECT unnest(string_split_regex(text, '[^A-Za-z]+')) AS word FROM documents),
    n AS (SELECT word, count(*) AS cnt FROM w WHERE word <> '' GROUP BY 1)
    SELECT word, cnt, {R('cnt / (SELECT sum(cnt) FROM n)')} AS fraction,
      {R('''sum(cnt) OVER (ORDER BY cnt DESC, substr(md5(word), 1, 3), word
        ROWS UNBOUNDED PRECEDING) / (SELECT sum(cnt) FROM n)''')} AS fraction_cumsum FROM n""",
)
def _(spark, d):
    words = fx.table(spark, d, "documents").select(F.explode(F.split("text", "[^A-Za-z]+")).alias("word"))
    counts = A.partition_counts(words.where("word <> ''"), "word")
    return rounded(Q.cumulative_share(counts, "word"))


_FREQ = f"""{EV_SQL}, f AS (SELECT coalesce(country, '__NULL__') AS value, count(*) AS cnt FROM ev GROUP BY 1),
  t AS (SELECT sum(cnt) AS total, count(*) AS n FROM f)"""


def _other(kept: str) -> str:
    return f"""SELECT value, {R('cnt * 100.0 / (SELECT total FROM t)')} AS pct FROM {kept}
    UNION ALL SELECT '*OTHER* (' || CAST((SELECT n FROM t) - (SELECT count(*) FROM {kept}) AS VARCHAR)
      || ' distinct values)', {R(f'''((SELECT total FROM t) - (SELECT sum(cnt) FROM {kept})) * 100.0
      / (SELECT total FROM t)''')}"""


@query(
    "top_frequent",
    f"""WITH {_FREQ}, k AS (SELECT * FROM f ORDER BY cnt DESC, value LIMIT 7) {_other('k')}""",
)
def _(spark, d):
    return rounded(Q.top_frequent(ev(spark, d), "country", top=7))


@query(
    "top_frequent_pct",
    f"""WITH {_FREQ}, c AS (SELECT value, cnt, sum(cnt) OVER (ORDER BY cnt DESC,
        substr(md5(value), 1, 3), value ROWS UNBOUNDED PRECEDING) - cnt AS before FROM f),
    k AS (SELECT * FROM c WHERE before * 100.0 < 60.0 * (SELECT total FROM t)) {_other('k')}""",
)
def _(spark, d):
    return rounded(Q.top_frequent(ev(spark, d), "country", total_pct=60.0))


@query(
    "sample_exact",
    """WITH h AS (SELECT *, md5('7|' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id) AS rn,
      count(*) OVER (PARTITION BY source) AS n FROM h)
    SELECT doc_id, source, n_chars FROM r WHERE rn <= floor(n * 0.3)""",
)
def _(spark, d):
    docs = fx.table(spark, d, "documents").select("doc_id", "source", "n_chars")
    return S.sample_exact(docs, "source", "doc_id", 0.3, seed=7)


@query("sample_fraction")
def _(spark, d):
    return S.sample_fraction(ev(spark, d), 0.1, seed=0).select("ev_id", "date_added")


@query(
    "heavy_words",
    f"""WITH w AS (SELECT unnest(string_split_regex(text, '[^A-Za-z]+')) AS word FROM documents)
    SELECT word AS value, count(*) AS cnt, {R("count(*) * 100.0 / (SELECT count(*) FROM w WHERE word <> '')")} AS pct
    FROM w WHERE word <> '' GROUP BY 1 ORDER BY cnt DESC, value LIMIT 25""",
)
def _(spark, d):
    """Totals of two halves add up; a few words stand out, so the others are not counted one by one."""
    words = fx.table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "[^A-Za-z]+")).alias("word")).where("word <> ''")
    parts = [Q.bucket_totals(words.where(F.col("doc_id") % 2 == k), "word") for k in (0, 1)]
    totals = parts[0].unionByName(parts[1]).groupBy("bucket").agg(F.sum("total").alias("total"))
    return rounded(Q.heavy_hitters(words, "word", 25, totals=totals))


@query(
    "heavy_urls",
    f"""WITH {EV_SQL} SELECT source_url AS value, count(*) AS cnt, {R("count(*) * 100.0 / (SELECT count(*) FROM ev)")} AS pct
    FROM ev GROUP BY 1 ORDER BY cnt DESC, value LIMIT 10""",
)
def _(spark, d):
    """All urls are about as frequent, so bucket totals can't tell them apart and all are counted."""
    return rounded(Q.heavy_hitters(ev(spark, d), "source_url", 10, buckets=64))
