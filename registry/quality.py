"""Column profiles and diagnosis of raw lines."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import fixtures as fx
from registry.base import EV_SQL, R, ev, query, rounded
from tinderbox.operators import quality as Q
from tinderbox.operators.profiles import profile_of, refresh_profiles
from tinderbox.session import new_dir
from tinderbox.sources.delimited import cast_to, scan

_EV_COLUMNS = [
    "ev_id", "date_added", "ev_date", "geo_key", "country", "state", "ev_root_code", "quad_class",
    "gstein_scale", "num_mentions", "avg_tone", "lat", "lon", "source_url",
]


@query(
    "null_pcts",
    f"WITH {EV_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {R(f'sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*)')} AS pct_nulls FROM ev"""
        for c in _EV_COLUMNS
    ),
)
def _(spark, d):
    return rounded(Q.null_percentages(ev(spark, d).select(*_EV_COLUMNS)))


_PROFILED = ["gstein_scale", "num_mentions", "num_articles", "avg_tone", "lat", "lon"]


@query(
    "column_profile",
    f"WITH {EV_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS nulls,
        {R(f'min({c})')} AS min, {R(f'max({c})')} AS max, {R(f'avg({c})')} AS mean,
        {R(f'stddev_samp({c})')} AS std FROM ev"""
        for c in _PROFILED
    )
    + f""" UNION ALL SELECT 'log_num_sources', count(num_sources), count(*) - count(num_sources),
        {R('min(ln(num_sources))')}, {R('max(ln(num_sources))')}, {R('avg(ln(num_sources))')},
        {R('stddev_samp(ln(num_sources))')} FROM ev""",
)
def _(spark, d):
    rows = Q.log_column(ev(spark, d).select(*_PROFILED, "num_sources"), "num_sources")
    return rounded(Q.profile(rows).select("column", "n", "nulls", "min", "max", "mean", "std"))


# Damaged lines: an id too large, a word where a number belongs, a missing and an extra field.
_LINE = """CASE event_id % 11
  WHEN 0 THEN '9' || CAST(event_id AS {s}) || '0000000000000000000' || '\t' || event_type || '\t1.5'
  WHEN 1 THEN CAST(event_id AS {s}) || '\t' || event_type || '\tn/a'
  WHEN 2 THEN CAST(event_id AS {s}) || '\t' || event_type
  WHEN 3 THEN CAST(event_id AS {s}) || '\t' || event_type || '\t2.5\textra'
  ELSE CAST(event_id AS {s}) || '\t' || event_type || '\t' || CAST(user_id AS {s}) || '.25' END"""
_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("score", T.FloatType()),
    ]
)


def _lines(spark, d):
    line = F.expr(_LINE.format(s="STRING").replace("\t", "\\t"))
    return fx.table(spark, d, "events").select("event_id", line.alias("value"))


@query(
    "faulty_rows",
    f"""WITH l AS (SELECT event_id, {_LINE.format(s='VARCHAR')} AS value FROM events),
    p AS (SELECT *, string_split(value, chr(9)) AS f FROM l)
    SELECT event_id, value FROM p WHERE len(f) <> 3 OR try_cast(f[1] AS BIGINT) IS NULL
      OR try_cast(f[3] AS FLOAT) IS NULL""",
)
def _(spark, d):
    return Q.faulty_rows(_lines(spark, d), _SCHEMA)


@query(
    "field_count_hist",
    f"""WITH l AS (SELECT event_id % 7 AS file, {_LINE.format(s='VARCHAR')} AS value FROM events)
    SELECT file, CAST(len(string_split(value, chr(9))) AS INTEGER) AS n_fields, count(*) AS n_lines
    FROM l GROUP BY 1, 2""",
)
def _(spark, d):
    lines = _lines(spark, d).withColumn("file", F.col("event_id") % 7)
    return Q.field_count_histogram(lines, "file")


_TOLERANT = f"""WITH l AS (SELECT {_LINE.format(s='VARCHAR')} AS value FROM events),
    p AS (SELECT string_split(value, chr(9)) AS f FROM l)
    SELECT try_cast(f[1] AS BIGINT) AS id, f[2] AS kind, {R('try_cast(f[3] AS FLOAT)')} AS score FROM p"""


@query("tolerant_scan", _TOLERANT)
def _(spark, d):
    folder = new_dir(spark, "lines")
    _lines(spark, d).select("value").write.text(folder)
    return rounded(scan(spark, folder, _SCHEMA))


@query("tolerant_cast", _TOLERANT)
def _(spark, d):
    f = F.split("value", "\t")
    cells = [F.get(f, F.lit(i)).alias(n) for i, n in enumerate(("id", "kind", "score"))]
    return rounded(cast_to(_lines(spark, d).select(*cells), _SCHEMA))


_NUMBERS = ["geo_key", "quad_class", "gstein_scale", "num_mentions", "avg_tone", "lat", "lon"]
_TEXTS = ["country", "state", "ev_root_code", "source_url"]
_WHOLE = ["geo_key", "quad_class", "num_mentions"]


def _profile_sql(c: str) -> str:
    number, sized = c in _NUMBERS, c in _TEXTS or c in _WHOLE
    moments = ", ".join(f"{R(f'{f}({c})')} AS {n}" if number else f"CAST(NULL AS DOUBLE) AS {n}" for f, n in (("min", "min"), ("max", "max"), ("avg", "mean"), ("stddev_samp", "std")))
    lengths = ", ".join(f"CAST({f}(length(CAST({c} AS VARCHAR))) AS INTEGER) AS {f}_length" if sized else f"CAST(NULL AS INTEGER) AS {f}_length" for f in ("min", "max"))
    return f"""SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS nulls, {lengths}, {moments},
      true AS distinct_close, {'true' if number else 'CAST(NULL AS BOOLEAN)'} AS quartiles_close FROM ev"""


@query("column_profile_days", f"WITH {EV_SQL} " + " UNION ALL ".join(_profile_sql(c) for c in _NUMBERS + _TEXTS))
def _(spark, d):
    """All of a profile's columns, merged from days stored in two steps, one day twice. Distinct counts must lie within 6 % of the
    true ones, and a twentieth of the rows at most between a quartile and the true one."""
    path, rows = new_dir(spark, "profiles"), ev(spark, d).select("date_added", *_NUMBERS, *_TEXTS)
    days = sorted(r[0] for r in rows.select("date_added").distinct().collect())
    for some in (days[:12], days[11:]):
        refresh_profiles(rows.where(F.col("date_added").isin(some)), path, "date_added", some)
    out = profile_of(spark, path)
    entries = [
        F.struct(
            F.lit(c).alias("column"), F.count_distinct(c).alias("distinct"),
            *[(F.percentile(F.col(c), q) if c in _NUMBERS else F.lit(None).cast("double")).alias(f"p{i}") for i, q in enumerate((0.2, 0.25, 0.3, 0.45, 0.5, 0.55, 0.7, 0.75, 0.8))],
        )
        for c in _NUMBERS + _TEXTS
    ]
    true = rows.agg(F.array(*entries).alias("e")).select(F.explode("e").alias("e")).select("e.*")
    within = [F.col(q).between(F.col(f"p{3 * i}"), F.col(f"p{3 * i + 2}")) for i, q in enumerate(("q25", "q50", "q75"))]
    near = F.abs(F.col("approx_distinct") - F.col("distinct")) <= 0.06 * F.col("distinct")
    sized = F.col("column").isin(_TEXTS + _WHOLE)
    return rounded(out.join(true, "column").select(
        "column", "n", "nulls", *[F.when(sized, F.col(c)).alias(c) for c in ("min_length", "max_length")], "min", "max", "mean", "std",
        near.alias("distinct_close"), (within[0] & within[1] & within[2]).alias("quartiles_close"),
    ))
