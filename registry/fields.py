"""Scalar functions, nested field parsers, sentences, prompts and completions."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import fixtures as fx
from registry.base import EV_SQL, R, bronze, dicts, ev, query, rounded
from registry.relational import SILVER_CTE
from tinderbox.functions import feed_fields, scalars, text
from tinderbox.operators import series
from tinderbox.plans import gold, silver
from tinderbox.schemas import TONE_FIELDS
from tinderbox.operators import aggregates as A

GKG_CTE = f"g AS ({fx.duck(fx.BRONZE_GKG)})"


def gkg(spark, d):
    return fx.view(spark, d, fx.BRONZE_GKG)


def _split(c: str, sep: str) -> str:
    cut = f"regexp_replace({c}, '{sep}$', '')"
    return f"array_to_string(string_split(nullif({cut}, ''), '{sep}'), '|') AS {c}"


@query(
    "split_list",
    f"""WITH {GKG_CTE} SELECT event_id, {_split('themes', ';')}, {_split('persons', ';')},
      {_split('organizations', ';')}, {_split('sources', ';')}, {_split('source_urls', '<UDIV>')} FROM g""",
)
def _(spark, d):
    seps = {"themes": ";", "persons": ";", "organizations": ";", "sources": ";", "source_urls": "<UDIV>"}
    return gkg(spark, d).select(
        "event_id",
        *[F.array_join(scalars.split_list(F.col(c), s), "|").alias(c) for c, s in seps.items()],
    )


@query(
    "event_id_list",
    f"""WITH {GKG_CTE}, x AS (SELECT event_id, unnest(string_split(event_ids, ',')) AS piece,
        generate_subscripts(string_split(event_ids, ','), 1) - 1 AS pos FROM g)
    SELECT event_id, CAST(pos AS INTEGER) AS pos, try_cast(piece AS BIGINT) AS id,
      coalesce(try_cast(piece AS BIGINT), -1) AS id_or_default FROM x""",
)
def _(spark, d):
    rows = gkg(spark, d).select(
        "event_id",
        F.posexplode(
            F.arrays_zip(
                scalars.split_ids(F.col("event_ids")).alias("id"),
                scalars.split_ids(F.col("event_ids"), default=-1).alias("id_or_default"),
            )
        ),
    )
    return rows.select("event_id", "pos", "col.id", "col.id_or_default")


@query(
    "int_date",
    """SELECT o_orderkey, CAST(try_strptime(CAST(n AS VARCHAR), '%Y%m%d') AS DATE) AS day FROM (
      SELECT o_orderkey, year(o_orderdate) * 10000 + (month(o_orderdate) + o_orderkey % 3) * 100
        + day(o_orderdate) AS n FROM orders)""",
)
def _(spark, d):
    when = F.col("o_orderdate")
    n = F.year(when) * 10000 + (F.month(when) + F.col("o_orderkey") % 3) * 100 + F.dayofmonth(when)
    return fx.table(spark, d, "orders").select("o_orderkey", scalars.int_date(n).alias("day"))


@query(
    "ensure_float",
    f"""WITH s AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN p_name
        WHEN 2 THEN CAST(p_size AS VARCHAR) || ',' || CAST(p_partkey AS VARCHAR) || '.5x'
        WHEN 3 THEN '#' || CAST(p_size AS VARCHAR) || '-1' ELSE CAST(p_size AS VARCHAR) || '.25' END AS v
      FROM part)
    SELECT p_partkey, v, {R('''coalesce(try_cast(nullif(v, '') AS DOUBLE),
      try_cast(nullif(regexp_replace(v, '[^0-9.-]', '', 'g'), '') AS DOUBLE))''')} AS number FROM s""",
)
def _(spark, d):
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    v = (
        F.when(key % 5 == 0, F.lit(""))
        .when(key % 5 == 1, F.col("p_name"))
        .when(key % 5 == 2, F.concat(size, F.lit(","), key.cast("string"), F.lit(".5x")))
        .when(key % 5 == 3, F.concat(F.lit("#"), size, F.lit("-1")))
        .otherwise(F.concat(size, F.lit(".25")))
    )
    named = fx.table(spark, d, "part").select("p_partkey", v.alias("v"))
    return rounded(named.withColumn("number", scalars.ensure_float(F.col("v"))))


@query(
    "extract_dates",
    f"""WITH {EV_SQL}, n AS (SELECT ev_id, CASE ev_id % 3
        WHEN 0 THEN strftime(date_added, '%Y%m%d') || '-' || strftime(ev_date, '%Y%m%d') || '.export.parquet'
        WHEN 1 THEN 'date=' || strftime(date_added, '%Y-%m-%d') || '/part'
        ELSE 'year 2024 of ' || CAST(ev_id AS VARCHAR) || ' 20241399' END AS name FROM ev),
    x AS (SELECT ev_id, unnest(regexp_extract_all(name, '[1-9][0-9]{{3}}-?[0-9]{{2}}-?[0-9]{{2}}')) AS piece FROM n)
    SELECT ev_id, CAST(try_strptime(replace(piece, '-', ''), '%Y%m%d') AS DATE) AS day FROM x
    WHERE try_strptime(replace(piece, '-', ''), '%Y%m%d') IS NOT NULL""",
)
def _(spark, d):
    compact = [F.date_format(c, "yyyyMMdd") for c in ("date_added", "ev_date")]
    name = (
        F.when(F.col("ev_id") % 3 == 0, F.concat(compact[0], F.lit("-"), compact[1], F.lit(".export.parquet")))
        .when(F.col("ev_id") % 3 == 1, F.concat(F.lit("date="), F.date_format("date_added", "yyyy-MM-dd"), F.lit("/part")))
        .otherwise(F.concat(F.lit("year 2024 of "), F.col("ev_id").cast("string"), F.lit(" 20241399")))
    )
    return ev(spark, d).select("ev_id", F.explode(scalars.extract_dates(name)).alias("day"))


@query(
    "file_names",
    f"""WITH {EV_SQL}, n AS (SELECT DISTINCT strftime(date_added, '%Y%m%d') || '.export.CSV'
        || CASE WHEN quad_class = 1 THEN '.sampled_0.1' ELSE '' END || '.zip' AS name FROM ev)
    SELECT name, split_part(name, '.', 1) AS date_str,
      regexp_extract(name, '(\\.sampled_[0-9.]+)\\.zip', 1) AS suffix FROM n""",
)
def _(spark, d):
    name = F.concat(
        F.date_format("date_added", "yyyyMMdd"), F.lit(".export.CSV"),
        F.when(F.col("quad_class") == 1, ".sampled_0.1").otherwise(""), F.lit(".zip"),
    )
    names = ev(spark, d).select(name.alias("name")).distinct()
    return names.select(
        "name", scalars.file_stamp(F.col("name")).alias("date_str"),
        scalars.sample_suffix(F.col("name")).alias("suffix"),
    )


@query(
    "parse_counts",
    f"""WITH {GKG_CTE}, x AS (SELECT event_id, unnest(list_filter(string_split(counts, ';'),
        lambda b: b <> '')) AS block FROM g),
    p AS (SELECT event_id, string_split(block, '#') AS f FROM x)
    SELECT event_id, f[1] AS "Type",
      CASE WHEN regexp_full_match(f[2], '[0-9]+') THEN try_cast(f[2] AS INTEGER) END AS "Count",
      f[3] AS "ObjectType",
      CASE f[4] WHEN '' THEN NULL WHEN '1' THEN 'COUNTRY' WHEN '2' THEN 'USSTATE' WHEN '3' THEN 'USCITY'
        WHEN '4' THEN 'WORLDCITY' WHEN '5' THEN 'WORLDSTATE' ELSE f[4] END AS "LocationType",
      f[5] AS "LocationName", f[6] AS "CountryCode", f[7] AS "ADM1Code",
      {R("try_cast(f[8] AS FLOAT)")} AS "Latitude", {R("try_cast(f[9] AS FLOAT)")} AS "Longitude",
      f[10] AS "LocationFeatureID" FROM p""",
)
def _(spark, d):
    entries = gkg(spark, d).select("event_id", F.explode(feed_fields.counts(F.col("counts"))).alias("e"))
    return rounded(entries.select("event_id", "e.*"))


@query(
    "parse_locations",
    f"""WITH {GKG_CTE}, x AS (SELECT event_id, unnest(list_filter(string_split(locations, ';'),
        lambda b: b <> '')) AS block FROM g),
    p AS (SELECT event_id, string_split(block, '#') AS f FROM x)
    SELECT event_id,
      CASE f[1] WHEN '' THEN NULL WHEN '1' THEN 'COUNTRY' WHEN '2' THEN 'USSTATE' WHEN '3' THEN 'USCITY'
        WHEN '4' THEN 'WORLDCITY' WHEN '5' THEN 'WORLDSTATE' ELSE f[1] END AS "LocationType",
      f[2] AS "LocationName", f[3] AS "CountryCode", f[4] AS "ADM1Code",
      {R("try_cast(f[5] AS FLOAT)")} AS "Latitude", {R("try_cast(f[6] AS FLOAT)")} AS "Longitude",
      f[7] AS "LocationFeatureID" FROM p""",
)
def _(spark, d):
    entries = gkg(spark, d).select("event_id", F.explode(feed_fields.locations(F.col("locations"))).alias("e"))
    return rounded(entries.select("event_id", "e.*"))


_TONE = ["Tone", "PositiveScore", "NegativeScore", "Polarity", "ActRefDensity", "SelfGroupRefDensity"]


@query(
    "parse_tone",
    f"""WITH {GKG_CTE}, p AS (SELECT event_id, string_split(tone_vec, ',') AS f FROM g)
    SELECT event_id, {', '.join(f'{R(f"try_cast(f[{i + 1}] AS FLOAT)")} AS "{n}"' for i, n in enumerate(_TONE))}
    FROM p""",
)
def _(spark, d):
    toned = gkg(spark, d).select("event_id", feed_fields.tone(F.col("tone_vec")).alias("t"))
    return rounded(toned.select("event_id", "t.*"))


@query(
    "silver_gkg",
    f"""WITH {GKG_CTE} SELECT event_id, pub_date, num_articles,
      CAST(CASE WHEN len(list_filter(string_split(counts, ';'), lambda b: b <> '')) > 0
        THEN len(list_filter(string_split(counts, ';'), lambda b: b <> '')) END AS INTEGER) AS n_counts,
      CAST(CASE WHEN len(list_filter(string_split(locations, ';'), lambda b: b <> '')) > 0
        THEN len(list_filter(string_split(locations, ';'), lambda b: b <> '')) END AS INTEGER) AS n_locations,
      {", ".join(R(f"try_cast(string_split(tone_vec, ',')[{i + 1}] AS FLOAT)") + f" AS {f.lower()}" for i, f in enumerate(TONE_FIELDS))},
      {_split('themes', ';')}, {_split('event_ids', ',')}, {_split('source_urls', '<UDIV>')},
      {_split('persons', ';')}, {_split('organizations', ';')}, {_split('sources', ';')} FROM g""",
)
def _(spark, d):
    s = silver.silver_gkg(gkg(spark, d))
    return rounded(
        s.select(
            "event_id", "pub_date", "num_articles", F.size("counts").alias("n_counts"),
            F.size("locations").alias("n_locations"), *[F.col(f"tone_vec.{f}").alias(f.lower()) for f in TONE_FIELDS],
            *[F.array_join(c, "|").alias(c) for c in ("themes", "event_ids", "source_urls", "persons", "organizations", "sources")],
        )
    )


@query(
    "flat_gkg",
    f"""WITH {GKG_CTE}, p AS (SELECT *, string_split(tone_vec, ',') AS f FROM g)
    SELECT CAST(try_strptime(CAST(pub_date AS VARCHAR), '%Y%m%d') AS DATE) AS pub_date, num_articles,
      {R("try_cast(f[1] AS FLOAT)")} AS tone_avg, {R("try_cast(f[2] AS FLOAT)")} AS tone_pct_pos,
      {R("try_cast(f[3] AS FLOAT)")} AS tone_pct_neg, {R("try_cast(f[4] AS FLOAT)")} AS tone_polarity,
      {R("try_cast(f[5] AS FLOAT)")} AS tone_pct_active, {R("try_cast(f[6] AS FLOAT)")} AS tone_pct_self_ref,
      array_to_string(string_split(themes, ';'), '|') AS themes,
      array_to_string(list_transform(string_split(event_ids, ','),
        lambda x: CAST(coalesce(try_cast(x AS BIGINT), -1) AS VARCHAR)), '|') AS event_ids,
      replace(persons, ';', '|') AS persons, replace(organizations, ';', '|') AS organizations,
      replace(sources, ';', '|') AS sources, replace(source_urls, '<UDIV>', '|') AS source_urls FROM p""",
)
def _(spark, d):
    flat = silver.flat_gkg(gkg(spark, d))
    tones = [c for c in flat.columns if c.startswith("tone_")]
    return rounded(
        flat.select(
            "pub_date", "num_articles", *tones, F.array_join("themes", "|").alias("themes"),
            F.array_join(F.col("event_ids").cast("array<string>"), "|").alias("event_ids"),
            *[F.array_join(c, "|").alias(c) for c in ("persons", "organizations", "sources", "source_urls")],
        )
    )


_SENTENCE = """
  coalesce(trim('Actor 1: ' || a1_name || coalesce(' (type: ' || a1_type1_desc || ' )', '')), '')
  || ' performed action ' || coalesce(ev_root_desc, 'None') || ', more specifically '
  || coalesce(ev_desc, 'None') || ' '
  || coalesce(trim('on Actor 2: ' || a2_name || coalesce(' (type: ' || a2_type1_desc || ')', '')), '')
  || '  This took place in: ' || coalesce(action_geo_country, 'None') || ' / '
  || coalesce(action_geo_state, 'None') || ' / ' || coalesce(action_geo_location, 'None')
  || '  and was reported in: ' || coalesce(source_url, 'None')"""


@query(
    "event_sentence",
    f"""WITH {SILVER_CTE} SELECT date_added, ev_id, ev_date, {_SENTENCE} AS svp_description FROM silver""",
)
def _(spark, d):
    return gold.event_sentences(silver.silver_events(bronze(spark, d), dicts(spark, d)))


@query("url_hash", f"WITH {EV_SQL} SELECT ev_id, source_url, substr(sha256(source_url), 1, 32) AS url_hash FROM ev")
def _(spark, d):
    return ev(spark, d).select("ev_id", "source_url", text.url_hash(F.col("source_url")).alias("url_hash"))


TEMPLATE = """
    Read this article and condense it into a few plain words:
    ---
    {news_text}
    ---
"""


def prompt_sql(body: str) -> str:
    before, after = (p.replace("'", "''") for p in TEMPLATE.split("{news_text}"))
    return f"regexp_replace('{before}' || {body} || '{after}', '(?m)^ {{4}}', '', 'g')"


@query(
    "prompt_build",
    f"""SELECT doc_id, sha256({prompt_sql('text')}) AS prompt_hash, length({prompt_sql('text')}) AS prompt_len,
      substr(sha256('{text.template_hash(TEMPLATE)}' || text || 'm1'), 1, 32) AS label_hash FROM documents""",
)
def _(spark, d):
    prompt = text.build_prompt(TEMPLATE, F.col("text"))
    key = text.hash_prefix(32, F.lit(text.template_hash(TEMPLATE)), F.col("text"), F.lit("m1"))
    return fx.table(spark, d, "documents").select(
        "doc_id", F.sha2(prompt, 256).alias("prompt_hash"),
        F.length(prompt).cast("bigint").alias("prompt_len"), key.alias("label_hash"),
    )


_COMPLETION = r"""CASE doc_id % 6
  WHEN 0 THEN '1. None' || chr(10) || '2. ' || CAST(n_chars AS VARCHAR)
  WHEN 1 THEN 'flood,,' || lang || chr(10) || CAST(n_chars / 1000 AS VARCHAR) || ',000'
  WHEN 2 THEN '1.protest, ' || source || chr(10) || 'many'
  WHEN 3 THEN 'one line, ' || lang
  WHEN 4 THEN 'none ' || chr(10) || ' 2.' || CAST(n_chars AS VARCHAR) || ' '
  END"""


@query(
    "parse_completion",
    f"""WITH c AS (SELECT doc_id, {_COMPLETION.replace('n_chars / 1000', 'n_chars // 1000')} AS answer FROM documents),
    l AS (SELECT doc_id, answer, string_split(answer, chr(10)) AS lines FROM c),
    t AS (SELECT doc_id, answer,
      trim(regexp_replace(trim(lines[1]), '^[0-9]\\.\\s*', '')) AS l1,
      trim(regexp_replace(trim(lines[2]), '^2\\.', '')) AS l2 FROM l)
    SELECT doc_id, CASE WHEN lower(l1) = 'none' THEN ''
        ELSE array_to_string(list_filter(string_split(l1, ','), lambda x: x <> ''), '|') END AS topics,
      try_cast(replace(l2, ',', '') AS BIGINT) AS people,
      CASE WHEN answer IS NULL THEN 'no completion' WHEN l2 IS NULL THEN 'line 2 is missing'
        WHEN try_cast(replace(l2, ',', '') AS BIGINT) IS NULL THEN 'no number in line 2: ' || l2 END AS error
    FROM t""",
)
def _(spark, d):
    docs = fx.table(spark, d, "documents")
    answer = F.expr(
        _COMPLETION.replace("n_chars / 1000", "n_chars div 1000").replace("VARCHAR", "STRING")
    )
    answered = docs.select("doc_id", answer.alias("answer"))
    c = F.col("answer")
    return answered.select(
        "doc_id",
        F.array_join(text.completion_topics(c), "|").alias("topics"),
        text.completion_people(c).alias("people"),
        text.completion_error(c).alias("error"),
    )


@query(
    "series_frame",
    f"""WITH {EV_SQL}, a AS (SELECT country, ev_root_code, date_added, count(*) AS cnt FROM ev GROUP BY 1, 2, 3)
    SELECT country || '-' || ev_root_code AS unique_id, date_added AS ds, {R('log10(1 + cnt)')} AS y FROM a""",
)
def _(spark, d):
    counts = A.log_counts(ev(spark, d), ["country", "ev_root_code", "date_added"])
    return rounded(series.log_series(counts, ["country", "ev_root_code"], "date_added", "cnt"))
