"""Feed-shaped views of the test tables.

Each view is one SELECT that Spark SQL and DuckDB both run; the braces name its input tables.
They only shape input (with deliberate NULLs and damaged fields); the operators under test
are applied to their result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

EV = """
SELECT e.event_id AS ev_id, CAST(e.ts AS DATE) AS date_added,
  CAST(CAST(e.ts AS DATE) - CAST(e.event_id % 3 AS INT) AS DATE) AS ev_date,
  CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE CAST(e.user_id % 25 AS INT) END AS geo_key,
  n.n_name AS country,
  CASE WHEN e.user_id % 3 = 0 THEN NULL ELSE CAST(e.user_id % 7 AS STRING) END AS state,
  e.event_type AS ev_root_code, CAST(e.event_id % 4 + 1 AS INT) AS quad_class,
  CASE WHEN e.event_id % 23 = 0 THEN NULL
       ELSE CAST(e.event_id * 7 % 21 - 10 AS DOUBLE) END AS gstein_scale,
  CAST(e.user_id % 20 + 1 AS INT) AS num_mentions,
  CAST(e.user_id % 5 + 1 AS INT) AS num_sources,
  CAST(e.user_id % 9 + 1 AS INT) AS num_articles,
  CAST(e.event_id % 2 AS INT) AS is_root_event,
  e.value AS avg_tone, CAST(e.event_id % 180 - 90 AS DOUBLE) AS lat,
  CAST(e.user_id % 360 - 180 AS DOUBLE) AS lon,
  CONCAT('http://s', CAST(e.event_id % 500 AS STRING)) AS source_url
FROM {events} e LEFT JOIN {nation} n
  ON n.n_nationkey = CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE e.user_id % 25 END
"""


def _code(key: str) -> str:
    """Two- or three-letter country code of a nation key; some are divided countries."""
    return (
        f"CASE {key} WHEN 0 THEN 'US' WHEN 3 THEN 'CH' WHEN 7 THEN 'IN' WHEN 9 THEN 'UK' "
        f"ELSE 'N' || lpad(CAST({key} AS STRING), 2, '0') END"
    )


def _int(day: str) -> str:
    return f"CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS INT)"


def _geo(prefix: str, n: str, key: str, adm: str) -> str:
    place = (
        f"concat_ws(', ', CASE WHEN st IS NULL THEN NULL ELSE city END, st, {n}.n_name)"
    )
    return f"""
  CAST(s.user_id % 6 AS INT) AS {prefix}_geo_id,
  CASE WHEN {key} IS NULL THEN NULL ELSE {place} END AS {prefix}_geo_full_name,
  {_code(key)} AS {prefix}_geo_country_code,
  CAST(NULL AS STRING) AS {adm},
  CASE WHEN {key} IS NULL THEN NULL ELSE CAST(CAST(event_id % 1800 - 900 AS DOUBLE) / 10 AS FLOAT) END AS {prefix}_geo_lat,
  CASE WHEN {key} IS NULL THEN NULL ELSE CAST(user_id % 360 - 180 AS FLOAT) END AS {prefix}_geo_lon,
  CAST({key} AS STRING) AS {prefix}_geo_feat_id,"""


def _actor(a: str, salt: int, key: str) -> str:
    return f"""
  'RAW' AS {a}_code,
  CASE WHEN (user_id + {salt}) % 5 = 0 THEN NULL ELSE 'ACTOR ' || CAST((user_id + {salt}) % 30 AS STRING) END AS {a}_name,
  'C' || lpad(CAST({key} AS STRING), 2, '0') AS {a}_country_code,
  CAST(NULL AS STRING) AS {a}_group_code, CAST(NULL AS STRING) AS {a}_ethnic_code,
  CAST(NULL AS STRING) AS {a}_rel1_code, CAST(NULL AS STRING) AS {a}_rel2_code,
  'R' || CAST((user_id + {salt}) % 6 AS STRING) AS {a}_type1_code,
  CASE WHEN user_id % 2 = 0 THEN 'R' || CAST(event_id % 6 AS STRING) ELSE NULL END AS {a}_type2_code,
  CAST(NULL AS STRING) AS {a}_type3_code,"""


BRONZE_EVENTS = f"""
SELECT s.event_id AS ev_id, {_int('ed')} AS ev_date,
  CAST(year(ed) * 100 + month(ed) AS INT) AS year_month, CAST(year(ed) AS INT) AS year,
  CAST(year(ed) AS FLOAT) AS date_fraction,
{_actor('a1', 0, 'k1')}
{_actor('a2', 2, 'k2')}
  CAST(event_id % 2 AS INT) AS is_root_event,
  lpad(CAST(user_id % 25 AS STRING), 2, '0') || '0' || CAST(event_id % 3 AS STRING) AS ev_code,
  lpad(CAST(user_id % 25 AS STRING), 2, '0') || '0' AS ev_base_code,
  lpad(CAST(user_id % 25 AS STRING), 2, '0') AS ev_root_code,
  CAST(event_id % 5 + 1 AS INT) AS quad_class,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id * 7 % 21 - 10 AS FLOAT) END AS gstein_scale,
  CAST(user_id % 20 + 1 AS INT) AS num_mentions, CAST(user_id % 5 + 1 AS INT) AS num_sources,
  CAST(user_id % 9 + 1 AS INT) AS num_articles, CAST(event_id % 13 - 6 AS FLOAT) AS avg_tone,
{_geo('a1', 'n1', 'k1', 'a1_geo_adm1_code')}
{_geo('a2', 'n2', 'k2', 'a2_adm1_code')}
{_geo('action', 'n3', 'k3', 'action_geo_adm1_code')}
  {_int('d')} AS date_added,
  'http://s' || CAST(event_id % 500 AS STRING) AS source_url
FROM (
  SELECT event_id, user_id, CAST(ts AS DATE) AS d,
    CAST(CAST(ts AS DATE) - CAST(event_id % 3 AS INT) AS DATE) AS ed,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id % 25 END AS k1,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE (user_id + 7) % 25 END AS k2,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE (user_id + 3) % 25 END AS k3,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'State ' || CAST(user_id % 7 AS STRING) END AS st,
    CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'City ' || CAST(user_id % 11 AS STRING) END AS city
  FROM {{events}}
) s
LEFT JOIN {{nation}} n1 ON n1.n_nationkey = s.k1
LEFT JOIN {{nation}} n2 ON n2.n_nationkey = s.k2
LEFT JOIN {{nation}} n3 ON n3.n_nationkey = s.k3
"""

BRONZE_GKG = f"""
SELECT event_id, {_int('CAST(ts AS DATE)')} AS pub_date, CAST(user_id % 9 + 1 AS INT) AS num_articles,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN ''
       WHEN event_id % 5 = 0 THEN ';' ELSE
    'KILL#' || CAST(user_id % 50 AS STRING) || '#' || event_type || '#' || CAST(event_id % 7 AS STRING)
    || '#Lima, Peru#PE#PE15#' || CAST(event_id % 180 - 90 AS STRING) || '.5#-77.25#-33;'
    || CASE WHEN event_id % 2 = 0 THEN 'PROTEST#x##' || CAST(event_id % 9 AS STRING) || '##US;' ELSE '' END
  END AS counts,
  CASE WHEN event_id % 10 = 0 THEN '' ELSE 'TAX;' || event_type || ';T' || CAST(user_id % 40 AS STRING) || ';' END AS themes,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE
    CAST(event_id % 7 AS STRING) || '#City ' || CAST(user_id % 11 AS STRING) || ', X#N01#A1#'
    || CAST(user_id % 90 AS STRING) || '.25##' || CAST(user_id AS STRING)
    || CASE WHEN event_id % 3 = 0 THEN ';1#Solo' ELSE '' END
  END AS locations,
  CASE WHEN event_id % 8 = 0 THEN NULL ELSE 'person ' || CAST(user_id % 60 AS STRING) || ';other' END AS persons,
  'org ' || CAST(user_id % 12 AS STRING) AS organizations,
  CASE WHEN event_id % 9 = 0 THEN '' WHEN event_id % 14 = 0 THEN NULL
       WHEN event_id % 4 = 0 THEN '-1.5,x,3'
       ELSE CAST(event_id % 21 - 10 AS STRING) || '.25,2,3.5,5.5,' || CAST(user_id AS STRING) || ',0.125' END AS tone_vec,
  CAST(event_id AS STRING) || CASE WHEN event_id % 3 = 0 THEN ',x,' ELSE ',' END || CAST(event_id + 1 AS STRING) AS event_ids,
  's' || CAST(user_id % 20 AS STRING) || '.com;t.org' AS sources,
  'http://s' || CAST(event_id % 500 AS STRING) || '<UDIV>http://t' || CAST(user_id % 9 AS STRING) AS source_urls
FROM {{events}}
"""

BRONZE_COUNTS = f"""
SELECT {_int('CAST(ts AS DATE)')} AS pub_date, CAST(user_id % 9 + 1 AS INT) AS num_articles,
  upper(event_type) AS count_type, CAST(event_id % 1000 AS FLOAT) AS reported_count,
  'object ' || CAST(user_id % 4 AS STRING) AS object_type, CAST(user_id % 6 AS INT) AS geo_id,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE concat_ws(', ',
    CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'City ' || CAST(user_id % 11 AS STRING) END,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'State ' || CAST(user_id % 7 AS STRING) END,
    'Land') END AS geo_full_name,
  {_code('(user_id % 25)')} AS geo_country_code, CAST(NULL AS STRING) AS geo_adm1_code,
  CAST(event_id % 180 - 90 AS FLOAT) AS geo_lat, CAST(user_id % 360 - 180 AS FLOAT) AS geo_lon,
  CAST(user_id AS STRING) AS geo_feat_id,
  CAST(event_id AS STRING) || CASE WHEN event_id % 3 = 0 THEN ',x,' ELSE ',' END || CAST(event_id + 1 AS STRING) AS event_ids,
  's' || CAST(user_id % 20 AS STRING) || '.com;t.org' AS sources,
  'http://s' || CAST(event_id % 500 AS STRING) || '<UDIV>http://t' || CAST(user_id % 9 AS STRING) AS source_urls
FROM {{events}}
"""

FIPS = f"SELECT {_code('n_nationkey')} AS fips_country_code, n_name AS country_name FROM {{nation}}"
ACTOR_COUNTRY = """
SELECT 'C' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS cameo_country_code,
  'Land of ' || n_name AS country_name FROM {nation}
"""
ACTOR_TYPE = """
SELECT 'R' || CAST(r_regionkey AS STRING) AS a_type_code, r_name AS a_type_desc FROM {region}
"""
EVENT_CODE = """
SELECT lpad(CAST(n_nationkey AS STRING), 2, '0') AS ev_code, 'ROOT ' || n_name AS ev_desc FROM {nation}
UNION ALL
SELECT lpad(CAST(n_nationkey AS STRING), 2, '0') || '0', n_name || ', not specified' FROM {nation}
UNION ALL
SELECT lpad(CAST(n_nationkey AS STRING), 2, '0') || '01', n_name || ', in detail' FROM {nation}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str, spread: bool = False) -> DataFrame:
    """Run a view's text over the Parquet tables it names.

    `spread` deals events over all tasks while they are slim: a table of few files or row groups is else widened by
    as few tasks.
    """
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    if "events" in used:
        slim = used["events"].select("event_id", "ts", "user_id", "event_type", "value")
        used["events"] = slim.hint("rebalance", "event_id") if spread else slim
    return spark.sql(sql, **used)


def duck(sql: str) -> str:
    """The same text with plain table names."""
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql.strip()
