"""Page text, fetches, completions and embeddings with stand-ins for the outside calls."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from registry import fixtures as fx
from registry.base import EV_SQL, R, ev, query, rounded
from registry.fields import TEMPLATE, prompt_sql
from tinderbox.functions import text
from tinderbox.operators import embedding as E
from tinderbox.operators import external as X
from tinderbox.operators import moments, vector_cache
from tinderbox.plans import gold
from tinderbox.session import new_dir
from tinderbox.sinks import storage

_TEXT = """regexp_replace(replace(replace(replace(
  regexp_replace(regexp_replace(
    regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g'),
    '<[^>]*>', '', 'g'), '&amp;?', '&', 'g'),
  '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), chr(10) || '+', chr(10), 'g')"""
# the ampersand must be decoded last, so it is protected while the others are
_TEXT = _TEXT.replace("'&amp;?', '&', 'g')", "'&amp;?', chr(1), 'g')")
_TEXT = f"replace({_TEXT}, chr(1), '&')"


@query("extract_text", f"SELECT page_id, url, {_TEXT} AS page_text FROM pages")
def _(spark, d):
    pages = fx.table(spark, d, "pages")
    return pages.select("page_id", "url", text.extract_text("html").alias("page_text"))


@query(
    "scrape_pages",
    f"""WITH w AS (SELECT url, DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER) AS day FROM pages
      UNION ALL SELECT 'http://s' || CAST(event_id % 500 AS VARCHAR), min(CAST(ts AS DATE)) FROM events GROUP BY 1),
    r AS (SELECT url, CASE WHEN page_id % 10 = 0 THEN 404 ELSE 200 END AS status, html FROM pages)
    SELECT w.url AS source_url, CASE WHEN status = 200 THEN {_TEXT} END AS scraped_text,
      CAST(coalesce(status, 0) AS BIGINT) AS status_code, substr(sha256(w.url), 1, 32) AS url_hash,
      CASE WHEN status = 200 THEN CAST(strlen(html) AS BIGINT) ELSE 0 END AS scraped_len,
      CASE WHEN status = 200 THEN length({_TEXT}) ELSE 0 END AS scraped_text_len,
      CASE WHEN status IS NULL THEN 'offline' END AS request_err, day AS part_date
    FROM w LEFT JOIN r ON w.url = r.url""",
)
def _(spark, d):
    pages = fx.table(spark, d, "pages")
    start = F.lit("2024-01-01").cast("date")
    from_pages = pages.select("url", F.date_add(start, (F.col("page_id") % 28).cast("int")).alias("day"))
    from_events = ev(spark, d).groupBy(F.col("source_url").alias("url")).agg(F.min("date_added").alias("day"))
    responses = pages.select(
        text.url_hash(F.col("url")).alias("url_hash"),
        F.when(F.col("page_id") % 10 == 0, 404).otherwise(200).alias("status_code"),
        "html",
        F.lit(None).cast("string").alias("request_err"),
        F.col("page_id").alias("response_id"),
    )
    return X.scrape(from_pages.unionByName(from_events), responses, "url", "day")


def digest_completer(prompt: str, slot: int) -> str:
    """Stand-in for a model: the prompt's digest; every tenth length fails."""
    if len(prompt) % 10 == 0:
        raise ValueError("busy")
    return hashlib.sha256(prompt.encode()).hexdigest()


@query(
    "summarize_stub",
    f"""WITH p AS (SELECT doc_id, {prompt_sql('text')} AS prompt FROM documents)
    SELECT CAST(doc_id AS VARCHAR) AS ext_id,
      CASE WHEN length(prompt) % 10 > 0 THEN sha256(prompt) END AS summary, 'm1' AS model,
      sha256(prompt) AS prompt_hash, length(prompt) % 10 > 0 AS success,
      CASE WHEN length(prompt) % 10 = 0 THEN 'API failure: ValueError(''busy'')' END AS error_msg,
      '{{"max_tokens":1024}}' AS llm_req_params,
      DATE '2024-01-01' + CAST(doc_id % 28 AS INTEGER) AS part_date FROM p""",
)
def _(spark, d):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 28).cast("int"))
    docs = fx.table(spark, d, "documents").select(F.col("doc_id").cast("string"), "text", day.alias("day"))
    out = X.summarize(
        docs, "doc_id", "text", "day", TEMPLATE, digest_completer, "m1", {"max_tokens": 1024}, slots=8
    )
    return out.withColumn("prompt_hash", F.sha2("prompt", 256)).drop("prompt")


def label_completer(prompt: str, slot: int) -> str:
    n = len(prompt)
    topics = "None" if n % 4 == 0 else f"flood,topic {n % 7}"
    return f"1. {topics}\n2. {n if n % 5 else 'several'}"


@query(
    "label_stub",
    f"""WITH t AS (SELECT doc_id, text, length({prompt_sql('text')}) AS n FROM documents d
      WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1))
    SELECT doc_id, substr(sha256('{text.template_hash(TEMPLATE)}' || text || 'm1' || '{{"max_tokens":256}}'), 1, 32) AS label_hash,
      CASE WHEN n % 4 = 0 THEN '' ELSE 'flood|topic ' || CAST(n % 7 AS VARCHAR) END AS topics,
      CASE WHEN n % 5 > 0 THEN n END AS people, n % 5 > 0 AS success,
      CASE WHEN n % 5 = 0 THEN 'no number in line 2: several' END AS error_msg FROM t""",
)
def _(spark, d):
    tmpl = text.template_hash(TEMPLATE)
    done = fx.table(spark, d, "labels").where("quality = 1").select(
        "doc_id", F.lit(tmpl).alias("prompt_tmpl_hash"), F.lit("m1").alias("model")
    )
    out = X.label(
        fx.table(spark, d, "documents"), done, "doc_id", "text", TEMPLATE, label_completer, "m1",
        {"max_tokens": 256},
    )
    label = F.from_json("label", "detected_situations array<string>, affected_people_count bigint, error_msg string")
    return out.withColumn("l", label).select(
        "doc_id", "label_hash", F.array_join("l.detected_situations", "|").alias("topics"),
        F.col("l.affected_people_count").alias("people"), "success", "l.error_msg",
    )


_DIM = 64


def _vector_sql(rows: str, key: str, body: str) -> str:
    slot = f"CAST('0x' || substr(md5(word), 1, 7) AS BIGINT) % {_DIM}"
    return f"""wd AS (SELECT {key}, unnest(regexp_extract_all(lower({body}), '[a-z0-9]+')) AS word FROM {rows}),
    cn AS (SELECT {key}, {slot} AS slot, count(*) AS n FROM wd GROUP BY 1, 2),
    vec AS (SELECT {key}, slot, CAST(n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS FLOAT) AS weight FROM cn)"""


@query(
    "embed_text",
    f"""WITH {_vector_sql('documents', 'doc_id', 'text')}
    SELECT doc_id, CAST(slot AS INTEGER) AS slot, {R('weight')} AS weight FROM vec""",
)
def _(spark, d):
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    vectors = E.embed_words(docs, "text", "vector", _DIM).drop("text")
    entries = vectors.select("doc_id", F.posexplode("vector").alias("slot", "weight"))
    return rounded(entries.where("weight <> 0"))


@query(
    "embed_text_batches",
    f"""WITH {_vector_sql('documents', 'doc_id', 'text')}
    SELECT doc_id, CAST(slot AS INTEGER) AS slot, {R('weight')} AS weight FROM vec""",
)
def _(spark, d):
    """The same vectors from an encoder that sees Arrow batches, as any outside model does."""
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    vectors = E.embed(docs, "text", "vector", E.hashed_words(_DIM)).drop("text")
    entries = vectors.select("doc_id", F.posexplode("vector").alias("slot", "weight"))
    return rounded(entries.where("weight <> 0"))


@query(
    "embed_cache_fallback",
    f"""WITH {EV_SQL}, t AS (SELECT country, count(*) AS cnt FROM ev WHERE country IS NOT NULL GROUP BY 1),
    k AS (SELECT n_name AS country, arg_min(embedding, vec_id) AS v FROM embeddings
      JOIN nation ON n_nationkey = label GROUP BY 1),
    {_vector_sql('t', 'country', 'country')},
    fresh AS (SELECT country, sum(CAST(weight AS DOUBLE)) AS total FROM vec GROUP BY 1)
    SELECT t.country, t.cnt, k.country IS NOT NULL AS is_cached,
      {R('''CASE WHEN k.country IS NOT NULL THEN list_sum(list_transform(v, lambda x: CAST(x AS DOUBLE)))
        ELSE fresh.total END''')} AS total
    FROM t LEFT JOIN k ON t.country = k.country LEFT JOIN fresh ON t.country = fresh.country""",
)
def _(spark, d):
    counts = ev(spark, d).where("country IS NOT NULL").groupBy("country").agg(F.count(F.lit(1)).alias("cnt"))
    nations = fx.table(spark, d, "nation").select(F.col("n_nationkey").alias("label"), F.col("n_name").alias("country"))
    cache = (
        fx.table(spark, d, "embeddings").join(nations, "label")
        .groupBy("country").agg(F.min_by("embedding", "vec_id").alias("vector"))
    )
    found = E.cached_or_encoded(counts, cache, "country", "vector", E.hashed_words(_DIM))
    marked = found.join(cache.select("country", F.lit(True).alias("is_cached")), "country", "left")
    total = F.aggregate("vector", F.lit(0.0).cast("double"), lambda a, x: a + x)
    return rounded(
        marked.select("country", "cnt", F.coalesce("is_cached", F.lit(False)).alias("is_cached"), total.alias("total"))
    )


@query(
    "embed_build_cache",
    f"""WITH {EV_SQL}, t AS (SELECT country, '{gold.COUNTRY_CACHE["prefix"]}' || country AS body FROM ev
      WHERE country IS NOT NULL GROUP BY 1),
    {_vector_sql('t', 'country', 'body')},
    m AS (SELECT slot, sum(CAST(weight AS DOUBLE)) / (SELECT count(*) FROM t) AS m FROM vec GROUP BY 1),
    s AS (SELECT country, sum(CAST(weight AS DOUBLE) * weight - 2 * weight * m) AS s FROM vec JOIN m USING (slot) GROUP BY 1)
    SELECT country, {_DIM} AS dim, round(sqrt(s + (SELECT sum(m * m) FROM m)), 4) + 0e0 AS distance FROM s""",
)
def _(spark, d):
    """With all components kept, a cached vector is as far from the mean as the encoder's."""
    cache, _model, _mean = E.build_cache(
        ev(spark, d), "country", "vector", E.hashed_words(_DIM), _DIM, gold.COUNTRY_CACHE["prefix"]
    )
    squares = F.aggregate("vector", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
    return cache.select("country", F.size("vector").alias("dim"), (F.round(F.sqrt(squares), 4) + F.lit(0.0)).alias("distance"))


@query("pca_embed")
def _(spark, d):
    vectors = fx.table(spark, d, "embeddings")
    model = E.fit_pca(vectors, "embedding", 30)
    reduced = E.reduce_dims(vectors, "embedding", model, E.centre(vectors, "embedding"), "reduced_vector")
    return reduced.select("vec_id", F.posexplode("reduced_vector").alias("component", "weight"))


@query(
    "pca_distance",
    f"""WITH x AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
    m AS (SELECT i, avg(CAST(v AS DOUBLE)) AS m FROM x GROUP BY 1)
    SELECT vec_id, round(sqrt(sum((v - m) * (v - m))), 4) + 0e0 AS distance FROM x JOIN m USING (i) GROUP BY 1""",
)
def _(spark, d):
    """All components together keep each vector's distance to the mean."""
    vectors = fx.table(spark, d, "embeddings")
    model = E.fit_pca(vectors, "embedding", _DIM)
    reduced = E.reduce_dims(vectors, "embedding", model, E.centre(vectors, "embedding"), "r")
    squares = F.aggregate("r", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
    return reduced.select("vec_id", (F.round(F.sqrt(squares), 4) + F.lit(0.0)).alias("distance"))


def _axes_sql(k: int, squarings: int) -> str:
    """The first k axes of x(key, i, v), whose keys n(key) lists: each is what high powers of the covariance, less the
    axes before, tend to. Gives z(key, component, weight)."""
    out = """m AS MATERIALIZED (SELECT i, sum(v) / (SELECT count(*) FROM n) AS m FROM x GROUP BY i),
    g AS (SELECT a.i, b.i AS j, sum(a.v * b.v) / (SELECT count(*) FROM n) AS g FROM x a JOIN x b USING (key) GROUP BY 1, 2),
    c0 AS MATERIALIZED (SELECT a.i, b.i AS j, coalesce(g, 0) - a.m * b.m AS c FROM m a, m b LEFT JOIN g ON g.i = a.i AND g.j = b.i)"""
    for axis in range(k):
        powers = f"p{axis}_0 AS MATERIALIZED (SELECT i, j, c / (SELECT sum(c) FROM c{axis} WHERE i = j) AS c FROM c{axis})"
        for step in range(squarings):
            powers += f""", q{axis}_{step} AS MATERIALIZED (SELECT a.i, b.j, sum(a.c * b.c) AS c FROM p{axis}_{step} a JOIN p{axis}_{step} b ON a.j = b.i GROUP BY 1, 2),
    p{axis}_{step + 1} AS MATERIALIZED (SELECT i, j, c / (SELECT sum(c) FROM q{axis}_{step} WHERE i = j) AS c FROM q{axis}_{step})"""
        last = f"p{axis}_{squarings}"
        out += f""", {powers},
    w{axis} AS MATERIALIZED (SELECT p.i, p.c / sqrt(l.c) AS w FROM {last} p JOIN (SELECT i, c FROM {last} WHERE i = j ORDER BY c DESC, i LIMIT 1) l ON p.j = l.i),
    e{axis} AS MATERIALIZED (SELECT sum(a.c * p.c) AS e FROM c{axis} a JOIN {last} p ON a.i = p.j AND a.j = p.i),
    c{axis + 1} AS MATERIALIZED (SELECT a.i, a.j, a.c - e * p.c AS c FROM c{axis} a JOIN {last} p USING (i, j), e{axis})"""
    axes = " UNION ALL ".join(
        f"""SELECT n.key, {axis} AS component, e AS variance, coalesce(s.s, 0) - (SELECT sum(m * w) FROM m JOIN w{axis} USING (i)) AS weight
      FROM n LEFT JOIN (SELECT key, sum(v * w) AS s FROM x JOIN w{axis} USING (i) GROUP BY key) s USING (key), e{axis}"""
        for axis in range(k)
    )
    return f"{out}, z AS ({axes})"


def _axes(reduced, key: str, variances):
    """(key, component, variance, weight) rows in the form both engines are compared in."""
    flat = reduced.select(F.col(key).alias("key"), F.posexplode("r").alias("component", "weight"))
    spread = F.element_at(F.array(*[F.lit(float(v)) for v in variances]), F.col("component") + 1)
    return rounded(flat.withColumn("variance", spread))


@query(
    "pca_increments",
    f"""WITH n AS (SELECT vec_id AS key FROM embeddings),
    x AS MATERIALIZED (SELECT vec_id AS key, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
    {_axes_sql(3, 16)} SELECT key, component, {R('variance')} AS variance, {R('weight')} AS weight FROM z""",
)
def _(spark, d):
    """Three of 64 components, from moments of three disjoint parts that are merged one after another."""
    vectors = fx.table(spark, d, "embeddings")
    sums = None
    for part in range(3):
        more = moments.moments(vectors.where(F.col("vec_id") % 3 == part), "embedding")
        sums = more if sums is None else moments.merge_moments(sums.unionByName(more))
    model = moments.components_of(sums, 3)
    return _axes(moments.project(vectors, "embedding", model, "r", "double"), "vec_id", model.variances[:3])


@query(
    "embed_cache_increments",
    f"""WITH t AS (SELECT DISTINCT url, 'page at ' || url AS body FROM pages), {_vector_sql('t', 'url', 'body')},
    n AS (SELECT url AS key FROM t), x AS MATERIALIZED (SELECT url AS key, slot AS i, weight::DOUBLE AS v FROM vec),
    {_axes_sql(3, 12)} SELECT key, component, round(weight, 4) + 0e0 AS weight, 0 AS encoded_again FROM z""",
)
def _(spark, d):
    """A cache that grows in two steps holds what one built at once would; texts seen before are not encoded again."""
    root = new_dir(spark, "vectors")
    pages = fx.table(spark, d, "pages").select("url", "page_id")
    for part in (F.col("page_id") % 3 > 0, F.lit(True), F.lit(True)):
        out = vector_cache.refresh(pages.where(part), root, "url", E.hashed_words(_DIM), "words", 3, "page at ")
    full = f"{root}/encoder=words/full"
    encoded = sum(spark.read.parquet(f"{full}/version={v}").count() for v in storage.partition_values(spark, full, "version"))
    again = F.lit(encoded - pages.select("url").distinct().count()).cast("int")
    flat = out.select(F.col("text").alias("key"), F.posexplode("vector").alias("component", "weight"))
    return flat.select("key", "component", (F.round(F.col("weight").cast("double"), 4) + F.lit(0.0)).alias("weight"), again.alias("encoded_again"))
