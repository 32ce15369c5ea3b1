"""Queries of this subpackage over the test tables, and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tinderbox.llm import (
    chat, classifier, content_sort, cover_tree, mixing, near_dedup, packing, pii, prefix_free, prefix_trie, quality_rules, tree_lloyd, warc,
)
from tinderbox.llm.common import table
from tinderbox.session import new_dir, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def tokenizer_file() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@query("op1_quality_rules")
def op1(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, d, "documents"), table(spark, d, "labels"))


WARC_SQL = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), h AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex, sha256(payload) AS same FROM p
), f AS (
  SELECT same, min(page_id) AS first FROM h GROUP BY same
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
    ((strpos('0123456789abcdef', hex[(5 * i) // 4 + 1]) - 1) * 16 + strpos('0123456789abcdef', hex[(5 * i) // 4 + 2]) - 1)
    >> (3 - (5 * i) % 4)) & 31 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM h JOIN f USING (same)
"""


@query("op2_warc", WARC_SQL)
def op2(spark: SparkSession, d: str) -> DataFrame:
    folder = new_dir(spark, "warc")
    warc.write_warc(table(spark, d, "pages"), folder)
    return warc.page_records(spark, folder)


@query("op3_chat_format")
def op3(spark: SparkSession, d: str) -> DataFrame:
    return chat.parse_transcripts(chat.as_transcripts(table(spark, d, "conversations")))


TOP_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


@query("op4_cover_tree_top_k", TOP_SQL)
def op4(spark: SparkSession, d: str) -> DataFrame:
    vectors = cover_tree.integer_vectors(table(spark, d, "embeddings"))
    return cover_tree.top_k(vectors, F.col("vec_id") % 50 == 0)


NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w
), e AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s
), few AS (
  SELECT doc_id, n, hash(shingle) AS shingle FROM e WHERE shingle IN (SELECT shingle FROM e GROUP BY shingle HAVING count(*) > 1)
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM few a JOIN few b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
), c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""


@query("op5_minhash_near_dedup", NEAR_SQL)
def op5(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, d, "documents"), shingle_words=3, percent=85)


@query("op6_quality_classifier")
def op6(spark: SparkSession, d: str) -> DataFrame:
    return classifier.quality_classifier(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op7_prefix_free_dedup")
def op7(spark: SparkSession, d: str) -> DataFrame:
    return prefix_free.remove_repeats(table(spark, d, "documents"))


@query("op8_pii")
def op8(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_pii(table(spark, d, "documents"))


@query("op9_best_fit_packing")
def op9(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), tokenizer_file())


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk FROM sized GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][(rk - 1) % 3 + 1] AS weight, 2 * source_size AS most FROM src
), r AS (
  SELECT *, most::DOUBLE / weight AS ratio, sum(source_size) OVER ()::DOUBLE * 1.5e0 AS budget, sum(weight) OVER () AS all_weight FROM w
), lv AS (
  SELECT *, (budget - coalesce(sum(most) OVER before, 0)::DOUBLE)
            / (all_weight - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM r WINDOW before AS (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), fr AS (
  SELECT level AS free_level FROM lv WHERE ratio > level ORDER BY ratio, source ASC NULLS LAST LIMIT 1
), targets AS (
  SELECT coalesce('0' || source, '1') AS queue, source_size,
         CASE WHEN ratio <= level THEN most::DOUBLE ELSE weight * (SELECT free_level FROM fr) END AS target FROM lv
), lined AS (
  SELECT s.doc_id, s.size, t.*, md5('mix' || coalesce(':' || s.doc_id, '') || ':' || s.size) AS draw
  FROM sized s JOIN targets t ON coalesce('0' || s.source, '1') = t.queue
), upto AS (
  SELECT *, sum(size) OVER (PARTITION BY queue ORDER BY draw, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto FROM lined
), turns AS (
  SELECT *, upto + e * source_size AS words, (upto + e * source_size)::DOUBLE / target AS finish
  FROM upto, (VALUES (0), (1)) AS epochs(e)
  WHERE target > 0 AND size > 0 AND upto + e * source_size - size < target
), spent AS (
  SELECT *, sum(size) OVER (ORDER BY finish, queue, draw, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS spent FROM turns
), given AS (
  SELECT queue, draw, doc_id, upto, sum(size) AS taken FROM spent
  WHERE spent <= (SELECT sum(target) FROM targets) GROUP BY ALL
)
SELECT u.doc_id, u.size, u.source_size, u.target, coalesce(g.taken, 0)::BIGINT AS taken
FROM upto u LEFT JOIN given g ON u.queue = g.queue AND u.draw = g.draw AND u.upto = g.upto AND u.size > 0
  AND u.doc_id IS NOT DISTINCT FROM g.doc_id
"""


@query("op10_mix_sources", MIX_SQL)
def op10(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(table(spark, d, "documents"))


SAME_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
"""


@query("op11_content_sort_dedup", SAME_SQL)
def op11(spark: SparkSession, d: str) -> DataFrame:
    return content_sort.exact_duplicates(table(spark, d, "documents"), keep="largest")


def _round_sql(k: int) -> str:
    """Assignment a<k> to codebooks b<k>, and the codebooks b<k + 1> it leads to."""
    return f"""
a{k} AS (
  SELECT p.vec_id, p.part, min(list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + b.entry) AS best
  FROM p JOIN b{k} b USING (part) GROUP BY p.vec_id, p.part
), m{k} AS (
  SELECT part, best % 64 AS entry, i, sum(x[i])::BIGINT AS s, count(*) AS n
  FROM a{k} JOIN p USING (vec_id, part), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY ALL
), b{k + 1} AS (
  SELECT part, entry, coalesce(u.x, b.x) AS x FROM b{k} b LEFT JOIN (
    SELECT part, entry, list((s - (s % n + n) % n) // n ORDER BY i) AS x FROM m{k} GROUP BY part, entry
  ) u USING (part, entry)
)"""


CODE_SQL = f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT vec_id, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS x FROM v, range(16) r(part)
), seeds AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v QUALIFY entry < 64
), b0 AS (SELECT part, entry, x FROM p JOIN seeds USING (vec_id)
),{_round_sql(0)},{_round_sql(1)},{_round_sql(2)}
, coded AS (
  SELECT vec_id, string_agg(format('{{:02x}}', best % 64), '' ORDER BY part) AS code, sum(best // 64)::BIGINT AS error FROM a2 GROUP BY vec_id
), books AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN v USING (vec_id), books
"""


@query("op12_tree_lloyd_codes", CODE_SQL)
def op12(spark: SparkSession, d: str) -> DataFrame:
    return tree_lloyd.compress_vectors(table(spark, d, "embeddings"))


TRIE_SQL = """
WITH o AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s,
    list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ord(substr(conv_id::VARCHAR, i, 1))::BIGINT) AS digits
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT conv_id, s, xor(list_reduce(list_concat([4294967295::BIGINT], digits), lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 9 AS h FROM o
), rebuilt AS (
  SELECT h.conv_id, list_concat(coalesce(b.s, [])[1 : h.h], h.s[h.h + 1 :]) AS s FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 5
), steps AS (
  SELECT conv_id, d, s[1 : d] AS k, d = len(s) AS ends FROM rebuilt, LATERAL (SELECT unnest(range(0, len(s) + 1)) AS d)
), n AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ids
  FROM steps GROUP BY k, d
), kids AS (
  SELECT k[1 : d - 1] AS k, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL
), whole AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (k, d)
), below AS (
  SELECT k[1 : a] AS k, a AS d, count(*) FILTER (n_children = 0) AS n_leaves,
    sum(CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(k[d].t)) END)::BIGINT AS saved_tokens
  FROM whole, LATERAL (SELECT unnest(range(0, d + 1)) AS a) GROUP BY ALL
)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, b.n_leaves, b.saved_tokens, sha256(w.ids) AS ends_sha256
FROM whole w JOIN below b USING (k, d) LEFT JOIN n p ON w.d > 0 AND p.d = w.d - 1 AND p.k = w.k[1 : w.d - 1]
"""


@query("op13_prefix_trie", TRIE_SQL)
def op13(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, d, "conversations"))
