"""Archives, chat, packing, mixing, the pipeline, and what all queries have in common."""

import base64
import gzip
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tinderbox.llm import chat, mixing, packing, queries, warc
from tinderbox.llm.common import slices, table
from tinderbox.session import new_dir

PAGES = "page_id long, url string, html string, payload binary, refers_to long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, b"x", 5) for i, u, h in rows], PAGES)


def page_rows():
    rng = random.Random(1)
    rows = [(i, f"http://x.org/{i}?q=ü", "".join(rng.choice("<p>abcé\r\n") for _ in range(rng.randrange(3000)))) for i in range(60)]
    rows += [(60 + i, None, None if i % 2 else "") for i in range(6)] + [(70, "http://y\r\nX: 1", rows[3][2]), (71, "u", rows[3][2])]
    rows += [(72, "u", "z" * 400_000), (None, "u", rows[4][2]), (None, None, "only null ids"), rows[5]]
    rows.append((73, "u", gzip.compress(b"WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n").decode("latin-1")))
    return rows


def plain_pages(rows, least):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        to = first.get(h or "") if len(data) >= least else None
        to = None if to == i else to
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("least", "split"), [(0, 700), (100, 1 << 20)])
def test_warc_round_trip(spark, least, split):
    folder, rows = new_dir(spark, "warc-test"), page_rows()
    assert warc.write_warc(pages(spark, rows), folder, least) == len(rows)
    got = warc.page_records(spark, folder, split)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_pages(rows, least)
    full = warc.read_warc(spark, folder, split).where("payload IS NOT NULL").select(F.octet_length("payload").alias("n"))
    assert full.agg(F.sum("n")).first()[0] == sum(r[1] for r in plain_pages(rows, least) if r[3] == "response")


def test_warc_of_nothing(spark):
    folder = new_dir(spark, "warc-test")
    assert warc.write_warc(pages(spark, []), folder) == 0
    assert warc.page_records(spark, folder).count() == 0


def test_false_magic_is_no_record(tmp_path):
    """Stored members carry their payload as it is: nested archives and stray magic must not count."""
    inner = warc.record(9, "u", b"inner", None)
    head = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n"
    stray = warc.MAGIC + b"\x00" * 20
    raw = b"".join(gzip.compress(head % len(b) + b + b"\r\n\r\n", 0) for b in (inner + stray, stray, b""))
    path = tmp_path / "a.warc.gz"
    path.write_bytes(raw)
    with path.open("rb") as file:
        whole = [(at, block) for at, _, block in warc.records_between(file, 0, len(raw), len(raw))]
        assert [b for _, b in whole] == [inner + stray, stray, b""]
        for step in (1, 7, 64):
            parts = [r for s in range(0, len(raw), step) for r in warc.records_between(file, s, min(s + step, len(raw)), len(raw))]
            assert [(at, block) for at, _, block in parts] == whole


def test_records_beside_other_members_are_kept(spark, tmp_path):
    """Padding, foreign members and damaged records cost no sound record beside them, and are reported once."""
    first, second, third = (warc.record(i, "u", b"payload %d" % i, None) for i in range(3))
    foreign, padding = gzip.compress(b"no record"), b"\0" * 9
    nested = b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % len(first) + first + b"\r\n\r\n"
    raw = first + foreign + second + third[:40] + gzip.compress(nested, 0) + third + padding
    at = [0, len(first) + len(foreign), len(raw) - len(padding) - len(third) - len(gzip.compress(nested, 0)), len(raw) - len(padding) - len(third)]
    bad = [len(first), at[1] + len(second), len(raw) - len(padding)]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(raw)
    with path.open("rb") as file:
        for step in (1, 7, 64, len(raw)):
            got = [r for s in range(0, len(raw), step) for r in warc.records_between(file, s, min(s + step, len(raw)), len(raw))]
            assert sorted(p for p, h, _ in got if h is not None) == at
            assert sorted(p for p, h, _ in got if h is None) == bad
    rows = warc.read_warc(spark, str(tmp_path), 50).collect()
    assert sorted(r.member_start for r in rows if r.error is None) == at and sum(r.error is not None for r in rows) == 3
    with pytest.raises(Exception, match="no record in bytes"):
        warc.page_records(spark, str(tmp_path)).collect()


def test_long_heads_and_other_spellings(spark, tmp_path):
    url = base64.b64encode(random.Random(1).randbytes(900_000)).decode()
    assert len(warc.record(1, url, b"x", None)) > 2 * warc.CHUNK
    block = b"HTTP/1.1 200 OK\r\nset-cookie: a=1, b\r\nSet-Cookie:c\r\ncontent-length:1\r\n\r\ny"
    old = b"WARC/0.18\r\nwarc-type:response\r\nWARC-RECORD-ID: <urn:page:2>\r\nX: a\r\n b\r\ncontent-length:%d\r\n\r\n" % len(block)
    (tmp_path / "a.warc.gz").write_bytes(warc.record(1, url, b"x", None) + gzip.compress(old + block + b"\r\n\r\n"))
    assert sorted((r.page_id, r.payload_bytes) for r in warc.page_records(spark, str(tmp_path)).collect()) == [(1, 1), (2, 1)]
    row = warc.read_warc(spark, str(tmp_path)).where("member_start > 0").first()
    assert row.http_headers["set-cookie"] == "a=1, b\nc" and row.headers["X"] == "a b" and row.headers["WARC-Type"] == "response"


def test_damaged_payload_stops(spark, tmp_path):
    good = warc.record(1, "u", b"payload", None)
    text = gzip.decompress(good).replace(b"\r\n\r\npayload", b"\r\n\r\nPAYLOAD")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(text))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_parallel_viterbi_is_viterbi(spark):
    rng = random.Random(3)
    lines = ["User: hi", "plain", "x" * 130, "", "A: yes", "### system", "[USER] q", "**Bot:** so"]
    rows = [(k, t, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 3)))) for k in (1, 2, None) for t in range(300)]
    got = chat.parse_transcripts(spark.createDataFrame([*rows, rows[7]], "conv_id long, part long, text string").repartition(5))
    want = {}
    for key in (1, 2, None):
        seen = []
        for _, _, text in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            parts = text.split("\n")
            seen += [(line, i > 0 and not parts[i - 1].strip()) for i, line in enumerate(parts)]
        turn, pieces = -1, {}
        for (line, _), state in zip(seen, chat.viterbi([chat.symbol(a, b) for a, b in seen]), strict=True):
            if state < 3:
                turn, line = turn + 1, chat.split_marker(line)[1]
            pieces.setdefault((key, turn, chat.ROLES[state % 3]), []).append(line)
        want |= {k: "\n".join(v).strip("\n") for k, v in pieces.items()}
    assert {(r.conv_id, r.turn, r.role): r.text for r in got.collect()} == want


def test_viterbi_is_the_best_path():
    from itertools import product

    rng = random.Random(4)
    for _ in range(20):
        codes = [rng.randrange(32) for _ in range(4)]

        def score(path, codes=codes):
            total = (chat.START[path[0]] if path[0] < 3 else chat.NEVER) + chat.EMIT[codes[0], path[0]]
            return total + sum(chat.MOVE[a, b] + chat.EMIT[c, b] for a, b, c in zip(path, path[1:], codes[1:], strict=False))

        assert score(chat.viterbi(codes)) == max(map(score, product(range(6), repeat=4)))


def test_chat_edges(spark):
    kinds = "conv_id long, turn long, role string, text string, state int, line string"
    rows = [(1, 0, None, None, 1, "x"), (2, 0, "user", "", 1, "x"), (3, None, "user", "hello", 1, "x"), (None, 0, "system", "be brief", 1, "x")]
    out = chat.parse_transcripts(chat.as_transcripts(spark.createDataFrame(rows, kinds))).collect()
    assert {r.conv_id for r in out} == {1, 2, 3, None}
    assert all(r.rendered == f"<|{r.role}|>\n{r.text}\n<|end|>\n" for r in out)
    assert chat.parse_transcripts(chat.as_transcripts(spark.createDataFrame([], kinds))).count() == 0


def test_texts_at_one_place_stay_whole(spark):
    texts = ["User: a\nb\nb2", "Assistant: c\nd\nd2"]
    rows = [(key, part, text) for key, part in ((1, 0), (2, None), (None, 3)) for text in texts]
    got = chat.parse_transcripts(spark.createDataFrame(rows, "conv_id long, part long, text string")).collect()
    want = {(key, role, text) for key in (1, 2, None) for role, text in (("user", "a\nb\nb2"), ("assistant", "c\nd\nd2"))}
    assert {(r.conv_id, r.role, r.text) for r in got} == want and len(got) == len(want)


def test_chat_chunks_are_small_whatever_the_turns(spark):
    """All lines at one place, or at few: chunks stay small, and the result is that of one Viterbi run."""
    rng = random.Random(8)
    lines = ["User: hi", "plain", "x" * 130, "", "A: yes", "and"]
    rows = [(k, None if k else i % 3, f"{i}\n" + "\n".join(rng.choice(lines) for _ in range(3))) for k in (1, None) for i in range(400)]
    rows.append((2, 0, "\n".join(rng.choice(lines) for _ in range(1000))))
    frame = spark.createDataFrame(rows, "conv_id long, part long, text string").repartition(5)
    got = {(r.conv_id, r.turn, r.role): r.text for r in chat.parse_transcripts(frame).collect()}
    keyed = frame.select(chat.conversation_key(F.col("conv_id")).alias("conv"), F.coalesce("part", F.lit(0)).alias("turn"), "text")
    chunks = chat.coded_lines(keyed).groupBy("conv", "chunk").agg(F.count("*").alias("n"), F.max("place").alias("last")).collect()
    assert max(c.n for c in chunks) <= chat.CHUNK_LINES and all(c.last == c.n - 1 for c in chunks)
    assert sum(c.n for c in chunks) == 2 * 400 * 4 + 1000
    want = {}
    for key in (1, 2, None):
        hashed = frame.where(F.col("conv_id").eqNullSafe(F.lit(key))).select(F.coalesce("part", F.lit(0)).alias("at"), F.xxhash64("text").alias("h"), "text")
        seen = []
        for r in sorted(hashed.collect()):
            parts = r.text.split("\n")
            seen += [(line, i > 0 and not parts[i - 1].strip()) for i, line in enumerate(parts)]
        turn, pieces = -1, {}
        for (line, _), state in zip(seen, chat.viterbi([chat.symbol(a, b) for a, b in seen]), strict=True):
            if state < 3:
                turn, line = turn + 1, chat.split_marker(line)[1]
            pieces.setdefault((key, turn, chat.ROLES[state % 3]), []).append(line)
        want |= {k: "\n".join(v).strip("\n") for k, v in pieces.items()}
    assert got == want


def test_scores_of_long_conversations_stay_apart():
    """Sums of over ten million lines would reach NEVER, where all states look alike."""
    codes = [chat.symbol("User: " + "x" * 20, False)] * 200
    one = next(chat._matrices(iter([{"conv": "=1", "chunk": 0, "codes": codes}])))
    entering = [r["entering"] for r in chat._entering({**one, "chunk": i} for i in range(100_000))]
    assert entering[-1] == entering[10] and len(set(entering[-1])) > 1


def test_long_conversation_ids_come_back(spark):
    rows = [("k" * (1 << 20) + "tail", 0, "User: hi"), ("null", 0, "User: a"), (None, 0, "User: b")]
    got = chat.parse_transcripts(spark.createDataFrame(rows, "conv_id string, part long, text string"), "string").collect()
    assert {(r.conv_id, r.text) for r in got} == {(rows[0][0], "hi"), ("null", "a"), (None, "b")}


def test_chat_recovers_the_roles(spark, sf):
    want = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.trim("text").alias("text"))
    got = queries.QUERIES["op3_chat_format"](spark, sf).select("conv_id", "turn", "role", F.trim("text").alias("text"))
    assert got.intersect(want).count() >= 0.95 * want.count()


def test_packing_search():
    rng = random.Random(6)
    for _ in range(30):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(1, 12))]
        bins = packing.complete(sizes, 100, 10**6)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 100 for b in bins)
        assert fewest(sizes, 100) <= len(bins) <= min(len(packing.best_fit(sizes, 100)), fewest(sizes, 100) + 1)
    # Best fit takes three bins here, bin completion two.
    sizes = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6]
    assert (len(packing.best_fit(sizes, 60)), sum(sizes)) == (4, 180) and len(packing.complete(sizes, 60)) == 3


def fewest(sizes, capacity):
    best = [len(sizes)]

    def place(rest, spaces):
        if len(spaces) >= best[0]:
            return
        if not rest:
            best[0] = len(spaces)
            return
        for k in range(len(spaces)):
            if spaces[k] >= rest[0] and spaces[k] not in spaces[:k]:
                place(rest[1:], [*spaces[:k], spaces[k] - rest[0], *spaces[k + 1 :]])
        place(rest[1:], [*spaces, capacity - rest[0]])

    place(sorted(sizes, reverse=True), [])
    return best[0]


def test_packed_pieces(spark, sf):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_file())
    extra = ["", None, " \n ", "It's <|endoftext|> ... THE. the, X.Y é. ǅ. ½. á. \x1c1,000", "word " * 9000, "a" * 5000]
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").limit(60).collect()] + list(enumerate(extra, 1000)) + [(None, "x"), (1003, extra[3])]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, piece int, length string")
    got = packing.pack_documents(docs, queries.tokenizer_file()).collect()
    want = []
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(i, k, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())) for k, s in enumerate(range(0, len(ids), 4096))]
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    filled = {}
    for r in got:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in filled.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False)) and sum(spans[-1]) <= 4096
    assert len(filled) <= -(-sum(r.length for r in got) // 4096) + 1
    assert packing.pack_documents(docs.limit(0), queries.tokenizer_file()).count() == 0


def mix_rows():
    rng = random.Random(8)
    rows = [(i, "w " * rng.randrange(1, 400), rng.choice(["a", "a", "a", "b", "ä", "Z", None])) for i in range(400)]
    return rows + [(400, None, "a"), (401, "", "empty"), (402, None, "empty"), (None, "one two", "b"), rows[5], rows[5]]


def test_mixing(spark):
    docs = spark.createDataFrame([(i, t, s, 9, 9) for i, t, s in mix_rows()], "doc_id long, text string, source string, size long, queue int")
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(mix_rows()) and {r.size for r in rows if r.doc_id in (400, 401, 402)} == {0}
    total = sum(r.size for r in rows)
    by_source = {}
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size) and r.target <= 2 * r.source_size
        by_source.setdefault((r.source_size, r.target), []).append(r)
    assert abs(sum(t for _, t in by_source) - 1.5 * total) < 1e-6 * total
    for (_, target), members in by_source.items():
        assert abs(sum(r.taken for r in members) - target) <= 2 * max(r.size for r in members)
    drawn = mixing.draw_mix(docs)
    assert drawn.columns == docs.columns
    assert drawn.select(mixing.word_count(F.col("text")).alias("n")).agg(F.sum("n")).first()[0] == sum(r.taken for r in rows)
    assert mixing.mix_sources(docs.limit(0)).count() == 0 and mixing.draw_mix(docs.limit(0)).count() == 0


def test_mixing_reruns_agree(spark):
    docs = spark.createDataFrame(mix_rows(), "doc_id long, text string, source string")
    a, b = (sorted(map(repr, mixing.mix_sources(d).collect())) for d in (docs, docs.repartition(7)))
    assert a == b


def test_pipeline(spark, sf):
    docs = table(spark, sf, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "personal data", "mixing", "packing"]
    packed = corpus_pipeline.run(spark, sf)
    assert packed.count() > 0 and packed.where("offset + length > 4096").count() == 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and stage(spark, empty, sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, sf).count() == 0


def test_every_operator_has_its_query():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


def test_slices_keep_all_rows():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["x" * (i % 97) for i in range(1000)] + ["y" * 50_000, None]})
    for limit in (1, 1000, 10**6):
        parts = list(slices(iter([batch]), limit))
        assert pa.Table.from_batches(parts).combine_chunks().to_batches()[0].equals(batch)
