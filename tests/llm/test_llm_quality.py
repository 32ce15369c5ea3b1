"""Counting rules, both models, and personal data, against plain versions."""

import re
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tinderbox.llm import classifier, ngrams, pii, quality_rules
from tinderbox.llm.common import held_out, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double"


def documents(spark, texts):
    """Rows with nulls, extra columns that clash with results, and a repeated row."""
    rows = [(i, t, "en", "s", 0, True, 1.0) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[-1], (None, "no id here", None, None, None, None, None)], SCHEMA)


GOOD = "The quick brown fox jumps over one lazy dog while rain falls on hills and rivers run to wide seas. "
BAD = "BUY!! NOW!! CHEAP!! $$$ ### WIN*** CASH%%% FREE!! "
TEXTS = [None, "", " \t\n", "word", "a b \x0bc\x1fd", "same line\nother\nsame line\n \n ", GOOD * 3, BAD * 12, "x " * 300, "y" * 70_000]


def plain_counts(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)
    )


def labels(spark):
    rows = [(i, i % 2, 0) for i in range(400)] + [(None, 1, 0), (3, None, None), (5, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def training(spark):
    return spark.createDataFrame([(i, (GOOD if i % 2 else BAD) * (1 + i % 5) + str(i)) for i in range(400)], "doc_id long, text string")


def test_counts_match_plain_version(spark):
    got = quality_rules.quality_rules(documents(spark, TEXTS), labels(spark)).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = TEXTS[r.doc_id] if r.doc_id is not None else "no id here"
        counts = plain_counts(text) if text is None or len(text) < 50_000 else (1, len(text), 0, 0, 0)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.kept and r.base_failed)


def test_no_labels_or_rows(spark):
    docs = documents(spark, [GOOD * 3 + "and some other words " + " ".join(map(str, range(60))), ""])
    none = labels(spark).limit(0)
    assert [r.kept for r in quality_rules.quality_rules(docs, none).orderBy("doc_id").collect()] == [False, True, False, False]
    assert {r.score for r in classifier.quality_classifier(docs, none).collect()} == {0.5}
    empty = docs.limit(0)
    assert quality_rules.quality_rules(empty, labels(spark)).count() == 0
    assert classifier.quality_classifier(empty, labels(spark)).count() == 0
    assert pii.find_pii(empty).count() == 0 and pii.mask_pii(empty).columns == docs.columns


def test_dropping_keeps_columns(spark):
    docs = documents(spark, TEXTS)
    kept = quality_rules.drop_low_quality(docs, labels(spark))
    assert kept.schema.names == docs.schema.names
    want = quality_rules.quality_rules(docs, labels(spark)).where("kept").count()
    assert kept.count() == want


@pytest.mark.parametrize("fold", ["quality_rules", "classifier"])
def test_held_out_accuracy(spark, fold):
    docs, marks = training(spark), labels(spark).where("quality IS NOT NULL").dropDuplicates(["doc_id"])
    if fold == "classifier":
        out = classifier.quality_classifier(docs, marks).withColumn("yes", F.col("predicted") == 1)
    else:
        out = quality_rules.quality_rules(docs, marks).withColumn("yes", F.col("quality_probability") >= 0.5)
    hits = out.join(marks, "doc_id").where(held_out(F.col("doc_id")) & (F.col("doc_id") != 5))
    assert hits.count() > 100
    assert hits.where(F.col("yes") == (F.col("quality") == 1)).count() >= 0.98 * hits.count()


def test_held_out_labels_change_nothing(spark):
    docs, marks = training(spark), labels(spark)
    flipped = marks.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = classifier.quality_classifier(docs, marks).orderBy("doc_id").collect()
    assert a == classifier.quality_classifier(docs, flipped).orderBy("doc_id").collect()


def test_real_labels(spark, sf):
    docs, marks = table(spark, sf, "documents"), table(spark, sf, "labels")
    out = classifier.quality_classifier(docs, marks).join(marks, "doc_id").where("held_out")
    assert out.where("predicted = quality").count() >= 0.85 * out.count()
    assert out.where("score < 0 OR score > 1").count() == 0


def test_ngram_means_are_those_of_frequencies():
    import numpy as np

    values = np.random.default_rng(1).normal(size=1 << 12)
    for text in ("", "ab", GOOD, "é" * 9 + " x x x", "word " * 70_000):
        ids, shares = ngrams.frequencies(text, 12)
        assert abs(ngrams.mean_value(text, values, 12) - float(shares @ values[ids])) < 1e-4


PII_TEXTS = [
    "mail a.b+c@mail-1.example.com, x@y @z.com a@b..c q@w.e.r@t.y",
    "1.2.3.4 256.1.1.1 001.002.003.255 1.2.3.4.5.6.7.8 9.9.9",
    "card 4539 1488 0343 6467 and 4539-1488-0343-6467, 4539148803436468 45 39",
    "+1 (274) 555-9629 +123 +12345678901234567890 ++49 30 1234567)",
    "pay to IBAN DE89 3704 0044 0532 0130 00 today; DE88 3704 0044 0532 0130 00 is wrong",
    "my SSN is 123-45-6789, order 123-45-6789", "amex card 378282246310005 but order 378282246310005 of isbn", "é" * 10 + "a@b.de",
]
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and plain_luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            out += [(kind, *m.span())] * good
    return out


def test_pii_base_spans(spark, sf):
    real = [r.text for r in table(spark, sf, "documents").select("text").limit(200).collect()]
    docs = documents(spark, [*TEXTS, *PII_TEXTS, *real])
    texts = [*TEXTS, *PII_TEXTS, *real]
    for r in pii.find_pii(docs).collect():
        want = plain_spans("no id here" if r.doc_id is None else texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[0] == k for w in want) for k in BASE]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_pii_further_kinds():
    assert ("iban", 12, 39) in pii.all_spans(PII_TEXTS[4]) and len(pii.all_spans(PII_TEXTS[4])) == 1
    assert [s[0] for s in pii.all_spans("my SSN is 123-45-6789")] == ["ssn"]
    assert pii.all_spans("order 123-45-6789") == []
    assert [s[0] for s in pii.all_spans("amex card 378282246310005")] == ["card"]
    assert pii.all_spans("order 378282246310005") == []
    assert pii.masked("to a@b.de!") == "to [email]!"


def test_pii_masking(spark):
    docs = documents(spark, PII_TEXTS)
    out = {r.doc_id: r for r in pii.mask_pii(docs).collect()}
    assert "[card] and [card]" in out[2].text and out[2].n_chars == len(out[2].text)
    assert pii.mask_pii(docs).schema.names == docs.schema.names
    assert pii.mask_pii(documents(spark, [None])).where("text IS NULL").count() == 2


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1.2." * 60_000, "a@" * 60_000, "+1(" * 60_000, "1 2-" * 60_000):
        pii.base_spans(text)
