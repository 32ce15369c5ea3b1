"""Operators against brute force on small, skewed inputs."""

import random
from datetime import date

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tinderbox.operators import aggregates as A
from tinderbox.operators import embedding, enrich, external, frequency, joins, medians, quality
from tinderbox.operators import ranking, sampling, series, unions, windows


def skewed(n: int = 4000, seed: int = 1) -> pd.DataFrame:
    """A third of all rows carry one key."""
    rnd = random.Random(seed)
    keys = ["hot" if rnd.random() < 1 / 3 else rnd.choice(["a", "b", None, "c"]) for _ in range(n)]
    return pd.DataFrame(
        {
            "id": range(n),
            "k": keys,
            "x": [rnd.choice([None, rnd.gauss(0, 40), float(rnd.randint(-3, 3))]) for _ in range(n)],
            "w": [rnd.randint(0, 9) for _ in range(n)],
        }
    )


def frame(spark, pdf: pd.DataFrame, ddl: str):
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, ddl)


def test_exact_medians_match_sorting(spark):
    pdf = skewed()
    df = frame(spark, pdf, "id bigint, k string, x double, w int")
    got = {r.k: (r.x, r.w) for r in medians.exact_medians(df, ["k"], ["x", "w"]).collect()}
    for key, part in pdf.groupby("k", dropna=False):
        k = None if pd.isna(key) else key
        assert got[k][0] == pytest.approx(part["x"].median())
        assert got[k][1] == pytest.approx(part["w"].median())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-200, 200, allow_nan=False, width=32), min_size=1, max_size=25))
def test_exact_median_property(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x float").withColumn("k", F.lit(1))
    got = medians.exact_medians(df, ["k"], ["x"], cell_width=7.5).first().x
    assert got == pytest.approx(float(np.median(np.array(values, dtype="float32").astype(float))))


def test_running_total_matches_one_ordered_pass(spark):
    rnd = random.Random(3)
    rows = [(f"v{i}", rnd.choice([1, 1, 1, 2, 50])) for i in range(800)]
    df = spark.createDataFrame(rows, "value string, cnt bigint")
    got = frequency.running_total(df, "value", digits=1).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 801))
    total = 0
    for r in got:
        total += r.cnt
        assert r.cum_cnt == total
    assert [r.cnt for r in got] == sorted((c for _, c in rows), reverse=True)


def test_top_frequent(spark):
    rows = [("a",)] * 5 + [("b",)] * 3 + [(None,)] + [("c",)]
    df = spark.createDataFrame(rows, "v string")
    got = {r.value: r.pct for r in frequency.top_frequent(df, "v", top=2).collect()}
    assert got == {"a": 50.0, "b": 30.0, "*OTHER* (2 distinct values)": 20.0}
    got = {r.value: r.pct for r in frequency.top_frequent(df, "v", total_pct=50).collect()}
    assert got == {"a": 50.0, "*OTHER* (3 distinct values)": 50.0}
    got = {r.value: r.pct for r in frequency.top_frequent(df, "v", top=9).collect()}
    assert got["*OTHER* (0 distinct values)"] == 0.0 and got["__NULL__"] == 10.0
    with pytest.raises(ValueError, match="either"):
        frequency.top_frequent(df, "v")


def test_sample_exact(spark):
    pdf = skewed()
    df = frame(spark, pdf[["id", "k"]], "id bigint, k string")
    got = sampling.sample_exact(df, "k", "id", 0.1, seed=5, digits=1).toPandas()
    want = (pdf.groupby("k", dropna=False).size() * 0.1).apply(np.floor)
    have = got.groupby("k", dropna=False).size()
    assert sorted(have) == sorted(want)
    assert got["id"].is_unique
    again = sampling.sample_exact(df.repartition(3), "k", "id", 0.1, seed=5).toPandas()
    assert set(again["id"]) == set(got["id"])


def test_weighted_scores_count_null_rows(spark):
    df = spark.createDataFrame([("a", 2.0, 1), ("a", None, 3), ("b", None, 0)], "k string, g double, w int")
    got = {r.k: r for r in A.weighted_scores(df, ["k"], "g", {"mentions": "w"}).collect()}
    assert got["a"].avg_gstein == 1.0 and got["a"].avg_gstein_weighted_mentions == 0.5
    assert got["b"].cnt == 1 and got["b"].avg_gstein is None and got["b"].avg_gstein_weighted_mentions is None


def test_enrich_keeps_rows_and_names(spark):
    dim = spark.createDataFrame([("A", "x"), ("A", "y"), ("B", "z")], "fips_country_code string, country_name string")
    df = spark.createDataFrame([("A",), ("Q",), (None,)], "geo_country_code string")
    out = enrich.describe(df, dim, "geo_country_code", "fips_country_code", "country_name")
    assert out.columns == ["geo_country_code", "geo_country_name"] and out.count() == 3
    assert enrich.target_name("geo_type", "geo_type_desc") == "geo_type_desc"
    replaced = enrich.describe(out, dim, "geo_country_code", "fips_country_code", "country_name")
    assert replaced.columns == out.columns


def test_unique_codes_takes_first_known(spark):
    rows = [("A", None, 1), ("A", "first", 2), ("A", "second", 3), ("B", None, 4), (None, "x", 5)]
    dim = spark.createDataFrame(rows, "c string, d string, pos int")
    got = {r.c: r.d for r in enrich.unique_codes(dim, "c", "d", "pos").collect()}
    assert got == {"A": "first", "B": None}


def test_unused_lookup_disappears(spark):
    dim = spark.range(5).select(F.col("id").alias("c"), F.lit("d").alias("v"))
    df = spark.range(100).select("id", (F.col("id") % 7).alias("code"))
    plan = enrich.describe(df, dim, "code", "c", "v", "text").select("id")._jdf.queryExecution().optimizedPlan()
    assert "Join" not in plan.toString()


def test_hottest_events_are_deterministic(spark):
    rows = [
        (1, "z1", "u1", 9.0), (2, "z1", "u1", 9.0), (3, "z1", "u2", 9.0), (4, "z1", "u3", 1.0),
        (5, "z2", "u1", 16.0), (6, None, "u9", 99.0), (7, "", "u9", 99.0),
    ]
    df = spark.createDataFrame(rows, "ev_id int, geo_zone string, source_url string, heat_indicator double")
    df = df.withColumn("date_added", F.lit(date(2024, 1, 1)))
    top = ranking.hottest_events(df, 2).orderBy("geo_zone", "heat_rank").collect()
    assert [(r.geo_zone, r.heat_rank, r.ev_id) for r in top] == [("z1", 1, 1), ("z1", 2, 3), ("z2", 1, 5)]
    urls = {r.source_url: r.ev_id for r in ranking.hottest_urls(df, 2).collect()}
    assert urls == {"u1": 5, "u2": 3}


def test_ranking_limits_groups_before_the_shuffle(spark):
    df = spark.range(10).selectExpr(
        "id as ev_id", "current_date() as date_added", "'z' as geo_zone", "cast(id as string) as source_url",
        "cast(id as double) as heat_indicator",
    )
    plan = ranking.hottest_events(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_dense_grid_without_cross_join(spark):
    rows = [(date(2024, 1, 1), "a", 1.0), (date(2024, 1, 3), "b", 2.0), (date(2024, 1, 3), None, 4.0)]
    df = spark.createDataFrame(rows, "day date, k string, y double")
    grid = series.dense_grid(df, "day", ["k"], ["y"])
    got = {(r.day.day, r.k): r.y for r in grid.collect()}
    assert got == {(1, "a"): 1.0, (3, "a"): 0.0, (1, "b"): 0.0, (3, "b"): 2.0, (1, None): 0.0, (3, None): 4.0}
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_forecasts_agree(spark):
    days = pd.date_range("2024-01-01", periods=28)
    rows = [
        (k, d.date(), 2.0 + slope * i + (3.0 if d.weekday() == 6 else 0.0) + (i * 7 % 5) * 0.1)
        for k, slope in (("a", 0.5), ("b", -0.1)) for i, d in enumerate(days)
    ] + [("single", date(2024, 1, 1), 4.0)]
    df = spark.createDataFrame(rows, "k string, day date, y double")
    for freq, horizon in (("D", 7), ("W", 3)):
        native = series.additive_forecast(df, ["k"], "day", "y", horizon, freq)
        grouped = series.forecast_groups(df, ["k"], "day", "y", horizon, freq)
        a = native.orderBy("k", "ds").toPandas()
        b = grouped.orderBy("k", "ds").toPandas()
        assert len(a) == 3 * horizon and list(a["ds"]) == list(b["ds"])
        for c in ("yhat", "yhat_lower", "yhat_upper"):
            np.testing.assert_allclose(a[c], b[c], atol=1e-8)
        assert (a["yhat_lower"] <= a["yhat"] + 1e-12).all() and (a["yhat"] <= a["yhat_upper"] + 1e-12).all()
        if freq == "W":
            assert {d.isoweekday() for d in a["ds"]} == {7}
    only = native.where("k = 'single'").first()
    assert only.yhat == 4.0


def test_custom_forecaster(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 1), 1.0)], "k string, day date, y double")

    def flat(history, horizon, freq):
        last = history["y"].iloc[-1]
        ds = [date(2030, 1, i + 1) for i in range(horizon)]
        return pd.DataFrame({"ds": ds, "yhat": last, "yhat_lower": last, "yhat_upper": last})

    assert series.forecast_groups(df, ["k"], "day", "y", 2, forecaster=flat).count() == 2


def test_windows():
    now = date(2024, 5, 10)
    assert windows.job_window("2024-01-01", "2024-01-03", now=now) == (date(2024, 1, 1), date(2024, 1, 3))
    assert windows.job_window(lookback_days="3", now=now) == (date(2024, 5, 7), now)
    assert windows.job_window(now=now) == (now, now)
    assert windows.job_window("2024-01-01", None, now=now) == (now, now)
    assert windows.window_from_values(None, None, None, now) == (date(2024, 5, 9), now)
    assert windows.window_from_values(date(2024, 1, 1), None, None, now) == (date(2024, 1, 1), now)


def test_sequences(spark):
    df = spark.createDataFrame([(date(2024, 2, 27), date(2024, 3, 1))], "a date, b date")
    assert [r[0] for r in windows.daily_stamps(df, "a", "b").collect()] == ["20240227", "20240228", "20240229"]
    assert windows.daily_stamps(df, "b", "a").count() == 0
    quarters = [r[0] for r in windows.quarter_hour_stamps(df, "a", "b").collect()]
    assert len(quarters) == 3 * 96 and quarters[0] == "20240227000000" and quarters[-1] == "20240229234500"
    sampled = windows.quarter_hour_stamps(df, "a", "b", 0.5, seed=1)
    assert sampled.count() == sampled.count() < 288


def test_unions_and_duplicate_columns(spark):
    a, b = spark.range(2), spark.range(2).withColumnRenamed("id", "x")
    assert unions.union_same([a, a]).count() == 4
    with pytest.raises(ValueError, match="columns"):
        unions.union_same([a, b])
    with pytest.raises(ValueError, match="duplicate"):
        windows.require_distinct_columns(a.select("id", "id"))


def test_pending_limit(spark):
    work = spark.createDataFrame([(i, "t" if i % 2 else None) for i in range(10)], "id int, body string")
    done = spark.createDataFrame([(1,), (3,)], "id int")
    assert [r.id for r in joins.pending(work, done, "id", "body").orderBy("id").collect()][:2] == [5, 7]


def test_cached_vectors(spark):
    cache = spark.createDataFrame([("a", [1.0, 2.0])], "k string, v array<float>")
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    got = {r.k: r.v for r in joins.cached_vectors(rows, cache, "k", "v", 2).collect()}
    assert got == {"a": [1.0, 2.0], "b": [0.0, 0.0], None: [0.0, 0.0]}


def test_profile(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10).cast("string").alias("s"), F.array("id").alias("arr"))
    got = {r.column: r for r in quality.profile(df).collect()}
    assert set(got) == {"id", "s"}
    assert abs(got["id"].approx_distinct - 1000) < 60 and got["s"].approx_distinct == 10
    assert got["id"].q50 == pytest.approx(499, abs=2) and got["s"].mean is None and got["s"].max_length == 1


def test_scrape_prefers_cache_then_fetches(spark):
    from tinderbox.functions.text import url_hash

    wanted = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "url string").withColumn("day", F.lit(date(2024, 1, 1)))
    stored = spark.createDataFrame(
        [("u1", 500, None, None, 1), ("u1", 200, "<p>hit</p>", None, 2), ("u2", 404, None, None, 3)],
        "url string, status_code int, html string, request_err string, response_id int",
    ).withColumn("url_hash", url_hash(F.col("url")))

    def fetcher(url):
        return (200, f"<b>{url}</b>\n\n\nx", None)

    got = {r.source_url: r for r in external.scrape(wanted, stored, "url", "day", fetcher).collect()}
    assert got["u1"].scraped_text == "hit" and got["u1"].scraped_len == 10
    assert got["u2"].status_code == 404 and got["u2"].scraped_text is None and got["u2"].scraped_text_len == 0
    assert got["u3"].scraped_text == "u3\nx"


def test_completions_fail_softly(spark):
    df = spark.createDataFrame([("ok",), ("bad",)], "p string")

    def completer(prompt, slot):
        if prompt == "bad":
            raise RuntimeError("quota")
        return f"{prompt}!"

    got = {r.p: (r.a, r.error_msg) for r in external.complete(df, "p", "a", completer, slots=2).collect()}
    assert got["ok"] == ("ok!", None) and got["bad"] == (None, "API failure: RuntimeError('quota')")


def test_completions_hold_few_prompts(spark):
    df = spark.range(2000).coalesce(1).selectExpr("rpad(cast(id AS string), 10000, 'x') AS p", "id")

    def completer(prompt, slot):
        import tracemalloc

        if not tracemalloc.is_tracing():
            tracemalloc.start()
        held = tracemalloc.get_traced_memory()[0]
        if prompt.startswith("1999x"):
            tracemalloc.stop()
        return f"{held} {prompt}"

    done = external.complete(df, "p", "a", completer).select("id", "error_msg", F.split("a", " ").alias("a"), "p")
    got = done.selectExpr("id", "error_msg", "cast(a[0] AS bigint) AS held", "a[1] = p AS same").collect()
    assert sorted(r.id for r in got) == list(range(2000)) and all(r.same and r.error_msg is None for r in got)
    assert max(r.held for r in got) < 4e6  # all prompts are 20 MB, and so are all answers


def test_embeddings(spark):
    df = spark.createDataFrame([("a b",), ("a b",), ("c d e",), ("x",)], "t string")
    vectors = embedding.embed(df, "t", "v", embedding.hashed_words(16))
    rows = [r.v for r in vectors.collect()]
    assert rows[0] == rows[1] and np.linalg.norm(rows[2]) == pytest.approx(1.0, abs=1e-6)
    model = embedding.fit_pca(vectors, "v", 2)
    assert len(embedding.explained_variance(model)) == 2
    mean = embedding.centre(vectors, "v")
    small = embedding.reduce_dims(vectors, "v", model, mean, "r")
    assert len(small.first().r) == 2 and abs(sum(r.r[0] for r in small.collect())) < 1e-5
    calls = spark.sparkContext.accumulator(0)

    def counting(texts):
        calls.add(len(texts))
        return np.ones((len(texts), 2))

    cache = spark.createDataFrame([("a b", [9.0, 9.0])], "t string, v array<float>")
    out = embedding.cached_or_encoded(df, cache, "t", "v", counting).collect()
    assert sorted(r.v[0] for r in out) == [1.0, 1.0, 9.0, 9.0] and calls.value == 2


def test_build_cache_then_fall_back(spark):
    df = spark.createDataFrame([(f"place {i}",) for i in range(20)], "t string")
    encoder = embedding.hashed_words(16)
    cache, model, mean = embedding.build_cache(df, "t", "v", encoder, 4, prefix="in: ")
    assert cache.count() == 20 and len(cache.first().v) == 4

    def finish(fresh):
        return embedding.reduce_dims(fresh, "v", model, mean, "r").select("t", F.col("r").alias("v"))

    wanted = spark.createDataFrame([("place 3",), ("elsewhere",)], "t string")
    out = embedding.cached_or_encoded(wanted, cache, "t", "v", encoder, finish).collect()
    assert [len(r.v) for r in out] == [4, 4]


def test_sifted_store_keeps_what_is_wanted(spark):
    from tinderbox.operators import sift

    key = F.sha2(F.col("id").cast("string"), 256).alias("k")
    store = spark.range(60_000).select(key, "id").unionByName(spark.createDataFrame([(None, -1)], "k string, id long"))
    wanted = spark.range(0, 60_000, 40).select(key).unionByName(spark.createDataFrame([(None,), ("unknown",)], "k string"))
    kept = {r.id for r in sift.sifted(store, "k", wanted, 1500).collect()}
    assert kept >= set(range(0, 60_000, 40)) and -1 not in kept and len(kept) < 1500 + 0.05 * 60_000
    assert sift.sifted(store, "k", wanted.limit(0), 10).count() == 0
    assert len(sift.bloom_words(wanted, "k", 1 << 14).first().words) == (1 << 14) // 64


def test_bodies_nobody_wants_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "store")
    store = spark.range(500).selectExpr("cast(id % 100 as string) as k", "id", "id % 3 = 0 as ok", "repeat('x', 50) as body")
    store.unionByName(store.where("id < 20")).write.parquet(path)  # some rows twice
    wanted = spark.createDataFrame([("7",), ("7",), ("55",), ("none",)], "k string")
    out = joins.cached_responses(wanted, spark.read.parquet(path), "k", "ok", "id", expected=100)
    got = sorted((r.k, r.id, r.is_hit) for r in out.collect())
    assert got == [("55", 255, True), ("7", 207, True), ("7", 207, True), ("none", None, False)]
    again = joins.cached_responses(wanted, spark.read.parquet(path), "k", "ok", "id", expected=100)
    lines = again._jdf.queryExecution().executedPlan().toString().splitlines()  # not run yet: one tree, leaves last
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    shuffle = max(i for i, line in enumerate(lines[:scan]) if "Exchange hashpartitioning(__key" in line)
    assert any("Filter" in line and "getbit(Subquery" in line for line in lines[shuffle:scan])


def test_cells_follow_the_values(spark):
    shares = spark.range(60_000).selectExpr("if(id % 3 > 0, 'hot', concat('k', id % 40)) as k", "rand(3) * rand(4) as x")
    counts = medians.value_counts(shares, ["k"], ["x"])
    cells = medians._cells(counts, ["k", "measure"], 64, 2000).groupBy("k", "cell").count().collect()
    hot = [r["count"] for r in cells if r.k == "hot"]
    assert len(hot) == 64 and max(hot) < 3 * sum(hot) / 64
    assert {r.cell for r in cells if r.k != "hot"} == {0}
    got = {r.k: r.x for r in medians.medians_of_counts(counts, ["k"], ["x"], cells=64, small=2000).collect()}
    assert got == {r.k: r.m for r in shares.groupBy("k").agg(F.median("x").alias("m")).collect()}


def test_medians_of_large_groups_with_odd_values(spark):
    values = [0.0, -0.0, 1e300, -1e300, float("inf"), float("-inf"), float("nan"), None]
    rows = spark.range(3000).selectExpr("id % 2 as k", "if(id % 5 = 0, 7.25, id * 1.5) as x")
    odd = spark.createDataFrame([(k, v) for k in (0, 1, 2) for v in values], "k long, x double")
    every = rows.unionByName(odd).unionByName(spark.range(2000).selectExpr("3L as k", "cast('NaN' as double) as x"))
    counts = medians.value_counts(every, ["k"], ["x"])
    got = {r.k: str(r.x) for r in medians.medians_of_counts(counts, ["k"], ["x"], cells=16, small=100).collect()}
    assert got == {r.k: str(r.m) for r in every.groupBy("k").agg(F.median("x").alias("m")).collect()}


def test_words_are_embedded_inside_the_jvm(spark):
    texts = ["Red red GREEN 12", "", None, "one two three " * 50, "Ünïcode ß word-word", "İstanbul K"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    plain = {r.id: r.v for r in embedding.embed(df, "t", "v", embedding.hashed_words(16)).collect()}
    out = embedding.embed_words(df, "t", "v", 16)
    assert out.columns == ["id", "t", "v"]
    for r in out.collect():
        assert r.v == pytest.approx(plain[r.id])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan


def test_heavy_hitters_propose_and_confirm(spark, monkeypatch):
    rnd = random.Random(9)
    values = ["a"] * 400 + ["b"] * 300 + [None] * 200 + [f"v{rnd.randrange(3000)}" for _ in range(6000)]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    counted, plain = [], frequency.value_frequencies

    def counting(rows, column):
        counted.append(rows.count())
        return plain(rows, column)

    monkeypatch.setattr(frequency, "value_frequencies", counting)
    top = [(r.value, r.cnt) for r in frequency.heavy_hitters(df, "x", 3, 1024).collect()]
    assert top == [("a", 400), ("b", 300), ("__NULL__", 200)] and len(counted) == 1 and counted[0] < 1500
    for k, buckets in ((5, 64), (40, 8), (5000, 1024), (1, 1)):
        got = [tuple(r) for r in frequency.heavy_hitters(df, "x", k, buckets).select("value", "cnt").collect()]
        assert got == [tuple(r) for r in plain(df, "x").orderBy(F.col("cnt").desc(), "value").limit(k).collect()]
    assert frequency.heavy_hitters(df.limit(0), "x", 3).collect() == []
