"""Totals, caches and models that are kept up to date from what an increment touches."""

import random
from collections import Counter
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from registry import base
from tinderbox.operators import embedding, folding, moments, vector_cache
from tinderbox.plans import daily, gold, silver
from tinderbox.sinks import storage, writers

PARTS = "part_day string, k string, n long"


def held(df):
    return {r.k: r.n for r in df.collect()}


def test_folded_totals_follow_any_refreshes(spark, tmp_path):
    rng, root, days = random.Random(3), str(tmp_path / "t"), {}
    assert folding.totals(spark, root) is None
    for _round in range(6):
        touched = rng.sample(["d1", "d2", "d3", "d4"], rng.randrange(1, 4))
        for day in touched:
            days[day] = {k: rng.randrange(1, 5) for k in rng.sample(["a", "b", "c", None], rng.randrange(4))}
        parts = spark.createDataFrame([(d, k, n) for d in touched for k, n in days[d].items()], PARTS)
        got = held(folding.fold(spark, root, parts, touched, ["n"]))
        assert got == dict(sum((Counter(p) for p in days.values()), Counter()))
        assert folding.known_days(spark, root, "d0", "d9") == sorted(days)
    assert folding.known_days(spark, root, "d2", "d3") == sorted({"d2", "d3"} & set(days))
    assert len(storage.partition_values(spark, f"{root}/totals", "snapshot")) == 2
    before = folding.part_versions(spark, root)
    assert held(folding.fold(spark, root, parts.limit(0), [], ["n"])) == got and folding.part_versions(spark, root) == before


def test_an_interrupted_fold_counts_nothing_twice(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")

    def parts(*rows):
        return spark.createDataFrame(rows, PARTS)

    folding.fold(spark, root, parts(("d1", "a", 1), ("d2", "a", 10)), ["d1", "d2"], ["n"])

    def lost(*_args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(folding, "totals", lost)  # parts and days are written, totals are not
        folding.fold(spark, root, parts(("d1", "a", 5), ("d3", "b", 7)), ["d1", "d3"], ["n"])
    assert held(folding.totals(spark, root)) == {"a": 11} and folding.known_days(spark, root, "", "e") == ["d1", "d2"]
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(storage, "delete", lost)  # all is committed, superseded parts are still there
        folding.fold(spark, root, parts(("d1", "a", 5)), ["d1"], ["n"])
    assert held(folding.totals(spark, root)) == {"a": 15}
    assert held(folding.fold(spark, root, parts(("d1", "a", 6)), ["d1"], ["n"])) == {"a": 16}
    assert held(folding.fold(spark, root, parts(), ["d1", "d2"], ["n"])) == {}


def test_place_tables_read_new_days_only(spark, sf, tmp_path, monkeypatch):
    lake, rows, d = daily.Lake(str(tmp_path / "lake")), base.bronze(spark, sf), base.dicts(spark, sf)
    writers.replace_present(rows, lake.path("bronze_events"), "date_added")
    plans, real = [], folding.fold

    def fold(spark, root, parts, days, measures):
        plans.append((parts._jdf.queryExecution().executedPlan().toString(), days))
        return real(spark, root, parts, days, measures)

    monkeypatch.setattr(folding, "fold", fold)
    tables = ("geo_locations_helper", "geo_zones_helper")

    def stored():
        return [sorted(map(repr, writers.latest_snapshot(spark, lake.path(t)).collect())) for t in tables]

    daily.refresh_place_tables(spark, lake, d)
    whole = stored()
    daily.refresh_place_tables(spark, lake, d, date(2024, 1, 3), date(2024, 1, 4))
    plan, days = plans[-1]
    assert days == ["20240103", "20240104"] and "PartitionFilters: [date_added" in plan and "20240104" in plan
    assert stored() == whole and all(whole)
    for day in days:
        storage.drop_partition(spark, lake.path("bronze_events"), "date_added", day)
    daily.refresh_place_tables(spark, lake, d, date(2024, 1, 3), date(2024, 1, 4))
    kept = daily.Lake(str(tmp_path / "kept"))
    writers.replace_present(rows.where("date_added NOT IN (20240103, 20240104)"), kept.path("bronze_events"), "date_added")
    less = stored()
    daily.refresh_place_tables(spark, kept, d)
    assert less == [sorted(map(repr, writers.latest_snapshot(spark, kept.path(t)).collect())) for t in tables] != whole


def vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "i long, v array<float>")


def test_components_of_merged_moments(spark):
    rng = np.random.default_rng(4)
    rows = (rng.normal(0, 1, (400, 6)) * [5, 4, 3, 2, 1, 0.5] + rng.normal(0, 1, 6)).astype(np.float32)
    parts = [moments.moments(vectors(spark, rows[a:b]).repartition(3), "v") for a, b in ((0, 70), (70, 71), (71, 400))]
    model = moments.components_of(moments.merge_moments(parts[0].unionByName(parts[1]).unionByName(parts[2])), 2)
    exact = rows.astype(np.float64)
    values, axes = np.linalg.eigh(np.cov(exact.T, bias=True))
    assert np.allclose(model.variances, values[::-1]) and np.allclose(model.mean, exact.mean(axis=0))
    assert np.allclose(np.abs(model.components), np.abs(axes[:, ::-1].T[:2]))
    assert all(c[np.abs(c).argmax()] > 0 for c in model.components)
    assert np.allclose(model.kept, np.cumsum(values[::-1])[:2] / values.sum())
    withnull = vectors(spark, rows).unionByName(spark.createDataFrame([(-1, None)], "i long, v array<float>"))
    got = {r.i: r.r for r in moments.project(withnull, "v", model, "r", "double").collect()}
    assert got.pop(-1) is None
    reduced = np.array([got[i] for i in range(400)])
    assert np.allclose((reduced**2).sum() / 400, values[::-1][:2].sum())  # the largest variances, no others
    assert np.allclose(reduced.T @ reduced / 400, np.diag(values[::-1][:2]), atol=1e-8)


def test_moments_of_odd_vectors(spark):
    assert moments.moments(vectors(spark, []), "v").collect() == []
    assert moments.components_of(moments.moments(vectors(spark, []), "v"), 3).components.shape == (0, 0)
    one = moments.components_of(moments.moments(vectors(spark, [[1, 2]]), "v"), 5)
    assert one.components.shape == (2, 2) and one.variances.tolist() == [0, 0] and one.kept.tolist() == [0, 0]
    with pytest.raises(Exception, match="length|shape"):
        moments.moments(vectors(spark, [[1, 2], [1]]), "v").collect()
    bad = spark.createDataFrame([([1.0, None],)], "v array<double>")
    with pytest.raises(Exception, match="null"):
        moments.moments(bad, "v").collect()


def test_cache_encodes_unseen_texts_only(spark, tmp_path):
    log, plain, root = tmp_path / "log", embedding.hashed_words(12), str(tmp_path / "cache")
    log.mkdir()

    def counting(texts):
        import uuid

        (log / uuid.uuid4().hex).write_text(str(len(texts)))
        return plain(texts)

    def encoded():
        n = sum(int(p.read_text()) for p in log.iterdir())
        for p in log.iterdir():
            p.unlink()
        return n

    def texts(low, high):
        words = ["concat('t', id % 7, ' u', id % 5, ' v', id % 3, ' w', id)", "if(id % 10 = 0, null, 1)"]
        return spark.range(low, high).selectExpr(*words).toDF("t", "x").withColumn("t", F.when(F.col("x").isNotNull(), F.col("t")))

    def refresh(df, name="m"):
        return {r.text: r.vector for r in vector_cache.refresh(df, root, "t", counting, name, 3, "about ").collect()}

    assert vector_cache.cached(spark, root, "m") is None and refresh(texts(0, 0)) == {} and encoded() == 0
    first = refresh(texts(0, 60).unionByName(texts(0, 60)))
    assert len(first) == 54 == encoded()
    again = refresh(texts(10, 50))
    assert again == first and encoded() == 0
    grown = refresh(texts(40, 100))
    assert len(grown) == 90 and encoded() == 36
    at_once, _, _ = embedding.build_cache(texts(0, 100), "t", "v", plain, 3, "about ")
    for r in at_once.collect():  # signs of the other model are arbitrary
        assert np.allclose(np.abs(grown[r.t]), np.abs(r.v), atol=1e-4)
    model = vector_cache.model_of(spark, root, "m", 3)
    assert model.components.shape == (3, 12)
    refresh(texts(0, 20), "other/model")
    assert encoded() == 18 and len(vector_cache.cached(spark, root, "m").collect()) == 90


def test_an_interrupted_cache_refresh_is_repeated(spark, tmp_path, monkeypatch):
    root, encoder = str(tmp_path / "cache"), embedding.hashed_words(8)

    def refresh(n):
        rows = spark.range(n).selectExpr("concat('a', id, ' b', id % 3) as t")
        return {r.text: tuple(r.vector) for r in vector_cache.refresh(rows, root, "t", encoder, "m", 2).collect()}

    first = refresh(20)

    def lost(*_args, **_kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(vector_cache, "project", lost)
        refresh(40)
    assert {r.text: tuple(r.vector) for r in vector_cache.cached(spark, root, "m").collect()} == first
    assert len(refresh(30)) == 30


def test_names_from_folded_counts(spark, sf, tmp_path):
    rows, d = base.bronze(spark, sf), base.dicts(spark, sf)
    enriched = silver.enriched_events(rows, d)
    whole = {"country": gold.country_names(enriched), "event": gold.event_descriptions(enriched), "place": gold.place_names(enriched)}
    for kind, want in whole.items():
        root = str(tmp_path / kind)
        for low, high in ((0, 20240115), (20240110, 99999999)):
            some = rows.where(f"date_added BETWEEN {low} AND {high}")
            days = [str(r[0]) for r in some.select("date_added").distinct().collect()]
            counts = folding.fold(spark, root, gold.name_parts(some, "date_added", kind), days, ["n"])
        got = base.rounded(gold.names_of(kind, counts, d)).select(want.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, base.rounded(want).collect()))


def test_profiles_merge_over_days(spark, tmp_path):
    from tinderbox.operators import profiles, quality

    path = str(tmp_path / "p")
    rows = spark.range(4000).selectExpr(
        "cast(id % 8 as int) as day", "id % 700 as a", "if(id % 9 = 0, null, sqrt(id)) as b", "if(id % 8 = 3, null, id / 7) as c",
        "concat('t', id % 50) as d", "if(id % 4 = 0, cast('NaN' as double), 1.5) as e", "array(id) as f", "cast(null as double) as g",
    )
    for days in ([0, 1, 2, 3, 4], [4, 5, 6, 7]):
        profiles.refresh_profiles(rows.where(F.col("day").isin(days)), path, "day", days)
    got = {r.column: r for r in profiles.profile_of(spark, path).collect()}
    want = {r.column: r for r in quality.profile(rows.drop("day")).collect()}
    assert got.keys() == want.keys() == set("abcdeg")
    for c in "abcdg":
        for field in ("n", "nulls", "min_length", "max_length", "min", "max", "mean", "std"):
            assert got[c][field] == (None if want[c][field] is None else pytest.approx(want[c][field]))
        assert got[c].approx_distinct == pytest.approx(want[c].approx_distinct, rel=0.1)
        for q in ("q25", "q50", "q75"):
            assert got[c][q] == (None if want[c][q] is None else pytest.approx(want[c][q], rel=0.1))
    assert (got["e"].n, got["e"].q50) == (4000, 1.5)
    part = {r.column: r.n for r in profiles.profile_of(spark, path, F.col("day") < 2).collect()}
    assert part["a"] == 1000
    profiles.refresh_profiles(rows.limit(0), path, "day", [0])
    assert {r.column: r.n for r in profiles.profile_of(spark, path).collect()}["a"] == 3500
    with pytest.raises(FileNotFoundError):
        profiles.profile_of(spark, path + "x")
