"""The daily job as one run."""

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from registry import base
from registry.storage import feed_lines
from test_archives import zipped
from tinderbox.plans import daily, gold, silver


@pytest.fixture
def job(spark, sf, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    lines = feed_lines(base.bronze(spark, sf).where("date_added <= 20240104")).withColumn("day", F.split("value", "\t")[56])
    entries = []
    for r in lines.groupBy("day").agg(F.collect_list("value").alias("v")).collect():  # a small fixture
        name = f"{r.day}.export.CSV.zip"
        (folder / name).write_bytes(zipped(r.v))
        entries.append((r.day, name, "1", hashlib.md5((folder / name).read_bytes()).hexdigest(), name, "events"))
    names = "date_str string, filename string, size_mb string, md5 string, full_url string, event_type string"
    listing = spark.createDataFrame(entries, names)
    return daily.Job(daily.Lake(str(tmp_path / "lake")), base.dicts(spark, sf), {"events": str(folder)}, {"events": listing}, exports=str(tmp_path / "dumps"))


def test_run_does_all_steps_of_its_window(spark, sf, job):
    done = daily.run(spark, job, lookback_days=2, now=date(2024, 1, 4))
    assert list(done) == ["ingest events", "silver events", "heat", "root heat", "country tables", "place tables", "zone forecast", "forecast", "exports"]
    rows = base.bronze(spark, sf).where("date_added BETWEEN 20240102 AND 20240104")
    assert done["ingest events"] == {"landed": 3, "damaged": 0, "absent": 0}
    assert job.lake.read(spark, "silver_events").count() == rows.count() == job.lake.read(spark, "bronze_events").count()
    enriched = silver.enriched_events(rows, job.dictionaries)
    assert [spark.read.parquet(p).count() for p in done["exports"]][1] == gold.country_ev_root(enriched).count()
    assert len({p.rsplit("/", 1)[-1].split(".")[0] for p in done["exports"]}) == 3


def test_run_names_the_step_that_failed_and_goes_on_from_it(spark, job, monkeypatch):
    calls = []

    def record(name):
        return lambda *args, **kwargs: calls.append((name, args[-2:]))

    for name in ("ingest", "refresh_silver", "refresh_heat", "refresh_root_heat", "refresh_country_tables", "refresh_place_tables",
                 "refresh_zone_forecast", "refresh_forecast", "export_country_tables"):
        monkeypatch.setattr(daily, name, record(name))

    def lost(*_args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(daily, "refresh_root_heat", lost)
        with pytest.raises(RuntimeError) as err:
            daily.run(spark, job, "2024-01-02", "2024-01-03")
    assert "since='root heat'" in err.value.__notes__[0]
    assert [c[0] for c in calls] == ["ingest", "refresh_silver", "refresh_heat"]
    assert calls[1][1] == (date(2024, 1, 2), date(2024, 1, 3))
    calls.clear()
    daily.run(spark, job, "2024-01-02", "2024-01-03", since="root heat")
    assert [c[0] for c in calls][:2] == ["refresh_root_heat", "refresh_country_tables"] and len(calls) == 6
    with pytest.raises(ValueError, match="no step"):
        daily.run(spark, job, since="nothing")
