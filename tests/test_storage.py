"""Sources, sinks, streaming and the daily job on small files."""

import hashlib
import io
import zipfile
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from registry import base, fixtures as fx
from registry.external import digest_completer, label_completer
from registry.storage import day_lines, feed_lines, zip_days
from tinderbox.functions.text import url_hash
from tinderbox.operators import embedding, external
from tinderbox.plans import daily, gold, silver
from tinderbox.schemas import feed
from tinderbox.session import scoped, staged
from tinderbox.sinks import storage, writers
from tinderbox.sources import archives, catalog, delimited, dictionaries, tables
from tinderbox.streaming import ingest

EVENTS, GKG = feed("events"), feed("gkg")


def write_zip(path, lines, member="x.CSV"):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr(member, "\n".join(lines))
    path.write_bytes(buffer.getvalue())


def test_tolerant_scan(spark, tmp_path):
    (tmp_path / "f.csv").write_text('1\t081097300169928285810\t3.5\n"2"\tx\t\n3\t4\n5\t6\t7\t8\n')
    schema = delimited.scan(spark, str(tmp_path), base.schemas.struct("a int, b int, c float"))
    got = sorted((tuple(r) for r in schema.collect()), key=lambda r: r[0])
    assert got == [(1, None, 3.5), (2, None, None), (3, 4, None), (5, 6, 7.0)]


def test_header_feed(spark, tmp_path):
    header = "\t".join(GKG.schema.names)
    (tmp_path / "g.csv").write_text(header + "\n20240101\t3" + "\t" * 9 + "\n")
    rows = delimited.scan_feed(spark, str(tmp_path), GKG).collect()
    assert len(rows) == 1 and rows[0].num_articles == 3 and rows[0].themes is None


def test_archives(spark, tmp_path):
    header = "\t".join(GKG.schema.names)
    write_zip(tmp_path / "20240101.gkg.csv.zip", [header, "20240101\t3" + "\t" * 9, "20240101\t4" + "\t" * 9])
    write_zip(tmp_path / "20240102.gkg.csv.sampled_0.1.zip", [header, "20240102\t5" + "\t" * 9])
    write_zip(tmp_path / "20240103.gkgcounts.csv.zip", ["other feed"])
    write_zip(tmp_path / "20240104.gkg.csv.zip", ["no member"], member="readme.txt")
    (tmp_path / "20240105.gkg.csv.zip").write_bytes(b"")
    (tmp_path / "20240106.gkg.CSV.zip").write_bytes(b"broken")
    rows, errors = archives.scan_archives(spark, str(tmp_path), GKG)
    assert sorted(r.num_articles for r in rows.collect()) == [3, 4, 5]
    assert sorted(r.path[-20:-8] for r in errors.collect()) == ["20240104.gkg", "20240106.gkg"]
    with pytest.raises(FileNotFoundError):
        archives.scan_archives(spark, str(tmp_path), EVENTS)


def listing(spark):
    lines = [
        "<UL>", '<LI><A HREF="20240101.export.CSV.zip">20240101.export.CSV.zip</A> (1.5MB) (MD5: ab12)',
        '<LI><A HREF="2013.zip">2013.zip</A> (20MB) (MD5: 00)</LI>',
        '<LI><A HREF="20240102.export.CSV.zip">20240102.export.CSV.zip</A> (2MB) (MD5: cd)</LI>',
    ]
    text = spark.createDataFrame([(line,) for line in lines], "value string")
    return catalog.parse_listing(text, "events", "http://h/events")


def test_listing_and_resolution(spark):
    files = listing(spark)
    assert [r.filename for r in files.orderBy("filename").collect()] == [
        "20240101.export.CSV.zip", "20240102.export.CSV.zip",
    ]
    stamps = spark.createDataFrame([("20240101",), ("20240105",)], "date_str string")
    resolved = catalog.resolve_files(stamps, files)
    assert {r.date_str: r.is_missing for r in resolved.collect()} == {"20240101": False, "20240105": True}
    with pytest.raises(Exception, match="no file for 20240105"):
        catalog.require_all(resolved).collect()
    done = files.where("date_str = '20240101'").select("date_str", "event_type")
    window = (date(2024, 1, 1), date(2024, 1, 31))
    todo, unread = catalog.new_files(files, done, "events", *window)
    assert [r.date_str for r in todo.collect()] == ["20240102"]
    todo, unread = catalog.new_files(files, done, "events", *window, force=True)
    assert todo.count() == 2 and unread.count() == 1


def test_cached_catalog(spark, tmp_path):
    path, calls = str(tmp_path / "cat"), []

    def load():
        calls.append(1)
        return listing(spark)

    now = datetime(2024, 1, 1, tzinfo=timezone.utc)
    for hours in (0, 2, 4):
        assert catalog.cached_catalog(spark, path, load, now + timedelta(hours=hours)).count() == 2
    assert len(calls) == 2
    catalog.cached_catalog(spark, path, load, now + timedelta(hours=4), refresh=True)
    assert len(calls) == 3


def test_md5(spark):
    files = spark.createDataFrame([("f", bytearray(b"x"))], "filename string, content binary")
    listed = spark.createDataFrame([("f", "9dd4e461268c8034f5c8564e155c67a6")], "filename string, md5 string")
    assert catalog.verify_md5(files, listed).first().is_intact


def test_dictionaries(spark, tmp_path):
    raw = tmp_path / "codes.txt"
    raw.write_text("CAMEOEVENTCODE\tEVENTDESCRIPTION\n01\tFIRST\n010\tDetail\n01\tAGAIN\n106\t\n")
    amend = tmp_path / "amend.csv"
    amend.write_text('"ev_code","ev_desc"\n"106","Demand meeting, negotiation"\n')
    d = dictionaries.standardize(spark, "cameo_event", str(raw), str(amend))
    got = {r.ev_code: r.ev_desc for r in d.collect()}
    assert got == {"01": "FIRST", "010": "Detail", "106": "Demand meeting, negotiation"}
    writers.export_dictionary(d, str(tmp_path), "cameo_event")
    again = dictionaries.load(spark, "cameo_event", str(tmp_path / "cameo_event.std.csv"))
    assert {r.ev_code: r.ev_desc for r in again.collect()} == got
    raw.write_text("WRONG\tHEADER\n01\tx\n")
    with pytest.raises(ValueError, match="header"):
        dictionaries.standardize(spark, "cameo_event", str(raw))
    assert dictionaries.quad_classes(spark).count() == 4 and dictionaries.geo_types(spark).count() == 5


def test_sample_files(spark, tmp_path):
    for name in ("20240101-20240105.export.parquet", "20240201-20240205.export.parquet", "20240101-20240105.gkg.parquet"):
        spark.range(10).coalesce(1).write.parquet(str(tmp_path / name))
    import shutil

    flat = tmp_path / "flat"
    flat.mkdir()
    for folder in tmp_path.glob("*.parquet"):
        shutil.copy(next(folder.glob("part-*")), flat / folder.name)
    got = tables.sample_files(spark, str(flat), "export", date(2024, 1, 3), date(2024, 1, 9), 1.0)
    assert got.count() == 10
    with pytest.raises(FileNotFoundError):
        tables.sample_files(spark, str(flat), "export", date(2025, 1, 1), date(2025, 1, 2), 1.0)


def test_replace_range(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(30).selectExpr("id", "date_add(date'2024-01-01', cast(id % 5 as int)) as day")
    writers.append(rows, path, "day")
    fresh = rows.where("day = date'2024-01-02'").withColumn("id", F.col("id") + 1000)
    writers.replace_range(fresh, path, "day", date(2024, 1, 2), date(2024, 1, 3))
    assert storage.partition_values(spark, path, "day") == ["2024-01-01", "2024-01-02", "2024-01-04", "2024-01-05"]
    before = sorted(r.id for r in spark.read.parquet(path).collect())
    with pytest.raises(Exception, match="outside the replaced range"):
        writers.replace_range(rows, path, "day", date(2024, 1, 2), date(2024, 1, 3))
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == before
    assert writers.replace_observed(fresh.limit(0), path, "day") is None
    assert writers.replace_observed(fresh, path, "day") == (date(2024, 1, 2), date(2024, 1, 2))
    writers.replace_range(fresh.limit(0), path, "day", date(2024, 1, 4), date(2024, 1, 5))
    assert storage.partition_values(spark, path, "day") == ["2024-01-01", "2024-01-02"]


def test_crowded_partition_is_split(spark, tmp_path):
    rows = spark.range(200_000).selectExpr("id", "sha2(cast(id as string), 256) as s", "if(id % 3 = 0, 1, cast(id % 50 as int)) as p")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        writers.append(rows, str(tmp_path / "t"), "p")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "p=1").glob("*.parquet"))) > 1


def test_catalog_tables(spark, tmp_path):
    for n in (3, 5):
        writers.swap_table(spark.range(n).withColumn("p", F.lit(1)), "swapped", "p")
        assert spark.table("swapped").count() == n
    writers.external_table(
        spark, "scraped", str(tmp_path / "ext"),
        {"source_url": ("string", "the url"), "part_date": ("date", "its day")}, "part_date", "texts",
    )
    assert spark.catalog.getTable("scraped").tableType == "EXTERNAL"
    writers.refresh(spark, "scraped")
    assert tables.scan_table(spark, "swapped").count() == 5
    spark.range(4).createOrReplaceTempView("agg")
    writers.export_view(spark, "agg", str(tmp_path / "agg"))
    assert tables.scan_table(spark, str(tmp_path / "agg")).count() == 4
    stamp = writers.dump_stamped(spark.range(2), str(tmp_path), "labels", datetime(2024, 1, 2, 3, 4))
    assert stamp.endswith("labels.2024-01-02T0304.parquet")


def test_chunks(spark, tmp_path):
    rows = spark.range(10_000).selectExpr("id", "if(id % 3 = 0, 7, cast(id % 30 as int)) as day")
    assert writers.write_chunks(rows, str(tmp_path / "c"), "day", 1000) == {"rows": 10_000}
    sizes = spark.read.parquet(str(tmp_path / "c")).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) <= 1000


def test_streamed_archives_are_read_once(spark, tmp_path):
    src, dest, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    src.mkdir()
    header = "\t".join(GKG.schema.names)
    write_zip(src / "20240101.gkg.csv.zip", [header, "20240101\t3" + "\t" * 9])
    for expected in ([3], [3], [3, 4]):
        if expected == [3, 4]:
            write_zip(src / "20240102.gkg.csv.zip", [header, "20240102\t4" + "\t" * 9])
        (src / "20240103.gkg.csv.zip").write_bytes(b"broken")
        rows, errors = ingest.stream_archives(spark, str(src), GKG)
        ingest.ingest_available(rows, dest, mark, "pub_date")
        ingest.ingest_available(errors, dest + "-errors", mark + "-errors")
        assert sorted(r.num_articles for r in spark.read.parquet(dest).collect()) == expected
        assert [r.path[-20:] for r in spark.read.parquet(dest + "-errors").collect()] == ["20240103.gkg.csv.zip"]


def zipped(lines, damage=False):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.CSV", "\n".join(lines))
    data = bytearray(buffer.getvalue())
    if damage:
        data[len(data) // 2] ^= 255
    return bytes(data)


def test_ingest_loses_nothing(spark, sf, tmp_path):
    """Damaged, absent and empty files, files that differ from their checksum, and their repair."""
    lake, folder = daily.Lake(str(tmp_path / "lake")), tmp_path / "feed"
    folder.mkdir()
    lines = [r.value for r in feed_lines(base.bronze(spark, sf).orderBy("ev_id")).limit(3000).collect()]

    def dated(day):
        return ["\t".join([*line.split("\t")[:56], str(day), *line.split("\t")[57:]]) for line in lines]

    good = {day: zipped(dated(day)) for day in range(20240101, 20240107)}
    sums = {day: hashlib.md5(data).hexdigest() for day, data in good.items()}
    entries = [(str(d), f"{d}.export.CSV.zip", "1", sums[d], "u", "events") for d in good]
    listing = spark.createDataFrame(entries, "date_str string, filename string, size_mb string, md5 string, full_url string, event_type string")
    delivered = {**good, 20240102: b"broken", 20240103: zipped(dated(20240103), damage=True), 20240105: b"", 20240106: zipped(["other"])}
    for day, data in delivered.items():
        if day != 20240104:
            (folder / f"{day}.export.CSV.zip").write_bytes(data)
    (folder / "20231231.export.CSV.zip").write_bytes(good[20240101])  # not listed, so never opened
    run = (spark, lake, "events", str(folder), listing, date(2024, 1, 1), date(2024, 1, 31))
    assert daily.ingest(*run) == {"landed": 2, "damaged": 3, "absent": 1}

    def landed():
        return {r.date_added: r["count"] for r in lake.read(spark, "bronze_events").groupBy("date_added").count().collect()}

    assert landed() == {20240101: len(lines)}
    errors = {r.filename[:8]: r.error for r in lake.read(spark, "bronze_ingest_errors").collect()}
    assert sorted(errors) == ["20240102", "20240103", "20240104", "20240106"] and errors["20240104"] == "absent"
    assert daily.ingest(*run) == {"landed": 0, "damaged": 3, "absent": 1}
    for day in (20240102, 20240103, 20240104, 20240106):
        (folder / f"{day}.export.CSV.zip").write_bytes(good[day])
    assert daily.ingest(*run) == {"landed": 4, "damaged": 0, "absent": 0}
    assert landed() == {d: len(lines) for d in good if d != 20240105}
    assert lake.read(spark, "bronze_scraping_checkpoints").count() == 6
    plan = archives.unpack(archives.read_archives(spark, [str(folder)]), False)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_archive_lines_are_all_or_none(spark, tmp_path):
    lines = [f"{i}\t{'é' * (i % 7)}" for i in range(200_000)]
    (tmp_path / "a.zip").write_bytes(zipped(["head", *lines]))
    (tmp_path / "b.zip").write_bytes(zipped(["head", *lines], damage=True))
    out = archives.unpack(archives.read_archives(spark, [str(tmp_path)]), True)
    assert [r.value for r in out.where("error IS NULL").collect()] == lines
    assert [r.path[-5:] for r in out.where("error IS NOT NULL").collect()] == ["b.zip"]


def test_unreadable_partition_values_are_set_aside(spark, tmp_path):
    path = str(tmp_path / "t")

    def frame(rows):
        return spark.createDataFrame(rows, "id int, p int")

    first, second = frame([(1, 5), (2, None)]), frame([(3, 6), (4, None), (4, None)])
    for _round in range(2):
        writers.replace_present(first, path, "p")
        writers.replace_present(second, path, "p")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3]
    assert sorted(r.id for r in spark.read.parquet(writers.unreadable_path(path)).collect()) == [2, 4, 4]
    assert writers.replace_observed(frame([(7, 6), (8, None)]), path, "p") == (6, 6)
    writers.replace_range(frame([(9, 5), (10, None)]), path, "p", 5, 6)
    assert [r.id for r in spark.read.parquet(path).collect()] == [9]
    assert sorted(r.id for r in spark.read.parquet(writers.unreadable_path(path)).collect()) == [2, 4, 4, 8, 10]
    writers.replace_values(frame([(11, 7)]), path, "p", [5, 7])
    assert [r.id for r in spark.read.parquet(path).collect()] == [11]


def test_upsert_touches_only_its_buckets(spark, tmp_path):
    root = str(tmp_path / "u")
    writers.upsert(spark.range(500).selectExpr("id", "0 as v"), root, ["id"])
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet") if p.is_file()}
    ties = spark.createDataFrame([(7, 2), (7, 1), (900, 3)], "id long, v int")
    got = [{r.id: r.v for r in writers.upsert(ties, root, ["id"]).collect()} for _ in range(2)]
    assert got[0] == got[1] and len(got[0]) == 501 and got[0][900] == 3 and got[0][8] == 0
    same = [p for p in before if p.exists() and p.stat().st_mtime_ns == before[p]]
    assert len(same) >= len(before) - 4
    assert writers.upsert(ties.limit(0), root, ["id"]).count() == 501


def test_rebuild_keeps_readers(spark, tmp_path):
    root = str(tmp_path / "s")
    for n in (3, 4, 5, 6):
        assert writers.rebuild(spark.range(n), root).count() == n
    assert writers.latest_snapshot(spark, root).count() == 6
    assert storage.partition_values(spark, root, "snapshot") == ["3", "4"]


def test_urls_are_fetched_once(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()

    def fetcher(url):
        import uuid

        (log / uuid.uuid4().hex).write_text(url)
        return (200, f"<p>{url}</p>", None) if url != "bad" else (500, None, "server")

    wanted = spark.createDataFrame([("a", date(2024, 1, 1)), ("a", date(2024, 1, 2)), ("bad", date(2024, 1, 1)), ("kept", date(2024, 1, 1))], "u string, d date")
    known = spark.createDataFrame([("kept", 1, 200, "<p>old</p>", None)], "u string, response_id long, status_code long, html string, request_err string")
    known = known.withColumn("url_hash", url_hash(F.col("u"))).drop("u")
    got = {(r.source_url, str(r.part_date)): r.scraped_text for r in external.scrape(wanted, known, "u", "d", fetcher).collect()}
    assert len(got) == 4 and got["bad", "2024-01-01"] is None and got["kept", "2024-01-01"].strip() == "old"
    assert sorted(p.read_text() for p in log.iterdir()) == ["a", "bad"]


def test_urls_are_asked_again_after_transport_failures(spark):
    """A timeout is asked again until a server answers; an HTTP failure is an answer."""
    wanted = spark.createDataFrame([("late", date(2024, 1, 1)), ("bad", date(2024, 1, 1))], "source_url string, d date")
    nothing = spark.createDataFrame([], "url_hash string, response_id long, status_code long, html string, request_err string")
    store = nothing
    for fetcher in (external.offline, lambda u: (0, None, "timeout"), lambda u: (200, "<p>x</p>", None) if u == "late" else (500, None, "server")):
        fresh = external.fetch_missing(wanted, store, "source_url", fetcher)
        assert fresh.count() == 2
        store = spark.createDataFrame(store.collect() + fresh.collect(), nothing.schema)
    got = {r.source_url: r for r in external.page_texts(wanted, store, "source_url", "d").collect()}
    assert got["late"].scraped_text.strip() == "x" and got["bad"].status_code == 500
    assert external.fetch_missing(wanted, store, "source_url").count() == 0


def test_encoder_sees_each_text_once(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    plain = embedding.hashed_words(8)

    def counting(texts):
        import uuid

        (log / uuid.uuid4().hex).write_text(str(len(texts)))
        return plain(texts)

    rows = spark.range(600).selectExpr("concat('text ', id % 200) as t")
    cache, _, _ = embedding.build_cache(rows, "t", "v", counting, 3, "about ")
    assert cache.count() == 200 and cache.distinct().count() == 200
    assert sum(int(p.read_text()) for p in log.iterdir()) == 200


def test_daily_job(spark, sf, tmp_path):
    """Archives to summaries, twice, with the same result."""
    lake, folder = daily.Lake(str(tmp_path / "lake")), tmp_path / "feed"
    folder.mkdir()
    rows = base.bronze(spark, sf)
    lines = feed_lines(rows).withColumn("day", F.split("value", "\t")[56])
    by_day = lines.groupBy("day").agg(F.collect_list("value").alias("v")).collect()  # a small fixture
    entries = []
    for r in by_day:
        name = f"{r.day}.export.CSV.zip"
        write_zip(folder / name, r.v)
        entries.append((r.day, name, "1", hashlib.md5((folder / name).read_bytes()).hexdigest(), name, "events"))
    names = "date_str string, filename string, size_mb string, md5 string, full_url string, event_type string"
    files = spark.createDataFrame(entries, names)
    start, end = date(2024, 1, 1), date(2024, 1, 31)
    d = base.dicts(spark, sf)
    pages = fx.table(spark, sf, "pages")
    urls = rows.select("source_url").distinct().orderBy("source_url").limit(20)
    numbered = urls.selectExpr("source_url", "row_number() over (order by source_url) - 1 as page_id")
    responses = numbered.join(pages.drop("url"), "page_id").select(
        url_hash(F.col("source_url")).alias("url_hash"), F.lit(200).alias("status_code"), "html",
        F.lit(None).cast("string").alias("request_err"), F.col("page_id").alias("response_id"),
    )
    writers.append(fx.view(spark, sf, fx.BRONZE_GKG), lake.path("bronze_gkg"), "pub_date")
    writers.append(fx.view(spark, sf, fx.BRONZE_COUNTS), lake.path("bronze_gkgcounts"), "pub_date")
    whole = gold.heat_by_location(gold.heat_by_event(silver.silver_events(rows, d)))
    counts = []
    for force in (False, True):
        daily.ingest(spark, lake, "events", str(folder), files, start, date(2024, 1, 10), force)
        daily.ingest(spark, lake, "events", str(folder), files, start, end, force)
        daily.refresh_silver(spark, lake, d, start, end)
        daily.refresh_heat(spark, lake, start, end)
        daily.refresh_root_heat(spark, lake, d, start, end)
        daily.refresh_country_tables(spark, lake, d, start, end)
        daily.refresh_silver_gkg(spark, lake, date(2024, 1, 1), end)
        daily.refresh_silver_counts(spark, lake, d, date(2024, 1, 1), end)
        daily.refresh_place_tables(spark, lake, d)
        daily.refresh_zone_forecast(spark, lake)
        daily.refresh_embedding_caches(spark, lake, d, embedding.hashed_words(8), 8)
        daily.refresh_forecast(spark, lake, end)
        daily.refresh_top_news(spark, lake, responses, start, end)
        daily.refresh_summaries(
            spark, lake, "Sum up:\n{news_text}", digest_completer, "m1", {"max_tokens": 9}, 4, start, end
        )
        daily.refresh_embeddings(spark, lake, embedding.hashed_words(8), start, end)
        tables_ = ["bronze_events", "bronze_scraping_checkpoints", "silver_events", "heat_indicator_by_event",
                   "heat_indicator_by_date_location", "heat_indicator_by_date_location_forecast_7d",
                   "scraping_results", "summary_results", "event_embeddings", "heat_indicator_by_event_root",
                   *daily.COUNTRY_TABLES, "silver_gkg", "silver_gkgcounts", "scraping_responses"]
        rebuilt = ["geo_locations_helper", "geo_zones_helper", "zone_heat_series", "country_embeddings",
                   "event_description_embeddings", "place_embeddings"]
        counts.append([lake.read(spark, t).count() for t in tables_])
        counts[-1] += [writers.latest_snapshot(spark, lake.path(t)).count() for t in rebuilt]
    assert counts[0] == counts[1]
    assert counts[0][0] == counts[0][2] == counts[0][8] == rows.count() and counts[0][1] == len(by_day)
    assert all(counts[0])
    assert lake.read(spark, "heat_indicator_by_date_location").count() == whole.count()
    for _round in range(2):  # the second run finds nothing to label
        labels = daily.refresh_labels(spark, lake, "Label:\n{news_text}", label_completer, "m1", {"max_tokens": 9})
        texts = lake.read(spark, "scraping_results").where("scraped_text is not null")
        assert labels.count() == texts.select("url_hash").distinct().count() > 0
    daily.training_extract(lake.read(spark, "silver_events"), str(tmp_path / "train"), embedding.hashed_words(8), 0.5)
    assert spark.read.parquet(str(tmp_path / "train")).count() > 0


def test_bronze_variants(spark, sf):
    dated = silver.dated_events(base.bronze(spark, sf)).schema
    assert dated["ev_date"].dataType.typeName() == "date" and len(dated) == 58
    listed = silver.listed_counts(fx.view(spark, sf, fx.BRONZE_COUNTS)).first()
    assert isinstance(listed.event_ids, list) and isinstance(listed.pub_date, date)


ALL_PARTS = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}


def parts(df):
    return df.select(F.spark_partition_id()).distinct().count()


def test_events_of_one_file_are_widened_and_parsed_by_many_tasks(spark, tmp_path):
    spark.range(400).selectExpr(
        "id AS event_id", "timestamp '2024-01-01' + make_interval(0, 0, 0, int(id % 2)) AS ts", "id % 7 AS user_id",
        "'view' AS event_type", "1.5D AS value",
    ).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.sql("SELECT 1 AS n_nationkey, 'PERU' AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    plain, rows = (base.bronze(spark, str(tmp_path), spread) for spread in (False, True))
    assert {r.asDict()["ev_id"]: r for r in rows.collect()} == {r.asDict()["ev_id"]: r for r in plain.collect()}
    lines = day_lines(rows).where("day >= 20240102")
    assert lines.count() == 200
    assert {r.value for r in lines.collect()} == {r.value for r in feed_lines(rows.where("date_added = 20240102")).collect()}
    # The condition needs one cell, not the line.
    assert "split(" not in lines._jdf.queryExecution().optimizedPlan().toString()
    (tmp_path / "feed").mkdir()
    with scoped(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "60"}):  # a day's lines go through several batches
        sent = {r.day: r.filename for r in zip_days(day_lines(rows), str(tmp_path / "feed")).collect()}
    assert sent == {d: f"{d}.export.CSV.zip" for d in (20240101, 20240102)}
    read = archives.archive_lines(spark, str(tmp_path / "feed"), EVENTS).where("day = '20240102'")
    assert sorted(r.value.decode() for r in read.where("value IS NOT NULL").collect()) == sorted(r.value for r in lines.collect())
    with scoped(spark, ALL_PARTS):
        assert parts(lines) > 1
        assert parts(archives.typed_rows(read, EVENTS)) > 1


def test_one_archive_with_lines_without_a_day_is_ingested_by_many_tasks(spark, tmp_path, monkeypatch):
    written = []

    @contextmanager
    def watched(df, label):
        with staged(df, label) as read:
            written.append(read.select(F.input_file_name()).distinct().count())
            yield read

    monkeypatch.setattr(daily, "staged", watched)
    (tmp_path / "feed").mkdir()
    at, name = [f.name for f in EVENTS.schema.fields].index("date_added"), "20240101.export.CSV.zip"
    days = ["20240101" if n % 4 else "" for n in range(200)]
    write_zip(tmp_path / "feed" / name, ["\t".join(["7"] * at + [day]) for day in days])
    listing = spark.createDataFrame([("20240101", name, "1", "", name, "events")], "date_str string, filename string, size_mb string, md5 string, full_url string, event_type string")
    lake = daily.Lake(str(tmp_path / "lake"))
    with scoped(spark, ALL_PARTS):
        for _run in range(2):
            got = daily.ingest(spark, lake, "events", str(tmp_path / "feed"), listing, date(2024, 1, 1), date(2024, 1, 2), force=True)
            assert got == {"landed": 1, "damaged": 0, "absent": 0}
    assert len(written) == 2 and min(written) > 1
    waiting = spark.read.parquet(writers.unreadable_path(lake.path("bronze_events")))
    assert sorted(r.line for r in waiting.select("line").collect()) == [n + 1 for n in range(200) if n % 4 == 0]
    assert lake.read(spark, "bronze_events").count() == 150
