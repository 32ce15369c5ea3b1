"""The archive source, batches of the archive stream, and what interrupted runs leave behind."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual, StringStartsWith

from tinderbox import session
from tinderbox.schemas import feed
from tinderbox.sinks import storage, writers
from tinderbox.sources import archives
from tinderbox.streaming import ingest

GKG = feed("gkg")
HEADER = "\t".join(GKG.schema.names)


def zipped(lines, member="x.CSV", end="\n"):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(member, end.join(lines).encode())
    return buffer.getvalue()


def gkg(*numbers, day=20240101, **how):
    return zipped([HEADER, *(f"{day}\t{n}" + "\t" * 9 for n in numbers)], **how)


def rows_of(content, header=True, hold=archives.HOLD_BYTES, md5=None):
    out = [r for b in archives.archive_rows("/f/20240101.gkg.csv.zip", content, header, md5, hold) for r in b.to_pylist()]
    assert {(r["filename"], r["day"]) for r in out} == {("20240101.gkg.csv.zip", "20240101")}
    return [(r["line"], r["value"], r["error"]) for r in out]


def test_rows_of_an_archive():
    assert rows_of(zipped(["h", "a", "", "é"], end="\r\n")) == [(1, b"a", None), (3, "é".encode(), None), (3, None, None)]
    assert rows_of(zipped(["a"]), header=False) == [(1, b"a", None), (1, None, None)]
    assert rows_of(zipped(["h"])) == [(0, None, None)] and rows_of(b"", md5="x") == [(0, None, None)]
    for bad in (b"broken", zipped(["h", "a"], member="x.txt"), zipped(["h", "a"])[:40]):
        (row,) = rows_of(bad)
        assert row[:2] == (0, None) and row[2]
    assert rows_of(zipped(["h", "a"]), md5="0" * 32) == [(0, None, "checksum differs from the listed one")]


@pytest.mark.parametrize(("hold", "times"), [(archives.HOLD_BYTES, 1), (10, 2)])
def test_an_archive_is_inflated_once_if_it_can_be_held(monkeypatch, hold, times):
    lines = [f"{i} {'x' * (i % 90)}" for i in range(60_000)]
    opened, plain = [], zipfile.ZipFile.open
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda self, *a, **k: opened.append(a) or plain(self, *a, **k))
    content = zipped(["h", *lines])
    opened.clear()
    got = rows_of(content, hold=hold)
    assert [v.decode() for _, v, _ in got[:-1]] == lines and [n for n, *_ in got] == [*range(1, 60_001), 60_000]
    assert len(opened) == times


def test_conditions_choose_the_files(tmp_path):
    for day in range(20240101, 20240110):
        (tmp_path / f"{day}.gkg.csv.zip").write_bytes(b"x" * (day % 100))
    (tmp_path / "20240103.gkgcounts.csv.zip").write_bytes(b"")
    (tmp_path / "20240104.gkg.csv.sampled_0.1.zip").write_bytes(b"")
    (tmp_path / "20240105.gkg.csv.zip.d").mkdir()

    def listed(*filters, most=1 << 20):
        reader = archives.ArchiveReader({"path": str(tmp_path), "pattern": archives.name_pattern(GKG), "partitionbytes": str(most)})
        left = list(reader.pushFilters(list(filters)))
        return [[p.rsplit("/", 1)[-1][6:8] for p in g.paths] for g in reader.partitions()], left

    day, name = ("day",), ("filename",)
    assert sum(len(g) for g in listed()[0]) == 10
    assert listed(GreaterThan(day, "20240107")) == ([["08", "09"]], [])
    assert listed(GreaterThanOrEqual(day, "20240108"), LessThan(day, "20240109")) == ([["08"]], [])
    assert listed(LessThanOrEqual(day, "20240101"), EqualTo(day, "20240102")) == ([[]], [])
    assert listed(In(name, ("20240104.gkg.csv.sampled_0.1.zip", "20240102.gkg.csv.zip"))) == ([["02", "04"]], [])
    other = [StringStartsWith(day, "2025"), EqualTo(("line",), 3)]
    groups, left = listed(*other, most=9)
    assert left == other and sum(groups, []) == ["01", "02", "03", "04", "04", "05", "06", "07", "08", "09"] and len(groups) == 6


def test_archive_lines(spark, tmp_path):
    (tmp_path / "20240101.gkg.csv.zip").write_bytes(gkg(3, 4))
    (tmp_path / "20240102.gkg.csv.zip").write_bytes(b"broken")
    (tmp_path / "20240103.gkg.csv.zip").write_bytes(b"")
    lines = archives.archive_lines(spark, str(tmp_path), GKG)
    ends = {r.day: (r.line, r.error is None) for r in lines.where("value IS NULL").collect()}
    assert ends == {"20240101": (2, True), "20240102": (0, False), "20240103": (0, True)}
    typed = archives.typed_rows(lines, GKG).where("value_read")
    assert sorted((r.line, r.pub_date, r.num_articles) for r in typed.collect()) == [(1, 20240101, 3), (2, 20240101, 4)]
    window = lines.where("day > '20240101' AND day < '20240103'")
    assert "PushedFilters: [GreaterThan(day,20240101), LessThan(day,20240103)]" in window._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert [r.day for r in window.collect()] == ["20240102"]
    (tmp_path / "none").mkdir()
    assert archives.archive_lines(spark, f"file:{tmp_path}/none", GKG).collect() == []


def test_replace_batch_keeps_other_batches(spark, tmp_path):
    path = str(tmp_path / "t")

    def frame(*rows):
        return spark.createDataFrame(rows, "v int, p int, origin string")

    writers.replace_batch(frame((1, 5, "a"), (2, 6, "a")), path, "batch", "b0", "p", ["origin"])
    writers.replace_batch(frame((3, 5, "b"), (9, None, "b")), path, "batch", "b1", "p", ["origin"])
    for _round in range(2):
        writers.replace_batch(frame((4, 5, "a"), (9, None, "a")), path, "batch", "b0", "p", ["origin"])
    stored = spark.read.parquet(path)
    assert sorted((r.v, r.p, r.batch) for r in stored.collect()) == [(3, 5, "b1"), (4, 5, "b0")] and "origin" not in stored.columns
    assert sorted(r.origin for r in spark.read.parquet(writers.unreadable_path(path)).collect()) == ["a", "b"]
    writers.replace_batch(frame().limit(0), path, "batch", "b0", "p", ["origin"])
    assert [r.v for r in spark.read.parquet(path).collect()] == [3]


def test_staged_rows_are_deleted(spark):
    folder = session.shared_dir(spark)

    def there():
        return [v for v in spark._jvm.java.io.File(folder.removeprefix("file:")).list() if v.startswith("stage-test")]

    with session.staged(spark.range(5), "stage-test") as rows:
        assert rows.count() == 5 and len(there()) == 1
    assert there() == []
    with pytest.raises(RuntimeError), session.staged(spark.range(5), "stage-test"):
        raise RuntimeError
    assert there() == []


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return folder, ingest.Landing(str(folder), GKG, *(str(tmp_path / n) for n in ("table", "ledger", "mark")))


def numbers(spark, to):
    return sorted(r.num_articles for r in to.rows(spark).collect())


def test_cut_batches_leave_what_one_run_leaves(spark, landing, monkeypatch):
    folder, to = landing
    for k in range(5):
        (folder / f"2024010{k + 1}.gkg.csv.zip").write_bytes(gkg(k, k + 10, day=20240101 + k % 2))
    replace, left = writers.replace_batch, [2]

    def failing(*args, **kwargs):
        replace(*args, **kwargs)
        left[0] -= 1
        if left[0] == 0:  # the second batch has its rows, but no ledger
            raise RuntimeError("lost")

    monkeypatch.setattr(writers, "replace_batch", failing)
    with pytest.raises(Exception, match="lost"):
        ingest.land_archives(spark, to, files_per_batch=2)
    assert to.files(spark).count() == 2 and len(numbers(spark, to)) == 8
    monkeypatch.setattr(writers, "replace_batch", replace)
    for _run in range(2):
        ingest.land_archives(spark, to, files_per_batch=2)
        assert numbers(spark, to) == [0, 1, 2, 3, 4, 10, 11, 12, 13, 14]
        assert to.files(spark).count() == 5 and to.damaged(spark).count() == 0


def test_damaged_archives_are_repaired_once(spark, landing):
    folder, to = landing
    for k in (1, 2, 3):
        (folder / f"2024010{k}.gkg.csv.zip").write_bytes(gkg(k) if k == 1 else b"broken")
    assert ingest.repair_archives(spark, to) == 0
    ingest.land_archives(spark, to)
    assert numbers(spark, to) == [1] and to.damaged(spark).count() == 2
    assert ingest.repair_archives(spark, to) == 0 and storage.partition_values(spark, to.table, ingest.BATCH) == ["b0000000000"]
    (folder / "20240102.gkg.csv.zip").write_bytes(gkg(2))
    assert [ingest.repair_archives(spark, to) for _ in range(2)] == [1, 0]
    assert numbers(spark, to) == [1, 2]
    (folder / "20240103.gkg.csv.zip").write_bytes(gkg(3, day=None))
    assert [ingest.repair_archives(spark, to) for _ in range(2)] == [1, 0]
    assert numbers(spark, to) == [1, 2]
    waiting = spark.read.parquet(writers.unreadable_path(to.table)).select("filename", "line", "num_articles")
    assert [tuple(r) for r in waiting.collect()] == [("20240103.gkg.csv.zip", 1, 3)]
    assert to.damaged(spark).count() == 0 and to.files(spark).where(F.col("error").isNull()).count() == 3


def test_a_name_shows_old_or_new_rows(spark, monkeypatch):
    name = "swap_check"

    def shown():
        return spark.table(name).count()

    def versions():
        return writers._versions(spark, name)

    spark.range(2).withColumn("p", F.lit(1)).write.partitionBy("p").saveAsTable(name)  # as older runs left it
    writers.swap_table(spark.table(name).unionByName(spark.range(1).withColumn("p", F.lit(2))), name, "p")
    assert shown() == 3 and spark.table(name).where("p = 2").count() == 1
    point, seen = writers._point, []

    def lost(*_args):
        seen.append(shown())  # a reader between the two steps
        raise RuntimeError("lost")

    monkeypatch.setattr(writers, "_point", lost)
    with pytest.raises(RuntimeError):
        writers.swap_table(spark.range(9).withColumn("p", F.lit(1)), name, "p")
    assert seen == [3] and shown() == 3
    monkeypatch.setattr(writers, "_point", point)
    for n in (4, 5, 6):
        before = spark.table(name)
        writers.swap_table(spark.range(n).withColumn("p", F.lit(1)), name, "p")
        assert shown() == n and before.count() > 0 and len(versions()) == 2
    writers.swap_table(spark.range(1), "default.swap_plain")
    writers.swap_table(spark.range(2), "default.swap_plain")
    assert spark.table("swap_plain").count() == 2
