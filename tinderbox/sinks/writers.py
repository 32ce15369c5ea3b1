"""Table writers.

`rebalance` lets adaptive execution merge small output partitions and split a hot one, so
one crowded day neither becomes one task nor leaves thousands of small files.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tinderbox.session import new_dir
from tinderbox.sinks import storage


def _spread(df: DataFrame, part: str) -> DataFrame:
    return df.hint("rebalance", part)


def _partitioned(df: DataFrame, part: str):
    return _spread(df, part).write.partitionBy(part)


def append(df: DataFrame, path: str, part: str) -> None:
    _partitioned(df, part).mode("append").parquet(path)


def overwrite(df: DataFrame, path: str, part: str) -> None:
    _partitioned(df, part).mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def _overwrite_touched(spread: DataFrame, path: str, part: str) -> None:
    writer = spread.write.partitionBy(part).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def _text(bound: object) -> str:
    return bound.isoformat() if isinstance(bound, date) else str(bound)


def _drop_stale(
    spark: SparkSession, path: str, part: str, low: object, high: object, written: set[str]
) -> None:
    """Drop partitions inside [low, high] that the write left untouched."""
    number = isinstance(low, int)
    for value in storage.partition_values(spark, path, part):
        key = int(value) if number and value.lstrip("-").isdigit() else value
        bounds = (low, high) if number else (_text(low), _text(high))
        if type(key) is type(bounds[0]) and bounds[0] <= key <= bounds[1] and value not in written:
            storage.drop_partition(spark, path, part, value)


def unreadable_path(path: str) -> str:
    """Where the rows of a table wait whose partition value could not be read."""
    return f"{path.rstrip('/')}_unreadable"


def _set_aside(df: DataFrame, target: str, part: str) -> None:
    """Append the rows of `df` without a partition value to the table `target`; rows that wait there
    already, from an earlier run over the same input, are not added again.

    Rows are the same if all their columns are, identity columns included: without those, an equal row of a later
    input passes for one that waits already.
    """
    spark = df.sparkSession
    lost = df.where(F.col(part).isNull())
    lost = lost.withColumn("row_hash", F.sha2(F.to_json(F.struct(*[f"`{c}`" for c in df.columns])), 256))
    if storage.exists(spark, target):
        lost = lost.join(spark.read.parquet(target).select("row_hash"), "row_hash", "left_anti")
    lost.write.mode("append").parquet(target)


def _replace(df: DataFrame, path: str, part: str, identity: Sequence[str] = (), aside: str | None = None) -> dict:
    """Overwrite the partitions that `df` holds; rows without a value are set aside, so that they
    never replace, nor are replaced as, a partition. Returns bounds and partitions written.

    All are observed while writing, so `df` is computed once, unless there are rows to set aside; who has
    costly rows hands in `staged` ones. `identity` columns tell where a row came from; only rows set aside keep them.
    """
    seen = Observation()
    # Observed above the shuffle: an empty input is optimized away together with what is below.
    rows = _spread(df.drop(*identity), part).observe(
        seen,
        F.min(part).alias("low"),
        F.max(part).alias("high"),
        F.collect_set(F.col(part).cast("string")).alias("parts"),
        F.count_if(F.col(part).isNull()).alias("unreadable"),
    )
    _overwrite_touched(rows.where(F.col(part).isNotNull()), path, part)
    if seen.get["unreadable"]:
        _set_aside(df, aside or unreadable_path(path), part)
    return {"low": seen.get["low"], "high": seen.get["high"], "parts": set(seen.get["parts"] or [])}


def replace_range(df: DataFrame, path: str, part: str, low: object, high: object) -> None:
    """Make [low, high] of the table hold exactly the rows of `df`.

    A row outside the range fails the job before anything is committed; one without a value is set
    aside beside the table. Partitions are overwritten first and emptied ones dropped after, so repeating
    the call is safe.
    """
    value = F.col(part)
    outside = F.raise_error(F.concat(F.lit(f"{part} outside the replaced range: "), value.cast("string")))
    checked = F.when(value.isNull() | value.between(F.lit(low), F.lit(high)), value).otherwise(outside)
    written = _replace(df.withColumn(part, checked), path, part)
    _drop_stale(df.sparkSession, path, part, low, high, written["parts"])


def replace_values(df: DataFrame, path: str, part: str, values: list) -> None:
    """Make the listed partitions hold exactly the rows of `df`, which has no others."""
    written = _replace(df.where(F.col(part).isNull() | F.col(part).isin(values)), path, part)
    for value in set(map(_text, values)) - written["parts"]:
        storage.drop_partition(df.sparkSession, path, part, value)


def replace_observed(df: DataFrame, path: str, part: str) -> tuple | None:
    """Replace the range between the smallest and largest partition value of `df`.

    No rows, no change; rows without a value are set aside beside the table.
    """
    written = _replace(df, path, part)
    if written["low"] is None:
        return None
    _drop_stale(df.sparkSession, path, part, written["low"], written["high"], written["parts"])
    return written["low"], written["high"]


def replace_present(df: DataFrame, path: str, part: str, identity: Sequence[str] = ()) -> None:
    """Replace only the partitions that occur in `df` (an increment of whole days); rows without a
    value are set aside beside the table.

    `identity` names columns, such as file and line, that tell equal rows of different origin apart; the table does
    not get them, rows set aside keep them.
    """
    _replace(df, path, part, identity)


def replace_batch(df: DataFrame, path: str, batch: str, key: str, part: str, identity: Sequence[str] = ()) -> None:
    """Make the partition `batch`=`key` of the table hold exactly the rows of `df`, by `part` within it.

    Repeating a batch replaces what it wrote before and drops days that it no longer has; other batches of the
    same days stay. Rows without a value are set aside beside the whole table.
    """
    own = f"{path}/{batch}={key}"
    written = _replace(df, own, part, identity, unreadable_path(path))
    for value in set(storage.partition_values(df.sparkSession, own, part)) - written["parts"]:
        storage.drop_partition(df.sparkSession, own, part, value)


CURRENT = "current_version"


def _versions(spark: SparkSession, name: str) -> list[int]:
    """Numbers of the tables that stand behind `name`, in use or not."""
    base, _, last = name.rpartition(".")
    where = f" IN {base}" if base else ""
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES{where} LIKE '{last}__v*'").collect()]
    numbers = [t.rpartition("__v")[2] for t in found]
    return sorted(int(n) for n in numbers if n.isdigit())


def _current(spark: SparkSession, name: str) -> int:
    """The version that the view `name` shows; 0 if there is no such view."""
    if not spark.catalog.tableExists(name):
        return 0
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return int(properties.get(CURRENT, 0))


def _point(spark: SparkSession, name: str, version: int) -> None:
    """Let `name` show this version, in one statement of the catalog."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{CURRENT}' = '{version}') AS SELECT * FROM {name}__v{version}")


def swap_table(df: DataFrame, name: str, part: str | None = None) -> None:
    """Build the next version of a catalog table beside the one in use, then let the name show it.

    The name is a view on the current version, replaced in one statement: readers see the old rows or the new ones, and a
    run that is cut off leaves the old ones. `df` may read the table itself. The version before stays, so that a reader that has just opened
    it is not cut off; older ones, and what interrupted runs left, are dropped. A plain table of that name is taken over
    once, which takes two statements: it becomes the version before.
    """
    spark, used = df.sparkSession, _current(df.sparkSession, name)
    plain = not used and spark.catalog.tableExists(name)
    version = max([used, *_versions(spark, name)]) + 1 + plain
    writer = df.write.mode("overwrite")
    (writer.partitionBy(part) if part else writer).saveAsTable(f"{name}__v{version}")
    if plain:
        used = version - 1
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__v{used}")
        if part:  # registered partitions still name the folder the table was built in
            spark.catalog.recoverPartitions(f"{name}__v{used}")
    _point(spark, name, version)
    for old in _versions(spark, name):
        if old not in (used, version):
            spark.sql(f"DROP TABLE {name}__v{old}")


def external_table(
    spark: SparkSession, name: str, path: str, columns: dict[str, tuple[str, str]],
    part: str | None = None, comment: str = "",
) -> None:
    """External Parquet table; `columns` maps a name to (type, comment)."""
    body = ", ".join(f"`{c}` {kind} COMMENT '{note}'" for c, (kind, note) in columns.items())
    by = f" PARTITIONED BY (`{part}`)" if part else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING PARQUET{by} "
        f"LOCATION '{path}' COMMENT '{comment}'"
    )


def refresh(spark: SparkSession, name: str) -> None:
    spark.catalog.refreshTable(name)


def merge_newest(
    old: DataFrame | None, new: DataFrame, keys: list[str], newest: list[Column] | None = None
) -> DataFrame:
    """Rows of both frames with one per key; a new row wins over an old one.

    Rows that `newest` leaves tied are told apart by a hash of all their columns, so reruns agree.
    """
    names = [f"`{c}`" for c in new.columns]
    order = [F.col("__new").desc(), *(newest or []), F.sha2(F.to_json(F.struct(*names)), 256)]
    rows = new.withColumn("__new", F.lit(1))
    if old is not None:
        rows = rows.unionByName(old.withColumn("__new", F.lit(0)))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank", "__new")


def committed_snapshots(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed snapshots below `root`."""
    found = [int(v) for v in storage.partition_values(spark, root, "snapshot")]
    return [v for v in found if storage.exists(spark, f"{root}/snapshot={v}/_SUCCESS")]


def latest_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """Newest committed snapshot below `root`."""
    done = committed_snapshots(spark, root)
    return spark.read.parquet(f"{root}/snapshot={max(done)}") if done else None


def keep_newest(spark: SparkSession, root: str, count: int = 2) -> None:
    """Drop all committed snapshots but the newest ones."""
    for old in sorted(committed_snapshots(spark, root))[:-count]:
        storage.drop_partition(spark, root, "snapshot", str(old))


def rebuild(df: DataFrame, root: str) -> DataFrame:
    """Write a whole table as the next snapshot; readers keep the one before until it is complete.

    The newest two snapshots stay, so a reader that has just opened the older one is not cut off.
    """
    spark = df.sparkSession
    taken = [int(v) for v in storage.partition_values(spark, root, "snapshot")]
    target = f"{root}/snapshot={max(taken, default=0) + 1}"
    df.write.parquet(target)
    keep_newest(spark, root)
    return spark.read.parquet(target)


BUCKETS = 64


def read_upserted(spark: SparkSession, root: str) -> DataFrame | None:
    """The table that `upsert` keeps below `root`."""
    buckets = storage.partition_values(spark, root, "key_bucket")
    return spark.read.parquet(root).drop("key_bucket") if buckets else None


def upsert(
    new: DataFrame, root: str, keys: list[str], newest: list[Column] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Merge rows into the table, one per key, and return it; only the hash buckets of keys that occur
    in `new` are rewritten, each swapped in when the job commits. An empty increment changes nothing."""
    spark = new.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    fresh = new.withColumn("key_bucket", bucket)
    old = None
    if storage.partition_values(spark, root, "key_bucket"):
        touched = [r[0] for r in fresh.select("key_bucket").distinct().collect()]  # `buckets` numbers at most
        old = spark.read.parquet(root).where(F.col("key_bucket").isin(touched)).select(*fresh.columns)
    merged = merge_newest(old, fresh, keys, newest)
    # A table cannot be read and overwritten at once: the merged buckets are written beside it first.
    staged = new_dir(spark, "upsert")
    merged.write.parquet(staged)
    _overwrite_touched(_spread(spark.read.schema(merged.schema).parquet(staged), "key_bucket"), root, "key_bucket")
    out = read_upserted(spark, root)
    return new.limit(0) if out is None else out


def write_chunks(df: DataFrame, path: str, day: str, rows_per_file: int = 250_000) -> dict[str, int]:
    """Parquet files of at most `rows_per_file` rows with neighbouring days together.

    The range key ends in a row hash, so a crowded day is spread over several tasks.
    Returns rows written.
    """
    seen = Observation()
    spread = df.withColumn("__h", F.xxhash64(*df.columns))
    ordered = spread.repartitionByRange(F.col(day), F.col("__h")).drop("__h")
    counted = ordered.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return {"rows": seen.get["rows"]}


def ingest_counters(raw: DataFrame, parsed_rows: int, written: DataFrame) -> DataFrame:
    """Files and bytes read, rows kept, files and bytes written, and the size ratio.

    `raw` is a (path, length) listing, `written` a Parquet scan.
    """
    files = written.select(
        F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s")
    ).distinct()
    listed = raw.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b"))
    return files.agg(
        F.count(F.lit(1)).alias("parquet_file_cnt"), F.sum("s").alias("parquet_bytes_written")
    ).select(
        listed.select("n").scalar().alias("raw_file_cnt"),
        listed.select("b").scalar().alias("raw_bytes_read"),
        F.lit(parsed_rows).cast("bigint").alias("row_cnt"),
        "parquet_file_cnt",
        "parquet_bytes_written",
        F.try_divide("parquet_bytes_written", listed.select("b").scalar()).alias("size_ratio"),
    )


def export_dictionary(df: DataFrame, folder: str, name: str) -> None:
    """A dictionary as fully quoted CSV and as Parquet."""
    one = df.coalesce(1)  # a few hundred rows
    one.write.mode("overwrite").option("quoteAll", True).option("header", True).csv(f"{folder}/{name}.std.csv")
    one.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def export_view(spark: SparkSession, view: str, path: str) -> None:
    spark.table(view).write.mode("overwrite").parquet(path)


def dump_stamped(df: DataFrame, folder: str, label: str, now: datetime | None = None) -> str:
    """Write to a folder that carries the time of the dump."""
    stamp = (now or datetime.now(tz=timezone.utc)).strftime("%Y-%m-%dT%H%M")
    target = f"{folder}/{label}.{stamp}.parquet"
    df.write.parquet(target)
    return target
