"""The daily job: ordinary functions in order, each rerunnable for the same window."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tinderbox.functions.scalars import int_date
from tinderbox.operators import embedding, external, folding, ranking, vector_cache
from tinderbox.operators.windows import in_int_window, in_window, job_window
from tinderbox.plans import gold, silver
from tinderbox.schemas import feed
from tinderbox.session import WIDE_LOOKUPS, scoped, staged
from tinderbox.sinks import storage, writers
from tinderbox.sources import archives, catalog


RESPONSES = {"url_hash": "string", "response_id": "bigint", "status_code": "bigint", "html": "string", "request_err": "string"}


@dataclass(frozen=True)
class Lake:
    """Where the tables live."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.path(table))


def _stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table that may not exist yet."""
    return spark.read.schema(schema).parquet(path) if storage.exists(spark, path) else spark.createDataFrame([], schema)


def ingest(
    spark: SparkSession, lake: Lake, source: str, folder: str, listing: DataFrame,
    start: date, end: date, force: bool = False,
) -> dict[str, int]:
    """Land the window's unread archives in bronze and record them; numbers of files landed, damaged and absent.

    Archives are chosen by name before any is opened; each is read and inflated once, compared with its listed
    checksum, and read to its end before its first row lands. Only files that were read (or were empty) are recorded;
    damaged and absent ones go to `bronze_ingest_errors` and are tried again next time. Only days present in the
    increment are replaced, so days ingested before stay; rows without a day are set aside with the file and line
    they stood in. What is gathered on the driver is names of the window's files.
    """
    spec = feed(source)
    known = lake.path("bronze_scraping_checkpoints")
    done = _stored(spark, known, listing.schema)
    todo, unread = catalog.new_files(listing, done, source, start, end, force)
    wanted = {r["filename"]: r["md5"] for r in todo.select("filename", "md5").collect()}
    if not wanted:
        return {"landed": 0, "damaged": 0, "absent": 0}
    lines = archives.archive_lines(spark, folder, spec, wanted).where(F.col("filename").isin(list(wanted)))
    with staged(archives.typed_rows(lines, spec), "increment") as increment:
        ends = increment.where("NOT value_read").select("filename", "error").collect()
        faults = {r["filename"]: r["error"] for r in ends if r["error"]}
        landed = [r["filename"] for r in ends if not r["error"]]
        # The increment is written before the files are recorded: a lost run is simply repeated.
        rows = increment.where("value_read").drop("value_read", "error")
        if landed:
            writers.replace_present(rows, lake.path(spec.table), spec.partition, ("filename", "line"))
    faults |= {name: "absent" for name in wanted if name not in landed and name not in faults}
    if landed:
        read = unread.where(F.col("filename").isin(landed))
        writers.append(read.select(*listing.columns), known, "event_type")
    if faults:
        errors = spark.createDataFrame([(source, *f) for f in sorted(faults.items())], "event_type string, filename string, error string")
        writers.append(errors, lake.path("bronze_ingest_errors"), "event_type")
    absent = sum(e == "absent" for e in faults.values())
    return {"landed": len(landed), "damaged": len(faults) - absent, "absent": absent}


def refresh_silver(
    spark: SparkSession, lake: Lake, d: silver.Dictionaries, start: date, end: date
) -> None:
    bronze = in_int_window(lake.read(spark, "bronze_events"), "date_added", start, end)
    rows = silver.silver_events(bronze, d)
    with scoped(spark, WIDE_LOOKUPS):
        writers.replace_range(rows, lake.path("silver_events"), "date_added", start, end)


def refresh_silver_gkg(spark: SparkSession, lake: Lake, start: date, end: date) -> None:
    bronze = in_int_window(lake.read(spark, "bronze_gkg"), "pub_date", start, end)
    rows = silver.silver_gkg(bronze).withColumn("pub_date", int_date(F.col("pub_date")))
    writers.replace_range(rows, lake.path("silver_gkg"), "pub_date", start, end)


def refresh_silver_counts(
    spark: SparkSession, lake: Lake, d: silver.Dictionaries, start: date, end: date
) -> None:
    bronze = in_int_window(lake.read(spark, "bronze_gkgcounts"), "pub_date", start, end)
    writers.replace_range(silver.silver_counts(bronze, d), lake.path("silver_gkgcounts"), "pub_date", start, end)


def refresh_heat(spark: SparkSession, lake: Lake, start: date, end: date) -> None:
    """Heat by event for the window, then by place for the days that this touches: an increment may
    carry, or no longer carry, events of earlier days. Days are gathered, not events."""
    path = lake.path("heat_indicator_by_event")

    def touched() -> set[date]:
        if not storage.exists(spark, path):
            return set()
        days = in_window(lake.read(spark, "heat_indicator_by_event"), "date_added", start, end)
        return {r[0] for r in days.select("indicator_date").distinct().collect()} - {None}

    before = touched()
    events = in_window(lake.read(spark, "silver_events"), "date_added", start, end)
    writers.replace_range(gold.heat_by_event(events), path, "date_added", start, end)
    days = sorted(before | touched())
    if days:
        facts = lake.read(spark, "heat_indicator_by_event").where(F.col("indicator_date").isin(days))
        writers.replace_values(gold.heat_by_location(facts), lake.path("heat_indicator_by_date_location"), "indicator_date", days)


def refresh_root_heat(spark: SparkSession, lake: Lake, d: silver.Dictionaries, start: date, end: date) -> None:
    """Root events with their heat, by the day they happened."""
    days = in_int_window(lake.read(spark, "bronze_events"), "ev_date", start, end)
    rows = gold.root_event_heat(silver.enriched_events(days, d)).withColumn("heat_date", int_date(F.col("heat_date")))
    writers.replace_range(rows, lake.path("heat_indicator_by_event_root"), "heat_date", start, end)


COUNTRY_TABLES = {
    "country_quad_class_agg": (gold.country_quad_class, "ev_date"),
    "country_ev_root_agg": (gold.country_ev_root, "date_added"),
    "country_ev_base_agg": (gold.country_ev_base, "ev_date"),
}


def refresh_country_tables(spark: SparkSession, lake: Lake, d: silver.Dictionaries, start: date, end: date) -> None:
    """The three country aggregates for the window, each by its own day."""
    for table, (aggregate, day) in COUNTRY_TABLES.items():
        bronze = in_int_window(lake.read(spark, "bronze_events"), day, start, end)
        rows = aggregate(silver.enriched_events(bronze, d)).withColumn(day, int_date(F.col(day)))
        writers.replace_range(rows, lake.path(table), day, start, end)


def _touched_days(spark: SparkSession, path: str, part: str, start: date | None, end: date | None) -> tuple[list[str], str, str]:
    """Days of a table inside the window (all without one), and the window's bounds as its folders write them."""
    low = f"{start:%Y%m%d}" if start else ""
    high = f"{end:%Y%m%d}" if end else "9" * 8
    return [d for d in storage.partition_values(spark, path, part) if low <= d <= high], low, high


def refresh_place_tables(
    spark: SparkSession, lake: Lake, d: silver.Dictionaries, start: date | None = None, end: date | None = None
) -> None:
    """Places and zones of all events, from counts that are kept by day: only events of the window's days are read (of all
    days, without a window), whatever the table holds. Days that the window has lost go too."""
    root, bronze = lake.path("place_values"), lake.path("bronze_events")
    there, low, high = _touched_days(spark, bronze, "date_added", start, end)
    days = sorted({*there, *folding.known_days(spark, root, low, high)})
    events = lake.read(spark, "bronze_events").where(F.col("date_added").isin([int(x) for x in there]))
    values = folding.fold(spark, root, gold.place_values(events, "date_added"), days, ["n"])
    writers.rebuild(gold.locations_of(values), lake.path("geo_locations_helper"))
    writers.rebuild(gold.zones_of(values, d.fips_country), lake.path("geo_zones_helper"))


def refresh_zone_forecast(spark: SparkSession, lake: Lake, horizon: int = 1, freq: str = "W") -> None:
    """The dense series of conflict heat by zone, and its forecast from the stored series."""
    grid, centroids = gold.zone_series(lake.read(spark, "silver_events"))
    stored = writers.rebuild(grid, lake.path("zone_heat_series"))
    writers.rebuild(gold.zone_forecast(stored, centroids, horizon, freq), lake.path("zone_heat_forecast"))


# Table, its kind of name, the column that is encoded, and how.
NAME_TABLES = {
    "country_embeddings": ("country", "country", gold.COUNTRY_CACHE),
    "event_description_embeddings": ("event", "full_desc", gold.EVENT_CACHE),
    "place_embeddings": ("place", "geo_full_name", gold.PLACE_CACHE),
}


def refresh_embedding_caches(
    spark: SparkSession, lake: Lake, d: silver.Dictionaries, encoder: embedding.Encoder, dim: int,
    start: date | None = None, end: date | None = None, encoder_name: str = "default",
) -> None:
    """Reduced vectors of country names, event descriptions and place names; `dim` is the encoder's size.

    Names are counted by day and folded, so only events of the window's days are read (of all days, without a window); only names
    that this encoder has not seen are encoded.
    """
    there, low, high = _touched_days(spark, lake.path("bronze_events"), "date_added", start, end)
    events = lake.read(spark, "bronze_events").where(F.col("date_added").isin([int(x) for x in there]))
    for table, (kind, text, how) in NAME_TABLES.items():
        root = lake.path(f"{kind}_name_counts")
        days = sorted({*there, *folding.known_days(spark, root, low, high)})
        counts = folding.fold(spark, root, gold.name_parts(events, "date_added", kind), days, ["n"])
        names = gold.names_of(kind, counts, d)
        vectors = vector_cache.refresh(names, lake.path(f"{kind}_vectors"), text, encoder, encoder_name, min(how["k"], dim), how["prefix"])
        keyed = vectors.select(F.col("text").alias(text), F.col("vector").alias("embedding"))
        writers.rebuild(names.join(keyed, text, "left"), lake.path(table))


def refresh_forecast(spark: SparkSession, lake: Lake, end: date, horizon: int = 7) -> None:
    facts = lake.read(spark, "heat_indicator_by_date_location")
    writers.replace_range(
        gold.country_forecast(facts, end, horizon),
        lake.path("heat_indicator_by_date_location_forecast_7d"),
        "date_predicted", end, end,
    )


def refresh_top_news(
    spark: SparkSession, lake: Lake, responses: DataFrame, start: date, end: date,
    fetcher: external.Fetcher = external.offline, top_k: int = 1,
) -> None:
    """The hottest urls of the window and their page texts. `responses` are those known from elsewhere; what is
    fetched, successes and failures, joins the store `scraping_responses`, so a rerun asks only urls again that no
    server has answered for; a transport failure is stored once."""
    heat = in_window(lake.read(spark, "heat_indicator_by_event"), "date_added", start, end)
    chosen = lake.path("top_news_events")
    writers.replace_range(ranking.hottest_urls(heat, top_k), chosen, "date_added", start, end)
    # Written first: scraping reads the choice several times, and fetches must not depend on
    # a ranking that is computed again after a lost executor.
    top = in_window(spark.read.parquet(chosen), "date_added", start, end)
    store = lake.path("scraping_responses")
    kept = responses.select(*[F.col(n).cast(t).alias(n) for n, t in RESPONSES.items()])
    known = _stored(spark, store, kept.schema).unionByName(kept)
    fresh = external.fetch_missing(top, known, "source_url", fetcher)
    fresh.join(known.select("url_hash", "response_id"), ["url_hash", "response_id"], "left_anti").write.mode("append").parquet(store)
    known = _stored(spark, store, kept.schema).unionByName(kept)
    scraped = external.page_texts(top, known, "source_url", "date_added")
    writers.replace_range(scraped, lake.path("scraping_results"), "part_date", start, end)


def refresh_summaries(
    spark: SparkSession, lake: Lake, template: str, completer: external.Completer, model: str,
    params: dict, slots: int, start: date, end: date,
) -> None:
    texts = in_window(lake.read(spark, "scraping_results"), "part_date", start, end)
    out = external.summarize(
        texts, "url_hash", "scraped_text", "part_date", template, completer, model, params, slots
    )
    writers.replace_range(out, lake.path("summary_results"), "part_date", start, end)


def refresh_labels(
    spark: SparkSession, lake: Lake, template: str, completer: external.Completer, model: str,
    params: dict,
) -> DataFrame:
    """Label texts that have no label for this template and model, and merge the labels in."""
    root = lake.path("news_labels")
    newest = [F.col("part_date").desc()]
    texts = lake.read(spark, "scraping_results").where(F.col("scraped_text").isNotNull())
    texts = ranking.first_per_key(texts, ["url_hash"], newest)
    known = writers.read_upserted(spark, root)
    if known is None:
        known = spark.createDataFrame([], "url_hash string, prompt_tmpl_hash string, model string")
    fresh = external.label(
        texts, known, "url_hash", "scraped_text", template, completer, model, params
    )
    # Equal texts share a label hash; keyed by url too, each url counts as labelled.
    return writers.upsert(fresh, root, ["url_hash", "label_hash"])


def refresh_embeddings(
    spark: SparkSession, lake: Lake, encoder: embedding.Encoder, start: date, end: date
) -> None:
    events = in_window(lake.read(spark, "silver_events"), "date_added", start, end)
    sentences = gold.event_sentences(events)
    vectors = embedding.embed(sentences, "svp_description", "svp_embedding", encoder)
    writers.replace_range(vectors, lake.path("event_embeddings"), "date_added", start, end)


def training_extract(
    silver_events: DataFrame, path: str, encoder: embedding.Encoder, fraction: float,
    seed: int = 0, days: int = 10,
) -> None:
    """Sampled, described and embedded events in one folder per window of `days` days."""
    sampled = silver_events.sample(fraction=fraction, seed=seed)
    sentences = gold.event_sentences(sampled)
    window = F.date_add(F.lit(date(1970, 1, 1)), (F.floor(F.unix_date("date_added") / days) * days).cast("int"))
    vectors = embedding.embed(sentences, "svp_description", "svp_embedding", encoder)
    writers.overwrite(vectors.withColumn("window_start", window), path, "window_start")



EXPORTS = tuple(COUNTRY_TABLES)


def export_country_tables(spark: SparkSession, lake: Lake, folder: str, now: datetime | None = None) -> list[str]:
    """One stamped dump per country aggregate; the folders written."""
    return [writers.dump_stamped(lake.read(spark, table), folder, table, now) for table in EXPORTS]


@dataclass(frozen=True)
class Job:
    """What a run needs to know besides its window; steps without their input are left out.

    `folders` and `listings` (of `catalog.parse_listing`) are by feed name.
    """

    lake: Lake
    dictionaries: silver.Dictionaries
    folders: dict[str, str] = field(default_factory=dict)
    listings: dict[str, DataFrame] = field(default_factory=dict)
    encoder: embedding.Encoder | None = None
    dim: int = 0
    encoder_name: str = "default"
    responses: DataFrame | None = None
    fetcher: external.Fetcher = external.offline
    completer: external.Completer | None = None
    summary: str = ""
    labels: str = ""
    model: str = ""
    params: dict = field(default_factory=dict)
    slots: int = 4
    exports: str | None = None


def steps_of(spark: SparkSession, job: Job, start: date, end: date) -> list[tuple[str, Callable[[], object]]]:
    """Names and calls of a run's steps, in the order in which they need each other."""
    lake, d = job.lake, job.dictionaries
    steps: list[tuple[str, Callable[[], object]]] = [
        (f"ingest {feed}", lambda feed=feed: ingest(spark, lake, feed, job.folders[feed], job.listings[feed], start, end)) for feed in job.folders
    ]
    if "events" in job.folders:
        steps += [
            ("silver events", lambda: refresh_silver(spark, lake, d, start, end)),
            ("heat", lambda: refresh_heat(spark, lake, start, end)),
            ("root heat", lambda: refresh_root_heat(spark, lake, d, start, end)),
            ("country tables", lambda: refresh_country_tables(spark, lake, d, start, end)),
            ("place tables", lambda: refresh_place_tables(spark, lake, d, start, end)),
            ("zone forecast", lambda: refresh_zone_forecast(spark, lake)),
            ("forecast", lambda: refresh_forecast(spark, lake, end)),
        ]
        if job.exports is not None:
            steps.append(("exports", lambda: export_country_tables(spark, lake, job.exports)))
        if job.encoder is not None:
            steps += [
                ("name embeddings", lambda: refresh_embedding_caches(spark, lake, d, job.encoder, job.dim, start, end, job.encoder_name)),
                ("event embeddings", lambda: refresh_embeddings(spark, lake, job.encoder, start, end)),
            ]
        if job.responses is not None:
            steps.append(("top news", lambda: refresh_top_news(spark, lake, job.responses, start, end, job.fetcher)))
            if job.completer is not None and job.summary:
                asks = (job.summary, job.completer, job.model, job.params, job.slots)
                steps.append(("summaries", lambda: refresh_summaries(spark, lake, *asks, start, end)))
            if job.completer is not None and job.labels:
                steps.append(("labels", lambda: refresh_labels(spark, lake, job.labels, job.completer, job.model, job.params)))
    if "gkg" in job.folders:
        steps.append(("silver gkg", lambda: refresh_silver_gkg(spark, lake, start, end)))
    if "gkgcounts" in job.folders:
        steps.append(("silver counts", lambda: refresh_silver_counts(spark, lake, d, start, end)))
    return steps


def run(
    spark: SparkSession, job: Job, start: str | date | None = None, end: str | date | None = None,
    lookback_days: int | str | None = None, since: str | None = None, now: date | None = None,
) -> dict[str, object]:
    """All steps for one window (`windows.job_window`): what each returned, by name.

    Each step can be repeated for the same window, so a run that failed is run again, from the step named `since` if
    those before are to be spared. The first failure ends the run and names its step.
    """
    low, high = job_window(start, end, lookback_days, now)
    steps, done = steps_of(spark, job, low, high), {}
    names = [name for name, _ in steps]
    if since is not None and since not in names:
        raise ValueError(f"no step {since!r} in {names}")
    for name, step in steps[names.index(since) if since else 0 :]:
        try:
            done[name] = step()
        except Exception as err:
            err.add_note(f"in step {name!r} for {low}..{high}; repeat with since={name!r}")
            raise
    return done
