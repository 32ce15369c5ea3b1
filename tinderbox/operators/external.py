"""Jobs that call something outside Spark: page fetches and text completions.

The outside call is an injected function, so it can be a network client on a cluster and a
stand-in elsewhere. Everything around the call stays in built-in functions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tinderbox.functions import text as X
from tinderbox.operators.joins import cached_responses, pending
from tinderbox.schemas import ddl
from tinderbox.session import new_dir

# url -> (status code, body or None, error or None)
Fetcher = Callable[[str], tuple[int, str | None, str | None]]
# (prompt, slot) -> answer; the slot picks a quota, such as one API key per partition
Completer = Callable[[str, int], str]

PROMPTS_HELD = 64


def offline(url: str) -> tuple[int, str | None, str | None]:
    """Fetcher for places without a network."""
    return 0, None, "offline"


def fetch(urls: DataFrame, url: str, fetcher: Fetcher = offline) -> DataFrame:
    """Add status_code, html and request_err, one call per row, batches bounded by Arrow."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [fetcher(u) for u in pdf[url]]
            yield pdf.assign(
                status_code=[g[0] for g in got],
                html=[g[1] for g in got],
                request_err=[g[2] for g in got],
            )

    return urls.mapInPandas(run, f"{ddl(urls.schema)}, status_code bigint, html string, request_err string")


def is_success(status: Column, body: Column) -> Column:
    return status.between(200, 299) & (F.length(body) > 0)


def is_answer(status: Column, error: Column) -> Column:
    """Whether a server answered, with a failure or not; false for a timeout and other transport failures."""
    return error.isNull() | (F.coalesce(status, F.lit(0)) > 0)


RESPONSE_COLUMNS = ["url_hash", "response_id", "status_code", "html", "request_err"]


def fetch_missing(wanted: DataFrame, responses: DataFrame, url: str, fetcher: Fetcher = offline) -> DataFrame:
    """Responses of the wanted urls that have none yet, in the columns of the store. A transport failure is no
    answer, so its url is asked again.

    Each distinct url is fetched once, however many days want it. Store the result before reading it: every
    read of this frame would fetch again.
    """
    distinct = wanted.select(url).where(F.col(url).isNotNull()).distinct().withColumn("url_hash", X.url_hash(F.col(url)))
    known = responses.where(is_answer(F.col("status_code"), F.col("request_err")))
    misses = distinct.join(known.select("url_hash"), "url_hash", "left_anti")
    got = fetch(misses, url, fetcher)
    return got.withColumn("response_id", F.xxhash64("url_hash", "status_code", "html")).select(*RESPONSE_COLUMNS)


def scrape(
    wanted: DataFrame, responses: DataFrame, url: str, day: str, fetcher: Fetcher = offline
) -> DataFrame:
    """Page text per wanted url, from stored responses where possible, fetched otherwise.

    `responses` has url_hash, status_code, html, request_err and response_id. Fetched responses are
    written to a table first, so that no url is fetched twice; keep them with `fetch_missing` instead where a
    later run shall find them.
    """
    fresh = fetch_missing(wanted, responses, url, fetcher)
    path = new_dir(wanted.sparkSession, "responses")
    fresh.write.parquet(path)
    fresh = wanted.sparkSession.read.schema(fresh.schema).parquet(path)
    stored = responses.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fresh.schema])
    return page_texts(wanted, stored.unionByName(fresh), url, day)


def page_texts(wanted: DataFrame, responses: DataFrame, url: str, day: str) -> DataFrame:
    """Page text per wanted url and day from the store; a url without a response has none. Successes come before
    other answers, and these before transport failures."""
    hashed = wanted.select(url, F.col(day).alias("part_date")).withColumn(
        "url_hash", X.url_hash(F.col(url))
    )
    stored = responses.select(
        "url_hash", "response_id", "status_code", "html", "request_err",
        is_success(F.col("status_code"), F.col("html")).alias("ok"),
        F.struct((~is_answer(F.col("status_code"), F.col("request_err"))).alias("unanswered"), "response_id").alias("tie"),
    )
    looked_up = cached_responses(hashed, stored, "url_hash", "ok", "tie")
    ok = is_success(F.col("status_code"), F.col("html"))
    page = looked_up.where("is_hit").withColumn("scraped_text", F.when(ok, X.extract_text("html")))
    return page.select(
        F.col(url).alias("source_url"),
        "scraped_text",
        F.col("status_code").cast("bigint").alias("status_code"),
        "url_hash",
        F.when(ok, F.octet_length("html")).otherwise(0).cast("bigint").alias("scraped_len"),
        F.coalesce(F.length("scraped_text"), F.lit(0)).cast("bigint").alias("scraped_text_len"),
        "request_err",
        "part_date",
    )


def complete(
    df: DataFrame, prompt: str, answer: str, completer: Completer, slots: int | None = None
) -> DataFrame:
    """Add the completion of each prompt and the error of a failed call.

    `slots` fixes the number of partitions, so that each owns one quota. Of a batch, only `PROMPTS_HELD` prompts and
    their answers are Python objects at a time; the rows themselves pass through as Arrow slices.
    """
    spread = df if slots is None else df.repartition(slots)

    def ask(text: str, slot: int) -> tuple[str | None, str | None]:
        try:
            return completer(text, slot), None
        except Exception as err:  # a failed call is a result, not a failed task
            return None, f"API failure: {err!r}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        slot = context.partitionId() if context else 0
        for batch in batches:
            for at in range(0, batch.num_rows, PROMPTS_HELD):
                rows = batch.slice(at, PROMPTS_HELD)
                pairs = [ask(text, slot) for text in rows.column(prompt).to_pylist()]
                added = [pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *added], names=[*rows.schema.names, answer, "error_msg"])

    return spread.mapInArrow(run, f"{ddl(spread.schema)}, `{answer}` string, error_msg string")


def summarize(
    texts: DataFrame,
    id_col: str,
    text_col: str,
    day_col: str,
    template: str,
    completer: Completer,
    model: str,
    params: dict[str, int | str | None],
    slots: int | None = None,
) -> DataFrame:
    """Summary per text; the whole text goes into the prompt."""
    prompt = X.build_prompt(template, F.col(text_col))
    asked = texts.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("ext_id"), F.col(day_col).alias("part_date"), prompt.alias("prompt")
    )
    as_json = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in params.items()]))
    return complete(asked, "prompt", "summary", completer, slots).select(
        "ext_id",
        "summary",
        F.lit(model).alias("model"),
        "prompt",
        F.col("error_msg").isNull().alias("success"),
        "error_msg",
        as_json.alias("llm_req_params"),
        "part_date",
    )


def label(
    texts: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    template: str,
    completer: Completer,
    model: str,
    params: dict[str, int | str | None],
) -> DataFrame:
    """Labels for texts that have none yet for this template and model.

    `labels` has the id column, prompt_tmpl_hash and model. Merge the result with an upsert
    on label_hash.
    """
    tmpl = X.template_hash(template)
    done = labels.where((F.col("prompt_tmpl_hash") == tmpl) & (F.col("model") == model))
    todo = pending(texts.select(id_col, text_col), done, id_col, text_col)
    as_json = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in params.items()]))
    asked = todo.select(
        id_col,
        X.build_prompt(template, F.col(text_col)).alias("prompt"),
        X.hash_prefix(32, F.lit(tmpl), F.col(text_col), F.lit(model), as_json).alias("label_hash"),
    )
    answered = complete(asked, "prompt", "completion", completer)
    topics = X.completion_topics(F.col("completion"))
    people = X.completion_people(F.col("completion"))
    parsed = answered.select(
        "label_hash",
        id_col,
        topics.alias("detected_situations"),
        people.alias("affected_people_count"),
        F.col("completion").alias("raw_completion"),
        F.coalesce("error_msg", X.completion_error(F.col("completion"))).alias("error_msg"),
    )
    as_label = ["detected_situations", "affected_people_count", "raw_completion", "error_msg"]
    return parsed.select(
        "label_hash",
        id_col,
        F.to_json(F.struct(*as_label), {"ignoreNullFields": "false"}).alias("label"),
        F.lit(model).alias("model"),
        as_json.alias("labeling_params"),
        F.lit(tmpl).alias("prompt_tmpl_hash"),
        (
            F.col("detected_situations").isNotNull() & F.col("affected_people_count").isNotNull()
        ).alias("success"),
    )
