"""Event sentences, hashes, prompts, completions and page text."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _shown(c: Column) -> Column:
    """How a missing value reads inside a sentence."""
    return F.coalesce(c, F.lit("None"))


def place_path(country: Column, state: Column, location: Column) -> Column:
    return F.concat_ws(" / ", _shown(country), _shown(state), _shown(location))


def _actor(prefix: str, name: Column, kind: Column, close: str) -> Column:
    label = F.concat(F.lit(prefix), name)
    typed = F.concat(label, F.lit(" (type: "), kind, F.lit(close))
    return F.coalesce(F.trim(F.coalesce(typed, label)), F.lit(""))


def event_sentence(
    a1_name: Column,
    a1_type: Column,
    root_desc: Column,
    desc: Column,
    a2_name: Column,
    a2_type: Column,
    place: Column,
    url: Column,
) -> Column:
    """Subject, verb, object, place and source of an event as one sentence."""
    # Wording and spacing, which embeddings of the sentence depend on.
    return F.concat(
        _actor("Actor 1: ", a1_name, a1_type, " )"),
        F.lit(" performed action "),
        _shown(root_desc),
        F.lit(", more specifically "),
        _shown(desc),
        F.lit(" "),
        _actor("on Actor 2: ", a2_name, a2_type, ")"),
        F.lit("  This took place in: "),
        _shown(place),
        F.lit("  and was reported in: "),
        _shown(url),
    )


def full_description(quad: Column, root: Column, desc: Column) -> Column:
    """`quad - root - event`; blank when the quad class or the event is unknown."""
    whole = F.concat(quad, F.lit(" - "), F.coalesce(root, F.lit("")), F.lit(" - "), desc)
    return F.coalesce(whole, F.lit(""))


def hash_prefix(length: int, *cols: Column) -> Column:
    """First hex digits of the SHA-256 of the concatenated columns."""
    return F.substring(F.sha2(F.concat(*cols), 256), 1, length)


def url_hash(url: Column) -> Column:
    return hash_prefix(32, url)


def indent_of(template: str) -> int:
    """Width of the first indented line."""
    found = re.search(r"(?m)^ +", template)
    return len(found.group()) if found else 0


def outdent(text: Column, width: int) -> Column:
    """Drop `width` leading blanks from every line that has them."""
    if width == 0:
        return text
    return F.regexp_replace(text, f"(?md)^ {{{width}}}", "")


def build_prompt(template: str, text: Column) -> Column:
    """Put a whole text into the `{news_text}` slot; a model with an input limit answers with an error."""
    before, after = template.split("{news_text}")
    return outdent(F.concat(F.lit(before), text, F.lit(after)), indent_of(template))


def template_hash(template: str) -> str:
    """Short id of a prompt template, computed once on the driver."""
    import hashlib

    stripped = template.strip()
    width = indent_of(stripped)
    if width:
        stripped = re.sub(f"(?m)^ {{{width}}}", "", stripped)
    return hashlib.sha256(stripped.encode("utf8")).hexdigest()[:12]


def completion_topics(completion: Column) -> Column:
    """First line of an answer: topics, or an empty array for `none`."""
    line = F.trim(F.regexp_replace(F.trim(F.get(F.split(completion, "\n"), F.lit(0))), r"^\d\.\s*", ""))
    topics = F.filter(F.split(line, ","), lambda t: t != "")
    return F.when(F.lower(line) == "none", F.array().cast("array<string>")).otherwise(topics)


def _second_line(completion: Column) -> Column:
    line = F.trim(F.get(F.split(completion, "\n"), F.lit(1)))
    return F.trim(F.regexp_replace(line, r"^2\.", ""))


def completion_people(completion: Column) -> Column:
    """Second line of an answer: number of people, thousands separators allowed."""
    return F.replace(_second_line(completion), F.lit(","), F.lit("")).try_cast("bigint")


def completion_error(completion: Column) -> Column:
    line = _second_line(completion)
    return (
        F.when(completion.isNull(), F.lit("no completion"))
        .when(line.isNull(), F.lit("line 2 is missing"))
        .when(completion_people(completion).isNull(), F.concat(F.lit("no number in line 2: "), line))
    )


class _TextOnly(HTMLParser):
    """Collects character data outside scripts, styles, templates and comments."""

    HIDDEN = {"script", "style", "template"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        if tag in self.HIDDEN:
            self.depth += 1

    def handle_endtag(self, tag):
        if tag in self.HIDDEN and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if not self.depth:
            self.pieces.append(data)


def page_text(html: str | None) -> str | None:
    """Readable text of one page, with runs of newlines collapsed."""
    if html is None:
        return None
    parser = _TextOnly()
    parser.feed(html)
    parser.close()
    return re.sub("\n+", "\n", "".join(parser.pieces))


@F.pandas_udf(T.StringType())
def extract_text(html: pd.Series) -> pd.Series:
    """Arrow-batched `page_text`; built-in functions cannot decode every named entity."""
    return html.map(page_text)
