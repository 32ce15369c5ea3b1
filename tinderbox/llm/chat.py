"""Transcripts to chat turns: a hidden Markov model recovers who speaks, then turns get one form.

Each line is seen as a symbol: the speaker its marker names (if any), whether it is blank, long, or follows
a blank line. Six states, a role and "first line of a turn" or "further line", explain the symbols,
and Viterbi finds the likeliest states. Scores are whole numbers (hundredths of a natural logarithm), so sums do not
depend on their order.

A conversation may hold any share of all lines, so it is cut into chunks of CHUNK_LINES lines by running numbers,
whatever its turn numbers are. A chunk's lines act on the scores as one max-plus matrix; chaining the matrices gives the scores before each chunk, which lets all
chunks run Viterbi at once; chaining their back pointers gives each chunk's last state. The result
is that of one Viterbi run over the whole conversation, ties going to the first state.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tinderbox.llm.common import materialize

ROLES = ("system", "user", "assistant")
NAMES = {
    "system": ("system", "instruction", "instructions", "context"),
    "user": ("user", "human", "question", "q", "customer", "prompter"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "model", "agent"),
}
LONG_LINE = 120
CHUNK_LINES = 256
NEVER = -(10**9)

# Costs of the model. States 0-2 are first lines, 3-5 further lines, of ROLES.
BEGIN_MARKED, BEGIN_PLAIN, BEGIN_OTHER = -10, -150, -900
INSIDE_PLAIN, INSIDE_SAME, INSIDE_OTHER = -5, -500, -600
BLANK_BEGIN, BLANK_INSIDE = -700, -20
BEGIN_AFTER_BLANK, BEGIN_AFTER_LINE, INSIDE_AFTER_BLANK = -30, -150, -420
LENGTH_COST = {"system": (-60, -100), "user": (-50, -110), "assistant": (-100, -50)}  # short, long
START = (-120, -60, -250)
NEXT_ROLE = {
    "system": {"system": -700, "user": -60, "assistant": -300},
    "user": {"system": -700, "user": -400, "assistant": -30},
    "assistant": {"system": -700, "user": -30, "assistant": -400},
}
STAY, LEAVE = -50, -100

_word = {name: role for role, names in NAMES.items() for name in names}
_alternatives = "|".join(sorted(_word, key=len, reverse=True))
MARKER = re.compile(
    rf"\s{{0,3}}(?:#{{1,4}}\s*({_alternatives})\s*(?::|$)|\*\*({_alternatives})\s*:?\*\*\s*:?|\[({_alternatives})\]\s*:?"
    rf"|<\|({_alternatives})\|>|({_alternatives})\s*(?::|>))\s?",
    re.I,
)


def split_marker(line: str) -> tuple[int, str]:
    """(0 without a marker, else 1 + the role's number; the line without its marker)."""
    found = MARKER.match(line)
    if not found:
        return 0, line
    return 1 + ROLES.index(_word[next(filter(None, found.groups())).lower()]), line[found.end() :]


def symbol(line: str, after_blank: bool) -> int:
    """marker * 8 + blank * 4 + long * 2 + after a blank line."""
    marker, rest = split_marker(line)
    blank = marker == 0 and not rest.strip()
    return marker * 8 + blank * 4 + (len(rest) >= LONG_LINE) * 2 + after_blank


def _emissions() -> np.ndarray:
    table = np.zeros((32, 6), np.int64)
    for code in range(32):
        marker, blank, long, after = code >> 3, code >> 2 & 1, code >> 1 & 1, code & 1
        for r, role in enumerate(ROLES):
            begin = BEGIN_PLAIN if not marker else BEGIN_MARKED if marker == r + 1 else BEGIN_OTHER
            inside = INSIDE_PLAIN if not marker else INSIDE_SAME if marker == r + 1 else INSIDE_OTHER
            begin += BEGIN_AFTER_BLANK if after or marker else BEGIN_AFTER_LINE
            inside += INSIDE_AFTER_BLANK * after * (not blank)
            length = 0 if blank else LENGTH_COST[role][long]
            table[code, r] = begin + (BLANK_BEGIN if blank else length)
            table[code, r + 3] = inside + (BLANK_INSIDE if blank else length)
    return table


def _transitions() -> np.ndarray:
    table = np.full((6, 6), NEVER, np.int64)
    for r, role in enumerate(ROLES):
        for phase in (0, 3):
            table[r + phase, r + 3] = STAY
            for s, other in enumerate(ROLES):
                table[r + phase, s] = LEAVE + NEXT_ROLE[role][other]
    return table


EMIT, MOVE = _emissions(), _transitions()


def _forward(codes: list[int], scores: np.ndarray | None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Scores after the codes, and back pointers of each; scores None: the codes open a conversation."""
    back = []
    for code in codes:
        if scores is None:
            scores = np.concatenate([np.array(START), np.full(3, NEVER)]) + EMIT[code]
            back.append(np.full(6, -1))
        else:
            ways = scores[:, None] + MOVE
            back.append(ways.argmax(axis=0))
            scores = ways.max(axis=0) + EMIT[code]
        scores = np.maximum(scores, NEVER)
    return scores, back


def viterbi(codes: list[int]) -> list[int]:
    """States of one conversation in one go."""
    if not codes:
        return []
    scores, back = _forward(codes, None)
    states = [int(scores.argmax())]
    for pointers in reversed(back[1:]):
        states.append(int(pointers[states[-1]]))
    return states[::-1]


def _matrix(codes: list[int]) -> np.ndarray:
    out = np.full((6, 6), NEVER, np.int64)
    np.fill_diagonal(out, 0)
    for code in codes:
        out = np.maximum((out[:, :, None] + MOVE[None]).max(axis=1) + EMIT[code], NEVER)
    return out


Rows = Iterator[dict]


def _streamed(step: Callable[[Rows], Rows], fields: list[tuple[str, pa.DataType]]) -> Callable:
    """Arrow batches to rows, through `step`, and back."""
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for row in step(r for b in batches for r in b.to_pylist()):
            held.append(row)
            if len(held) == 2048:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return run


_KEY = [("conv", pa.string()), ("chunk", pa.int64())]
_LONGS = pa.list_(pa.int64())


def _matrices(rows: Rows) -> Rows:
    """What a chunk does to the scores, and the scores after it if it opens a conversation."""
    for r in rows:
        opening = _forward(r["codes"], None)[0].tolist()
        yield {"conv": r["conv"], "chunk": r["chunk"], "matrix": _matrix(r["codes"]).ravel().tolist(), "opening": opening}


def _entering(rows: Rows) -> Rows:
    """Scores before each chunk, less the best of them; rows come by conversation and chunk."""
    conv, scores = None, None
    for r in rows:
        if r["conv"] != conv:
            conv, scores = r["conv"], None
        yield {"conv": conv, "chunk": r["chunk"], "entering": None if scores is None else scores.tolist()}
        if scores is None:
            scores = np.array(r["opening"])
        else:
            scores = (scores[:, None] + np.array(r["matrix"]).reshape(6, 6)).max(axis=0)
        scores = np.maximum(scores - scores.max(), NEVER)  # only differences count; sums would reach NEVER


def _pointers(rows: Rows) -> Rows:
    """For each last state of a chunk, the last state of the chunk before; and the best last state."""
    for r in rows:
        scores, back = _forward(r["codes"], None if r["entering"] is None else np.array(r["entering"]))
        at = np.arange(6)
        for pointers in reversed(back):
            at = pointers[at] if pointers[0] >= 0 else at
        yield {"conv": r["conv"], "chunk": r["chunk"], "before": at.tolist(), "best": int(scores.argmax())}


def _leaving(rows: Rows) -> Rows:
    """The last state of each chunk; rows come by conversation, last chunk first."""
    conv, state = None, 0
    for r in rows:
        if r["conv"] != conv:
            conv, state = r["conv"], r["best"]
        yield {"conv": conv, "chunk": r["chunk"], "leaving": state}
        state = r["before"][state]


def _states(rows: Rows) -> Rows:
    """States of a chunk's lines, and how many turns have begun with each."""
    for r in rows:
        _, back = _forward(r["codes"], None if r["entering"] is None else np.array(r["entering"]))
        states = [r["leaving"]]
        for pointers in reversed(back[1:]):
            states.append(int(pointers[states[-1]]))
        states.reverse()
        begun = np.cumsum([s < 3 for s in states]).tolist()
        yield {"conv": r["conv"], "chunk": r["chunk"], "states": states, "begun": begun, "begins": begun[-1]}


def _spoken(rows: Rows) -> Rows:
    """Turns before each chunk; rows come by conversation and chunk."""
    conv, total = None, 0
    for r in rows:
        if r["conv"] != conv:
            conv, total = r["conv"], 0
        yield {"conv": conv, "chunk": r["chunk"], "spoken_before": total}
        total += r["begins"]


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds code, chunk and place in the chunk. Lines come in order, and conversations and tasks too, so a task's number
    and the running number of a line within task and conversation tell its place in the conversation."""
    task, conv, at = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        codes = [symbol(t or "", bool(a)) for t, a in zip(batch.column("line").to_pylist(), batch.column("after_blank").to_pylist(), strict=True)]
        chunks, places = [], []
        for key in batch.column("conv").to_pylist():
            if key != conv:
                conv, at = key, 0
            chunks.append((task << 32) + at // CHUNK_LINES)
            places.append(at % CHUNK_LINES)
            at += 1
        columns = [batch.column("conv"), pa.array(chunks, pa.int64()), pa.array(places, pa.int32()), batch.column("line"), pa.array(codes, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["conv", "chunk", "place", "line", "code"])


def coded_lines(texts: DataFrame) -> DataFrame:
    """Lines of texts (conv, turn, text) in order of turn, hash of the text, text and line: conv, chunk, place, line, code.

    (chunk, place) orders the lines of a conversation; no chunk holds more than CHUNK_LINES lines.
    """
    order = ["conv", "turn", "text_hash"]
    ordered = texts.withColumn("text_hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    lines = ordered.withColumn("lines", F.split("text", "\r\n|\n")).select("conv", "lines", F.posexplode("lines").alias("line_no", "line"))
    after = F.when(F.col("line_no") > 0, F.try_element_at("lines", F.col("line_no")).rlike(r"^\s*$")).otherwise(False)
    return materialize(
        lines.select("conv", "line", F.coalesce(after, F.lit(False)).alias("after_blank")).mapInArrow(
            _symbols, "conv string, chunk long, place int, line string, code long"
        ),
        "chat-lines",
    )


def line_states(texts: DataFrame) -> DataFrame:
    """Lines of texts (conv, turn, text) with chunk, place, code, state and `spoken`, the number of the recovered turn."""
    coded = coded_lines(texts)
    place = F.array_sort(F.collect_list(F.struct("place", "code")))
    chunks = materialize(coded.groupBy("conv", "chunk").agg(F.transform(place, lambda x: x["code"]).alias("codes")), "chat-chunks")
    key = ["conv", "chunk"]

    def mapped(df: DataFrame, step: Callable[[Rows], Rows], columns: str, *fields: tuple[str, pa.DataType]) -> DataFrame:
        return df.mapInArrow(_streamed(step, [*_KEY, *fields]), "conv string, chunk long, " + columns)

    # One conversation's chunks pass one task in turn, without their codes: 42 numbers for CHUNK_LINES lines.
    def by_conversation(df: DataFrame, order: Column) -> DataFrame:
        return df.repartition("conv").sortWithinPartitions("conv", order)

    matrices = mapped(chunks, _matrices, "matrix array<bigint>, opening array<bigint>", ("matrix", _LONGS), ("opening", _LONGS))
    entering = mapped(by_conversation(matrices, F.col("chunk").asc()), _entering, "entering array<bigint>", ("entering", _LONGS))
    entered = materialize(chunks.join(entering, key), "chat-entered")
    pointers = mapped(entered, _pointers, "before array<bigint>, best long", ("before", _LONGS), ("best", pa.int64()))
    leaving = mapped(by_conversation(pointers, F.col("chunk").desc()), _leaving, "leaving long", ("leaving", pa.int64()))
    states = mapped(
        entered.join(leaving, key), _states, "states array<bigint>, begun array<bigint>, begins long",
        ("states", _LONGS), ("begun", _LONGS), ("begins", pa.int64()),
    )
    states = materialize(states, "chat-states")
    begins = by_conversation(states.select(*key, "begins"), F.col("chunk").asc())
    counted = mapped(begins, _spoken, "spoken_before long", ("spoken_before", pa.int64()))
    numbered = states.join(counted, key).select(*key, "spoken_before", F.posexplode(F.arrays_zip("states", "begun")).alias("place", "z"))
    numbered = numbered.select(*key, "place", F.col("z.states").alias("state"), (F.col("spoken_before") + F.col("z.begun") - 1).alias("spoken"))
    return coded.join(numbered, [*key, "place"])


def canonical(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>\n"))


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = [split_marker(t or "")[1] for t in batch.column("line").to_pylist()]
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays(
            [pa.array(lines, pa.string()) if n == "line" else batch.column(n) for n in names], names=names
        )


def conversation_key(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit("null"))


def parse_transcripts(parts: DataFrame, conv_type: str = "bigint") -> DataFrame:
    """conv_id, turn, role, text and rendered for every turn recovered from transcript parts (conv_id, part, text).

    Parts are stretches of a transcript in their order; a whole transcript may be one part. A turn ends where
    the model begins the next one; a marker at its head is dropped, as are blank lines around it.
    Null and empty texts are one blank line. A conversation of blank lines has one turn with an empty text.
    Null ids form one conversation. Equal rows count once; different texts at one place follow each other in a
    fixed order. No rows give no rows.
    """
    rows = parts.select(
        conversation_key(F.col("conv_id")).alias("conv"), F.coalesce(F.col("part").cast("long"), F.lit(0)).alias("turn"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).distinct()
    found = line_states(rows)
    opened = found.withColumn("opens", F.col("state") < 3)
    stripped = opened.where("opens").mapInArrow(_strip, opened.schema).unionByName(opened.where("NOT opens"))
    role = F.element_at(F.array(*map(F.lit, ROLES)), (F.col("state") % 3 + 1).cast("int"))
    pieces = F.array_sort(F.collect_list(F.struct("chunk", "place", "line")))
    turns = stripped.withColumn("role", role).groupBy("conv", "spoken", "role").agg(
        F.array_join(F.transform(pieces, lambda p: p["line"]), "\n").alias("text")
    )
    text = F.regexp_replace(F.regexp_replace("text", r"^(?:[^\S\n]*\n)+", ""), r"(?:\n[^\S\n]*)+$", "")
    return turns.select(
        F.when(F.col("conv") != "null", F.substr("conv", F.lit(2))).cast(conv_type).alias("conv_id"),
        F.col("spoken").alias("turn"), "role", text.alias("text"),
    ).withColumn("rendered", canonical(F.col("role"), F.col("text")))


def as_transcripts(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) written as people write transcripts: (conv_id, part, text).

    Four styles by conversation: "User: ...", a "### user" heading, "[USER] ...", and, without names but at the
    head of the first turn, only blank lines between turns. Null roles go unmarked.
    """
    style = F.pmod(F.xxhash64(F.col("conv_id").cast("string")), F.lit(4))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    plain = F.when(F.col("turn") == 0, F.concat(F.initcap(role), F.lit(": "), text)).otherwise(F.concat(F.lit("\n"), text))
    marked = (
        F.when(style == 0, F.concat(F.initcap(role), F.lit(": "), text))
        .when(style == 1, F.concat(F.lit("### "), role, F.lit("\n"), text))
        .when(style == 2, F.concat(F.lit("["), F.upper(role), F.lit("] "), text))
        .otherwise(plain)
    )
    return turns.select("conv_id", F.col("turn").alias("part"), F.when(F.col("role").isNull(), text).otherwise(marked).alias("text"))
