"""Best-fit packing: bin completion with branch and bound.

Documents become token ids plus an end id; longer ones are cut into pieces of the sequence length.
Pieces are dealt into groups of bounded size, and each group is packed by itself: best fit gives a
first solution, then bins are completed around the largest piece left with undominated fillings, least
waste first; branches that waste more than a better solution may waste are cut, those that leave the first
choice least often are searched first, and the best solution stays.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from itertools import chain, combinations, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tinderbox.llm.common import materialize, slices

CAPACITY = 4096
END_ID = 1
# Pieces packed together: each group leaves at most about one sequence unfilled.
GROUP_PIECES = 4000
# Effort of the search in a group: fillings looked at for each bin of the first solution. When it is
# spent, the best solution found so far stands.
EFFORT = 4
# Texts whose distinct words are encoded together.
TEXT_BYTES = 16 << 20
ENCODED_AT_ONCE = 20_000
# Latin parts that are encoded as one string; what stands between them is a token no letters give.
JOINED = 64
BETWEEN = " 0"


def ragged(flat: np.ndarray, ends: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Runs number `at` of a ragged array, one after the other."""
    wanted = lengths[at]
    upto = np.cumsum(wanted)
    return flat[np.repeat(ends[at] - upto, wanted) + np.arange(upto[-1] if len(upto) else 0)]


# Letters below U+0250 that are one letter in lower case too; they need no normalizing.
LATIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+$"
ODD_STOP = re.compile(rb"[^a-z0-9\s][.,]")


def simplified(text: bytes) -> bytes:
    """A plain text in lower case, with white space before stops that end its words: the same tokens from
    fewer different words. Texts in which a stop may belong to other signs stay as they are."""
    if not text.isascii() or b"<|" in text:
        return text
    text = text.lower()
    if ODD_STOP.search(text):
        return text
    return text.replace(b". ", b" . ").replace(b", ", b" , ").replace(b".\n", b" .\n")


def as_text(strings: pa.Array) -> list[str]:
    try:
        return strings.to_pylist()
    except UnicodeDecodeError:
        return [t.decode("utf-8", "replace") for t in strings.view(pa.binary()).to_pylist()]


class WordIds:
    """Token ids of texts from the ids of their words.

    White space always separates tokens and is dropped by this kind of tokenizer, so a text's ids are
    those of its words. Words are split and told apart in Arrow; a Latin word is put into lower case and cut before
    the stops at its end, as the tokenizer does, and each distinct part is encoded once for many texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        # For Latin letters in lower case, normalizing changes nothing and there is nothing to split.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.between = self.letters.encode(BETWEEN, add_special_tokens=False).ids

    def latin_ids(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts of Latin letters, one after the other, and how many each has."""
        if len(self.between) != 1:
            return self.other_ids(parts, self.letters)
        edges = pa.array([*range(0, len(parts), JOINED), len(parts)], pa.int32())
        lines = [line + BETWEEN for line in pc.binary_join(pa.ListArray.from_arrays(edges, parts), BETWEEN + " ").to_pylist()]
        step, ids = ENCODED_AT_ONCE // JOINED, [np.empty(0, np.uint32)]
        for at in range(0, len(lines), step):
            ids += [np.array(e.ids, np.uint32) for e in self.letters.encode_batch_fast(lines[at : at + step], add_special_tokens=False)]
        flat = np.concatenate(ids)
        ends = np.flatnonzero(flat == self.between[0])
        return np.delete(flat, ends), np.diff(ends, prepend=-1) - 1

    def other_ids(self, parts: pa.Array, tokenizer) -> tuple[np.ndarray, np.ndarray]:
        texts, ids, lengths = as_text(parts), [np.empty(0, np.uint32)], []
        for at in range(0, len(texts), ENCODED_AT_ONCE):
            found = [e.ids for e in tokenizer.encode_batch_fast(texts[at : at + ENCODED_AT_ONCE], add_special_tokens=False)]
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32))
            lengths += map(len, found)
        return np.concatenate(ids), np.array(lengths, np.int64)

    def part_ids(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all parts, where those of each part end, and how many these are."""
        latin = pc.match_substring_regex(parts, LATIN)
        order = np.argsort(pc.invert(latin).to_numpy(zero_copy_only=False), kind="stable")  # Latin parts first
        ids, lengths = zip(self.latin_ids(parts.filter(latin)), self.other_ids(parts.filter(pc.invert(latin)), self.whole), strict=True)
        found_lengths = np.concatenate(lengths)
        ends, by_part = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        ends[order], by_part[order] = np.cumsum(found_lengths), found_lengths
        return np.concatenate(ids), ends, by_part

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        lists = pc.ascii_split_whitespace(pa.array(map(simplified, texts), pa.binary()).view(pa.string()))
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary
        core = pc.utf8_rtrim(words, ".,")
        latin = pc.match_substring_regex(core, LATIN)
        cut = pc.and_(latin, pc.not_equal(core, words))
        tails = pc.extract_regex(words.filter(cut), "(?P<tail>[.,]+)$").field("tail")
        cores = pc.if_else(latin, pc.utf8_lower(core), words)
        parts = pa.concat_arrays([cores, tails]).dictionary_encode()
        number = parts.indices.to_numpy()
        flat, ends, lengths = self.part_ids(parts.dictionary)
        # A word's ids are those of its core, then of its tail if it has one.
        at_tail = np.flatnonzero(cut.to_numpy(zero_copy_only=False))
        owner = np.concatenate([np.arange(len(words)), at_tail])
        order = np.argsort(owner, kind="stable")
        number = number[order]
        flat = ragged(flat, ends, lengths, number)
        lengths = np.bincount(owner[order], lengths[number], len(words)).astype(np.int64)
        ends, at = np.cumsum(lengths), coded.indices.to_numpy()
        upto = np.cumsum(lists.value_lengths().to_numpy()).tolist()
        for start, end in zip([0, *upto], upto, strict=False):
            yield np.append(ragged(flat, ends, lengths, at[start:end]), np.uint32(END_ID))


def cutter(path: str, capacity: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path)
        for batch in slices(batches, TEXT_BYTES):
            at, rows = [], []
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            for i, ids in enumerate(words.encode(texts)):
                for k, start in enumerate(range(0, len(ids), capacity)):
                    piece = ids[start : start + capacity]
                    at.append(i)
                    rows.append((k, start, len(piece), zlib.crc32(piece.astype("<u4").tobytes())))
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return cut


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing; bins are lists of positions in `lengths`."""
    bins: list[list[int]] = []
    open_bins: list[tuple[int, int]] = []  # (space, bin), ordered
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect_left(open_bins, (lengths[i], -1))
        if at < len(open_bins):
            space, b = open_bins.pop(at)
        else:
            space, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if space > lengths[i]:
            insort(open_bins, (space - lengths[i], b))
    return bins


def fillings(sizes: list[int], counts: dict[int, int], space: int, most: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """All fillings of a space from the sizes left (ascending) that waste up to `most`, with their waste: least waste
    first, and of equal waste the one whose smallest piece is largest.

    Bit t of `sums[k]` says whether some of the first k pieces, from large to small, add up to t; so only
    choices that lead to a filling are followed, and sums are formed as far as they are asked for.
    """
    pieces = [s for s in reversed(sizes) if s <= space for _ in range(min(counts[s], space // s))]
    sums, mask = [1], (2 << space) - 1

    def smallest(limit: int, target: int) -> Iterator[int]:
        """Places up to `limit` whose piece can be the smallest of pieces that add up to the target."""
        k = max(1, bisect_left(sums, 1, 0, min(limit + 1, len(sums)), key=lambda bits: bits >> target & 1))
        while k <= limit:
            if k == len(sums):
                sums.append(sums[-1] | sums[-1] << pieces[k - 1] & mask)
            if pieces[k - 1] <= target and sums[k - 1] >> (target - pieces[k - 1]) & 1:
                yield k
            k += 1

    for waste in range(min(most, space) + 1):
        target = space - waste
        if not target:
            yield (), waste
            return
        if waste and not sums[-1] >> target & 1:
            continue
        open_places, chosen = [smallest(len(pieces), target)], []
        while open_places:
            k = next(open_places[-1], None)
            if k is None:
                open_places.pop()
                target += chosen.pop() if chosen else 0
                continue
            s = pieces[k - 1]
            target -= s
            if k > 1 and pieces[k - 2] == s:  # of equal pieces, the first ones are taken
                ahead = [k - 1] if target >= s and sums[k - 2] >> (target - s) & 1 else []
                open_places.append(iter(ahead))
            elif target:
                open_places.append(smallest(k - 1, target))
            else:
                yield (*chosen, s), waste
                target += s
                continue
            chosen.append(s)


def dominated(filling: tuple[int, ...], waste: int, left: int) -> bool:
    """Whether a piece that is left (bit s of `left`: a piece of size s is) could take the place of a part of the
    filling: of nothing, of a smaller piece, or of several pieces no larger together. Such a filling leaves
    smaller pieces for later, so it need not be tried. Of more than eight pieces, parts of up to two are tested."""
    window = (2 << waste) - 1
    if left >> 1 & (window >> 1) or any(left >> (s + 1) & (window >> 1) for s in set(filling)):
        return True
    top = len(filling) if len(filling) <= 8 else 2
    return any(left >> sum(part) & window for n in range(2, top + 1) for part in set(combinations(filling, n)))


def least_bins(lengths: list[int], capacity: int) -> int:
    """A lower bound: whole room, and pieces of over half a bin, which share with none of their kind nor with
    pieces too large for what they leave."""
    bound = -(-sum(lengths) // capacity)
    ordered = sorted(lengths)
    upto = np.concatenate([[0], np.cumsum(ordered, dtype=np.int64)])
    half = bisect_left(ordered, capacity // 2 + 1)
    for small in sorted({s for s in ordered if 2 * s <= capacity} | {0}):
        alone = bisect_left(ordered, capacity - small + 1)  # pieces from here on leave less than `small`
        low = bisect_left(ordered, small)
        over = max(alone, half)
        rest = int(upto[half] - upto[low])
        room = (over - half) * capacity - int(upto[over] - upto[half])
        bound = max(bound, len(ordered) - half + max(0, -(-(rest - room) // capacity)))
    return bound


def complete(lengths: list[int], capacity: int, max_nodes: int | None = None) -> list[list[int]]:
    """Pack by bin completion, with best fit as the first incumbent, looking at up to `max_nodes` fillings
    (EFFORT for each bin of best fit, if not given).

    The search runs in waves: in wave d, a solution departs from the fillings tried first d times in
    all, so what was chosen for early bins is tried otherwise as well as what was chosen for late ones.
    """
    best = best_fit(lengths, capacity)
    least = least_bins(lengths, capacity)
    if len(best) <= least:
        return best
    places: dict[int, list[int]] = {}
    for i, s in enumerate(lengths):
        places.setdefault(s, []).append(i)
    counts = {s: len(p) for s, p in places.items()}
    sizes = sorted(counts)
    left = sum(1 << s for s in sizes)
    total, bound, nodes, wave = sum(lengths), len(best), 0, 0
    budget = EFFORT * len(best) if max_nodes is None else max_nodes
    solution: list[tuple[int, ...]] | None = None

    def take(pieces: tuple[int, ...], sign: int) -> None:
        nonlocal left
        for s in pieces:
            counts[s] -= sign
            left = left | 1 << s if counts[s] else left & ~(1 << s)

    more = True
    while more and nodes < budget and bound > least:
        more, wasted, departed = False, 0, 0
        stack: list[list] = []  # [bin's largest, fillings looked at, undominated ones among them, filling in use, its waste]
        down = True
        while down or stack:
            if down and left:
                first = left.bit_length() - 1
                take((first,), 1)
                stack.append([first, 0, 0, None, 0])
            elif down:
                bound, solution = len(stack), [(f[0], *f[3]) for f in stack]
            frame = stack[-1]
            if frame[3] is not None:
                take(frame[3], -1)
                wasted -= frame[4]
                departed -= frame[2] - 1
                frame[3] = None
            down = False
            most = (bound - 1) * capacity - total - wasted
            if bound <= least or nodes >= budget:
                break
            if departed + frame[2] > wave:
                more = True
            elif most >= 0:
                ways = fillings([s for s in sizes if counts[s]], counts, capacity - frame[0], most)
                for filling, waste in islice(ways, frame[1], None):
                    frame[1] += 1
                    nodes += 1
                    take(filling, 1)
                    if not dominated(filling, waste, left):
                        departed += frame[2]
                        frame[2:] = [frame[2] + 1, filling, waste]
                        wasted += waste
                        down = True
                        break
                    take(filling, -1)
                    if nodes >= budget:
                        break
            if not down:
                take((frame[0],), -1)
                stack.pop()
        for frame in stack:  # the wave was ended: everything is left again
            take((frame[0], *(frame[3] or ())), -1)
        wave += 1
    if solution is None:
        return best
    return [[places[s].pop() for s in one] for one in solution]


def packer(capacity: int, max_nodes: int | None) -> Callable:
    def pack(group: pa.Table) -> pa.Table:
        # Arrow, as pandas would turn whole ids beside a null into floats.
        group = group.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "ids_crc32")])
        lengths = group.column("length").to_pylist()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        base = group.column("pack_group")[0].as_py() << 24
        for b, members in enumerate(complete(lengths, capacity, max_nodes)):
            at = 0
            for i in members:
                sequence[i], offset[i] = base + b, at
                at += lengths[i]
        return group.drop_columns(["pack_group"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return pack


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, max_nodes: int | None = None
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    Null and empty texts are one piece, the end id alone. Groups are drawn by a hash of each row's place
    in the written table of pieces, so neither long documents nor repeated ids crowd one group.
    Rows without an id and repeated rows are packed like others; no rows give no rows; other
    columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = materialize(
        docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(
            cutter(tokenizer_path, capacity), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
        ),
        "pack-pieces",
    )
    groups = max(1, -(-pieces.count() // group_pieces))
    drawn = pieces.withColumn("pack_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return drawn.groupBy("pack_group").applyInArrow(
        packer(capacity, max_nodes),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
