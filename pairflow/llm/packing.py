"""Sequence packing by non-negative least squares over a length histogram.

Every document is tokenised and closed with the end id. Whole windows of 2048
ids become sequences of their own; what is left is a head (a multiple of 64
ids) and a tail (under 64 ids). Two small histograms follow: tails fill
windows of 64, heads and filled tail windows fill windows of 32 units. For
either, all combinations of few lengths that fill the window exactly are
enumerated, repeat counts are solved against the histogram by non-negative
least squares, rounded down and clipped to what is there. Residual heads are
cut into powers of two, which fill windows exactly; residual tails are packed
greedily, longest first. Only histograms (at most 96 rows) reach the driver;
the plan maps (length, rank) to (sequence, offset) without any join.

Padding: all sequences are full, except the last of the residual heads and
those of the residual tails.

Defined cases: null text counts as empty and holds the end id alone; repeated
rows are packed each; an empty table gives no piece. Only doc_id and text are
read. Checksums are taken while the ids are at hand, so no text is read twice.
"""

from __future__ import annotations

import itertools
import re
import struct
import unicodedata
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import process_memo, staged, text_slices

WINDOW = 2048
UNIT = 64
DEPTH = 4
END_ID = 1
CACHED_CHUNKS = 200_000
LONGEST_KEPT = 40  # letters; longer runs seldom come again
SLICE_ROWS = 4_000  # texts encoded together, of 4 million bytes at most
RANK_ROWS = 20_000  # rows that one task ranks, about


def default_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


# --- token ids -----------------------------------------------------------------

# the four separators that Python takes for white space and the tokenizer does not
SEPARATORS = re.compile("[\x1c-\x1f]")
SPACE = re.compile(r"[^\S\x1c-\x1f]+")


def chunks_of(text: str) -> list[str]:
    if SEPARATORS.search(text):
        return [w for w in SPACE.split(text) if w]
    return text.split()


def chunk_lists(texts: list[str]) -> pa.ListArray:
    """The chunks of each text, empty ones among them."""
    if any(map(SEPARATORS.search, texts)):
        return pa.array([chunks_of(t) for t in texts], pa.list_(pa.string()))
    return pc.utf8_split_whitespace(pa.array(texts, pa.string()))


# what the tokenizer cuts a chunk into, apart from its contractions
PIECE = regex.compile(r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def plain(word: str) -> bool:
    """Letters that normalising and lower case leave letters, so that no sign
    behind them joins their marks."""
    return word.isalpha() and (
        word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


def pieces_of(chunk: str) -> list[str]:
    """Parts of a chunk that the tokenizer encodes one by one; the chunk itself
    where a contraction, a special token, composition or a letter that lower
    case takes apart could join them, or a character is too new to be sure of."""
    if chunk.isalpha() or "'" in chunk or "<|" in chunk or not (
            chunk.isascii() or "\u0130" not in chunk and unicodedata.is_normalized("NFC", chunk)
            and "Cn" not in map(unicodedata.category, chunk)):
        return [chunk]
    return [p.lower() if p.isascii() else p for p in PIECE.findall(chunk)]


STOPS = (".", ",")


def runs_of(chunks: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """For each chunk its leading run, and the number of the stop behind it
    from 1 (0: none). A word is a run, in lower case as far as it is ASCII,
    which the tokenizer does to all letters; any other chunk stays whole."""
    stop = np.zeros(len(chunks), np.int64)
    for number, sign in enumerate(STOPS, 1):
        stop[pc.ends_with(chunks, sign).to_numpy(zero_copy_only=False)] = number
    before = pc.utf8_slice_codeunits(chunks, 0, -1)
    stop[~pc.utf8_is_alpha(before).to_numpy(zero_copy_only=False)] = 0
    ascii_only = pc.string_is_ascii(before).to_numpy(zero_copy_only=False)
    foreign = np.flatnonzero((stop > 0) & ~ascii_only)
    sure = map(plain, strings(before.take(pa.array(foreign))))
    stop[foreign] *= np.fromiter(sure, bool, len(foreign))
    run = pc.if_else(pa.array(stop > 0), before, chunks)
    return pc.if_else(pc.utf8_is_alpha(run), pc.ascii_lower(run), run), stop


def strings(values: pa.StringArray) -> list[str]:
    """Strings without blanks; several times faster than one by one."""
    if not len(values):
        return []
    row = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pc.binary_join(row, " ")[0].as_py().split(" ")


def gathered(values: np.ndarray, sizes: np.ndarray, order: np.ndarray):
    """`values` holds runs of these sizes: those named by `order` in a row,
    and the size of each."""
    taken = sizes[order]
    first = np.cumsum(sizes) - sizes
    at = np.repeat(first[order] - (np.cumsum(taken) - taken), taken)
    at += np.arange(len(at))
    return values[at], taken


# the letter by which the tokenizer's vocabulary writes a byte
SHOWN = [b for b in range(256) if 33 <= b < 127 or 161 <= b != 173]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(sorted({*range(256)} - {*SHOWN}))}


def encoder(path: str, cached: int = CACHED_CHUNKS):
    """texts -> little-endian uint32 ids of each, closed by the end id.

    The tokenizer drops white space and never joins across it, so a text's
    ids are those of its chunks one after another, and a chunk's those of its
    runs of letters, digits and signs. Each distinct run of a call is looked up
    once, in a bounded memo that the worker keeps between tasks. Unknown words
    go straight to the tokenizer's model, the way its own normaliser and byte
    alphabet would hand them over; all else goes through the whole tokenizer."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    model, normalizer = tokenizer.model, tokenizer.normalizer
    memo = process_memo(path)

    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids_of(text: str) -> bytes:
        return packed(tokenizer.encode(text, add_special_tokens=False).ids)

    def ids_of_word(word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return packed([t.id for t in model.tokenize(word)])

    def ids_of_words(words: list[str]) -> list[bytes]:
        out = [ids_of_word(w) if w.isascii() else b"" for w in words]
        foreign = [i for i, w in enumerate(words) if not w.isascii()]
        for a in range(0, len(foreign), 400):
            some = foreign[a:a + 400]
            line = normalizer.normalize_str(" ".join([words[i] for i in some]))
            for i, word in zip(some, line.split(" ")):
                # lower case takes some letters apart
                out[i] = ids_of_word(word) if word.isalpha() else ids_of(words[i])
        return out

    def ids_of_runs(runs: list[str]) -> list[bytes]:
        """Of distinct runs or whole chunks."""
        out = list(map(memo.get, runs))
        unknown = [i for i, ids in enumerate(out) if ids is None]
        cut = {i: pieces_of(runs[i]) for i in unknown if not runs[i].isalpha()}
        parts = {p for pieces in cut.values() for p in pieces}
        words = {runs[i] for i in unknown if i not in cut}
        words.update(p for p in parts if p.isalpha() and p not in memo)
        fresh = dict(zip(words, ids_of_words(list(words))))
        fresh.update((p, ids_of(p)) for p in parts if p not in fresh and p not in memo)
        for i in unknown:
            if i in cut:
                fresh[runs[i]] = b"".join([fresh[p] if p in fresh else memo[p] for p in cut[i]])
            out[i] = fresh[runs[i]]
        short = (item for item in fresh.items() if len(item[0]) <= LONGEST_KEPT)
        memo.update(itertools.islice(short, max(0, cached - len(memo))))
        return out

    signs = [b""] + [ids_of(sign) for sign in STOPS] + [packed([END_ID])]

    def encode(texts: list[str]) -> list[np.ndarray]:
        lists = chunk_lists(texts)
        chunks = lists.values.dictionary_encode()
        run, stop = runs_of(chunks.dictionary)
        run = run.dictionary_encode()
        spelled = ids_of_runs(strings(run.dictionary))
        # each distinct chunk is a run and a sign or none; the last is the end
        order = np.append(np.column_stack([run.indices.to_numpy(), stop + len(spelled)]),
                          [[len(spelled), len(spelled) + len(signs) - 1]], axis=0)
        spelled += signs
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 4
        ids, sizes = gathered(np.frombuffer(b"".join(spelled), "<u4"), sizes, order.ravel())
        sizes = sizes.reshape(-1, 2).sum(axis=1)
        # the chunks of all texts in a row, an end behind each text
        ends = lists.offsets.to_numpy()[1:]
        order = np.insert(chunks.indices.to_numpy(), ends, len(sizes) - 1)
        ids, sizes = gathered(ids, sizes, order)
        cuts = np.cumsum(sizes)[ends + np.arange(len(ends))]
        return np.split(ids, cuts[:-1])

    return encode


def _checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes()) & 0xFFFFFFFF


def binary_parts(units: int) -> list[int]:
    """Powers of two that add up to `units`, largest first."""
    return [1 << b for b in range(units.bit_length() - 1, -1, -1) if units >> b & 1]


def raw_pieces(documents: DataFrame, tokenizer: str, window: int, unit: int,
               with_ids: bool, cached: int = CACHED_CHUNKS) -> DataFrame:
    """One row per whole window, head and tail of a document; a head also
    holds the checksums of its power-of-two parts."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encode = encoder(tokenizer, cached)
        for part, texts in text_slices(batches, rows=SLICE_ROWS, memo=tokenizer):
            rows = []
            for row, ids in enumerate(encode(texts)):
                n, at = len(ids), 0
                head = (n % window) // unit * unit
                for size in [window] * (n // window) + [head, n % unit]:
                    if size:
                        piece = ids[at:at + size]
                        steps = [0] + list(np.cumsum(binary_parts(size // unit)) * unit)
                        crcs = [] if size in (window, n % unit) else [
                            _checksum(piece[a:b]) for a, b in zip(steps, steps[1:])]
                        rows.append((row, at, size, _checksum(piece), crcs, n,
                                     piece.tobytes() if with_ids else None))
                    at += size
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.int64(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(arrays[0]), *arrays[1:]],
                names=["doc_id", "start", "length", "ids_crc32", "parts", "doc_tokens", "ids"])

    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, parts array<long>, "
             "doc_tokens long, ids binary")


# --- the plan --------------------------------------------------------------------

def nnls(a: np.ndarray, b: np.ndarray, steps: int = 600) -> np.ndarray:
    """Active-set non-negative least squares: argmin |ax - b|, x >= 0."""
    x, passive = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    for _ in range(steps):
        gain = a.T @ (b - a @ x)
        gain[passive] = -np.inf
        k = int(np.argmax(gain))
        if gain[k] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        passive[k] = True
        while True:
            s = np.zeros_like(x)
            s[passive] = np.linalg.lstsq(a[:, passive], b, rcond=None)[0]
            bad = passive & (s <= 1e-12)
            if not bad.any():
                break
            ratio = x[bad] / np.maximum(x[bad] - s[bad], 1e-300)
            x = x + ratio.min() * (s - x)
            passive &= x > 1e-12
            x[~passive] = 0
        x = s
    return x


def combinations(total: int, depth: int, present: list[int]) -> list[tuple[int, ...]]:
    """Multisets of 2 to `depth` present lengths that add up to `total`."""
    have, out = set(present), []
    for size in range(2, depth + 1):
        for head in itertools.combinations_with_replacement(sorted(have, reverse=True), size - 1):
            last = total - sum(head)
            if 0 < last <= head[-1] and last in have:
                out.append(head + (last,))
    return out


def solve(counts: dict[int, int], total: int, depth: int,
          rounds: int = 6) -> list[tuple[tuple[int, ...], int]]:
    """Repeat counts of exact combinations: least squares, rounded down, and
    clipped so that no length is used more often than it occurs; then the
    same for what is left, while that gains anything."""
    left, plan = dict(counts), []
    for _ in range(rounds):
        present = [k for k, v in left.items() if v > 0]
        combos = combinations(total, depth, present)
        if not combos:
            break
        row = {k: i for i, k in enumerate(present)}
        a = np.zeros((len(present), len(combos)))
        for j, combo in enumerate(combos):
            for k in combo:
                a[row[k], j] += 1
        repeats = np.floor(nnls(a, np.array([left[k] for k in present], float)) + 1e-6)
        before = len(plan)
        for j in np.argsort(-repeats, kind="stable"):
            uses = {k: combos[j].count(k) for k in combos[j]}
            n = min([int(repeats[j])] + [left[k] // u for k, u in uses.items()])
            if n > 0:
                plan.append((combos[j], n))
                for k, u in uses.items():
                    left[k] -= n * u
        if len(plan) == before:
            break
    for combo in combinations(total, depth, [k for k, v in left.items() if v > 0]):
        n = min(left[k] // combo.count(k) for k in combo)
        if n > 0:  # a repeat count that rounding down had made 0
            plan.append((combo, n))
            for k in combo:
                left[k] -= n
    return plan


def greedy(counts: dict[int, int], window: int, first_free: int) -> list[tuple[list[int], int]]:
    """Pack the rest longest first; equal windows are planned together. The
    first window has only `first_free` ids of room (0: none)."""
    left, plan, room = {k: v for k, v in counts.items() if v > 0}, [], first_free
    while left:
        whole = not room
        free, uses = room or window, {}
        for k in sorted(left, reverse=True):
            n = min(left[k], free // k)
            if n:
                uses[k], free = n, free - n * k
        repeat = min(left[k] // n for k, n in uses.items()) if whole else 1
        plan.append(([k for k, n in uses.items() for _ in range(n)], repeat if uses else 1))
        for k, n in uses.items():
            left[k] -= n * repeat
            if not left[k]:
                del left[k]
        room = 0
    return plan


class Layout:
    """Where the r-th piece of each length goes: ranges of ranks."""

    def __init__(self):
        self.used: dict[int, int] = {}
        self.ranges: dict[int, list] = {}

    def place(self, lengths, repeat, base, offset=0, scale=1):
        """`repeat` windows from number `base`, each holding `lengths`."""
        for k in lengths:
            start = self.used.get(k, 0)
            self.ranges.setdefault(k, []).append((start, base, offset))
            self.used[k] = start + repeat
            offset += k * scale
        return base + repeat

    def at(self, length, ranks):
        rows = np.array(self.ranges[length], dtype=np.int64)
        hit = np.searchsorted(rows[:, 0], ranks, side="right") - 1
        return rows[hit, 1] + ranks - rows[hit, 0], rows[hit, 2]


def plan(histogram: dict[int, int], window: int, unit: int, depth: int) -> dict:
    """The whole packing of a histogram of lengths."""
    tails = {k: v for k, v in histogram.items() if k < unit}
    heads = {k // unit: v for k, v in histogram.items() if unit <= k < window}
    small = Layout()  # tails -> windows of one unit
    filled = 0
    for combo, n in solve(tails, unit, min(depth, 3)):
        filled = small.place(combo, n, filled)
    units = dict(heads)
    units[1] = units.get(1, 0) + filled
    large = Layout()  # units -> sequences
    sequence = histogram.get(window, 0)  # whole windows come first
    for combo, n in solve({k: v for k, v in units.items() if v}, window // unit, depth):
        sequence = large.place(combo, n, sequence, scale=unit)
    # residual heads, cut into powers of two, fill windows one after another
    rest = {k: v - large.used.get(k, 0) for k, v in units.items()}
    position, starts = 0, {}
    for size in sorted({p for k in rest for p in binary_parts(k)}, reverse=True):
        for k in sorted(rest):
            if size in binary_parts(k):
                starts[k, size] = position
                position += size * rest[k]
    per = window // unit
    first = sequence
    sequence += -(-position // per)
    free = (-position % per) * unit
    loose = Layout()  # residual tails -> sequences
    for lengths, n in greedy({k: v - small.used.get(k, 0) for k, v in tails.items()}, window, free):
        if free:
            loose.place(lengths, 1, sequence - 1, window - free)
            free = 0
        else:
            sequence = loose.place(lengths, n, sequence)
    return {"small": small, "large": large, "loose": loose, "starts": starts, "first": first,
            "unit_heads": heads.get(1, 0), "per": per}


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """Number the pieces of each length from 0. Ranks are taken in hashed
    buckets of bounded size, so a length that a third of all documents share
    is spread over many tasks."""
    buckets = max(64, total // RANK_ROWS)
    key = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets))
    pieces = pieces.withColumn("bucket", key)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
               .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0))
                       .alias("base")))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    # lengths x buckets narrow rows; the engine broadcasts them when small
    return (pieces.withColumn("rank", F.row_number().over(inside) - 1)
            .join(offsets, ["length", "bucket"])
            .withColumn("rank", F.col("rank") + F.col("base")).drop("bucket", "base"))


def pack(documents: DataFrame, window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH,
         tokenizer: str | None = None, with_ids: bool = False,
         cached: int = CACHED_CHUNKS) -> DataFrame:
    """Pieces of all documents with their place: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset and, on request, the ids as
    little-endian unsigned 32-bit numbers. A worker keeps the ids of up to
    `cached` pieces of text, about 200 bytes each."""
    if window % unit or (window // unit) & (window // unit - 1):
        raise ValueError("window must be a power of two times unit")
    tokenizer = tokenizer or default_tokenizer()
    pieces = staged(raw_pieces(documents, tokenizer, window, unit, with_ids, cached),
                    "pieces")
    rows = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # <= 96 rows
    histogram = {int(r["length"]): int(r["n"]) for r in rows}
    layout = plan(histogram, window, unit, depth)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def place(frames):
        for frame in frames:
            for length, group in frame.groupby("length", sort=False):
                yield from _placed(group, int(length), layout, window, unit)

    # ids pass through pandas as text, which keeps them exact next to nulls
    rows = ranked(pieces, sum(histogram.values())).withColumn("doc_id", F.col("doc_id").cast("string"))
    out = rows.mapInPandas(
        place, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, "
               "sequence_id long, offset long, ids binary").withColumn(
        "doc_id", F.col("doc_id").cast(kind))
    return out if with_ids else out.drop("ids")


def _placed(group: pd.DataFrame, length: int, layout: dict, window: int, unit: int):
    """Rows of one length -> placed pieces."""
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
               "ids"]
    ranks = group["rank"].to_numpy(np.int64)
    if length == window:
        yield group.assign(sequence_id=ranks, offset=0)[columns]
        return
    if length < unit:
        small = layout["small"].used.get(length, 0)
        inner = ranks < small
        if (~inner).any():
            sequence, offset = layout["loose"].at(length, ranks[~inner] - small)
            yield group[~inner].assign(sequence_id=sequence, offset=offset)[columns]
        group = group[inner]
        if not len(group):
            return
        box, inside = layout["small"].at(length, ranks[inner])
        ranks, units = box + layout["unit_heads"], 1
    else:
        inside, units = np.zeros(len(group), dtype=np.int64), length // unit
    fitted = layout["large"].used.get(units, 0)
    whole = ranks < fitted
    if whole.any():
        sequence, offset = layout["large"].at(units, ranks[whole])
        yield group[whole].assign(sequence_id=sequence, offset=offset + inside[whole])[columns]
    rest, rank, inside = group[~whole], ranks[~whole] - fitted, inside[~whole]
    if not len(rest):
        return
    at = 0
    for i, size in enumerate(binary_parts(units)):
        position = layout["starts"][units, size] + size * rank
        piece = rest.assign(sequence_id=layout["first"] + position // layout["per"],
                            offset=position % layout["per"] * unit + inside)
        if length >= unit:
            span = slice(4 * at * unit, 4 * (at + size) * unit)
            piece = piece.assign(
                start=rest["start"] + at * unit, length=size * unit,
                ids_crc32=[p[i] for p in rest["parts"]],
                ids=[None if b is None else bytes(b)[span] for b in rest["ids"]])
        at += size
        yield piece[columns]
