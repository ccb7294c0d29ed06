"""Benchmark decontamination: CGK embedding, bit-sampling LSH, edit check.

Benchmark items and documents are sequences of words. The CGK random walk
turns a window into an output sequence: at step j it emits the current word
and moves on if a random bit of (j, word) is 1, so windows at small edit
distance give outputs at small Hamming distance. Sampling few output positions
and hashing them is a locality-sensitive hash for the edit distance; it is
repeated with other walks and positions, for windows of several lengths, until
the wanted recall is reached.

Item-sized windows start where an item has one of its anchors, its rarest
longest words; documents open windows at the same words, so an exact copy of
an item meets it in every table. Every candidate is verified: the item's word
edit distance to the best matching stretch of the document (bit-parallel,
exact) may not exceed (1 - similarity) of the item's words.

The benchmark is small and travels with the tasks in blocks of bounded size;
documents are read once per block, in place, without a shuffle.

Defined cases: null text is empty; an item without words matches nothing;
equal items match alike; repeated documents are checked each; empty tables
give no row. Only the id and text columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_slices

SIMILARITY = 0.8
ANCHORS = 8             # window starts per item
SHORT = 10              # items of fewer words are looked up by intact word pairs
LENGTHS = (6, 12, 24)   # CGK steps of the window lengths; a window has at least as many words
REPEATS = 6             # tables per window length
SAMPLED = 4             # output positions per hash
ITEMS_PER_BLOCK = 20_000
HITS = 50_000           # windows hashed at a time
LANES = 4               # 64-bit words of marks
OTHER = 0xD6E8FEB86659FD93  # hash of every word that no item holds
WORD = re.compile(r"\w+")
MASK = (1 << 64) - 1


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Hasher:
    """The random walks: fixed odd multipliers per (repeat, step)."""

    def __init__(self, seed: int = 17):
        rng = np.random.default_rng(seed)
        steps = max(LENGTHS)
        self.walk = rng.integers(0, 1 << 63, (REPEATS, steps), dtype=np.uint64) * np.uint64(2) \
            + np.uint64(1)
        self.mix = rng.integers(0, 1 << 63, (REPEATS, SAMPLED), dtype=np.uint64) * np.uint64(2) \
            + np.uint64(1)
        self.positions = {n: [np.sort(rng.choice(n, SAMPLED, replace=False))
                              for _ in range(REPEATS)] for n in LENGTHS}

    def hashes(self, line: np.ndarray, at: np.ndarray):
        """The walks over `line` (word hashes, 0 behind each text, where a walk
        stays) from the places `at`: ((length, repeat), hash of each window)."""
        for r in range(REPEATS):
            place = at.copy()
            emitted = np.empty((max(LENGTHS), len(at)), dtype=np.uint64)
            for j in range(max(LENGTHS)):
                symbol = line[place]
                emitted[j] = symbol
                place += ((symbol * self.walk[r, j]) >> np.uint64(63)).astype(np.int64)
            for length in LENGTHS:
                h = np.full(len(at), length * 1000003 + r, dtype=np.uint64)
                for k, position in enumerate(self.positions[length][r]):
                    h = (h ^ (emitted[position] * self.mix[r, k])) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(29)
                yield (length, r), h


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word, 77) or 1


class BenchmarkIndex:
    """Anchors and LSH tables of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY):
        self.items = [(i, w) for i, t in items if (w := words_of(t))]
        self.similarity = similarity
        self.distinct = [frozenset(w) for _, w in self.items]
        seen = Counter(w for _, words in self.items for w in set(words))
        vocabulary = sorted(seen)
        self.ids = {w: i for i, w in enumerate(vocabulary, 1)}  # 0: any other word
        self.end = len(vocabulary) + 1  # stands behind each text
        self.hash_of = np.array([OTHER, *map(word_hash, vocabulary), 0], dtype=np.uint64)
        bit = (self.hash_of >> np.uint64(7)) % np.uint64(64 * LANES)
        self.mark_of = np.zeros((len(bit), LANES), dtype=np.uint64)
        self.mark_of[np.arange(len(bit)), (bit // np.uint64(64)).astype(int)] = \
            np.uint64(1) << (bit % np.uint64(64))
        self.mark_of[[0, self.end]] = 0
        line, of, at = self.line([w for _, w in self.items])
        self.marks = np.zeros((len(self.items), LANES), dtype=np.uint64)
        np.bitwise_or.at(self.marks, of, self.mark_of[line])
        self.length = np.array([len(w) for _, w in self.items], dtype=np.int64)
        self.most = ((1 - similarity) * self.length + 1e-9).astype(np.int64)
        starts = []
        for k, (_, words) in enumerate(self.items):
            first = {w: p for p, w in reversed(list(enumerate(words)))}
            if len(words) < SHORT:
                continue
            fits = [w for w, p in first.items() if len(words) - p >= min(LENGTHS)]
            for w in sorted(fits, key=lambda w: (seen[w], -len(w), first[w]))[:ANCHORS]:
                starts.append((k, first[w]))
        self.starts = np.array(starts, dtype=np.int64).reshape(-1, 2)
        item, offset = self.starts.T
        self.anchor = np.zeros(self.end + 1, dtype=bool)
        self.anchor[line[at[item] + offset]] = True
        # a short item in as many parts as it may have edits, and one more: one
        # of the parts stands untouched, so the first two words of each find it
        self.short: dict[tuple[str, ...], list[tuple[int, int]]] = {}
        for k, (_, words) in enumerate(self.items):
            if len(words) < SHORT:
                parts = int((1 - similarity) * len(words) + 1e-9) + 1
                cuts = [len(words) * i // parts for i in range(parts + 1)]
                for low, high in zip(cuts, cuts[1:]):
                    self.short.setdefault(tuple(words[low:min(high, low + 2)]), []) \
                        .append((k, low))
        self.hasher, self.tables = Hasher(), {}
        room = self.length[item] - offset
        for (length, r), h in self.hasher.hashes(self.hash_of[line], at[item] + offset):
            fit = np.flatnonzero(room >= length)
            fit = fit[np.argsort(h[fit], kind="stable")]
            keys, first, counts = np.unique(h[fit], return_index=True, return_counts=True)
            self.tables[length, r] = (keys, first, counts, fit)

    def line(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All texts behind one another as word ids, with room for a walk
        behind each; the text of each place, and where each text begins."""
        gap = max(LENGTHS) + 1
        sizes = np.array([len(w) + gap for w in texts], dtype=np.int64)
        at = np.cumsum(sizes) - sizes
        line = np.full(int(sizes.sum()), self.end, dtype=np.int64)
        for i, words in zip(at, texts):
            line[i:i + len(words)] = list(map(self.ids.get, words, repeat(0)))
        return line, np.repeat(np.arange(len(texts)), sizes), at

    def candidates(self, texts: list[list[str]], line, of, at) -> np.ndarray:
        """Rows (text, item, word where the item would start), each once."""
        hashes, span = self.hash_of[line], int(self.length.max(initial=0))
        size = len(line) + span + 1

        def code(text, item, start):
            return (text * len(self.items) + item) * size + start + span

        found = [np.zeros(0, dtype=np.int64)]
        hits = np.flatnonzero(self.anchor[line])
        for low in range(0, len(hits), HITS):
            part = hits[low:low + HITS]
            for table, h in self.hasher.hashes(hashes, part):
                keys, first, counts, owners = self.tables[table]
                if not len(keys):
                    continue
                slot = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                window = np.flatnonzero(keys[slot] == h)
                n = counts[slot[window]]
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                owner = owners[np.repeat(first[slot[window]], n) + nth]
                place = np.repeat(part[window], n)
                item, offset = self.starts[owner].T
                found.append(np.unique(code(of[place], item, place - at[of[place]] - offset)))
        if self.short:
            short = [code(t, k, p - low) for t, words in enumerate(texts)
                     for p, w in enumerate(words) for pair in ((w,), tuple(words[p:p + 2]))
                     for k, low in self.short.get(pair, ())]
            found.append(np.array(short, dtype=np.int64))
        pair, start = np.divmod(np.unique(np.concatenate(found)), size)
        return np.column_stack([*np.divmod(pair, max(1, len(self.items))), start - span])

    def possible(self, texts: list[list[str]]) -> np.ndarray:
        """The candidates that enough words speak for. Each edit accounts for
        one missing word at most, and a mark of the item's words that no word
        near the candidate has is a missing word."""
        line, of, at = self.line(texts)
        rows = self.candidates(texts, line, of, at)
        text, item, start = rows.T
        most, size = self.most[item], np.array([len(w) for w in texts], dtype=np.int64)[text]
        low = np.maximum(0, start - 2 * most)
        width = np.minimum(size, start + self.length[item] + 2 * most) - low
        low += at[text]
        keep, marks, step = np.zeros(len(rows), dtype=bool), self.mark_of[line], 1
        while step <= width.max(initial=0):
            # marks[i]: those of `step` words from i; two such runs cover a width below 2 * step
            now = np.flatnonzero((width >= step) & (width < 2 * step))
            near = marks[low[now]] | marks[low[now] + width[now] - step]
            missing = np.bitwise_count(self.marks[item[now]] & ~near).sum(axis=1)
            keep[now] = missing <= most[now]
            marks, step = marks[:-step] | marks[step:], 2 * step
        return rows[keep]

    def matches(self, texts: list[list[str]]) -> list[tuple[int, int, int, int]]:
        """(text, item id, distance, last word) of every verified pair."""
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for t, k, start in self.possible(texts).tolist():
            words, most = self.items[k][1], int(self.most[k])
            if best.get((t, k), (1, 0))[0] == 0:
                continue
            low = max(0, start - 2 * most)
            part = texts[t][low:max(0, start + len(words) + 2 * most)]
            if len(self.distinct[k].difference(part)) > most:
                continue
            distance, end = edit_distance(words, part)
            if distance <= most and distance < best.get((t, k), (most + 1, 0))[0]:
                best[t, k] = (distance, low + end)
        return [(t, self.items[k][0], d, e) for (t, k), (d, e) in best.items()]


def edit_distance(pattern: list[str], text: list[str]) -> tuple[int, int]:
    """Least edit distance of the pattern to any stretch of the text, and
    where that stretch ends: the bit-parallel recurrence over columns."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text, 1):
        eq = masks.get(w, 0)
        x = eq | minus
        d0 = (((x & plus) + plus) ^ plus) | x
        hp, hm = minus | (~(plus | d0) & full), plus & d0
        if hp & top:
            score += 1
        if hm & top:
            score -= 1
        hp, hm = (hp << 1) & full, (hm << 1) & full
        plus, minus = hm | (~(d0 | hp) & full), hp & d0
        if score < best:
            best, end = score, j
    return best, end


def indexes(benchmark: DataFrame, similarity: float,
            items_per_block: int = ITEMS_PER_BLOCK):
    """The benchmark in blocks of about `items_per_block` items, one at a time,
    and whether the block is the only one. Where it is not, its result is
    written before the next one is fetched, so the driver holds one block."""
    blocks = max(1, -(-benchmark.count() // items_per_block))
    for block in range(blocks):
        rows = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield BenchmarkIndex([(r["item_id"], r["text"]) for r in
                              rows.select("item_id", "text").collect()], similarity), blocks == 1


def find_leaks(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
               items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """(doc_id, item_id, distance, last_word): every benchmark item that a
    document holds, up to the allowed edits."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, distance int, last_word int"
    docs = documents.select("doc_id", "text")
    index_type = pa.string() if item_kind == "string" else pa.int64()

    def one(index):
        def run(batches):
            for part, texts in text_slices(batches, rows=200, chars=2_000_000):
                found = sorted(index.matches([words_of(t) for t in texts]),
                               key=lambda m: (m[0], str(m[1])))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array([m[0] for m in found], pa.int64())),
                    pa.array([m[1] for m in found], index_type),
                    pa.array([m[2] for m in found], pa.int32()),
                    pa.array([m[3] for m in found], pa.int32())],
                    names=["doc_id", "item_id", "distance", "last_word"])

        return docs.mapInArrow(run, schema)

    found = []
    for index, alone in indexes(benchmark, similarity, items_per_block):
        found.append(one(index) if alone else staged(one(index), "leaks"))
    return reduce(DataFrame.unionByName, found)


def drop_leaked(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """The documents that hold no benchmark item, with their own columns."""
    kept = documents
    for index, alone in indexes(benchmark, similarity, items_per_block):
        def run(batches, index=index):
            for part, texts in text_slices(batches, rows=200, chars=2_000_000):
                hit = {t for t, *_ in index.matches([words_of(t) for t in texts])}
                yield part.filter(pa.array([i not in hit for i in range(len(texts))]))

        kept = kept.mapInArrow(run, documents.schema)
        if not alone:
            kept = staged(kept, "unleaked")
    return kept
