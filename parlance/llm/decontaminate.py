"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact verification.

Every benchmark item becomes a weighted bag of word shingles (weight: rarity among the items) and a
64-bit SimHash of it. In a document, windows of each item's own length get the same fingerprint. A
multi-index over four 16-bit blocks finds every item within the Hamming radius: of two fingerprints
at most `radius` apart, at least one block differs in at most radius // 4 bits, and all such block
values are listed. Candidates are verified by the exact weighted Jaccard similarity of the bags.
Windows that share no shingle with an item have similarity 0 with it, so fingerprints are computed
only for windows over a shared shingle; nothing that could be verified is lost by that.

The benchmark is sent to every task, in blocks of at most BLOCK_ITEMS items and BLOCK_CHARS
characters; a larger benchmark is worked off block by block, each a pass over the documents. Rarity
is counted over the whole benchmark before it is cut, so results don't depend on the blocks; a
shingle of one item weighs as much as one of none, so only those of several items are sent along.

Defined results: null texts count as empty; a document or item without words matches nothing; an
item of fewer than five words is one shingle of all its words; the best window of a pair of document
and item is reported, of ties the first; repeated documents are reported as often as they come;
items that are repeated are all reported; items without an id count as others and are reported with
a null. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text
from .shingles import SIZE, WordHashes, shingles, word_hashes

SIMILARITY, RADIUS = 0.8, 23
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 16_000_000
BLOCK_BITS = 16
SCHEMA = "doc_id long, item_id long, start_word int, n_words int, hamming int, similarity double"


def fingerprints(bits: np.ndarray, weights: np.ndarray, width: int) -> np.ndarray:
    """The SimHash of every run of `width` shingles. bits: their hashes, as rows of 64 times -1 or 1."""
    total = np.zeros((len(bits) + 1, 64))
    np.cumsum(bits * weights[:, None], axis=0, out=total[1:])
    return np.packbits(total[width:] - total[:-width] > 1e-9, axis=1, bitorder="little").view(np.uint64).ravel()


def signs(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int8) * 2 - 1


class HammingIndex:
    """All fingerprints within `radius` bits of one asked for, by four tables of 16-bit blocks."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        values = np.arange(1 << BLOCK_BITS, dtype=np.uint32)
        self.blocks = prints.view(np.uint16).reshape(-1, 4)
        # by block value: which masks of change are allowed, nearest first
        self.masks = values[np.bitwise_count(values) <= radius // 4]
        self.tables = [defaultdict(list) for _ in range(4)]
        for table, column in zip(self.tables, self.blocks.T, strict=True):
            for number, value in enumerate(column.tolist()):
                table[value].append(number)
        self.present = [np.array(sorted(t), np.uint32) for t in self.tables]

    def near(self, prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every print, the numbers within the radius and their distances."""
        out = []
        for p, blocks in zip(prints, prints.view(np.uint16).reshape(-1, 4), strict=True):
            found: set[int] = set()
            for table, present, value in zip(self.tables, self.present, blocks, strict=True):
                # the fewer of the two: values in the table, or values within reach
                reach = present[np.bitwise_count(present ^ value) <= self.radius // 4] if len(present) <= len(self.masks) else self.masks ^ value
                for v in reach.tolist():
                    found.update(table.get(v, ()))
            numbers = np.fromiter(found, int, len(found))
            distance = np.bitwise_count(self.prints[numbers] ^ p)
            near = distance <= self.radius
            out.append((numbers[near], distance[near]))
        return out


class Rarity(NamedTuple):
    """Of a whole benchmark: shingles that several items have, how many have each, and the number of items with words."""

    shingles: np.ndarray
    counts: np.ndarray
    items: int


def rarity_of(items: DataFrame, size: int) -> Rarity:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for text in batch.column(0):
                found = np.unique(shingles(word_hashes(text.as_py(), known), size))
                if len(found):
                    # null counts the items
                    yield pa.RecordBatch.from_arrays([pa.array([None, *found.view(np.int64).tolist()], pa.int64())], ["shingle"])

    got = items.select("text").mapInArrow(work, "shingle long").groupBy("shingle").count().where("count > 1 or shingle is null").toArrow()
    number, count = got["shingle"], got["count"].to_numpy()
    none = number.is_null().to_numpy()
    return Rarity(number.drop_null().to_numpy().view(np.uint64), count[~none], int(count[none].sum()))


class Benchmark:
    """What a task needs of a block of items."""

    def __init__(self, items: list[tuple[int | None, str]], similarity: float, radius: int, size: int, rarity: Rarity | None = None):
        known = WordHashes()
        self.size, self.similarity = size, similarity
        hashed = [(i, word_hashes(text or "", known)) for i, text in items]
        hashed = [(i, h) for i, h in hashed if len(h)]
        self.ids = [i for i, _ in hashed]
        self.words = [len(h) for _, h in hashed]
        lists = [shingles(h, size) for _, h in hashed]
        if rarity is None:
            share, every = Counter(s for x in lists for s in set(x.tolist())), len(lists)
        else:
            share, every = dict(zip(rarity.shingles.tolist(), rarity.counts.tolist(), strict=True)), rarity.items
        self.weight = {s: 1 + math.log(every / n) for s, n in share.items() if n > 1}
        self.most = 1 + math.log(max(1, every))
        self.bags = [Counter(x.tolist()) for x in lists]
        self.holders: dict[int, list[int]] = defaultdict(list)
        for number, bag in enumerate(self.bags):
            for s in bag:
                self.holders[s].append(number)
        self.known = np.array(sorted(self.holders), np.uint64)
        self.first = np.zeros(1 << 22, bool)
        self.first[self.known >> np.uint64(42)] = True
        prints = [fingerprints(signs(x), self.weights(x), len(x))[0] for x in lists]
        self.index = HammingIndex(np.array(prints, np.uint64), radius)
        #: shingles of fewer words than `size`, where an item is that short
        self.short = sorted({n for n in self.words if n < size})

    def weights(self, hashes: np.ndarray) -> np.ndarray:
        return np.array([self.weight.get(s, self.most) for s in hashes.tolist()])

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Where a document's shingles are those of an item."""
        at = np.flatnonzero(self.first[hashes >> np.uint64(42)])
        if len(at) and len(self.known):
            at = at[self.known[np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)] == hashes[at]]
        return at

    def matches(self, words: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(item id, first word, words, Hamming distance, similarity) of the best windows."""
        best: dict[int, tuple[float, int, int, int]] = {}
        for size in [*self.short, self.size]:
            hashes = shingles(words, size) if len(words) >= size or size == self.size else words[:0]
            at = self.hits(hashes)
            if not len(at):
                continue
            widths: dict[int, list[int]] = defaultdict(list)
            for place in at.tolist():
                for number in self.holders[int(hashes[place])]:
                    widths[min(len(hashes), max(1, self.words[number] - size + 1))].append(place)
            bits, weights = signs(hashes), None
            for width, places in sorted(widths.items()):
                spots = np.array(sorted(set(places)))
                starts = np.zeros(len(hashes) - width + 2, int)
                np.add.at(starts, np.maximum(0, spots - width + 1), 1)
                np.add.at(starts, np.minimum(len(starts) - 1, spots + 1), -1)
                starts = np.flatnonzero(np.cumsum(starts[:-1]) > 0)
                if weights is None:
                    weights = self.weights(hashes)
                for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                    lo, hi = int(run[0]), int(run[-1]) + width
                    prints = fingerprints(bits[lo:hi], weights[lo:hi], width)
                    for start, (numbers, far) in zip(run.tolist(), self.index.near(prints), strict=True):
                        if not len(numbers):
                            continue
                        bag = Counter(hashes[start : start + width].tolist())
                        for number, distance in zip(numbers.tolist(), far.tolist(), strict=True):
                            score = self.exact(bag, self.bags[number])
                            if score >= self.similarity and score > best.get(number, (0.0,))[0] + 1e-12:
                                best[number] = (score, start, width + size - 1, int(distance))
        return [(self.ids[n], start, min(length, len(words)), distance, score) for n, (score, start, length, distance) in sorted(best.items())]

    def exact(self, a: Counter, b: Counter) -> float:
        """Weighted Jaccard similarity of two bags."""
        both = sum(self.weight.get(s, self.most) * min(n, b[s]) for s, n in a.items() if s in b)
        if not both:
            return 0.0
        return both / (sum(self.weight.get(s, self.most) * n for bag in (a, b) for s, n in bag.items()) - both)


#: The blocks that a worker has made ready last, by number of their broadcast and settings.
READY: dict[tuple, Benchmark] = {}


def ready(sent, *how) -> Benchmark:
    """A block made ready once a worker, not once a task."""
    key = (sent.value[2], *how)
    if key not in READY:
        if len(READY) >= 4:
            READY.clear()
        items, rarity, _ = sent.value
        READY[key] = Benchmark(items, *how, rarity)
    return READY[key]


def item_blocks(benchmark: DataFrame, item_id: str, text: str, most_items: int, most_chars: int, size: int) -> Iterator[tuple[list[tuple[int | None, str]], Rarity | None, str]]:
    """The items, in blocks that fit a task, each with the rarity of shingles where there are several, and a name. A block is collected only after its size has been read."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), whole_text(text).alias("text"))
    count, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = max(1, math.ceil(count / most_items), math.ceil(chars / most_chars))
    rarity = rarity_of(items, size) if parts > 1 else None
    for part in range(parts):
        yield [(r.item_id, r.text) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").toLocalIterator()], rarity, uuid.uuid4().hex


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS, size: int = SIZE, most_items: int = BLOCK_ITEMS, most_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for every document and item with a window of that similarity: SCHEMA."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    out = None
    for block in item_blocks(benchmark, item_id, item_text, most_items, most_chars, size):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            bench, known = ready(sent, similarity, radius, size), WordHashes()
            for batch in batches:
                found = [(batch.column(0)[k].as_py(), *m) for k, value in enumerate(batch.column(1)) for m in bench.matches(word_hashes(value.as_py(), known))]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                columns = zip(*found, strict=True) if found else [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "start_word", "n_words", "hamming", "similarity"])

        part = rows.mapInArrow(search, SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS, size: int = SIZE, most_items: int = BLOCK_ITEMS, most_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no benchmark item. Nothing is moved; ids may be null or repeat."""
    schema, place = docs.schema, docs.columns.index(text)
    for block in item_blocks(benchmark, item_id, item_text, most_items, most_chars, size):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            bench, known = ready(sent, similarity, radius, size), WordHashes()
            for batch in batches:
                yield batch.filter(pa.array([not bench.matches(word_hashes(value.as_py() or "", known)) for value in batch.column(place)], pa.bool_()))

        docs = docs.mapInArrow(search, schema)
    return docs
