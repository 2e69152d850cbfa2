"""Token counts by rank-synchronous array merging.

The texts of a batch are cut into units (see bpe.units), and the units not seen before into
pre-tokens. The bytes of all new pre-tokens lie in one ragged numpy array. In a round, every
pre-token applies its own lowest-rank pair, at each place where it stands, all pre-tokens at once;
those without a pair left are done. The symbols that survive are the tokens. In a pre-token of more
than LONG bytes a round touches only the places of the pair whose turn it is, and their neighbours:
places are kept by rank, and a pair that a merge makes always ranks after that merge, so ranks come
up in order. Such a pre-token costs time in proportion to its merges; nothing is cut.

Defined results: null text counts as empty: no bytes, no tokens; special strings count as one token
each, as the tokenizers library has it by default; repeated rows are returned as they come; ids may
be null. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Vocabulary, shipped, units
from .common import whole_text

LIMIT = 1024
#: Units that a task remembers, and bytes of the pre-tokens merged at a time.
REMEMBERED, AT_A_TIME = 400_000, 1_000_000
#: Bytes from which a pre-token is merged by places.
LONG = 2000
NONE = np.iinfo(np.int64).max


class Merger:
    """Merges of a byte-level vocabulary as sorted arrays: pair of symbols to the symbol they make, its rank too."""

    def __init__(self, vocabulary: Vocabulary):
        ranks = vocabulary.ranks
        self.width = max(ranks.values()) + 1
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs, ranks_of_bytes = {}, set(self.byte.tolist())
        for token, rank in ranks.items():
            if len(token) > 1:
                parts = self.parts(token, rank, ranks)
                if len(parts) == 2:
                    pairs[ranks[parts[0]] * self.width + ranks[parts[1]]] = rank
        if any(made <= max(divmod(key, self.width)) for key, made in pairs.items() if max(divmod(key, self.width)) not in ranks_of_bytes):
            raise ValueError("a merge of the vocabulary ranks before one that it needs")
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        # pairs of small symbols, which are most of those looked up, by place
        self.small = 2048
        self.table = np.full(self.small * self.small, NONE, np.int64)
        a, b = np.divmod(self.keys, self.width)
        inside = (a < self.small) & (b < self.small)
        self.table[a[inside] * self.small + b[inside]] = self.made[inside]

    @staticmethod
    def parts(token: bytes, rank: int, ranks: dict[bytes, int]) -> list[bytes]:
        """The two symbols that a token is merged from: what merges of lower rank leave of its bytes."""
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 2:
            lowest, at = min((ranks.get(parts[k] + parts[k + 1], rank), k) for k in range(len(parts) - 1))
            if lowest >= rank:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        out = np.full(len(left), NONE, np.int64)
        inside = (left < self.small) & (right < self.small)
        out[inside] = self.table[left[inside] * self.small + right[inside]]
        rest = np.flatnonzero(~inside)
        if len(rest):
            key = left[rest] * self.width + right[rest]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[rest] = np.where(self.keys[at] == key, self.made[at], NONE)
        return out

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Surviving symbols of every piece."""
        total = np.array([len(p) for p in pieces], np.int64)
        symbols = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), total)
        while True:
            # of neighbours in the same piece: the symbol they would make
            rank = np.full(len(symbols), NONE, np.int64)
            if len(symbols) > 1:
                same = np.flatnonzero(owner[:-1] == owner[1:])
                rank[same] = self.ranks_of(symbols[same], symbols[same + 1])
            if not len(rank):
                return total
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(owner)]))
            live = lowest < NONE
            if not live.any():
                return total
            symbols, owner, rank, lowest = symbols[live], owner[live], rank[live], lowest[live]
            at = np.flatnonzero(rank == lowest)
            # a run of places side by side (aaa): every other one from its start
            new = np.r_[True, (np.diff(at) > 1) | (owner[at[1:]] != owner[at[:-1]])]
            first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            symbols[at] = rank[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            total -= np.bincount(owner[at], minlength=len(total))
            symbols, owner = symbols[stay], owner[stay]

    def count_long(self, piece: bytes) -> int:
        """Surviving symbols of one long piece, as a linked list in arrays: a round costs what its pair's places do."""
        n = len(piece)
        symbols = self.byte[np.frombuffer(piece, np.uint8)]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank = np.full(n, NONE, np.int64)
        rank[:-1] = self.ranks_of(symbols[:-1], symbols[1:])
        waiting: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def wait(places: np.ndarray) -> None:
            """Keep places by the rank of the pair that starts there."""
            places = places[rank[places] < NONE]
            places = places[np.argsort(rank[places], kind="stable")]
            ranks = rank[places]
            for some in np.split(places, np.flatnonzero(np.diff(ranks)) + 1) if len(places) else ():
                own = int(rank[some[0]])
                if own not in waiting:
                    waiting[own] = []
                    heapq.heappush(order, own)
                waiting[own].append(some)

        wait(np.arange(n))
        left = n
        while order:
            own = heapq.heappop(order)
            at = np.unique(np.concatenate(waiting.pop(own)))
            # a place whose symbols have changed since has another rank now
            at = at[rank[at] == own]
            if not len(at):
                continue
            # a run of places one after another (aaa): every other one from its start
            new = np.r_[True, after[at[:-1]] != at[1:]]
            first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            gone = after[at]
            symbols[at], after[at], rank[gone] = own, after[gone], NONE
            follows = after[at] < n
            before[after[at][follows]] = at[follows]
            left -= len(at)
            rank[at] = NONE
            rank[at[follows]] = self.ranks_of(symbols[at[follows]], symbols[after[at[follows]]])
            ahead = before[at]
            ahead = ahead[ahead >= 0]
            rank[ahead] = self.ranks_of(symbols[ahead], symbols[after[ahead]])
            wait(np.unique(np.concatenate([at, ahead])))
        return left


class Counter:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.vocabulary = Vocabulary(path)
        self.merger = Merger(self.vocabulary)
        self.remembered, self.units, self.pieces = remembered, {}, {}

    def learn(self, new: list[str]) -> dict[str, int]:
        """Token counts of units that aren't remembered."""
        known, find = self.pieces, self.vocabulary.pattern.findall
        # str.isalpha() is true of letters alone, which with the space before them are one pre-token
        split = {u: find(u) for u in new if not (u.isalpha() or u[0] == " " and u[1:].isalpha())}
        pieces = list({*(p for ps in split.values() for p in ps if p not in known), *(u for u in new if u not in split and u not in known)})
        long = [p for p in pieces if len(p) > LONG // 4 and len(p.encode()) > LONG]
        counts, at = {p: self.merger.count_long(p.encode()) for p in long}, 0
        if long:
            pieces = [p for p in pieces if p not in counts]
        while at < len(pieces):
            some, size = [], 0
            while at < len(pieces) and size < AT_A_TIME:
                some.append(pieces[at].encode())
                size, at = size + len(some[-1]), at + 1
            counts.update(zip(pieces[at - len(some) : at], self.merger.counts(some).tolist(), strict=True))
        known.update(counts)
        out = {u: sum(map(known.__getitem__, split[u])) if u in split else known[u] for u in new}
        for p in [p for p in counts if len(p) > 64]:
            del known[p]
        if len(known) > self.remembered:
            known.clear()
        return out

    def batch(self, texts: list[str]) -> list[int]:
        cut = [[(units(part) if special is None else None) for part, special in self.vocabulary.parts(t)] for t in texts]
        flat = {u for parts in cut for us in parts if us is not None for u in us}
        new = [u for u in flat if u not in self.units]
        if len(self.units) + len(new) > self.remembered:
            self.units = {}
            new = list(flat)
        self.units.update(self.learn(new))
        done = [sum(1 if us is None else sum(map(self.units.__getitem__, us)) for us in parts) for parts in cut]
        for u in [u for u in new if len(u) > 64]:
            del self.units[u]
        return done


@functools.lru_cache(1)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT, chars: int = 2_000_000) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit. `chars`: of texts merged together."""
    name = shipped(docs.sparkSession, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(SparkFiles.get(name))
        for batch in batches:
            sizes, counts, held, length = [], [], [], 0
            for value in batch.column(1):
                held.append(value.as_py())
                sizes.append(value.as_buffer().size)
                length += sizes[-1]
                if length >= chars:
                    counts += own.batch(held)
                    held, length = [], 0
            counts += own.batch(held)
            tokens = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), tokens, pa.array([n > limit for n in counts], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).mapInArrow(work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
