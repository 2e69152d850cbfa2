"""Ranked lexical search: MaxScore over shards of an inverted index.

The stated queries are taken in bounded blocks. For a block, every document is read once and written
as a row of a forward index: its length and the places and counts of the block's terms. Document
frequencies and lengths are summed over all documents in SQL; term weights follow from them. A shard
is a bounded stretch of the forward index inside one task; it is inverted with numpy into posting
lists with an upper bound each. For a query the lists are split: those with the least bounds whose
sum stays below the k-th best score so far are non-essential, as no document in them alone can
qualify. Documents of the essential lists are scored, and the non-essential lists are probed, the
greatest bound first, only for the documents that can still reach the bar with all bounds that are
left. A task hands on its k best of every query; these are ranked per query in two steps, so that no
task gets a row for every other task. Scores are 64-bit integers and exact.

Terms are maximal runs of ASCII letters and digits and of all other characters outside ASCII, with
only A-Z lower-cased. Defined results: null and empty texts have no terms, and a document without
terms isn't counted; a query without terms or hits has no rows; equal scores rank by ascending
doc_id, null ids last; repeated rows are documents of their own; a repeated item_id is a query for
every row of it, a null one is returned as null. Empty tables give no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import whole_text, written

#: Queries, and bytes of their texts, in one block.
MOST_QUERIES, MOST_BYTES = 20_000, 16_000_000
#: Postings of a shard, unless one document has more.
SHARD = 2_000_000
#: Groups of tasks whose best are ranked first.
FAN = 1_000
#: Every byte of a term to itself, A-Z to a-z, all other bytes of ASCII to a blank.
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: str) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split()


def forward(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """Rows (doc_id, n, terms, tfs) of every document that has a term; of `terms` only those numbered, ascending."""
    sent = docs.sparkSession.sparkContext.broadcast(number)  # of one bounded block of queries

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            out = []
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = Counter(terms(text.as_py()))
                if found:
                    own = sorted((known[t], c) for t, c in found.items() if t in known)
                    out.append((i, found.total(), [t for t, _ in own], [c for _, c in own]))
            columns = zip(*out, strict=True) if out else ([], [], [], [])
            types = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(work, "doc_id long, n long, terms array<int>, tfs array<long>")


class Shard:
    """Posting lists of some documents: for a term the places of its documents, ascending, and what each adds to a score."""

    def __init__(self, size: np.ndarray, rows: np.ndarray, found: np.ndarray, tfs: np.ndarray, weight: np.ndarray, documents: int, length: int):
        m = 100 - 50 + (50 * size * documents) // length
        adds = weight[found] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[rows]))
        order = np.argsort(found, kind="stable")
        self.size, self.rows, self.adds = len(size), rows[order], adds[order]
        self.names, self.starts = np.unique(found[order], return_index=True)
        self.ends = np.r_[self.starts[1:], len(order)]
        self.upper = np.maximum.reduceat(self.adds, self.starts) if len(order) else np.zeros(0, np.int64)

    def search(self, query: np.ndarray, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the documents with a score of at least `bar`, 1 or more; `query` is ascending."""
        at = np.searchsorted(self.names, query)
        lists = at[(at < len(self.names)) & (np.r_[self.names, -1][at] == query)]
        lists = lists[np.argsort(self.upper[lists], kind="stable")]
        bounds = np.cumsum(self.upper[lists])
        split = int(np.searchsorted(bounds, bar))
        score = np.zeros(self.size, np.int64)
        for k in lists[split:]:
            score[self.rows[self.starts[k] : self.ends[k]]] += self.adds[self.starts[k] : self.ends[k]]
        live = np.flatnonzero(score)
        for j in range(split - 1, -1, -1):
            live = live[score[live] + bounds[j] >= bar]
            if not len(live):
                break
            k = lists[j]
            own = self.rows[self.starts[k] : self.ends[k]]
            place = np.searchsorted(own, live)
            hit = place < len(own)
            hit[hit] = own[place[hit]] == live[hit]
            score[live[hit]] += self.adds[self.starts[k] + place[hit]]
        live = live[score[live] >= bar]
        return live, score[live]


class Best:
    """The k best of one query so far."""

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.missing = np.zeros(0, bool)

    @property
    def bar(self) -> int:
        return max(1, int(self.score[-1])) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        score, ids, missing = np.r_[self.score, score], np.r_[self.ids, ids], np.r_[self.missing, missing]
        order = np.lexsort((ids, missing, -score))[: self.k]
        self.score, self.ids, self.missing = score[order], ids[order], missing[order]


def shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, missing ids, lengths, places, terms, counts) of stretches of documents with at most so many postings, one document at least."""
    for batch in batches:
        ids = batch.column("doc_id")
        missing, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
        n, held, tfs = batch.column("n").to_numpy(), batch.column("terms"), batch.column("tfs")
        offsets = held.offsets.to_numpy()
        found, counts = held.values.to_numpy(zero_copy_only=False), tfs.values.to_numpy(zero_copy_only=False)
        shift = tfs.offsets.to_numpy()[0] - offsets[0]
        a = 0
        while a < len(n):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
            part = slice(offsets[a], offsets[b])
            yield ids[a:b], missing[a:b], n[a:b], np.repeat(np.arange(b - a), np.diff(offsets[a : b + 1])), found[part], counts[part.start + shift : part.stop + shift]
            a = b


def ranked(index: DataFrame, queries: list[np.ndarray], weight: np.ndarray, documents: int, length: int, k: int, most: int) -> DataFrame:
    """The k best documents of every query within a task: rows (query, doc_id, score)."""
    sent = index.sparkSession.sparkContext.broadcast((queries, weight))  # of one bounded block

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = sent.value
        best = [Best(k) for _ in asked]
        for ids, missing, n, rows, found, tfs in shards(batches, most):
            shard = Shard(n, rows, found, tfs, weights, documents, length)
            for query, top in zip(asked, best, strict=True):
                live, score = shard.search(query, top.bar)
                if len(live):
                    top.add(score, ids[live], missing[live])
        for i, top in enumerate(best):
            if len(top.score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top.score), i, np.int32)), pa.array(top.ids, mask=top.missing), pa.array(top.score)], ["query", "doc_id", "score"])

    return index.mapInArrow(work, "query int, doc_id long, score long")


def block(docs: DataFrame, texts: list[tuple[str, str]], k: int, most: int) -> DataFrame | None:
    """Rows (query_key, rank, doc_id, score) of the queries (query_key, text); None where no document has a term."""
    spark = docs.sparkSession
    own = [sorted(set(terms(text))) for _, text in texts]
    number = {t: i for i, t in enumerate(sorted({t for ts in own for t in ts}))}
    index = written(forward(docs, number), "forward")
    documents, length = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not documents:
        return None
    # as many rows at most as the block has terms
    holding = {r.t: r.df for r in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()}
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(i, 0) + 1))) for i in range(len(number))], np.int64)
    found = ranked(index, [np.array([number[t] for t in ts], np.int32) for ts in own], weight, documents, length, k, most)
    best = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    first = found.withColumn("task", F.spark_partition_id() % FAN).withColumn("rank", best("query", "task")).where(F.col("rank") <= k).drop("rank", "task")
    names = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(texts)], "query int, query_key string")
    return first.withColumn("rank", best("query")).where(F.col("rank") <= k).join(F.broadcast(names), "query").select("query_key", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", most_queries: int = MOST_QUERIES, most_bytes: int = MOST_BYTES, shard: int = SHARD) -> DataFrame:
    """The k documents with the highest scores above 0 for every item: item_id, rank, doc_id, score."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), whole_text(item_text).alias("text")).withColumn("query_key", F.sha2("text", 256))
    texts = asked.select("query_key", "text").distinct()
    n, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(math.ceil(n / most_queries), math.ceil(size / most_bytes))
    out = docs.sparkSession.createDataFrame([], "query_key string, rank int, doc_id long, score long")
    for i in range(blocks):
        # bounded but for chance: different texts are dealt by their hash
        got = texts.where(F.pmod(F.xxhash64("query_key"), F.lit(blocks)) == i).collect()
        part = block(rows, [(r.query_key, r.text) for r in got], k, shard) if got else None
        if part is not None:
            out = out.unionByName(part)
    return asked.select("item_id", "query_key").join(out, "query_key").select("item_id", "rank", "doc_id", "score")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
     held AS (SELECT r, doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
     total AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM held),
     q AS (SELECT DISTINCT i, item_id, t FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)),
     tf AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(ts) AS t FROM held) GROUP BY ALL),
     w AS (SELECT t, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), total),
     s AS (SELECT q.i, q.item_id, tf.r, tf.doc_id, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (100 - 50 + ((50 * tf.n * big_n) // big_l))))) AS BIGINT) AS score
           FROM q JOIN tf USING (t) JOIN w USING (t), total GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) <= 50
"""
