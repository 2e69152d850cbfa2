"""N-gram Jaccard join: MinHash banding finds candidates, whole n-gram sets decide.

1. Every text becomes its set of five-word shingles, a digest of that set, band hashes and a short
   signature. Texts with equal sets are one entry from here on, by that digest and not by an id.
2. Entries are dealt by band hash. A bucket is cut into blocks and every two blocks meet in one
   cell, which holds no more than two blocks however large the bucket. Cells are dealt to tasks by
   ranges of as many rows. In a cell, pairs whose signatures agree enough link up; only a forest
   leaves the cell, of as many edges as entries, or as trees where it has two blocks.
3. The components of these forests are the candidate groups. Their texts move once for a group
   within one block (once per block beyond that), to cells as before, and every pair in a cell is
   verified on the full sets. Cells return a count of links per entry and a spanning forest.
4. Components of the verified forests are the classes.

Pairs are counted where they are found and are never emitted, so a group of thousands of near
copies costs rows in proportion to its size (times its blocks), not to its square.

Defined results: null text counts as empty; a text without words has no shingle and links to
nothing; a text of fewer than five words has one shingle, of all its words; texts with equal sets
are copies: one entry, one class, and not counted as links of each other; repeated rows are copies;
rows of one id with different texts are compared and returned each by its own text; rows with a null
id take part like all others, and where no row of an entry or a class has an id, entry_id or
class_id is null. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, group_bounds, whole_groups, whole_text, written
from .shingles import SIZE, WordHashes, mixed, shingles, word_hashes

SIMILARITY = 0.8
RECALL = 0.9999
HASHES = 128
#: Rows of a block where buckets and groups are cut, and shingles of a block of texts.
BLOCK, BLOCK_SHINGLES = 256, 500_000


def bands_and_rows(similarity: float = SIMILARITY, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """The most rows a band, within `hashes` hashes in all, at which a pair of just that similarity shares a band with probability `recall`."""
    best = None
    for rows in range(1, hashes + 1):
        chance = similarity**rows
        bands = 1 if chance >= recall else math.ceil(math.log(1 - recall) / math.log(1 - chance))
        if bands * rows <= hashes:
            best = bands, rows
    if not best:
        raise ValueError(f"{hashes} hashes don't reach a recall of {recall} at {similarity}")
    return best


class Sketcher:
    def __init__(self, bands: int, rows: int, size: int):
        self.bands, self.rows, self.size, self.known = bands, rows, size, WordHashes()
        draw = np.random.default_rng(20240229)
        self.mul = draw.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = draw.integers(0, 2**63, bands * rows, dtype=np.uint64)

    def set_of(self, text: str) -> np.ndarray:
        return np.unique(shingles(word_hashes(text, self.known), self.size))

    def signature(self, found: np.ndarray) -> np.ndarray:
        least = np.full(len(self.mul), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(found), 2048):
            np.minimum(least, (found[at : at + 2048, None] * self.mul + self.add).min(axis=0), out=least)
        return least

    def buckets(self, signature: np.ndarray) -> np.ndarray:
        """One hash a band, the band's number mixed in."""
        total = np.arange(1, self.bands + 1, dtype=np.uint64)
        for column in signature.reshape(self.bands, self.rows).T:
            total = mixed(total ^ column) + column
        return mixed(total).view(np.int64)


def named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (doc_id, text_key, text): the key tells texts of one id apart."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def sketches(docs: DataFrame, doc_id: str, text: str, size: int, bands: int, rows: int) -> DataFrame:
    """Rows (doc_id, text_key, set_key, n, buckets, signature); the last four are null where there is no shingle."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Sketcher(bands, rows, size)
        for batch in batches:
            keys, sizes, buckets, short = [], [], [], []
            for value in batch.column(2):
                found = maker.set_of(value.as_py())
                if not len(found):
                    for out in (keys, sizes, buckets, short):
                        out.append(None)
                    continue
                signature = maker.signature(found)
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=20).digest())
                sizes.append(len(found))
                buckets.append(maker.buckets(signature))
                short.append((signature >> np.uint64(56)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(buckets, pa.list_(pa.int64())), pa.array(short, pa.binary())], ["doc_id", "text_key", "set_key", "n", "buckets", "signature"])

    return named(docs, doc_id, text).mapInArrow(sketch, "doc_id long, text_key long, set_key binary, n long, buckets array<long>, signature binary")


def into_cells(df: DataFrame, group: str, blocks: str) -> DataFrame:
    """`df` with a row for every cell that a row belongs to: cell, and side (0 or 1; 2 in a cell of one block)."""
    own, other = F.pmod(F.xxhash64("entry"), F.col(blocks)), F.col("__other")
    return (
        df.withColumn("__own", own)
        .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
        .withColumn("cell", F.xxhash64(group, F.least("__own", other), F.greatest("__own", other)))
        .withColumn("side", F.when(F.col("__own") == other, 2).when(F.col("__own") < other, 0).otherwise(1))
        .drop("__own", "__other", group, blocks)
    )


def linked(of: np.ndarray) -> np.ndarray:
    """From a symmetric matrix of links: the least index that each index is connected to."""
    top = np.full(len(of), -1)
    for start in range(len(of)):
        if top[start] >= 0:
            continue
        front = np.zeros(len(of), bool)
        front[start] = True
        seen = front.copy()
        while front.any():
            front = of[front].any(axis=0) & ~seen
            seen |= front
        top[seen] = start
    return top


def forest(links: np.ndarray, side: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what a cell connects, of entries in order and the symmetric links of all of them.

    A cell of one block ties its entries to the least of each tree. A cell of two blocks only ties
    these least entries of the trees inside either block to each other, as each block has a cell of
    its own: the edges of a large group are as many as its entries and pairs of blocks.
    """
    top = linked(links & (side[:, None] == side[None, :]))
    if side[0] == 2:
        return entry, entry[top]
    a, b = np.nonzero(np.triu(links & across(side)))
    pairs = np.unique(np.stack([top[a], top[b]]), axis=1)
    return entry[pairs[0]], entry[pairs[1]]


def across(side: np.ndarray) -> np.ndarray:
    """Which pairs a cell answers for: all of one block, or those between its two blocks."""
    return (side[:, None] == 2) | (side[:, None] != side[None, :])


def alike(signatures: np.ndarray) -> np.ndarray:
    """The share of equal signature bytes of every two rows."""
    return np.stack([(signatures == row).mean(axis=1, dtype=np.float32) for row in signatures])


def common(sets: list[np.ndarray], columns: int = 1 << 16) -> np.ndarray:
    """The size of the intersection of every two sets."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count[place] > 1
    number = np.cumsum(count > 1) - 1
    place, owner = number[place[shared]], owner[shared]
    total = np.zeros((len(sets), len(sets)), np.int64)
    for at in range(0, int((count > 1).sum()), columns):
        inside = (place >= at) & (place < at + columns)
        bits = np.zeros((len(sets), columns), bool)
        bits[owner[inside], place[inside] - at] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        packed = packed[:, packed.any(axis=0)]
        for i, row in enumerate(packed):
            total[i] += np.bitwise_count(packed & row).sum(axis=1, dtype=np.int64)
    return total


def near(buckets: DataFrame, floor: float) -> DataFrame:
    """Forest edges (a, b) of the pairs in a bucket whose signatures agree in `floor` of their bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell"):
            cells, entry = table["cell"].to_numpy(), table["entry"].to_numpy()
            side = table["side"].to_numpy()
            signature = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(len(cells), -1)
            starts, ends = group_bounds(cells)
            two = starts[(ends - starts == 2)]
            good = ((signature[two] == signature[two + 1]).mean(axis=1) >= floor) & ((side[two] == 2) | (side[two] != side[two + 1]))
            a, b = [entry[two[good]]], [entry[two[good] + 1]]
            for start, end in zip(starts[ends - starts > 2], ends[ends - starts > 2], strict=True):
                own = forest(alike(signature[start:end]) >= floor, side[start:end], entry[start:end])
                a.append(own[0])
                b.append(own[1])
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])

    return buckets.repartitionByRange("cell").sortWithinPartitions("cell", "entry").mapInArrow(work, "a long, b long")


def verified(texts: DataFrame, similarity: float, size: int) -> DataFrame:
    """Rows (entry, n_links) of a cell's entries with links, and rows (entry, other) of the edges of its forest; the third column is null or 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Sketcher(1, 1, size)
        for table in whole_groups(batches, "cell"):
            cells, entry, side = table["cell"].to_numpy(), table["entry"].to_numpy(), table["side"].to_numpy()
            rows: list[tuple[np.ndarray, ...]] = []
            for start, end in zip(*group_bounds(cells), strict=True):
                if end - start < 2:
                    continue
                sets = [maker.set_of(x.as_py()) for x in table["text"][start:end]]
                sizes = np.array([len(s) for s in sets])
                both = common(sets)
                links = both >= similarity * (sizes[:, None] + sizes[None, :] - both) - 1e-9
                np.fill_diagonal(links, False)
                own = entry[start:end]
                count = (links & across(side[start:end])).sum(axis=1)
                one, other = forest(links, side[start:end], own)
                tied = one != other
                rows.append((own[count > 0], np.full(int((count > 0).sum()), -1), count[count > 0]))
                rows.append((one[tied], other[tied], np.zeros(int(tied.sum()), np.int64)))
            done = [np.concatenate(x) for x in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * 3
            other = pa.array(done[1].astype(np.int64), mask=done[1] < 0)
            yield pa.RecordBatch.from_arrays([pa.array(done[0].astype(np.int64)), other, pa.array(done[2].astype(np.int64))], ["entry", "other", "n_links"])

    return texts.repartitionByRange("cell").sortWithinPartitions("cell", "entry").mapInArrow(work, "entry long, other long, n_links long")


def ngram_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, size: int = SIZE, recall: float = RECALL, hashes: int = HASHES, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, class_id, entry_id, n_links.

    entry_id is the least id with the same n-gram set, class_id the least id of the connected
    texts, n_links the number of different n-gram sets that are as similar as asked.
    """
    bands, rows = bands_and_rows(similarity, recall, hashes)
    # Six standard deviations below the similarity (and a byte agrees by chance once in 256 times).
    floor = max(0.0, similarity - 6 * math.sqrt(similarity * (1 - similarity) / (bands * rows)))
    made = written(sketches(docs, doc_id, text, size, bands, rows), "sketch")
    # Of an entry: one row that has its set, with an id where there is one. Entries are numbered once and written with their numbers.
    source = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    entries = made.where("set_key is not null").groupBy("set_key", "n").agg(F.min(source).alias("source"), F.first("buckets").alias("buckets"), F.first("signature").alias("signature"))
    entries = written(entries.withColumn("entry", F.monotonically_increasing_id()), "entries")
    members = entries.select("entry", F.explode("buckets").alias("bucket"))
    full = members.groupBy("bucket", F.shiftright("bucket", 1).alias("__again")).agg(F.count("*").alias("m")).where("m > 1").select("bucket", F.ceil(F.col("m") / block).alias("blocks"))
    shared = members.join(full, "bucket").join(entries.select("entry", "signature"), "entry")
    groups = components(near(into_cells(shared, "bucket", "blocks"), floor))
    groups = groups.select(F.col("node").alias("entry"), F.col("class_id").alias("candidate")).join(entries.select("entry", "n", "source"), "entry")
    groups = written(groups.select("entry", "candidate", "n", F.col("source.none").alias("none"), F.coalesce("source.doc_id", F.lit(0)).alias("id"), F.col("source.text_key").alias("text_key")), "candidates")
    sizes = groups.groupBy("candidate", F.shiftright("candidate", 1).alias("__again"))
    sizes = sizes.agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks")).drop("__again")
    # Both sides grow with the input, so neither is ever broadcast. Repeated rows meet the same entry.
    texts = named(docs, doc_id, text).select(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_key", "text")
    texts = texts.hint("merge").join(groups.drop("n"), ["none", "id", "text_key"]).select("entry", "candidate", "text").dropDuplicates(["entry"])
    found = written(verified(into_cells(texts.join(sizes, "candidate"), "candidate", "blocks"), similarity, size), "verified")
    classes = components(found.where("other is not null").select(F.col("entry").alias("a"), F.col("other").alias("b"))).select(F.col("node").alias("entry"), F.col("class_id").alias("class"))
    links = found.where("other is null").groupBy("entry").agg(F.sum("n_links").alias("n_links"))
    known = entries.select("set_key", "entry", F.col("source.doc_id").alias("entry_id")).join(classes, "entry", "left").join(links, "entry", "left")
    known = written(known, "known")
    least = known.where("class is not null").groupBy("class", F.shiftright("class", 1).alias("__again")).agg(F.min("entry_id").alias("class_id")).drop("__again")
    known = known.join(least, "class", "left")
    return made.select("doc_id", "set_key").join(known, "set_key", "left").select(
        "doc_id",
        F.when(F.col("class").isNotNull(), F.col("class_id")).when(F.col("entry").isNotNull(), F.col("entry_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("entry").isNotNull(), F.col("entry_id")).otherwise(F.col("doc_id")).alias("entry_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", without_id: bool = False, **how) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each class, that with the least id.

    Rows of one id with different texts are told apart; of repeated rows one stays. Rows without an
    id stay, whatever their text. With `without_id` they are members of the classes too, and go where
    a row with an id stays, or another without one (that whose text has the least digest).
    """
    # ids that repeat or are missing cost a copy of the rows with a key for each, which is written so that it can't change
    if not docs.groupBy(docs[doc_id].alias("__id")).count().where("__id is null or count > 1").isEmpty():
        return keep_one_keyed(docs, doc_id, text, without_id, **how)
    found = written(ngram_join(docs, doc_id, text, **how).select(F.col("doc_id").alias("__gone"), "class_id"), "classes")
    return docs.join(found.where("__gone <> class_id").select("__gone"), docs[doc_id] == F.col("__gone"), "left_anti")


def keep_one_keyed(docs: DataFrame, doc_id: str, text: str, without_id: bool, **how) -> DataFrame:
    """keep_one, joined and decided by a key of each row."""
    keyed = written(docs.withColumn("__row", F.monotonically_increasing_id()), "keyed")
    asked = keyed if without_id else keyed.where(F.col(doc_id).isNotNull())
    classes = ngram_join(asked, "__row", text, **how).select(F.col("doc_id").alias("__row"), F.col("class_id").alias("__class"))
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.sha2(whole_text(text), 256).alias("sha"), F.col("__row").alias("row"))
    rows = written(asked.select("__row", order.alias("__order")).join(classes, "__row"), "classes")
    first = rows.groupBy("__class", F.shiftright("__class", 1).alias("__again")).agg(F.min("__order").alias("__first")).select("__first.row")
    # texts without words are in no class with others; of those only repeated rows go
    left = rows.join(first, F.col("__row") == F.col("row"), "left_semi").groupBy("__order.none", "__order.id", "__order.sha").agg(F.min("__row").alias("__stays"))
    gone = rows.select("__row").join(left, F.col("__row") == F.col("__stays"), "left_anti").withColumnRenamed("__row", "__gone")
    return keyed.join(gone, F.col("__row") == F.col("__gone"), "left_anti").drop("__row")
