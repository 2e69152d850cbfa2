"""Helpers shared by the training-data operators: work tables, text columns, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary one on a single machine, and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = f"file://{tempfile.gettempdir()}/parlance-shared"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of `df`: write it to the shared folder as Parquet and read it again."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As `written`, with the path; the shuffle files of the step go when it ends, so a chain of steps holds those of one at a time."""
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Delete a work table that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: What a broadcast table may hold at most.
MOST_ROWS, MOST_BYTES = 100_000, 32_000_000


def small(table: DataFrame, column: str) -> DataFrame:
    """A written table, to be broadcast if its rows and the bytes of its main column have been counted and are few; else as it is."""
    rows, size = table.agg(F.count("*"), F.coalesce(F.sum(F.length(F.to_json(F.struct(column)))), F.lit(0))).first()
    return F.broadcast(table) if rows <= MOST_ROWS and size <= MOST_BYTES else table.hint("merge")


def whole_text(column: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(df: DataFrame, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; rows with 0 are held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (node, class_id), class_id the least node.

    Alternating large-star and small-star steps; every step keeps the number of edges at most as it
    was, moves only pairs of ids, and is written to the shared folder, so a lost executor costs one
    step. A step groups by node with a combining minimum, so a node with very many edges is summed
    before it moves. Self loops and repeated edges are allowed; no edges give no rows.
    """
    spark = edges.sparkSession

    def kept(df: DataFrame) -> tuple[DataFrame, str]:
        path = work_path(spark, "cc")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    edges, path = kept(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    # Grouped by the node and one more column of it: the joins below then deal both sides anew, so
    # that a node with very many edges can be split over tasks.
    again = F.shiftright("u", 1)
    last = state(edges)
    for _ in range(rounds):
        # large star: every larger neighbour of u, to the least of u's neighbours and u itself
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u", again.alias("__again")).agg(F.min("v").alias("w")).select("u", F.least("w", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours, to the least of them
        low = large.groupBy("u", again.alias("__again")).agg(F.min("v").alias("m")).drop("__again")
        step = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        before = path
        edges, path = kept(step)
        removed(spark, before)
        now = state(edges)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    tops = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("class_id")).unionByName(tops.select("node", F.col("node").alias("class_id")))


def bounded_ids(rows: DataFrame, sample: int) -> list[int]:
    """Of the column doc_id: the ids that hash lowest, as many as have `sample` rows together. An id with more rows than are left is passed over."""
    counted = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") <= sample).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    taken, left = [], sample
    for r in counted:
        if r.n <= left:
            taken.append(r.doc_id)
            left -= r.n
    return taken


def of_ids(rows: DataFrame, ids: list[int]) -> DataFrame:
    """The rows of these ids, whose number the caller has bounded."""
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame([(i,) for i in ids], "doc_id long")), "doc_id", "left_semi")


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by `key` (not null); a group is never divided."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1]))
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal keys."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return starts, np.r_[starts[1:], len(keys)] if len(keys) else starts
