"""Pieces that the training-data operators share: tables, scratch space, word rules, graph components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The words of the contracts: runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share; in tests, where none is named, a local one is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        found = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def stage(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends there and lost executors lose nothing.

    A `schema` reads what is stored as other types of the same layout, as vectors of their four fields.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores behind it until df has no such column."""
    held, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def bound(value: Column, use) -> Column:
    """use(value), with value worked out once a row even where the optimizer copies the expression into a filter."""
    return F.get(F.transform(F.array(value), use), 0)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text modulo `modulus`; a null id counts as remainder 0, so it is never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus, F.lit(0))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def labelled_sample(labels: DataFrame, label: str, modulus: int, most: int) -> DataFrame:
    """At most `most` labelled (doc_id, label) rows outside the held-out fold, the same ones on every run.

    The bound makes the sample fit for a broadcast. Rows with a null id or label are skipped; of rows that
    repeat an id the one with the larger label counts.
    """
    ok = F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (remainder("doc_id", modulus) != 0)
    return (
        labels.filter(ok)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )


def components(nodes_edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    Alternating large-star and small-star steps; each is one grouped pass over the edges, which shrink to stars.
    Every round is written to the shared folder. Hot nodes keep only (node, smallest) pairs after the first round.
    """
    spark = nodes_edges.sparkSession
    x, y = F.col(a), F.col(b)
    edges = stage(nodes_edges.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "edges")
    parts = min(shuffle_width(spark), 64)
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_min = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(small_min, "u")
            .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .filter("u != v")
            .distinct()
        )
        edges = stage(small.coalesce(parts), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def planes(numbers: np.ndarray) -> bytes:
    """Small numbers as four rows of bytes, which compress well; `unplaned` reads them."""
    return np.ascontiguousarray(np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def zipped(whole: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as w:
        w.write_table(whole)
    return sink.getvalue().to_pybytes()


def unzipped(data: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(data.as_buffer()).read_all()


def trim() -> None:
    """Hand freed memory back to the system: Spark keeps Python workers for later tasks, and counts what they hold."""
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if release:
        release(0)
