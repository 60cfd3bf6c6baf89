"""Benchmark decontamination by size-partitioned MinHash containment search, with DataFrame functions only.

A test item's sketch holds its q - ceil(0.75 q) + 1 smallest shingle hashes (bottom-k MinHash, q distinct shingles): a
document with three quarters of the item has at least one of them. Items are partitioned by size (powers of two); each
partition has a sketch bound, the largest hash of its sketches, and a least document size. A document is partitioned
by its size in turn: it is probed with its own shingle hashes up to the bound of the item sizes that it can contain.
Probes meet sketches in one hash join, and every candidate pair is verified on the shingles themselves.

Words are lower-cased runs of non-white characters, shingles five words; an item or text of fewer words is one
shingle. Null and empty texts and items match nothing. Every copy of a text is hashed, and candidates are pairs of different texts
and items, so copies are verified once. Very long texts are hashed whole. Repeated item_ids count as
items of their own, null doc_ids and item_ids are kept as they are. Empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.llm.common import SPACE, bound, stage, table, unused

WIDTH = 5
NUM, DEN = 75, 100
#: Sketch entries or candidates beyond these counts are joined by a shuffle, not broadcast.
BROADCAST_SKETCHES = 1_000_000
BROADCAST_CANDIDATES = 500_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")


def hashed(word_hashes: Column) -> Column:
    """One hash for each run of WIDTH words; the whole sequence if there are fewer; nothing if there are none."""
    n = F.size(word_hashes)
    runs = F.transform(F.sequence(F.lit(0), n - WIDTH), lambda i: F.xxhash64(*[F.get(word_hashes, i + k) for k in range(WIDTH)]))
    return F.when(n >= WIDTH, runs).when(n > 0, F.array(F.xxhash64(word_hashes, n))).otherwise(F.array().cast("array<long>"))


def spelled(ws: Column) -> Column:
    """The distinct shingles themselves."""
    n = F.size(ws)
    runs = F.transform(F.sequence(F.lit(0), n - WIDTH), lambda i: F.concat_ws(" ", *[F.get(ws, i + k) for k in range(WIDTH)]))
    return F.array_distinct(F.when(n >= WIDTH, runs).when(n > 0, F.array(F.array_join(ws, " "))).otherwise(F.array().cast("array<string>")))


def text_hashes(text: Column) -> Column:
    return bound(F.transform(words(text), lambda w: F.xxhash64(w)), hashed)


def text_shingles(text: Column) -> Column:
    return bound(words(text), spelled)


def sketches(items: DataFrame) -> DataFrame:
    """(item_id, key, shingles, q, need, part, sketch): each item with its size partition and bottom-k sketch."""
    rows = items.select("item_id", F.xxhash64("text").alias("key"), "text")
    rows = rows.withColumn("h", F.array_sort(F.array_distinct(text_hashes(F.col("text"))))).withColumn("shingles", text_shingles(F.col("text")))
    rows = rows.withColumn("q", F.size("shingles")).filter("q > 0").withColumn("need", F.ceil(F.col("q") * NUM / DEN).cast("int"))
    return rows.select("item_id", "key", "shingles", "q", "need", F.floor(F.log2("q")).cast("int").alias("part"), F.slice("h", F.lit(1), F.size("h") - F.ceil(F.size("h") * NUM / DEN).cast("int") + 1).alias("sketch"))


def probe_bound(parts: list, n: Column) -> Column:
    """The largest hash that a document of n shingles at most is probed with; parts has the bounds of the size partitions."""
    least = F.lit(-(1 << 63))
    return reduce(lambda c, p: F.greatest(c, F.when(n >= p["least_size"], F.lit(p["bound"])).otherwise(least)), parts, least)


def candidates(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(key, item_key, part) of texts and items that share a sketch entry; docs has key and text."""
    entries = found.select(F.col("key").alias("item_key"), "need", F.explode("sketch").alias("probe")).distinct()
    parts = found.groupBy("part").agg(F.max(F.array_max("sketch")).alias("bound"), F.min("need").alias("least_size")).collect()  # a row for each power of two
    if entries.count() <= BROADCAST_SKETCHES:
        entries = F.broadcast(entries)
    probing = lambda h: F.struct(F.size(h).alias("n"), bound(probe_bound(parts, F.size(h)), lambda most: F.filter(h, lambda x: x <= most)).alias("probes"))
    rows = docs.select("key", bound(text_hashes(F.col("text")), probing).alias("p"))
    probes = rows.select("key", F.coalesce("p.n", F.lit(0)).alias("n"), F.explode_outer("p.probes").alias("probe"))
    return probes.join(entries, "probe").filter("n >= need").select("key", "item_key").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) of documents that hold three quarters or more of an item."""
    found = stage(sketches(benchmark.select("item_id", "text")), "sketches")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    pairs = stage(candidates(rows, found), "contamination-candidates")
    items = found.select(F.col("key").alias("item_key"), "item_id", "shingles", "q", "need")
    texts = pairs.groupBy("key").agg(F.collect_set("item_key").alias("item_keys"))
    if pairs.count() <= BROADCAST_CANDIDATES:
        texts = F.broadcast(texts)
    near = rows.join(texts, "key").select("doc_id", text_shingles(F.col("text")).alias("own"), F.explode("item_keys").alias("item_key"))
    both = near.join(items, "item_key").select("doc_id", "item_id", F.size(F.array_intersect("own", "shingles")).cast("long").alias("shared"), F.col("q").cast("long").alias("item_shingles"))
    return both.filter(DEN * F.col("shared") >= NUM * F.col("item_shingles")).withColumn("containment", F.col("shared") / F.col("item_shingles"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that hold a benchmark item; all columns stay."""
    id_, key = unused(docs, "bad_id", "bad_key")
    rows = docs.select(F.struct("doc_id", F.xxhash64("text").alias("key")).alias("doc_id"), "text")
    bad = contaminated(rows, benchmark).select(F.col("doc_id.doc_id").alias(id_), F.col("doc_id.key").alias(key)).distinct()
    bad = stage(bad, "contaminated")
    if bad.count() <= BROADCAST_CANDIDATES:
        bad = F.broadcast(bad)
    return docs.join(bad, F.col(id_).eqNullSafe(docs["doc_id"]) & (F.xxhash64(docs["text"]) == F.col(key)), "left_anti")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The exact answer by brute force over all pairs of shingles.
SQL = """
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d)),
its AS (SELECT DISTINCT item_id, s FROM (SELECT item_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM i)),
q AS (SELECT item_id, count(*) AS item_shingles FROM its GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, item_shingles, CAST(count(*) AS DOUBLE) / item_shingles AS containment
FROM ds JOIN its USING (s) JOIN q USING (item_id)
GROUP BY doc_id, item_id, item_shingles HAVING 100 * count(*) >= 75 * item_shingles
"""
