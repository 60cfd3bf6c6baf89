"""Filter interaction audit: what each filter removes, alone and behind the others, in every order of application.

Filters A to D look at one text: A fewer than 200 words, B fewer than half of the words distinct, C more than 3 % of
the characters A-Z, D any of `#$%&*|`. Filter E fails a text that a smaller doc_id has too, table-wide.

E has a counting-Bloom prepass. Each task counts the hashes of its texts in a sketch of counters that stop at two, the
sketches are merged segment by segment, and a text with a counter of one has no copy. Only the other texts, the
possible repeats, are shuffled, to find the smallest doc_id of each full text. The flags of all documents then meet in
a bit mask, masks are counted, and every order's steps are sums over the counts, since a document's fate in an order
depends on its mask only.

The sketch grows with the rows (two bytes a row). It is broadcast up to BROADCAST_BYTES and met by a shuffle beyond.

A null text is an empty one (it fails A, and E as a copy of an empty text). A null lang is the part ''. A row with a
null doc_id never fails E and spares no other; labels don't find it. Of repeated rows all are counted, and none fails E
because of a row with the same doc_id. Of several label rows of a document the largest values count. Very long texts
are taken whole. A table without rows has no parts, so no rows. Other columns of the tables don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.llm.common import stage, table

FILTERS = "ABCDE"
#: Counters of a segment of the sketch, and how many there are for a row. A text has two, in one segment.
CELLS = 1 << 16
CELLS_A_ROW = 16
#: Hashes that a task counts before it passes its sketch on.
HELD = 1 << 20
#: A sketch of more bytes is shuffled to the texts, not broadcast.
BROADCAST_BYTES = 64 << 20
CAPITALS, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"


def failed(text: bytes, points: int) -> int:
    """The bits of A to D that a text of so many code points fails."""
    words = text.split()  # bytes are split at exactly the six ASCII white-space characters
    capitals = len(text) - len(text.translate(None, CAPITALS))
    few, dull = len(words) < 200, 100 * len(set(words)) < 50 * len(words)
    return few | dull << 1 | (100 * capitals > 3 * points) << 2 | (len(text) != len(text.translate(None, MARKS))) << 3


def full_text() -> Column:
    return F.coalesce("text", F.lit(""))


def flags(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, h): each document's bits of A to D and the hash of its text."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mask = [failed(x.encode("utf-8", "surrogatepass"), len(x)) for x in (t.as_py() for t in b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(mask, pa.int32()), b.column(3)], ["doc_id", "part", "mask", "h"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), full_text().alias("text"), F.xxhash64(full_text()).alias("h"))
    return rows.mapInArrow(judge, "doc_id long, part string, mask int, h long")


def segment_of(h: Column, segments: int) -> Column:
    return h.bitwiseAND(F.lit(0xFFFFFFFF)) % segments


def cells_of(h: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(h, 48), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(CELLS - 1))


def sketch(hashes: DataFrame, segments: int) -> DataFrame:
    """(segment, bits) of the merged counting-Bloom sketch of h: 64 counters a long, a bit is set where two or more were counted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def report() -> pa.RecordBatch:
            segment, a, b = (np.concatenate(x) for x in zip(*held))
            one = a != b  # a text whose two counters are one counts once
            key, n = np.unique(np.r_[segment << 16 | a, segment[one] << 16 | b[one]], return_counts=True)
            at, first = np.unique(key >> 16, return_index=True)
            parts = list(zip(first, np.r_[first[1:], len(key)]))
            cells, twice = (key & CELLS - 1).astype("<u2"), np.minimum(n, 2).astype(np.uint8)
            return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([cells[s:e].tobytes() for s, e in parts], pa.binary()), pa.array([twice[s:e].tobytes() for s, e in parts], pa.binary())], ["segment", "cells", "counts"])

        for b in batches:
            if b.num_rows:
                held.append([b.column(k).to_numpy() for k in range(3)])
                size += b.num_rows
            if size >= HELD:
                yield report()
                held, size = [], 0
        if held:
            yield report()

    def merge(rows: pa.Table) -> pa.Table:
        cells = np.concatenate([np.frombuffer(x.as_py(), "<u2") for x in rows["cells"]])
        counts = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in rows["counts"]])
        bits = np.packbits(np.bincount(cells, counts, CELLS) >= 2, bitorder="little").view("<i8")
        kept = int(bits.any())
        return pa.table({"segment": rows["segment"][:kept], "bits": pa.array([bits][:kept], pa.list_(pa.int64()))})

    h = F.col("h")
    own = hashes.select(segment_of(h, segments).alias("segment"), *[c.alias(n) for c, n in zip(cells_of(h), "ab")])
    return own.mapInArrow(count, "segment long, cells binary, counts binary").groupBy("segment").applyInArrow(merge, "segment long, bits array<long>")


def possible_repeat(rows: DataFrame, merged: DataFrame, segments: int, how: str) -> tuple[DataFrame, Column]:
    """rows (with h) beside the sketch, and whether both counters of a row reached two."""
    met = [F.getbit(F.get("bits", F.shiftright(cell, 6).cast("int")), cell.bitwiseAND(F.lit(63)).cast("int")) == 1 for cell in cells_of(F.col("h"))]
    return rows.withColumn("segment", segment_of(F.col("h"), segments)).join(merged, "segment", how), F.coalesce(met[0] & met[1], F.lit(False))


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask): each document with the bits of the filters, E included, that it fails."""
    flagged = stage(flags(docs), "flags")
    segments = max(1, -(-flagged.count() * CELLS_A_ROW // CELLS))
    merged = stage(sketch(flagged.select("h"), segments), "sketch")
    if segments * CELLS // 8 <= BROADCAST_BYTES:
        merged = F.broadcast(merged)
    texts, may = possible_repeat(docs.select(F.col("doc_id").cast("long").alias("doc_id"), full_text().alias("text"), F.xxhash64(full_text()).alias("h")), merged, segments, "inner")
    # full texts are the keys; copies meet in each task before they are shuffled
    least = texts.filter(may).groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", F.xxhash64("text").alias("h"), F.lit(True).alias("first"))
    rows, may = possible_repeat(flagged, merged, segments, "left")
    rows = rows.select("doc_id", "part", "mask", "h", may.alias("may"))
    copy = F.col("may") & F.col("first").isNull() & F.col("doc_id").isNotNull()
    return rows.join(least, ["doc_id", "h"], "left").select("doc_id", "part", F.col("mask").bitwiseOR(F.when(copy, 16).otherwise(0)).alias("mask"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents with exactly these failed filters, and those of them so labelled."""
    said = lambda label: F.coalesce(F.max(F.col(label) == 1), F.lit(False)).alias(label)
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").groupBy("doc_id").agg(said("quality"), said("toxic"))
    n = lambda label: F.count_if(F.col(label)).alias(label)
    return failures(docs).join(marked, "doc_id", "left").groupBy("part", "mask").agg(F.count("*").alias("n"), n("quality"), n("toxic"))


def interactions(counts: DataFrame) -> DataFrame:
    """For each part, order and step what the step's filter does, from the counts of masks: at most 32 rows a part."""
    bits = lambda letters: sum((F.when(F.contains(letters, F.lit(x)), 1 << k).otherwise(0) for k, x in enumerate(FILTERS)), F.lit(0))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    name, step, mask = F.col("filter_order"), F.col("step"), F.col("mask")
    own, before = bits(F.substring(name, step, F.lit(1))), bits(F.substring(name, F.lit(1), step - 1))
    hit = lambda x: mask.bitwiseAND(x) != 0
    now = hit(own) & ~hit(before)
    total = lambda when, value, alias: F.sum(F.when(when, value).otherwise(0)).cast("long").alias(alias)
    # a filter comes first among the k filters that a document fails in 120 / k of the orders
    share = F.expr("n * 120 div bit_count(mask)")
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~hit(own) & ~hit(before), F.col("n"), "kept"), total(now, F.col("n"), "removed"), total(hit(own) & hit(before), F.col("n"), "redundant"), total(mask == own, F.col("n"), "unique_fails"),
        total(now, F.col("quality"), "good_lost"), total(now, F.col("toxic"), "toxic_lost"), total(hit(own), share, "shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as t, coalesce(lang, '') as part, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w, min(doc_id) over (partition by coalesce(text, '')) as least
  from documents),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
m as (
  select part, (case when len(w) < 200 then 1 else 0 end) + (case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end)
    + (case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) then 4 else 0 end)
    + (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end) + (case when d.doc_id > least then 16 else 0 end) as mask,
    coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
  from d left join l on d.doc_id = l.doc_id),
c as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by part, mask),
f as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as v(x, bit)),
o as (
  select a.x || b.x || c.x || d.x || e.x as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from f a, f b, f c, f d, f e where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s as (select filter_order, step, bits[step] as own, coalesce(list_sum(bits[1:step - 1]), 0)::int as seen from o, (select unnest([1, 2, 3, 4, 5]) as step)),
r as (
  select part, filter_order, step, own,
    sum(case when mask & (own | seen) = 0 then n else 0 end) as kept, sum(case when mask & own > 0 and mask & seen = 0 then n else 0 end) as removed,
    sum(case when mask & own > 0 and mask & seen > 0 then n else 0 end) as redundant, sum(case when mask = own then n else 0 end) as unique_fails,
    sum(case when mask & own > 0 and mask & seen = 0 then good else 0 end) as good_lost, sum(case when mask & own > 0 and mask & seen = 0 then toxic else 0 end) as toxic_lost
  from c, s group by part, filter_order, step, own)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails,
  good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, own))::bigint as shapley
from r
"""
