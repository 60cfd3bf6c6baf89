"""Embedding near-duplicates by Euclidean p-stable hashing with exact cosine checks.

Vectors are normalised; equal vectors of a label become one class. Tables of quantised Gaussian projections deal the
classes into buckets. The number of projections grows with the logarithm of a label's classes, so that a class meets
about as many unrelated ones at every size, and the number of tables with it, so that a pair at the threshold is found
with the same probability (RECALL). In each bucket every pair that met in no earlier table is compared by its exact cosine
in double precision, so a link is counted once, however many tables it meets in, and no pair is ever emitted: a bucket
gives each class its number of new links and one edge of a spanning forest. A bucket larger than TILE is cut into
tiles, and every two tiles meet, so nothing is capped and no task holds more than two tiles.

Null, empty and zero vectors, vectors with null or non-finite components, and rows with a null label or vec_id link
with nothing: n_links 0, component_id = vec_id. Vectors of different lengths are never compared. Rows that repeat a
vec_id count as vectors of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.llm.common import components, shuffle_width, stage, table

THRESHOLD = 0.93
#: Share of pairs at the threshold that meet in a table; pairs above it meet more often.
RECALL = 0.97
LEAST_BITS, WIDTH = 10, 2.0
#: Unrelated classes that one meets over all tables, about.
MET = 64
TILE = 4096
SEED = 20240229


def same_cell(cosine: float) -> float:
    """Probability that two unit vectors with this cosine share a cell of one projection."""
    r = WIDTH / math.sqrt(2 - 2 * cosine)
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def shape(size: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Tables, and projections of a table, for so many classes of one label."""
    near, far = same_cell(threshold), same_cell(0.0)
    bits = LEAST_BITS
    while True:
        tables = math.ceil(math.log(1 - RECALL) / math.log(1 - near**bits))
        if size * tables * far**bits <= MET:
            return tables, bits
        bits += 1


def projections(dim: int, tables: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gaussian directions (dim, tables * bits), offsets, and odd multipliers that fold a table's cells to 64 bits."""
    rng = np.random.default_rng(SEED + dim)
    return rng.standard_normal((dim, tables * bits)), rng.uniform(0, WIDTH, tables * bits), rng.integers(1 << 62, size=bits, dtype=np.int64) * 2 + 1


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def buckets(x: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """(vectors, tables) bucket numbers of unit vectors."""
    a, b, m = projections(x.shape[1], tables, bits)
    cells = np.floor((x @ a + b) / WIDTH).astype(np.int64).reshape(len(x), tables, bits)
    return (cells * m).sum(2)


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def classes(rows: DataFrame) -> DataFrame:
    """(cid, label, dim, n, least_id, vector) of each distinct usable vector within a label."""
    ok = rows.filter(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    vector = F.transform("embedding", lambda v: F.when(v == 0, F.lit(0.0)).otherwise(v).cast("double"))
    return (
        ok.select("vec_id", "label", vector.alias("vector"))
        .groupBy("label", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("least_id"))
        .select(F.xxhash64("label", "vector").alias("cid"), "label", F.size("vector").alias("dim"), "n", "least_id", "vector")
    )


def _compare(rows: np.ndarray, x: np.ndarray, key: np.ndarray, table_no: int, tile: np.ndarray, same: bool, n: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of new links of each vector of a group, and the group-local root of its links; blocks bound the memory."""
    size, links, root = len(rows), np.zeros(len(rows), np.int64), np.arange(len(rows))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for at in range(0, size, 512):
        block = slice(at, min(at + 512, size))
        near = x[block] @ x.T >= threshold
        near[np.arange(block.stop - at), np.arange(at, block.stop)] = False
        if not same:
            near &= tile[block, None] != tile[None, :]
        i, j = np.nonzero(near)
        i += at
        if table_no and len(i):
            met = np.zeros(len(i), bool)
            for part in range(0, len(i), 1 << 18):
                s = slice(part, part + (1 << 18))
                met[s] = (key[i[s], :table_no] == key[j[s], :table_no]).any(1)
            i, j = i[~met], j[~met]
        np.add.at(links, i, n[j])
        # a spanning forest: each vector is tied to its first new neighbour, then to any other root it still meets
        while len(i):
            _, first = np.unique(i, return_index=True)
            for a, b in zip(i[first], j[first]):
                ra, rb = find(int(a)), find(int(b))
                if ra != rb:
                    root[max(ra, rb)] = min(ra, rb)
            roots = np.array([find(k) for k in range(size)])
            open_ = roots[i] != roots[j]
            i, j = i[open_], j[open_]
    return links, np.array([find(k) for k in range(size)], dtype=np.int64)


def links(found: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(cid, n, other): new links of a class in one bucket, and a class it is connected with. `found` has classes()."""

    most = found.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    tables, bits = shape(most, threshold)

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, part in b.groupby("dim"):
                x = unit(np.stack(part.vector.to_numpy()))
                yield pd.DataFrame({"cid": part.cid, "label": part.label, "dim": dim, "n": part.n, "vector": [v.tobytes() for v in x], "keys": list(buckets(x, tables, bits))})

    wide = found.select("cid", "label", "dim", "n", "vector").mapInPandas(keyed, "cid long, label long, dim int, n long, vector binary, keys array<long>")
    wide = stage(wide, "vectors")
    place = ["t", "label", "dim", "bucket"]
    dealt = lambda *more: wide.select(*more, "label", "dim", F.posexplode("keys").alias("t", "bucket"))
    hot = dealt().groupBy(*place).agg(F.count("*").alias("size")).filter(F.col("size") > tile)
    hot = stage(hot.withColumn("tiles", F.ceil(F.col("size") / tile).cast("int")).drop("size"), "hot-buckets")
    rows = dealt("cid", "n", "vector")
    if hot.isEmpty():
        rows = rows.withColumns({"tile": F.lit(0), "ti": F.lit(0), "tj": F.lit(0)})
    else:
        own = F.pmod(F.xxhash64("cid", "t"), F.col("tiles")).cast("int")
        pair = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda o: F.struct(F.least(o, "tile").alias("ti"), F.greatest(o, "tile").alias("tj")))
        rows = (
            rows.join(hot, place, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1))).withColumn("tile", own)
            .withColumn("pair", F.explode(pair)).select("cid", "n", "vector", *place, "tile", "pair.ti", "pair.tj")
        )
    group = [*place, "ti", "tj"]
    rows = rows.repartition(shuffle_width(found.sparkSession), *group).sortWithinPartitions(*group, "cid")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solve(b: pd.DataFrame) -> pd.DataFrame | None:
            if len(b) < 2:
                return None
            x = np.frombuffer(b"".join(b.vector), np.float64).reshape(len(b), -1)
            cid, n, t = b.cid.to_numpy(), b.n.to_numpy(), int(b.t.iat[0])
            new, root = _compare(cid, x, buckets(x, tables, bits), t, b.tile.to_numpy(), b.ti.iat[0] == b.tj.iat[0], n, threshold)
            at = np.flatnonzero(new)
            return pd.DataFrame({"cid": cid[at], "n": new[at], "other": cid[root[at]]}) if len(at) else None

        rest = None
        for b in batches:
            if not len(b):
                continue
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            k = b[group].to_numpy()
            cut = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
            edges = [0, *cut.tolist()]
            for s, e in zip(edges, edges[1:]):
                if e - s > 1 and (out := solve(b.iloc[s:e])) is not None:
                    yield out
            rest = b.iloc[edges[-1] :]
        if rest is not None and (out := solve(rest)) is not None:
            yield out

    return rows.mapInPandas(compare, "cid long, n long, other long")


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    rows = embeddings.select("vec_id", "embedding", "label")
    found = stage(classes(rows), "vector-classes")
    met = stage(links(found, threshold), "vector-links")
    more = met.groupBy("cid").agg(F.sum("n").alias("more"))
    comp = components(met.select(F.col("cid").alias("a"), F.col("other").alias("b")))
    known = found.select("cid", "n", "least_id").join(more, "cid", "left").join(comp.withColumnRenamed("node", "cid"), "cid", "left")
    known = known.withColumn("root", F.coalesce("component", "cid"))
    least = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
    known = known.join(least, "root").select("cid", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id")
    vector = F.transform("embedding", lambda v: F.when(v == 0, F.lit(0.0)).otherwise(v).cast("double"))
    key = F.when(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable(F.col("embedding")), F.xxhash64("label", vector))
    out = rows.select("vec_id", key.alias("cid")).join(known, "cid", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").cast("long").alias("component_id")).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
