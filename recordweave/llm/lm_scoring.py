"""Language-model scoring by context-tree weighting over binary-decomposed bytes.

A text is its words (A-Z lower-cased) joined by single blanks and closed by one line feed. Every byte is eight binary
decisions; each decision has a tree of contexts, the DEPTH bytes before, in which the Krichevsky-Trofimov estimates of
all depths are mixed by their weighted block probabilities. Counts come from the training documents only.

1. Documents are read once. A block of them has its distinct words and (context, byte) grams with their training counts,
   dealt into buckets (grams by a hash of the last three context bytes), and its documents as numbers of its words.
2. A bucket sums up the counts of all blocks and the trees from the deepest level to the third. The second level meets
   in one aggregate by two context bytes and decision, the levels above in another (256 contexts, 255 decisions).
3. Each bucket gets the mixture down to its second level, works out its grams' log-probabilities and answers each
   block; blocks score their documents. The model is never broadcast.

Null and empty texts consist of the end alone. Repeated rows count and score as often as they occur; a null doc_id is
held out. A very long text makes a block of its own, whose size is the text's. With no training documents all estimates are 1/2 for a bit, and N is 0. A table without rows gives no rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.llm.common import planes, remainder, shuffle_width, stage, table, trim, unplaned, unzipped, words_of, zipped

DEPTH = 5
FOLDS = 10
END = 10
PIECE = 1 << 20
#: A block ends with the document that brings it to so many characters.
BLOCK_CHARS = 1 << 24
HALF = np.log(0.5)
STRANGE = "a block meets entries that are not its own"


def grams(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram at each place, first place and number of grams of each text) of texts given as words."""
    pad = bytes([END]) * DEPTH
    parts = [pad + b" ".join(w) + bytes([END]) for w in texts]
    raw = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
    key = raw[: len(raw) - DEPTH]
    for k in range(1, DEPTH + 1):
        key = (key << 8) | raw[k : len(raw) - DEPTH + k]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    return key, np.cumsum(size) - size, size - DEPTH


def counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    key, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return key, np.bincount(inverse, np.concatenate([n for _, n in parts]), len(key)).astype(np.int64)


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """By the last three context bytes: all that the deeper levels of a tree need is in one bucket."""
    h = (key >> 8 & 0xFFFFFF).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(33)).astype(np.int64) % buckets


def in_buckets(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of ascending keys by bucket, and their buckets."""
    place = bucket_of(key, buckets)
    return np.argsort(place, kind="stable"), place


class _Words(dict):
    """A number for each word, given at first sight."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Block:
    """Documents as numbers of distinct words (the end is one), and the counts of their grams."""

    def __init__(self):
        self.words, self.seq, self.ids, self.n, self.train = _Words(), array("I"), [], array("I"), []
        self.held, self.room, self.chars = {True: [], False: []}, {True: 0, False: 0}, 0
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, doc_id: int | None, text: str | None, train: bool) -> None:
        w = words_of(text)
        self.seq.extend(map(self.words.__getitem__, w))
        self.seq.append(self.words[b"\n"])
        self.ids.append(doc_id), self.n.append(len(w) + 1), self.train.append(train)
        self.held[train].append(w)
        self.room[train] += len(text or "")
        self.chars += len(text or "")
        if self.room[train] >= PIECE:
            self.count(train)

    def count(self, train: bool) -> None:
        key, start, size = grams(self.held[train])
        k, n = np.unique(key[inside(start, size, len(key))], return_counts=True)
        self.parts.append((k, n if train else np.zeros_like(n)))
        self.held[train], self.room[train] = [], 0

    def rows(self, block: int, buckets: int) -> pa.RecordBatch:
        for train in (True, False):
            if self.held[train]:
                self.count(train)
        key, n = counted(self.parts)
        by, place = in_buckets(key, buckets)
        key, n, place = key[by], n[by], place[by]
        words, seq = list(self.words), np.frombuffer(self.seq, np.uint32)
        of = np.fromiter((crc32(w) % buckets for w in words), np.int64, len(words))
        order = np.argsort(of, kind="stable")
        number = np.empty(len(order), np.uint32)
        number[order] = np.arange(len(order), dtype=np.uint32)
        seen = np.bincount(number[seq], np.repeat(self.train, np.frombuffer(self.n, np.uint32)), len(words)).astype(np.int64)
        words, of = pa.array(words, pa.binary()).take(pa.array(order)), of[order]
        own = np.union1d(place, of)
        entries = []
        for k in own.tolist():
            g, w = slice(*np.searchsorted(place, [k, k + 1])), slice(*np.searchsorted(of, [k, k + 1]).tolist())
            entries.append(packed(gram=key[g], n=n[g], word=words[w], count=seen[w]))
        docs = packed(doc_id=pa.array(self.ids, pa.int64()), size=np.frombuffer(self.n, np.uint32).astype(np.int64), seq=planes(number[seq]), word=words)
        keys, none = np.r_[own, -1 - block], [None]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.full(len(keys), block), pa.int64()), pa.array(entries + none, pa.binary()), pa.array(none * len(own) + [docs], pa.binary())], ["key", "block", "entries", "docs"])


def packed(**columns) -> bytes:
    """Arrays of any lengths as one compressed Arrow row."""

    def one(v) -> pa.Array:
        if isinstance(v, bytes):
            return pa.array([v], pa.large_binary())
        return pa.LargeListArray.from_arrays(pa.array([0, len(v)], pa.int64()), v if isinstance(v, pa.Array) else pa.array(v))

    return zipped(pa.table({k: one(v) for k, v in columns.items()}))


def opened(data: pa.Scalar) -> dict[str, pa.Array]:
    t = unzipped(data)
    return {k: t[k][0].as_py() if pa.types.is_large_binary(t[k].type) else t[k][0].values for k in t.column_names}


def inside(start: np.ndarray, size: np.ndarray, n: int) -> np.ndarray:
    """The places of a run of texts that are grams of one text."""
    step = np.zeros(n + DEPTH, np.int8)
    np.add.at(step, start, 1), np.add.at(step, start + size, -1)
    return np.flatnonzero(np.cumsum(step[:n]))


def blocks(docs: DataFrame, buckets: int) -> DataFrame:
    """(key, block, entries, docs): grams and words of each bucket (key >= 0) of each block, and its documents (key = -1 - block).

    Blocks are numbered by task and place, so a task that runs again gives the same ones.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 24, _Block()
        for b in batches:
            for doc_id, text, train in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                held.add(doc_id, text.as_py(), train)
                if held.chars >= BLOCK_CHARS:
                    yield held.rows(number, buckets)
                    number, held = number + 1, _Block()
                    trim()
        if held.ids:
            yield held.rows(number, buckets)
        del held
        trim()

    return docs.select(F.col("doc_id").cast("long"), "text", "train").mapInArrow(scan, "key long, block long, entries binary, docs binary")


def lgamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x >= 1/2: Stirling's series after eight steps up."""
    y = x + 8
    up = sum(np.log(x + k) for k in range(8))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - up


def block_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov block probability."""
    return lgamma(zeros + 0.5) + lgamma(ones + 0.5) - np.log(np.pi) - lgamma(zeros + ones + 1.0)


def kt_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (ones + 0.5) / (zeros + ones + 1.0)


def weighted(own: np.ndarray, children: np.ndarray) -> np.ndarray:
    """log of the weighted probability of a node with children."""
    return np.logaddexp(HALF + own, HALF + children)


def levels(key: np.ndarray, n: np.ndarray, top: int = 3):
    """Per depth DEPTH..top: node codes, counts, block and weighted logs; and the node of each (gram, bit) per depth."""
    byte, shift = key & 255, np.arange(8)
    node = (1 << shift) | (byte[:, None] >> (8 - shift))
    bit = (byte[:, None] >> (7 - shift)) & 1
    weight = np.repeat(n, 8).astype(float)
    ones = weight * bit.ravel()
    out, place, below = {}, {}, None
    for d in range(DEPTH, top - 1, -1):
        context = (key >> 8) & ((1 << 8 * d) - 1)
        code, inv = np.unique((context[:, None] * 256 + node).ravel(), return_inverse=True)
        b = np.bincount(inv, ones, len(code))
        a = np.bincount(inv, weight, len(code)) - b
        own = block_log(a, b)
        if below is None:
            pw = own
        else:
            parent = np.zeros(len(out[d + 1][0]), np.int64)
            parent[place[d + 1]] = inv
            pw = weighted(own, np.bincount(parent, below, len(code)))
        out[d], place[d], below = (code, a, b, own, pw), inv, pw
    return out, place, bit


def second(code: np.ndarray) -> np.ndarray:
    """(two context bytes, decision) of codes of any depth."""
    return code & 0xFFFFFF


def bucket_counts(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Grams of one bucket over all blocks and their training counts."""
    return counted([(r["gram"].to_numpy(), r["n"].to_numpy()) for r in rows])


def bucket_sums(entries: DataFrame) -> DataFrame:
    """(bucket, code, a, b, pw): counts and weighted logs below each second-level node that a bucket has grams of.

    Code -1 has the bucket's training tokens (a) and distinct ones (b).
    """

    def sums(rows: pa.Table) -> pa.Table:
        found = [opened(x) for x in rows["entries"]]
        out = {"bucket": [], "code": [], "a": [], "b": [], "pw": []}
        if found:
            code, a, b, _, pw = levels(*bucket_counts(found))[0][3]
            two, inv = np.unique(second(code), return_inverse=True)
            words = pa.concat_arrays([r["word"] for r in found]).dictionary_encode()
            c = np.bincount(words.indices.to_numpy(), np.concatenate([r["count"].to_numpy() for r in found]), len(words.dictionary))
            own = lambda v, last: np.r_[np.bincount(inv, v, len(two)), last]
            out = {"bucket": np.full(len(two) + 1, rows["key"][0].as_py()), "code": np.r_[two, -1], "a": own(a, c.sum()), "b": own(b, (c > 0).sum()), "pw": own(pw, 0.0)}
        return pa.table({k: pa.array(v, pa.int64() if k in ("bucket", "code") else pa.float64()) for k, v in out.items()})

    return entries.groupBy("key").applyInArrow(sums, "bucket long, code long, a double, b double, pw double")


def near_root(twos: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each (last byte, decision), (256 * 256): the mixed probability of a one down to depth 1, and the weight left.

    twos: code, a, b, pw of all second-level nodes; at most 65,536 sums come to the driver.
    """
    first = F.col("code").bitwiseAND(F.lit(0xFFFF)).alias("code")
    rows = twos.groupBy(first).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("pw").alias("pw")).toPandas()
    a1, b1, children = (np.zeros(65536) for _ in range(3))
    a1[rows.code], b1[rows.code], children[rows.code] = rows.a, rows.b, rows.pw
    own1 = block_log(a1, b1)
    pw1 = weighted(own1, children)
    a0, b0, below = (x.reshape(256, 256).sum(0) for x in (a1, b1, pw1))
    own0 = block_log(a0, b0)
    w0 = np.exp(HALF + own0 - weighted(own0, below))
    w1 = np.exp(HALF + own1 - pw1)
    rest = np.tile(1 - w0, 256)
    return np.tile(w0 * kt_one(a0, b0), 256) + rest * w1 * kt_one(a1, b1), rest * (1 - w1)


def second_level(sums: DataFrame) -> DataFrame:
    """(bucket, code, mixed, rest): the mixed probability of a one down to depth 2, and the weight left, for each bucket."""

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            own = block_log(x.a.to_numpy(), x.b.to_numpy())
            yield pd.DataFrame({"code": x.code, "a": x.a, "b": x.b, "own": own, "pw": weighted(own, x.pw.to_numpy())})

    nodes = sums.filter("code >= 0").groupBy("code").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("pw").alias("pw"))
    twos = stage(nodes.mapInPandas(weigh, "code long, a double, b double, own double, pw double"), "lm-twos")
    mixed1, rest1 = near_root(twos)

    def mix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            at, w = x.code.to_numpy() & 0xFFFF, np.exp(HALF + x.own.to_numpy() - x.pw.to_numpy())
            yield pd.DataFrame({"code": x.code, "mixed": mixed1[at] + rest1[at] * w * kt_one(x.a.to_numpy(), x.b.to_numpy()), "rest": rest1[at] * (1 - w)})

    return sums.filter("code >= 0").select("bucket", "code").join(twos.mapInPandas(mix, "code long, mixed double, rest double"), "code")


def log_values(key: np.ndarray, n: np.ndarray, code: np.ndarray, mixed2: np.ndarray, rest2: np.ndarray) -> np.ndarray:
    """log10 probability of the byte of each gram; code (ascending), mixed2 and rest2 are the bucket's second level."""
    found, place, bit = levels(key, n)
    at = find(code, second(found[3][0]))
    mixed, rest = mixed2[at][place[3]], rest2[at][place[3]]
    for d in range(3, DEPTH + 1):
        _, a, b, own, pw = found[d]
        w = np.exp(HALF + own - pw) if d < DEPTH else np.ones(len(own))
        mixed = mixed + rest * (w * kt_one(a, b))[place[d]]
        rest = rest * (1 - w)[place[d]]
    one = mixed.reshape(-1, 8)
    return np.log10(np.where(bit == 1, one, 1 - one)).sum(1)


def answers(entries: DataFrame, seconds: DataFrame) -> DataFrame:
    """(key, bucket, data): for each block and bucket the log10 probabilities of its grams and its words' counts."""

    def answer(known: pa.Table, rows: pa.Table) -> pa.Table:
        found, key, data = [opened(x) for x in rows["entries"]], [], []
        if found:
            known = known.sort_by("code")
            grams_, n = bucket_counts(found)
            value = log_values(grams_, n, *(known[c].to_numpy() for c in ("code", "mixed", "rest")))
            words = pa.concat_arrays([r["word"] for r in found]).dictionary_encode()
            at, stops = words.indices.to_numpy(), np.cumsum([len(r["word"]) for r in found])
            counts = np.bincount(at, np.concatenate([r["count"].to_numpy() for r in found]), len(words.dictionary)).astype(np.int64)
            for block, r, s, e in zip(rows["block"].to_pylist(), found, [0, *stops], stops):
                key.append(-1 - block)
                data.append(packed(value=value[find(grams_, r["gram"].to_numpy())], count=counts[at[s:e]]))
        bucket = pa.array(rows["key"].to_pylist(), pa.int64())
        return pa.table({"key": pa.array(key, pa.int64()), "bucket": bucket, "data": pa.array(data, pa.binary())})

    return seconds.groupBy("bucket").cogroup(entries.groupBy("key")).applyInArrow(answer, "key long, bucket long, data binary")


def gram_logs(counts: DataFrame) -> DataFrame:
    """(key, value): log10 probability of the byte of each gram, from a table (key, n) of grams and counts."""
    buckets = 4 * shuffle_width(counts.sparkSession)
    place = F.pandas_udf(lambda k: pd.Series(bucket_of(k.to_numpy(), buckets)), "long")

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("key")
        data = packed(gram=rows["key"].combine_chunks(), n=rows["n"].combine_chunks(), word=pa.array([], pa.binary()), count=pa.array([], pa.int64()))
        return pa.table({"key": rows["bucket"][:1], "block": pa.array([0], pa.int64()), "entries": pa.array([data], pa.binary())})

    entries = stage(counts.withColumn("bucket", place("key")).groupBy("bucket").applyInArrow(pack, "key long, block long, entries binary"), "lm-entries")
    found = answers(entries, second_level(stage(bucket_sums(entries), "lm-sums")))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for asked, answered in zip(map(opened, b.column(0)), map(opened, b.column(1))):
                yield pa.RecordBatch.from_arrays([asked["gram"], answered["value"]], ["key", "value"])

    both = entries.join(found.select(F.col("bucket").alias("key"), "data"), "key").select("entries", "data")
    return both.mapInArrow(unpack, "key long, value double")


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the wanted keys stand among sorted keys; a key that isn't there is an error, not its neighbour."""
    at = np.searchsorted(keys, wanted)
    if len(wanted) and (len(keys) == 0 or (keys[np.minimum(at, len(keys) - 1)] != wanted).any()):
        raise LookupError(STRANGE)
    return at


SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def finished(docs: DataFrame, found: DataFrame, tokens: int, kinds: int, buckets: int) -> DataFrame:
    """Scores of every document, from the answers to its block."""
    whole = tokens + 0.1 * (kinds + 1)
    names = [x.split()[0] for x in SCORES.split(", ")]
    schema = pa.schema([(k, pa.float64() if k in ("base_score", "score", "bits_per_byte") else pa.int64()) for k in names])

    def pieces(d: dict) -> Iterator[tuple]:
        """(first, last, grams, their places, sizes) of some documents at a time."""
        words, seq, size = d["word"].to_pylist(), unplaned(d["seq"]), d["size"].to_numpy()
        stop = np.cumsum(size)
        chars = np.cumsum(np.array([len(w) for w in words], np.int64)[seq] + 1)[stop - 1]
        first = 0
        while first < len(size):
            last = max(first + 1, int(np.searchsorted(chars, (chars[first - 1] if first else 0) + PIECE, "right")))
            begin = stop[first:last] - size[first:last]
            at = seq[begin[0] : stop[last - 1]].tolist()
            texts = [list(map(words.__getitem__, at[s : s + n - 1])) for s, n in zip((begin - begin[0]).tolist(), size[first:last].tolist())]
            k, start, n = grams(texts)
            key, place = np.unique(k[inside(start, n, len(k))], return_inverse=True)
            yield first, last, key, place.astype(np.int32), n
            first = last

    def finish(rows: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        for data in rows["docs"]:
            d = opened(data)
            got = [opened(x) for x in found.sort_by("bucket")["data"]]
            answer, count = (np.concatenate([x[k].to_numpy() for x in got]) for k in ("value", "count"))
            read = list(pieces(d))
            key = np.unique(np.concatenate([p[2] for p in read]))
            if len(key) != len(answer) or len(count) != len(d["word"]):
                raise LookupError(STRANGE)
            value = np.empty(len(key))
            value[in_buckets(key, buckets)[0]] = answer
            base, known = np.log10((count + 0.1) / whole), (count > 0).astype(np.int64)
            seq, size = unplaned(d["seq"]), d["size"].to_numpy()
            begin = np.cumsum(size) - size
            per = lambda v: np.add.reduceat(v[seq], begin)
            n_known, base_score = per(known), per(base)
            for first, last, own, place, n in read:
                score = np.add.reduceat(value[find(key, own)][place], np.cumsum(n) - n)
                cols = {"doc_id": d["doc_id"].slice(first, last - first), "n_tokens": size[first:last], "n_known": n_known[first:last], "train_tokens": np.full(last - first, tokens), "base_score": base_score[first:last], "score": score, "bits_per_byte": -score * np.log2(10) / n}
                out.append(pa.RecordBatch.from_arrays([pa.array(cols[c]) for c in names], schema=schema))
        trim()
        return pa.Table.from_batches(out, schema)

    return docs.groupBy("key").cogroup(found.groupBy("key")).applyInArrow(finish, SCORES)


def score(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Scores of every document under a model of those outside the held-out fold."""
    buckets = 4 * shuffle_width(docs.sparkSession)
    docs = docs.select("doc_id", "text", (remainder("doc_id", folds) != 0).alias("train"))
    dealt = stage(blocks(docs, buckets), "lm-blocks")
    entries = dealt.filter("key >= 0").select("key", "block", "entries")
    sums = stage(bucket_sums(entries), "lm-sums")
    n = sums.filter("code = -1").agg(F.coalesce(F.sum("a"), F.lit(0.0)).cast("long"), F.coalesce(F.sum("b"), F.lit(0.0)).cast("long")).first()
    return finished(dealt.filter("key < 0").select("key", "docs"), answers(entries, second_level(sums)), n[0], n[1], buckets)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", (remainder("doc_id", FOLDS) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
