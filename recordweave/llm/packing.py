"""Best-fit packing of tokenised documents into sequences, by a linear grouping scheme.

A document's tokens are cut into pieces of at most `size` tokens. Large pieces (over size / 4) are put in groups of
equal cardinality by length and count as their group's largest length, so that there are few sizes. Configurations,
ways to fill a sequence with such sizes, are optimised as a linear programme (columns are generated by a knapsack),
rounded down, and the rest is packed by fullest sequence. Actual pieces then take the places of the rounded ones, and
small pieces go best-fit into the room that is left, new sequences being opened when nothing has room.

Plans are made on the driver from the histogram of lengths, which has `size` numbers however many documents there are.
Documents are never there: a piece gets its rank among the pieces of its length from a window over salted lengths, and
the plan says in which sequence the piece of that rank goes.

Null texts are empty. Every document has at least the end token, so every row gives a piece; rows that repeat, and null
doc_ids, are pieces of their own. Other columns are left out, so their names don't matter. A table without rows gives
no rows. Very long texts become many pieces, of which only the last is shorter than `size`.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordweave.llm.common import stage, table, trim

MODEL = "word_bpe_49k.json"
SIZE, END = 2048, 0
#: Large lengths are rounded up within at most so many groups.
GROUPS = 128
#: Pieces of one length that are ranked in one window, about.
RANKED = 200_000
#: A task forgets the ids of its words when it has so many.
WORDS_HELD = 400_000
#: Words of documents whose ids are put together at a time.
PIECE = 1 << 20
#: Other words, which are longer or have with characters that a normaliser may change, are left to the tokenizers' own code.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]{1,48}")
#: How the vocabulary's own pattern cuts a word of plain characters.
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|\n|[^a-zß-öø-ÿ0-9\n]+")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies show for each byte: itself if it prints, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Encoder:
    """Ids of words: merges of many words at once where the words are plain and short, else the library's."""

    def __init__(self, name: str = MODEL):
        with open(public_tokenizers.path(name), encoding="utf-8") as f:
            self.source = f.read()
        self.library: Tokenizer | None = None
        model, added = (json.loads(self.source)[k] for k in ("model", "added_tokens"))
        self.special = [t["content"] for t in added]
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.last = np.array([vocab[x + model["end_of_word_suffix"]] for x in letters], np.int64)
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.joined = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.none = len(merges)
        if max(vocab.values()) >= 1 << 16:
            raise ValueError("the vocabulary is too large for packed pairs")
        # a merge may only make pieces that are merged later, else one pair at a time would be another order
        made = {j: k for k, j in enumerate(self.joined.tolist())}
        if any(made.get(x, -1) >= k for k, (a, b) in enumerate(merges) for x in (vocab[a], vocab[b])):
            raise ValueError("a merge comes before the merge that makes its parts")

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 16 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (none empty), one after another, and how many each has: in each round, a word's best pair is merged."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(size)
        sym = self.inner[raw]
        sym[ends - 1] = self.last[raw[ends - 1]]
        word, out_n = np.repeat(np.arange(len(words)), size), size.copy()
        rank = np.full(len(sym), self.none, np.int32)
        pair = np.flatnonzero(word[1:] == word[:-1])
        rank[pair] = self.rank(sym[pair], sym[pair + 1])
        done = []
        while len(sym):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, first)
            runs = np.diff(np.r_[first, len(sym)])
            over = best == self.none
            if over.any():
                gone = np.repeat(over, runs)
                done.append((word[gone], sym[gone]))
                out_n[word[first[over]]] = runs[over]
                word, sym, rank = word[~gone], sym[~gone], rank[~gone]
                best, runs = best[~over], runs[~over]
                if not len(sym):
                    break
            hit = rank == np.repeat(best, runs)
            at = np.flatnonzero(hit)
            # of pairs that overlap (aaa) every second one is merged, from the left
            start = np.r_[True, np.diff(at) != 1]
            nth = np.arange(len(at)) - np.flatnonzero(start)[np.cumsum(start) - 1]
            at = at[nth % 2 == 0]
            sym[at] = self.joined[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            now = np.cumsum(keep)[at] - 1
            word, sym, rank = word[keep], sym[keep], rank[keep]
            for left in (now, now[now > 0] - 1):
                right = np.minimum(left + 1, len(sym) - 1)
                rank[left] = np.where((right > left) & (word[left] == word[right]), self.rank(sym[left], sym[right]), self.none)
        if not done:
            return np.zeros(0, np.int64), out_n
        word, sym = (np.concatenate(x) for x in zip(*done))
        return sym[np.argsort(word, kind="stable")], out_n

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after another, and how many each has."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        texts = b"\n".join(words).decode("utf-8", "surrogatepass").split("\n")
        plain = [PLAIN.fullmatch(x) is not None for x in texts]
        for x in self.special:
            plain = [p and x not in t for p, t in zip(plain, texts)]
        odd = [(k, t) for k, (p, t) in enumerate(zip(plain, texts)) if not p]
        parts = _Numbers()
        found = PARTS.findall("\n".join([t for p, t in zip(plain, texts) if p]).lower())
        between = parts["\n"]
        of_word = np.fromiter(map(parts.__getitem__, found), np.int64, len(found))
        ids, n = self.merged("\t".join(parts).encode().split(b"\t"))
        ends = np.r_[np.flatnonzero(of_word == between), len(of_word)]
        sizes = np.zeros(len(words), np.int64)
        sizes[np.flatnonzero(plain)] = np.diff(np.r_[-1, ends])[: len(words) - len(odd)] - 1
        of_word = of_word[of_word != between]
        flat, n = runs_of(ids, np.cumsum(n) - n, n, of_word)
        total = np.r_[0, np.cumsum(n)]
        ends = np.cumsum(sizes)
        count = total[ends] - total[ends - sizes]
        if not odd:
            return flat, count
        if self.library is None:
            self.library = Tokenizer.from_str(self.source)
        theirs = [self.library.encode(x, add_special_tokens=False).ids for _, x in odd]
        at = np.array([k for k, _ in odd])
        flat = np.r_[flat, np.fromiter((i for x in theirs for i in x), np.int64)]
        first = np.cumsum(count) - count
        count[at] = [len(x) for x in theirs]
        first[at] = total[-1] + np.cumsum(count[at]) - count[at]
        return runs_of(flat, first, count, np.arange(len(words)))


def runs_of(values: np.ndarray, first: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `values` with these beginnings and sizes at the given places, one after another, and their sizes."""
    n = size[at]
    return values[np.arange(int(n.sum())) + np.repeat(first[at] - (np.cumsum(n) - n), n)], n


class _Numbers(dict):
    """A number for each key, given at first sight."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


class _Words(dict):
    """A number for each word of a task, and the ids of the words."""

    def __init__(self, encoder: Encoder):
        self.encoder, self.fresh = encoder, []
        self.ids, self.size = np.zeros(0, np.uint16), np.zeros(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number

    def tokens(self, seq: array) -> tuple[np.ndarray, np.ndarray]:
        if self.fresh:
            ids, n = self.encoder.encode(self.fresh)
            self.ids, self.size, self.fresh = np.r_[self.ids, ids.astype(np.uint16)], np.r_[self.size, n], []
        return runs_of(self.ids, np.cumsum(self.size) - self.size, self.size, np.frombuffer(seq, np.uint32))


def pieces(docs: DataFrame, size: int = SIZE, name: str = MODEL) -> DataFrame:
    """(row, doc_id, piece, start, length, ids): the pieces of each document, ids as little-endian 32-bit numbers.

    `row` tells the pieces apart; it is given by task and place, so stage the result before using it twice.
    """

    encoder = Encoder(name)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, row = _Words(encoder), TaskContext.get().partitionId() << 40

        def report() -> pa.RecordBatch:
            nonlocal row
            flat, n = words.tokens(seq)
            total, at, out = np.r_[0, np.cumsum(n)], 0, []
            for doc_id, end in held:
                ids = np.r_[flat[total[at] : total[end]], END].astype("<u4")
                at = end
                for k, s in enumerate(range(0, len(ids), size)):
                    part = ids[s : s + size]
                    out.append((row, doc_id, k, s, len(part), part.tobytes()))
                    row += 1
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], ["row", "doc_id", "piece", "start", "length", "ids"])

        held, seq = [], array("I")
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = (text.as_py() or "").encode("utf-8", "surrogatepass")
                # bytes are split at ASCII white space, which no token crosses
                seq.extend(map(words.__getitem__, text.split()))
                held.append((doc_id, len(seq)))
                if len(seq) + len(held) >= PIECE:
                    yield report()
                    held, seq = [], array("I")
                    if len(words) >= WORDS_HELD:
                        words = _Words(encoder)
        if held:
            yield report()
        del words
        trim()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "row long, doc_id long, piece int, start long, length long, ids binary")


# --- the plan, from the histogram of lengths ------------------------------------------------------------------------
def groups(count: np.ndarray, most: int = GROUPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group of each large length (else -1), and each group's largest length and cardinality.

    count[l] pieces have length l. A group ends with the length that brings the pieces so far to the next equal part;
    lengths are not split, so a length with many pieces is a group by itself.
    """
    size = len(count) - 1
    large = np.flatnonzero(count[size // 4 + 1 : size]) + size // 4 + 1
    of = np.full(size + 1, -1)
    if not len(large):
        return of, np.zeros(0, int), np.zeros(0, int)
    upto = np.cumsum(count[large])
    part = np.minimum((upto - count[large] // 2 - 1) * most // upto[-1], most - 1) if len(large) > most else np.arange(len(large))
    _, of[large] = np.unique(part, return_inverse=True)
    ends = np.r_[np.flatnonzero(np.diff(of[large])), len(large) - 1]
    return of, large[ends], np.bincount(of[large], count[large]).astype(np.int64)


def fullest(sizes: np.ndarray, worth: np.ndarray, room: int, most: np.ndarray) -> np.ndarray:
    """How many of each size, at most so many, make the best worth in a sequence."""
    best = np.zeros(room + 1)
    took = np.zeros((len(sizes), room + 1), np.int16)
    for k, (s, w, m) in enumerate(zip(sizes.tolist(), worth.tolist(), np.minimum(most, room // sizes).tolist())):
        base = best.copy()
        for n in range(1, m + 1 if w > 0 else 1):
            with_ = base[: room + 1 - n * s] + n * w
            better = with_ > best[n * s :]
            best[n * s :][better] = with_[better]
            took[k, n * s :][better] = n
    out, c = np.zeros(len(sizes), np.int64), int(best.argmax())
    for k in range(len(sizes) - 1, -1, -1):
        out[k] = took[k, c]
        c -= out[k] * sizes[k]
    return out


def configurations(sizes: np.ndarray, need: np.ndarray, room: int, rounds: int = 2000) -> list[tuple[np.ndarray, int]]:
    """(how many of each size, how many sequences): the linear programme's solution rounded down, then the fullest sequences for the rest.

    Revised simplex on one row a size. Pricing is a knapsack; it ends when no configuration is worth more than a sequence.
    """
    n = len(sizes)
    if not n:
        return []
    columns = np.diag(room // sizes).astype(float)
    inverse = np.diag(1.0 / (room // sizes))
    amount = inverse @ need
    for _ in range(rounds):
        dual = inverse.sum(0)
        new = fullest(sizes, np.maximum(dual, 0.0), room, room // sizes)
        if new @ dual <= 1 + 1e-7:
            break
        move = inverse @ new
        up = move > 1e-9
        ratio = np.where(up, amount / np.where(up, move, 1.0), np.inf)
        out = int(ratio.argmin())
        columns[:, out] = new
        pivot = inverse[out] / move[out]
        inverse -= np.outer(move, pivot)
        inverse[out] = pivot
        amount = np.maximum(inverse @ need, 0.0)
    left, plan = need.copy(), []
    for k in np.argsort(-(sizes @ columns), kind="stable"):
        what = np.round(columns[:, k]).astype(np.int64)
        times = min(int(amount[k] + 1e-6), *(left[what > 0] // what[what > 0]).tolist())
        if times > 0:
            plan.append((what, times))
            left -= what * times
    while left.any():
        what = fullest(sizes, sizes.astype(float), room, left)
        times = int((left[what > 0] // what[what > 0]).min())
        plan.append((what, times))
        left -= what * times
    return plan


def best_fit(room: np.ndarray, small: np.ndarray) -> tuple[dict[int, list[tuple[int, int, int]]], int]:
    """Where small pieces go: for each length (first rank of the piece, level, first rank in the level), and sequences to open.

    room[r] sequences have r tokens left and make the level r, ordered within it in any fixed way; new sequences are
    the last level. Runs of sequences that are filled alike are moved as one.
    """
    new = len(room) - 1
    lots = {r: [(r, 0, int(n))] for r, n in enumerate(room) if n and r}
    where, opened = {}, 0
    for length in np.flatnonzero(small)[::-1].tolist():
        left, rank, runs = int(small[length]), 0, []
        while left:
            level = min((r for r in lots if r >= length), default=None)
            if level is None:  # nothing has room: enough sequences for all, one run
                n = -(-left // (new // length))
                lots[new] = [(new, opened, n)]
                opened += n
                continue
            source, at, n = lots[level].pop()
            if not lots[level]:
                del lots[level]
            n_now = min(n, left)
            if n > n_now:
                lots.setdefault(level, []).append((source, at + n_now, n - n_now))
            if level > length:
                lots.setdefault(level - length, []).append((source, at, n_now))
            runs.append((rank, source, at))
            rank, left = rank + n_now, left - n_now
        where[length] = runs
    return where, opened


# --- the plan, carried out ------------------------------------------------------------------------------------------
def ranked(rows: DataFrame, key: str, tie: str) -> DataFrame:
    """rows with rank: each row's place (from 0) among those with its key, which has few values.

    A key with many rows is salted; windows number the rows of a salted key, and the rows before it are added.
    """
    salts = max(1, -(-rows.count() // RANKED))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(tie), F.lit(salts)))
    before = salted.groupBy(key, "salt").count().withColumn("before", F.sum("count").over(Window.partitionBy(key).orderBy("salt")) - F.col("count")).drop("count")
    own = salted.withColumn("rank", F.row_number().over(Window.partitionBy(key, "salt").orderBy(tie)) - 1)
    return own.join(before, [key, "salt"]).withColumn("rank", F.col("rank") + F.col("before")).drop("salt", "before")


def histogram(rows: DataFrame, column: str, size: int) -> np.ndarray:
    """Rows of each value 0 to size: at most size + 1 numbers reach the driver."""
    out = np.zeros(size + 1, np.int64)
    for value, n in rows.groupBy(column).count().collect():
        out[value] = n
    return out


def looked_up(spec: dict[int, list[tuple[int, ...]]], key: Column, rank: Column, fields: list[str]) -> Column:
    """The last run of spec[key] that begins at `rank` or before, as a struct of `fields`; runs are sorted by their first field."""
    first = np.cumsum([0, *(len(v) for v in spec.values())])
    place = {k: (int(a), int(b)) for k, a, b in zip(spec, first, first[1:])}
    flat = np.array([r for runs in spec.values() for r in runs], np.int64).reshape(-1, len(fields))

    @F.pandas_udf(", ".join(f"{f} long" for f in fields))
    def find(keys, ranks):
        k, r = keys.to_numpy(), ranks.to_numpy()
        at = np.zeros(len(k), np.int64)
        for value in np.unique(k):
            a, b = place[int(value)]
            own = k == value
            at[own] = a + np.searchsorted(flat[a:b, 0], r[own], "right") - 1
        return pd.DataFrame(flat[at], columns=fields)

    return find(key, rank)


def pack(lengths: DataFrame, size: int = SIZE, most: int = GROUPS) -> DataFrame:
    """(row, sequence_id, offset): a place for each (row, length), of lengths 1 to size."""
    count = histogram(lengths, "length", size)
    of, sizes, need = groups(count, most)
    plan = configurations(sizes, need, size)
    # full pieces come first, each in a sequence of its own
    begin, runs = int(count[size]), {g: [] for g in range(len(sizes))}
    used = np.zeros(len(sizes), np.int64)
    for what, times in plan:
        for g in np.flatnonzero(what).tolist():
            runs[g].append((int(used[g]), begin, int(what[g])))
            used[g] += times * what[g]
        begin += times
    group = F.get(F.lit(of.tolist()), F.col("length").cast("int"))
    rows = ranked(lengths.select("row", "length", F.when(F.col("length") == size, -2).when(group >= 0, group).otherwise(-1 - F.lit(2) - F.col("length")).alias("kind")), "kind", "row")
    rows = stage(rows, "ranked")
    full = rows.filter("kind = -2").select("row", "length", F.col("rank").alias("sequence_id"))
    run = looked_up(runs, F.col("kind"), F.col("rank"), ["used", "begin", "copies"])
    large = rows.filter("kind >= 0").withColumn("run", run).select("row", "length", F.expr("run.begin + (rank - run.used) div run.copies").alias("sequence_id"))
    large = stage(large, "large")
    # every planned sequence holds a large piece, so the room of all is known from them
    open_ = large.groupBy("sequence_id").agg((F.lit(size) - F.sum("length")).cast("long").alias("level"))
    small = rows.filter("kind < -2")
    levels = stage(ranked(open_, "level", "sequence_id"), "levels")
    where, _ = best_fit(histogram(levels, "level", size), np.where(np.arange(size + 1) <= size // 4, count, 0))
    put = small.withColumn("run", looked_up(where, F.col("length"), F.col("rank"), ["first", "level", "at"])).select("row", "length", "run.level", (F.col("run.at") + F.col("rank") - F.col("run.first")).alias("rank"))
    met = put.filter(F.col("level") < size).join(levels.select("level", "rank", "sequence_id"), ["level", "rank"]).select("row", "length", "sequence_id")
    opened = put.filter(F.col("level") == size).select("row", "length", (F.col("rank") + begin).alias("sequence_id"))
    placed = full.unionByName(large).unionByName(met).unionByName(opened)
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "row").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("row", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))


def packed(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """Staged pieces (any columns beside row and length) with sequence_id and offset."""
    return cut.join(pack(cut.select("row", "length"), size), "row")


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pieces(table(spark, sf_dir, "documents")).select("row", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packed(stage(cut, "pieces")).drop("row")
