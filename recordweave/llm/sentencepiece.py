"""SentencePiece encoding and decoding by a relational lattice.

The distinct words of the corpus are exploded into their substrings of bounded length, substrings meet the piece
table in an equi-join, the matched edges are grouped by word, and a higher-order `aggregate` folds each word's edges
into its pieces: the Viterbi path for a unigram model, merges in order of rank for a BPE model (a best path does not
give a BPE model's ids).

Documents are read once. They travel as blocks: a block has its distinct words, dealt by hash into buckets, and its
documents as numbers of these words. A bucket's words of all blocks meet in one lattice; each block gets the pieces of
its own words back, bucket by bucket, and its documents are written out as ids.

Words are cut where no piece of the model can reach across: before a run of blanks and between letters and other
characters (checked against the piece table). Characters without a piece become byte pieces, or the unknown id if the
model has none. Null and empty texts have no ids. A text's own U+2581 decodes to a blank, as in the original format;
every other text decodes to itself. Repeated rows and null doc_ids are encoded like any others; other columns are left
out, so their names don't matter. A table without rows gives no rows.
"""

from __future__ import annotations

import heapq
import struct
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.llm.common import bound, planes, shuffle_width, table, trim, unplaned, unzipped, zipped

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6
#: Words of more characters are folded in Python over the same edges: a fold's cuts are the bits of a long.
FAST = 61
#: A block ends with the document that brings it to so many distinct parts or characters.
BLOCK_PARTS = 1 << 18
BLOCK_CHARS = 6_000_000
#: Words of documents that are written out at a time.
PIECE = 1 << 17
#: Distinct words that one task holds before it passes them on.
WORDS_HELD = 1 << 19
#: An edge is a long: the piece's place in the order of merges, the start, the low bits of the stop.
START_BITS, STOP_BITS = 31, 12
#: The place of a character without a piece.
STRANGE = (1 << 20) - 1
CUT = regex.compile(r" *[\p{L}\p{M}]+| *[^\p{L}\p{M} ]+| +")
CUT_BLANKS = regex.compile(r" *[^ ]+| +")
LETTER = regex.compile(r"[\p{L}\p{M}]")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        shift = out = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            if size is None:
                size = number()
            yield key >> 3, data[at : at + size]
            at += size


class Model:
    """The piece table of a .model file. Its size is that of the file, which bounds everything sent to tasks."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.prefix, self.squeeze = UNIGRAM, True, True
        for k, v in _fields(data):
            if k == 1:
                p = dict(_fields(v))
                self.pieces.append((p[1].decode(), struct.unpack("<f", p[2])[0] if 2 in p else 0.0, p.get(3, NORMAL)))
            elif k == 2:
                self.kind = dict(_fields(v)).get(3, UNIGRAM)
            elif k == 3:
                norm = dict(_fields(v))
                self.prefix, self.squeeze = bool(norm.get(3, 1)), bool(norm.get(4, 1))
                if norm.get(2):
                    raise ValueError("only models with identity normalisation are read")
        self.bytes_ = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(self.pieces) if t == BYTE}
        self.unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        usable = [p for p, _, t in self.pieces if t in (NORMAL, USER)]
        # pieces that decode on their own: normal ones, and bytes that are ASCII characters
        ascii_ = {i: chr(b) for b, i in self.bytes_.items() if b < 128}
        self.shown = [ascii_.get(i, p.replace(BLANK, " ")) for i, (p, _, _) in enumerate(self.pieces)]
        self.alone = np.array([i in ascii_ or t in (NORMAL, USER) for i, (_, _, t) in enumerate(self.pieces)])
        self.longest = max(map(len, usable), default=1)
        # places: usable pieces from the best score to the worst
        order = sorted((i for i, p in enumerate(self.pieces) if p[2] in (NORMAL, USER)), key=lambda i: (-self.pieces[i][1], i))
        if len(order) >= STRANGE or self.longest >= 1 << STOP_BITS:
            raise ValueError("the piece table is too large for packed edges")
        self.by_place = np.array([*order, -1], np.int64)
        self.place = {self.pieces[i][0]: k for k, i in enumerate(order)}
        self.scores = np.array([self.pieces[i][1] for i in order])
        self.floor = min((s for _, s, t in self.pieces if t == NORMAL), default=0.0) - 10.0
        self.odd = self._odd(order) if self.kind == BPE else set()
        if any(BLANK in p.lstrip(BLANK) for p in usable):
            raise ValueError("a piece has a blank after other characters, so words can't be cut at blanks")
        mixed = any(len({bool(LETTER.match(c)) for c in p.lstrip(BLANK)}) > 1 for p in usable)
        self.cut = CUT_BLANKS if mixed else CUT

    @classmethod
    def load(cls, path: str = MODEL) -> Model:
        with open(path, "rb") as f:
            return cls(f.read())

    def _odd(self, order: list[int]) -> set[int]:
        """Places of merges that one pass, best first, may miss: those with tied scores, and pieces that it doesn't build."""
        long = [k for k, i in enumerate(order) if len(self.pieces[i][0]) > 1]
        odd = {k for pair in zip(long, long[1:]) for k in pair if self.pieces[order[pair[0]]][1] == self.pieces[order[pair[1]]][1]}
        for k, i in enumerate(order):
            piece = self.pieces[i][0]
            n = len(piece)
            cuts = (1 << (n + 1)) - 1
            for _, a, b in sorted((self.place[piece[a:b]], a, b) for a in range(n) for b in range(a + 2, n + 1) if piece[a:b] in self.place):
                ends, inner = 1 << a | 1 << b, (1 << b) - (1 << (a + 1))
                if cuts & ends == ends and (cuts & inner).bit_count() == 1:
                    cuts &= ~inner
            if cuts != 1 | 1 << n:
                odd.add(k)
        return odd

    def table(self, spark: SparkSession) -> DataFrame:
        """(piece, place, score, odd) of the usable pieces."""
        rows = [(p, k, float(self.pieces[self.by_place[k]][1]), k in self.odd) for p, k in self.place.items()]
        return spark.createDataFrame(rows, "piece string, place int, score double, odd boolean")

    def raw_words(self, text: str) -> list[str] | None:
        """Parts between single blanks, each to be cut with a blank before it; None if the text needs `words`."""
        if not self.prefix or self.squeeze or BLANK in text or "  " in text or text[:1] == " " or text[-1:] == " ":
            return None
        return text.split(" ")

    def words(self, text: str | None) -> list[str]:
        if not text:
            return []
        text = text.replace(BLANK, " ")
        if self.squeeze:
            text = regex.sub(" +", " ", text).strip(" ")
            if not text:
                return []
        return self.cut.findall(" " + text if self.prefix else text)

    def decode(self, ids: np.ndarray) -> str:
        ids = np.asarray(ids, dtype=np.int64)
        if self.alone[ids].all():
            text = "".join(map(self.shown.__getitem__, ids.tolist()))
            return text[1:] if self.prefix and text.startswith(" ") else text
        out, pending = [], bytearray()
        for i in ids.tolist():
            piece, _, kind = self.pieces[i]
            if kind == BYTE:
                pending.append(int(piece[3:5], 16))
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            if kind in (NORMAL, USER):
                out.append(piece)
            elif kind == UNKNOWN:
                out.append(" ⁇ ")
        if pending:
            out.append(pending.decode("utf-8", "replace"))
        text = "".join(out).replace(BLANK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def taken(values: np.ndarray, first: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `values` with these beginnings and sizes at the given places, one after another, and their sizes."""
    n = sizes[at]
    out = np.arange(int(n.sum()), dtype=np.int32)
    out += np.repeat((first[at] - (np.cumsum(n) - n)).astype(np.int32), n)
    return values[out], n


class _Parts(dict):
    """A number for each part, given at first sight. A part is what stands between blanks, or (text,) for a whole text."""

    def __init__(self, model: Model):
        self.model, self.words, self.of_part, self.sizes = model, {}, array("I"), array("I")

    def __missing__(self, part) -> int:
        number = self[part] = len(self)
        if isinstance(part, tuple):
            found = self.model.words(part[0])
        else:
            found = (" " + part,) if part.isalpha() else self.model.cut.findall(" " + part)
        words = self.words
        self.of_part.extend([words.setdefault(w, len(words)) for w in found])
        self.sizes.append(len(found))
        return number


def digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


class _Block:
    """Documents as numbers of distinct words; with their digests if they are to be checked, else with what spells them."""

    def __init__(self, model: Model, check: bool):
        self.model, self.check, self.parts, self.seq = model, check, _Parts(model), array("I")
        self.ids, self.n, self.kept, self.digests, self.chars = [], array("i"), [], array("Q"), 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        parts = self.model.raw_words(text) if text else ()
        if parts is None:
            parts = ((text,),)
            if not self.check and "".join(self.model.words(text)) != " " * self.model.prefix + text:
                self.kept.append((len(self.ids), text))
        if self.check:
            self.digests.append(digest(text or ""))
        self.seq.extend(map(self.parts.__getitem__, parts))
        self.ids.append(doc_id)
        self.n.append(-1 if text is None else len(parts))
        self.chars += len(text or "")

    def full(self) -> bool:
        return len(self.parts) >= BLOCK_PARTS or self.chars >= BLOCK_CHARS

    def rows(self, block: int, buckets: int) -> pa.RecordBatch:
        words = list(self.parts.words)
        bucket = np.fromiter((crc32(w.encode()) % buckets for w in words), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        of_part, sizes = np.frombuffer(self.parts.of_part, np.uint32), np.frombuffer(self.parts.sizes, np.uint32).astype(np.int32)
        seq, n = taken(number[of_part], np.cumsum(sizes) - sizes, sizes, np.frombuffer(self.seq, np.uint32))
        ends = np.r_[0, np.cumsum(n, dtype=np.int64)]
        parts = np.frombuffer(self.n, np.int32)
        last = np.cumsum(np.maximum(parts, 0))
        count = np.where(parts < 0, -1, ends[last] - ends[last - np.maximum(parts, 0)])
        words = pa.array(words, pa.string()).take(pa.array(order))
        one = {"doc_id": pa.array([self.ids], pa.list_(pa.int64())), "n": pa.array([count], pa.list_(pa.int64())), "seq": pa.array([planes(seq)], pa.large_binary()), "size": pa.array([len(words)], pa.int64())}
        if self.check:
            one |= {"digest": pa.array([np.frombuffer(self.digests, np.uint64)], pa.list_(pa.uint64()))}
        else:
            one |= {"words": pa.ListArray.from_arrays([0, len(words)], words), "kept": pa.array([[k for k, _ in self.kept]], pa.list_(pa.int64())), "texts": pa.array([[t for _, t in self.kept]], pa.list_(pa.large_string()))}
        own, first = np.unique(bucket[order], return_index=True)
        lists = [zipped(pa.table({"word": words[s:e]})) for s, e in zip(first.tolist(), [*first[1:].tolist(), len(words)])]
        keys, none = np.r_[own, -1 - block], [None]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.full(len(keys), block), pa.int64()), pa.array(lists + none, pa.binary()), pa.array(none * len(own) + [zipped(pa.table(one))], pa.binary())], ["key", "block", "words", "docs"])


def blocks(docs: DataFrame, model: Model, buckets: int, check: bool = False) -> DataFrame:
    """(key, block, words, docs): the words of each bucket (key >= 0) of each block, and its documents (key = -1 - block).

    Both are compressed Arrow tables. Blocks are numbered by task and place, so a task that runs again gives the same ones.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 24, _Block(model, check)
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                held.add(doc_id, text.as_py())
                if held.full():
                    yield held.rows(number, buckets)
                    number, held = number + 1, _Block(model, check)
                    trim()
        if held.ids:
            yield held.rows(number, buckets)
        del held
        trim()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "key long, block long, words binary, docs binary")


def bucket_words(dealt: DataFrame) -> DataFrame:
    """(bucket, word): the distinct words of all blocks."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def report() -> Iterator[pa.RecordBatch]:
            for k, (found,) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), k), pa.int64()), found], ["bucket", "word"])
            held.clear()

        def compact() -> int:
            for k, found in held.items():
                held[k] = [pc.unique(pa.concat_arrays(found))]
            return sum(len(found) for found, in held.values())

        size = 0
        for b in batches:
            for k, words in zip(b.column(0).to_pylist(), b.column(2)):
                if k >= 0:
                    held.setdefault(k, []).append(unzipped(words)["word"].combine_chunks())
                    size += len(held[k][-1])
            if size >= 2 * WORDS_HELD:
                size = compact()
                if size >= WORDS_HELD:
                    yield from report()
                    size = 0
        compact()
        yield from report()
        trim()

    return dealt.mapInArrow(spread, "bucket long, word string")


def lattice(words: DataFrame, model: Model, edge: Column) -> DataFrame:
    """words with n, edges and odd: the pieces that are substrings of each word, and whether an odd piece is among them.

    `edge` is made of place, start, size and score. A character without a piece has an edge of its own, at STRANGE. The
    words are dealt before they are exploded, so their edges are grouped where they arise.
    """
    keys = words.columns
    shown = words.select(*keys, F.translate("word", " ", BLANK).alias("shown"), F.char_length("word").alias("n"))
    starts = shown.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("start"))
    spans = starts.select(*keys, "shown", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(model.longest), F.col("n") - F.col("start")))).alias("size"))
    rows = spans.select(*keys, "start", "size", F.expr("substring(shown, start + 1, size)").alias("piece"))
    met = rows.join(F.broadcast(model.table(words.sparkSession)), "piece", "left").filter("place is not null or size = 1").withColumn("place", F.coalesce("place", F.lit(STRANGE)))
    edges = met.groupBy(*keys).agg(F.collect_list(edge).alias("edges"), F.bool_or(F.coalesce("odd", F.lit(False))).alias("odd"))
    return edges.withColumn("n", F.char_length("word"))


def packed_edge() -> Column:
    long = lambda c, bits: F.shiftleft(F.col(c).cast("long"), bits)
    stop = (F.col("start") + F.col("size")).bitwiseAND(F.lit((1 << STOP_BITS) - 1))
    return long("place", START_BITS + STOP_BITS).bitwiseOR(long("start", STOP_BITS)).bitwiseOR(stop.cast("long"))


def scored_edge() -> Column:
    return F.struct((F.col("start") + F.col("size")).alias("stop"), "start", "score", "place")


def merge_fold(n: Column, edges: Column) -> Column:
    """Places of the pieces of a BPE model's word, by one pass over its packed edges from the best merge to the worst.

    Cuts are the bits of a long. A merge is done if both its ends are cuts and one cut lies between them. A piece that
    is not odd is built by better merges inside it, so it can be merged when its turn comes or never.
    """
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))

    def masked(e: Column) -> Column:
        low, high = bit(F.shiftright(e, STOP_BITS)), bit(e)
        return F.struct(e.alias("e"), low.bitwiseOR(high).alias("ends"), (high - F.shiftleft(low, 1)).alias("inner"))

    def step(cuts: Column, m: Column) -> Column:
        fits = (cuts.bitwiseAND(m["ends"]) == m["ends"]) & (F.bit_count(cuts.bitwiseAND(m["inner"])) == 1)
        return F.when(fits, cuts.bitwiseAND(F.bitwise_not(m["inner"]))).otherwise(cuts)

    def path(cuts: Column, found: Column) -> Column:
        on = F.filter(found, lambda m: (cuts.bitwiseAND(m["ends"]) == m["ends"]) & (cuts.bitwiseAND(m["inner"]) == 0))
        by_start = lambda e: F.shiftleft(F.shiftright(e, STOP_BITS).bitwiseAND(F.lit((1 << START_BITS) - 1)), 20).bitwiseOR(F.shiftright(e, START_BITS + STOP_BITS))
        return F.transform(F.sort_array(F.transform(on, lambda m: by_start(m["e"]))), lambda x: x.bitwiseAND(F.lit((1 << 20) - 1)).cast("int"))

    return bound(F.transform(F.sort_array(edges), masked), lambda found: bound(F.aggregate(found, bit(n + 1) - 1, step), lambda cuts: path(cuts, found)))


def viterbi_fold(n: Column, edges: Column, floor: float) -> Column:
    """Places of the pieces on the best path of a unigram model; characters without a piece pass at the score `floor`.

    Of equal paths the one whose last piece is longest is taken.
    """
    start = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(F.when(i == 0, 0.0).otherwise(-1e300).alias("score"), F.lit(-1).alias("back"), F.lit(-1).alias("place")))

    def step(best: Column, e: Column) -> Column:
        score = F.get(best, e["start"])["score"] + F.coalesce(e["score"], F.lit(floor))
        return F.transform(best, lambda b, i: F.when((i == e["stop"]) & (score > b["score"]), F.struct(score.alias("score"), e["start"].alias("back"), e["place"].alias("place"))).otherwise(b))

    def back(best: Column) -> Column:
        none = F.struct(n.alias("at"), F.array().cast("array<int>").alias("path"))
        node = lambda s: F.get(best, s["at"])
        return F.aggregate(F.sequence(F.lit(1), n), none, lambda s, _: F.when(s["at"] > 0, F.struct(node(s)["back"].alias("at"), F.concat(F.array(node(s)["place"]), s["path"]).alias("path"))).otherwise(s), lambda s: s["path"])

    return bound(F.aggregate(F.array_sort(edges), start, step), back)


def merged(n: int, edges: list[int], score: np.ndarray) -> list[int]:
    """merge_fold for words of any length and any pieces: a heap of merges. `score` goes by place."""
    place = {}
    for e in edges:
        start = e >> STOP_BITS & (1 << START_BITS) - 1
        place[start, start + (e - start & (1 << STOP_BITS) - 1)] = e >> START_BITS + STOP_BITS
    left, right = list(range(-1, n)), list(range(1, n + 2))
    alive, heap = [True] * (n + 1), []
    push = lambda a, c: (p := place.get((a, c))) is not None and heapq.heappush(heap, (-score[p], a, c))
    for i in range(n - 1):
        push(i, i + 2)
    while heap:
        _, a, c = heapq.heappop(heap)
        if not (alive[a] and alive[c]) or right[a] == c or right[right[a]] != c:
            continue
        alive[right[a]] = False
        right[a], left[c] = c, a
        if left[a] >= 0:
            push(left[a], c)
        if c < n:
            push(a, right[c])
    cuts = [i for i in range(n + 1) if alive[i]]
    return [place[a, b] for a, b in zip(cuts, cuts[1:])]


def best_path(n: int, edges: list[dict], floor: float) -> list[int]:
    """viterbi_fold for words of any length."""
    best = [(0.0, -1, -1)] + [(-1e300, -1, -1)] * n
    for e in sorted(edges, key=lambda e: (e["stop"], e["start"])):
        score = best[e["start"]][0] + (floor if e["score"] is None else e["score"])
        if score > best[e["stop"]][0]:
            best[e["stop"]] = (score, e["start"], e["place"])
    path, at = [], n
    while at > 0:
        path.append(best[at][2])
        at = best[at][1]
    return path[::-1]


def word_pieces(words: DataFrame, model: Model) -> DataFrame:
    """words (distinct, with any keys), pieces and edges: the places of each word's pieces.

    A word that is too long for a fold of bits, or has an odd piece, has its edges instead, for `folded`.
    """
    n, edges = F.col("n"), F.col("edges")
    if model.kind == BPE:
        found, fold = lattice(words, model, packed_edge()), merge_fold(n, edges)
    else:
        found, fold = lattice(words, model, scored_edge()), viterbi_fold(n, edges, model.floor)
    slow = (n > FAST) | F.col("odd")
    return found.select(*words.columns, F.when(~slow, fold).alias("pieces"), F.when(slow, edges).alias("edges"))


def folded(word: str, edges: list, model: Model) -> list[int]:
    return merged(len(word), edges, model.scores) if model.kind == BPE else best_path(len(word), edges, model.floor)


def spelled(word: str, places: list[int], model: Model) -> list[int]:
    """Ids of a word from the places of its pieces."""
    out, at = [], 0
    for p in places:
        if p == STRANGE:
            out += [model.bytes_[x] for x in word[at].encode()] if len(model.bytes_) == 256 else [model.unknown]
            at += 1
        else:
            out.append(int(model.by_place[p]))
            at += len(model.pieces[model.by_place[p]][0])
    return out


def bucket_ids(entries: DataFrame, dealt: DataFrame, model: Model) -> DataFrame:
    """(key, bucket, ids): for each block and bucket the number of ids of each word, and the ids."""

    def assign(known: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.filter(pc.is_valid(rows["words"]))
        key, bucket, data = [], [], []
        if rows.num_rows:
            words, pieces = known["word"].combine_chunks(), known["pieces"].combine_chunks()
            sizes = pc.fill_null(pc.list_value_length(pieces), 0).to_numpy().astype(np.int64)
            places = pieces.flatten().to_numpy()
            first = np.cumsum(sizes) - sizes
            ids = [model.by_place[np.minimum(places, len(model.by_place) - 1)]]
            slow = dict.fromkeys(np.flatnonzero(pc.is_null(pieces).to_numpy(zero_copy_only=False)).tolist())
            slow |= dict.fromkeys(np.unique(np.searchsorted(first + sizes, np.flatnonzero(places == STRANGE), "right")).tolist())
            end = len(places)
            for k in slow:
                word, edges = words[k].as_py(), known["edges"][k].as_py()
                own = spelled(word, pieces[k].as_py() if edges is None else folded(word, edges, model), model)
                first[k], sizes[k] = end, len(own)
                end += len(own)
                ids.append(np.array(own, np.int64))
            ids = np.concatenate(ids)
            asked = [unzipped(w)["word"].combine_chunks() for w in rows["words"]]
            at = pc.index_in(pa.concat_arrays(asked), value_set=words)
            if at.null_count:
                raise LookupError("a block has a word that its bucket has no pieces for")
            at, ends = at.to_numpy(), np.cumsum([len(x) for x in asked])
            for k, b, s, e in zip(rows["key"].to_pylist(), rows["block"].to_pylist(), [0, *ends], ends):
                flat, n = taken(ids, first, sizes, at[s:e])
                key.append(-1 - b), bucket.append(k), data.append(planes(np.r_[len(n), n, flat]))
        trim()
        return pa.table({"key": pa.array(key, pa.int64()), "bucket": pa.array(bucket, pa.int64()), "ids": pa.array(data, pa.binary())})

    return entries.groupBy("bucket").cogroup(dealt.groupBy("key")).applyInArrow(assign, "key long, bucket long, ids binary")


def encode(docs: DataFrame, model: Model, check: bool = False) -> DataFrame:
    """(doc_id, text, ids) of every document; with `check` (doc_id, ids, round_trip): whether the ids decode to a text with the text's digest."""
    width = 2 * shuffle_width(docs.sparkSession)
    # every use below takes all columns, so the documents are read and dealt once
    dealt = blocks(docs, model, 2 * width, check).repartition(width, "key")
    words = bucket_words(dealt).repartition(width, "bucket").distinct()
    found = bucket_ids(word_pieces(words, model), dealt, model)
    last = ("round_trip", pa.bool_()) if check else ("text", pa.string())
    names = ["doc_id", "ids", last[0]] if check else ["doc_id", "text", "ids"]
    types = {"doc_id": pa.int64(), "ids": pa.list_(pa.int32()), last[0]: last[1]}

    def finish(rows: pa.Table, found: pa.Table) -> pa.Table:
        rows = rows.filter(pc.is_valid(rows["docs"]))
        out = []
        for data in rows["docs"]:
            t = unzipped(data)
            doc_id, count = t["doc_id"][0].values, t["n"][0].values.to_numpy()
            seq = unplaned(t["seq"][0].as_py())
            if check:
                digests = t["digest"][0].as_py()
            else:
                words, kept = t["words"][0].values.to_pylist(), dict(zip(t["kept"][0].as_py(), t["texts"][0].as_py()))
            per_bucket = [unplaned(x.as_py()) for x in found.sort_by("bucket")["ids"]]
            sizes = np.concatenate([x[1 : 1 + x[0]] for x in per_bucket] or [np.zeros(0, int)]).astype(np.int32)
            ids = np.concatenate([x[1 + x[0] :] for x in per_bucket] or [np.zeros(0, int)]).astype(np.int32)
            if len(sizes) != t["size"][0].as_py():
                raise LookupError("a block lacks the pieces of some of its words")
            begin, stop = np.cumsum(sizes) - sizes, np.cumsum(np.maximum(count, 0))
            group = 0
            while group < len(count):  # a few documents at a time, so that what a task holds is bounded
                first = stop[group - 1] if group else 0
                last_ = max(group + 1, int(np.searchsorted(stop, first + PIECE, "right")))
                part = seq[first : stop[last_ - 1]]
                flat, n = taken(ids, begin, sizes, part)
                ends = np.r_[0, np.cumsum(n)]
                bounds = ends[np.r_[first, stop[group:last_]] - first]
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
                if check:
                    shown = [digest(model.decode(flat[a:b])) == x for a, b, x in zip(bounds, bounds[1:], digests[group:last_])]
                else:
                    shown, numbers = [], part.tolist()
                    for k in range(group, last_):
                        s, e = int(stop[k] - max(count[k], 0) - first), int(stop[k] - first)
                        shown.append(None if count[k] < 0 else kept[k] if k in kept else "".join(map(words.__getitem__, numbers[s:e]))[int(model.prefix) :])
                cols = {"doc_id": doc_id.slice(group, last_ - group), "ids": lists, last[0]: pa.array(shown, last[1])}
                out.append(pa.RecordBatch.from_arrays([cols[c] for c in names], names))
                group = last_
        trim()
        return pa.Table.from_batches(out, pa.schema([(c, types[c]) for c in names]))

    return dealt.groupBy("key").cogroup(found.groupBy("key")).applyInArrow(finish, "doc_id long, ids array<int>, round_trip boolean" if check else "doc_id long, text string, ids array<int>")


def decode(df: DataFrame, model: Model, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """df with the text of its ids as one more column."""

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return pd.Series([None if i is None else model.decode(i) for i in ids], dtype=object)

    return df.withColumn(name, text(ids))


def encoded(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): each document's ids and whether they decode to its text."""
    model = model or Model.load()
    return encode(docs, model, check=True).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))
