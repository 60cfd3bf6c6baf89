"""Ranked lexical search over a K2-treap of the term-document grid.

Documents travel in blocks. A block is a grid with a row for each of its terms and a column for each of its documents
(by doc_id), cut into quadrants again and again: a treap keeps, level by level, which quadrants hold anything (four
bits a cell) and the largest impact in each (as the difference from its parent's, which is mostly small). An impact is
the integer part of a term's score in a document without the term's weight.

An item's terms are rows. All its row paths go down together over one range of documents at a time: the weighted sum of
the cells' maxima bounds every score in the range, ranges are taken best bound first (a few at a time), and those that
can't reach the item's best documents so far are left. A task keeps the best documents of each item from block to
block; the tasks' best meet in one small window. So the result is exact.

A document without terms (null or empty texts among them) counts nowhere and is never found. Rows that repeat are
documents of their own; of equal scores the smaller doc_id comes first, null ones last. Items that repeat an id are
searched as one text after another, items without terms find nothing, and so does everything in an empty table. Very
long texts are taken whole. Other columns don't matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordweave.llm.common import planes, stage, table, trim, unplaned

#: Bytes of terms stay (A-Z lower-cased), others become blanks; bytes of characters beyond ASCII are parts of terms.
TERMS = bytes(b if b >= 0x80 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: A block ends with the document that brings it to so many documents or grid points.
BLOCK_DOCS = 1 << 11
BLOCK_POINTS = 1 << 19
POSTINGS = ["terms", "doc_ids", "sizes", "df", "column", "tf"]
#: Items that are sent to the tasks at a time.
ITEMS_AT_ONCE = 2000
#: Ranges of documents that are opened at a time.
AT_ONCE = 64
#: The doc_id that a null one counts as: behind all others.
NO_ID = np.iinfo(np.int64).max


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERMS).split()


def one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


# --- blocks of postings ---------------------------------------------------------------------------------------------
def blocks(docs: DataFrame) -> DataFrame:
    """(docs, terms, doc_ids, sizes, df, column, tf): the postings of blocks of documents, by term, then column.

    Columns are in order of doc_id, terms in order of df, the documents that hold them, so that cells join like terms.
    sizes are terms with repeats. Numbers are packed.
    """

    class Block:
        def __init__(self):
            self.ids, self.sizes, self.numbers, self.row, self.tf = [], [], {}, [], []

        def add(self, doc_id: int | None, terms: list[bytes]) -> None:
            own = Counter(terms)
            self.ids.append(NO_ID if doc_id is None else doc_id)
            self.sizes.append((len(terms), len(own)))
            numbers = self.numbers
            self.row.append(np.fromiter((numbers.setdefault(t, len(numbers)) for t in own), np.uint32, len(own)))
            self.tf.append(np.fromiter(own.values(), np.uint32, len(own)))

        def rows(self) -> pa.RecordBatch:
            ids, sizes = np.array(self.ids, np.int64), np.array(self.sizes, np.int64)
            order = np.argsort(ids, kind="stable")
            column = np.empty(len(ids), np.int64)
            column[order] = np.arange(len(ids))
            number, tf = np.concatenate(self.row), np.concatenate(self.tf)
            df = np.bincount(number)
            by_df = np.argsort(-df, kind="stable")
            row = np.empty(len(df), np.int64)
            row[by_df] = np.arange(len(df))
            key = row[number] << 32 | np.repeat(column, sizes[:, 1])
            by = np.argsort(key)
            names = pa.array(list(self.numbers), pa.binary()).take(pa.array(by_df))
            packed = [ids[order].tobytes(), sizes[order, 0].tobytes(), planes(df[by_df]), planes(key[by] & 0xFFFFFFFF), planes(tf[by])]
            return pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int64()), one_list(names), *[pa.array([x], pa.binary()) for x in packed]], ["docs", "terms", "doc_ids", "sizes", "df", "column", "tf"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, points = Block(), 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                terms = terms_of((text.as_py() or "").encode("utf-8", "surrogatepass"))
                if terms:
                    held.add(doc_id, terms)
                    points += held.sizes[-1][1]
                if len(held.ids) >= BLOCK_DOCS or points >= BLOCK_POINTS:
                    yield held.rows()
                    held, points = Block(), 0
        if held.ids:
            yield held.rows()
        del held
        trim()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "docs long, terms array<binary>, doc_ids binary, sizes binary, df binary, column binary, tf binary")


def term_counts(dealt: DataFrame) -> DataFrame:
    """(term, df) of every block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for terms, df in zip(b.column(0), b.column(1)):
                yield pa.RecordBatch.from_arrays([terms.values, pa.array(unplaned(df.as_py()).astype(np.int64))], ["term", "df"])

    return dealt.select("terms", "df").mapInArrow(count, "term binary, df long")


def totals(dealt: DataFrame) -> tuple[int, int]:
    """Documents with terms, and all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([int(np.frombuffer(x.as_py(), np.int64).sum()) for x in b.column(1)], pa.int64())], ["n", "l"])

    found = dealt.select("docs", "sizes").mapInArrow(count, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    return found[0] or 0, found[1] or 0


# --- the treap ------------------------------------------------------------------------------------------------------
def spread(x: np.ndarray) -> np.ndarray:
    """The bits of x (32 at most) at the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


class Treap:
    """Quadrants of a grid of 2 ** height rows and columns, as four bits a cell, and the maxima in them."""

    def __init__(self, height: int, masks: list[np.ndarray], maxima: list[np.ndarray]):
        self.height, self.masks, self.maxima = height, masks, maxima
        # the first child of each cell, and which child each of its bits is
        self.first = [np.r_[np.int32(0), np.cumsum(np.bitwise_count(m), dtype=np.int32)] for m in masks]

    @classmethod
    def build(cls, row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int, columns: int) -> Treap:
        height = max(rows - 1, columns - 1, 1).bit_length()
        code = spread(row) << np.uint64(1) | spread(column)
        order = np.argsort(code)
        code, value = code[order], value[order].astype(np.int32)
        masks, maxima = [], [value]
        for _ in range(height):
            up = code >> np.uint64(2)
            first = np.flatnonzero(np.r_[True, up[1:] != up[:-1]])
            masks.append(np.bitwise_or.reduceat(np.left_shift(1, (code & np.uint64(3)).astype(np.uint8), dtype=np.uint8), first))
            value = np.maximum.reduceat(value, first)
            maxima.append(value)
            code = up[first]
        return cls(height, masks[::-1], maxima[::-1])

    def packed(self) -> tuple[bytes, bytes]:
        """The bits of all levels, and the differences of the maxima from their parents', level by level."""
        less = [self.maxima[0], *[np.repeat(p, np.bitwise_count(m)) - c for p, m, c in zip(self.maxima, self.masks, self.maxima[1:])]]
        return np.concatenate(self.masks).tobytes(), planes(np.concatenate(less))

    @classmethod
    def unpacked(cls, height: int, masks: bytes, less: bytes) -> Treap:
        bits, differences = np.frombuffer(masks, np.uint8), unplaned(less).astype(np.int32)
        levels, maxima, at, n = [], [differences[:1]], 0, 1
        for _ in range(height):
            levels.append(bits[at : at + n])
            at += n
            size = np.bitwise_count(levels[-1])
            n = int(size.sum())
            maxima.append(np.repeat(maxima[-1], size) - differences[at : at + n])
        return cls(height, levels, maxima)

    def child(self, level: int, cell: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The cells of the next level in these quadrants; -1 where there is nothing, or was nothing before."""
        mask = np.where(cell >= 0, self.masks[level][cell], 0)
        held = mask >> quadrant & 1
        return np.where(held == 1, self.first[level][cell] + np.bitwise_count(mask & (1 << quadrant) - 1), -1)


def impacts(tf: np.ndarray, size: np.ndarray, n: int, total: int) -> np.ndarray:
    """A term's part of a score, without its weight; size is the document's terms."""
    m = 100 - 25 + 25 * size * n // max(total, 1)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def builder(n: int, total: int):
    """A function from batches of blocks to batches of their treaps over impacts, which follow from n and total."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for terms, *data in zip(*b.columns):
                (ids, sizes), (df, column, tf) = (np.frombuffer(x.as_py(), np.int64) for x in data[:2]), (unplaned(x.as_py()) for x in data[2:])
                value = impacts(tf.astype(np.int64), sizes[column], n, total)
                treap = Treap.build(np.repeat(np.arange(len(df)), df), column, value, len(df), len(ids))
                packed = treap.packed()
                yield pa.RecordBatch.from_arrays([one_list(terms.values), pa.array([ids.tobytes()], pa.binary()), pa.array([treap.height], pa.int32()), *[pa.array([x], pa.binary()) for x in packed]], ["terms", "doc_ids", "height", "masks", "less"])
        trim()

    return build


def index(dealt: DataFrame, n: int, total: int) -> DataFrame:
    """(terms, doc_ids, height, masks, less) of each block: an index to be written, for `searcher`."""
    return dealt.select(POSTINGS).mapInArrow(builder(n, total), "terms array<binary>, doc_ids binary, height int, masks binary, less binary")


# --- search ---------------------------------------------------------------------------------------------------------
class Best:
    """The best (score, doc_id) of an item so far, at most `most`; equal scores by doc_id."""

    def __init__(self, most: int):
        self.most, self.score, self.doc_id = most, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, doc_id: np.ndarray) -> None:
        score, doc_id = np.r_[self.score, score], np.r_[self.doc_id, doc_id]
        order = np.lexsort((doc_id, -score))[: self.most]
        self.score, self.doc_id = score[order], doc_id[order]

    def may(self, bound: np.ndarray, doc_id: np.ndarray) -> np.ndarray:
        """Whether documents of at most this score, and at least this doc_id, can be among the best."""
        if len(self.score) < self.most:
            return bound > 0
        least = self.score[-1]
        return (bound > least) | (bound == least) & (doc_id < self.doc_id[-1])


def descend(treap: Treap, ids: np.ndarray, rows: np.ndarray, weight: np.ndarray, best: Best) -> None:
    """Put the block's documents that are among the item's best into `best`; rows are the item's terms in the block."""
    h = treap.height
    wide = max(len(ids) - 1, 0).bit_length()
    cell = np.zeros((1, len(rows)), np.int64)
    for level in range(h - wide):  # here one cell is as wide as the block, so rows alone decide
        cell = treap.child(level, cell, (rows >> h - 1 - level & 1)[None] << 1)
    # ranges that wait: level, beginning, bound, cells of the rows
    wait = [(h - wide, np.zeros(1, np.int64), np.array([NO_ID]), cell)]
    halves = np.array([[0], [1]])
    while wait:
        # the best ranges of the level that holds the best of all
        at = max(range(len(wait)), key=lambda k: wait[k][2][0])
        level, begin, bound, cell = wait.pop(at)
        if not best.may(bound[:1], ids[:1])[0]:
            continue
        if len(bound) > AT_ONCE:
            wait.append((level, begin[AT_ONCE:], bound[AT_ONCE:], cell[AT_ONCE:]))
            begin, bound, cell = begin[:AT_ONCE], bound[:AT_ONCE], cell[:AT_ONCE]
        keep = best.may(bound, ids[begin])
        begin, cell = begin[keep], cell[keep]
        if level == h:
            best.add(bound[keep], ids[begin])
            continue
        if not len(begin):
            continue
        quadrant = (rows >> h - 1 - level & 1) << 1
        below = treap.child(level, np.repeat(cell, 2, 0), np.tile(quadrant | halves, (len(begin), 1)))
        begin = np.repeat(begin, 2)
        begin[1::2] += 1 << h - 1 - level
        value = np.where(below >= 0, treap.maxima[level + 1][below], 0)
        bound = value.astype(np.int64) @ weight
        keep = np.flatnonzero(bound > 0)
        begin, bound, below = begin[keep], bound[keep], below[keep]
        keep = np.flatnonzero(best.may(bound, ids[begin]))
        if len(keep):
            keep = keep[np.argsort(-bound[keep], kind="stable")]
            wait.append((level + 1, begin[keep], bound[keep], below[keep]))


def searcher(queries: dict[int, dict[bytes, int]], most: int):
    """A function from batches of treaps to (item, doc_id, score): each item's best documents in them; queries are weights of terms."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {item: Best(most) for item in queries}
        asked = list({t for q in queries.values() for t in q})
        names = pa.array(asked, pa.binary())
        for b in batches:
            for terms, doc_ids, height, masks, less in zip(*b.columns):
                at = pc.index_in(names, value_set=terms.values)
                place = {t: k for t, k in zip(asked, at.to_pylist()) if k is not None}
                treap, ids = Treap.unpacked(height.as_py(), masks.as_py(), less.as_py()), np.frombuffer(doc_ids.as_py(), np.int64)
                for item, weights in queries.items():
                    found = [(place[t], w) for t, w in weights.items() if t in place]
                    if found:
                        rows, weight = np.array(found, np.int64).T
                        descend(treap, ids, rows, weight, best[item])
        for item, x in best.items():
            if len(x.score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x.score), item)), pa.array(x.doc_id), pa.array(x.score)], ["item", "doc_id", "score"])
        trim()

    return look


FOUND = "item long, doc_id long, score long"


def search(dealt: DataFrame, n: int, total: int, queries: dict[int, dict[bytes, int]], most: int) -> DataFrame:
    """The best documents in each task's blocks, whose treaps are built one at a time and searched at once."""
    build, look = builder(n, total), searcher(queries, most)
    return dealt.select(POSTINGS).mapInArrow(lambda batches: look(build(batches)), FOUND)


def search_index(indexed: DataFrame, queries: dict[int, dict[bytes, int]], most: int) -> DataFrame:
    """The same over a written index."""
    return indexed.mapInArrow(searcher(queries, most), FOUND)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of items."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, t, k) for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for t, k in Counter(terms_of((text or "").encode("utf-8", "surrogatepass"))).items()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), (pa.int64(), pa.binary(), pa.int64()))] if found else [pa.array([], t) for t in (pa.int64(), pa.binary(), pa.int64())], ["item_id", "term", "times"])

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(cut, "item_id long, term binary, times long").groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def ranked(docs: DataFrame, items: DataFrame, most: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's best documents.

    Items go to the tasks in groups of ITEMS_AT_ONCE, so what is sent is bounded; documents are cut into terms once.
    """
    dealt = stage(blocks(docs), "blocks")
    n, total = totals(dealt)
    counts = term_counts(dealt)
    weight = F.floor(1000 * F.ln((F.lit(2.0) * n + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long") * F.col("times")
    asked = stage(item_terms(items), "item_terms")
    df = counts.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weighed = asked.join(df, "term").withColumn("weight", weight).filter("weight > 0 and item_id is not null")
    weighed = stage(weighed.groupBy("item_id").agg(F.collect_list(F.struct("term", "weight")).alias("terms")), "weights")
    found = None
    for batch in batched(weighed):
        part = search(dealt, n, total, batch, most)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return items.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    # tasks' best are thinned by parts first, so that no window holds all tasks' rows of an item
    for keys in (["item", F.pmod(F.xxhash64("doc_id"), F.lit(64))], ["item"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    out = found
    return out.select(F.col("item").alias("item_id"), "rank", F.nullif("doc_id", F.lit(int(NO_ID))).alias("doc_id"), "score")


def batched(weighed: DataFrame) -> Iterator[dict[int, dict[bytes, int]]]:
    """Items with their terms' weights, ITEMS_AT_ONCE at a time."""
    batch: dict[int, dict[bytes, int]] = {}
    for item in weighed.select("item_id", "terms").toLocalIterator():
        batch[item.item_id] = {bytes(t.term): t.weight for t in item.terms}
        if len(batch) == ITEMS_AT_ONCE:
            yield batch
            batch = {}
    if batch:
        yield batch


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
with t as (
  select doc_id, row_number() over () as row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents where text is not null),
p as (select row, any_value(doc_id) as doc_id, term, count(*)::bigint as tf from t group by row, term),
d as (select row, sum(tf)::bigint as n from p group by row),
a as (select count(*)::bigint as n, sum(n)::bigint as l from d),
q as (
  select item_id, term, count(*)::bigint as times from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark where text is not null)
  group by item_id, term),
w as (select term, floor(1000 * ln((2.0::double * (select n from a) + 2) / (2.0::double * count(*) + 1)))::bigint as w from p group by term),
s as (
  select q.item_id, p.row, any_value(p.doc_id) as doc_id, sum(q.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * d.n * a.n) // a.l))))::bigint as score
  from q join p using (term) join w using (term) join d on p.row = d.row cross join a group by q.item_id, p.row),
r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from s where score > 0)
select item_id, rank, doc_id, score from r where rank <= 20
"""
