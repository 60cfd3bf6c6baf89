"""Linking joins: identifier cascade, lossless substring join, name join, best match, ledger joins."""

from __future__ import annotations

import difflib
import operator
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from recordweave.functions import text as T
from recordweave.sources.staging import staged

#: Sides of at most so many rows are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most `rows` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def prioritised(columns: list[tuple[str, Column]], name: str, use) -> Column:
    """All identifiers of a row as (pri_, pos_, match_source, `name`), by column, then position."""

    def tagged(k: int, source: str, ids: Column) -> Column:
        return F.transform(ids, lambda x, i: F.struct(F.lit(k).alias("pri_"), i.alias("pos_"), F.lit(source).alias("match_source"), use(x).alias(name)))

    return F.flatten(F.array(*[tagged(k, source, ids) for k, (source, ids) in enumerate(columns)]))


def id_cascade(left: DataFrame, lookup: DataFrame, columns: list[tuple[str, Column]], row_id: str = "row_id", key: str = "application_id") -> DataFrame:
    """left with match_source and the lookup's columns: the first identifier, by column then position, that is known.

    `columns` are (source name, array of identifiers) in order of priority. One equi-join, one window per row.
    """
    ids = prioritised(columns, "candidate", lambda x: x)
    found = left.select(row_id, F.explode(ids).alias("c")).select(row_id, "c.*").join(lookup, F.col("candidate") == F.col(key))
    first = found.withColumn("rank_", F.row_number().over(Window.partitionBy(row_id).orderBy("pri_", "pos_"))).filter("rank_ = 1").drop("rank_", "pri_", "pos_", "candidate")
    return left.join(first, row_id, "left")


def grams(c: Column, k: int) -> Column:
    """Distinct runs of k characters."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - k + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(k))))


#: Needles of digits alone meet runs of digits, by their length from one of these up to the next.
DIGITS = (12, 9, 6)


def substring_join(needles: DataFrame, haystacks: DataFrame, needle: str, haystack: str, k: int = 6, least: int = 3) -> DataFrame:
    """All pairs with needle contained in haystack, for needles of at least `least` characters.

    A needle's last k characters must be among the haystack's k-grams, so that one equi-join finds every pair, and
    `contains` is checked within it. Needles shorter than k are joined on their last `least` characters. Needles of
    digits alone are joined on as many digits as their kind of length allows, with grams of runs of digits only: so
    numbers of equal endings don't meet. The kinds that there are (a few) are looked up first; needles of a kind that all
    have one length are joined as a whole.
    """
    text, digits = F.col(needle), F.col(needle).rlike("^[0-9]+$")
    kind = F.when(digits, F.coalesce(*[F.when(F.length(text) >= x, x) for x in DIGITS if x > k], F.when(F.length(text) >= k, k), F.lit(least))).otherwise(F.when(F.length(text) >= k, -k).otherwise(-least))
    asked = needles.filter(F.length(text) >= least).withColumn("kind_", kind)
    out = []
    kinds = {r[0]: r[1:] for r in asked.groupBy("kind_").agg(F.min(F.length(text)), F.max(F.length(text))).collect()}
    for size, (shortest, longest) in sorted(kinds.items()) or [(least, (least, least))]:
        n = abs(size)
        own = asked.filter(F.col("kind_") == size).drop("kind_")
        runs = T.all_groups(F.col(haystack), rf"[0-9]{{{n},}}") if size > 0 else F.array(haystack)
        # needles of one length are the grams: no haystack goes along for a check
        n = longest if shortest == longest else n
        own = own.withColumn("gram_", text.substr(F.length(text) - n + 1, F.lit(n)))
        h = haystacks.filter(F.length(haystack) >= n).withColumn("gram_", F.explode(F.array_distinct(F.flatten(F.transform(runs, lambda x: grams(x, n))))))
        met = own["gram_"] == h["gram_"]
        out.append(own.join(h, met if shortest == longest else met & F.col(haystack).contains(text)).drop("gram_"))
    return reduce(DataFrame.unionByName, out)


def ids_in_text(left: DataFrame, rows: DataFrame, columns: list[tuple[str, Column]], row_id: str, text: str, order: str, blocked: bool = True) -> DataFrame:
    """(row_id, match_source, order): per row the first identifier found inside `text`, by column, position and row order."""
    ids = prioritised(columns, "needle", T.normalize_id)
    # written once: they are asked for their kinds, for distinct ones and for the rows that hold them
    needles = staged(left.select(row_id, F.explode(ids).alias("c")).select(row_id, "c.*").filter(F.length("needle") >= 3))
    hay = rows.select(F.col(order), T.normalize_id(F.col(text)).alias("hay"))
    distinct = needles.select("needle").distinct()
    if blocked:
        pairs = substring_join(distinct, hay, "needle", "hay")
    else:
        pairs = checked_broadcast(distinct).join(hay, F.col("hay").contains(F.col("needle")))
    # the first row of a needle is all that can win, so pairs shrink before they meet the rows again
    first = pairs.groupBy("needle").agg(F.min(order).alias(order))
    hit = needles.join(first, "needle")
    return hit.groupBy(row_id).agg(F.min_by(F.struct("match_source", F.col(order)), F.struct("pri_", "pos_")).alias("m")).select(row_id, "m.match_source", F.col(f"m.{order}").alias(order))


def matching(x: str, y: str) -> int:
    """Characters in difflib's matching blocks of texts without popular characters: the longest block, the first in x and then in y, and so on at both sides of it."""
    total, todo = 0, [(0, len(x), 0, len(y))]
    while todo:
        i, x_end, y_from, y_end = todo.pop()
        x_from, at, size = i, i, 0
        while i + size < x_end:
            if y.find(x[i : i + size + 1], y_from, y_end) >= 0:
                at, size = i, size + 1
            else:
                i += 1
        if size:
            there = y.find(x[at : at + size], y_from, y_end)
            total += size
            todo += [(x_from, at, y_from, there), (at + size, x_end, there + size, y_end)]
    return total


def ratio(x: str | None, y: str | None) -> float:
    """difflib's ratio; from 200 characters on difflib leaves frequent ones of y out."""
    if not x or not y:
        return 0.0
    if len(y) < 200:
        return 2.0 * (min(len(x), len(y)) if x in y or y in x else matching(x, y)) / (len(x) + len(y))
    return difflib.SequenceMatcher(None, x, y).ratio()


#: Texts of up to so many characters are compared many at once: a bit for each character of the second one.
LONGEST, BITS = 256, 63
#: Pairs in one batch of ratios.
BATCH = 4_000
ONE = np.uint64(1)


class Coded:
    """Texts as numbers of their characters from 1 on, all of one alphabet: one list (code) with row and place, lengths (n)."""

    def __init__(self, texts: list[str]):
        self.n = np.fromiter(map(len, texts), np.int64, len(texts))
        self.code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.row = np.repeat(np.arange(len(texts)), self.n)
        self.at = np.arange(len(self.code)) - np.repeat(np.cumsum(self.n) - self.n, self.n)

    def padded(self, most: int) -> np.ndarray:
        """A row for each text, 0 after its end; longer texts than `most` stay empty."""
        fits = self.n <= most
        out = np.zeros((len(self.n), int(self.n[fits].max(initial=1))), np.int64)
        some = fits[self.row]
        out[self.row[some], self.at[some]] = self.code[some]
        return out

    def counts(self, size: int) -> np.ndarray:
        """A row for each character, a column for each text."""
        return np.bincount(self.code * len(self.n) + self.row, minlength=size * len(self.n)).astype(np.int32).reshape(size, -1)


def coded(*lists: list[str]) -> tuple[list[Coded], np.ndarray]:
    """The lists in numbers, and the alphabet: the character (as a number) that each number stands for, but for 0."""
    found = [Coded(x) for x in lists]
    held = np.zeros(max(int(x.code.max(initial=0)) for x in found) + 1, bool)
    for x in found:
        held[x.code] = True
    place = np.cumsum(held)
    for x in found:
        x.code = place[x.code]
    return found, np.concatenate([[0], np.flatnonzero(held)])


def places(y: np.ndarray, size: int) -> np.ndarray:
    """For each text and character the places that have it, as bits."""
    out, row = np.zeros((len(y), size), np.uint64), np.arange(len(y))
    for k in range(y.shape[1]):
        out[row, y[:, k]] |= ONE << np.uint64(k)
    out[:, 0] = 0
    return out


def matchings(at: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """`matching` of many pairs. at: for each character of x (down) of each pair (across) its places in y, as bits."""
    total = np.zeros(len(m), np.int64)
    pair = np.flatnonzero((m > 0) & (n > 0))
    x_from, x_end, y_from, y_end = np.zeros_like(pair), m[pair], np.zeros_like(pair), n[pair]
    while len(pair):
        i = np.arange(int((x_end - x_from).max()))[:, None]
        met = at[np.minimum(x_from + i, len(at) - 1), pair] & ((ONE << y_end.astype(np.uint64)) - (ONE << y_from.astype(np.uint64)))
        run = met = np.where(i < x_end - x_from, met, np.uint64(0))
        size, x_last, y_last, which, k = np.zeros_like(pair), np.zeros_like(pair), np.zeros_like(pair), np.arange(len(pair)), 0
        before = run
        while len(which):  # run: the ends of blocks of k + 1 characters
            on = np.bitwise_or.reduce(run, axis=0) != 0
            if not on.all():
                if k:
                    ended, off = before[:, ~on], which[~on]
                    first = (ended != 0).argmax(0)
                    bits = ended[first, np.arange(len(off))]
                    size[off], x_last[off], y_last[off] = k, first, np.bitwise_count((bits & (~bits + ONE)) - ONE)
                which, run, met = which[on], run[:, on], met[:, on]
            before, run = run, np.zeros_like(run)
            run[1:] = (before[:-1] << ONE) & met[1:]
            k += 1
        some = size > 0
        pair, size, x_from, x_end, y_from, y_end = (v[some] for v in (pair, size, x_from, x_end, y_from, y_end))
        x_next, y_next = x_from + x_last[some] + 1, y_last[some] + 1
        total += np.bincount(pair, size, len(total)).astype(np.int64)
        left, right = (x_next - size > x_from) & (y_next - size > y_from), (x_next < x_end) & (y_next < y_end)
        sides = ((pair, pair), (x_from, x_next), (x_next - size, x_end), (y_from, y_next), (y_next - size, y_end))
        pair, x_from, x_end, y_from, y_end = (np.concatenate([a[left], b[right]]) for a, b in sides)
    return total


def ratios(xs: list[str | None], ys: list[str | None]) -> np.ndarray:
    """`ratio` of many pairs."""
    xs, ys = [x or "" for x in xs], [y or "" for y in ys]
    m, n = (np.fromiter(map(len, v), np.int64, len(v)) for v in (xs, ys))
    out, some = np.zeros(len(xs)), (m > 0) & (n > 0)
    short = (m <= LONGEST) & (n <= BITS)
    for k in np.flatnonzero(some & ~short):
        out[k] = ratio(xs[k], ys[k])
    todo = np.flatnonzero(some & short)
    todo = todo[np.argsort(m[todo], kind="stable")]  # a batch is as wide as its longest text
    for which in (todo[k : k + BATCH] for k in range(0, len(todo), BATCH)):
        (x, y), alphabet = coded([xs[k] for k in which], [ys[k] for k in which])
        at = places(y.padded(BITS), len(alphabet))[np.arange(len(which)), x.padded(LONGEST).T]
        out[which] = 2.0 * matchings(at, x.n, y.n) / (x.n + y.n)
    return out


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of normalised texts; 0 where one is empty. The order of arguments matters."""
    return pd.Series(ratios(a.tolist(), b.tolist()), dtype=float)


def numbered(x: Column) -> Column:
    """The characters of x as numbers, each with the number of its occurrence: what two texts share is what both lists have."""
    chars = F.array_sort(F.filter(F.split(x, ""), lambda ch: ch != ""))
    return F.transform(chars, lambda ch, i: (F.ascii(ch) * 1024 + F.least(i - F.array_position(chars, ch) + 1, F.lit(1023))).cast("int"))


def similarity_bound(a: Column, b: Column, shared: Column | None = None) -> Column:
    """No ratio exceeds this: twice the shared characters over both lengths; `shared` if it is known."""
    if shared is None:
        shared = F.size(F.array_intersect(numbered(a), numbered(b)))
    # occurrences beyond the 1,023rd count as one, so very long texts have no bound below 1
    return F.when((a == "") | (b == ""), 0.0).when(F.greatest(F.length(a), F.length(b)) > 1023, 1.0).otherwise(2.0 * shared / (F.length(a) + F.length(b)))


def combined(sub: Column, dev: Column, sub_in: Column, dev_in: Column) -> Column:
    bonus = lambda s, inside: F.least(F.lit(1.0), s + F.when(inside, 0.15).otherwise(0.0))
    return 0.5 * bonus(sub, sub_in) + 0.5 * bonus(dev, dev_in)


def ranked_characters(names: DataFrame, name: str, often: DataFrame | None = None) -> DataFrame:
    """(name, own, token, place): the characters of distinct names, those that few names of `often` have first."""
    tokens = names.filter(F.col(name) != "").select(name).distinct().select(name, F.length(name).alias("own"), F.explode(numbered(F.col(name))).alias("token"))
    counts = (tokens if often is None else often).groupBy("token").agg(F.count("*").alias("often"))
    placed = tokens.join(F.broadcast(counts) if often is not None else counts, "token", "left")
    return placed.withColumn("place", F.row_number().over(Window.partitionBy(name).orderBy(F.coalesce("often", F.lit(0)), "token"))).drop("often")


def meeting_names(left: DataFrame, theirs: DataFrame, ratio: float) -> DataFrame:
    """(d, c): pairs of names, some of them repeated, among which are all whose similarity can reach `ratio` (over 0).

    left: d; theirs: the other names' `ranked_characters`. A ratio r of names with m and n characters needs
    ceil(r (m + n) / 2) shared ones, so both must have one of the same few characters that come first in any fixed order
    of all. Rare characters come first, and names meet on both lengths and such a character, so a key that many names
    share is only met where lengths leave nothing rarer.
    """
    c = theirs
    d = staged(ranked_characters(left, "d", c))
    lengths = {n: [r[0] for r in names.select("own").distinct().collect()] for n, names in (("c", d), ("d", c))}  # numbers up to the longest name

    def first_ones(placed: DataFrame, name: str) -> DataFrame:
        need = lambda n: F.ceil((F.col("own") + n) * ratio / 2 - 1e-9)
        others = F.filter(F.lit(lengths[name]).cast("array<int>"), lambda n: (need(n) <= F.least(F.col("own"), n)) & (F.col("place") <= F.col("own") - need(n) + 1))
        return placed.select(name, "token", "own", F.explode(others).alias("other"))

    asked = first_ones(d, "d")
    return checked_broadcast(asked).join(first_ones(c, "c").select("c", "token", F.col("own").alias("other"), F.col("other").alias("own")), ["token", "own", "other"]).select("d", "c")


def similar_names(left: DataFrame, right: DataFrame, ratio: float) -> DataFrame:
    """(d, c): all pairs of distinct names whose similarity can reach `ratio` (over 0), by an equi-join."""
    met = meeting_names(left, staged(ranked_characters(right, "c")), ratio)
    return met.distinct().filter(similarity_bound(F.col("d"), F.col("c")) >= ratio - 1e-9)


#: A part of a score is looked at from the highest values down, in these steps: what is found ends the search of most records.
PARTS = (1.0, 0.95, 0.9, 0.85, 0.8, 0.7, 0.6, 0.5)
BONUS = 0.15
#: Records and rows that share an alike text meet in blocks of about so many.
RECORDS, CANDIDATES = 2_000, 4_000
#: Pairs whose bounds are worked out at once.
PAIRS = 250_000
#: So few pairs are looked at in one step.
FEW = 1_000_000
#: What differs from the other part's names: a record's text and the row's text that it is compared with.
SIDES = {"s": "p", "d": "c"}


def holds(x: Column, y: Column) -> Column:
    """Whether one of two texts contains the other."""
    return (x != "") & (y != "") & (x.contains(y) | y.contains(x))


def part(x: Column, y: Column) -> Column:
    """A text's part of a score: the ratio, and the bonus where one text contains the other."""
    return F.least(F.lit(1.0), similarity(x, y) + F.when(holds(x, y), BONUS).otherwise(0.0))


def most_of_each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(ch, most): how often each character is in one text at most."""
    most: Counter = Counter()
    for frame in batches:
        texts = frame.iloc[:, 0].drop_duplicates().tolist()
        for k in range(0, len(texts), 1_000):
            (x,), alphabet = coded(texts[k : k + 1_000])
            most |= Counter({chr(ch): int(v) for ch, v in zip(alphabet[1:], x.counts(len(alphabet)).max(1)[1:])})
    yield pd.DataFrame(list(most.items()), columns=["ch", "most"])


def highest_part(texts: DataFrame, name: str, rows: DataFrame, theirs: str) -> DataFrame:
    """(name, cap_name): no text of the rows gives a text a larger part of a score than its cap.

    Only characters that some row has can be shared, and lengths are those that rows have. An empty text has 0.
    """
    texts = texts.select(name).distinct()
    most = rows.select(theirs).mapInPandas(most_of_each, "ch string, most int").groupBy("ch").agg(F.max("most").alias("most"))
    known = most.select("ch", F.explode(F.sequence(F.lit(0), F.least(F.col("most") - 1, F.lit(1023)))).alias("k")).select((F.ascii("ch") * 1024 + F.col("k")).cast("int").alias("token")).distinct()
    held = texts.select(name, F.explode(numbered(F.col(name))).alias("token")).join(known, "token", "left_semi").groupBy(name).agg(F.count("*").alias("held"))
    lengths = [r[0] for r in rows.filter(F.col(theirs) != "").select(F.length(theirs)).distinct().collect()]  # numbers up to the longest text
    own, held_ = F.length(name), F.coalesce("held", F.lit(0))

    def at(n: Column) -> Column:
        inside = (n <= held_) | ((own == held_) & (own <= n))
        ratio = F.when(F.greatest(own, n) > 1023, 1.0).otherwise(2.0 * F.least(held_, n) / (own + n))
        return F.least(F.lit(1.0), ratio + F.when(inside, BONUS).otherwise(0.0))

    parts = F.array_max(F.transform(F.lit(lengths).cast("array<int>"), at))
    return texts.join(held, name, "left").select(name, F.when(own == 0, 0.0).otherwise(F.coalesce(parts, F.lit(0.0))).alias(f"cap_{name}"))


def subsequences(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of many pairs, of places as `matchings` has them."""
    whole = (ONE << n.astype(np.uint64)) - ONE
    left = whole.copy()
    for here in at:
        met = left & here
        left = (left + met) | (left - met)
    return n - np.bitwise_count(left & whole).astype(np.int64)


def best_of_block(records: pd.DataFrame, cands: pd.DataFrame) -> pd.DataFrame:
    """(text, score, row_idx): for each record of one text its best candidate, if that reaches what it has.

    records: text, best; cands: row_idx, value (the part that is known), other. A ratio is worked out only where what two
    texts share at most, by characters and then by their order, can still give the best score: the most promising
    candidate of each record first, then twice as many in each round.
    """
    out: list[tuple] = []
    texts, others, values, idx = records["text"].tolist(), cands["other"].tolist(), cands["value"].to_numpy(float), cands["row_idx"].to_numpy()
    step = max(1, PAIRS // max(len(others), 1))
    if not texts or not others:
        return pd.DataFrame(out, columns=["text", "score", "row_idx"])
    (x, y), alphabet = coded(texts, others)
    small = np.uint8 if max(x.n.max(), y.n.max()) < 256 else np.int32
    held, theirs = (v.counts(len(alphabet)).astype(small) for v in (x, y))
    common = [ch for ch in range(1, len(alphabet)) if held[ch].any() and theirs[ch].any()]
    short = y.n <= BITS
    bits, codes = places(y.padded(BITS), len(alphabet)), x.padded(LONGEST)
    order = np.empty(len(idx), np.int64)
    order[np.argsort(idx, kind="stable")] = np.arange(len(idx))

    def bound(m: np.ndarray, n: np.ndarray, value: np.ndarray, shared: np.ndarray) -> np.ndarray:
        inside = np.where((shared >= np.minimum(m, n)) & (shared > 0), BONUS, 0.0)
        return 0.5 * value + 0.5 * np.minimum(1.0, 2.0 * shared / np.maximum(m + n, 1) + inside)

    for begin in range(0, len(texts), step):
        some = slice(begin, begin + step)
        m, best = x.n[some], records["best"].to_numpy(float)[some].copy()
        row = np.full(len(m), -1)
        shared = np.zeros((len(m), len(others)), small)
        for ch in common:
            if held[ch, some].any():
                shared += np.minimum(held[ch, some][:, None], theirs[ch])
        most = bound(m[:, None], y.n, values, shared)

        def places_of(a: np.ndarray, b: np.ndarray, m: np.ndarray = m, begin: int = begin) -> np.ndarray:
            return bits[b, codes[begin + a, : int(m[a].max(initial=1))].T]

        def promising(a: np.ndarray, b: np.ndarray, high: np.ndarray, best: np.ndarray = best, row: np.ndarray = row) -> np.ndarray:
            return (high > best[a]) | ((high == best[a]) & ((row[a] < 0) | (order[b] < order[row[a]])))

        def settle(a: np.ndarray, b: np.ndarray, m: np.ndarray = m, begin: int = begin, best: np.ndarray = best, row: np.ndarray = row) -> None:
            """Works out scores of pairs; records keep the best."""
            part, quick = np.zeros(len(a)), short[b] & (m[a] <= LONGEST)
            for k in range(0, len(a), BATCH):
                which = k + np.flatnonzero(quick[k : k + BATCH])
                i, j = a[which], b[which]
                part[which] = 2.0 * matchings(places_of(i, j), m[i], y.n[j]) / np.maximum(m[i] + y.n[j], 1)
            for k in np.flatnonzero(~quick):
                part[k] = ratio(texts[begin + a[k]], others[b[k]])
            for k in np.flatnonzero((part > 0) & (part * (m[a] + y.n[b]) >= 2 * np.minimum(m[a], y.n[b]) - 0.5) | ~quick):
                one, other = texts[begin + a[k]], others[b[k]]
                part[k] += BONUS if one and other and (one in other or other in one) else 0.0
            score = 0.5 * values[b] + 0.5 * np.minimum(1.0, part)
            at = np.lexsort((order[b], -score, a))
            at = at[np.flatnonzero(np.diff(a[at], prepend=-1))]
            at = at[promising(a[at], b[at], score[at])]
            best[a[at]], row[a[at]] = score[at], b[at]

        first = most.argmax(1)
        a = np.flatnonzero(most[np.arange(len(m)), first] >= best)
        settle(a, first[a])
        most[np.arange(len(m)), first] = -1.0
        a, b = np.divmod(np.flatnonzero(most >= best[:, None]), len(others))
        high = most[a, b]
        for k in range(0, len(a), BATCH):
            which = k + np.flatnonzero(short[b[k : k + BATCH]] & (m[a[k : k + BATCH]] <= LONGEST))
            i, j = a[which], b[which]
            high[which] = bound(m[i], y.n[j], values[j], subsequences(places_of(i, j), y.n[j]))
        keep = promising(a, b, high)
        a, b, high = a[keep], b[keep], high[keep]
        at = np.lexsort((order[b], -high, a))
        a, b, high = a[at], b[at], high[at]
        many = 1
        while True:
            keep = promising(a, b, high)
            a, b, high = a[keep], b[keep], high[keep]
            if not len(a):
                break
            begun = np.flatnonzero(np.diff(a, prepend=-1))
            now = np.arange(len(a)) - np.repeat(begun, np.diff(begun, append=len(a))) < many
            settle(a[now], b[now])
            a, b, high, many = a[~now], b[~now], high[~now], 2 * many
        out += [(texts[begin + k], best[k], idx[row[k]]) for k in np.flatnonzero(row >= 0)]
    return pd.DataFrame(out, columns=["text", "score", "row_idx"])


def best_through(name: str, open_: DataFrame, rows: DataFrame, ranked: dict[str, DataFrame], least: float, below: float) -> DataFrame | None:
    """(s, d, best_): the best rows of records among those that give their text `name` a part from `least` to `below`.

    ranked: the characters of the rows' texts, made once for each name that is asked for.

    A record takes part if such a row can reach what it has (`best`): one part of a score reaches the score, and what it
    lacks of twice the score the other part must be able to give. None if no record does. Alike texts are found by an
    equi-join; their records and rows meet in blocks, of which each row of a block's result is one record.
    """
    theirs, (other, their_other) = SIDES[name], next(x for x in SIDES.items() if x[0] != name)
    need = F.greatest(F.col("best"), 2 * F.col("best") - F.col(f"cap_{other}")) - 1e-9
    asked = open_.filter((F.col(f"cap_{name}") >= least - 1e-9) & (F.least(F.col(f"cap_{name}"), F.lit(below)) >= need)).withColumn("need", need)
    if asked.isEmpty():
        return None
    if name not in ranked:
        ranked[name] = staged(ranked_characters(rows.select(F.col(theirs).alias("c")), "c"))
    x, y = F.col("d"), F.col("c")
    # by their lengths alone, most pairs that don't hold each other can't have such a part
    reach = 2.0 * F.least(F.length(x), F.length(y)) / (F.length(x) + F.length(y)) + F.when(holds(x, y), BONUS).otherwise(0.0)
    pairs = meeting_names(asked.select(F.col(name).alias("d")), ranked[name], max(least - BONUS, 0.0)).filter(F.least(F.lit(1.0), reach) >= least - 1e-9).distinct()
    made = staged(pairs.select(F.col("d").alias(name), F.col("c").alias(theirs), part(F.col("d"), F.col("c")).alias("value")).filter((F.col("value") >= least) & (F.col("value") < below)))
    asked = asked.join(made.groupBy(name).agg(F.max("value").alias("most")), name).filter("most >= need")
    needed = asked.groupBy(name).agg(F.count("*").alias("n"), F.min("need").alias("least_need"))
    found = made.join(needed, name).filter("value >= least_need").join(rows, theirs).select(name, "row_idx", "value", F.col(their_other).alias("other"))
    cands, asked = staged(found), staged(asked.select(name, F.col(other).alias("text"), "best"))
    counted = cands.groupBy(name).agg(F.count("*").alias("m")).join(asked.groupBy(name).agg(F.count("*").alias("n")), name)
    sizes = staged(counted.select(name, F.ceil(F.col("n") / RECORDS).cast("int").alias("of_i"), F.ceil(F.col("m") / CANDIDATES).cast("int").alias("of_j")))
    block = lambda key, of: F.pmod(F.xxhash64(key), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    a = asked.join(sizes, name).select("*", block("text", "of_i").alias("i")).select(name, "text", "best", "i", every("of_j").alias("j"))
    b = cands.join(sizes, name).select("*", block("row_idx", "of_j").alias("j")).select(name, "row_idx", "value", "other", "j", every("of_i").alias("i"))

    def meet(key: tuple, records: pd.DataFrame, cands: pd.DataFrame) -> pd.DataFrame:
        return best_of_block(records, cands).assign(key=key[0])[["key", "text", "score", "row_idx"]]

    schema = f"key string, text string, score double, row_idx {rows.schema['row_idx'].dataType.simpleString()}"
    # blocks are small and cost much, so they are not put together by their size
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    a, b = (x.repartition(n, name, "i", "j") for x in (a, b))
    met = a.groupBy(name, "i", "j").cogroup(b.groupBy(name, "i", "j")).applyInPandas(meet, schema)
    return met.groupBy("key", "text").agg(F.min(F.struct((-F.col("score")).alias("minus"), "row_idx")).alias("best_")).select(F.col("key").alias(name), F.col("text").alias(other), "best_")


def plain_text(x: str) -> Column:
    """The normalised text of a column; it is rewritten only where there is something to squeeze."""
    c = F.col(x)
    return F.lower(F.when(c.rlike(r"[^\S ]|  "), T.squeeze(c)).otherwise(F.trim(F.coalesce(c, F.lit("")))))


def score_of(s: str, p: str, d: str, c: str) -> Column:
    """The score of normalised texts: of a record (s, d) and of a row (p, c)."""
    return 0.5 * part(F.col(s), F.col(p)) + 0.5 * part(F.col(d), F.col(c))


def best_match(left: DataFrame, rows: DataFrame, hits: DataFrame, threshold: float = 0.45) -> DataFrame:
    """(left_id, row_idx, id_hits, score): most identifier hits, then the higher score, then the first row.

    left: left_id, substation, developer; rows: row_idx, pooling_station, connectivity_applicant; hits: left_id, row_idx,
    id_hits. Records without a hit take their best row by text.
    """
    a = left.select("left_id", plain_text("substation").alias("s"), plain_text("developer").alias("d"))
    b = rows.select("row_idx", plain_text("pooling_station").alias("p"), plain_text("connectivity_applicant").alias("c"))
    hits = staged(hits)
    hit = hits.join(b, "row_idx").join(a, "left_id").select("left_id", "row_idx", "id_hits", score_of("s", "p", "d", "c").alias("score"))
    rank = F.row_number().over(Window.partitionBy("left_id").orderBy(F.desc("id_hits"), F.desc("score"), "row_idx"))
    hit = hit.withColumn("rank_", rank).filter("rank_ = 1").drop("rank_")

    other = staged(a.join(hits.select("left_id").distinct(), "left_id", "left_anti"))
    fuzzy = other.join(best_by_text(other, b, threshold), ["s", "d"]).select("left_id", "row_idx", F.lit(0).cast("long").alias("id_hits"), "score")
    return hit.unionByName(fuzzy)


def best_by_text(records: DataFrame, rows: DataFrame, threshold: float = 0.45) -> DataFrame:
    """(s, d, row_idx, score): for distinct texts of records the row of the highest score from the threshold on, the first of these.

    records: s, d; rows: p, c, row_idx, all normalised. Records meet rows whose one text is alike enough, from the most
    alike down, until nothing that is left can give them a better score. Equal records are looked at once, as are equal
    rows, of which the first counts.
    """
    b = staged(rows.groupBy("p", "c").agg(F.min("row_idx").alias("row_idx")))
    open_ = staged(records.select("s", "d").distinct())
    for name, theirs in SIDES.items():
        open_ = open_.join(highest_part(open_, name, b, theirs), name)
    none = F.lit(None).cast(f"struct<minus:double,row_idx:{b.schema['row_idx'].dataType.simpleString()}>")
    open_ = staged(open_.withColumns({"best_": none, "best": F.lit(float(threshold))}))
    steps = [*([x for x in PARTS if x > threshold] if open_.count() * b.count() > FEW else []), threshold]
    ranked: dict[str, DataFrame] = {}
    for least, below in zip(steps, [2.0, *steps]):
        for name in SIDES:
            found = best_through(name, open_, b, ranked, least, below)
            if found is not None:
                better = open_.join(found.withColumnRenamed("best_", "new_"), ["s", "d"], "left").withColumn("best_", F.array_min(F.array("best_", "new_"))).drop("new_")
                open_ = staged(better.withColumn("best", F.coalesce(-F.col("best_.minus"), F.col("best"))))
    return open_.filter("best_ is not null").select("s", "d", F.col("best_.row_idx").alias("row_idx"), F.col("best").alias("score"))


def best_of_one_id(left: DataFrame, rows: DataFrame, values: list[str], key: str = "application_id", threshold: float = 0.45) -> DataFrame:
    """Distinct records of left (substation, developer, `key`) with id_hits, score and the columns of their best row; nulls where there is none.

    A record has one identifier or none. Of the rows (row_idx, pooling_station, connectivity_applicant and others) with it
    in one of `values` the one of the highest score is the best, then the first; a record without such a row takes its best
    row by text. Records meet the rows of their identifier in one join that also drops repeated records; only where
    several rows have it they are ranked.
    """
    own, theirs = left.columns, rows.columns
    named = left.filter(F.col(key) != "")
    ids = staged(named.select(key).distinct().withColumn("needle", T.normalize_id(F.col(key))))
    pairs = id_rows(ids.filter(F.length("needle") >= 3).select("needle").distinct(), rows, values)
    found = staged(pairs.join(ids, "needle").drop("needle").join(rows, "row_idx").withColumn("n_", F.count("*").over(Window.partitionBy(key))))
    missing = staged(ids.select(key).join(found.select(key).distinct(), key, "left_anti"))
    texts = lambda df: df.select("*", plain_text("substation").alias("s"), plain_text("developer").alias("d"))

    def scored(records: DataFrame, found: DataFrame) -> DataFrame:
        both = texts(records.join(found, key)).select("*", plain_text("pooling_station").alias("p"), plain_text("connectivity_applicant").alias("c"))
        return both.select(*own, *theirs, "n_", F.lit(1).cast("long").alias("id_hits"), score_of("s", "p", "d", "c").alias("score"))

    def best(scored: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*own).orderBy(F.desc("score"), "row_idx"))
        return scored.withColumn("rank_", rank).filter("rank_ = 1").drop("rank_")

    # partitions by the identifier serve the distinct records and their join
    records, several = named.repartition(key).distinct(), found.filter("n_ > 1")
    if several.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        few = named.join(F.broadcast(several.select(key).distinct()), key, "left_semi").distinct()
        hit = scored(records, found.filter("n_ = 1")).unionByName(best(scored(few, F.broadcast(several))))
    else:
        hit = best(scored(records, found))
    none = left.filter(F.coalesce(F.col(key), F.lit("")) == "").unionByName(named.join(checked_broadcast(missing), key, "left_semi").select(*own))
    other = staged(texts(none.distinct()))
    b = rows.select("row_idx", plain_text("pooling_station").alias("p"), plain_text("connectivity_applicant").alias("c"))
    by_text = best_by_text(other, b, threshold).withColumn("id_hits", F.lit(0).cast("long"))
    fuzzy = other.join(by_text, ["s", "d"], "left").join(rows, "row_idx", "left").select(*own, *theirs, "id_hits", "score")
    return hit.drop("n_").unionByName(fuzzy)


def id_rows(needles: DataFrame, rows: DataFrame, values: list[str]) -> DataFrame:
    """(needle, row_idx): the rows that have a normalised identifier in any of `values`."""
    hay = rows.select("row_idx", F.explode(F.array_distinct(F.array(*[T.normalize_id(F.col(v)) for v in values]))).alias("hay"))
    return substring_join(needles, hay, "needle", "hay").select("needle", "row_idx").distinct()


def id_hits(left: DataFrame, rows: DataFrame, values: list[str]) -> DataFrame:
    """(left_id, row_idx, id_hits): how many distinct identifiers of a record occur in any value of a row."""
    needles = staged(left.select("left_id", F.explode(F.array_distinct(F.transform("ids", T.normalize_id))).alias("needle")).filter(F.length("needle") >= 3))
    pairs = id_rows(needles.select("needle").distinct(), rows, values)
    return needles.join(pairs, "needle").groupBy("left_id", "row_idx").agg(F.count("*").alias("id_hits"))


def names_match(name: Column, entity: Column) -> Column:
    """Whether either name contains the other, as they are or without parentheses; entity is one entity."""
    a, b = T.name_key(name), T.name_key(entity)
    x, y = T.name_key(T.without_parentheses(name)), T.name_key(T.without_parentheses(entity))
    whole = (a != "") & (b != "") & (a.contains(b) | b.contains(a))
    return whole | ((a != "") & (b != "") & (x != "") & (y != "") & (x.contains(y) | y.contains(x)))


def name_join(left: DataFrame, entries: DataFrame, blocked: bool = True, k: int = 5) -> DataFrame:
    """left rows (row_id, developer, voltage_key) with the entries of the same voltage whose name fits one of theirs.

    Blocked, the shorter name of a pair meets the longer one on its rarest run of k characters, or as a whole if it is
    shorter: both directions of containment are equi-joins, and a beginning that many names share is no key.
    """
    ents = entries.withColumn("entity", F.explode(F.filter(F.transform(F.split("entity_name", ";"), lambda x: F.trim(x)), lambda x: x != "")))
    if not blocked:
        pairs = left.join(checked_broadcast(ents), ["voltage_key"]).filter(names_match(F.col("developer"), F.col("entity")))
        return pairs.drop("entity").distinct()
    key = lambda c: F.array_distinct(F.filter(F.array(T.name_key(c), T.name_key(T.without_parentheses(c))), lambda x: x != ""))
    # written once, for both directions and for the checks of their sizes
    names = staged(left.select("voltage_key", "developer").distinct().withColumn("n", F.explode(key(F.col("developer")))))
    whole = staged(ents.select("voltage_key", "entity").distinct().withColumn("e", F.explode(key(F.col("entity")))))
    sides = []
    for needle, hay, n, h in ((names, whole, "n", "e"), (whole, names, "e", "n")):
        short, gram = F.length(n) < k, ["voltage_key", "g"]
        lengths = needle.filter(short).select(F.length(n).alias("l_")).distinct()
        runs = hay.filter(F.length(h) >= k).withColumn("g", F.explode(grams(F.col(h), k)))
        own = needle.filter(~short).select("voltage_key", n).distinct()
        asked = own.select("voltage_key", n, F.explode(grams(F.col(n), k)).alias("g"))
        if own.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:  # only runs that are asked for are counted
            runs = runs.join(checked_broadcast(staged(asked.select(*gram).distinct())), gram, "left_semi")
        often = checked_broadcast(staged(runs.groupBy(*gram).agg(F.count("*").alias("often_"))))
        # a name with a run that no longer name has is in none of them
        rarest = asked.join(often, gram, "left").groupBy("voltage_key", n).agg(F.min_by("g", F.struct("often_", "g")).alias("g"), F.bool_and(F.col("often_").isNotNull()).alias("all_")).filter("all_").drop("all_")
        begun = checked_broadcast(staged(needle.join(checked_broadcast(staged(rarest)), ["voltage_key", n])))
        long_ = begun.join(runs, gram).filter(F.col(h).contains(F.col(n)))
        parts = hay.join(F.broadcast(lengths), F.length(h) >= F.col("l_")).withColumn("g", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(h) - F.col("l_") + 1), lambda i: F.substring(h, i, F.col("l_"))))))
        few = needle.filter(short).withColumn("g", F.col(n)).join(parts, gram)
        sides += [x.select("voltage_key", "developer", "entity") for x in (long_, few)]
    pairs = reduce(DataFrame.unionByName, sides).distinct().filter(names_match(F.col("developer"), F.col("entity")))
    return left.join(pairs, ["voltage_key", "developer"]).join(ents, ["voltage_key", "entity"]).drop("entity").distinct()


def pending(files: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return files.join(done, key, "left_anti")


def completed(files: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    return files.join(cache, key, "left_semi")


def insert_or_ignore(ledger: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """ledger plus the first new row of each key that it does not have."""
    first = new.withColumn("rank_", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("rank_ = 1").drop("rank_")
    return ledger.unionByName(first.join(ledger.select(*key), key, "left_anti"), allowMissingColumns=True)


def listing_diff(listing: DataFrame, inventory: DataFrame, key: list[str], position: str, held: str) -> DataFrame:
    """Full outer diff: keep (same place), shift (renumber), new (fetch), stale (no longer listed)."""
    a, b = listing.withColumn("l_", F.lit(True)), inventory.withColumn("i_", F.lit(True))
    action = F.when(F.col("l_").isNull(), "stale").when(F.col("i_").isNull(), "new").when(F.col(position) == F.col(held), "keep").otherwise("shift")
    return a.join(b, key, "full_outer").withColumn("action", action).drop("l_", "i_")


def dimension(left: DataFrame, mapping: dict[str, str], column: str, keep_unknown: bool) -> DataFrame:
    """left with `column` replaced by its mapped value; unknown values stay or their rows go."""
    mapped = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[F.col(column)]
    out = left.withColumn(column, F.coalesce(mapped, F.col(column)) if keep_unknown else mapped)
    return out if keep_unknown else out.filter(F.col(column).isNotNull())


def find_column(df: DataFrame, *candidates: str) -> str | None:
    """The first candidate that df has, whatever its case, as df spells it."""
    held = {c.lower(): c for c in reversed(df.columns)}
    return next((held[c.lower()] for c in candidates if c.lower() in held), None)


def first_value(df: DataFrame, *candidates: str) -> Column:
    """Per row the first non-empty value of the candidates that df has, whatever their case; else ''."""
    found = [x for x in (find_column(df, c) for c in candidates) if x]
    return F.coalesce(*[F.nullif(F.trim(F.col(x)), F.lit("")) for x in found], F.lit(""))


def any_of(conditions: list[Column]) -> Column:
    return reduce(operator.or_, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(operator.and_, conditions)
