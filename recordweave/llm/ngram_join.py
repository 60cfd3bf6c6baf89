"""N-gram Jaccard self-join by filtering under several global token orders, with connected groups of documents.

A document's set holds its distinct 5-word shingles as 64-bit hashes; equal sets become one class, so copies cost
nothing. Two sets with a similarity of 0.75 or more share a token among the first n - ceil(0.75 n) + 1 of either,
whatever order the tokens are put in, as long as it is one order for all. The steps:

1. One pass counts tokens: windows of the input report those that they hold more than once. The HEAVY_KEPT most
   frequent ones go last in every order, rarest first; that only makes prefixes selective, any order is correct.
2. Under the first order every set's prefix is dealt by token (heavy tokens salted) and met sets are kept.
3. Families: each set is paired with the neighbour that it shares most prefix tokens with, then with the most
   central set of its crowded tokens; links make components.
4. The rest: pairs of sets in different components that share a prefix token and pass the size and position bounds,
   likely ones first, so that families are joined before their pairs are listed.

Pairs of both steps must share prefix tokens under every further order too; what is left is verified on whole sets.
Sets are told apart by 64-bit hashes.

Pairs within a component are never listed, and no pair of different components that could link is left out. Texts
without words have an empty set and link with nothing; fewer than five words make one shingle. Null doc_ids and
repeated rows are documents like any other (a null id stays null and is no component's name unless nothing else is).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordweave.llm.common import components, shuffle_width, stage, table, trim, unused

WIDTH = 5
#: Similarity as a fraction: 100 * both >= 75 * any.
NUM, DEN = 75, 100
#: Tokens per counting window, tokens kept as heavy (the bound of what is sent to tasks), least count of a heavy one.
WINDOW_TOKENS = 1 << 22
HEAVY_KEPT = 1 << 17
HEAVY_LEAST = 6
#: A token in more sets than this (by the counts of step 1) is dealt to several tasks.
SALT_ROWS = 4000
#: Multipliers of the further global orders.
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
BROADCAST_KEYS = 2_000_000
TRIES = 4
#: Groups of at most so many sets are compared row by row; sets of larger ones are crowded.
SMALL_GROUP = 32


_RANDOM = np.random.default_rng(20240301)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_PLACE = _RANDOM.integers(1, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = 0x9FB21C651E98DF25
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of them."""
    if len(_POWERS[0]) < n:
        n = 1 << int(n).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS


def mixed(h: np.ndarray, multiplier: int = 0xBF58476D1CE4E5B9) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(multiplier)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Distinct shingle hashes of a whole text, ascending. A word's hash is a polynomial over random values of its bytes."""
    if not text:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.zeros(len(raw) + 2, bool)
    np.logical_not(_WHITE[raw], out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edge[::2], edge[1::2]
    if not len(first):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power[: len(raw)], out=sums[1:])
    word = mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
    run = min(WIDTH, len(word))
    n = len(word) - run + 1
    out = mixed(sum(word[k : k + n] * _PLACE[k] for k in range(run)))
    out.sort()
    return out[np.r_[True, out[1:] != out[:-1]]]


def set_id(tokens: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes()))))


def prefix_length(n: int) -> int:
    return n - -(-NUM * n // DEN) + 1


def ordered(tokens: np.ndarray, heavy: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The prefix of a set under the first global order (heavy tokens last, rarest first), and its tokens' counts."""
    most = prefix_length(len(tokens))
    c = np.zeros(len(tokens), np.int64)
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)
        c = np.where(heavy[at] == tokens, count[at], 0)
    light = np.flatnonzero(c == 0)[:most]
    if len(light) == most:
        return tokens[light], c[light]
    first = np.lexsort((tokens, c))[:most]
    return tokens[first], c[first]


def further_prefix(tokens: np.ndarray, multiplier: int) -> np.ndarray:
    """The prefix of a set under a further global order, that of another hash; ascending places in that order."""
    n = prefix_length(len(tokens))
    return np.sort(np.partition(mixed(tokens, multiplier), n - 1)[:n])


def meet_in_all(a: list[np.ndarray], b: list[np.ndarray]) -> bool:
    """Whether two sets share prefix tokens under every further order."""
    for x, y in zip(a, b):
        at = np.searchsorted(x, y)
        if not (x[np.minimum(at, len(x) - 1)] == y).any():
            return False
    return True


def survey(docs: DataFrame) -> DataFrame:
    """One pass: rows of kind 0 describe documents (doc_id, n, set, key), rows of kind 1 frequent tokens (set, n)."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, seen = [], 0, set()

        def report() -> pd.DataFrame:
            nonlocal size
            token, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, int))
            held.clear(), seen.clear()
            size = 0
            return pd.DataFrame({"kind": 1, "doc_id": pd.array([None] * int((n > 1).sum()), "Int64"), "n": n[n > 1], "set": token[n > 1].view(np.int64), "key": 0})

        for b in batches:
            ids, ns, sets = b.doc_id.astype("Int64"), [], []
            for text in b.text:
                t = shingles(text)
                s = set_id(t)
                ns.append(len(t)), sets.append(s)
                if s not in seen:
                    seen.add(s), held.append(t)
                    size += len(t)
                if size >= WINDOW_TOKENS:
                    yield report()
            yield pd.DataFrame({"kind": 0, "doc_id": ids, "n": ns, "set": sets, "key": b.key})
        yield report()
        trim()

    return docs.select("doc_id", "text", F.xxhash64("text").alias("key")).mapInPandas(scan, "kind int, doc_id long, n long, set long, key long")


def heavy_tokens(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens, ascending, and their counts; at most HEAVY_KEPT."""
    top = found.filter("kind = 1").groupBy("set").agg(F.sum("n").alias("n")).filter(F.col("n") >= HEAVY_LEAST).orderBy(F.desc("n"), "set").limit(HEAVY_KEPT).toPandas()
    token, order = top.set.to_numpy(np.int64).view(np.uint64), None
    order = np.argsort(token)
    return token[order], top.n.to_numpy(np.int64)[order]


def _partners(rows: np.ndarray) -> pd.DataFrame:
    """Rows (token, parts and salt, set, n and pos), sorted, that may have a partner in their token's group.

    A partner is another set that passes the size and position bounds. Of a small group the first partner is named as
    hub; of a large one or one part of a salted token all rows stay and the first row is the hub.
    """
    if len(rows):
        rows = rows[np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(1)]]
    token, set_, n, pos = rows[:, 0], rows[:, 2], rows[:, 3] >> 32, rows[:, 3] & 0xFFFFFFFF
    new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)] if len(rows) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    start = np.flatnonzero(new)
    size = np.diff(np.r_[start, len(rows)])[group] if len(rows) else np.zeros(0, int)
    place = np.arange(len(rows)) - (start[group] if len(rows) else 0)
    keep, hub = np.zeros(len(rows), bool), np.full(len(rows), -1)
    for step in range(1, int(min(size.max(initial=1), SMALL_GROUP))):
        j = np.flatnonzero((place >= step) & (size <= SMALL_GROUP))
        i = j - step
        sizes_ok = DEN * np.minimum(n[i], n[j]) >= NUM * np.maximum(n[i], n[j])
        ok = sizes_ok & ((NUM + DEN) * np.minimum(n[i] - pos[i], n[j] - pos[j]) >= NUM * (n[i] + n[j]))
        keep[i[ok]] = keep[j[ok]] = True
        hub[j[ok]] = i[ok]
    crowd = (size > SMALL_GROUP) | (rows[:, 1] >> 32 > 1)
    keep |= crowd
    hub = np.where(crowd & (place > 0), np.arange(len(rows)) - place, hub)
    out = pd.DataFrame({"token": token[keep], "set": set_[keep], "n": n[keep], "pos": pos[keep], "crowd": crowd[keep]})
    out["hub"] = pd.array(np.where(hub[keep] >= 0, set_[hub[keep]], 0), "Int64")
    out.loc[hub[keep] < 0, "hub"] = pd.NA
    return out


def meetings(docs: DataFrame, heavy: np.ndarray, count: np.ndarray) -> DataFrame:
    """(token, set, n, pos, crowd, hub): prefix rows under the first order that may have a partner with the same token."""
    sent = docs.sparkSession.sparkContext.broadcast((heavy, count))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heavy, count = sent.value
        seen: set[int] = set()
        for b in batches:
            rows = []
            for text in b.text:
                t = shingles(text)
                s = set_id(t)
                if not len(t) or s in seen:
                    continue
                seen.add(s)
                p, c = ordered(t, heavy, count)
                parts = c // SALT_ROWS + 1
                rows.append((p.view(np.int64), np.full(len(p), s), (len(t) << 32) + np.arange(len(p)), (parts << 32) + s % parts))
                if len(rows) >= 500:
                    yield pd.DataFrame(dict(zip(("token", "set", "n_pos", "deal"), map(np.concatenate, zip(*rows)))))
                    rows = []
            if rows:
                yield pd.DataFrame(dict(zip(("token", "set", "n_pos", "deal"), map(np.concatenate, zip(*rows)))))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = np.zeros((0, 4), np.int64)
        for b in batches:
            rows = np.vstack([rest, b[["token", "deal", "set", "n_pos"]].to_numpy(np.int64)])
            if not len(rows):
                continue
            open_ = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(1))
            cut = open_[-1] + 1 if len(open_) else 0
            rest = rows[cut:]
            yield _partners(rows[:cut])
        yield _partners(rest)
        trim()

    rows = docs.select("text").mapInPandas(emit, "token long, set long, n_pos long, deal long")
    dealt = rows.repartition(shuffle_width(docs.sparkSession), "token", "deal").sortWithinPartitions("token", "deal", "set")
    return dealt.mapInPandas(meet, "token long, set long, n long, pos long, crowd boolean, hub long")


def texts_of(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(set, text) of the given sets (set, key): one document is read for each."""
    keys = sets.select("set", "key")
    rows = docs.select("text", F.xxhash64("text").alias("key"))
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return rows.join(keys, "key").groupBy("set").agg(F.min("text").alias("text"))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets whose similarity reaches the bound, by their whole texts.

    The pairs share a prefix token under the first order; those that share none under a further one go uncompared.
    """
    pairs = stage(pairs.select("a", "b"), "ngram-tries")
    need = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    if pairs.count() <= BROADCAST_KEYS // 2:
        texts = texts.join(F.broadcast(need), "set", "left_semi")
    a = texts.select(F.col("set").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("set").alias("b"), F.col("text").alias("tb"))

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, mine, filters = None, None, None
        orders = lambda t: [further_prefix(t, m) for m in ORDERS]
        for x in batches:
            ok = []
            for hub, ta, tb in zip(x.b, x.ta, x.tb):
                if last != hub:
                    last, mine = hub, shingles(tb)
                    filters = orders(mine)
                other = shingles(ta)
                if not meet_in_all(filters, orders(other)):
                    ok.append(False)
                    continue
                both = len(np.intersect1d(mine, other, assume_unique=True))
                ok.append(DEN * both >= NUM * (len(mine) + len(other) - both))
            yield x.loc[ok, ["a", "b"]]

    return pairs.select("a", "b").join(a, "a").join(b, "b").mapInPandas(exact, "a long, b long")


def _merge(links: DataFrame, more: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    links = stage(links if more is None else more.union(links), "ngram-links")
    return links, stage(components(links).withColumnRenamed("node", "set"), "ngram-components")


def further_prefixes(texts: DataFrame) -> DataFrame:
    """(set, p0, p1, ..): prefixes under the further orders, as 32-bit halves of the hashes: a filter may let more pass."""
    names = [f"p{k}" for k in range(len(ORDERS))]

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            t = [shingles(x) for x in b.text]
            yield pd.DataFrame({"set": b.set, **{name: [(further_prefix(x, m) >> np.uint64(32)).astype(np.uint32).view(np.int32) for x in t] for name, m in zip(names, ORDERS)}})

    return texts.mapInPandas(emit, "set long, " + ", ".join(f"{n} array<int>" for n in names))


def _best(rows: DataFrame) -> DataFrame:
    """(a, b): for each set the hub it meets most often, if that is often enough to be likely."""
    met = rows.filter("set != hub").groupBy("set", "hub").agg(F.count("*").alias("c"), F.first("n").alias("n")).filter(F.col("c") >= F.least(F.lit(2), 1 + F.col("n") / 20))
    return met.groupBy("set").agg(F.max_by("hub", F.struct("c", "hub")).alias("hub")).select(F.col("set").alias("a"), F.col("hub").alias("b"))


def _open_rows(met: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows of tokens that still stand in more than one component."""
    rows = met.select("token", "set", "n", "pos", "crowd", *(["most"] if "most" in met.columns else [])).join(comp, "set", "left").withColumn("component", F.coalesce("component", "set"))
    mixed_ = rows.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi").select("token")
    return rows.join(mixed_, "token")


def _possible(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Open rows with `most`, the most tokens that a crowded set can share with another crowded one (-1: not crowded).

    Of a crowded set only tokens that a second crowded set has can be shared. Sets that so fall short of every partner
    go from the crowded groups. Pairs in small groups need no such bound: a row of a small group keeps most = -1.
    """
    crowded = texts.join(rows.filter("crowd").select("set").distinct(), "set", "left_semi")

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in range(0, len(b), 200):
                t = [shingles(x) for x in b.text[part : part + 200]]
                yield pd.DataFrame({"set": np.repeat(b.set[part : part + 200].to_numpy(), [len(x) for x in t]), "token": np.concatenate(t).view(np.int64)})

    def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = np.zeros((0, 2), np.int64)
        for b in batches:
            both = np.vstack([rest, b[["token", "set"]].to_numpy(np.int64)])
            if len(both):
                cut = np.flatnonzero(np.r_[True, both[1:, 0] != both[:-1, 0]])[-1]
                rest = both[cut:]
                yield tally(both[:cut])
        yield tally(rest)

    def tally(both: np.ndarray) -> pd.DataFrame:
        again = both[1:, 0] == both[:-1, 0]
        set_, n = np.unique(both[np.r_[False, again] | np.r_[again, False], 1] if len(both) > 1 else both[:0, 1], return_counts=True)
        return pd.DataFrame({"set": set_, "n": n})

    tokens = crowded.mapInPandas(explode, "set long, token long").repartition(shuffle_width(rows.sparkSession), "token").sortWithinPartitions("token")
    most = stage(tokens.mapInPandas(shared, "set long, n long").groupBy("set").agg(F.sum("n").alias("most")), "ngram-most")
    small = rows.filter("not crowd").withColumn("most", F.lit(-1).cast("long"))
    return stage(small.unionByName(rows.filter("crowd").join(most, "set").filter(DEN * F.col("most") >= NUM * F.col("n"))), "ngram-possible")


def join_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, set, key) of every document, and (set, component) of the sets that link with another one."""
    docs = docs.select("doc_id", "text")
    found = stage(survey(docs), "ngram-survey")
    heavy, count = heavy_tokens(found)
    met = stage(meetings(docs, heavy, count), "ngram-meetings")

    keys = found.filter("kind = 0").groupBy("set").agg(F.min("key").alias("key"))
    texts = stage(texts_of(docs, keys.join(met.select("set").distinct(), "set")), "ngram-texts")
    # families: the neighbour that a set shares most prefix tokens with
    links, comp = _merge(verified(_best(met.filter("hub is not null").select("set", "hub", "n")), texts), None)
    rows = _possible(stage(_open_rows(met, comp), "ngram-open"), texts)
    # then the most central set of each crowded token, the one with the largest share of its tokens in other sets
    central = rows.filter("crowd").groupBy("token").agg(F.max_by("set", F.struct(F.col("most") / F.col("n"), "set")).alias("hub"))
    tries = _best(rows.filter("crowd").select("token", "set", "n").join(central, "token"))
    links, comp = _merge(verified(tries, texts), links)
    rows = stage(_open_rows(rows, comp), "ngram-open")
    one = rows.select("token", F.col("set").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("component").alias("ca"), F.col("most").alias("ma"))
    two = rows.select("token", F.col("set").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("component").alias("cb"), F.col("most").alias("mb"))
    size_ok = DEN * F.least("na", "nb") >= NUM * F.greatest("na", "nb")
    room = (NUM + DEN) * F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"), F.when(F.col("ma") >= 0, F.col("ma")).otherwise(F.col("na")), F.when(F.col("mb") >= 0, F.col("mb")).otherwise(F.col("nb"))) >= NUM * (F.col("na") + F.col("nb"))
    pairs = one.join(two, "token").filter((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & size_ok & room).groupBy("a", "b").agg(F.count("*").alias("c"))
    pairs = stage(pairs, "ngram-pairs")
    if not pairs.isEmpty():
        some = texts.join(pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct(), "set", "left_semi")
        more = stage(further_prefixes(some), "ngram-orders")
        side = lambda s: more.select(F.col("set").alias(s), *[F.col(f"p{k}").alias(f"{s}{k}") for k in range(len(ORDERS))])
        every = F.lit(True)
        for k in range(len(ORDERS)):
            every = every & F.arrays_overlap(f"a{k}", f"b{k}")
        pairs = stage(pairs.join(side("a"), "a").join(side("b"), "b").filter(every).select("a", "b", "c"), "ngram-pairs")
        left = pairs
        for limit in (TRIES, None):
            name = lambda s: comp.select(F.col("set").alias(s), F.col("component").alias(f"c{s}"))
            left = left.join(name("a"), "a", "left").join(name("b"), "b", "left").withColumns({"ca": F.coalesce("ca", "a"), "cb": F.coalesce("cb", "b")}).filter("ca != cb")
            left = stage(left, "ngram-left")
            if left.isEmpty():
                break
            couple = Window.partitionBy(F.least("ca", "cb"), F.greatest("ca", "cb")).orderBy(F.desc("c"), "a", "b")
            first = left.withColumn("try", F.row_number().over(couple)).filter(F.col("try") <= limit) if limit else left
            links, comp = _merge(verified(first, texts), links)
            left = left.select("a", "b", "c")
    return found.filter("kind = 0").select("doc_id", "n", "set", "key"), comp


def duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    rows, comp = join_classes(docs)
    rows = rows.join(comp, "set", "left").withColumn("component", F.when(F.col("n") > 0, F.coalesce("component", "set")))
    least = rows.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "component", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with one document of each connected group: the one with the smallest doc_id. All columns stay.

    Documents without words are in no group and stay. Rows that repeat both doc_id and text are one document.
    """
    rows, comp = join_classes(docs)
    rows = rows.join(comp, "set", "left").withColumn("component", F.coalesce("component", "set"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("key").alias("text"))
    rows = stage(rows.filter("n > 0").select("doc_id", "key", "component", rank.alias("rank")), "ngram-ranked")
    first = rows.groupBy("component").agg(F.min("rank").alias("first"))
    id_, key = unused(docs, "gone_id", "gone_key")
    gone = rows.join(first, "component").filter("rank != first").select(F.col("doc_id").alias(id_), F.col("key").alias(key)).distinct()
    gone = stage(gone, "ngram-gone")
    if gone.count() <= BROADCAST_KEYS:
        gone = F.broadcast(gone)
    left = docs.join(gone, F.col(id_).eqNullSafe(docs["doc_id"]) & (F.col(key) == F.xxhash64(docs["text"])), "left_anti")
    repeated = rows.groupBy("doc_id", "key").count().filter("count > 1")
    return left if repeated.isEmpty() else left.dropDuplicates(["doc_id", "text"])


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(table(spark, sf_dir, "documents"))
