"""Training-data operators against brute force, round trips, held-out accuracy and odd inputs."""

import hashlib
import base64
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("recordweave.llm")
from pyspark.sql import functions as F  # noqa: E402

from recordweave.llm import common, decontamination, embedding_dedup, filter_audit, html_extraction, lexical_search, lm_scoring, ngram_join, packing, quality, sentencepiece, toxicity, url_filters, warc  # noqa: E402

DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " ", "\n\t", "one", "Zwei\u00a0drei \u65e5\u672c\u8a9e \U0001f642", "a" * 5000, "word " * 3000, "x\u2581y", "  two  blanks "]


def docs_of(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids or range(len(texts)), texts)], DOC)


def words(rng, n, k=200):
    return " ".join(f"w{rng.randrange(k)}" for _ in range(n))


def union_find(n, pairs):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    want = union_find(131, pairs)
    got = dict(map(tuple, common.components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert all(got[x] == want[x] for p in pairs if p[0] != p[1] for x in p)


def test_parts_do_not_depend_on_how_files_are_split(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = random.Random(11)
    texts = [f"t{i} " + words(rng, 30, 500) for i in range(400)]
    pq.write_table(pa.table({"doc_id": pa.array(range(400), pa.int64()), "text": texts}), tmp_path / "documents.parquet", row_group_size=40)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    model = sentencepiece.Model.load()
    want = {r.doc_id: r.score for r in lm_scoring.score(docs_of(spark, texts)).collect()}
    try:
        for first, second in ((4_000, 10_000_000), (10_000_000, 4_000)):
            spark.conf.set(name, first)
            docs = common.table(spark, str(tmp_path), "documents")
            scored, ids = lm_scoring.score(docs), sentencepiece.encoded(docs, model)
            spark.conf.set(name, second)
            got = {r.doc_id: r.score for r in scored.collect()}
            assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)
            assert ids.filter("round_trip").count() == len(texts)
    finally:
        spark.conf.set(name, before)


def test_unknown_keys_are_errors():
    keys = np.array([5, 9])
    assert lm_scoring.find(keys, np.array([9, 5])).tolist() == [1, 0] and len(lm_scoring.find(keys[:0], keys[:0])) == 0
    for held, wanted in ((keys, [5, 6]), (keys, [10]), (keys[:0], [5])):
        with pytest.raises(LookupError):
            lm_scoring.find(held, np.array(wanted))


# --- 1 --------------------------------------------------------------------------------------------------------------
def test_sentencepiece_equals_library(spark):
    spm = pytest.importorskip("sentencepiece")
    lib = spm.SentencePieceProcessor(model_file=sentencepiece.MODEL)
    rng = random.Random(12)
    texts = [*ODD, "Hello, naïve wörld! 3.14\n\nfoo_bar", "trail ", "ABcdE" * 30, *["".join(rng.choice("aeinrstühl") for _ in range(n)) for n in range(57, 67)], "lines\n\n  of    blanks\t日本語\u0378x", "x" + " " * 40 + "y"]
    got = sentencepiece.encode(docs_of(spark, texts), sentencepiece.Model.load()).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.ids == (lib.encode(r.text) if r.text else [])
    back = {r.doc_id: r.decoded for r in sentencepiece.decode(sentencepiece.encode(docs_of(spark, texts), sentencepiece.Model.load()), sentencepiece.Model.load()).collect()}
    assert all(back[i] == (t or "").replace("\u2581", " ") for i, t in enumerate(texts))
    assert sentencepiece.encoded(docs_of(spark, []).limit(0)).count() == 0


def test_unigram_fold_equals_plain_viterbi(spark):
    """The same pieces read as a unigram model: the fold finds the best score over the whole text."""
    with open(sentencepiece.MODEL, "rb") as f:
        data = bytearray(f.read())
    data[data.index(bytes([3 << 3, sentencepiece.BPE, 4 << 3]), data.rindex(b"tok_v0")) + 1] = sentencepiece.UNIGRAM
    model = sentencepiece.Model(bytes(data))
    assert model.kind == sentencepiece.UNIGRAM
    score = {p: s for p, s, t in model.pieces if t == sentencepiece.NORMAL}
    for r in sentencepiece.encode(docs_of(spark, ["the quick brown fox", "unbelievable connectivity", "Grid substation"]), model).collect():
        text = (" " + r.text).replace(" ", sentencepiece.BLANK)
        best = [0.0] + [-1e18] * len(text)
        for k in range(1, len(text) + 1):
            best[k] = max(best[i] + score.get(text[i:k], -1e18) for i in range(max(0, k - model.longest), k))
        assert abs(sum(model.pieces[i][1] for i in r.ids) - best[-1]) < 1e-6 and "".join(model.pieces[i][0] for i in r.ids) == text


# --- 2 --------------------------------------------------------------------------------------------------------------
def plain_verdict(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.index(x) for x in "/?#" if x in rest], default=len(rest))
    host, path = "".join(ch.lower() if ch.isascii() else ch for ch in rest[:cut]), rest[cut:]
    path = path[: min([path.index(x) for x in "?#" if x in path], default=len(path))]
    fits = [(len(h + p), h + p, v) for h, p, v in url_filters.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://WWW.Example.com/en/1?q#f", "http://m.example.com/en/x", "https://example.com", "http://a.net/es/", "http://net/fr/1", "http://xnet/es/1", "a://b://c/d", "http://h.com?x=/en/", "http://com/"]
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id long, url string, html string, confidence int")
    none = spark.createDataFrame([], "rule_id long, tokens array<string>, confidence double, support double")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(pages, none).collect()}
    for i, u in enumerate(urls):
        h, p, rule, v = plain_verdict(u)
        assert got[i] == (h, p, rule, v or "allow")


def test_url_rules_are_mined(spark):
    rows = [(f"http://{'bad-farm' if i % 4 == 0 else 'good'}.example.org/{'x' if i % 2 else 'y'}/{i}", int(i % 4 == 0)) for i in range(200)]
    rules = url_filters.mine(spark.createDataFrame(rows, "url string, bad int"))
    assert rules.count() >= 1 and all("bad" in "".join(r.tokens) or "farm" in "".join(r.tokens) for r in rules.collect())
    pages = spark.createDataFrame([(1, "http://bad-farm.example.org/z/1"), (2, "http://good.example.org/z/1")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filters.judge(pages, rules).collect()} == {1: "block", 2: "allow"}
    assert url_filters.mine(spark.createDataFrame([], "url string, bad int")).count() == 0


# --- 3 --------------------------------------------------------------------------------------------------------------
def plain_sets(texts):
    out = []
    for t in texts:
        w = "".join(ch.lower() if ch.isascii() else ch for ch in t or "").encode().split()
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def test_ngram_join_equals_brute_force(spark):
    rng = random.Random(7)
    base = [words(rng, n) for n in (12, 30, 60, 200, 60)]
    passage = words(rng, 60)
    texts = [*ODD, *base]
    for b in base:
        for _ in range(9):
            w = b.split()
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(999)}"
            texts.append(" ".join(w))
    texts += [words(rng, 100) + " " + passage for _ in range(45)] + [base[2]] * 5 + ["same words here", "Same  words here"]
    sets = plain_sets(texts)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = union_find(len(texts), pairs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.duplicates(docs_of(spark, texts)).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in range(len(texts))}
    left = sorted(r.doc_id for r in ngram_join.deduplicated(docs_of(spark, texts)).collect())
    assert left == [i for i in range(len(texts)) if not sets[i] or want[i] == i]
    assert ngram_join.duplicates(docs_of(spark, []).limit(0)).count() == 0


# --- 4, 5 -----------------------------------------------------------------------------------------------------------
def labelled(spark, rng, n=400):
    texts, rows = [], []
    for i in range(n):
        good, toxic = i % 3 > 0, i % 5 == 0
        t = words(rng, 80, 5000) if good else " ".join(["REPEAT!!"] * 60 + [f"w{rng.randrange(9)}"])
        texts.append(t + (" vileword" if toxic else ""))
        rows.append((i, int(good), int(toxic)))
    return docs_of(spark, texts), spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module,label,threshold", [(quality, "quality", 0.3), (toxicity, "toxic", 0.5)])
def test_classifiers(spark, module, label, threshold):
    docs, labels = labelled(spark, random.Random(2))
    model = module.train(docs, labels, label)
    marks = {r.doc_id: r[label] for r in labels.collect()}
    got = {r.doc_id: r.score for r in module.score(docs, model).collect()}
    held = [i for i in marks if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= threshold) == marks[i] for i in held]) > 0.95
    odd = [r.score for r in module.score(docs_of(spark, ODD).withColumn("label", F.lit(1)), model).collect()]
    assert len(odd) == len(ODD) and all(0 <= s <= 1 for s in odd)
    empty = module.train(docs.limit(0), labels.limit(0), label)
    assert all(0 <= r.score <= 1 for r in module.score(docs.limit(3), empty).collect())


# --- 6 --------------------------------------------------------------------------------------------------------------
def test_html_extraction():
    page = (
        '<html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Menu one</a></li></ul></nav>'
        '<div class="ad">Buy, now. Really.</div><article><h1>A title &amp; more</h1><p><b>First  para,\nwith <i>marks</i>.<br><p>Second &lt;para&gt;, longer. It has text.</p>'
        '<div class="comments"><p>Nice, thanks. Great.</p></div></article><footer>&copy; x</footer></body></html>'
    )
    assert html_extraction.main_text(page) == "A title & more\n\nFirst para, with marks.\n\nSecond <para>, longer. It has text."
    plain = "<body><div id='menu'><a href=x>one</a> <a href=y>two</a></div><div><p>A long sentence, with some words, that goes on.</p><p>And another one, as long as that, follows it.</p></div>"
    assert html_extraction.main_text(plain) == "A long sentence, with some words, that goes on.\n\nAnd another one, as long as that, follows it."
    for odd in (None, "", "<", "<p", "<p>", "</p></div>", "just text, here.", "<!-- x", "<script>", "&#x41;&bogus;"):
        html_extraction.main_text(odd)


def test_html_wrappers_and_comments():
    body = "<p>A long sentence, with some words, that goes on.</p><p>And another one, as long as that, follows it.</p>"
    want = "A long sentence, with some words, that goes on.\n\nAnd another one, as long as that, follows it."
    side = "<div class='sidebar'><p>Read this, too.</p></div>"
    for opens in ("<div class='layout has-sidebar'>", "<div id='page' class='with-nav'>", "<form id='aspnetForm'>", "<div class='has-comments'>"):
        for inner in (body, f"<article>{body}</article>"):
            assert html_extraction.main_text(f"<body>{opens}{inner}{side}</div></form></body>") == want, (opens, inner)
    comment = "<article class='comment'><p>Nice, thanks, great, and many more words of a reader, and more, and more.</p></article>" * 3
    assert html_extraction.main_text(f"<body><div>{body}</div><div>{comment}</div></body>") == want
    assert html_extraction.main_text(f"<body><article>{body}</article><div class='related'><article><p>Short, teaser.</p></article></div>{comment}</body>") == want
    assert html_extraction.main_text("<body><nav>one</nav><div class='menu'><a href=x>one</a> <a href=y>two</a></div></body>") == ""


def test_html_extraction_of_tables(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, "<article><p>Hi, there.</p></article>")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert [tuple(r) for r in html_extraction.extract(pages).orderBy("page_id").collect()] == [(1, "u", "", 0), (2, None, "Hi, there.", 10)]


# --- 7 --------------------------------------------------------------------------------------------------------------
def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a/1", "same"), (2, "http://a/\n2", "same"), (3, None, None), (4, "u", ""), (5, "u", "x" * 400_000), (6, "u", "ü日"), (None, "u", "same"), (6, "u", "ü日")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha1", F.lit("clash"))
    bundles = common.stage(warc.write_bundles(warc.with_references(pages)), "bundles")
    got = warc.read_bundles(bundles).collect()
    assert len(got) == len(rows)
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", 0))
    for r in got:
        h = next(h or "" for i, _, h in rows if i == r.page_id)
        raw = h.encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        refers = last[h] if r.page_id is not None and last[h] != r.page_id else None
        assert r.refers_to == refers and r.record_type == ("revisit" if refers else "response") and bytes(r.payload) == (b"" if refers else raw)
    one = warc.fetch(bundles, spark.createDataFrame([(warc.record_id(5),)], "record_id string")).collect()
    assert [(r.page_id, len(r.payload)) for r in one] == [(5, 400_000)]
    warc.export_files(bundles, str(tmp_path))
    data = next(tmp_path.glob("*.warc.zst")).read_bytes()
    assert b"WARC/1.1" in warc.read_frame(data, 0)
    assert warc.read_bundles(warc.write_bundles(warc.with_references(pages.limit(0)))).count() == 0


# --- 8 --------------------------------------------------------------------------------------------------------------
def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((30, 16))
    x = np.vstack([base, *[base[k] + 0.12 * rng.standard_normal((8, 16)) for k in range(10)], np.repeat(base[:1], 20, 0)])
    label = np.r_[np.zeros(30, int), np.repeat(np.arange(10) % 2, 8), np.zeros(20, int)]
    rows = [(i, [float(v) for v in r], int(lab)) for i, (r, lab) in enumerate(zip(x, label))]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, rows[0][1], None), (904, [], 0), (905, [1.0, 2.0], 0), (None, rows[0][1], 0)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    u = embedding_dedup.unit(x)
    near = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(table).collect()}
    found = sum(got[i].n_links for i in range(len(x)))
    assert 0.9 * near.sum() <= found <= near.sum()
    assert all(got[i].n_links <= near[i].sum() for i in range(len(x)))
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (900, 901, 902, 903, 904, 905))
    tiled = embedding_dedup.links(embedding_dedup.classes(table), tile=4).groupBy().agg(F.sum("n")).first()[0]
    assert tiled == embedding_dedup.links(embedding_dedup.classes(table)).groupBy().agg(F.sum("n")).first()[0]
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


# --- 9 --------------------------------------------------------------------------------------------------------------
def test_context_trees_equal_plain_recursion(spark):
    """gram_logs against a direct recursion over all context nodes."""
    text = b"abracadabra abracadabra banana\n"
    pad = bytes([lm_scoring.END]) * lm_scoring.DEPTH
    key, start, size = lm_scoring.grams([text[:-1].split()])
    k, n = np.unique(key, return_counts=True)
    got = {r.key: r.value for r in lm_scoring.gram_logs(spark.createDataFrame([(int(a), int(b)) for a, b in zip(k, n)], "key long, n long")).collect()}
    raw, count = pad + text, {}
    for i in range(lm_scoring.DEPTH, len(raw)):
        for d in range(lm_scoring.DEPTH + 1):
            node = 1
            for b in range(8):
                bit = raw[i] >> (7 - b) & 1
                count.setdefault((raw[i - d : i], node), [0, 0])[bit] += 1
                node = node * 2 + bit
    own = lambda s: float(lm_scoring.block_log(*[np.array([float(v)]) for v in count[s]])[0])
    memo = {}

    def pw(s):
        if s not in memo:
            if len(s[0]) == lm_scoring.DEPTH:
                memo[s] = own(s)
            else:
                kids = sum(pw(t) for t in count if t[1] == s[1] and len(t[0]) == len(s[0]) + 1 and t[0].endswith(s[0]))
                memo[s] = float(np.logaddexp(lm_scoring.HALF + own(s), lm_scoring.HALF + kids))
        return memo[s]

    for i in range(lm_scoring.DEPTH, len(raw), 5):
        total, node = 0.0, 1
        for b in range(8):
            bit, one, rest = raw[i] >> (7 - b) & 1, 0.0, 1.0
            for d in range(lm_scoring.DEPTH + 1):
                s = (raw[i - d : i], node)
                w = np.exp(lm_scoring.HALF + own(s) - pw(s)) if d < lm_scoring.DEPTH else 1.0
                a, c = count[s]
                one += rest * w * (c + 0.5) / (a + c + 1)
                rest *= 1 - w
            total += np.log10(one if bit else 1 - one)
            node = node * 2 + bit
        gram = int.from_bytes(raw[i - lm_scoring.DEPTH : i + 1], "big")
        assert abs(got[gram] - total) < 1e-7


def test_scores(spark):
    from collections import Counter

    rng = random.Random(8)
    texts = [words(rng, 60, 40) for _ in range(60)] + ODD
    train = [zlib.crc32(str(i).encode()) % 10 != 0 for i in range(len(texts))]
    c = Counter()
    for t, f in zip(texts, train):
        if f:
            c.update([*common.words_of(t), b"\n"])
    total, kinds = sum(c.values()), len(c)
    for r in lm_scoring.score(docs_of(spark, texts)).collect():
        w = [*common.words_of(texts[r.doc_id]), b"\n"]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), total)
        assert abs(r.base_score - sum(np.log10((c[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in w)) < 1e-6 * len(w)
        assert r.score < 0
    assert lm_scoring.score(docs_of(spark, []).limit(0)).count() == 0


# --- 10 -------------------------------------------------------------------------------------------------------------
def test_decontamination_equals_brute_force(spark):
    rng = random.Random(9)
    items = [words(rng, n, 900) for n in (3, 5, 9, 20, 45, 90)] + ["", None]
    texts = [*ODD]
    for it in items:
        for cut in (0, 2, 6):
            w = (it or "").split()
            texts.append(words(rng, rng.randint(0, 300), 900) + " " + " ".join(w[cut:]).upper() + " " + words(rng, 20, 900))
    texts += [items[3]] * 3
    a, b = plain_sets(texts), plain_sets(items)
    want = {(i, j) for i in range(len(texts)) for j in range(len(items)) if b[j] and 100 * len(a[i] & b[j]) >= 75 * len(b[j])}
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs_of(spark, texts), bench).collect()}
    assert got == want and len(want) > 5
    kept = {r.doc_id for r in decontamination.clean(docs_of(spark, texts), bench).collect()}
    assert kept == set(range(len(texts))) - {i for i, _ in want}
    assert decontamination.contaminated(docs_of(spark, texts), bench.limit(0)).count() == 0
    assert decontamination.contaminated(docs_of(spark, []).limit(0), bench).count() == 0


def plain_places(text):
    """Hash places of all character n-grams, one by one."""
    t, out = f" {' '.join(text.lower().split())} ", set()
    for n in toxicity.SIZES:
        for i in range(len(t) - n + 1):
            key = sum(ord(ch) * int(f) for ch, f in zip(t[i : i + n], toxicity._FACTORS)) % 2**64
            out.add(((key ^ (key >> 29)) * 0xBF58476D1CE4E5B9 % 2**64) >> 44)
    return out


def test_toxicity_equals_plain_sums(spark):
    texts = ["Zwei drei 日本語 \U0001f642 drei", "a", "", None, "word " * 3000, "Über  die\nBrücke " * 40]
    weight = np.random.default_rng(1).standard_normal(toxicity.BUCKETS)
    got = [r.score for r in toxicity.score(docs_of(spark, texts), toxicity.Weights(-0.3, np.arange(toxicity.BUCKETS), weight)).orderBy("doc_id").collect()]
    for t, g in zip(texts, got):
        at = sorted(plain_places(t)) if t else []
        z = -0.3 + weight[at].sum()
        assert abs(g - 1 / (1 + np.exp(-z))) < 1e-9
    long = "ab cd ef " * (toxicity.CHUNK // 4)  # more than one piece
    assert set(toxicity.present(long, np.zeros(toxicity.BUCKETS, bool)).tolist()) == plain_places("ab cd ef " * 20)


def test_toxicity_features_equal_plain_ratios(spark):
    texts = [f"wort{i % 7} satz{i % 5} {'gift' if i % 6 == 0 else 'mild'}" for i in range(60)] + [None, "", "\U0001f642 ja"]
    labels = [int(i % 6 == 0) for i in range(60)] + [0, 0, 1]
    found = [plain_places(t) if t else set() for t in texts]
    n = [labels.count(k) for k in (0, 1)]
    want = {}
    for p in set().union(*found):
        neg, pos = (sum(p in f and b == k for f, b in zip(found, labels)) for k in (0, 1))
        ratio = np.log((pos + 1) / (n[1] + 2)) - np.log((neg + 1) / (n[0] + 2))
        if abs(ratio) >= 3 * np.sqrt(1 / (pos + 1) - 1 / (n[1] + 2) + 1 / (neg + 1) - 1 / (n[0] + 2)):
            want[p] = (ratio, neg + pos)
    rows = spark.createDataFrame(list(zip(texts, labels)), "text string, label int").repartition(4)
    got = toxicity.ratios(toxicity.counts(rows), n[1], n[0], 3.0)
    assert got.place.tolist() == sorted(want) and 0 < len(want) < len(set().union(*found))
    for p, r, texts_ in zip(got.place, got.ratio, got.texts):
        assert abs(r - want[p][0]) < 1e-12 and texts_ == want[p][1]


def test_trees_equal_plain_walk(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 4))
    trees = quality.fit_trees(x, (x[:, 0] + x[:, 1] > 0).astype(float), trees=7)
    for row, got in zip(x[:50], trees.score(x[:50])):
        total = trees.base
        for f, t, v in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += v[node - len(f)]
        assert abs(got - 1 / (1 + np.exp(-total))) < 1e-12
    assert np.mean((trees.score(x) > 0.5) == (x[:, 0] + x[:, 1] > 0)) > 0.9


def test_html_attributes_and_article_parts():
    page = "<article><p data-x=don't>First one, that goes.</p><p title=\"5\" tall\">Second, it goes on.</p><p>It's 'fine', yes.</p></article>"
    assert html_extraction.main_text(page) == "First one, that goes.\n\nSecond, it goes on.\n\nIt's 'fine', yes."
    body = "<p>A long paragraph, with many words, and more of them, in it, for sure.</p><p>Another long paragraph, with many words, and more.</p>"
    page = f"<article>{body}<ul><li>one item</li><li>two</li></ul><table><tr><td>cell</td></tr></table><blockquote>said so</blockquote></article>"
    assert html_extraction.main_text(page).split("\n\n")[2:] == ["one item", "two", "cell", "said so"]


def test_clashing_names_and_repeats(spark):
    rng = random.Random(21)
    docs, labels = labelled(spark, rng, 120)
    docs = docs.unionByName(docs.limit(40)).unionByName(docs_of(spark, ["other text for a held id"], [7]))
    extra = ("gone_id", "gone_key", "bad_id", "bad_key", "toxicity", "quality", "score", "component", "key", "set")
    wide = docs.withColumns({x: F.lit("clash") for x in extra})
    for made in (ngram_join.deduplicated(wide), decontamination.clean(wide, spark.createDataFrame([(1, "w1 w2")], "item_id long, text string")), toxicity.clean(wide, labels), quality.clean(wide, labels)):
        rows = made.collect()
        assert made.columns == wide.columns and rows and all(r.gone_id == "clash" for r in rows)
    for module, label in ((quality, "quality"), (toxicity, "toxic")):
        scores = [[(r.doc_id, r.score) for r in module.score(docs, module.train(docs.repartition(n), labels, label)).orderBy("doc_id", "text").collect()] for n in (1, 5)]
        assert all(a == b and abs(x - y) < 1e-6 for (a, x), (b, y) in zip(*scores))


def test_empty_tables(spark, tmp_path):
    import corpus_pipeline

    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filters.judge(pages, spark.createDataFrame([], "rule_id long, tokens array<string>, confidence double, support double")).count() == 0
    assert html_extraction.extract(pages).count() == 0
    for name, schema in (("documents", DOC), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", "share-price social-study notice-period related-work menu-of-options header-text promo".split())
def test_html_class_names_in_articles(name):
    inner = "A part of the article, which says something, and goes on for a while, so that it is clearly prose and not a button."
    page = f"<article><p>First of all, there is this.</p><div class='{name}'><p>{inner}</p></div><p>And last, there is that.</p></article>"
    assert html_extraction.main_text(page) == f"First of all, there is this.\n\n{inner}\n\nAnd last, there is that."


def test_html_short_parts_of_articles_and_comment_ends():
    long = "First of all, there is this, " + "and this, " * 20 + "and no more."
    page = f"<article><p>{long}</p><div class='share'><p>Share it!</p></div><div class='ad'><p>Buy now, all of you, and buy a lot of it, or else you will be sorry, very sorry.</p></div><p>And last, there is that.</p></article>"
    assert html_extraction.main_text(page) == f"{long}\n\nAnd last, there is that."
    for comment in ("<!-- a --!>", "<!-->", "<!--->", "<!-- <p> -- > -->"):
        assert html_extraction.main_text(f"<p>One, two.</p>{comment}<p>Three, four.</p>") == "One, two.\n\nThree, four."


def test_url_mining_of_long_urls(spark):
    rng = random.Random(6)
    deep = "/".join("abcdefghijklmnopqrstuvw"[k] * 3 for k in range(23))
    rows = [(f"https://long-host-name.site.example.org/{deep}/{rng.choice(['x', 'y', 'z'])}/", int(i % 3 == 0)) for i in range(150)]
    rows += [(f"https://www.spam.example.org/win/{rng.choice('pqr')}/", int(i % 10 > 0)) for i in range(60)]
    rules = url_filters.mine(spark.createDataFrame(rows, "url string, bad int")).collect()
    assert any("host:spam" in r.tokens and "path:win" in r.tokens for r in rules)
    assert all(len(r.tokens) < 8 for r in rules)


def test_url_mining_leaves_no_item_out(spark, monkeypatch):
    # thirteen words that go with bad pages, each in its own urls too, hide the pair that is a rule: each of its words alone is no rule
    rng = random.Random(12)
    words, rows = ["w" + chr(97 + k) * 2 for k in range(13)], []
    for i in range(60):
        rows.append(("http://h.org/" + "/".join([*words, "left", "right"]), 1))
    for w in words:
        rows += [(f"http://h.org/{w}", int(k < 4)) for k in range(6)]
    rows += [(f"http://h.org/{rng.choice(['left', 'right'])}", 0) for _ in range(300)]
    labelled = spark.createDataFrame(rows, "url string, bad int")
    rules = {tuple(r.tokens): (round(r.confidence, 9), round(r.support, 9)) for r in url_filters.mine(labelled).collect()}
    assert rules[("path:left", "path:right")] == (1.0, round(60 / len(rows), 9))

    # every rule of all item sets, by FP-growth and by sets in which each item keeps out a good url
    rows = [("http://h.org/" + "/".join(w for w in words[:7] if rng.random() < 0.5), int(rng.random() < 0.3)) for _ in range(500)]
    rows += [("http://h.org/" + "/".join(words[a:b]), 1) for a, b in ((0, 3), (2, 6), (1, 2)) for _ in range(25)]
    labelled = spark.createDataFrame(rows, "url string, bad int")
    found = []
    for most in (12, 0):
        monkeypatch.setattr(url_filters, "MOST_ITEMS", most)
        found.append({tuple(r.tokens): (round(r.confidence, 9), round(r.support, 9)) for r in url_filters.mine(labelled, min_confidence=0.4, min_lift=1.1).collect()})
    assert found[0] == found[1] and any(len(t) > 1 for t in found[0])


# --- filter audit ------------------------------------------------------------------------------------------------------
def plain_audit(docs, labels):
    from itertools import permutations

    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    rows = []
    for i, t, lang in docs:
        t = t or ""
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", t) if x]
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= x <= "Z" for x in t) > 3 * len(t), "D": any(x in "#$%&*|" for x in t), "E": i is not None and i > least[t]}
        good, toxic = (any(a == i is not None and b == 1 for a, b in ((r[0], r[k]) for r in labels)) for k in (1, 2))
        rows.append((lang or "", fails, good, toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        first = {x: 0 for x in "ABCDE"}
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                first[x] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(r[1][x] for r in own) - len(gone), sum(r[1][x] and sum(r[1].values()) == 1 for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone), x]
        for key in [k for k in out if k[0] == part]:
            out[key][-1] = first[out[key][-1]] if isinstance(out[key][-1], str) else out[key][-1]
    return {k: tuple(v) for k, v in out.items()}


def test_filter_audit_equals_plain_version(spark, monkeypatch):
    rng = random.Random(31)
    texts = [words(rng, rng.choice([3, 150, 210, 400]), rng.choice([40, 100, 900])) for _ in range(40)]
    texts = [t.upper() if rng.random() < 0.2 else t + rng.choice(["", "", " #", " |x"]) for t in texts]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None])) for i in range(120)] + [(500 + k, t, "odd") for k, t in enumerate(ODD)] + [(3, texts[0], "en"), (None, texts[0], "en"), (None, None, None), (900, None, "en"), (901, "", "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 120, 2)] + [(4, 1, 0), (None, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({x: F.lit("clash") for x in ("part", "h", "mask", "segment", "first", "quality", "n")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1))
    want = plain_audit(docs, labels)
    for bound in (filter_audit.BROADCAST_BYTES, 0):
        monkeypatch.setattr(filter_audit, "BROADCAST_BYTES", bound)
        monkeypatch.setattr(filter_audit, "HELD", 16)
        got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filter_audit.interactions(filter_audit.mask_counts(df.repartition(5), marks)).collect()}
        assert got == want
    assert filter_audit.interactions(filter_audit.mask_counts(df.limit(0), marks.limit(0))).count() == 0


# --- packing -----------------------------------------------------------------------------------------------------------
def test_encoder_equals_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(packing.MODEL))
    rng = random.Random(2)
    texts = [t or "" for t in ODD] + ["don't we'll'S", "a<|endoftext|>b <|ENDOFTEXT|>", "\x1c a\x85b", "\u03a9\u03c3\u03c2 \u0391\u03a3 \u0130x \u00c4\u00df\u00d7\u00f7", "aaaaaaaaaaaa" * 9, "\u00e9 e\u0301 \u00bd\u00b2", "x_1--!!2024", "'s't''"]
    texts += ["".join(rng.choice("abeinrstAB'.,-019 \u00e4\u00df\u00f1%$") for _ in range(rng.randint(1, 80))) for _ in range(300)]
    encoder = packing.Encoder()
    parts = [t.encode().split() for t in texts]
    flat, n = encoder.encode([w for p in parts for w in p])
    ends, at = np.r_[0, np.cumsum(n)], 0
    for t, p in zip(texts, parts):
        assert flat[ends[at] : ends[at + len(p)]].tolist() == library.encode(t, add_special_tokens=False).ids, t
        at += len(p)


def test_packing_places_every_piece(spark):
    rng = random.Random(12)
    texts = [*ODD, "ab " * 3000, "cd " * 2047, "ef " * 2048] + [words(rng, rng.choice([5, 40, 300, 700])) for _ in range(60)] + [words(random.Random(1), 500)] * 20
    docs = docs_of(spark, texts, [*range(len(texts) - 1), 0]).unionByName(docs_of(spark, ["null id"]).withColumn("doc_id", F.lit(None).cast("long"))).withColumns({x: F.lit(1) for x in ("row", "length", "piece", "kind", "rank")})
    import public_tokenizers
    from tokenizers import Tokenizer

    library, want = Tokenizer.from_file(public_tokenizers.path(packing.MODEL)), []
    for i, t in [*zip([*range(len(texts) - 1), 0], texts), (None, "null id")]:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(i, k, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
    cut = common.stage(packing.pieces(docs.repartition(3)).select("row", "doc_id", "piece", "start", "length", F.crc32("ids").alias("crc")), "pieces")
    rows = packing.packed(cut).collect()
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.crc) for r in rows], key=key) == sorted(want, key=key)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1.1 * sum(r.length for r in rows) / 2048 + 1
    assert packing.packed(common.stage(packing.pieces(docs.limit(0)), "none")).count() == 0


def test_packing_plans():
    rng = np.random.default_rng(3)
    for trial in range(6):
        count = np.zeros(65, np.int64)
        np.add.at(count, np.minimum(rng.integers(1, 64, rng.integers(1, 400)), 64 if trial % 2 else 20), 1)
        of, sizes, need = packing.groups(count, 8)
        assert all(sizes[of[x]] >= x for x in np.flatnonzero(of >= 0)) and need.sum() == count[17:64].sum() and len(sizes) <= 8
        plan = packing.configurations(sizes, need, 64)
        assert all((what @ sizes) <= 64 for what, _ in plan) and (sum((what * n for what, n in plan), np.zeros(len(sizes), int)) == need).all()
        room = np.bincount(rng.integers(0, 60, 30), minlength=65)
        small = np.where(np.arange(65) <= 16, count, 0)
        where, opened = packing.best_fit(room, small)
        left = {(r, k): r for r in range(64) for k in range(room[r])} | {(64, k): 64 for k in range(opened)}
        for length in np.flatnonzero(small):
            starts = [*where[length], (int(small[length]), 0, 0)]
            for (rank, level, at), (stop, _, _) in zip(starts, starts[1:]):
                for k in range(stop - rank):
                    left[level, at + k] -= int(length)
        assert min(left.values(), default=0) >= 0


# --- lexical search ----------------------------------------------------------------------------------------------------
def plain_search(docs, items, most=20):
    import math
    import re
    from collections import Counter

    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = lambda t: re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(low))
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(x for _, c in held for x in c)
    out = []
    for item in {i for i, _ in items if i is not None}:
        asked = Counter(x for i, t in items if i == item for x in terms(t))
        found = []
        for i, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n) // total
            score = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((1_000_000_000 * c[x]) // (1000 * c[x] + 12 * m)) for x, k in asked.items() if c[x])
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, rank, None if gone else i, -score) for rank, (score, gone, i) in enumerate(sorted(found)[:most], 1)]
    return sorted(out, key=lambda r: r[:2])


def test_lexical_search_equals_plain_ranking(spark, monkeypatch):
    rng = random.Random(17)
    texts = [*ODD, "\u00c4rger-\u00e4RGER x1,y2", "!!! ???"] + [words(rng, rng.randint(1, 60), 80) for _ in range(150)] + [words(random.Random(4), 30, 80)] * 40
    docs = list(enumerate(texts)) + [(5, texts[20]), (None, texts[21]), (None, texts[21])]
    items = [(k, words(rng, rng.randint(1, 12), 80)) for k in range(8)] + [(8, None), (9, "..."), (10, "nowhere found"), (11, "W3 w3 w4"), (11, "w5"), (12, "word one A aaa"), (None, "w1 w2"), (13, texts[-1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({x: F.lit("clash") for x in ("item", "score", "rank", "term", "df")})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit(0))
    want = plain_search(docs, items)
    for size in (1 << 11, 16):
        monkeypatch.setattr(lexical_search, "BLOCK_DOCS", size)
        monkeypatch.setattr(lexical_search, "AT_ONCE", 3 if size == 16 else 64)
        monkeypatch.setattr(lexical_search, "ITEMS_AT_ONCE", 5 if size == 16 else 2000)
        got = sorted((tuple(r) for r in lexical_search.ranked(df.repartition(3), asked).select("item_id", "rank", "doc_id", "score").collect()), key=lambda r: r[:2])
        assert got == want
    assert lexical_search.ranked(df.limit(0), asked).count() == 0 and lexical_search.ranked(df, asked.limit(0)).count() == 0


def test_treap_finds_every_cell_and_survives_packing():
    rng = np.random.default_rng(1)
    cells = np.unique(rng.integers(0, 37 * 21, 120))
    row, column, value = cells // 21, cells % 21, rng.integers(1, 1000, len(cells))
    treap = lexical_search.Treap.build(row, column, value, 37, 21)
    treap = lexical_search.Treap.unpacked(treap.height, *treap.packed())
    held = dict(zip(zip(row.tolist(), column.tolist()), value.tolist()))
    for r in range(37):
        for c in range(21):
            cell, h = np.zeros(1, np.int64), treap.height
            for level in range(h):
                cell = treap.child(level, cell, np.array([(r >> h - 1 - level & 1) << 1 | c >> h - 1 - level & 1]))
            assert (treap.maxima[h][cell[0]] if cell[0] >= 0 else None) == held.get((r, c))


CONTRACT = {
    "op1_sentencepiece": ("documents", "doc_id:bigint n_tokens:bigint ids:array<int>"), "op2_url_filters": ("pages", "page_id:bigint host:string path:string rule:string verdict:string"),
    "op3_ngram_jaccard_join": ("documents", "doc_id:bigint n_shingles:bigint component_id:bigint"), "op4_quality_classifier": ("documents", "doc_id:bigint held_out:boolean score:double predicted:int"),
    "op5_toxicity": ("documents", "doc_id:bigint held_out:boolean score:double predicted:int"), "op6_html_extraction": ("pages", "page_id:bigint url:string text:string n_chars:bigint"),
    "op7_warc": ("pages", "page_id:bigint payload_bytes:bigint payload_digest:string record_type:string refers_to:bigint"), "op8_embedding_dedup": ("embeddings", "vec_id:bigint n_links:bigint component_id:bigint kept:boolean"),
    "op9_lm_scoring": ("documents", "doc_id:bigint held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double"), "op10_decontamination": (None, "doc_id:bigint item_id:bigint"),
    "op11_lexical_search": (None, "item_id:bigint rank:int doc_id:bigint score:bigint"), "op12_best_fit_packing": (None, "doc_id:bigint piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint"),
    "op13_filter_audit": (None, "part:string filter_order:string step:int kept:bigint removed:bigint redundant:bigint unique_fails:bigint good_lost:bigint toxic_lost:bigint shapley:bigint"),
}


@pytest.mark.parametrize("name", CONTRACT)
def test_queries(spark, name):
    import os

    from recordweave.llm import queries

    sf, (source, columns) = "/root/testdata/sf0.001", CONTRACT[name]
    if not os.path.isdir(sf):
        pytest.skip("driver tables are not here")
    made = queries.QUERIES[name](spark, sf)
    types = dict(made.dtypes)
    for c in columns.split():
        c, kind = c.split(":")
        assert types[c] == kind
    rows = made.collect()
    if source:
        assert len(rows) == common.table(spark, sf, source).count()
    if "held_out" in types:
        modulus = 10 if name == "op9_lm_scoring" else 5
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == 0) for r in rows)
    if name in queries.ORACLE_SQL:
        import duckdb

        con = duckdb.connect()
        for t in ("documents", "pages", "benchmark", "labels"):
            con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
        want = con.sql(queries.ORACLE_SQL[name])
        assert sorted(want.columns) == sorted(types)
        at = [want.columns.index(c) for c in sorted(types)]
        assert sorted(repr([r[c] for c in sorted(types)]) for r in rows) == sorted(repr([r[k] for k in at]) for r in want.fetchall())


def test_pipeline(spark):
    import os

    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables are not here")
    docs = common.table(spark, sf, "documents")
    columns = docs.columns
    toxic = {r.doc_id for r in common.table(spark, sf, "labels").filter("toxic = 1").collect()}
    for name, apply in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = common.stage(apply(spark, docs, sf), name)
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and after <= before
        if name == "toxicity":
            assert len(after & toxic) <= 0.2 * len(toxic)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in out} == after and all(r.round_trip for r in out)


def test_pipeline_of_odd_rows(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(41)
    good = [words(rng, 300, 5000) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate([*ODD, *good, good[0], good[1] + " more", None])] + [(None, good[2]), (7, good[3]), (7, good[3])]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOC).withColumns({"gone_id": F.lit(1), "score": F.lit("x")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1, 0), (None, 0, 1), (11, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None), (2, ""), (2, " ".join(good[5].split()[:20]))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {r.doc_id for r in out}
    assert all(r.round_trip for r in out if "\u2581" not in (rows[r.doc_id][1] or "") or r.doc_id is None)
    assert len(out) <= len(rows) and kept <= {i for i, _ in rows}
    assert len(ODD) + 5 not in kept  # it holds an item
