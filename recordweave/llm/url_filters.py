"""URL filtering: explicit host and path rules first, then association rules mined from labelled pages.

Spark's FP-growth finds token combinations (host labels, path words, query keys, extension) that go with bad
documents. Rules that pass the support, confidence and lift bounds are kept as an inverted index from token to rule;
a url is blocked when all tokens of a rule are among its own.

Null urls and urls without `://` have an empty host and path, match no rule and are allowed. Repeated pages and extra
columns pass unchanged; all tokens of deep urls are mined and matched; with no labels, or with labels of one kind, no rule is mined.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.llm.common import ascii_lower, stage, table

#: (host, path, verdict), as the contract of the query fixes them.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
BAD = "=bad"
#: FP-growth lists all item sets, which double with every item; where a url has more items than this, `strict_sets` lists those that matter.
MOST_ITEMS = 12
#: Mined rules beyond this count are joined by a shuffle, not broadcast.
BROADCAST_RULES = 200_000


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def explicit(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. Rules are a literal list, so this is one projection."""
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def tokens(url: Column) -> Column:
    """Distinct tokens: host labels, the words of compound ones, path words without digits, query keys, extension."""
    path = path_of(url)
    words = lambda c, pattern: F.filter(F.split(c, pattern), lambda x: (x != "") & ~x.rlike(r"\d"))
    mark = lambda arr, kind: F.transform(arr, lambda x: F.concat(F.lit(kind), F.lower(x)))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    ext = F.regexp_extract(path, r"\.([A-Za-z]+)$", 1)
    out = F.concat(
        mark(words(host_of(url), r"\."), "host:"),
        mark(F.array_except(words(host_of(url), r"[.\-]"), words(host_of(url), r"\.")), "word:"),
        mark(words(path, r"[/.\-_]+"), "path:"),
        mark(F.filter(keys, lambda x: x != ""), "key:"),
        F.when(ext != "", F.array(F.concat(F.lit("ext:"), F.lower(ext)))).otherwise(F.array().cast("array<string>")),
    )
    return F.array_sort(F.array_distinct(F.coalesce(out, F.array().cast("array<string>"))))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad): pages whose path names a labelled document, bad if that is of low quality or toxic."""
    doc = F.try_to_number(F.regexp_extract(path_of(F.col("url")), r"/(\d{1,18})(?:/|\.\w+)?$", 1), F.lit("9" * 18)).cast("long")
    marks = labels.groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad")).filter("bad is not null")
    return pages.select("url", doc.alias("doc_id")).filter("doc_id is not null").join(marks, "doc_id").select("url", "bad")


def items_of(labelled: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(row, bad, items) of each labelled url, and (item, tokens) of items that stand for several tokens.

    Tokens of fewer than `least` urls can be in no rule, and tokens of all urls say nothing: both are left out. Tokens that
    are in exactly the same urls are one item.
    """
    rows = labelled.select(F.monotonically_increasing_id().alias("row"), "url", "bad")
    rows = stage(rows, "labelled")
    held = rows.select("row", "bad", F.explode(tokens(F.col("url"))).alias("token"))
    n = rows.count()
    counted = held.groupBy("token").agg(F.count("*").alias("n"), F.sum("bad").alias("n_bad"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("set_a"), F.sum(F.xxhash64("row", F.lit(1)).cast("decimal(38,0)")).alias("set_b"))
    counted = counted.filter((F.col("n") >= least) & (F.col("n") < n))
    merged = counted.groupBy("n", "n_bad", "set_a", "set_b").agg(F.array_sort(F.collect_list("token")).alias("tokens")).select(F.get("tokens", 0).alias("item"), "tokens")
    merged = stage(merged, "items")
    listed = held.join(merged.select(F.col("item").alias("token")), "token").groupBy("row").agg(F.collect_list("token").alias("items"))
    items = rows.join(listed, "row", "left").select("row", "bad", F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return stage(items, "baskets"), merged


def strict_sets(baskets: DataFrame, least: int) -> DataFrame:
    """(items, n_bad, n_good): item sets of at least `least` bad urls in which every item keeps out some good url.

    If an item keeps no good url out, the set without it goes with at least as many bad urls and the same good ones, so it
    is a rule at least as strong; that holds for all larger sets too. So these sets give every rule that has no stronger
    sub-rule, at any length. Sets grow by one item a step, from the urls that hold them.
    """
    held = baskets.select("row", "bad", F.explode("items").alias("item"))

    def counted(cover: DataFrame) -> DataFrame:
        return cover.groupBy("items").agg(F.sum("bad").cast("long").alias("n_bad"), F.count_if(F.col("bad") == 0).alias("n_good")).filter(F.col("n_bad") >= least)

    cover = held.select(F.array("item").alias("items"), "row", "bad")
    sets = stage(counted(cover), "sets")
    own = stage(held.join(sets.select(F.get("items", 0).alias("item")), "item").select("row", "bad", "item"), "own")
    cover, every = own.select(F.array("item").alias("items"), "row"), [sets]
    while not sets.isEmpty():
        wider = cover.join(own, "row").filter(F.col("item") > F.element_at("items", -1)).select(F.array_append("items", F.col("item")).alias("items"), "row", "bad")
        more = stage(counted(wider), "more")
        parts = more.select("items", "n_good", F.explode("items").alias("x")).select("items", "n_good", F.array_remove("items", F.col("x")).alias("part"))
        strict = parts.join(sets.select(F.col("items").alias("part"), F.col("n_good").alias("without")), "part").filter("without > n_good").groupBy("items").count()
        sets = stage(more.join(strict.filter(F.col("count") == F.size("items")), "items", "left_semi"), "sets")
        cover = stage(wider.join(sets, "items", "left_semi").select("items", "row"), "cover")
        every.append(sets)
    return reduce(DataFrame.unionByName, every)


def mine(labelled: DataFrame, min_support: float = 0.002, min_count: int = 12, min_confidence: float = 0.6, min_lift: float = 1.5) -> DataFrame:
    """(rule_id, tokens, confidence, support) of rules tokens -> bad. A rule with a stronger sub-rule is left out."""
    spark = labelled.sparkSession
    schema = "rule_id long, tokens array<string>, confidence double, support double"
    n = labelled.count()
    if n == 0:
        return spark.createDataFrame([], schema)
    support = max(min_support, min(1.0, min_count / n))
    least = math.ceil(support * n)
    items, merged = items_of(labelled, least)
    longest, n_bad = items.agg(F.max(F.size("items")), F.sum("bad")).first()
    if longest <= MOST_ITEMS:
        baskets = items.select(F.concat("items", F.when(F.col("bad") == 1, F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))).alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
        rules = model.associationRules.filter((F.element_at("consequent", 1) == BAD) & (F.col("lift") >= min_lift)).select(F.array_sort("antecedent").alias("items"), "confidence", "support")
    else:
        rules = strict_sets(items, least).select("items", (F.col("n_bad") / (F.col("n_bad") + F.col("n_good"))).alias("confidence"), (F.col("n_bad") / n).alias("support"))
        rules = rules.filter((F.col("confidence") >= min_confidence) & (F.col("confidence") * n >= min_lift * n_bad))
    rules = stage(rules, "rules")
    r, s = rules.alias("r"), rules.select(F.col("items").alias("t2"), F.col("confidence").alias("c2"), F.explode("items").alias("first")).alias("s")
    weaker = (
        r.select("items", "confidence", F.explode("items").alias("first")).join(s, "first")
        .filter((F.size("t2") < F.size("items")) & (F.size(F.array_except("t2", "items")) == 0) & (F.col("c2") >= F.col("confidence")))
        .select("items").distinct()
    )
    kept = rules.join(weaker, "items", "left_anti").withColumn("item", F.explode("items")).join(merged, "item")
    whole = kept.groupBy("items", "confidence", "support").agg(F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens"))
    return whole.select(F.xxhash64("tokens").alias("rule_id"), "tokens", "confidence", "support")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, confidence): urls that hold all tokens of a rule, by an inverted index from token to rule."""
    index = rules.select("rule_id", "confidence", F.size("tokens").alias("need"), F.explode("tokens").alias("token"))
    if rules.count() <= BROADCAST_RULES:
        index = F.broadcast(index)
    hits = urls.select("url").filter("url is not null").distinct().select("url", F.explode(tokens(F.col("url"))).alias("token")).join(index, "token")
    return hits.groupBy("url", "rule_id").agg(F.count("*").alias("n"), F.first("need").alias("need"), F.first("confidence").alias("confidence")).filter("n = need").groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, mined: DataFrame, rules=RULES) -> DataFrame:
    """Every page with host, path, rule and verdict: the explicit rule's, else block for a mined match, else allow."""
    hit = match(pages, mined).withColumnRenamed("url", "hit_url")
    key = F.coalesce("url", F.concat(F.lit("\0"), F.col("page_id").cast("string"), F.lit("")), F.lit("\0"))  # null urls are dealt by page
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = explicit(F.col("host"), F.col("path"), rules)
    return (
        pages.select("page_id", "url").withColumns({"host": host, "path": path})
        .withColumn("key", key)
        .join(hit, F.col("key") == F.col("hit_url"), "left")
        .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("confidence").isNotNull(), "block"), F.lit("allow")).alias("verdict"))
    )


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    return judge(pages, mine(labelled_pages(pages, labels)))


#: The explicit rules in SQL. Labels say nothing about urls in the given tables, so no rule is mined and the rest is allowed.
SQL = f"""
WITH r AS (SELECT * FROM (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}) AS t(h, p, verdict)),
x AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM x),
f AS (SELECT page_id, host, path, h || p AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST) AS k FROM u LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE k = 1
"""
