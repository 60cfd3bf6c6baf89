"""First, last and latest rows by explicit order; carry-forward; deduplication; top-n; ordinal names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordweave.sources.staging import staged


def first_per(df: DataFrame, key: list, order: list) -> DataFrame:
    """One row for each key: the first in the given order."""
    return top_per(df, key, order, 1)


def top_per(df: DataFrame, key: list, order: list, n: int) -> DataFrame:
    """At most n rows for each key; a negative n keeps all."""
    if n < 0:
        return df
    return df.withColumn("rank_", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("rank_") <= n).drop("rank_")


def first_in_all(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows of all, each task handing on n at most; a negative n keeps all."""
    return df if n < 0 else df.orderBy(*order).limit(n)


def first_or_unkeyed(df: DataFrame, key: Column, order: list, empty: Column) -> DataFrame:
    """First row of each key; rows whose key is empty are all kept, and never meet in one window."""
    keyed = df.withColumn("key_", key)
    return first_per(keyed.filter(~empty), ["key_"], order).unionByName(keyed.filter(empty)).drop("key_")


def composite_key(columns: list[Column], whole: list[str]) -> Column:
    """The columns as one key, or the whole row as JSON where all of them are empty."""
    parts = [F.coalesce(F.trim(c), F.lit("")) for c in columns]
    empty = parts[0] == ""
    for p in parts[1:]:
        empty = empty & (p == "")
    return F.when(empty, F.to_json(F.struct(*sorted(whole)))).otherwise(F.to_json(F.array(*parts)))


def carry_last(value: Column, by: list, order: list) -> Column:
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def carry_first(value: Column, by: list, order: list) -> Column:
    return F.first(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def group_number(start: Column, by: list, order: list) -> Column:
    """0 before the first start, then 1, 2, .. with each row that starts a group."""
    return F.sum(start.cast("int")).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def drop_leading(df: DataFrame, header: Column, by: list, order: list) -> DataFrame:
    """df without the longest run of header rows that begins each group."""
    return df.withColumn("body_", group_number(~header, by, order)).filter("body_ > 0").drop("body_")


def ordinal(by: list, order: list) -> Column:
    return F.lpad(F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("string"), 2, "0")


def in_ranges(df: DataFrame, keys: list, rows: int = 20_000) -> DataFrame:
    """df dealt by range of the keys into parts of about `rows` rows, written with its part (`part_`) and place (`seq_`)."""
    width = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))
    dealt = df.repartitionByRange(width, *keys).sortWithinPartitions(*keys)
    return staged(dealt.withColumns({"part_": F.spark_partition_id(), "seq_": F.monotonically_increasing_id()}))


def global_number(df: DataFrame, group: list[str], order: list[str], name: str = "n") -> DataFrame:
    """df with 1, 2, .. in each group, or in all rows without one, by an order that tells rows apart.

    No window holds a whole group: rows are numbered within ranges, and the counts of the ranges before are added.
    """
    dealt = in_ranges(df, [*group, *order])
    own = F.row_number().over(Window.partitionBy(*group, "part_").orderBy("seq_"))
    counts = dealt.groupBy(*group, "part_").agg(F.count("*").alias("rows_"))
    before = counts.withColumn("before_", F.sum("rows_").over(Window.partitionBy(*group).orderBy("part_")) - F.col("rows_")).drop("rows_")
    return dealt.withColumn("own_", own).join(before, [*group, "part_"]).withColumn(name, F.col("own_") + F.col("before_")).drop("own_", "before_", "part_", "seq_")


def collision_name(name: str, order: list) -> Column:
    """The second and further rows of a name get -2, -3, .. before the extension."""
    k = F.row_number().over(Window.partitionBy(name).orderBy(*order))
    numbered = F.concat(F.regexp_replace(F.col(name), r"\.[^.]+$", ""), F.lit("-"), k.cast("string"), F.regexp_extract(F.col(name), r"(\.[^.]+)?$", 0))
    return F.when(k == 1, F.col(name)).otherwise(numbered)


def size_chunks(pages: Column, most: int) -> Column:
    """Greedy chunks of an ordered array of texts: a chunk closes when one more text would pass `most` characters."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, page: Column) -> Column:
        full = (acc["open"] != "") & (F.length(acc["open"]) + F.length(page) > most)
        return F.struct(F.when(full, F.array_append(acc["done"], acc["open"])).otherwise(acc["done"]).alias("done"), F.when(full, page).otherwise(F.concat(acc["open"], page)).alias("open"))

    return F.aggregate(pages, start, step, lambda a: F.when(a["open"] != "", F.array_append(a["done"], a["open"])).otherwise(a["done"]))
