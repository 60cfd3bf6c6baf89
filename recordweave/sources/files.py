"""Readers and writers: JSON caches, file discovery, flat reports, tables on stored pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordweave.operators.ordering import carry_last, group_number


def read_json_cache(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Whole-file JSON with an explicit schema and the file's name; unreadable files give a row of nulls that goes."""
    df = spark.read.schema(schema + ", _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(folder)
    return df.withColumn("file_name", F.col("_metadata.file_name")).filter("_corrupt is null").drop("_corrupt")


def write_json_cache(df: DataFrame, folder: str, by: str = "source_pdf") -> None:
    """One folder for each document; a second run replaces only the documents it holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).json(folder)


def discover(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """Path, size and time of all files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path", "length", "modificationTime")


def report(parts: list[DataFrame], order: list[str] | None = None) -> DataFrame:
    """Rows of all parts under the given columns, else under all of them as first seen; missing values are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    if order:
        out = out.select(*[F.col(x) if x in out.columns else F.lit(None).cast("string").alias(x) for x in order])
    return out


def write_report(df: DataFrame, path: str, names: dict[str, str] | None = None) -> None:
    """CSV with display names; columns keep plain names until here."""
    df.select(*[F.col(x).alias((names or {}).get(x, x)) for x in df.columns]).write.mode("overwrite").option("header", True).csv(path)


def read_rows(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of a cache of one folder a document (with the folders' column); lines that are no JSON go."""
    df = spark.read.schema(schema + ", _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(folder)
    return df.filter("_corrupt is null").drop("_corrupt")


def add_to_cache(df: DataFrame, folder: str, by: str = "source_pdf") -> None:
    """Write the documents that the cache does not hold; those that it holds stay as they are, unread."""
    held = discover(df.sparkSession, folder, "*.json").select(F.url_decode(F.regexp_extract("path", f"{by}=([^/]*)/", 1)).alias(by)).distinct()
    write_json_cache(df.join(held, by, "left_anti"), folder, by)


def write_observed(records: DataFrame, statistics: list[Column], folder: str, columns: list[str] | None = None) -> DataFrame:
    """Write records (all columns, or these) and, beside them, statistics taken while they are written: one pass over the data."""
    seen = Observation()
    records.observe(seen, *statistics).select(columns or records.columns).write.mode("overwrite").json(f"{folder}/records")
    names = records.agg(*statistics).schema
    stats = records.sparkSession.createDataFrame([tuple(seen.get[f.name] for f in names)], names)
    stats.coalesce(1).write.mode("overwrite").json(f"{folder}/stats")
    return records.sparkSession.read.schema(names).json(f"{folder}/stats")


def write_with_stats(records: DataFrame, stats: DataFrame, folder: str) -> None:
    records.write.mode("overwrite").json(f"{folder}/records")
    stats.write.mode("overwrite").json(f"{folder}/stats")


def links(pages: DataFrame) -> DataFrame:
    """(page_id, url, pos, href, label): the anchors of stored pages, in page order."""
    anchors = F.regexp_extract_all("html", F.lit(r'(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>'), F.lit(0))
    rows = pages.select("page_id", "url", F.posexplode(anchors).alias("pos", "a"))
    label = F.trim(F.regexp_replace(F.regexp_replace("a", r"<[^>]+>", " "), r"\s+", " "))
    return rows.select("page_id", "url", "pos", F.regexp_extract("a", r'(?i)href="([^"]*)"', 1).alias("href"), label.alias("label"))


def sectioned_links(pages: DataFrame) -> DataFrame:
    """(page_id, url, pos, href, label, section): the links with the text of the last heading above each."""
    found = F.regexp_extract_all("html", F.lit(r'(?is)<h[1-6][^>]*>.*?</h[1-6]>|<a\s[^>]*href="[^"]*"[^>]*>.*?</a>'), F.lit(0))
    rows = pages.select("page_id", "url", F.posexplode(found).alias("at", "m"))
    text = F.trim(F.regexp_replace(F.regexp_replace("m", r"<[^>]+>", " "), r"\s+", " "))
    is_link = F.lower(F.substring("m", 2, 1)) == "a"
    rows = rows.select("page_id", "url", "at", is_link.alias("is_link"), F.regexp_extract("m", r'(?i)href="([^"]*)"', 1).alias("href"), text.alias("label"))
    rows = rows.withColumns({"section": carry_last(F.when(~F.col("is_link"), F.col("label")), ["page_id"], ["at"]), "pos": group_number(F.col("is_link"), ["page_id"], ["at"]).cast("int") - 1})
    return rows.filter("is_link").drop("is_link", "at")


def keep_links(links: DataFrame, path: str | None = None, suffix: str | None = r"\.pdf", label: str | None = None, section: str | None = None) -> DataFrame:
    """Links whose address has a path fragment and ends (before ? or #) in a suffix pattern, with these words in label and section."""
    low = F.lower("href")
    if path:
        links = links.filter(low.contains(path.lower()))
    if suffix:
        links = links.filter(low.rlike(rf"^[^?#]*{suffix}([?#]|$)"))
    if label:
        links = links.filter(F.lower("label").contains(label.lower()))
    return links.filter(F.lower("section").contains(section.lower())) if section else links


def serialised(names: dict[str, str], meta: dict[str, Column] | None = None) -> Column:
    """A row as JSON under display names, with values of its document as `meeting_meta`; nulls are written."""
    parts = [F.col(k).alias(v) for k, v in names.items()]
    if meta:
        parts.append(F.struct(*[v.alias(k) for k, v in meta.items()]).alias("meeting_meta"))
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})
