"""Listings of documents: HTML tables read by their header row, and the plan of what to fetch under which name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordweave.functions import names as N
from recordweave.functions import text as T
from recordweave.operators import joins as J
from recordweave.operators import ordering as R

c = F.col
TABLE, ROW, CELL = r"(?is)<table\b[^>]*>(.*?)</table\s*>", r"(?is)<tr\b[^>]*>(.*?)</tr\s*>", r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]\s*>"
HREF = r"(?is)<a\s[^>]*href=\"([^\"]*)\""
#: Regions as listings name them.
REGIONS = {
    "northern region": "Northern Region", "western region": "Western Region", "southern region": "Southern Region", "eastern region": "Eastern Region",
    "north eastern region": "North Eastern Region", "north-eastern region": "North Eastern Region",
}
TYPES = ("Notice", "Agenda", "Minutes")


def place(header: Column, fits, default: int) -> Column:
    """Place of the first header cell that fits, else the default."""
    at = F.filter(F.transform(header, lambda x, i: F.when(fits(x), i)), lambda i: i.isNotNull())
    return F.coalesce(F.get(at, 0), F.lit(default))


def cell_text(x: Column) -> Column:
    return F.lower(F.trim(N.strip_tags(F.coalesce(x, F.lit("")))))


def listed(pages: DataFrame, root: str, path: str) -> DataFrame:
    """(page_id, row_no, pos, region, doc_type, url) of the links in a listing's first table, all in one projection.

    The first row tells which cells are the region and the kinds of document. Rows without a known region, and links
    outside `path`, go; addresses without a host get `root`.
    """
    rows = T.all_groups(T.first_group(c("html"), TABLE), ROW, 1)
    cells = pages.select("page_id", rows.alias("rows")).filter(F.size("rows") > 1)
    cells = cells.withColumn("header", F.transform(T.all_groups(F.get("rows", 0), CELL, 1), cell_text))
    cells = cells.select("page_id", "header", F.posexplode(F.slice("rows", 2, 1_000_000)).alias("row_no", "row")).withColumn("cells", T.all_groups(c("row"), CELL, 1))
    known = F.create_map(*[F.lit(x) for kv in REGIONS.items() for x in kv])
    region = F.try_element_at(known, cell_text(F.get("cells", place(c("header"), lambda x: x == "region", 3))))
    kinds = {"Notice": (lambda x: x.contains("notice"), 4), "Agenda": (lambda x: x.contains("agenda"), 5), "Minutes": (lambda x: x.isin("minutes", "mom"), 6)}

    def found(kind: str) -> Column:
        links = T.all_groups(F.coalesce(F.get("cells", place(c("header"), *kinds[kind])), F.lit("")), HREF, 1)
        wanted = F.filter(F.transform(links, F.trim), lambda x: F.lower(x).contains(path))
        return F.transform(wanted, lambda x: F.struct(F.lit(kind).alias("doc_type"), F.when(x.startswith("http"), x).otherwise(F.concat(F.lit(root), x)).alias("url")))

    out = cells.withColumn("region", region).filter("region is not null")
    return out.select("page_id", "row_no", "region", F.posexplode(F.flatten(F.array(*map(found, TYPES)))).alias("pos", "link")).select("page_id", "row_no", "pos", "region", "link.*")


def crawl_plan(links: DataFrame, held: DataFrame, kinds: tuple[str, ...] = ("Agenda", "Minutes"), most: int = -1) -> DataFrame:
    """(doc_type, region, n, name, url, action): each address once, numbered within its kind and region, against what is held.

    held has (url, held_n). An address counts where it is first listed, whatever its kind; at most `most` of a kind and
    region are planned (-1: all). Numbers are given across tasks, as a region can have any share of all links.
    """
    first = R.first_per(links, ["url"], ["page_id", "row_no", "pos"]).filter(c("doc_type").isin(*kinds))
    numbered = R.global_number(first, ["doc_type", "region"], ["page_id", "row_no", "pos"])
    if most >= 0:
        numbered = numbered.filter(c("n") <= most)
    file = N.url_file_name(c("url"))
    name = F.concat(F.lpad(c("n").cast("string"), 2, "0"), F.lit("_"), N.meeting_label(N.stem_of(file)), N.extension_of(file))
    name = F.when(c("n") > 99, F.concat(c("n").cast("string"), F.lit("_"), N.meeting_label(N.stem_of(file)), N.extension_of(file))).otherwise(name)
    planned = numbered.select("doc_type", "region", c("n").cast("long").alias("n"), name.alias("name"), "url")
    return J.listing_diff(planned, held, ["url"], "n", "held_n")
