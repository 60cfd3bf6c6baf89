"""Run ledger: append-only events, and the state that follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordweave.operators.ordering import first_per

c = F.col


def latest(events: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last event of each key."""
    return first_per(events, key, [F.desc(x) for x in order])


def started(events: DataFrame, keys: DataFrame, order: str) -> DataFrame:
    """events with one `pending` event for each of keys (one column set, new ones only), after all that are there."""
    return _appended(events, keys.join(events.select(keys.columns).distinct(), keys.columns, "left_anti"), order, F.lit("pending"))


def finished(events: DataFrame, results: DataFrame, order: str) -> DataFrame:
    """events with one `completed` or `failed` event for each of results, by its boolean column `ok`."""
    return _appended(events, results, order, F.when(c("ok"), "completed").otherwise("failed"))


def _appended(events: DataFrame, rows: DataFrame, order: str, status: Column) -> DataFrame:
    last = events.agg(F.coalesce(F.max(order), F.lit(0)).alias("last_"))
    new = rows.withColumn("status", status).crossJoin(F.broadcast(last)).withColumn(order, c("last_") + 1).drop("last_", "ok")
    return events.unionByName(new, allowMissingColumns=True)


def lifecycle(events: DataFrame, key: list[str], order: str) -> DataFrame:
    """Per key its state, events and failures: pending when registered, in_progress when taken up again, completed or failed."""
    out = events.groupBy(*key).agg(
        F.max_by("status", order).alias("last_"), F.count("*").alias("events"), F.count_if(c("status") == "failed").alias("failures"), F.min(order).alias("registered_at"),
        F.max(F.when(c("status") == "completed", c(order))).alias("completed_at"),
    )
    state = F.when((c("last_") == "pending") & (c("events") > 1), "in_progress").otherwise(c("last_"))
    return out.withColumns({"state": state, "is_extracted": c("last_") == "completed"}).drop("last_")


def record_key(gna: Column, lta: Column, handler: Column, pdf: Column) -> Column:
    part = lambda x, default: F.coalesce(F.nullif(F.trim(x), F.lit("")), F.lit(default))
    return F.concat_ws("::", part(gna, "UNKNOWN"), part(lta, "NO_LTA"), handler, pdf)


def exports(events: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Latest export of each key; more than one makes it `regenerated`."""
    n = F.count("*").over(Window.partitionBy(*key))
    return latest(events.withColumn("n_", n), key, order).withColumn("state", F.when(c("n_") > 1, "regenerated").otherwise("generated")).drop("n_")


def handler_status(events: DataFrame) -> DataFrame:
    """Per handler: files, completed, pending, failed (by latest state) and events."""
    state = latest(events, ["handler", "pdf_name"], ["seq"])
    n = events.groupBy("handler").agg(F.count("*").alias("events"))
    counts = state.groupBy("handler").agg(F.count("*").alias("files"), *[F.count_if(c("status") == s).alias(s) for s in ("completed", "pending", "failed")])
    return counts.join(n, "handler")


def run_totals(events: DataFrame, run: Column) -> DataFrame:
    """Per run: files first seen in it, files completed, handlers whose exports a completion makes new, and events."""
    file = F.struct("handler", "pdf_name")
    first = events.groupBy("handler", "pdf_name").agg(F.min_by(run, c("seq")).alias("run")).groupBy("run").agg(F.count("*").alias("downloaded"))
    done = c("status") == "completed"
    own = events.groupBy(run.alias("run")).agg(F.count_distinct(F.when(done, file)).alias("extracted"), F.count_distinct(F.when(done, c("handler"))).alias("exports"), F.count("*").alias("records"))
    return own.join(first, "run", "left").select("run", F.coalesce("downloaded", F.lit(0)).alias("downloaded"), "extracted", "exports", "records")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


def export_rows(records: DataFrame, handler: str | None = None) -> DataFrame:
    """Records with their JSON payload as a map; payloads that are no JSON objects become empty."""
    rows = records if handler is None else records.filter(c("handler") == handler)
    return rows.withColumn("data", F.coalesce(F.from_json("data_json", "map<string,string>"), F.create_map().cast("map<string,string>")))
