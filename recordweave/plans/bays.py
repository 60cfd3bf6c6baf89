"""Bay tables: row kinds, substation groups, inherited headers, allocation entries, and the mapping of bays to names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordweave.functions import text as T
from recordweave.functions.numbers import is_number_like
from recordweave.operators import joins as J
from recordweave.operators import ordering as R

c = F.col
#: Cells of a substation that later rows of its group inherit, and those of each voltage.
HEADER = ["sl_no", "name_of_substation", "substation_coordinates", "region", "capacity_planned_mva", "capacity_existing_mva", "capacity_under_implementation_mva"]
VOLTAGE_CELLS = ["bay_no", "quantum", "name_of_entity", "margin_bay_no", "margin"]
BY_VOLTAGE = [f"{x}_{v}kv" for v in ("220", "400") for x in VOLTAGE_CELLS]
CELLS = HEADER + BY_VOLTAGE + ["space_provision_220kv", "space_provision_400kv", "remarks"]
PAGE, ORDER = ["source_pdf", "page_number"], ["row_idx"]
TARGET_HEADERS = ("sl", "substation", "coordinates", "bay", "entity", "margin")


def cells() -> Column:
    return F.array(*[T.squeeze(c(x)) for x in CELLS])


def filled(row: Column) -> Column:
    return F.filter(row, lambda x: x != "")


def named(row: Column, names: list[str]) -> list[Column]:
    """Positional cells as columns, padded with '' or trimmed to the names."""
    return [F.coalesce(F.get(row, i), F.lit("")).alias(n) for i, n in enumerate(names)]


def is_section_text(x: Column) -> Column:
    return x.rlike(r"(?i)^section[\s\-]*[a-z]")


def is_section(row: Column) -> Column:
    return (F.size(filled(row)) == 1) & is_section_text(F.get(filled(row), 0))


def is_total(row: Column) -> Column:
    return (F.size(filled(row)) == 1) & F.regexp_replace(F.get(filled(row), 0), ",", "").try_cast("double").isNotNull()


def is_sub_header(row: Column) -> Column:
    return (F.size(filled(row)) > 0) & F.forall(filled(row), lambda x: F.lower(x).rlike(r"^\d{3}\s*kv$|bay no|connectivity quantum|name of entity"))


def is_inline_header(row: Column) -> Column:
    return F.lower(F.array_join(row, " ")).rlike("application|sl\\. no|si no")


def is_target_table(header: Column, least: int = 3) -> Column:
    """Whether a header has enough of the words, with or without what stands between its letters."""
    low, tight = F.lower(header), T.compact(header)
    return sum(((low.contains(h) | tight.contains(h)).cast("int") for h in TARGET_HEADERS), F.lit(0)) >= least


def first_target_tables(rows: DataFrame, by: list[str], leading: int = 3) -> DataFrame:
    """Per page the first table, of two rows or more, whose leading rows together are a target header.

    rows: `by`, table_no, row_idx (from 0 in a table), cells (array). Only leading rows are gathered.
    """
    table = [*by, "table_no"]
    head = F.array_sort(F.collect_list(F.when(c("row_idx") < leading, F.struct("row_idx", F.array_join(F.transform("cells", T.squeeze), " ").alias("text")))))
    tables = rows.groupBy(*table).agg(F.array_join(F.transform(head, lambda x: x["text"]), " ").alias("header"), F.count("*").alias("n_rows"))
    return tables.filter((c("n_rows") >= 2) & is_target_table(c("header"))).groupBy(*by).agg(F.min_by(F.struct("table_no", "n_rows"), "table_no").alias("t")).select(*by, "t.*")


def has_data() -> Column:
    """Whether any of the ten cells of both voltages is filled; a section's name in a bay cell is no bay."""
    shown = lambda x: F.when(is_section_text(c(x)), F.lit("")).otherwise(c(x)) if x.startswith("bay_no") else c(x)
    return J.any_of([F.coalesce(F.trim(shown(x)) != "", F.lit(False)) for x in BY_VOLTAGE])


def starts_group() -> Column:
    return is_number_like(c("sl_no")) | ((c("name_of_substation") != "") & (c("substation_coordinates") != ""))


def parse(rows: DataFrame) -> DataFrame:
    """Rows with section, substation group (0: before any start) and the header values their group has shown so far."""
    grouped = rows.withColumns({"section": R.carry_last(F.when(is_section_text(c("bay_no_220kv")), c("bay_no_220kv")), PAGE, ORDER), "group_no": R.group_number(starts_group(), PAGE, ORDER)})
    by = [*PAGE, "group_no"]
    fill = {f"{x}_filled": R.carry_first(T.none_if_empty(c(x)), by, ORDER) for x in HEADER}
    return grouped.withColumns(fill)


def records(parsed: DataFrame) -> DataFrame:
    """Data rows with all cells, page, place and section; empty header cells are filled from the row's substation."""
    filled_ = [F.coalesce(T.none_if_empty(c(x)), c(f"{x}_filled"), F.lit("")).alias(x) for x in HEADER]
    return parsed.filter(has_data()).select(*PAGE, "row_idx", "section", *filled_, *CELLS[len(HEADER) :])


def entries(parsed: DataFrame) -> DataFrame:
    """One row for each bay of a data row: voltage, quantum, entity, margins and the inherited substation, with its search fields."""

    def side(v: str) -> Column:
        of = lambda x: c(f"{x}_{v}kv")
        bay = F.when(is_section_text(of("bay_no")), F.lit("")).otherwise(of("bay_no"))
        return F.struct(F.lit(f"{v}kv").alias("voltage_key"), F.lit(f"{v} kV").alias("voltage"), bay.alias("bay_no"), of("quantum").alias("connectivity_quantum_mw"), of("name_of_entity").alias("entity_name"), of("margin_bay_no").alias("margin_bay_no"), of("margin").alias("margin_available_mw"), of("space_provision").alias("space_provision"))

    held = [*[c(f"{x}_filled").alias(x) for x in ("name_of_substation", "substation_coordinates", "region", "sl_no")], c("remarks")]
    out = parsed.filter(has_data()).withColumn("e", F.explode(F.array(side("220"), side("400")))).select(*PAGE, "row_idx", "group_no", "section", *held, "e.*").filter("bay_no <> ''")
    search = F.struct(c("entity_name").alias("entity"), c("name_of_substation").alias("substation"), c("substation_coordinates").alias("coordinates"), "voltage", "connectivity_quantum_mw", "bay_no")
    return out.withColumns({"entities": entities(c("entity_name")), "search_fields": search})


def lookup(found: DataFrame) -> DataFrame:
    """Per group, voltage and bay: the last entity at the first place; entries without an entity go."""
    by = [*PAGE, "group_no", "voltage_key", "bay_no"]
    return (
        found.filter("bay_no <> ''").groupBy(*by)
        .agg(F.max_by("entity_name", "row_idx").alias("entity_name"), F.min("row_idx").alias("pos"), F.min("name_of_substation").alias("name_of_substation"), F.min("substation_coordinates").alias("substation_coordinates"))
        .filter("entity_name <> ''")
    )


def bay_text(found: DataFrame) -> DataFrame:
    """`bay: entity | bay: entity` of each group and voltage, in order of place."""
    pairs = F.array_sort(F.collect_list(F.struct("pos", "bay_no", "entity_name")))
    return found.groupBy(*PAGE, "group_no", "voltage_key").agg(F.array_join(F.transform(pairs, lambda x: F.concat(x["bay_no"], F.lit(": "), x["entity_name"])), " | ").alias("bays"))


def entities(cell: Column) -> Column:
    """(name, raw, capacity) of each entity of a cell: parts at `;` and at ` + ` before a capital."""
    parts = F.filter(F.transform(F.split(cell, r";|\s+\+\s+(?=[A-Z])"), lambda x: F.trim(x)), lambda x: x != "")
    return F.transform(parts, lambda x: F.struct(T.without_parentheses(x).alias("name"), x.alias("raw"), T.first_group(x, r"\(([^)]*\d[^)]*)\)").alias("capacity")))


def route(existing_bay: Column, coordinates: Column, coordination_bay: Column, voltage_key: Column, developer: Column) -> Column:
    """What a row needs: its coordination bay, nothing, or the search by voltage and name."""
    return (
        F.when(~T.is_blank(coordination_bay), "coordination")
        .when(~T.is_blank(coordinates), "has_coordinates")
        .when(~T.is_blank(existing_bay) & ~T.is_single_digit(existing_bay), "has_bay")
        .when(voltage_key.isNull(), "no_voltage")
        .when(T.is_blank(developer), "no_developer")
        .otherwise("search")
    )


def join_distinct(value: str, order: list[str]) -> Column:
    """Distinct non-empty values in order of their place, joined."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(*order, value))), lambda x: x[value])
    return F.array_join(F.array_distinct(F.filter(listed, lambda x: F.coalesce(x != "", F.lit(False)))), " | ")


def map_bays(rows: DataFrame, found: DataFrame, blocked: bool = True) -> DataFrame:
    """rows (row_id, developer, voltage_key, route and coordination_bay) with bay numbers, substations and their source."""
    hits = J.name_join(rows.filter("route = 'search'").select("row_id", "developer", "voltage_key"), found, blocked)
    order = ["page_number", "pos"]
    first = hits.withColumn("k", F.row_number().over(Window.partitionBy("row_id", "bay_no").orderBy(*order, "group_no"))).filter("k = 1")
    made = first.groupBy("row_id").agg(join_distinct("bay_no", order).alias("found_bays"), join_distinct("name_of_substation", order).alias("substations"), join_distinct("substation_coordinates", order).alias("coordinates"))
    out = rows.join(made, "row_id", "left")
    own = c("route") == "coordination"
    return out.withColumns({"bay_no": F.when(own, F.trim("coordination_bay")).otherwise(c("found_bays")), "bay_source": F.when(own, "coordination").when(c("found_bays").isNotNull(), "bay table")})
