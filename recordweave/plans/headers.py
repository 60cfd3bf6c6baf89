"""Tables read by their headers: each header row maps columns to fields until the next one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordweave.functions import text as T
from recordweave.operators import ordering as R

#: Header texts and their fields, in the order in which they are tried.
HEADERS = {
    "si no": "sl_no", "sl. no.": "sl_no", "sl no": "sl_no", "application id": "application_id", "name of applicant": "name_of_applicant", "region": "region", "type of project": "type_of_project",
    "installed capacity (mw)": "installed_capacity_mw", "installed capacity": "installed_capacity_mw", "solar": "solar_mw", "wind": "wind_mw", "ess": "ess_mw", "hydro": "hydro_mw",
    "connectivity (mw)": "connectivity_mw", "connectivity": "connectivity_mw", "present connectivity /deemed gna": "present_connectivity_mw", "present connectivity": "present_connectivity_mw",
    "substation": "substation", "state": "state", "expected date of connectivity/ gna to be made effective": "expected_date", "expected date of connectivity/gna to be made effective": "expected_date", "expected date": "expected_date",
}
FIELDS = tuple(dict.fromkeys(HEADERS.values()))


def is_header(cells: Column) -> Column:
    return F.lower(F.array_join(cells, " ", "")).rlike(r"application|sl\. no|si no")


def field_of(header: Column) -> Column:
    """The field of a header text: an exact match, else the first known text that it contains."""
    key = F.lower(T.squeeze(header))
    exact = reduce(lambda w, kv: w.when(key == kv[0], kv[1]), list(HEADERS.items())[1:], F.when(key == next(iter(HEADERS)), HEADERS[next(iter(HEADERS))]))
    part = reduce(lambda w, kv: w.when(key.contains(kv[0]), kv[1]), list(HEADERS.items())[1:], F.when(key.contains(next(iter(HEADERS))), HEADERS[next(iter(HEADERS))]))
    return F.coalesce(exact, part)


def records(rows: DataFrame, cells: str, by: list[str], order: list[str]) -> DataFrame:
    """rows with a column for each field, from the cells under the last header row above, also of an earlier page.

    Header rows, rows above any header and rows without an application or an applicant go. Of several columns with
    one field the last that a row has counts. `by` is the document, `order` the order of its rows.
    """
    header = is_header(F.col(cells))
    mapped = rows.withColumn("fields_", R.carry_last(F.when(header, F.transform(cells, field_of)), by, order)).filter(~header)
    value = lambda f: F.try_element_at(F.filter(F.col(cells), lambda x, i: F.get("fields_", i) == f), F.lit(-1))
    found = mapped.filter("fields_ is not null").select(*rows.columns, *[value(f).alias(f) for f in FIELDS])
    return found.filter((F.coalesce("application_id", F.lit("")) != "") | (F.coalesce("name_of_applicant", F.lit("")) != ""))
