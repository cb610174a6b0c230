"""Tables inside nested JSON: lists of objects at any depth that have the wanted fields, found and read as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


def find_tables(docs: DataFrame, id_col: str, json_col: str, required: Sequence[str], excluded: Sequence[str] = ()) -> DataFrame:
    """(id, path, n_rows, rows) of all lists in the JSON texts whose first element is an object with every required field and no excluded one.

    ``rows`` are the list's elements as variants. Texts are parsed once; each round opens the objects and lists of one more depth
    and drops all other values, so a round reads what is nested deeper than the one before. Text that is no JSON, null and empty
    have no tables; a field whose value is null is there. Elements that are lists or objects are opened too, so tables within tables are found.
    """
    inside = checkpointed(docs.select(F.col(id_col).alias("id"), F.lit("$").alias("path"), F.try_parse_json(F.col(json_col)).alias("v")).filter(F.col("v").isNotNull()))
    found = None
    as_list, as_object = (lambda v, kind=kind: F.try_variant_get(v, "$", kind) for kind in ("array<variant>", "map<string,variant>"))
    while True:
        opened = inside.withColumns({"items": as_list(F.col("v")), "fields": as_object(F.col("v"))}).filter("items is not null or fields is not null").drop("v")
        first = F.map_keys(as_object(F.try_element_at("items", F.lit(1))))
        has = F.size(F.array_intersect(first, F.array(*map(F.lit, required)))) == len(set(required)) if required else F.lit(True)
        lacks = F.size(F.array_intersect(first, F.array(*map(F.lit, excluded)))) == 0 if excluded else F.lit(True)
        tables = opened.filter(first.isNotNull() & has & lacks).select("id", "path", F.size("items").cast("long").alias("n_rows"), F.col("items").alias("rows"))
        found = tables if found is None else found.unionByName(tables)
        by_place = opened.filter("items is not null").select("id", "path", F.posexplode("items").alias("p", "v")).select("id", F.concat("path", F.lit("["), F.col("p").cast("string"), F.lit("]")).alias("path"), "v")
        by_name = opened.filter("fields is not null").select("id", "path", F.explode("fields").alias("k", "v")).select("id", F.concat("path", F.lit("."), "k").alias("path"), "v")
        deeper = by_place.unionByName(by_name)
        inside = checkpointed(deeper.filter(as_list(F.col("v")).isNotNull() | as_object(F.col("v")).isNotNull()))
        if inside.isEmpty():
            return found


def largest_tables(tables: DataFrame) -> DataFrame:
    """Of each id the table with the most rows; of several, the first by path. Partial cut-outs of a table are passed over this way."""
    best = tables.groupBy("id").agg(F.min(F.struct((-F.col("n_rows")).alias("less"), "path"))["path"].alias("path"))
    return tables.join(best, ["id", "path"])


def table_rows(tables: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """(id, path, row, columns): the rows of found tables, typed. ``columns`` maps a name to (field, type); a value that can't be cast is null."""
    each = tables.select("id", "path", F.posexplode("rows").alias("row", "v"))
    return each.select("id", "path", "row", *[F.try_variant_get("v", f"$['{field}']", kind).alias(n) for n, (field, kind) in columns.items()])
