"""Writers of the formats that people read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pipe_rows(columns: list[str]) -> Column:
    """A row of a pipe table; bars in cells are escaped and line ends become blanks."""
    cell = lambda c: F.replace(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[\r\n]+", " "), F.lit("|"), F.lit("\\|"))
    return F.concat(F.lit("| "), F.concat_ws(" | ", *(cell(c) for c in columns)), F.lit(" |"))


def pipe_table(df: DataFrame, group: str, columns: list[str], order: str) -> DataFrame:
    """group, markdown: one table for each group, rows by `order`. For reports: a group is one text."""
    head = "| " + " | ".join(columns) + " |\n|" + "---|" * len(columns) + "\n"
    rows = df.select(group, F.struct(F.col(order).alias("o"), pipe_rows(columns).alias("r")).alias("x"))
    return rows.groupBy(group).agg(F.concat(F.lit(head), F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["r"]), "\n")).alias("markdown"))


def bibtex(key: Column, kind: Column, fields: dict[str, Column]) -> Column:
    """An entry with its non-blank fields, braces and special characters escaped."""
    escaped = lambda c: F.regexp_replace(c.cast("string"), r"([&%#_])", r"\\$1")
    lines = [F.when(F.coalesce(F.trim(c.cast("string")), F.lit("")) != "", F.concat(F.lit(f"  {name} = {{"), escaped(c), F.lit("}"))) for name, c in fields.items()]
    return F.concat(F.lit("@"), kind, F.lit("{"), key, F.lit(",\n"), F.array_join(F.array_compact(F.array(*lines)), ",\n"), F.lit("\n}"))


def bibtex_keys(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"@\w+\{([^,\s]+),"), F.lit(1))


def write_json(df: DataFrame, folder: str) -> None:
    """Whole or not at all, by Spark's commit."""
    df.write.mode("overwrite").json(folder)


def append_log(df: DataFrame, folder: str) -> None:
    df.write.mode("append").json(folder)
