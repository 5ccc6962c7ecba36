"""Publication: catalog tables, comments, views, provenance, exports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_catalog(tables: Mapping[str, DataFrame], descriptions: Mapping[str, str] | None = None, source: str = "") -> DataFrame:
    """(name, rows, description, source) of each table; counts come from the files' footers where they can."""
    text = descriptions or {}
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows", F.lit(text.get(n)).cast("string").alias("description"), F.lit(source).alias("source")) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _lit(value: str) -> str:
    """A SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish(spark: SparkSession, database: str, tables: Mapping[str, DataFrame], comments: Mapping[str, str] | None = None, column_notes: Iterable[tuple[str, str, str, str, str]] = ()) -> DataFrame:
    """Create or replace catalog tables with comments, and return their catalog.

    column_notes: (table, column, note, curie, unit curie); notes on columns that a table lacks are ignored. A
    column's comment is "note [curie; unit curie]" with what there is of these.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
        if comment := (comments or {}).get(name):
            spark.sql(f"COMMENT ON TABLE {database}.{name} IS {_lit(comment)}")
    for table, column, note, curie, unit in column_notes:
        if table in tables and column in tables[table].columns:
            tags = "; ".join(x for x in (curie, f"unit {unit}" if unit else "") if x)
            said = " ".join(x for x in (note, f"[{tags}]" if tags else "") if x)
            spark.sql(f"ALTER TABLE {database}.{table} ALTER COLUMN `{column}` COMMENT {_lit(said)}")
    catalog = table_catalog({n: spark.table(f"{database}.{n}") for n in tables}, comments)
    catalog.write.mode("overwrite").saveAsTable(f"{database}.table_catalog")
    return spark.table(f"{database}.table_catalog")


def replace_view(spark: SparkSession, name: str, sql: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")


def provenance(spark: SparkSession, facts: Iterable[tuple[str, str, str, str]]) -> DataFrame:
    """(kind, name, value, detail) facts of a run: code, packages, models, datasets, and builds in place of snapshots."""
    return spark.createDataFrame(list(facts), "kind string, name string, value string, detail string")


def export_csv(df: DataFrame, path: str, drop: Iterable[str] = ()) -> list[str]:
    """Write CSV without the named columns and without those that are all null; returns the columns written."""
    kept = df.drop(*drop)
    filled = kept.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in kept.columns]).first()
    columns = [c for c in kept.columns if filled[c]]
    kept.select(*[F.col(f"`{c}`") for c in columns]).write.mode("overwrite").option("header", True).csv(path)
    return columns


def schema_document(tables: Mapping[str, DataFrame], notes: Mapping[tuple[str, str], str] | None = None) -> str:
    """A Markdown section for each table with its columns, types and notes."""
    lines = []
    for name, df in tables.items():
        lines += [f"## {name}", "", "| column | type | note |", "|---|---|---|"]
        lines += [f"| {f.name} | {f.dataType.simpleString()} | {(notes or {}).get((name, f.name), '')} |" for f in df.schema]
        lines.append("")
    return "\n".join(lines)
