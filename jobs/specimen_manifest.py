"""Build the specimen manifest of a project's tables, and how much of it is named and linked, by site and year.

    python -m jobs.specimen_manifest --tables PATH --out PATH [--config FILE]

tables is a folder of Parquet tables; the settings say which table each input is, which of its rows count, and the SQL
expression of each column that the manifest needs. Inputs: determinations (individualID and the columns of a
determination), experts (their identifications), plots (surroundings), records (a repository's, by individual).

out/manifest, partitioned by year: a row for each individual with its best identification, surroundings and repository
record. out/coverage, partitioned by year: of each site, individuals that are named, named by an expert, held by a
repository and photographed.

Reruns: both outputs are replaced whole, by rows that depend on the inputs alone, so a run that failed is just run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobs.common import command_line, log, read_config
from taxaflow.plans import specimens

#: Columns that a determination, an expert's identification, a plot and a record have at least.
NEEDED = {
    "determinations": ("individualID", "identifiedDate", "collectDate", "plotID", "siteID"), "experts": ("individualID", "identifiedDate", "scientificName"),
    "plots": ("plotID", "nlcdClass", "decimalLatitude", "decimalLongitude", "elevation", "collectDate"), "records": ("individualID", "collection", "catalogNumber", "occid", "n_images"),
}


def read_input(spark: SparkSession, tables: str, name: str, given: dict) -> DataFrame:
    """An input's rows and columns, as the settings state them; Spark reads only what they name."""
    if missing := set(NEEDED[name]) - given["columns"].keys():
        raise ValueError(f"{name} lacks {', '.join(sorted(missing))}")
    rows = spark.read.parquet(f"{tables}/{given['table']}.parquet")
    if given.get("where"):
        rows = rows.where(given["where"])
    return rows.select(*[F.expr(sql).alias(column) for column, sql in given["columns"].items()])


def coverage(manifest: DataFrame) -> DataFrame:
    """Individuals of each site and year, and how many of them are named, and so on."""
    return manifest.groupBy("siteID", "year").agg(
        F.count("*").alias("individuals"), F.count("bestScientificName").alias("named"), F.count_if(F.col("idSource") == "expert").alias("by_expert"),
        F.count_if("in_biorepository").alias("held"), F.count_if(F.col("biorepo_n_images") > 0).alias("photographed"),
    )


def run(spark: SparkSession, tables: str, out: str, config: str | None = None) -> DataFrame:
    """Build and write both outputs, and return the manifest as it was written."""
    inputs = read_config(spark, config, "specimen_manifest.json")["inputs"]
    seen = {name: Observation() for name in NEEDED}  # rows are counted as they pass, not by scans of their own
    read = {name: read_input(spark, tables, name, inputs[name]).observe(o, F.count(F.lit(1)).alias("rows")) for name, o in seen.items()}
    # an individual without an id cannot be told from another
    known = read["determinations"].filter("individualID IS NOT NULL")
    named = specimens.specimen_manifest(known, read["experts"], read["plots"])
    linked = specimens.link_repository(named, read["records"])
    # year as a partition's name; rows of one year go to few files, of a size that adaptive execution chooses
    linked.hint("rebalance", F.col("year")).write.mode("overwrite").partitionBy("year").parquet(f"{out}/manifest")
    for name, o in seen.items():
        log.info("read %s of %s/%s.parquet: %s rows", name, tables, inputs[name]["table"], o.get["rows"])
    manifest = spark.read.parquet(f"{out}/manifest")
    coverage(manifest).hint("rebalance", F.col("year")).write.mode("overwrite").partitionBy("year").parquet(f"{out}/coverage")
    log.info("wrote %s/manifest: %d rows; %s/coverage: %d rows", out, manifest.count(), out, spark.read.parquet(f"{out}/coverage").count())
    return manifest


def main(argv: Sequence[str] | None = None) -> None:
    command_line("specimen manifest", ("tables", "out"), lambda spark, a: run(spark, a.tables, a.out, a.config), argv)


if __name__ == "__main__":
    main()
