"""Specimen and sample tables: best identification, links to repository records, preserved samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.functions import text
from taxaflow.operators import linkage, selection, shaping

#: Groups of sample types, and the order of collections that an individual's records are taken from.
GROUPS = {"carabid": "bulk carabid", "other carabid": "bulk carabid", "invert bycatch": "invertebrate bycatch", "vert bycatch herp": "herptile bycatch", "vert bycatch mam": "mammal bycatch"}
VOUCHERS = ["CARC-PV", "DCTC"]
#: Labels of identifiers in otherCatalogNumbers.
IDENTIFIERS = {"NEON sampleID": "neon_sampleID", "NEON sampleID Hash": "neon_sampleID_hash", "NEON sampleCode (barcode)": "neon_barcode", "NEON sampleUUID": "neon_sampleUUID"}

KEPT = "individualID domainID siteID plotID trapID setDate collectDate subsampleID taxonID scientificName taxonRank morphospeciesID nativeStatusCode sampleCondition identificationQualifier release".split()
EXPERT = "individualID taxonID scientificName taxonRank sex family genus identifiedBy laboratoryName identifiedDate".split()
COMMON = "domainID siteID plotID setDate collectDate sampleType taxonID scientificName sampleCondition remarks release".split()


def _ties(df: DataFrame, order: Sequence[str]) -> list:
    return [F.col(c).desc_nulls_last() for c in order if c in df.columns]


def _latest(df: DataFrame) -> DataFrame:
    date = "identifiedDate" if "identifiedDate" in df.columns else "individualID"
    return selection.latest(df, ["individualID"], date, _ties(df, ["uid", "taxonID", "scientificName", "collectDate"]))


def specimen_manifest(para: DataFrame, expert: DataFrame | None = None, field: DataFrame | None = None) -> DataFrame:
    """One row for each pinned individual; the expert's identification wins where an expert named it.

    Records without a date count as the latest. An expert's missing taxonID stays missing. Of records with the same
    date the one with the largest uid counts. field adds each plot's surroundings.
    """
    man = shaping.present(_latest(para), KEPT).withColumnsRenamed({c: f"para_{c}" for c in ("taxonID", "scientificName", "taxonRank", "identificationQualifier")})
    if expert is not None:
        e = shaping.present(_latest(expert), EXPERT)
        man = man.join(e.withColumnsRenamed({c: f"expert_{c}" for c in ("taxonID", "scientificName", "taxonRank", "identifiedBy", "identifiedDate")}), "individualID", "left")
    needed = [f"{who}_{c}" for who in ("para", "expert") for c in ("taxonID", "scientificName", "taxonRank")] + ["sex", "collectDate"]
    missing = [c for c in needed if c not in man.columns]
    man = man.withColumns({c: F.lit(None).cast("string") for c in missing})
    has = F.col("expert_scientificName").isNotNull()
    best = {f"best{c[0].upper()}{c[1:]}": shaping.preferred(has, F.col(f"expert_{c}"), F.col(f"para_{c}")) for c in ("taxonID", "scientificName", "taxonRank")}
    man = man.withColumns(best | {"idSource": F.when(has, "expert").otherwise("parataxonomist"), "year": shaping.year_of(F.col("collectDate")).cast("long")})
    if field is not None and "nlcdClass" in field.columns:
        values = ["nlcdClass", "decimalLatitude", "decimalLongitude", "elevation"]
        man = linkage.lookup(man, field, "plotID", "plotID", values, [F.col("collectDate").asc_nulls_last(), *[F.col(v).asc_nulls_last() for v in values]])
    return man


def link_repository(man: DataFrame, records: DataFrame, occurrences: DataFrame | None = None) -> DataFrame:
    """Adds each individual's repository record: its voucher before others, then the one with most images."""
    order = [selection.priority_order("collection", VOUCHERS), F.col("n_images").desc_nulls_last(), F.col("occid").asc_nulls_last()]
    found = linkage.best_candidate(man, records, "individualID", order, ["collection", "catalogNumber", "occid", "n_images"])
    found = found.withColumnsRenamed({c: f"biorepo_{c}" for c in ("collection", "catalogNumber", "occid", "n_images")})
    found = found.withColumns({"in_biorepository": F.col("biorepo_occid").isNotNull(), "biorepo_n_images": F.coalesce("biorepo_n_images", F.lit(0)).cast("long")})
    return _with_occurrences(found, occurrences)


def _with_occurrences(df: DataFrame, occurrences: DataFrame | None) -> DataFrame:
    if occurrences is None:
        return df
    return linkage.lookup(df, occurrences, "biorepo_catalogNumber", "catalogNumber", ["gbifID"], [F.asc("gbifID")])


def preserved_samples(sorting: DataFrame, pooling: DataFrame | None = None, records: DataFrame | None = None, occurrences: DataFrame | None = None) -> DataFrame:
    """One row for each vial kept from sorting or pooling, linked to its accession by ID, then hash, then barcode."""

    def level(df: DataFrame, name: str, own: dict[str, str]) -> DataFrame:
        wanted = [*COMMON, *own]
        full = df.withColumns({c: F.lit(None).cast("string") for c in wanted if c not in df.columns}).select(*wanted)
        return full.withColumnsRenamed({a: b for a, b in own.items() if a != b}).filter("sample_id IS NOT NULL").withColumn("level", F.lit(name))

    same = lambda *cs: {c: c for c in cs}
    out = level(sorting, "trap sorting", {"subsampleID": "sample_id", "subsampleCode": "barcode", "sampleID": "trap_sampleID"} | same("trapID", "individualCount", "taxonRank", "identifiedBy"))
    if pooling is not None:
        a = level(pooling, "archive pooling", {"archiveVialID": "sample_id", "archiveSampleCode": "barcode"} | same("subsampleIDList", "pooledFromMultiplePlots"))
        out = shaping.union_aligned(out, a.withColumn("n_pooled_subsamples", text.part_count(F.col("subsampleIDList"))).drop("subsampleIDList"))
    out = selection.first_by(out, ["level", "sample_id"], [F.col(c).asc_nulls_last() for c in ("collectDate", "barcode", "taxonID", "scientificName")])
    out = out.withColumns({
        "specimen_group": shaping.recode(F.col("sampleType"), GROUPS), "individualCount": shaping.number(F.col("individualCount")),
        "year": shaping.year_of(F.col("collectDate")).cast("long"),
    })
    if records is None:
        return out
    tries = [("sample_id", "neon_sampleID", "sample ID"), ("sample_id", "neon_sampleID_hash", "sample ID hash"), ("barcode", "neon_barcode", "barcode")]
    keyed = out.withColumn("_id", F.concat_ws("\x1f", "level", "sample_id"))
    linked = linkage.fallback_link(keyed, records, tries, "catalogNumber", [F.asc("catalogNumber")], "_id").drop("_id")
    linked = linked.withColumnsRenamed({"link": "biorepo_catalogNumber", "link_kind": "biorepo_link"})
    linked = linkage.lookup(linked, records, "biorepo_catalogNumber", "catalogNumber", ["collection", "occid", "n_images"], [F.col("occid").asc_nulls_last()])
    linked = linked.withColumnsRenamed({"collection": "biorepo_collection", "occid": "biorepo_occid"}).withColumns(
        {"in_biorepository": F.col("biorepo_catalogNumber").isNotNull(), "biorepo_n_images": F.coalesce("n_images", F.lit(0)).cast("long")}
    )
    return _with_occurrences(linked.drop("n_images"), occurrences)


def repository_records(occurrences: DataFrame, collection: str | Column, group: str | Column, media: DataFrame | None = None) -> DataFrame:
    """Darwin Core occurrences of a collection with the identifiers in otherCatalogNumbers, location and individual.

    media (coreid, ...) gives n_images, its rows of each record; records without any have 0.
    """
    parsed = occurrences.withColumn("_ids", text.labelled_pairs(F.col("otherCatalogNumbers"), IDENTIFIERS))
    rows = parsed.select("*", "_ids.*").drop("_ids")
    individual = F.when(F.rlike("neon_sampleID", F.lit(r"^NEON\.BET\.D\d{2}\.\d+$")), F.col("neon_sampleID"))
    as_column = lambda v: F.lit(v) if isinstance(v, str) else v
    rows = rows.withColumns({
        "collection": as_column(collection), "specimen_group": as_column(group), "individualID": individual,
        "siteID": text.extract(F.col("locationID"), "^([A-Z]{4})[_.]"), "plotID": text.extract(F.col("locationID"), r"^([A-Z]{4}_\d{3})"),
        "domainID": text.extract(F.col("locality"), r"\((D\d{2})\)"),
    })
    if media is None:
        return rows
    counts = media.groupBy(F.col("coreid").alias("occid")).agg(F.count("*").alias("n_images"))
    return rows.join(counts, "occid", "left").withColumn("n_images", F.coalesce("n_images", F.lit(0).cast("long")))


def side_table(rows: DataFrame, collection: str | Column) -> DataFrame:
    """Identifications, measurements or material samples of an archive, by record: coreid as occid, with the collection."""
    named = F.lit(collection) if isinstance(collection, str) else collection
    return rows.withColumnRenamed("coreid", "occid").withColumn("collection", named)


def repository_images(records: DataFrame, media: DataFrame) -> DataFrame:
    """(image_id, occid, image_url, image_kind, view, ...) of still images, one for each URL and each id.

    A medium without a type is a still image, and one without a record keeps nulls of it. The id has the collection and
    the file's stem; a photo that was uploaded twice is there once.
    """
    still = media.filter(F.coalesce("type", F.lit("StillImage")) == "StillImage").withColumnRenamed("coreid", "occid")
    rows = still.withColumn("image_url", F.coalesce("accessURI", "goodQualityAccessURI")).join(records, "occid", "left")
    rows = rows.withColumns({
        "image_kind": text.image_kind(F.col("collection"), F.col("image_url")), "view": text.image_view(F.col("image_url")), "source": F.lit("biorepo"),
        "image_id": F.concat(F.lit("biorepo/"), "collection", F.lit("/"), text.stem(text.url_file(F.col("image_url")))),
    })
    return selection.two_stage_distinct(rows, ["image_url"], ["image_id"], [F.asc("occid"), F.asc("image_url")])


def collection_catalog(collections: DataFrame, records: DataFrame, images: DataFrame) -> DataFrame:
    """Collections' descriptions as text with counts of what was read of them."""
    counts = records.groupBy("collection").agg(
        F.count("*").alias("records"), F.count_if(F.col("n_images") > 0).alias("records_with_images"), F.countDistinct("siteID").alias("sites"),
        F.min(F.substring("eventDate", 1, 4)).alias("first_year"), F.max(F.substring("eventDate", 1, 4)).alias("last_year"),
        F.coalesce(F.sum(shaping.number(F.col("individualCount"))), F.lit(0.0)).alias("individuals"),
    )
    pictures = images.groupBy("collection").agg(F.count("*").alias("images"))
    joined = collections.join(counts, "collection", "left").join(pictures, "collection", "left")
    return joined.withColumns({"description": text.plain_text(F.col("description")), "images": F.coalesce("images", F.lit(0)), "records": F.coalesce("records", F.lit(0))})
