"""Validation against annotations, species suggestions, and the aggregates of a report."""

from __future__ import annotations

import html
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.functions import text
from taxaflow.operators import boxes, linkage, selection, shaping, summaries

#: Ranks at or below species, and the least probability of a model's pick.
SPECIES_RANKS = ("species", "subspecies", "variety", "form")
LEAST_PROBABILITY = 0.6


def detection_validation(detections: DataFrame, truth: DataFrame, lines: DataFrame, placed: DataFrame, annotator: str) -> DataFrame:
    """Counts of each annotated image: found, human boxes, matches, and annotated individuals that have an instance.

    detections and truth are (image_id, id, box); lines (image_id, user_name, workflowID, individual); placed
    (image_id, individual, instance_id). The individuals are those of the preferred annotator, else of the most
    frequent one, in that annotator's most frequent workflow.
    """
    found = detections.groupBy("image_id").agg(F.count("*").alias("n_detected"))
    human = truth.groupBy("image_id").agg(F.count("*").alias("n_human_boxes"))
    tp = boxes.matched(detections, truth, "image_id").withColumnRenamed("tp", "tp_iou50")
    user = summaries.preferred_else_most_frequent(lines, "image_id", "user_name", annotator).drop("n")
    theirs = lines.join(user, ["image_id", "user_name"])
    flow = summaries.preferred_else_most_frequent(theirs, "image_id", "workflowID", "").drop("n")
    counted = theirs.join(flow, ["image_id", "workflowID"]).groupBy("image_id").agg(F.countDistinct("individual").alias("n_annotated"))
    covered = theirs.join(flow, ["image_id", "workflowID"]).select("image_id", "individual").distinct().join(placed.filter("instance_id IS NOT NULL"), ["image_id", "individual"])
    covered = covered.groupBy("image_id").agg(F.countDistinct("individual").alias("n_annotated_covered"), F.countDistinct("instance_id").alias("n_instances_annotated"))
    out = human
    for part in (found, tp, counted, covered):
        out = out.join(part, "image_id", "left")
    return out.na.fill(0)


def detection_summary(validation: DataFrame) -> DataFrame:
    """One row of precision, recall and how often counts agree."""
    pr = summaries.precision_recall(F.col("tp_iou50"), F.col("n_detected"), F.col("n_human_boxes"))
    ca = summaries.count_agreement(F.col("n_detected"), F.col("n_human_boxes"))
    covered = F.sum("n_annotated_covered") / F.greatest(F.sum("n_annotated"), F.lit(1))
    return validation.agg(*[c.alias(k) for k, c in (pr | ca).items()], covered.alias("annotated_covered"), F.count("*").alias("n"))


def trait_summary(traits: DataFrame, pairs: Mapping[str, tuple[str, str]], subsets: Mapping[str, Column]) -> DataFrame:
    """Long agreement statistics of measured traits with human ones, by subsets."""
    return summaries.agreement_long(traits, subsets, pairs, ("bias", "mae", "median_abs_pct", "within_10pct", "pearson_r", "slope"))


def compared_methods(first: DataFrame, second: DataFrame, truth: DataFrame, images: int, seed: int = 0) -> DataFrame:
    """Counts and matches of two detectors on the same seeded sample of annotated images."""
    chosen = selection.seeded_sample(truth.select("image_id").distinct(), "image_id", images, seed)
    out = truth.join(chosen, "image_id").groupBy("image_id").agg(F.count("*").alias("n_human_boxes"))
    for name, found in (("first", first), ("second", second)):
        own = found.join(chosen, "image_id", "left_semi")
        out = out.join(own.groupBy("image_id").agg(F.count("*").alias(f"{name}_n")), "image_id", "left")
        out = out.join(boxes.matched(own, truth, "image_id").withColumnRenamed("tp", f"{name}_tp_iou50"), "image_id", "left")
    return out.na.fill(0)


def species_records(records: DataFrame, group: str = "herptile bycatch") -> DataFrame:
    """Records of a group with whether they name a species, surely, and the taxon to look candidates up under."""
    rank = F.lower(F.coalesce("taxonRank", F.lit("")))
    to_species = rank.isin(*SPECIES_RANKS)
    genus = F.split(F.coalesce("scientificName", F.lit("")), r"\s+")[0]
    return records.filter(F.col("specimen_group") == group).withColumns({
        "to_species": to_species, "confident": to_species & F.col("identificationQualifier").isNull(),
        "higher_taxon": F.when(to_species, genus).otherwise(F.col("scientificName")),
        "decimalLatitude": shaping.number(F.col("decimalLatitude")), "decimalLongitude": shaping.number(F.col("decimalLongitude")),
    })


def candidate_searches(records: DataFrame) -> DataFrame:
    """(siteID, higher_taxon, taxonKey, lat, lon): one search for each taxon of a site, at the mean place of its records.

    Records without a site or a key are not searched for, and neither are sites without a place. Of a pair's keys the
    smallest counts.
    """
    pairs = records.filter("taxonKey IS NOT NULL AND siteID IS NOT NULL").groupBy("siteID", "higher_taxon").agg(F.min("taxonKey").alias("taxonKey"))
    return linkage.with_means(pairs, records, "siteID", {"lat": "decimalLatitude", "lon": "decimalLongitude"})


def range_picks(candidates: DataFrame) -> DataFrame:
    """(siteID, higher_taxon, n_candidates, range_pick, range_pick_key, range_pick_share, candidates).

    candidates has siteID, higher_taxon, species, speciesKey, n_observations. The pick is observed most; ties go to
    the smaller key.
    """
    order = F.struct("n_observations", (-F.col("speciesKey")).alias("k"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n_observations")).alias("n"), "speciesKey", "species")))
    return candidates.groupBy("siteID", "higher_taxon").agg(
        F.count("*").alias("n_candidates"), F.max_by("species", order).alias("range_pick"), F.max_by("speciesKey", order).alias("range_pick_key"),
        F.try_divide(F.max("n_observations"), F.sum("n_observations")).alias("range_pick_share"),
        F.array_join(F.transform(ranked, lambda x: x["species"]), "|").alias("candidates"),
    )


def suggestions(records: DataFrame, picks: DataFrame, models: DataFrame) -> DataFrame:
    """Suggested species of records: the only candidate, or the model's pick if it is probable enough.

    models has occid, model_pick, model_pick_key, model_prob. Records that name a species get no suggestion, but
    whether the picks agree with it.
    """
    out = records.join(picks, ["siteID", "higher_taxon"], "left").join(models, "occid", "left")
    need = ~F.col("to_species") & (F.coalesce("n_candidates", F.lit(0)) > 0)
    single = need & (F.col("n_candidates") == 1)
    strong = need & (F.col("n_candidates") > 1) & F.coalesce(F.col("model_prob") >= LEAST_PROBABILITY, F.lit(False))
    agrees = {f"{m}_agrees": F.when(F.col("to_species") & F.col(f"{m}_pick_key").isNotNull(), F.coalesce(F.col(f"{m}_pick_key") == F.col("speciesKey"), F.lit(False))) for m in ("range", "model")}
    return out.withColumns(agrees | {
        "suggested_species": F.when(single, F.col("range_pick")).when(strong, F.col("model_pick")),
        "suggestion_basis": F.when(single, "only candidate nearby").when(strong, "model among candidates nearby"),
    })


def suggestion_accuracy(found: DataFrame, candidates: DataFrame) -> DataFrame:
    """Accuracy of the picks where the species is known: all, with a choice, and with a probable model pick."""
    there = candidates.select("siteID", "higher_taxon", F.col("speciesKey")).distinct().withColumn("_in", F.lit(True))
    known = found.filter(F.col("confident") & (F.coalesce("n_candidates", F.lit(0)) > 0) & F.col("model_pick").isNotNull()).join(there, ["siteID", "higher_taxon", "speciesKey"], "left")
    choice = F.col("n_candidates") > 1
    subsets = {"all": F.lit(True), "two or more": choice, "two or more, probable": choice & (F.col("model_prob") >= LEAST_PROBABILITY)}
    share = lambda c, ok: F.avg(F.when(ok, F.coalesce(c, F.lit(False)).cast("double")))
    rows = [F.struct(F.lit(n).alias("subset"), F.count_if(ok).alias("records"), F.median(F.when(ok, F.col("n_candidates"))).alias("median_candidates"), share(F.col("_in"), ok).alias("recorded_species_among_candidates"), share(F.col("range_agrees"), ok).alias("range_pick_accuracy"), share(F.col("model_agrees"), ok).alias("model_pick_accuracy")) for n, ok in subsets.items()]
    return known.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*").filter("records > 0")


def report_aggregates(specimens: DataFrame, manifest: DataFrame, measured: DataFrame) -> dict[str, DataFrame]:
    """The tables behind a report: by site, by year and release, by pool, the funnel, histograms and worst images."""
    steps = {"images": F.lit(True), "processed": shaping.flag(F.col("process")), "measured": F.col("n") > 0, "scaled": F.col("scaled") > 0}
    per = measured.groupBy("image_id").agg(F.count("*").alias("n"), F.count_if("qc_has_scale").alias("scaled"))
    return {
        "sites": specimens.groupBy("siteID").agg(F.count("*").alias("n"), F.countDistinct("bestScientificName").alias("taxa"), F.avg(F.col("in_biorepository").cast("double")).alias("linked")),
        "years": summaries.pivoted(specimens, "year", "idSource", ["expert", "parataxonomist"], F.count(F.lit(1)), fill=0),
        "pools": measured.groupBy("source").agg(F.count("*").alias("n"), F.avg(shaping.flag(F.col("parts_ok")).cast("double")).alias("parts_ok")),
        "funnel": summaries.funnel(manifest.join(per, "image_id", "left"), steps),
        "lengths": summaries.histogram(measured.filter("length_mm IS NOT NULL"), "length_mm", 0.0, 42.0, 21),
        "names": selection.top_k(measured.filter("scientificName IS NOT NULL").groupBy(text.binomial(F.col("scientificName")).alias("name")).agg(F.count("*").alias("n")), 15, F.desc("n"), F.asc("name")),
    }


def render_report(title: str, tables: Mapping[str, Sequence[Mapping[str, object]]]) -> str:
    """An HTML page of small collected tables, with bars for their last numeric column."""
    parts = [f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, rows in tables.items():
        columns = list(rows[0]) if rows else []
        numbers = [c for c in columns if all(isinstance(r[c], int | float) for r in rows)]
        most = max((abs(r[numbers[-1]]) for r in rows), default=0) if numbers else 0
        head = "".join(f"<th>{html.escape(c)}</th>" for c in columns)
        body = []
        for r in rows:
            cells = "".join(f"<td>{html.escape('' if r[c] is None else str(r[c]))}</td>" for c in columns)
            bar = f"<td><svg width='200' height='10'><rect width='{200 * abs(r[numbers[-1]]) / most:.1f}' height='10'/></svg></td>" if most else ""
            body.append(f"<tr>{cells}{bar}</tr>")
        parts.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{''.join(body)}</table>")
    return "\n".join(parts)
