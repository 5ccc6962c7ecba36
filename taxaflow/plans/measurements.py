"""Image manifests, scales and measurements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaflow.functions import kernels, text
from taxaflow.functions.rasters import rle_decode
from taxaflow.operators import boxes, linkage, selection, shaping

#: Measured columns in pixels that become millimetres, and areas.
LENGTHS = "length width perimeter ellipse_major ellipse_minor core_length core_width body_length_parts elytra_length elytra_width pronotum_length pronotum_width head_width elytra_base_width pronotum_base_width elytra_midline_length midline_length".split()
AREAS = "area elytra_area pronotum_area head_area".split()


def tray_manifest(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trays and annotation lines from measurement rows: coordinates from JSON, sizes from tuples, lengths in pixels.

    A tray has the first non-null names in the order of its rows' measureID, and the most frequent image size.
    """
    rows = lines.withColumns({
        "pictureID": F.regexp_replace("pictureID", r"\.jpg$", ""), "_c": text.line_coords(F.col("coords_pix")),
        "_full": text.tuple_ints(F.col("image_dim")), "_small": text.tuple_ints(F.col("resized_image_dim")),
    })
    k = F.try_divide(F.try_element_at("_full", F.lit(2)).cast("double"), F.try_element_at("_small", F.lit(2)).cast("double"))
    rows = rows.withColumns({n: F.col("_c")[n] * F.coalesce(k, F.lit(1.0)) for n in boxes.BOX} | {"image_id": F.concat(F.lit("hf2018/"), "pictureID")})
    rows = rows.withColumns({"dist_px_full": F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")), "px_per_cm_full": F.col("cm_pix").cast("double") * F.coalesce(k, F.lit(1.0))})
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("measureID"))).alias(c)
    trays = rows.groupBy("image_id").agg(
        first("scientificName"), first("NEON_sampleID"), first("siteID"), first("plotID"), F.mode(F.try_element_at("_full", F.lit(1)), True).alias("height"),
        F.mode(F.try_element_at("_full", F.lit(2)), True).alias("width"), (F.median("px_per_cm_full") / 10).alias("px_per_mm"),
    )
    return trays, rows.drop("_c", "_full", "_small", "coords_pix", "image_dim", "resized_image_dim")


def trait_manifest(traits: DataFrame, metadata: DataFrame, kinds: Sequence[str] = ("scalebar", "elytra_max_length", "basal_pronotum_width", "elytra_max_width")) -> tuple[DataFrame, DataFrame]:
    """Group images with the median pixels per millimetre of their scale bars, and traits with coordinates as columns."""
    rows = traits.withColumn("image_id", F.concat(F.lit("hawaii/"), text.stem(F.element_at(F.split("groupImageFilePath", "/"), -1))))
    for kind in kinds:
        c = text.line_coords(F.col(f"coords_{kind}"))
        rows = rows.withColumns({f"{kind}_{n}": c[n] for n in boxes.BOX}).drop(f"coords_{kind}")
    rows = rows.join(metadata, "individualID", "left")
    scale = F.median(F.try_divide(F.col("px_scalebar").cast("double"), F.col("cm_scalebar").cast("double") * 10))
    return rows.groupBy("image_id").agg(scale.alias("px_per_mm"), F.substring(F.min("collectDate"), 1, 4).alias("year")), rows


def anonymous_manifest(rows: DataFrame) -> DataFrame:
    """Crops whose places are anonymised; their ids carry a prefix, and they are one specimen each."""
    renamed = rows.withColumnsRenamed({"siteID": "anon_siteID", "domainID": "anon_domainID", "eventID": "anon_eventID"})
    return renamed.withColumns({"image_kind": F.lit("pinned"), "is_carabid": F.lit(True), "eventDate": F.col("collectDate"), "image_id": F.concat(F.lit("sentinel/"), F.col("public_id")), "source": F.lit("sentinel"), "route": F.lit("crop"), "year": F.substring("collectDate", 1, 4)})


def image_manifest(biorepo: DataFrame, files: DataFrame, pools: Sequence[DataFrame], tray_barcodes: DataFrame, schema: T.StructType) -> DataFrame:
    """All pools' images: routed, with duplicates marked, and whether each is to be processed.

    biorepo has image_id, image_url, image_kind, specimen_group, family, occid, neon_barcode; files image_id,
    status, sha256; tray_barcodes a column barcode. A tray whose file is another pool's tray is a copy of that one;
    otherwise the smallest id of files with equal content is kept. Marked images are not processed.
    """
    name = text.without_size(text.stem(text.url_file(F.col("image_url"))))
    unique = selection.first_by(files, ["image_id"], [F.col("status").desc(), F.col("sha256").asc_nulls_last()])
    rows = biorepo.join(unique, "image_id").filter("status = 'ok'").withColumn("barcode", name)
    herp, tray = F.col("specimen_group") == "herptile bycatch", F.col("image_kind") == "tray_ethanol"
    rows = selection.known_copies(rows, tray_barcodes, "barcode").withColumns({
        "source": F.when(herp, "herp").otherwise(F.lit("biorepo")), "route": F.when(herp, "herp").when(tray, "tray").otherwise("single"),
        "is_carabid": shaping.flag(F.col("family") == "Carabidae"), "biorepo_occid": F.col("occid"),
        "neon_barcode": F.coalesce("neon_barcode", F.when(tray, F.col("barcode"))),
    })
    rows = rows.withColumn("_known", F.when(tray & F.col("is_copy"), F.concat(F.lit("hf2018/"), "barcode")))
    least = rows.filter("sha256 IS NOT NULL").groupBy("sha256").agg(F.min("image_id").alias("_least"))
    rows = rows.join(least, "sha256", "left")
    same = F.when(F.col("_least") != F.col("image_id"), F.col("_least"))
    rows = rows.withColumn("duplicate_of", F.coalesce("_known", same)).drop("_known", "_least", "is_copy")
    every = shaping.union_aligned(*[shaping.ensure_columns(p, schema) for p in (rows, *pools)])
    return every.withColumn("process", F.col("duplicate_of").isNull() & (shaping.flag(F.col("is_carabid")) | shaping.flag(F.col("source") == "herp")))


class ScaleRule(NamedTuple):
    """How a source's images show their scale, in which region (parts of the sides), and what a reading needs to count."""

    how: str
    name: str
    least_strength: float = 0.0
    least_n: int = 0
    most_spread: float = 1.0
    least_part: float = 0.0
    region: tuple[float, float, float, float] = (0.0, 0.0, 1.0, 1.0)
    read_least: int = 6


#: The rule of each source; ticks of rulers, squares of boards, and the part of the width that a bar spans.
SCALE_RULES = {
    "hf2018": ScaleRule("checkerboard", "checkerboard", least_n=2, most_spread=0.03),
    "sentinel": ScaleRule("ruler", "ruler_ticks", least_strength=0.4, least_n=8),
    "herp": ScaleRule("ruler", "ruler_ticks", least_strength=0.4, region=(0.0, 0.62, 0.70, 1.0), read_least=20),
    "biorepo": ScaleRule("bar", "printed_bar", least_part=0.15),
}


def _rules(spark: SparkSession, rules: Mapping[str, ScaleRule]) -> DataFrame:
    fields = "source string, how string, name string, least_strength double, least_n int, most_spread double, least_part double, region array<double>, read_least int"
    return spark.createDataFrame([(s, r.how, r.name, r.least_strength, r.least_n, r.most_spread, r.least_part, list(r.region), r.read_least) for s, r in rules.items()], fields)


def read_scales(images: DataFrame, uses: DataFrame | None = None, rules: Mapping[str, ScaleRule] = SCALE_RULES) -> DataFrame:
    """(image_id, source, px_per_mm, strength, n, spread, part): what the images show, before any rule refuses it.

    images has image_id, source, pixels (grey bytes, row by row), height, width and labels, the texts read beside a
    printed bar, or null. Each is read once, where it lies; pixels do not move. uses (image_id, scale_image) names the
    image that shows an image's scale, for a ruler that many crops share: then there is a row for each of its images,
    null where the scale image is missing. Sources without a rule are left out; images without pixels have nulls.
    """
    rule = F.broadcast(_rules(images.sparkSession, rules))  # a row for each source
    known = images.join(rule.select("source", "how", "region", "read_least"), "source")
    read = known.withColumn("_r", kernels.scale_reading("how", "pixels", "height", "width", "read_least", *[F.col("region")[i] for i in range(4)]))
    bar = F.col("_r.bar")
    by_bar = kernels.printed_bar_scale(bar, F.coalesce("labels", F.array().cast("array<string>")))
    part = (bar["x2"] - bar["x1"]) / F.col("width")
    found = read.select("image_id", "source", F.coalesce("_r.px_per_mm", by_bar).alias("px_per_mm"), *[f"_r.{c}" for c in ("strength", "n", "spread")], part.alias("part"))
    if uses is None:
        return found
    return uses.select("image_id", "scale_image").join(found.withColumnRenamed("image_id", "scale_image"), "scale_image", "left").select("image_id", *found.columns[1:])


def image_scale(readings: DataFrame, annotated: DataFrame | None = None, rules: Mapping[str, ScaleRule] = SCALE_RULES) -> DataFrame:
    """(image_id, px_per_mm, scale_source, scale_confidence): readings that their source's rule refuses keep the confidence alone.

    readings are those of read_scales(). A board's confidence is 1 less its spread, a ruler's the strength of its period,
    both also of readings that are refused but for boards, which then have 0, as printed bars have. Annotated scales
    (image_id, px_per_mm) count as certain where no reading passes. Sources without a rule pass nothing.
    """
    r = readings.join(F.broadcast(_rules(readings.sparkSession, rules)), "source", "left")
    enough = lambda c, least: F.coalesce(F.col(c) >= F.col(least), F.col(least) <= 0)
    ok = (F.col("px_per_mm") > 0) & enough("strength", "least_strength") & enough("n", "least_n") & enough("part", "least_part") & (F.coalesce("spread", F.lit(0.0)) <= F.col("most_spread"))
    ok = F.coalesce(ok, F.lit(False))
    strength = F.when(F.col("how") == "ruler", F.col("strength")).when(ok, F.coalesce("strength", F.lit(1.0))).when(F.col("how").isNotNull(), 0.0)
    gate = shaping.gated(ok, px_per_mm=F.col("px_per_mm"), scale_source=F.col("name"))
    found = r.select("image_id", gate["px_per_mm"].alias("px_per_mm"), gate["scale_source"].alias("scale_source"), strength.alias("scale_confidence"))
    if annotated is None:
        return found
    given = annotated.filter("px_per_mm IS NOT NULL").select("image_id", F.col("px_per_mm").alias("_k"))
    joined = found.join(given, "image_id", "full")
    use = F.col("px_per_mm").isNull() & F.col("_k").isNotNull()
    return joined.select(
        "image_id", F.coalesce("px_per_mm", "_k").alias("px_per_mm"), F.when(use, "annotated").otherwise(F.col("scale_source")).alias("scale_source"),
        F.when(use, 1.0).otherwise(F.col("scale_confidence")).alias("scale_confidence"),
    )


def with_base_widths(instances: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds base widths and whether head, pronotum or elytra reach the image's edge; instances without elytra get nulls.

    sizes has image_id, width, height; without it the parts' window is taken for the image.
    """
    rows = instances.join(sizes.select("image_id", F.col("width").alias("_w"), F.col("height").alias("_h")), "image_id", "left")
    rows = rows.withColumn("_b", kernels.base_widths("head_rle", "pronotum_rle", "elytra_rle", "parts_h", "parts_w"))
    rows = rows.withColumn("_e", trunk_extent(F.array("head_rle", "pronotum_rle", "elytra_rle"), F.col("parts_h"), F.col("parts_w")))
    w, h = F.coalesce("_w", F.col("pwin_x1") + F.col("parts_w")), F.coalesce("_h", F.col("pwin_y1") + F.col("parts_h"))
    extent = F.struct(*[(F.col(f"pwin_{n[0]}1") + F.col("_e")[n]).alias(n) for n in boxes.BOX])
    edge = F.when(F.col("_e.x1").isNotNull(), boxes.touches_edge(extent, w, h))
    return rows.select("*", "_b.*").withColumn("trunk_touches_edge", edge).drop("_b", "_e", "_w", "_h")


@F.pandas_udf(T.StructType([T.StructField(n, T.IntegerType()) for n in boxes.BOX]))
def trunk_extent(codes: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    """First and last columns and rows of any of a row's coded masks; null where all are empty or one is null."""
    rows = []
    for some, h, w in zip(codes, height, width, strict=True):
        found = {n: None for n in boxes.BOX}
        if some is not None and not any(c is None for c in some) and not pd.isna(h):
            whole = np.logical_or.reduce([rle_decode(c, int(h), int(w)) for c in some])
            ys, xs = np.nonzero(whole)
            if len(xs):
                found = dict(zip(boxes.BOX, map(int, (xs.min(), ys.min(), xs.max(), ys.max())), strict=True))
        rows.append(found)
    return pd.DataFrame(rows, columns=list(boxes.BOX))


def measurements(instances: DataFrame, scales: DataFrame, manifest: DataFrame, annotations: DataFrame | None = None) -> DataFrame:
    """Instances without masks, in millimetres where there is a scale, with their images' keys and quality flags.

    annotations has instance_id and ann_ columns, one row an instance; annotated identities win over the image's.
    """
    rows = instances.drop(*[c for c in instances.columns if c.endswith("_rle")]).join(scales, "image_id", "left")
    lengths = {f"{c}_px": f"{c}_mm" for c in LENGTHS if f"{c}_px" in rows.columns}
    areas = {f"{c}_px": f"{c}_mm2" for c in AREAS if f"{c}_px" in rows.columns}
    rows = shaping.to_units(rows, lengths, areas, "px_per_mm")
    keys = [c for c in "source specimen_group image_kind view individualID neon_sampleID neon_barcode biorepo_occid catalogNumber siteID plotID domainID eventDate year scientificName sex anon_siteID anon_domainID anon_eventID split".split() if c in manifest.columns]
    rows = rows.join(manifest.select("image_id", *keys), "image_id", "left")
    if annotations is not None:
        rows = rows.join(annotations, "instance_id", "left")
        rows = rows.withColumns({c: F.coalesce(f"ann_{c}", c) for c in ("individualID", "scientificName", "plotID") if f"ann_{c}" in annotations.columns and c in rows.columns})
        rows = rows.drop("ann_individualID", "ann_scientificName", "ann_plotID")
    return rows.withColumns({"qc_low_solidity": shaping.flag(F.col("solidity") < 0.5), "qc_has_scale": F.col("px_per_mm").isNotNull()})


def line_annotations(lines: DataFrame, instances: DataFrame, scales: DataFrame) -> DataFrame:
    """(instance_id, ann_elytra_length_mm, ann_elytra_width_mm, ann_lying_flat) of instances that lines lie on.

    Lines (measureID, image_id, workflowID, structure, dist_cm, px_per_cm_full, lying_flat, x1..y2) count where their
    frame is the photo's; several volunteers' lines are one median.
    """
    checked = scales.filter("scale_source = 'checkerboard'").select("image_id", (F.col("px_per_mm") * 10).alias("_cm"))
    framed = shaping.fixed_annotation_frame(lines.join(checked, "image_id", "left"), ["image_id", "workflowID"], "_cm", "px_per_cm_full", boxes.BOX)
    points = framed.filter("frame_ok").select("image_id", F.col("measureID").alias("p_id"), ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"), "structure", "dist_cm", "lying_flat")
    placed = kernels.points_in_masks(points, instances).filter("instance_id IS NOT NULL")
    of = lambda s: F.median(F.when(F.col("structure") == s, F.col("dist_cm") * 10))
    return placed.groupBy("instance_id").agg(of("ElytraLength").alias("ann_elytra_length_mm"), of("ElytraWidth").alias("ann_elytra_width_mm"), F.mode("lying_flat", True).alias("ann_lying_flat"))


def linked_traits(traits: DataFrame, instances: DataFrame) -> DataFrame:
    """(instance_id, ann_ columns) of trait rows whose elytra line's middle lies on an instance; one row an instance."""
    x = (F.col("elytra_max_length_x1") + F.col("elytra_max_length_x2")) / 2
    y = (F.col("elytra_max_length_y1") + F.col("elytra_max_length_y2")) / 2
    points = traits.withColumns({"p_id": F.concat_ws("#", "image_id", "individualID"), "x": x, "y": y}).filter("x IS NOT NULL")
    placed = kernels.points_in_masks(points, instances).filter("instance_id IS NOT NULL")
    one = selection.first_by(placed, ["instance_id"], [F.asc("individualID")])
    mm = {"elytra_max_length": "elytra_length", "elytra_max_width": "elytra_width", "basal_pronotum_width": "pronotum_width"}
    named = [F.col(c).alias(f"ann_{c}") for c in ("individualID", "scientificName", "plotID", "trapID", "collectDate")]
    return one.select("instance_id", *named, *[(F.col(f"cm_{a}") * 10).alias(f"ann_{b}_mm") for a, b in mm.items()])


def annotations(*parts: DataFrame) -> DataFrame:
    """Annotations from several sources as one row for each instance, earlier sources first."""
    ranked = shaping.union_aligned(*[p.withColumn("_rank", F.lit(i)) for i, p in enumerate(parts)])
    cols = [c for c in ranked.columns if c not in ("instance_id", "_rank")]
    return ranked.groupBy("instance_id").agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(c) for c in cols])


def prior_scales(manifest: DataFrame) -> DataFrame:
    return manifest.filter("px_per_mm IS NOT NULL").select("image_id", "px_per_mm", F.lit("annotated").alias("scale_source"), F.lit(1.0).alias("scale_confidence"))


def unmeasured(manifest: DataFrame, scales: DataFrame) -> DataFrame:
    return linkage.not_done(manifest.filter("process"), scales, "image_id")
