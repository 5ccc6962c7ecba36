"""Models over rows: a pluggable predictor, loaded once a worker, with routes, isolation of errors and resumption."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.operators.linkage import not_done
from taxaflow.sources.files import TableStore

_LOADED: dict[str, object] = {}


class Predictor(Protocol):
    """What a detector, segmenter, part model, label reader or species model must offer."""

    def predict(self, rows: Sequence[dict]) -> Sequence[dict]: ...


def loaded(name: str, load: Callable[[], Predictor]) -> Predictor:
    """The worker's one instance of a model."""
    if name not in _LOADED:
        _LOADED[name] = load()
    return _LOADED[name]


def predicted(df: DataFrame, name: str, load: Callable[[], Predictor], schema: str, key: str = "image_id", batch: int = 8) -> DataFrame:
    """The predictor's columns for each row in mini-batches, and a status.

    A batch that fails is taken row by row, so that one row's error is its own: "error:<Type>", or
    "error:out_of_memory" for a MemoryError.
    """
    names = [s.split()[0] for s in schema.split(",")]
    kind = df.schema[key].dataType.simpleString()

    def row(found: dict | None, status: str, k: object) -> dict:
        return {key: k, "status": status} | {n: (found or {}).get(n) for n in names}

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loaded(name, load)
        for frame in frames:
            records, out = frame.to_dict("records"), []
            for start in range(0, len(records), batch):
                some = records[start : start + batch]
                try:
                    out += [row(f, "ok", r[key]) for r, f in zip(some, model.predict(some), strict=True)]
                except Exception:  # noqa: BLE001  each row is tried by itself
                    for r in some:
                        try:
                            out.append(row(model.predict([r])[0], "ok", r[key]))
                        except MemoryError:
                            out.append(row(None, "error:out_of_memory", r[key]))
                        except Exception as error:  # noqa: BLE001
                            out.append(row(None, f"error:{type(error).__name__}", r[key]))
            yield pd.DataFrame(out, columns=[key, *names, "status"])

    return df.mapInPandas(run, f"{key} {kind}, {schema}, status string")


def routed(manifest: DataFrame, routes: Mapping[str, Callable[[DataFrame], DataFrame]], done: DataFrame | None = None, key: str = "image_id", limit: int | None = None) -> DataFrame:
    """Each route's function over its rows that are to be processed and are not done yet, in one table.

    With a limit, the first rows by key are taken: a feature to try a run on a few.
    """
    rows = manifest.filter(F.coalesce("process", F.lit(False)))
    if done is not None:
        rows = not_done(rows, done, key)
    if limit is not None:
        rows = rows.orderBy(key).limit(limit)
    parts = [f(rows.filter(F.col("route") == name)) for name, f in routes.items()]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part, allowMissingColumns=True)
    return found


def trusted_parts(head: F.Column, pronotum: F.Column, elytra: F.Column, foreground: F.Column, window: F.Column) -> F.Column:
    """Whether a crop's part map is to be trusted: each trunk part 0.2 % of the window, the foreground 1 %."""
    return (F.least(head, pronotum, elytra) >= 0.002 * window) & (foreground >= 0.01 * window)


def recheck_queue(results: DataFrame, instances: DataFrame, key: str = "image_id") -> DataFrame:
    """Images to run again: those that failed, and those without an instance."""
    failed = results.filter(F.col("status") != "ok").select(key)
    empty = results.filter(F.col("status") == "ok").select(key).join(instances.select(key).distinct(), key, "left_anti")
    return failed.unionByName(empty).distinct()


def backdrop_queue(instances: DataFrame, most: float = 0.5, key: str = "image_id") -> DataFrame:
    """Images with an instance whose stored mask is the backdrop: it covers more than `most` of its window's outline."""
    from taxaflow.functions import kernels

    covered = kernels.border_coverage("mask_rle", "mask_h", "mask_w")
    return instances.filter("mask_rle IS NOT NULL").select(key, covered.alias("_covered")).filter(F.col("_covered") > most).select(key).distinct()


def requeued(store: TableStore, ids: DataFrame, kinds: Sequence[str] = ("instances", "images"), key: str = "image_id", by: str = "source") -> DataFrame:
    """Drop images from the shards, so that the next run, which leaves out what is done, takes them again; returns their ids.

    The ids are written down first, in the folder of the context's checkpoints, as they can come from the same shards.
    """
    held = ids.select(key).distinct().checkpoint()
    for kind in kinds:
        store.drop_from_shards(kind, held, key, by)
    return held
