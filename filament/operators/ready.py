"""Readiness (P22, J5) and the already-handled anti-join (J6) on a listing frame.

Strategies: ``atomic_rename`` (name matches, no temp suffix), ``stable_size``
(additionally ``now - mtime >= stable_delay``) and ``marker`` (a ``<data><suffix>``
marker exists; the data file must match the pattern and exist, the marker itself is
never data).  Directories are never ready.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filament.spec import PipelineSpec, glob_to_regex


def _no_temp_suffix(name, suffixes) -> "F.Column":
    cond = F.lit(True)
    for s in suffixes:
        if s:
            cond = cond & ~name.endswith(s)
    return cond


def ready_files(listing: DataFrame, spec: PipelineSpec, now: dt.datetime) -> DataFrame:
    """Ready data files: ``path, name, size, mtime`` (plus listing extras)."""
    files = listing.filter(~F.col("is_dir"))
    pat = glob_to_regex(spec.file_pattern)
    if spec.ready_strategy == "marker":
        if not spec.marker_suffix:
            return files.limit(0)
        suffix = spec.marker_suffix
        markers = (files.filter(F.col("name").rlike(glob_to_regex(spec.file_pattern + suffix)))
                        .select(F.expr(f"left(path, length(path) - {len(suffix)})").alias("_data_path")))
        data = files.filter(F.col("name").rlike(pat) & _no_temp_suffix(F.col("name"), spec.temp_suffixes))
        return data.join(markers, data["path"] == markers["_data_path"], "left_semi")
    ready = files.filter(F.col("name").rlike(pat) & _no_temp_suffix(F.col("name"), spec.temp_suffixes))
    if spec.ready_strategy == "stable_size":
        age = F.lit(now).cast("timestamp").cast("double") - F.col("mtime").cast("double")
        ready = ready.filter(age >= F.lit(float(spec.stable_delay_s)))
    return ready
