"""A run's parameters, its derived paths, and its stages, which stop at the first that fails."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.functions.text import absolute_path, default_if_empty
from framewright.operators.gates import capture_paths

# What holds where a run gives nothing.
DEFAULTS = {"frame_rate": "2", "output_size": "8000x4000", "iterations": "30000", "resolution": "1"}
STAGES = ("stitch", "reconstruct", "train")


def with_defaults(runs: DataFrame) -> DataFrame:
    """runs with their parameters, those that are null or empty by default."""
    return runs.withColumns({k: default_if_empty(F.col(k), v) for k, v in DEFAULTS.items()})


def planned_runs(runs: DataFrame, root: str, folder: str | None = None) -> DataFrame:
    """runs (run_id, path, parameters) with the paths that each stage reads and writes; ``reason`` where a run cannot start.

    With ``folder``, the working folder, paths are made absolute before they are compared with root.
    """
    if folder is not None:
        runs = runs.withColumn("path", absolute_path(F.col("path"), folder))
    return with_defaults(runs).withColumns(capture_paths(F.col("path"), F.lit(root)))


@dataclass(frozen=True)
class StageResult:
    stage: str
    ran: bool
    error: str | None = None


def run_stages(stages: dict[str, Callable[[], None]], skip: frozenset[str] = frozenset()) -> list[StageResult]:
    """Runs the stages in order, but for those to skip; the first error ends it, and is the last result."""
    out = []
    for name, action in stages.items():
        if name in skip:
            out.append(StageResult(name, False))
            continue
        try:
            action()
        except Exception as e:  # reported to the caller
            return [*out, StageResult(name, True, f"{type(e).__name__}: {e}")]
        out.append(StageResult(name, True))
    return out
