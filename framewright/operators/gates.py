"""Which stages still have to run, and whether what they left is usable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.text import basename, dirname, relative_to, size_strict, stem, strip_extension, suffix, under_root

IMAGE_SUFFIXES = ("insp", "jpg")
VIDEO_SUFFIXES = ("mp4", "insv", "lrv")


def media_route(path: Column) -> Column:
    """``image``, ``video`` or ``unsupported``, by the suffix in lower case."""
    ending = suffix(path)
    return F.when(ending.isin(*IMAGE_SUFFIXES), "image").when(ending.isin(*VIDEO_SUFFIXES), "video").otherwise("unsupported")


def capture_route(inputs: Column) -> Column:
    """The first input decides for all."""
    return media_route(F.get(inputs, F.lit(0)))


def missing_arguments(n_args: Column, least: int) -> Column:
    return F.when(n_args < least, F.lit("too few arguments"))


def request_reason(inputs: Column, output: Column, sequence_dir: Column) -> Column:
    """Why a request cannot run, or null."""
    blank = lambda c: F.coalesce(c == "", F.lit(True))
    return F.when(F.coalesce(F.size(inputs) <= 0, F.lit(True)), "no input").when(blank(output) & blank(sequence_dir), "no output")


def capture_paths(path: Column, root: Column) -> dict[str, Column]:
    """Derived paths of a capture below root; ``reason`` is set where it lies elsewhere."""
    rel = relative_to(path, root)
    out_dir = F.concat(strip_extension(rel), F.lit("_reconstruction"))
    video = F.concat(out_dir, F.lit("/pano.mp4"))
    return {
        "reason": F.when(~under_root(path, root), "outside root"),
        "rel_path": rel,
        "output_dir": out_dir,
        "output_video": video,
        "reconstruction_dir": F.concat(strip_extension(video), F.lit("_mapping")),
    }


def mapping_paths(video: Column) -> dict[str, Column]:
    """Where a video's images, database and model go."""
    work = F.concat(dirname(video), F.lit("/"), stem(video), F.lit("_mapping"))
    return {"work_dir": work, "image_dir": F.concat(work, F.lit("/images")), "database_path": F.concat(work, F.lit("/database.db")), "sparse_dir": F.concat(work, F.lit("/sparse"))}


def url_parts(path: Column) -> dict[str, Column]:
    return {"base": basename(path), "dir": dirname(path), "ending": suffix(path), "mapping": F.concat(stem(path), F.lit("_mapping"))}


def validate_output(artifacts: DataFrame, requested: str = "requested_size") -> DataFrame:
    """artifacts (size, first_frame_ok, width, height, requested_size, ...) with ``reason``, null where usable.

    In this order: the file is there and not empty, the request is a size, a frame
    decodes, the size is the one requested.
    """
    want = size_strict(F.col(requested))
    same = (F.col("width") == want["width"]) & (F.col("height") == want["height"])
    reason = (
        F.when(F.coalesce(F.col("size"), F.lit(0)) <= 0, "missing or empty")
        .when(want.isNull(), "bad size request")
        .when(~F.coalesce(F.col("first_frame_ok"), F.lit(False)), "no frame decodes")
        .when(~F.coalesce(same, F.lit(False)), "wrong size")
    )
    return artifacts.withColumn("reason", reason)


def video_report(artifacts: DataFrame) -> DataFrame:
    """artifacts (path, frame_count, width, height, ...) that are usable, with ``report``: how many frames, of which size."""
    usable = validate_output(artifacts).where(F.col("reason").isNull()).drop("reason")
    return usable.withColumn("report", F.format_string("%s: %d frames, %dx%d", "path", F.col("frame_count").cast("long"), "width", "height"))


def pending(required: DataFrame, present: DataFrame, on: list[str]) -> DataFrame:
    """Stages that have no valid artifact; a null key never has one."""
    return required.join(present, on, "left_anti")


def done_stages(artifacts: DataFrame, rate: str | None = None) -> DataFrame:
    """Stages whose artifact lets them be skipped: (run_id, stage[, rate]).

    ``stitch``: not empty, decodes, has the size requested. ``convert``: exists at
    all. ``reconstruct``: not empty; the sampling rate is not looked at unless ``rate``
    names a column that makes it part of the key. ``train`` always runs.
    """
    checked = validate_output(artifacts)
    ok = F.when(F.col("stage") == "stitch", F.col("reason").isNull()).when(F.col("stage") == "convert", F.col("size").isNotNull()).when(F.col("stage") == "reconstruct", F.col("size") > 0).otherwise(False)
    return checked.where(ok).select("run_id", "stage", *([rate] if rate else [])).distinct()
