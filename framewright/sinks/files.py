"""Manifests of images, images, and the files of a run."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.plans.training import to_yaml
from framewright.workers import find_package


def write_manifest(images: DataFrame, path: str, capture: str = "capture_id") -> None:
    """Writes the numbered images' names, a folder for each capture. Numbers are taken whether or not an image could be written."""
    images.select(capture, "frame_idx", "image_idx", "image_name").repartition(capture, F.floor(F.col("image_idx") / 1_000_000)).write.mode("overwrite").partitionBy(capture).parquet(path)


def write_images(images: DataFrame, folder: str) -> int:
    """Writes (image_name, image) to files in folder, one of the file systems that Arrow knows by its URI; returns how many.

    Each task writes its own rows' files. An image without bytes leaves no file, its number is taken all the same. A file that
    is there already is replaced, so that a task may run again.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        uri = re.sub(r"^file:/(?!/)", "file:///", folder)
        system, path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
        system.create_dir(path, recursive=True)
        for batch in batches:
            n = 0
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if name is not None and data.is_valid:
                    with system.open_output_stream(f"{path}/{name}") as out:
                        out.write(data.as_py())
                    n += 1
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    find_package(images.sparkSession)
    written = images.select("image_name", "image").mapInArrow(write, "n long")
    return int(written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


def write_training_config(path: str, sections: dict[str, dict[str, object]]) -> None:
    """Writes one run's config; a few kilobytes, by the driver."""
    with open(path, "w", encoding="utf-8") as f:
        f.write(to_yaml(sections))
