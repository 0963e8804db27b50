"""Media files, frames and video properties. Decoding needs an optional library; what is done with a decoder's answers is tested without it."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from framewright.operators.gates import media_route

#: Numbers by which a decoder knows a video's properties.
WIDTH, HEIGHT, FPS, FRAME_COUNT = 3, 4, 5, 7


def media_files(spark: SparkSession, folder: str, images_only: bool = False) -> DataFrame:
    """Files below folder as (path, modified, size, route), or its images only, by the suffix in any case. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    files = files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"), media_route(F.col("path")).alias("route"))
    return files.where(F.col("route") == "image") if images_only else files


def open_video(path: str):
    try:
        import cv2
    except ImportError as e:
        raise RuntimeError("reading videos needs OpenCV") from e
    return cv2.VideoCapture(path)


def to_jpeg(pixels) -> bytes | None:
    import cv2

    ok, data = cv2.imencode(".jpg", pixels)
    return data.tobytes() if ok else None


def step_of(fps: float, rate: float) -> int:
    """Frames from one sample to the next, as ``functions.text.sampling_step``."""
    return max(1, round((fps or rate) / rate))


def frames_of(video, step: int = 1, rate: float | None = None, encode=None) -> Iterator[tuple]:
    """(frame_idx, fps, grab_ok, read_ok, image) of every step-th frame of an open video, up to the first that fails.

    With ``rate`` the step follows from the video's own frames a second. Frames in between are grabbed, not decoded. A kept
    frame that cannot be read ends the video with a row that says so; a skipped one that cannot be grabbed ends it, as its end does.
    ``encode`` makes an image's bytes; without it there are none.
    """
    fps = float(video.get(FPS))
    step = step_of(fps, rate) if rate else step
    index = 0
    while True:
        if not video.grab():
            return
        if index % step == 0:
            ok, pixels = video.retrieve()
            yield index, fps, True, bool(ok), encode(pixels) if ok and encode else None
            if not ok:
                return
        index += 1


def properties_of(video) -> tuple[float, int, int, int, bool]:
    """fps, width, height, frame count and whether a frame decodes, of an open video."""
    first = bool(video.read()[0])
    return float(video.get(FPS)), int(video.get(WIDTH)), int(video.get(HEIGHT)), int(video.get(FRAME_COUNT)), first


class _Video(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        paths = options.get("paths", "")
        self.paths = json.loads(paths) if paths.startswith("[") else [p for p in paths.split(",") if p]
        self.step = int(options.get("step", 1))
        self.rate = float(options["rate"]) if options.get("rate") else None
        self.images = options.get("images", "false").lower() == "true"
        if self.step < 1 or (self.rate is not None and self.rate <= 0):
            raise ValueError("step and rate must be positive")

    def partitions(self) -> list[InputPartition]:
        return [_Video(p) for p in self.paths]


class _FrameReader(_Reader):
    def read(self, partition: _Video | None) -> Iterator[tuple]:
        if partition is None:  # no paths
            return
        video = open_video(partition.path)
        if not video.isOpened():
            raise OSError(f"cannot open {partition.path}")
        for row in frames_of(video, self.step, self.rate, to_jpeg if self.images else None):
            yield partition.path, *row


class FrameSource(DataSource):
    """``spark.read.format("video_frames").option("paths", "a.mp4,b.mp4")``: a row for each frame, a task for each video.

    paths: with commas in between, or a JSON list. step, or rate (frames a second): which frames
    are decoded. images: ``true`` for their JPEG bytes.
    """

    @classmethod
    def name(cls) -> str:
        return "video_frames"

    def schema(self) -> str:
        return "capture_id string, frame_idx long, fps double, grab_ok boolean, read_ok boolean, image binary"

    def reader(self, schema) -> DataSourceReader:
        return _FrameReader(self.options)


class _PropertyReader(_Reader):
    def read(self, partition: _Video | None) -> Iterator[tuple]:
        if partition is not None:
            yield partition.path, *properties_of(open_video(partition.path))


class PropertySource(DataSource):
    """``spark.read.format("video_properties").option("paths", ...)``: a row for each video; one that does not open has no frame that decodes."""

    @classmethod
    def name(cls) -> str:
        return "video_properties"

    def schema(self) -> str:
        return "capture_id string, fps double, width int, height int, frame_count long, first_frame_ok boolean"

    def reader(self, schema) -> DataSourceReader:
        return _PropertyReader(self.options)
