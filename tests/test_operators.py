"""Operators against plain loops, and their edge cases."""

from __future__ import annotations

import math
import random

import pytest
from framewright.functions import text as X
from framewright.operators import cli, events, frames, gates, params
from framewright.plans import pipeline, training
from framewright.sinks.files import write_images, write_manifest, write_training_config
from framewright.sources.config import combined_arguments, command_line_values, parse_call, read_config
from framewright.sources.media import FrameSource, PropertySource, frames_of, media_files, properties_of
from framewright.streaming.progress import progress_changes, run_bounded, run_status
from pyspark.sql import functions as F


def test_sampling_step(spark):
    cases = [(25.0, 2.0, 12), (0.0, 2.0, 1), (1.0, 2.0, 1), (29.97, 2.0, 15), (30.0, 2.0, 15), (59.94, 2.0, 30), (None, 2.0, 1), (27.0, 2.0, 14)]
    for fps, rate, want in cases:
        got = spark.range(1).select(X.sampling_step(F.lit(fps).cast("double"), rate).alias("s")).first()["s"]
        assert got == want == max(1, round((fps or rate) / rate))


def test_frame_name_is_not_cut(spark):
    assert spark.range(1).select(X.frame_name(F.lit(1_000_000))).first()[0] == "1000000.jpg"


def test_clamp(spark):
    rows = spark.createDataFrame([(250,), (-250,), (5,), (None,)], "v int").select(X.clamp(F.col("v"), -100, 100)).collect()
    assert [r[0] for r in rows] == [100, -100, 5, None]


def _loop(oks: list[tuple[bool, bool]], step: int) -> list[int]:
    """Grab what is skipped, read what is kept, stop at the first that fails."""
    kept = []
    for i, (grab, read) in enumerate(oks):
        if i % step:
            if not grab:
                break
        elif not read:
            break
        else:
            kept.append(i)
    return kept


def test_until_failure_is_the_loop(spark):
    rng = random.Random(5)
    captures = {c: [(rng.random() > 0.03, rng.random() > 0.05) for _ in range(rng.randint(0, 60))] for c in range(40)}
    rows = [(c, i, g, r) for c, oks in captures.items() for i, (g, r) in enumerate(oks)]
    df = spark.createDataFrame(rows, "capture_id long, frame_idx long, grab_ok boolean, read_ok boolean")
    for step in (1, 2, 5):
        kept = frames.stride_sample(frames.until_failure(df, step), step).collect()
        got: dict[int, list] = {}
        for r in kept:
            got.setdefault(r["capture_id"], []).append((r["frame_idx"], r["image_idx"]))
        for c, oks in captures.items():
            assert sorted(got.get(c, [])) == [(i, n) for n, i in enumerate(_loop(oks, step))]


def test_until_failure_nulls_and_empty(spark):
    schema = "capture_id long, frame_idx long, grab_ok boolean, read_ok boolean"
    df = spark.createDataFrame([(None, 0, True, True), (None, 1, None, True), (None, 2, True, True), (1, 0, False, None)], schema)
    assert [(r[0], r[1]) for r in frames.until_failure(df, 2).collect()] == [(None, 0)]
    assert frames.until_failure(spark.createDataFrame([], schema), 2).count() == 0


def test_capture_without_frames_has_a_reason(spark):
    captures = spark.createDataFrame([(1,), (2,)], "capture_id long")
    images = spark.createDataFrame([(1, 0)], "capture_id long, image_idx long")
    assert sorted(map(tuple, frames.capture_summary(captures, images).collect())) == [(1, 1, None), (2, 0, "no frames")]


def _cli_loop(tokens: list[str]) -> tuple[list[str], dict[str, str], list[str]]:
    i, inputs, opts, odd = 0, [], {}, []
    while i < len(tokens):
        tok = tokens[i]
        if tok == "-inputs":
            i += 1
            while i < len(tokens) and not tokens[i].startswith("-"):
                inputs.append(tokens[i])
                i += 1
            if i == len(tokens):
                break
            tok = tokens[i]
        if tok in cli.VALUE_OPTIONS:
            i += 1
            if i < len(tokens):
                opts[tok] = tokens[i]
        elif tok in cli.SWITCHES:
            opts[tok] = "true"
        else:
            odd.append(tok)
        i += 1
    return inputs, opts, odd


def test_command_lines_are_the_loop(spark):
    rng = random.Random(11)
    words = ["-inputs", "-inputs", "-output", "-bitrate", "-exposure", "-help", "-enable_flowstate", "-odd", "a", "b", "7", ""]
    lines = {r: [rng.choice(words) for _ in range(rng.randint(1, 14))] for r in range(300)}
    rows = [(r, i, t) for r, line in lines.items() for i, t in enumerate(line)]
    rng.shuffle(rows)
    ev = cli.parsed(spark.createDataFrame(rows, "run_id long, pos int, tok string")).cache()
    got_in: dict[int, list] = {r: [] for r in lines}
    for r in sorted(cli.inputs(ev).collect()):
        got_in[r["run_id"]].append(r["path"])
    got_opt: dict[int, dict] = {r: {} for r in lines}
    for r in cli.options(ev).collect():
        got_opt[r["run_id"]][r["flag"]] = r["value"]
    got_odd: dict[int, list] = {r: [] for r in lines}
    for r in sorted(cli.unknown(ev).collect()):
        got_odd[r["run_id"]].append(r["tok"])
    for r, line in lines.items():
        assert (got_in[r], got_opt[r], got_odd[r]) == _cli_loop(line)


def test_overlay_is_the_dict_merge(spark):
    rng = random.Random(3)
    for _ in range(5):
        cfg = {k: rng.choice([None, "1", "2"]) for k in rng.sample("abcdefgh", 5)}
        given = {k: rng.choice([None, "8", "9"]) for k in rng.sample("abcdefgh", 5)}
        want = dict(cfg) | {k: v for k, v in given.items() if v is not None}
        schema = "key string, value string"
        got = params.overlay(spark.createDataFrame(list(cfg.items()), schema), spark.createDataFrame(list(given.items()), schema))
        assert {r["key"]: r["value"] for r in got.collect()} == want


def test_group_schema():
    fields = {f.name: f.dataType.simpleString() for f in params.group_schema(params.MODEL_PARAMS)}
    assert fields["source_path"] == "string" and fields["resolution"] == "bigint" and fields["eval"] == "boolean"
    assert [len(d) for d in params.GROUPS.values()] == [12, 4, 26]


def test_config_is_parsed_not_run(spark, tmp_path):
    (tmp_path / "cfg").write_text("Namespace(a=1, b='x, y', c=None, d=True)")
    assert sorted(map(tuple, read_config(spark, str(tmp_path / "cfg")).collect())) == [("a", "1"), ("b", "x, y"), ("c", None), ("d", "true")]
    for bad in ("Namespace(a=open('x'))", "1 + 1", "f(1)", "f(**x)"):
        with pytest.raises(ValueError):
            parse_call(bad)
    rows = dict(map(tuple, command_line_values(spark, {"source_path": "x", "b": None}).collect()))
    assert rows["source_path"].startswith("/") and rows["b"] is None


def test_rate_aware_gate(spark):
    schema = "run_id long, stage string, size long, first_frame_ok boolean, width int, height int, requested_size string, rate string"
    done = gates.done_stages(spark.createDataFrame([(1, "reconstruct", 5, None, None, None, None, "2")], schema), rate="rate")
    required = spark.createDataFrame([(1, "reconstruct", "2"), (1, "reconstruct", "4")], "run_id long, stage string, rate string")
    assert [r["rate"] for r in gates.pending(required, done, ["run_id", "stage", "rate"]).collect()] == ["4"]


def test_first_input_decides(spark):
    row = spark.range(1).select(gates.capture_route(F.array(F.lit("a.MP4"), F.lit("b.jpg"))), gates.media_route(F.lit("noext"))).first()
    assert tuple(row) == ("video", "unsupported")


@pytest.mark.parametrize("span", [1, 3, 1000])
def test_progress_changes_over_stretches(spark, span):
    rng = random.Random(span)
    rows = [(run, seq, rng.choice([0, 0, 5, 100, None])) for run in (None, "a", "b") for seq in range(20) if rng.random() < 0.8]
    got = events.progress_changes(spark.createDataFrame(rows, "run_id string, seq long, percent int"), span=span)
    want, before = [], {}
    for run, seq, p in rows:
        if (p or 0) != before.get(run, 0):
            want.append((run, seq, p))
        before[run] = p or 0
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_any_state_event_fails_a_run(spark):
    progress = spark.createDataFrame([("a", 100), ("b", 101), ("c", 5)], "run_id string, percent int")
    states = spark.createDataFrame([("c", 0)], "run_id string, error int")
    assert sorted(map(tuple, events.terminal_status(progress, states).collect())) == [("a", True, False, True), ("b", False, False, False), ("c", False, True, True)]


def test_stages_stop_at_the_first_error():
    ran = []

    def fail():
        raise OSError("no")

    out = pipeline.run_stages({"stitch": lambda: ran.append(1), "reconstruct": fail, "train": lambda: ran.append(2)})
    assert ran == [1] and [(r.stage, r.ran, r.error) for r in out] == [("stitch", True, None), ("reconstruct", True, "OSError: no")]
    assert [r.ran for r in pipeline.run_stages({"stitch": fail, "train": lambda: None}, frozenset({"stitch"}))] == [False, True]


def test_training_config(tmp_path):
    sections = training.settings('/w "x"', "/w/out", resolution=2, iterations=7_000)
    write_training_config(str(tmp_path / "c.yaml"), sections)
    text = (tmp_path / "c.yaml").read_text()
    assert '  source_path: "/w \\"x\\""' in text and "  iterations: 7000" in text and "  position_lr_max_steps: 30000" in text and "position_lr_final: 0.0000016" in text
    for line in ("model_params:", "pipeline_params:", "optim_params:", '  model_config: {name: "GaussianModel", kwargs: {}}', "  resolution: 2", "  eval: true", '  alpha_masks: ""', "  densify_grad_abs_threshold: 0.0004", "  prune_by_extent: false", "  lambda_dssim: 0.2", "  depth_l1_weight_init: 0", "  max_cache_num: 512"):
        assert line in text.split("\n")
    assert [len(s) for s in sections.values()] == [16, 3, 22] and math.isclose(sections["optim_params"]["opacity_lr"], 0.05)


def test_media_files_and_manifest(spark, tmp_path):
    for name in ("a.insp", "b.mp4", "c.txt", "D.JPG", "E.InSp"):
        (tmp_path / name).write_bytes(b"x")
    got = {r["path"].rpartition("/")[2]: r["route"] for r in media_files(spark, str(tmp_path)).collect()}
    assert got == {"a.insp": "image", "b.mp4": "video", "c.txt": "unsupported", "D.JPG": "image", "E.InSp": "image"}
    assert media_files(spark, str(tmp_path), images_only=True).count() == 3
    images = frames.stride_sample(spark.createDataFrame([("v", i) for i in range(7)], "capture_id string, frame_idx long"), 3)
    write_manifest(images, str(tmp_path / "m"))
    assert sorted(r["image_name"] for r in spark.read.parquet(str(tmp_path / "m")).collect()) == ["000000.jpg", "000001.jpg", "000002.jpg"]


def test_progress_stream(spark, tmp_path):
    schema = "run_id string, seq long, percent long"
    for part, rows in enumerate([[("a", 0, 0), ("a", 1, 5), ("b", 0, 7)], [("a", 2, 5), ("a", 3, 100), ("b", 1, 7)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    query = progress_changes(stream).writeStream.format("memory").queryName("changes").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    assert run_bounded(query, 120)
    assert sorted(map(tuple, spark.table("changes").collect())) == [("a", 1, 5), ("a", 3, 100), ("b", 0, 7)]


def test_frame_source_without_decoder(spark):
    spark.dataSource.register(FrameSource)
    df = spark.read.format("video_frames").option("paths", "").load()
    assert df.columns == ["capture_id", "frame_idx", "fps", "grab_ok", "read_ok", "image"] and df.count() == 0
    spark.dataSource.register(PropertySource)
    df = spark.read.format("video_properties").option("paths", "[]").load()
    assert df.columns == ["capture_id", "fps", "width", "height", "frame_count", "first_frame_ok"] and df.count() == 0


class _FakeVideo:
    """A decoder's answers: frames by number, of which some cannot be grabbed or read."""

    def __init__(self, n: int, fps: float = 25.0, no_grab: tuple = (), no_read: tuple = ()):
        self.n, self.fps, self.no_grab, self.no_read, self.at, self.decoded = n, fps, no_grab, no_read, -1, []

    def get(self, what):
        return {3: 640.0, 4: 320.0, 5: self.fps, 7: float(self.n)}[what]

    def grab(self):
        self.at += 1
        return self.at < self.n and self.at not in self.no_grab

    def retrieve(self):
        self.decoded.append(self.at)
        return (False, None) if self.at in self.no_read else (True, f"pixels{self.at}")

    def read(self):
        return self.retrieve() if self.grab() else (False, None)


def test_skipped_frames_are_grabbed_only():
    video = _FakeVideo(30)
    rows = list(frames_of(video, rate=2.0, encode=str.encode))
    assert [r[0] for r in rows] == video.decoded == [0, 12, 24] and rows[1][1:] == (25.0, True, True, b"pixels12")
    assert [r[0] for r in frames_of(_FakeVideo(7), step=3)] == [0, 3, 6]
    assert [r[0] for r in frames_of(_FakeVideo(9, no_grab=(4,)), step=3)] == [0, 3]
    assert [(r[0], r[3]) for r in frames_of(_FakeVideo(9, no_read=(4, 6)), step=3)] == [(0, True), (3, True), (6, False)]
    assert list(frames_of(_FakeVideo(0))) == [] and [r[0] for r in frames_of(_FakeVideo(3, fps=0.0), rate=2.0)] == [0, 1, 2]


def test_sampled_frames_are_what_the_operators_keep(spark):
    """Reading with a step gives the images of reading all, cut at the first failure and sampled."""
    rng = random.Random(8)
    for _ in range(4):
        n, step = rng.randint(5, 40), rng.choice([2, 3, 5])
        bad = dict(no_grab=(rng.randrange(n * 2),), no_read=(rng.randrange(n * 2),))
        ok = [r[0] for r in frames_of(_FakeVideo(n, **bad), step=step) if r[3]]
        every = [("v", i, i not in bad["no_grab"], i not in bad["no_read"] and i not in bad["no_grab"]) for i in range(n)]
        df = spark.createDataFrame(every, "capture_id string, frame_idx long, grab_ok boolean, read_ok boolean")
        assert sorted(r["frame_idx"] for r in frames.stride_sample(frames.until_failure(df, step), step).collect()) == ok


def test_video_properties():
    assert properties_of(_FakeVideo(9)) == (25.0, 640, 320, 9, True)
    assert properties_of(_FakeVideo(0)) == (25.0, 640, 320, 0, False)


def test_images_are_written(spark, tmp_path):
    rows = [("000000.jpg", b"a"), ("000001.jpg", None), ("000002.jpg", b"c"), (None, b"d")]
    images = spark.createDataFrame(rows, "image_name string, image binary").repartition(2)
    for _ in range(2):
        assert write_images(images, str(tmp_path / "out")) == 2
    assert {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()} == {"000000.jpg": b"a", "000002.jpg": b"c"}
    assert write_images(images.limit(0), str(tmp_path / "none")) == 0


def test_absolute_paths_are_the_systems(spark):
    import os

    rng = random.Random(2)
    paths = ["".join(rng.choices(["a", "..", ".", "/", "b.c"], k=rng.randint(0, 7))) for _ in range(300)] + [None]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select("p", X.absolute_path(F.col("p"), "/x/y").alias("a")).collect()
    assert all(r["a"] == (None if r["p"] is None else os.path.normpath(os.path.join("/x/y", r["p"]))) for r in got)


def test_config_under_a_command_line(spark, tmp_path):
    (tmp_path / "cfg_args").write_text("Namespace(images='i', eval=None, resolution=4, source_path='/s')")
    got = dict(map(tuple, combined_arguments(spark, str(tmp_path), {"resolution": 2, "images": None, "depths": None, "debug": True}).collect()))
    assert got == {"images": "i", "eval": None, "resolution": "2", "source_path": "/s", "debug": "true"}
    assert dict(map(tuple, combined_arguments(spark, None, {"a": 1}).collect())) == {"a": "1"}
    (tmp_path / "cfg_args").write_text("")
    with pytest.raises(ValueError):
        combined_arguments(spark, str(tmp_path), {})


def test_busy_run_in_one_micro_batch(spark, tmp_path):
    """More events than one frame holds, shuffled."""
    rows = [("a", seq, seq // 10_000 * 30) for seq in range(30_000)]
    random.Random(1).shuffle(rows)
    schema = "run_id string, seq long, percent long"
    spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    query = progress_changes(stream).writeStream.format("memory").queryName("busy").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    assert run_bounded(query, 120)
    assert sorted(map(tuple, spark.table("busy").collect())) == [("a", 10_000, 30), ("a", 20_000, 60)]


def test_silent_runs_are_forgotten():
    import pandas as pd
    from framewright.streaming.progress import _changes

    class State:
        exists, hasTimedOut, kept, duration = False, False, None, None

        @property
        def get(self):
            return self.kept

        def update(self, value):
            self.exists, self.kept = True, value

        def remove(self):
            self.exists, self.kept = False, None

        def setTimeoutDuration(self, ms):
            self.duration = ms

    state, run = State(), _changes(5000)
    frame = lambda *rows: pd.DataFrame(rows, columns=["run_id", "seq", "percent"])
    out = pd.concat(run(("a",), iter([frame(("a", 2, 7)), frame(("a", 1, 5), ("a", 3, None))]), state))
    assert out["seq"].tolist() == [1, 2, 3] and state.kept == (0,) and state.duration == 5000
    state.hasTimedOut = True
    assert list(run(("a",), iter([]), state)) == [] and not state.exists


def test_status_stream_is_the_batch(spark, tmp_path):
    from datetime import datetime, timedelta

    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    progress = [("a", at(0), 5), ("a", at(2), 100), ("b", at(1), 50), ("c", at(3), 101), ("d", at(600), 1), ("d", at(1200), 1)]
    states = [("b", at(4)), ("d", at(601))]
    for name, rows, schema in (("p", progress, "run_id string, ts timestamp, percent int"), ("s", states, "run_id string, ts timestamp")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name))
    p, s = (spark.readStream.schema(x).parquet(str(tmp_path / n)) for n, x in (("p", "run_id string, ts timestamp, percent int"), ("s", "run_id string, ts timestamp")))
    query = run_status(p, s).writeStream.format("memory").queryName("ended").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    assert run_bounded(query, 120)
    got = sorted(map(tuple, spark.table("ended").collect()))
    assert got[:3] == [("a", True, False, True, 120_000), ("b", False, True, True, 180_000), ("c", False, False, False, 0)]
    assert ("d", False, True, True, 60_000) in got
