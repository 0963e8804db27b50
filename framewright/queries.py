"""The library's queries over the test tables, and over small literal relations, with their SQL.

The tables hold no media: events stand in for frames and for progress events,
page addresses for paths, orders and their items for stages and artifacts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.functions import text as X
from framewright.operators import cli, events, frames, gates, params
from framewright.plans import pipeline, training
from framewright.sources.config import parse_call


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql_text(v: object) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    if isinstance(v, bool):
        return str(v).lower()
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _values(columns: str, rows: list[tuple]) -> str:
    """A literal relation in SQL that both engines read."""
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(_sql_text, r)) + ')' for r in rows)}) AS t({columns})"


FPS, RATE, STEP = 25.0, 2.0, 3
URL_ROOT = "https:/"
FRAME_LIST = "20-50-30-20"
TOKENS = _values(
    "run_id, pos, tok",
    [
        (run, pos, tok)
        for run, line in enumerate(
            [
                "-inputs a b -output o",
                "-inputs a -inputs b -output o",
                "-inputs a -output o -inputs b -bitrate 1",
                "-output -bitrate 5",
                "-bitrate 1 -bitrate 2",
                "-inputs a.insv -output o.mp4 -exposure 250 -tint -250 -definition -5 -stitch_type template -stitch_type aistitch -enable_flowstate",
                "-image_type png -image_type gif -image_processing_accel cpu -warmth abc -help -nonsense 7",
                "-output_size 8000x4000 -export_frame_index 20-50-30 -image_sequence_dir d -bitrate",
                "-inputs",
                "x -inputs y -disable_cuda -inputs z",
            ]
        )
        for pos, tok in enumerate(line.split(" "))
    ],
)
PATHS = _values("root, path", [("/repo", "/repo/data/v.insv"), ("/repo", "/repo2/x.insv"), ("/re_o", "/repo/v.mp4"), ("/repo", "/repo"), ("/repo", "/repo/a.b/file"), ("/repo", "/repo/x.tar.gz"), ("/a%", "/a%/clip.MP4")])
SIZES = _values("size", [(s,) for s in ("8000x4000", "8000X4000", "1x2x3", "ax4000", "", "7x", "x9", " 12 x 7 ", "-3x4", "99999999999x2", "1.5x2")])
TEXTS = _values("s", [(s,) for s in ("20-50-30", "20-50-", "", "-20", "20--", "12", " -7x", "abc", "+3", "1.9", "99999999999", "--", "q.MP4", "noext", "x.tar.gz", "a.b/file", "/top", "d/e/f.jpg", "no/", "2147483647", None)])
ARTIFACTS = _values(
    "run_id, stage, size, first_frame_ok, width, height, requested_size",
    [
        (1, "stitch", 10, True, 8000, 4000, "8000x4000"),
        (2, "stitch", 10, True, 1920, 960, "8000X4000"),
        (3, "stitch", 0, True, 8000, 4000, "8000x4000"),
        (4, "stitch", 10, False, 8000, 4000, "8000x4000"),
        (5, "stitch", 10, True, 1920, 960, "8000x4000"),
        (1, "convert", 0, False, 0, 0, ""),
        (2, "reconstruct", 0, False, 0, 0, ""),
        (3, "reconstruct", 5, False, 0, 0, ""),
        (1, "train", 5, False, 0, 0, ""),
    ],
)
REQUIRED = _values("run_id, stage", [(r, s) for r in (1, 2, 3, 4, 5) for s in ("stitch", "convert", "reconstruct", "train")])
REQUESTS = _values("run_id, n_inputs, output, sequence_dir, n_args", [(1, 2, "o", "", 1), (2, 0, "o", "", 0), (3, 1, "", "", 2), (4, 1, "", "d", 1), (5, 1, None, None, 1), (6, 0, "", "", 0)])
RUNS = _values("run_id, path, frame_rate, output_size, iterations, resolution", [(1, "/repo/data/v.insv", "", None, "7000", "2"), (2, "/elsewhere/v.insv", "4", "1920x960", "", None), (3, "/repo/a/b.c.lrv", None, "", None, "")])
CONFIG = _values("key, value", [("images", "images"), ("resolution", "4"), ("eval", None), ("data_device", "cpu"), ("sh_degree", "3")])
GIVEN = _values("key, value", [("resolution", "2"), ("images", None), ("depths", None), ("iterations", "7000"), ("data_device", "cuda"), ("white_background", "true"), ("source_path", "../in/./x")])
VIDEOS = _values(
    "path, size, first_frame_ok, width, height, frame_count, requested_size",
    [("a.mp4", 10, True, 8000, 4000, 7200, "8000x4000"), ("b.mp4", 10, True, 1920, 960, 0, "1920x960"), ("c.mp4", 10, False, 8000, 4000, 5, "8000x4000"), ("d.mp4", 10, True, 1920, 960, 9, "8000x4000"), ("e.mp4", 0, True, 8000, 4000, 9, "8000x4000")],
)
RAW_PATHS = _values("path", [(p,) for p in ("v.insv", "/repo/v.insv", "./a/../v.insv", "../up.mp4", "/repo//x/./y.mp4", "", "/", "//two/x", "///three/x", "../../../../over.mp4", "a/b/..", None)])
CONFIG_TEXT = "Namespace(sh_degree=3, source_path='/data/it, is', images=\"images\", resolution=-1, white_background=False, lambda_dssim=0.2, depths=None)"


def frame_stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _table(spark, sf_dir, "events").select(F.col("event_id").alias("frame_idx"), F.lit(FPS).alias("fps"))
    return frames.sample_at_rate(own, RATE).select("frame_idx", "image_idx", "image_name")


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    bad = (F.col("event_type") == "error") & (F.col("value") > 100)
    number = (F.row_number().over(order) - 1).cast("long")
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("capture_id"), number.alias("frame_idx"), (~bad).alias("grab_ok"), (~bad).alias("read_ok"))


def frame_prefix_until_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = frames.stride_sample(frames.until_failure(_captures(spark, sf_dir), STEP), STEP)
    return kept.select("capture_id", "frame_idx", "image_idx", "image_name")


def frame_capture_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = frame_prefix_until_failure(spark, sf_dir)
    return frames.capture_summary(_table(spark, sf_dir, "events").select(F.col("user_id").alias("capture_id")).distinct(), images)


def frame_index_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _table(spark, sf_dir, "events").select(F.col("event_id").alias("frame_idx"), "event_type")
    return frames.export_listed(own, spark.sql(f"SELECT '{FRAME_LIST}' AS frame_list"))


def _progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    percent = F.least(F.lit(100), F.floor("value")).cast("int")
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), percent.alias("percent"), "event_type")


def progress_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.progress_changes(_progress(spark, sf_dir), span=1000).select("run_id", "seq", "percent")


def run_terminal_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _progress(spark, sf_dir)
    return events.terminal_status(own, own.where((F.col("event_type") == "error") & (F.col("percent") > 60)))


def elapsed_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.elapsed(_table(spark, sf_dir, "events").withColumnRenamed("user_id", "run_id"))


def clamp_adjustment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select("c_custkey", X.clamp(F.col("c_acctbal").cast("int"), -100, 100).alias("adjusted"))


def media_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = _table(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    return urls.union(spark.sql(PATHS).select("path")).select("path", X.suffix(F.col("path")).alias("ending"), gates.media_route(F.col("path")).alias("route"))


def path_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", *[c.alias(k) for k, c in gates.url_parts(F.col("url")).items()])


def path_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql(PATHS).union(_table(spark, sf_dir, "pages").select(F.lit(URL_ROOT), "url"))
    return own.select("root", "path", *[c.alias(k) for k, c in gates.capture_paths(F.col("path"), F.col("root")).items()])


def absolute_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql(RAW_PATHS).union(_table(spark, sf_dir, "pages").select("url"))
    return own.select("path", X.absolute_path(F.col("path"), "/work/here").alias("absolute"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TEXTS).union(_table(spark, sf_dir, "pages").select("url"))


def mapping_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).where("s is not null").select("s", *[c.alias(k) for k, c in gates.mapping_paths(F.col("s")).items()])


def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s")
    tokens = X.split_tokens(s, "-")
    return _texts(spark, sf_dir).select("s", F.array_join(tokens, ",").alias("tokens"), F.size(tokens).alias("n"), X.leading_int(s).alias("number"), X.strip_extension(s).alias("stripped"), X.stem(s).alias("stem"), X.default_if_empty(s, "none").alias("given"))


def size_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lenient, strict = X.size_lenient(F.col("size")), X.size_strict(F.col("size"))
    return spark.sql(SIZES).select("size", lenient["width"].alias("width"), lenient["height"].alias("height"), strict["width"].alias("strict_width"), strict["height"].alias("strict_height"))


def stage_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"))
    present = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run_id"))
    return gates.pending(required, present, ["run_id"])


def stage_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.pending(spark.sql(REQUIRED), gates.done_stages(spark.sql(ARTIFACTS)), ["run_id", "stage"])


def output_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.validate_output(spark.sql(ARTIFACTS).where("stage = 'stitch'")).select("run_id", "reason")


def request_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql(REQUESTS)
    given = F.when(F.col("n_inputs") > 0, F.array_repeat(F.lit("a"), F.col("n_inputs"))).otherwise(F.array().cast("array<string>"))
    return own.select("run_id", gates.request_reason(given, F.col("output"), F.col("sequence_dir")).alias("reason"), gates.missing_arguments(F.col("n_args"), 1).alias("arity"))


def run_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.planned_runs(spark.sql(RUNS), "/repo")


def param_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return params.param_rows(spark, fill_none=frozenset({"model"}))


def param_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return params.extract(spark.sql(GIVEN), params.param_rows(spark), "model", "/work/here")


def param_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return params.overlay(spark.sql(CONFIG), spark.sql(GIVEN))


def param_switches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return params.resolve_switches(params.param_rows(spark), spark.sql(GIVEN).where("value = 'true'"))


def param_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = params.param_rows(spark).select("key", F.col("default_value").alias("value"))
    return params.compare_settings(declared, training.setting_rows(spark, training.settings("/w", "/w/out", iterations=7_000)).select("key", "value"))


def config_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(k, params.text_of(v)) for k, v in parse_call(CONFIG_TEXT).items()], "key string, value string")


def config_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return params.overlay(config_values(spark, sf_dir), spark.sql(GIVEN))


def training_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.setting_rows(spark, training.settings("/w", "/w/out", iterations=7_000))


def video_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.video_report(spark.sql(VIDEOS)).select("path", "frame_count", "report")


def cli_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cli.inputs(cli.parsed(spark.sql(TOKENS)))


def cli_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cli.typed_options(cli.options(cli.parsed(spark.sql(TOKENS))))


def cli_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cli.unknown(cli.parsed(spark.sql(TOKENS)))


def cli_image_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cli.effective_options(cli.options(cli.parsed(spark.sql(TOKENS))), "image")


QUERIES = {
    f.__name__: f
    for f in (
        frame_stride_sample,
        frame_prefix_until_failure,
        frame_capture_summary,
        frame_index_export,
        progress_changes,
        run_terminal_status,
        elapsed_per_run,
        clamp_adjustment,
        media_route,
        path_derive,
        path_containment,
        absolute_paths,
        mapping_paths,
        text_functions,
        size_parse,
        stage_pending,
        stage_gates,
        output_validation,
        request_check,
        run_defaults,
        param_rows,
        param_extract,
        param_overlay,
        param_switches,
        param_compare,
        config_values,
        config_overlay,
        training_settings,
        video_report,
        cli_inputs,
        cli_options,
        cli_unknown,
        cli_image_options,
    )
}

# --- SQL -----------------------------------------------------------------


def _list(names) -> str:
    return "(" + ", ".join(_sql_text(n) for n in names) + ")"


def _number(s: str) -> str:
    return f"CASE WHEN {s} IS NOT NULL THEN coalesce(try_cast(nullif(regexp_extract({s}, '^[ \\t\\n\\x0B\\f\\r]*([+-]?[0-9]+)', 1), '') AS INT), 0) END"


def _tokens(s: str, d: str) -> str:
    return f"CASE WHEN string_split({s}, '{d}')[-1] = '' THEN string_split({s}, '{d}')[:-2] ELSE string_split({s}, '{d}') END"


_PREFIX = f"""
WITH f AS (
  SELECT user_id AS capture_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx,
         NOT (event_type = 'error' AND value > 100) AS ok FROM events
), e AS (
  SELECT capture_id, min(frame_idx) AS stop FROM f WHERE NOT ok GROUP BY capture_id
), kept AS (
  SELECT f.capture_id, f.frame_idx, f.frame_idx // {STEP} AS image_idx, printf('%06d.jpg', f.frame_idx // {STEP}) AS image_name
  FROM f LEFT JOIN e ON f.capture_id = e.capture_id WHERE (stop IS NULL OR frame_idx < stop) AND frame_idx % {STEP} = 0
)"""
_DIR = "CASE WHEN NOT contains({0}, '/') THEN '.' WHEN regexp_extract({0}, '^(.*)/[^/]*$', 1) = '' THEN '/' ELSE regexp_extract({0}, '^(.*)/[^/]*$', 1) END"
_BASE = "regexp_extract({0}, '([^/]*)$', 1)"
_STRIP = "regexp_replace({0}, '\\.[^.]*$', '')"
_ROUTE = f"CASE WHEN ending IN {_list(gates.IMAGE_SUFFIXES)} THEN 'image' WHEN ending IN {_list(gates.VIDEO_SUFFIXES)} THEN 'video' ELSE 'unsupported' END"
_SUFFIX = "lower(string_split({0}, '.')[-1])"
_STRICT = "^\\s*([+-]?[0-9]+)\\s*x\\s*([+-]?[0-9]+)\\s*$"


def _derived(path: str, root: str) -> str:
    rel = f"CASE WHEN starts_with({path}, {root} || '/') THEN substr({path}, length({root}) + 2) ELSE {path} END"
    return f"CASE WHEN NOT starts_with({path}, {root} || '/') THEN 'outside root' END AS reason, {rel} AS rel_path, {_STRIP.format(f'({rel})')} || '_reconstruction' AS output_dir, {_STRIP.format(f'({rel})')} || '_reconstruction/pano.mp4' AS output_video, {_STRIP.format(f'({rel})')} || '_reconstruction/pano_mapping' AS reconstruction_dir"


_FOLD = f"""
WITH RECURSIVE t AS ({TOKENS}), n AS (
  SELECT run_id, min(pos) AS pos, '' AS mode, '' AS tok, '' AS kind, '' AS was FROM t GROUP BY run_id
), fold AS (
  SELECT run_id, pos, mode, tok, kind, was FROM n
  UNION ALL
  SELECT t.run_id, t.pos + 1,
         CASE WHEN takes THEN '' WHEN collects OR opens THEN '-inputs' WHEN t.tok IN {_list(cli.VALUE_OPTIONS)} THEN t.tok ELSE '' END,
         t.tok,
         CASE WHEN takes THEN 'option' WHEN collects THEN 'input' WHEN opens OR t.tok IN {_list(cli.VALUE_OPTIONS)} THEN 'opens' WHEN t.tok IN {_list(cli.SWITCHES)} THEN 'switch' ELSE 'unknown' END,
         f.mode
  FROM fold f JOIN (SELECT * FROM t) t ON t.run_id = f.run_id AND t.pos = f.pos
  CROSS JOIN LATERAL (SELECT f.mode NOT IN ('', '-inputs') AS takes, f.mode = '-inputs' AND NOT starts_with(t.tok, '-') AS collects, f.mode = '' AND t.tok = '-inputs' AS opens) x
), ev AS (
  SELECT run_id, pos - 1 AS pos, kind, CASE WHEN kind = 'option' THEN was ELSE tok END AS flag, CASE WHEN kind = 'switch' THEN 'true' ELSE tok END AS value FROM fold WHERE kind <> ''
), opt AS (
  SELECT run_id, flag, arg_max(value, pos) AS value FROM ev WHERE kind IN ('option', 'switch') GROUP BY run_id, flag
)"""
_INT_VALUE = f"CASE WHEN flag IN {_list(cli.INT_OPTIONS)} THEN {_number('value')} " + " ".join(f"WHEN flag = '{f}' THEN greatest({lo}, least({hi}, {_number('value')}))" for f, (lo, hi) in cli.CLAMPED_OPTIONS.items()) + " END"
_ENUM_VALUE = "CASE " + " ".join(f"WHEN flag = '{f}' THEN CASE value " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in known.items()) + f" ELSE '{cli.ENUM_DEFAULTS[f]}' END" for f, known in cli.ENUM_OPTIONS.items()) + " END"
_REASON = f"""CASE WHEN size <= 0 THEN 'missing or empty' WHEN NOT regexp_full_match(requested_size, '[+-]?[0-9]+x[+-]?[0-9]+') THEN 'bad size request'
  WHEN NOT first_frame_ok THEN 'no frame decodes' WHEN width || 'x' || height <> requested_size THEN 'wrong size' END"""
# Fixed values, written down beside the tables of the code under test: group, key, type, short form, default.
_PARAMETERS = """
model sh_degree long - 3
model source_path string s ""
model model_path string s ""
model images string s images
model depths string s ""
model resolution long s -1
model white_background boolean s false
model dynamic_memory boolean - false
model train_test_exp boolean - false
model data_device string - cuda
model eval boolean - false
model skip_interval long - 1
pipeline convert_SHs_python boolean - false
pipeline compute_cov3D_python boolean - false
pipeline debug boolean - false
pipeline antialiasing boolean - false
optimization iterations long - 30000
optimization position_lr_init double - 0.00016
optimization position_lr_final double - 1.6e-06
optimization position_lr_delay_mult double - 0.01
optimization position_lr_max_steps long - 30000
optimization feature_lr double - 0.0025
optimization opacity_lr double - 0.025
optimization scaling_lr double - 0.005
optimization rotation_lr double - 0.001
optimization exposure_lr_init double - 0.01
optimization exposure_lr_final double - 0.001
optimization exposure_lr_delay_steps long - 0
optimization exposure_lr_delay_mult double - 0.0
optimization percent_dense double - 0.01
optimization lambda_dssim double - 0.2
optimization densification_interval long - 100
optimization opacity_reset_interval long - 3000
optimization min_opacity double - 0.01
optimization max_point_screen_size long - 20
optimization densify_from_iter long - 500
optimization densify_until_iter long - 15000
optimization densify_grad_threshold double - 0.0002
optimization depth_l1_weight_init double - 1.0
optimization depth_l1_weight_final double - 0.01
optimization random_background boolean - false
optimization optimizer_type string - default
"""
# Section, key, value of a training config for /w, 7000 iterations.
_TRAINING = """
model_params model_config {'name': 'GaussianModel', 'kwargs': {}}
model_params sh_degree 3
model_params source_path /w
model_params model_path /w/out
model_params images images
model_params alpha_masks ""
model_params use_alpha_masks false
model_params use_sky_masks false
model_params use_depth false
model_params resolution 1
model_params white_background false
model_params data_device cpu
model_params eval true
model_params skybox_num 100000
model_params skybox_locked false
model_params default_camera_type 3
pipeline_params convert_SHs_python false
pipeline_params compute_cov3D_python false
pipeline_params debug false
optim_params iterations 7000
optim_params position_lr_init 0.00016
optim_params position_lr_final 1.6e-06
optim_params position_lr_delay_mult 0.01
optim_params position_lr_max_steps 30000
optim_params feature_lr 0.0025
optim_params opacity_lr 0.05
optim_params scaling_lr 0.005
optim_params rotation_lr 0.001
optim_params percent_dense 0.01
optim_params lambda_dssim 0.2
optim_params densification_interval 100
optim_params opacity_reset_interval 3000
optim_params densify_from_iter 500
optim_params densify_until_iter 15000
optim_params densify_grad_threshold 0.0002
optim_params densify_grad_abs_threshold 0.0004
optim_params prune_by_extent false
optim_params depth_l1_weight_init 0
optim_params depth_l1_weight_final 0
optim_params max_cache_num 512
optim_params skip_bottom_ratio 0
"""


def _lines(text: str, n: int) -> list[list[str]]:
    """Lines of n words, of which the last may have blanks; two quotes are an empty text."""
    return [["" if w == '""' else w for w in line.split(" ", n - 1)] for line in text.strip().split("\n")]


_PARAM_ROWS = _values("grp, key, dtype, has_short, default_value", [(g, k, t, short == "s", v) for g, k, t, short, v in _lines(_PARAMETERS, 5)])
_SETTING_ROWS = _values("section, key, value", [tuple(x) for x in _lines(_TRAINING, 3)])
_CONFIG_VALUES = _values("key, value", [("sh_degree", "3"), ("source_path", "/data/it, is"), ("images", "images"), ("resolution", "-1"), ("white_background", "false"), ("lambda_dssim", "0.2"), ("depths", None)])
_ALL_PATHS = f"SELECT root, path FROM ({PATHS}) UNION ALL SELECT '{URL_ROOT}', url FROM pages"
_ALL_TEXTS = f"SELECT s FROM ({TEXTS}) UNION ALL SELECT url FROM pages"


def _absolute(p: str, folder: str) -> str:
    """Path parts from the last to the first: each .. takes away the next that is none."""
    full = f"CASE WHEN starts_with({p}, '/') THEN {p} ELSE '{folder}/' || {p} END"
    fold = f"""list_reduce([{{'n': 0, 's': ''}}] || list_transform(list_reverse(list_filter(string_split({full}, '/'), lambda x: x NOT IN ('', '.'))), lambda x: {{'n': 0, 's': x}}),
      lambda acc, x: CASE WHEN x.s = '..' THEN {{'n': acc.n + 1, 's': acc.s}} WHEN acc.n > 0 THEN {{'n': acc.n - 1, 's': acc.s}} ELSE {{'n': 0, 's': '/' || x.s || acc.s}} END).s"""
    return f"CASE WHEN {p} IS NULL THEN NULL ELSE CASE WHEN regexp_matches({full}, '^//([^/]|$)') THEN '/' ELSE '' END || coalesce(nullif({fold}, ''), '/') END"


ORACLE = {
    "frame_stride_sample": f"SELECT event_id AS frame_idx, event_id // s AS image_idx, printf('%06d.jpg', event_id // s) AS image_name FROM events, (SELECT greatest(1, round_even({FPS} / {RATE}, 0)::BIGINT) AS s) WHERE event_id % s = 0",
    "frame_prefix_until_failure": _PREFIX + " SELECT * FROM kept",
    "frame_capture_summary": _PREFIX + " SELECT c.capture_id, count(kept.frame_idx) AS n_images, CASE WHEN count(kept.frame_idx) = 0 THEN 'no frames' END AS reason FROM (SELECT DISTINCT user_id AS capture_id FROM events) c LEFT JOIN kept ON c.capture_id = kept.capture_id GROUP BY c.capture_id",
    "frame_index_export": f"SELECT event_id AS frame_idx, event_type FROM events WHERE event_id IN ({FRAME_LIST.replace('-', ', ')})",
    "progress_changes": "SELECT run_id, seq, percent FROM (SELECT user_id AS run_id, event_id AS seq, least(100, floor(value))::INT AS percent, lag(least(100, floor(value))::INT, 1, 0) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) WHERE percent <> before",
    "run_terminal_status": "SELECT user_id AS run_id, bool_or(least(100, floor(value)) = 100) AS finished, bool_or(event_type = 'error' AND least(100, floor(value)) > 60) AS failed, bool_or(least(100, floor(value)) = 100 OR (event_type = 'error' AND least(100, floor(value)) > 60)) AS terminal FROM events GROUP BY user_id",
    "elapsed_per_run": "SELECT user_id AS run_id, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS elapsed_ms FROM events GROUP BY user_id",
    "clamp_adjustment": "SELECT c_custkey, greatest(-100, least(100, trunc(c_acctbal)::INT)) AS adjusted FROM customer",
    "media_route": f"SELECT path, ending, {_ROUTE} AS route FROM (SELECT path, {_SUFFIX.format('path')} AS ending FROM (SELECT url AS path FROM pages UNION ALL SELECT path FROM ({PATHS})))",
    "path_derive": f"SELECT page_id, {_BASE.format('url')} AS base, {_DIR.format('url')} AS dir, {_SUFFIX.format('url')} AS ending, {_STRIP.format(_BASE.format('url'))} || '_mapping' AS mapping FROM pages",
    "path_containment": f"SELECT root, path, {_derived('path', 'root')} FROM ({_ALL_PATHS})",
    "absolute_paths": f"SELECT path, {_absolute('path', '/work/here')} AS absolute FROM (SELECT path FROM ({RAW_PATHS}) UNION ALL SELECT url FROM pages)",
    "mapping_paths": f"SELECT s, w AS work_dir, w || '/images' AS image_dir, w || '/database.db' AS database_path, w || '/sparse' AS sparse_dir FROM (SELECT s, {_DIR.format('s')} || '/' || {_STRIP.format(_BASE.format('s'))} || '_mapping' AS w FROM ({_ALL_TEXTS}) WHERE s IS NOT NULL)",
    "text_functions": f"SELECT s, CASE WHEN s IS NOT NULL THEN array_to_string({_tokens('s', '-')}, ',') END AS tokens, len({_tokens('s', '-')})::INT AS n, {_number('s')} AS number, {_STRIP.format('s')} AS stripped, {_STRIP.format(_BASE.format('s'))} AS stem, coalesce(nullif(s, ''), 'none') AS given FROM ({_ALL_TEXTS})",
    "size_parse": f"SELECT size, CASE WHEN len(p) = 2 THEN {_number('p[1]')} ELSE 1920 END AS width, CASE WHEN len(p) = 2 THEN {_number('p[2]')} ELSE 960 END AS height, CASE WHEN b IS NOT NULL THEN a END AS strict_width, CASE WHEN a IS NOT NULL THEN b END AS strict_height FROM (SELECT size, {_tokens('size', 'x')} AS p, try_cast(nullif(regexp_extract(size, '{_STRICT}', 1), '') AS INT) AS a, try_cast(nullif(regexp_extract(size, '{_STRICT}', 2), '') AS INT) AS b FROM ({SIZES}))",
    "stage_pending": "SELECT o_orderkey AS run_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "stage_gates": f"SELECT run_id, stage FROM ({REQUIRED}) EXCEPT SELECT run_id, stage FROM (SELECT *, {_REASON} AS reason FROM ({ARTIFACTS})) WHERE (stage = 'stitch' AND reason IS NULL) OR stage = 'convert' OR (stage = 'reconstruct' AND size > 0)",
    "output_validation": f"SELECT run_id, {_REASON} AS reason FROM ({ARTIFACTS}) WHERE stage = 'stitch'",
    "request_check": f"SELECT run_id, CASE WHEN n_inputs = 0 THEN 'no input' WHEN coalesce(output, '') = '' AND coalesce(sequence_dir, '') = '' THEN 'no output' END AS reason, CASE WHEN n_args < 1 THEN 'too few arguments' END AS arity FROM ({REQUESTS})",
    "run_defaults": "SELECT run_id, path, " + ", ".join(f"coalesce(nullif({k}, ''), '{v}') AS {k}" for k, v in pipeline.DEFAULTS.items()) + f", {_derived('path', chr(39) + '/repo' + chr(39))} FROM ({RUNS})",
    "param_rows": f"SELECT grp, key, dtype, has_short, CASE WHEN grp <> 'model' THEN default_value END AS default_value FROM ({_PARAM_ROWS})",
    "param_extract": f"SELECT key, CASE WHEN key = 'source_path' THEN '/work/in/x' ELSE value END AS value FROM ({GIVEN}) WHERE key IN (SELECT key FROM ({_PARAM_ROWS}) WHERE grp = 'model')",
    "param_overlay": f"SELECT coalesce(g.key, c.key) AS key, coalesce(g.value, c.value) AS value FROM ({CONFIG}) c FULL JOIN ({GIVEN}) g ON c.key = g.key WHERE c.key IS NOT NULL OR g.value IS NOT NULL",
    "param_switches": f"SELECT grp, key, default_value = 'true' OR key IN (SELECT key FROM ({GIVEN}) WHERE value = 'true') AS value FROM ({_PARAM_ROWS}) WHERE dtype = 'boolean'",
    "param_compare": f"SELECT coalesce(a.key, b.key) AS key, default_value AS left_value, value AS right_value, CASE WHEN b.key IS NULL THEN 'left only' WHEN a.key IS NULL THEN 'right only' WHEN default_value IS NOT DISTINCT FROM value THEN 'equal' ELSE 'differs' END AS status FROM ({_PARAM_ROWS}) a FULL JOIN ({_SETTING_ROWS}) b ON a.key = b.key",
    "config_values": _CONFIG_VALUES,
    "config_overlay": f"SELECT coalesce(g.key, c.key) AS key, coalesce(g.value, c.value) AS value FROM ({_CONFIG_VALUES}) c FULL JOIN ({GIVEN}) g ON c.key = g.key WHERE c.key IS NOT NULL OR g.value IS NOT NULL",
    "training_settings": _SETTING_ROWS,
    "video_report": f"SELECT path, frame_count, path || ': ' || frame_count || ' frames, ' || width || 'x' || height AS report FROM (SELECT *, {_REASON} AS reason FROM ({VIDEOS})) WHERE reason IS NULL",
    "cli_inputs": _FOLD + " SELECT run_id, (row_number() OVER (PARTITION BY run_id ORDER BY pos) - 1)::INT AS input_idx, value AS path FROM ev WHERE kind = 'input'",
    "cli_options": _FOLD + f" SELECT run_id, flag, value, {_INT_VALUE} AS int_value, {_ENUM_VALUE} AS enum_value FROM opt",
    "cli_unknown": _FOLD + " SELECT run_id, pos, value AS tok FROM ev WHERE kind = 'unknown'",
    "cli_image_options": _FOLD + f" SELECT run_id, flag, value FROM opt WHERE flag NOT IN {_list(cli.VIDEO_ONLY)}",
}
