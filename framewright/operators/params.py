"""Parameter groups: schemas by declaration, defaults, extraction, and overlay of a command line on a config."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.functions.text import absolute_path

# Keys, defaults and which keys have a one-letter form (marked by a leading _).
MODEL_PARAMS = {"sh_degree": 3, "_source_path": "", "_model_path": "", "_images": "images", "_depths": "", "_resolution": -1, "_white_background": False, "dynamic_memory": False, "train_test_exp": False, "data_device": "cuda", "eval": False, "skip_interval": 1}
PIPELINE_PARAMS = {"convert_SHs_python": False, "compute_cov3D_python": False, "debug": False, "antialiasing": False}
OPTIMIZATION_PARAMS = {
    "iterations": 30_000,
    "position_lr_init": 0.00016,
    "position_lr_final": 0.0000016,
    "position_lr_delay_mult": 0.01,
    "position_lr_max_steps": 30_000,
    "feature_lr": 0.0025,
    "opacity_lr": 0.025,
    "scaling_lr": 0.005,
    "rotation_lr": 0.001,
    "exposure_lr_init": 0.01,
    "exposure_lr_final": 0.001,
    "exposure_lr_delay_steps": 0,
    "exposure_lr_delay_mult": 0.0,
    "percent_dense": 0.01,
    "lambda_dssim": 0.2,
    "densification_interval": 100,
    "opacity_reset_interval": 3000,
    "min_opacity": 0.01,
    "max_point_screen_size": 20,
    "densify_from_iter": 500,
    "densify_until_iter": 15_000,
    "densify_grad_threshold": 0.0002,
    "depth_l1_weight_init": 1.0,
    "depth_l1_weight_final": 0.01,
    "random_background": False,
    "optimizer_type": "default",
}
GROUPS = {"model": MODEL_PARAMS, "pipeline": PIPELINE_PARAMS, "optimization": OPTIMIZATION_PARAMS}

_TYPES = {bool: ("boolean", T.BooleanType()), int: ("long", T.LongType()), float: ("double", T.DoubleType()), str: ("string", T.StringType())}
SCHEMA = "grp string, key string, dtype string, has_short boolean, default_value string"


def text_of(value: object) -> str | None:
    """A parameter's value as the text that the relations hold."""
    if value is None:
        return None
    return str(value).lower() if isinstance(value, bool) else str(value)


def group_schema(declared: dict[str, object]) -> T.StructType:
    """The struct of a group; each field has its default's type."""
    return T.StructType([T.StructField(k.removeprefix("_"), _TYPES[type(v)][1]) for k, v in declared.items()])


def group_rows(declared: dict[str, object], grp: str, fill_none: bool = False) -> list[tuple]:
    """A row for each parameter; with fill_none the defaults are null, so that a config shows through."""
    return [(grp, k.removeprefix("_"), _TYPES[type(v)][0], k.startswith("_"), None if fill_none else text_of(v)) for k, v in declared.items()]


def param_rows(spark: SparkSession, groups: dict[str, dict[str, object]] | None = None, fill_none: frozenset[str] = frozenset()) -> DataFrame:
    """All groups' parameters as (grp, key, dtype, has_short, default_value)."""
    rows = [r for grp, declared in (groups or GROUPS).items() for r in group_rows(declared, grp, grp in fill_none)]
    return spark.createDataFrame(rows, SCHEMA)


def extract(values: DataFrame, params: DataFrame, grp: str, folder: str | None = None) -> DataFrame:
    """The values (key, value) whose keys the group declares.

    With ``folder``, the working folder, the group ``model`` gets its ``source_path`` absolute; an empty one is the folder itself.
    """
    own = values.join(params.where(F.col("grp") == grp).select("key"), "key", "left_semi")
    if grp != "model" or folder is None:
        return own
    return own.withColumn("value", F.when(F.col("key") == "source_path", absolute_path(F.col("value"), folder)).otherwise(F.col("value")))


def resolve_switches(params: DataFrame, given: DataFrame) -> DataFrame:
    """Booleans with what was given (key): a switch can only turn on."""
    named = given.select(F.col("key").alias("_key")).distinct()
    on = params.where(F.col("dtype") == "boolean").join(named, params["key"] == named["_key"], "left")
    return on.select("grp", "key", (F.col("_key").isNotNull() | F.coalesce(F.col("default_value") == "true", F.lit(False))).alias("value"))


def overlay(config: DataFrame, command_line: DataFrame) -> DataFrame:
    """config and command_line (key, value) to one: the command line wins where it has a value.

    A config's key stays even if its value is null; one that only the command line has, with null, goes.
    """
    cfg = config.select("key", F.col("value").alias("cfg_value"), F.lit(True).alias("in_cfg"))
    cli = command_line.select("key", F.col("value").alias("cli_value"))
    both = cfg.join(cli, "key", "full_outer")
    return both.where(F.col("in_cfg") | F.col("cli_value").isNotNull()).select("key", F.coalesce("cli_value", "cfg_value").alias("value"))


def compare_settings(left: DataFrame, right: DataFrame) -> DataFrame:
    """(key, value) twice to each key's ``status``: equal, differs, left only, right only."""
    a, b = left.select("key", F.col("value").alias("left_value"), F.lit(True).alias("in_left")), right.select("key", F.col("value").alias("right_value"), F.lit(True).alias("in_right"))
    status = F.when(F.col("in_right").isNull(), "left only").when(F.col("in_left").isNull(), "right only").when(F.col("left_value").eqNullSafe(F.col("right_value")), "equal").otherwise("differs")
    return a.join(b, "key", "full_outer").select("key", "left_value", "right_value", status.alias("status"))
