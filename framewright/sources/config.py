"""Config files that hold a call's keyword arguments as text, like ``Namespace(a=1, b='x')``."""

from __future__ import annotations

import ast
import os

from pyspark.sql import DataFrame, SparkSession

from framewright.operators.params import overlay, text_of


def parse_call(text: str) -> dict[str, object]:
    """The keyword arguments, which must be literals. Nothing is evaluated."""
    try:
        tree = ast.parse(text.strip(), mode="eval").body
    except SyntaxError as e:
        raise ValueError("not a call with keyword arguments only") from e
    if not isinstance(tree, ast.Call) or tree.args or any(k.arg is None for k in tree.keywords):
        raise ValueError("not a call with keyword arguments only")
    return {k.arg: ast.literal_eval(k.value) for k in tree.keywords}


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """One config file as (key, value). A missing file raises."""
    text = spark.read.text(path, wholetext=True).first()
    values = parse_call(text[0] if text else "")
    return spark.createDataFrame([(k, text_of(v)) for k, v in values.items()], "key string, value string")


def command_line_values(spark: SparkSession, given: dict[str, object]) -> DataFrame:
    """Values given on a command line as (key, value); ``source_path`` is made absolute."""
    given = {k: os.path.abspath(v) if k == "source_path" and isinstance(v, str) else v for k, v in given.items()}
    return spark.createDataFrame([(k, text_of(v)) for k, v in given.items()], "key string, value string")


def combined_arguments(spark: SparkSession, model_path: str | None, given: dict[str, object], config_name: str = "cfg_args") -> DataFrame:
    """A command line's values over those of the config file in ``model_path``, as (key, value).

    Without a model path there is no config. A config file that is missing, empty or no call raises.
    """
    config = spark.createDataFrame([], "key string, value string") if model_path is None else read_config(spark, os.path.join(model_path, config_name))
    return overlay(config, command_line_values(spark, given))
