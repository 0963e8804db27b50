"""The training config: three sections of fixed settings, two paths and two numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewright.operators.params import text_of

# The sections' settings; None is filled in for each run.
MODEL = {
    "model_config": {"name": "GaussianModel", "kwargs": {}},
    "sh_degree": 3,
    "source_path": None,
    "model_path": None,
    "images": "images",
    "alpha_masks": "",
    "use_alpha_masks": False,
    "use_sky_masks": False,
    "use_depth": False,
    "resolution": None,
    "white_background": False,
    "data_device": "cpu",
    "eval": True,
    "skybox_num": 100_000,
    "skybox_locked": False,
    "default_camera_type": 3,
}
PIPELINE = {"convert_SHs_python": False, "compute_cov3D_python": False, "debug": False}
OPTIM = {
    "iterations": None,
    "position_lr_init": 0.00016,
    "position_lr_final": 0.0000016,
    "position_lr_delay_mult": 0.01,
    "position_lr_max_steps": 30_000,
    "feature_lr": 0.0025,
    "opacity_lr": 0.05,
    "scaling_lr": 0.005,
    "rotation_lr": 0.001,
    "percent_dense": 0.01,
    "lambda_dssim": 0.2,
    "densification_interval": 100,
    "opacity_reset_interval": 3000,
    "densify_from_iter": 500,
    "densify_until_iter": 15_000,
    "densify_grad_threshold": 0.0002,
    "densify_grad_abs_threshold": 0.0004,
    "prune_by_extent": False,
    "depth_l1_weight_init": 0,
    "depth_l1_weight_final": 0,
    "max_cache_num": 512,
    "skip_bottom_ratio": 0,
}


def settings(source_path: str, model_path: str, resolution: int = 1, iterations: int = 30_000) -> dict[str, dict[str, object]]:
    """The three sections. Steps that depend on the number of iterations do not follow it."""
    model = MODEL | {"source_path": source_path, "model_path": model_path, "resolution": resolution}
    return {"model_params": model, "pipeline_params": dict(PIPELINE), "optim_params": OPTIM | {"iterations": iterations}}


def to_yaml(sections: dict[str, dict[str, object]]) -> str:
    """The sections as YAML, texts quoted and escaped."""

    def value(v: object) -> str:
        if isinstance(v, dict):
            return "{" + ", ".join(f"{k}: {value(x)}" for k, x in v.items()) + "}"
        if isinstance(v, str):
            return '"' + v.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n") + '"'
        if isinstance(v, float):
            return f"{v:.10f}".rstrip("0")
        return text_of(v)

    return "\n".join(f"{name}:\n" + "".join(f"  {k}: {value(v)}\n" for k, v in section.items()) for name, section in sections.items())


def setting_rows(spark: SparkSession, sections: dict[str, dict[str, object]]) -> DataFrame:
    """(section, key, value), nested settings as text."""
    rows = [(s, k, str(v) if isinstance(v, dict) else text_of(v)) for s, section in sections.items() for k, v in section.items()]
    return spark.createDataFrame(rows, "section string, key string, value string")
