"""Command lines as a relation (run_id, pos, tok)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.text import clamp, leading_int

# The options, by how they read what follows them, and their defaults.
INPUTS = "-inputs"
TEXT_OPTIONS = ("-output", "-model_root_dir", "-output_size", "-image_sequence_dir", "-export_frame_index")
ENUM_OPTIONS = {"-stitch_type": {"optflow": "OPTFLOW", "dynamicstitch": "DYNAMICSTITCH", "aistitch": "AIFLOW"}, "-image_processing_accel": {"auto": "AUTO", "cpu": "CPU"}, "-image_type": {"jpg": "JPEG", "png": "PNG"}}
ENUM_DEFAULTS = {"-stitch_type": "OPTFLOW", "-image_processing_accel": "AUTO", "-image_type": "JPEG"}
INT_OPTIONS = ("-bitrate", "-camera_accessory_type")
CLAMPED_OPTIONS = {
    "-exposure": (-100, 100),
    "-highlights": (-100, 100),
    "-shadows": (-100, 100),
    "-contrast": (-100, 100),
    "-brightness": (-100, 100),
    "-blackpoint": (-100, 100),
    "-saturation": (-100, 100),
    "-vibrance": (-100, 100),
    "-warmth": (-100, 100),
    "-tint": (-100, 100),
    "-definition": (0, 100),
}
SWITCHES = ("-enable_coolingshell", "-enable_flowstate", "-disable_cuda", "-enable_stitchfusion", "-enable_denoise", "-enable_colorplus", "-enable_directionlock", "-enable_h265_encoder", "-enable_deflicker", "-enable_defringe", "-enable_soft_encode", "-enable_soft_decode", "-enable_debug_info", "-help")
#: Options that a still image's stitching does not look at.
VIDEO_ONLY = ("-enable_directionlock", "-enable_h265_encoder", "-bitrate", "-image_sequence_dir", "-image_type", "-export_frame_index", "-enable_deflicker", "-enable_defringe", "-enable_soft_encode", "-enable_soft_decode")
VALUE_OPTIONS = (*TEXT_OPTIONS, *ENUM_OPTIONS, *INT_OPTIONS, *CLAMPED_OPTIONS)

_EVENT = "array<struct<pos:int,kind:string,flag:string,value:string>>"


def parsed(tokens: DataFrame) -> DataFrame:
    """What each token turned out to be: run_id, pos, kind (input, option, switch, unknown), flag, value.

    A fold over each run's tokens in the order of pos. An option takes the next token
    whatever it looks like; one at the end of the line takes none. ``-inputs`` takes tokens up to
    the next that starts with ``-``, which is then read as an option, but not as another
    ``-inputs``: one that directly ends a list of inputs is unknown, and so is what follows it.

    A command line is at most some kilobytes, so a run's tokens fit in a row.
    """
    line = tokens.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("pos", "tok"))).alias("line"))
    values, switches = F.array(*map(F.lit, VALUE_OPTIONS)), F.array(*map(F.lit, SWITCHES))

    def event(t: Column, kind: str, flag: Column, value: Column) -> Column:
        return F.array(F.struct(t["pos"].cast("int").alias("pos"), F.lit(kind).alias("kind"), flag.cast("string").alias("flag"), value.cast("string").alias("value")))

    def step(acc: Column, t: Column) -> Column:
        mode, tok = acc["mode"], F.coalesce(t["tok"], F.lit(""))
        none = F.lit(None).cast("string")
        collects = (mode == INPUTS) & ~F.startswith(tok, F.lit("-"))
        takes = (mode != "") & (mode != INPUTS)
        opens = (mode == "") & (tok == INPUTS)
        is_value, is_switch = F.array_contains(values, tok), F.array_contains(switches, tok)
        new = (
            F.when(takes, event(t, "option", mode, tok))
            .when(collects, event(t, "input", F.lit(INPUTS), tok))
            .when(opens | is_value, F.array().cast(_EVENT))
            .when(is_switch, event(t, "switch", tok, F.lit("true")))
            .otherwise(event(t, "unknown", none, tok))
        )
        then = F.when(takes, F.lit("")).when(collects | opens, F.lit(INPUTS)).when(is_value, tok).otherwise(F.lit(""))
        return F.struct(then.alias("mode"), F.concat(acc["events"], new).alias("events"))

    start = F.struct(F.lit("").alias("mode"), F.array().cast(_EVENT).alias("events"))
    return line.select("run_id", F.explode(F.aggregate("line", start, step, lambda acc: acc["events"])).alias("e")).select("run_id", "e.*")


def inputs(events: DataFrame) -> DataFrame:
    """(run_id, input_idx, path), in the order given."""
    own = events.where(F.col("kind") == "input").groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("i"))
    return own.select("run_id", F.posexplode("i").alias("input_idx", "i")).select("run_id", "input_idx", F.col("i.value").alias("path"))


def options(events: DataFrame) -> DataFrame:
    """(run_id, flag, value): of an option given more than once the last counts."""
    return events.where(F.col("kind").isin("option", "switch")).groupBy("run_id", "flag").agg(F.max_by("value", "pos").alias("value"))


def typed_options(opts: DataFrame) -> DataFrame:
    """options with ``int_value``, clamped where the option is, and ``enum_value``, the default where the value is not known."""
    number = leading_int(F.col("value"))
    as_int = F.when(F.col("flag").isin(*INT_OPTIONS), number)
    for flag, (low, high) in CLAMPED_OPTIONS.items():
        as_int = F.when(F.col("flag") == flag, clamp(number, low, high)).otherwise(as_int)
    as_enum = F.lit(None).cast("string")
    for flag, known in ENUM_OPTIONS.items():
        own = F.lit(ENUM_DEFAULTS[flag])
        for name, meaning in known.items():
            own = F.when(F.col("value") == name, F.lit(meaning)).otherwise(own)
        as_enum = F.when(F.col("flag") == flag, own).otherwise(as_enum)
    return opts.select("run_id", "flag", "value", as_int.alias("int_value"), as_enum.alias("enum_value"))


def unknown(events: DataFrame) -> DataFrame:
    """(run_id, pos, tok): tokens that nothing read."""
    return events.where(F.col("kind") == "unknown").select("run_id", "pos", F.col("value").alias("tok"))


def effective_options(opts: DataFrame, route: str) -> DataFrame:
    """The options that a run of this route looks at."""
    return opts.where(~F.col("flag").isin(*VIDEO_ONLY)) if route == "image" else opts
