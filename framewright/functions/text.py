"""String and number functions of the command line and of paths, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SLASH_FREE = r"([^/]*)$"


def default_if_empty(value: Column, default: str) -> Column:
    """The value, or the default where it is null or the empty string."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def split_tokens(text: Column, delimiter: str) -> Column:
    """Tokens between delimiters, without the empty one after a delimiter that ends the text.

    An empty text has no token; null stays null.
    """
    parts = F.split(text, re.escape(delimiter))
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def leading_int(text: Column) -> Column:
    """The integer at the start of a text, after white space and with a sign, else 0; also 0 beyond 32 bits. Null stays null."""
    digits = F.nullif(F.regexp_extract(text, r"^[ \t\n\x0B\f\r]*([+-]?[0-9]+)", 1), F.lit(""))
    return F.when(text.isNotNull(), F.coalesce(digits.try_cast("int"), F.lit(0)))


def clamp(value: Column, low: int, high: int) -> Column:
    """The value within low and high; null stays null."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def suffix(path: Column) -> Column:
    """What follows the last dot, in lower case; the whole path if it has none."""
    return F.lower(F.substring_index(path, ".", -1))


def strip_extension(path: Column) -> Column:
    """The path before its last dot, wherever that is: a dot in a folder counts too."""
    return F.regexp_replace(path, r"\.[^.]*$", "")


def basename(path: Column) -> Column:
    return F.regexp_extract(path, _SLASH_FREE, 1)


def dirname(path: Column) -> Column:
    """What precedes the last slash: ``.`` without a slash, ``/`` for what lies in the root."""
    head = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return F.when(~F.contains(path, F.lit("/")), F.lit(".")).when(head == "", F.lit("/")).otherwise(head)


def stem(path: Column) -> Column:
    return strip_extension(basename(path))


def absolute_path(path: Column, folder: str) -> Column:
    """The path, from ``folder`` on if it does not start with a slash, without ``.``, ``..`` and needless slashes. Null stays null.

    Two slashes at the start stay, as POSIX has it; three or more are one.
    """
    full = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit(folder.rstrip("/") + "/"), path))
    parts = F.filter(F.split(full, "/"), lambda x: (x != "") & (x != "."))
    empty = F.array().cast("array<string>")
    kept = F.aggregate(parts, empty, lambda acc, x: F.when(x != "..", F.concat(acc, F.array(x))).otherwise(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))))
    lead = F.when(full.rlike("^//([^/]|$)"), F.lit("//")).otherwise(F.lit("/"))
    return F.when(path.isNotNull(), F.concat(lead, F.array_join(kept, "/")))


def under_root(path: Column, root: Column) -> Column:
    """Whether the path lies below root; ``/repo2/x`` is not below ``/repo``, and no character is a wildcard."""
    return F.startswith(path, F.concat(root, F.lit("/")))


def relative_to(path: Column, root: Column) -> Column:
    """The path below root; paths elsewhere are unchanged."""
    return F.when(under_root(path, root), F.substr(path, F.length(root) + F.lit(2))).otherwise(path)


def size_lenient(text: Column, default: tuple[int, int] = (1920, 960)) -> Column:
    """Width and height of ``WxH``, each by its leading integer; the default unless there are exactly two parts."""
    parts = split_tokens(text, "x")
    fits = F.coalesce(F.size(parts) == 2, F.lit(False))
    part = lambda i: F.when(fits, leading_int(F.get(parts, F.lit(i)))).otherwise(F.lit(default[i]))
    return F.struct(part(0).alias("width"), part(1).alias("height"))


def size_strict(text: Column) -> Column:
    """Width and height of a text that is two integers around an ``x``, else null."""
    pattern = r"^\s*([+-]?[0-9]+)\s*x\s*([+-]?[0-9]+)\s*$"
    number = lambda i: F.nullif(F.regexp_extract(text, pattern, i), F.lit("")).try_cast("int")
    return F.when(number(1).isNotNull() & number(2).isNotNull(), F.struct(number(1).alias("width"), number(2).alias("height")))


def frame_name(index: Column) -> Column:
    """``000007.jpg``: six digits, more where needed."""
    return F.format_string("%06d.jpg", index.cast("long"))


def sampling_step(fps: Column, rate: float) -> Column:
    """Frames from one sample to the next, 1 at least; halves are rounded to the even neighbour. fps 0 or null counts as the rate."""
    return F.greatest(F.lit(1).cast("long"), F.rint(F.coalesce(F.nullif(fps, F.lit(0.0)), F.lit(rate)) / F.lit(rate)).cast("long"))
