"""Line dedup: windows of three consecutive lines that occur again anywhere are removed where they recur.

Lines are compared without the white space around them; blank lines belong to no
window and always stay. Of the places at which a window occurs the first, by document
and then by line, keeps its lines. Every later one loses its three lines, less
those that the first occurrence has in the same document, so that a run of
equal lines keeps one window. The places that windows cover are merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import cut_lineage, read_table, small

WINDOW = 3
#: A window's occurrences are dealt over so many tasks, for one window may have most of them.
SALTS = 16
#: Documents that lose lines, and lines lost, that are sent to all executors at most (some 16 bytes each); more are joined by an exchange.
BROADCAST_ROWS = 500_000


def _lines(text: Column) -> Column:
    """The text's lines as structs of place and stripped line, without blank ones."""
    split = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x, i: F.struct(i.alias("at"), F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "").alias("line")))
    return F.filter(split, lambda x: x["line"] != "")


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to a row for each window: doc_id, t (a hash of the text), w (its number in the document), at (its lines' places), h1 and h2, a 128-bit hash of its lines."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("t"), _lines(F.col("text")).alias("l")).where(F.size("l") >= WINDOW)
    n = F.size("l") - (WINDOW - 1)
    rows = lines.select("doc_id", "t", F.posexplode(F.arrays_zip(F.slice("l", 1, n).alias("a"), F.slice("l", 2, n).alias("b"), F.slice("l", 3, n).alias("c"))).alias("w", "x"))
    own = [F.col(f"x.{k}.line") for k in "abc"]
    return rows.select("doc_id", "t", "w", F.array("x.a.at", "x.b.at", "x.c.at").alias("at"), F.xxhash64(*own).alias("h1"), F.xxhash64(F.lit(7), own[2], own[0], own[1]).alias("h2"))


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to (doc_id, t, gone): the places of the lines to remove, merged over all windows that cover them.

    Windows are made once and kept in the shared folder. They go through one exchange to find what recurs, minima and counts being
    taken before it, and through another to join that to its occurrences; both carry
    hashes and numbers only. Each occurrence draws one of ``SALTS`` tasks, and what
    recurs is sent to all of them.
    """
    found = cut_lineage(windows(docs))
    again = found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "t", "w")).alias("first")).where(F.col("n") > 1)
    again = again.select("h1", "h2", F.col("first.doc_id").alias("first_doc"), F.col("first.t").alias("first_t"), F.col("first.w").alias("first_w"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    later = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "t", "w"), F.lit(SALTS)).cast("int")).join(again, ["h1", "h2", "salt"])
    same = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("t") == F.col("first_t"))
    later = later.where(~(same & (F.col("w") == F.col("first_w"))))
    lost = F.filter("at", lambda x, k: ~same | (F.col("w") + k >= F.col("first_w") + WINDOW))
    return later.select("doc_id", "t", F.explode(lost).alias("line")).groupBy("doc_id", "t").agg(F.collect_set("line").alias("gone"))  # at most a document's lines


def line_dedup(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) to the same with text shortened, n_lines, n_removed and spans (runs of removed lines).

    Every row stays, with an empty text if all its lines go; texts that lose nothing are
    unchanged, to the byte. Null texts stay null. An id and a text name a document: rows that share an id, or
    have none, but hold other texts are documents of their own, in the order of id (null first), then of the text's hash; rows that
    are equal in both are one document and lose the same lines. Columns of docs that are named
    like those added are replaced.
    """
    gone = cut_lineage(removed_lines(docs.select("doc_id", "text"))).withColumnsRenamed({"doc_id": "_id", "t": "_t", "gone": "_gone"})
    n = gone.agg(F.count("*") + F.coalesce(F.sum(F.size("_gone")), F.lit(0))).first()[0]
    own = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))  # so that no column of docs is taken for one of ours
    joined = own.join(small(gone, n, BROADCAST_ROWS), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_t")), "left")
    joined = joined.withColumn("_places", F.array_sort(F.coalesce("_gone", F.array().cast("array<int>"))))
    raw = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_raw") - 1), F.col("_places"))
    joined = joined.withColumn("_raw", F.when(F.col("_gone").isNotNull(), raw)).withColumn("_stay", F.when(F.col("_raw").isNotNull(), stay))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform("_stay", lambda i: F.get("_raw", i)), "\n"))
    firsts = F.filter("_places", lambda p, i: (i == 0) | (F.get("_places", i - 1) != p - 1))
    lasts = F.filter("_places", lambda p, i: F.coalesce(F.get("_places", i + 1) != p + 1, F.lit(True)))
    spans = F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), b.alias("last")))
    n_lines = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("long")
    added = {"n_lines": n_lines, "n_removed": F.size("_places").cast("long"), "spans": spans}
    columns = [text.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns if c not in added]
    return joined.select(*columns, *[c.alias(k) for k, c in added.items()])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what is left of its text. Extra columns are not read."""
    out = line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["first"].cast("string"), s["last"].cast("string"))), ",")
    return out.select("doc_id", "n_lines", "n_removed", spans.alias("spans"), "text")


ORACLE_SQL = f"""
WITH raw AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS ln FROM documents
), shown AS (
  SELECT doc_id, ln, regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS line,
         row_number() OVER (PARTITION BY doc_id ORDER BY ln) - 1 AS w
  FROM raw WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), win AS (
  SELECT doc_id, w, [line, lead(line, 1) OVER d, lead(line, 2) OVER d] AS x, lead(line, 2) OVER d IS NOT NULL AS whole
  FROM shown WINDOW d AS (PARTITION BY doc_id ORDER BY w)
), ranked AS (
  SELECT doc_id, w, first_value(doc_id) OVER f AS first_doc, first_value(w) OVER f AS first_w
  FROM win WHERE whole WINDOW f AS (PARTITION BY x ORDER BY doc_id, w)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = first_doc THEN greatest(w, first_w + {WINDOW}) ELSE w END, w + {WINDOW})) AS w
  FROM ranked WHERE NOT (doc_id = first_doc AND w = first_w)
), flagged AS (
  SELECT raw.doc_id, raw.ln, raw.line, shown.w IS NOT NULL AS visible, gone.w IS NOT NULL AS lost
  FROM raw LEFT JOIN shown ON raw.doc_id = shown.doc_id AND raw.ln = shown.ln
           LEFT JOIN gone ON shown.doc_id = gone.doc_id AND shown.w = gone.w
), runs AS (
  SELECT doc_id, min(ln) || '-' || max(ln) AS span, min(ln) AS a
  FROM (SELECT doc_id, ln, ln - row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS g FROM flagged WHERE lost) GROUP BY doc_id, g
), spans AS (
  SELECT doc_id, string_agg(span, ',' ORDER BY a) AS spans FROM runs GROUP BY doc_id
), texts AS (
  SELECT doc_id, count(*) FILTER (visible) AS n_lines, count(*) FILTER (lost) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY ln) FILTER (NOT lost), '') AS text
  FROM flagged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(spans, '') AS spans, CASE WHEN d.text IS NULL THEN NULL ELSE t.text END AS text
FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id LEFT JOIN spans s ON d.doc_id = s.doc_id
"""

QUERIES = {"op1_line_dedup": op1_line_dedup}
ORACLE = {"op1_line_dedup": ORACLE_SQL}
