"""Mixing sources to target weights by Pareto order sampling.

Each source gets a number of words by its weight. Every document of a source first
gets the whole copies that all of them surely get; what is left of the source's
target is filled by Pareto order sampling: documents are ranked by their random odds
over their inclusion odds, u/(1-u) : p/(1-p), and the lowest ranks are taken until
the sample has the size that is left, counted in words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.llm.common import WORD, cut_lineage, read_table, uniform

MAX_COPIES = 3
WEIGHT_CYCLE = 3
SEED = "mix-1"
#: Documents under this many words have half the exposure of the others.
FRAGMENT_WORDS = 50
#: Rows that share one bucket of ranks, and so one task's sort, on average.
BUCKET_ROWS = 50_000
MIN_BUCKETS = 64
#: Documents that go in or out one by one after the cut, to bring a source nearer its target.
FIT_STEPS = 3
#: Halvings of the interval in which the fraction of a source's documents is looked for.
HALVINGS = 60
#: Most sources of a plan that is sent to all executors: some MB at a few hundred bytes each.
BROADCAST_SOURCES = 10_000
#: A source's rows are dealt over so many tasks where they meet its targets.
SALTS = 16


def source_targets(per_source: DataFrame, max_copies: int = MAX_COPIES, cycle: int = WEIGHT_CYCLE) -> DataFrame:
    """(source, source_size, n_rows) to the same with ``target``, in words.

    Weights are 1 to ``cycle``, repeating over the sources by code point, null last.
    The targets share the sum of all sizes by weight; one that is above
    ``max_copies`` times its source's size stops there and the excess goes to the
    others by weight, until none is above. Filling sources in the order of cap over
    weight finds that fixed point in one pass: the level L of words for each unit of
    weight only rises while sources below it are set aside, so its maximum is the level.

    The windows here run over one row for each source, not over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per_source.withColumn("w", ((F.row_number().over(by_name) - 1) % cycle + 1).cast("double")).withColumn("cap", (F.col("source_size") * max_copies).cast("double"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    gone = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    level = (F.sum(F.col("source_size").cast("double")).over(everything) - gone("cap")) / (F.sum("w").over(everything) - gone("w"))
    return ranked.withColumn("level", level).withColumn("target", F.least(F.col("cap"), F.col("w") * F.max("level").over(everything))).select("source", "source_size", "n_rows", "target")


def pareto_rank(fraction: Column, exposure: Column, u: Column) -> Column:
    """Random odds over inclusion odds, as a number in (0, 1); ascending order is the sample's order.

    A document of exposure g is included with probability p = 1 - (1 - fraction)^g, so that
    exposures of any size give probabilities below 1; the fraction is such that the probabilities times the sizes add up to what is left (``plan_mix``).
    """
    p = F.lit(1.0) - F.pow(F.lit(1.0) - fraction, exposure)
    q = (u / (F.lit(1.0) - u)) / (p / (F.lit(1.0) - p))
    return F.when((p > 0) & (p < 1), q / (F.lit(1.0) + q)).otherwise(u)


def _fraction() -> Column:
    """The f for which sizes times 1 - (1 - f)^exposure, summed over ``classes`` (exposure, class_size), are ``left``: by halving (0, 1)."""

    def taken(f: Column) -> Column:
        return F.aggregate("classes", F.lit(0.0), lambda acc, c: acc + c["class_size"].cast("double") * (F.lit(1.0) - F.pow(F.lit(1.0) - f, c["exposure"])))

    def half(acc: Column, _: Column) -> Column:
        middle = (acc["low"] + acc["high"]) / 2
        short = taken(middle) < F.col("left")
        return F.struct(F.when(short, middle).otherwise(acc["low"]).alias("low"), F.when(short, acc["high"]).otherwise(middle).alias("high"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high")), half)
    return found["high"]


def by_source(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """left joined to right by source, with null equal to null."""
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, left["source"].eqNullSafe(right["_source"]), how).drop("_source")


def ranked(rows: DataFrame, plan: DataFrame, seed: str, plan_rows: int | None = None) -> DataFrame:
    """rows with their source's part of the plan, their rank, and the bucket it falls in.

    A plan of at most ``BROADCAST_SOURCES`` sources (``plan_rows``, counted) is sent to all
    executors; else rows and sources meet by source and salt, so that no source's
    rows meet in one task.
    """
    if plan_rows is not None and plan_rows <= BROADCAST_SOURCES:
        right = plan.withColumnRenamed("source", "_source")
        joined = rows.join(F.broadcast(right), rows["source"].eqNullSafe(right["_source"])).drop("_source")
    else:
        right = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("source", "_source")
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        joined = salted.join(right, salted["source"].eqNullSafe(right["_source"]) & (F.col("salt") == F.col("_salt"))).drop("_source", "_salt", "salt")
    joined = joined.withColumn("rank", pareto_rank(F.col("fraction"), F.col("exposure"), uniform(F.lit(seed), F.col("doc_id"))))
    return joined.withColumn("bucket", F.floor(F.col("rank") * F.col("buckets")))


def _fitted() -> Column:
    """Whether a ranked row is one of those that went in or out after the cut."""
    return F.exists("fits", lambda f: f["doc_id"].eqNullSafe(F.col("doc_id")) & (f["rank"] == F.col("rank")) & (f["size"] == F.col("size")))


def _drawn() -> Column:
    """Whether a ranked row is in the sample: before its source's cut, but for those that went in or out."""
    upto = F.struct("rank", "doc_id", "size") <= F.col("cut")
    before = F.coalesce((F.col("fraction") > 0) & ((F.col("bucket") < F.col("edge")) | ((F.col("bucket") == F.col("edge")) & upto)), F.lit(False))
    return before != F.coalesce(_fitted(), F.lit(False))


def plan_mix(rows: DataFrame, max_copies: int = MAX_COPIES, seed: str = SEED) -> tuple[DataFrame, int]:
    """rows (doc_id, source, size, exposure) to a row for each source: target, whole copies, and where its sample is cut; and their number.

    The cut through the order is the one that comes nearest the target; then up to
    ``FIT_STEPS`` times the document goes in (or out, where too much is taken) whose size
    brings the source nearest, if there is one that brings it nearer.

    A source may hold any share of the rows: it is never gathered. Ranks are cut into
    buckets, sums by bucket find the one through which the cut goes, and only that
    bucket's rows, about ``BUCKET_ROWS``, are sorted together.
    """
    # A row for each source and exposure; exposures are a few classes.
    classes = rows.groupBy("source", "exposure").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("class_size"), F.count("*").alias("n"))
    classed = F.collect_list(F.struct("exposure", "class_size")).alias("classes")
    sums = cut_lineage(classes.groupBy("source").agg(F.sum("class_size").alias("source_size"), F.sum("n").alias("n_rows"), F.sort_array(classed).alias("classes")))
    per_copy = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = (
        by_source(source_targets(sums.drop("classes"), max_copies), sums.select("source", "classes"), "inner")
        .withColumn("whole", F.least(F.floor(per_copy), F.lit(max_copies)).cast("long"))
        .withColumn("left", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
        .withColumn("fraction", F.when(F.col("left") > 0, _fraction()).otherwise(F.lit(0.0)))
        .drop("classes")
        .withColumn("buckets", F.greatest(F.lit(MIN_BUCKETS), F.ceil(F.col("n_rows") / BUCKET_ROWS)))
    )
    plan = cut_lineage(plan)
    n = plan.count()

    by_bucket = ranked(rows, plan, seed, n).groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"), F.first("left").alias("left"))
    start = F.coalesce(F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = by_bucket.withColumn("start", start).where((F.col("start") <= F.col("left")) & (F.col("left") < F.col("start") + F.col("bucket_size")))
    edge = cut_lineage(edge.select("source", F.col("bucket").alias("edge"), "start"))
    plan = cut_lineage(by_source(plan, edge, "left"))

    in_edge = ranked(rows, plan, seed, n).where(F.col("bucket") == F.col("edge"))
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "size")
    before = F.col("start") + F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_edge = in_edge.withColumn("before", before)
    fits = (F.col("before") + F.col("size") <= F.col("left")) | ((F.col("before") < F.col("left")) & (F.col("before") + F.col("size") / 2 < F.col("left")))
    cut = in_edge.where(fits).groupBy("source").agg(F.max(F.struct("rank", "doc_id", "size")).alias("cut"), F.max(F.col("before") + F.col("size")).alias("end"))
    plan = by_source(plan, cut, "left")
    no_fits = F.array().cast("array<struct<rank:double,doc_id:{},size:{}>>".format(rows.schema["doc_id"].dataType.simpleString(), rows.schema["size"].dataType.simpleString()))
    plan = cut_lineage(plan.withColumn("short", F.col("left") - F.coalesce("end", "start", F.lit(0))).withColumn("fits", no_fits))

    for _ in range(FIT_STEPS):
        miss = F.abs(F.abs("short") - F.col("size"))
        useful = (F.col("fraction") > 0) & (F.col("size") > 0) & (miss < F.abs("short")) & (_drawn() == (F.col("short") < 0)) & ~F.coalesce(_fitted(), F.lit(False))
        fit = ranked(rows, plan, seed, n).where(useful).groupBy("source").agg(F.min(F.struct(miss.alias("miss"), F.col("rank"), F.col("doc_id"), F.col("size"))).alias("fit"))
        plan = by_source(plan, fit, "left")
        found = F.col("fit").isNotNull()
        fits = F.when(found, F.concat("fits", F.array(F.struct("fit.rank", "fit.doc_id", "fit.size")))).otherwise(F.col("fits"))
        short = F.when(found, F.col("short") - F.when(F.col("short") > 0, F.col("fit.size")).otherwise(-F.col("fit.size"))).otherwise(F.col("short"))
        plan = cut_lineage(plan.withColumns({"fits": fits, "short": short}).drop("fit"))
    return plan, n


def draw(rows: DataFrame, plan: DataFrame, plan_rows: int, max_copies: int = MAX_COPIES, seed: str = SEED) -> DataFrame:
    """rows (doc_id, source, size, exposure, ...) with source_size, target and ``copies``, of a plan that was made for them."""
    drawn = ranked(rows, plan, seed, plan_rows)
    copies = F.col("whole") + _drawn().cast("long")
    return drawn.withColumn("copies", F.least(copies, F.lit(max_copies).cast("long"))).select(*rows.columns, "source_size", "target", "copies")


def mix(rows: DataFrame, max_copies: int = MAX_COPIES, seed: str = SEED) -> DataFrame:
    """rows (doc_id, source, size, exposure) to the same with source_size, target and ``copies``, whole ones only.

    Seed and ids alone decide, so reruns agree. Rows with equal id and size are ranked
    alike and stay or go together.
    """
    plan, n = plan_mix(rows, max_copies, seed)
    return draw(rows, plan, n, max_copies, seed)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, each as often as the mix takes it."""
    plan, n = plan_mix(cut_lineage(measured(docs)))
    own = docs.columns
    size = word_count(F.col("text"))
    named = docs.select(*[F.col(c).alias(f"own_{c}") for c in own], "doc_id", "source", size.alias("size")).withColumn("exposure", exposure(F.col("size")))
    taken = draw(named, plan, n).where(F.col("copies") > 0)
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*[F.col(f"own_{c}").alias(c) for c in own])


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def exposure(size: Column) -> Column:
    return F.when(size < FRAGMENT_WORDS, 0.5).otherwise(1.0)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, exposure."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size")).withColumn("exposure", exposure(F.col("size")))


def op10_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: what each gives, in words, with its source's target.

    A null text has size 0 and gives nothing; null is a source of its own, the last.
    Extra columns are not read; an empty table gives an empty result.
    """
    rows = cut_lineage(measured(read_table(spark, sf_dir, "documents")))
    return mix(rows).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def _fit_sql() -> str:
    useful = "f > 0 AND size > 0 AND NOT used AND abs(abs(short) - size) < abs(short) AND hit = (short < 0)"
    steps = ""
    for i in range(FIT_STEPS):
        steps += f""", f{i} AS (
  SELECT *, coalesce({useful} AND row_number() OVER (PARTITION BY source, {useful} ORDER BY abs(abs(short) - size), rank, doc_id, size) = 1, false) AS moved FROM s{i}
), s{i + 1} AS (
  SELECT * EXCLUDE (hit, used, short, moved), hit <> moved AS hit, used OR moved AS used,
         short - sum(CASE WHEN moved AND short > 0 THEN size WHEN moved THEN -size ELSE 0 END) OVER (PARTITION BY source) AS short FROM f{i}
)"""
    return steps


ORACLE_SQL = f"""
WITH base AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), rows AS (
  SELECT *, CASE WHEN size < {FRAGMENT_WORDS} THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS exposure,
         (('0x' || md5('{SEED}|' || doc_id)[1:13])::BIGINT::DOUBLE + 0.5::DOUBLE) / {2**52}::DOUBLE AS u
  FROM base
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows,
         coalesce(sum(size) FILTER (exposure = 1), 0)::DOUBLE AS s1, coalesce(sum(size) FILTER (exposure < 1), 0)::DOUBLE AS sh
  FROM rows GROUP BY source
), w AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {WEIGHT_CYCLE} + 1)::DOUBLE AS w, source_size * {MAX_COPIES}::DOUBLE AS cap FROM s
), lv AS (
  SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM w WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), tg AS (
  SELECT source, source_size, n_rows, s1, sh, least(cap, w * max(level) OVER ()) AS target FROM lv
), fr AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), {MAX_COPIES})::BIGINT ELSE 0 END AS whole FROM tg
), pl AS (
  SELECT *, greatest(target - whole * source_size, 0)::DOUBLE AS l,
         -- s1 (1 - u * u) + sh (1 - u) = l, where u * u is 1 - f
         CASE WHEN target <= whole * source_size THEN 0 WHEN s1 = 0 THEN 1 - power((sh - (target - whole * source_size)) / sh, 2)
              ELSE 1 - power((sqrt(sh * sh + 4 * s1 * greatest(s1 + sh - (target - whole * source_size), 0)) - sh) / (2 * s1), 2) END AS f FROM fr
), pr AS (
  SELECT r.*, p.source_size, p.target, p.whole, p.l, p.f, 1.0::DOUBLE - power(1.0::DOUBLE - p.f, r.exposure) AS p
  FROM rows r JOIN pl p ON r.source IS NOT DISTINCT FROM p.source
), q AS (
  SELECT *, CASE WHEN p > 0 AND p < 1 THEN (u / (1.0::DOUBLE - u)) / (p / (1.0::DOUBLE - p)) END AS odds FROM pr
), rk AS (
  SELECT *, coalesce(odds / (1.0::DOUBLE + odds), u) AS rank FROM q
), cum AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM rk
), one AS (
  SELECT *, f > 0 AND (before + size <= l OR (before < l AND before + size / 2 < l)) AS hit FROM cum
), short AS (
  SELECT *, l - sum(CASE WHEN hit THEN size ELSE 0 END) OVER (PARTITION BY source) AS short FROM one
), s0 AS (
  SELECT *, false AS used FROM short
){_fit_sql()}, c AS (
  SELECT *, least(whole + hit::INT, {MAX_COPIES})::BIGINT AS copies FROM s{FIT_STEPS}
)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM c
"""

QUERIES = {"op10_pareto_mixing": op10_pareto_mixing}
ORACLE = {"op10_pareto_mixing": ORACLE_SQL}
