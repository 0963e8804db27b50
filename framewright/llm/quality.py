"""Quality rules by host: rule failures are pooled by domain, shrunk, and joined back.

A document that fails a rule of its own base goes. The host's verdict is about all rules (``RULES``): the rate of its documents that fail
any of them, shrunk towards all hosts' rate by an empirical beta prior. If that is above ``MAX_LIFT`` times all hosts'
rate, and above ``MIN_HOST_RATE``, every document of the host goes: a host with few documents needs more evidence than its
raw rate to be dropped, one with many is judged by what it has, and where all hosts are alike none is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import cut_lineage, read_table, words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host goes if the shrunk rate of its failing documents is above so many times the rate of all, and above the least rate.
MAX_LIFT, MIN_HOST_RATE = 2.0, 0.4
#: Limits of the other rules: symbols to words, lines equal to an earlier one, code points a word.
MAX_SYMBOL_PERCENT, MAX_DUP_LINE_PERCENT, WORD_CHARS = 10, 30, (3, 10)
SYMBOLS = "[#*$%&|<>]"


def _adjacent(pairs: Column) -> Column:
    """Places whose key, in pairs sorted by (key, place), is also their neighbour's."""
    same = lambda i, j: F.coalesce(F.get(pairs, i)["key"] == F.get(pairs, j)["key"], F.lit(False))
    return F.transform(F.filter(pairs, lambda p, i: same(i, i - 1) | same(i, i + 1)), lambda p: p["at"])


def rule_counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """keep, with n_words, word_chars, n_symbols, n_lines (those with a word), n_dup_lines and n_repeat_words of each text.

    Null and blank texts have 0 everywhere. A window of three words is known by a
    64-bit hash; within one text, equal hashes are equal windows. Windows are sorted
    only in texts in which a hash repeats. All of it stays inside a row: no
    exchange, whatever the text's length.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select(*keep, words_of(F.col(text)).alias("_w"), lines.alias("_l"), F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    n = F.size("_w")
    windows = F.when(n >= 3, F.zip_with(F.zip_with(F.slice("_w", 1, F.greatest(n - 2, F.lit(0))), F.slice("_w", 2, F.greatest(n - 2, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), F.slice("_w", 3, F.greatest(n - 2, F.lit(0))), lambda ab, c: F.xxhash64(ab["a"], ab["b"], c)))
    step = step.select(
        *keep,
        "n_symbols",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(windows, F.array().cast("array<bigint>")).alias("_k"),
    )
    repeats = F.size(F.array_distinct("_k")) < F.size("_k")
    pairs = F.when(repeats, F.array_sort(F.transform("_k", lambda k, i: F.struct(k.alias("key"), i.alias("at")))))
    step = step.select(*keep, "n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines", pairs.alias("_p"))
    step = step.select(*keep, "n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines", F.array_sort(_adjacent(F.col("_p"))).alias("_at"))
    # Words covered by windows of three from places in ascending order: 3, less what the next one covers again.
    covered = F.aggregate("_at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")), lambda acc, at: F.struct((acc["n"] + F.least(F.lit(3).cast("long"), at - acc["last"])).alias("n"), at.cast("long").alias("last")))
    return step.select(*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", F.coalesce(covered["n"], F.lit(0).cast("long")).alias("n_repeat_words"))


#: Rules of a document, by the counts of its text.
RULES = {
    "short": lambda: F.col("n_words") < MIN_WORDS,
    "repeats": lambda: F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT,
    "symbols": lambda: F.col("n_symbols") * 100 > F.col("n_words") * MAX_SYMBOL_PERCENT,
    "dup_lines": lambda: F.col("n_dup_lines") * 100 > F.col("n_lines") * MAX_DUP_LINE_PERCENT,
    "word_chars": lambda: (F.col("word_chars") < F.col("n_words") * WORD_CHARS[0]) | (F.col("word_chars") > F.col("n_words") * WORD_CHARS[1]),
}
BASE = ("short", "repeats")


def verdicts(counts: DataFrame) -> DataFrame:
    """counts with base_failed, and n_failed, how many of all rules a document fails."""
    base = RULES[BASE[0]]() | RULES[BASE[1]]()
    return counts.withColumn("base_failed", base).withColumn("n_failed", sum((rule().cast("int") for rule in RULES.values()), F.lit(0)))


def host_rates(failures: DataFrame, host: str = "host") -> tuple[DataFrame, float]:
    """(host, n, failed) to the same with ``rate``, the posterior mean of the host's failure rate; and the rate of all.

    The prior is Beta(m*k, (1-m)*k) with m the pooled rate and k by the method of
    moments from the spread of the hosts' rates beyond what sampling explains; hosts
    that differ by no more than chance get k = 10^9, so all have the pooled rate.
    """
    # One row of four numbers.
    total = failures.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"), F.count("*").alias("hosts"), F.coalesce(F.sum(F.col("failed") * F.col("failed") / F.col("n")), F.lit(0.0)).alias("squares")).first()
    n, failed, hosts, squares = total["n"], total["failed"], total["hosts"], total["squares"]
    m = failed / n if n else 0.0
    between = (squares / n - m * m - m * (1 - m) * (hosts - 1) / n) if n else 0.0
    k = min(1e9, max(m * (1 - m) / between - 1, 0.0)) if between > 0 else 1e9
    return failures.withColumn("rate", (F.col("failed") + F.lit(m * k)) / (F.col("n") + F.lit(k))), m


def apply_host_rules(judged: DataFrame, host: str = "host", max_lift: float = MAX_LIFT, min_rate: float = MIN_HOST_RATE) -> DataFrame:
    """judged (with base_failed, n_failed and host) to the same with host_rate and ``kept``.

    A null host is no host: its rows are pooled in the prior and judged by themselves
    alone. The verdicts are joined by host; the table of hosts is sent to all executors only if
    Spark finds it small at run time, else a hot host's partition is split.
    """
    failures = judged.groupBy(host).agg(F.count("*").alias("n"), F.sum((F.col("n_failed") > 0).cast("long")).alias("failed"))
    rates, pooled = host_rates(cut_lineage(failures), host)
    rates = rates.where(F.col(host).isNotNull()).select(F.col(host).alias("_host"), F.col("rate").alias("host_rate"))
    limit = max(min_rate, max_lift * pooled)
    return judged.join(rates, judged[host] == rates["_host"], "left").drop("_host").withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("host_rate") <= limit, F.lit(True)))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every document; its host is its source. Extra columns are not read."""
    docs = read_table(spark, sf_dir, "documents")
    judged = verdicts(rule_counts(docs.select("doc_id", F.col("source").alias("host"), "text"), ["doc_id", "host"]))
    out = apply_host_rules(cut_lineage(judged))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("host_rate", 6).alias("host_rate"))


ORACLE_SQL = f"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents
), tri AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS tri, unnest(range(1, len(w) - 1)) AS i FROM w
), twice AS (
  SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, tri) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS c FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
), counts AS (
  SELECT w.doc_id, source AS host, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
         len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words OR 100 * n_symbols > {MAX_SYMBOL_PERCENT} * n_words
         OR 100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines OR word_chars NOT BETWEEN {WORD_CHARS[0]} * n_words AND {WORD_CHARS[1]} * n_words AS any_failed
  FROM counts
), hosts AS (
  SELECT host, count(*) AS n, sum(any_failed::INT) AS failed FROM judged GROUP BY host
), pooled AS (
  SELECT sum(failed) / sum(n) AS m, sum(failed * failed / n) / sum(n) AS sq, count(*) AS hosts, sum(n) AS n FROM hosts
), spread AS (
  SELECT m, sq - m * m - m * (1 - m) * (hosts - 1) / n AS between_ FROM pooled
), prior AS (
  SELECT m, CASE WHEN between_ > 0 THEN least(1e9, greatest(m * (1 - m) / between_ - 1, 0)) ELSE 1e9 END::DOUBLE AS k FROM spread
), rates AS (
  SELECT host, (failed + m * k) / (n + k) AS rate FROM hosts, prior WHERE host IS NOT NULL
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(rate <= (SELECT greatest({MIN_HOST_RATE}, {MAX_LIFT} * m) FROM pooled), true) AS kept, round(rate, 6) AS host_rate
FROM judged LEFT JOIN rates ON judged.host = rates.host
"""

QUERIES = {"op8_host_rules": op8_host_rules}
ORACLE = {"op8_host_rules": ORACLE_SQL}
