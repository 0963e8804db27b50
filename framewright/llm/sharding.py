"""Sharding by Hilbert order: rows that are alike in several metadata columns share shards.

Each metadata column is quantised to ``bits`` bits in its own order, by the share of the rows that sort before a value (sizes by classes of an eighth of a doubling), the cell's index on a Hilbert
curve orders the rows, and runs of that order are cut into shards. A file then
covers a compact box of all the columns at once, so a filter on any of them
prunes files by their minima and maxima.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.llm.common import cut_lineage, long_array, read_table, small

N_SHARDS = 40
BITS = 5
ROW_OVERHEAD = 16
_STATE_BITS = 8
#: Labels that are sent to all executors at most; more meet the rows by an exchange, in SALTS tasks for each label.
BROADCAST_LABELS = 100_000
SALTS = 16


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Digit and next state for each (state, corner), state = (entry corner, direction).

    Made by the compact-index recurrences: a corner is rotated into the state's own
    frame, ranked by the inverse Gray code, and the sub-cube's entry and direction
    give the next state.
    """
    corners = 1 << dims

    def rotate(x: int, k: int) -> int:
        k %= dims
        return ((x << k) | (x >> (dims - k))) & (corners - 1)

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    def trailing_ones(i: int) -> int:
        n = 0
        while i & 1:
            i, n = i >> 1, n + 1
        return n

    rank = {gray(i): i for i in range(corners)}
    entry = [0] + [gray(2 * ((i - 1) // 2)) for i in range(1, corners)]
    turn = [0] + [trailing_ones(i if i % 2 else i - 1) % dims for i in range(1, corners)]
    digit, follow = [], []
    for state in range(corners * dims):
        start, direction = divmod(state, dims)
        for corner in range(corners):
            w = rank[rotate(corner ^ start, dims - (direction + 1) % dims)]
            digit.append(w)
            follow.append((start ^ rotate(entry[w], direction + 1)) * dims + (direction + turn[w] + 1) % dims)
    return digit, follow


def hilbert_index(dims: list[Column], bits: int) -> Column:
    """The cell's place on the curve; each of dims is an integer of ``bits`` bits.

    One fold over the levels of the grid, from the coarsest: the running value
    holds the index so far and, in its low bits, the curve's state.
    """
    n = len(dims)
    if n * (1 << n) > 1 << _STATE_BITS or n * bits + _STATE_BITS > 62:
        raise ValueError(f"{n} dimensions of {bits} bits do not fit")
    digit, follow = (long_array(t) for t in curve_tables(n))
    corners = []
    for level in range(bits - 1, -1, -1):
        corner = F.lit(0).cast("long")
        for k, c in enumerate(dims):
            corner = corner + F.shiftleft(F.shiftright(c.cast("long"), level).bitwiseAND(F.lit(1)), k)
        corners.append(corner)

    def step(acc: Column, corner: Column) -> Column:
        at = (F.shiftleft(acc.bitwiseAND(F.lit((1 << _STATE_BITS) - 1)), n) + corner + 1).cast("int")
        index = F.shiftleft(F.shiftright(acc, _STATE_BITS), n) + F.element_at(digit, at)
        return F.shiftleft(index, _STATE_BITS) + F.element_at(follow, at)

    return F.shiftright(F.aggregate(F.array(*corners), F.lit(0).cast("long"), step), _STATE_BITS)


def size_class(n: Column) -> Column:
    """A number's logarithm in steps of an eighth or less, without floating point: its count of binary digits and the three digits after the first."""
    digits = F.length(F.bin(n.cast("long"))).cast("long")
    rest = F.floor(n / F.pow(F.lit(2.0), F.greatest(digits - 4, F.lit(0)))).cast("long").bitwiseAND(F.lit(7))
    return digits * 8 + rest


def in_order(df: DataFrame, order: list[Column], sizes: dict[str, Column]) -> tuple[DataFrame, dict[str, int], int]:
    """df's rows as (row, part, local, sizes, before_*), in ascending order by ranges; the sums of sizes; the number of rows.

    ``row`` holds df's columns; ``rank`` is the row's place from 0, ``before_<name>`` the sum of a size over the rows before it. Nulls sort first.

    One range exchange on the whole order and a local sort; places come from the partitions' counts and sums, so no
    window runs over all rows. The ranged rows are checkpointed: counts and places then refer to the same
    partitions even when an executor is lost.
    """
    held = df.select(F.struct(*df.columns).alias("row"), *[c.alias(f"_o{i}") for i, c in enumerate(order)], *[c.cast("long").alias(f"_s_{k}") for k, c in sizes.items()])
    keys = [F.col(f"_o{i}").asc_nulls_first() for i in range(len(order))]
    ranged = held.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*[f"_o{i}" for i in range(len(order))])
    ranged = cut_lineage(ranged.withColumn("_place", F.monotonically_increasing_id()))
    part, local = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    # One row for each partition: as many as the exchange has, whatever the number of rows.
    sums = [F.coalesce(F.sum(f"_s_{k}"), F.lit(0)).alias(k) for k in sizes]
    per_part = {r["part"]: r for r in ranged.groupBy(part.alias("part")).agg(F.count("*").alias("_rows"), *sums).collect()}
    starts: dict[str, list[int]] = {k: [] for k in ("_rows", *sizes)}
    total = dict.fromkeys(starts, 0)
    for p in range(max(per_part, default=-1) + 1):
        for k in starts:
            starts[k].append(total[k])
            total[k] += per_part[p][k] if p in per_part else 0
    at = (part + 1).cast("int")
    start = lambda k: F.element_at(long_array(starts[k]), at) if starts[k] else F.lit(0).cast("long")
    out = ranged.withColumn("rank", start("_rows") + local)
    earlier = Window.partitionBy(part).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    for k in sizes:
        out = out.withColumn(f"before_{k}", start(k) + F.coalesce(F.sum(f"_s_{k}").over(earlier), F.lit(0).cast("long")))
    return out.select("row", "rank", *[f"before_{k}" for k in sizes]), {k: total[k] for k in sizes}, total["_rows"]


def shard(df: DataFrame, order: list[Column], n_shards: int = N_SHARDS, law: str = "rows", size: Column | None = None) -> DataFrame:
    """Adds ``shard`` and ``slot`` to df: runs of df in ascending ``order``.

    law ``rows``: the shards' row counts differ by at most one. law ``bytes``: a shard
    takes the rows whose first byte falls in its share of all bytes of ``size``, so its
    size is off by one row at most. ``slot`` counts from 0 in each shard, without gaps.

    Ties in a hot cell are dealt out by the order's later columns; no shard is gathered in one task.
    Rows that are equal in all of ``order`` take neighbouring
    slots in any order. Nulls sort first. An empty df stays empty. All columns of df stay, but for any that is
    named shard or slot, which is replaced.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"unknown law: {law}")
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    ranked, total, n = in_order(df, order, {"bytes": size} if law == "bytes" else {})
    own = [F.col("row")[c].alias(c) for c in df.columns if c not in ("shard", "slot")]
    if not n:
        return ranked.select(*own, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    if law == "rows":
        ranked = ranked.withColumn("_shard", F.expr(f"cast(rank * {n_shards} div {n} as int)"))
        return ranked.select(*own, F.col("_shard").alias("shard"), F.expr(f"rank - (_shard * {n}L + {n_shards - 1}) div {n_shards}").alias("slot"))
    ranked = ranked.withColumn("_shard", F.expr(f"cast(least(before_bytes * {n_shards} div {max(total['bytes'], 1)}, {n_shards - 1}) as int)"))
    first = ranked.groupBy(F.col("_shard").alias("_of")).agg(F.min("rank").alias("_first"))
    ranked = ranked.join(F.broadcast(first), F.col("_shard") == F.col("_of"))  # a row for each of n_shards
    return ranked.select(*own, F.col("_shard").alias("shard"), (F.col("rank") - F.col("_first")).alias("slot"))


def label_codes(labels: DataFrame, bits: int) -> DataFrame:
    """labels (label) to (label, code): each label's code is the share of the rows whose label sorts before it, in 2**bits parts; null sorts first.

    Codes keep the labels' order, so that a range of codes is a range of labels, and cells hold about equal numbers of
    rows; of labels that share a cell each is a neighbour of the next. Labels are counted, not gathered.
    """
    counted = labels.groupBy("label").agg(F.count("*").alias("n"))
    ranked, total, _ = in_order(counted, [F.col("label")], {"n": F.col("n")})
    return ranked.select(F.col("row.label").alias("label"), F.expr(f"before_n * {1 << bits} div {max(total['n'], 1)}").alias("code"))


def with_code(df: DataFrame, name: str, label: Column, bits: int = BITS) -> DataFrame:
    """df with a column ``name``: the code of its label among all of df's."""
    codes = cut_lineage(label_codes(df.select(label.alias("label")), bits))
    n = codes.count()
    codes = codes.withColumnsRenamed({"label": "_label", "code": name})
    if n <= BROADCAST_LABELS:
        return df.join(small(codes, n, BROADCAST_LABELS), label.eqNullSafe(F.col("_label"))).drop("_label")
    salted = df.withColumn("_salt", F.floor(F.rand(7) * SALTS).cast("int"))
    codes = codes.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(codes, label.eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_of"))).drop("_label", "_salt", "_of")


def document_keys(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """docs (doc_id, text, lang, source, ...) to (row, id, size, text_crc32, curve): the columns to keep, or all, id, size, checksum and curve index."""
    text = F.col("text").cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(ROW_OVERHEAD).cast("long")
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    labels = [F.col(c).cast("string").alias(f"_{c}") for c in ("lang", "source")]
    held = docs.select(F.struct(*(docs.columns if keep is None else keep)).alias("row"), F.col("doc_id").cast("long").alias("id"), size.alias("size"), crc.alias("text_crc32"), *labels)
    coded = with_code(with_code(held, "_a", F.col("_lang")), "_b", F.col("_source"))
    coded = with_code(coded.withColumn("_class", size_class(F.col("size"))), "_c", F.col("_class"))
    curve = hilbert_index([F.col("_a"), F.col("_b"), F.col("_c")], BITS)
    return coded.select("row", "id", "size", "text_crc32", curve.alias("curve"))


def hilbert_shards(docs: DataFrame, n_shards: int = N_SHARDS, law: str = "rows", keep: list[str] | None = None) -> DataFrame:
    """docs to (row, id, size, text_crc32, curve, shard, slot), by the law ``rows`` or ``bytes``.

    A null text has size 16 and checksum 0; null lang or source come first in their
    order. Repeated rows take neighbouring slots.
    """
    return shard(document_keys(docs, keep), [F.col("curve"), F.col("id"), F.col("text_crc32"), F.col("size")], n_shards, law, F.col("size"))


def sharded(docs: DataFrame, n_shards: int = N_SHARDS, law: str = "rows") -> DataFrame:
    """docs with ``shard`` and ``slot``; all its columns stay, but for any of these names."""
    out = hilbert_shards(docs, n_shards, law)
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")


def op6_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard (0 to 39) and slot under the law ``rows``. Extra columns are not read."""
    out = hilbert_shards(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def _oracle() -> str:
    digit, follow = curve_tables(3)
    unit = []
    for i in range(8):  # CRC-32 is linear: the table's entry for a byte is the sum of its bits' entries
        c = 1 << i
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        unit.append(c)
    byte = "xor(acc, x)"
    step = "acc >> 8"
    for i, c in enumerate(unit):
        step = f"xor({step}, (({byte} >> {i}) & 1) * {c})"
    corners = ", ".join(f"((a >> {b}) & 1) + ((b >> {b}) & 1) * 2 + ((c >> {b}) & 1) * 4" for b in range(BITS - 1, -1, -1))
    return f"""
WITH t AS (
  SELECT {digit}::BIGINT[] AS digit, {follow}::BIGINT[] AS follow
), langs AS (
  SELECT lang, ((sum(count(*)) OVER (ORDER BY lang NULLS FIRST) - count(*)) * {1 << BITS} // sum(count(*)) OVER ())::BIGINT AS a FROM documents GROUP BY lang
), sources AS (
  SELECT source, ((sum(count(*)) OVER (ORDER BY source NULLS FIRST) - count(*)) * {1 << BITS} // sum(count(*)) OVER ())::BIGINT AS b FROM documents GROUP BY source
), base AS (
  SELECT doc_id, a, b, hex(encode(coalesce(text, ''))) AS hx,
         coalesce(strlen(text), 0)::BIGINT + {ROW_OVERHEAD} AS size
  FROM documents d JOIN langs ON d.lang IS NOT DISTINCT FROM langs.lang JOIN sources ON d.source IS NOT DISTINCT FROM sources.source
), classed AS (
  SELECT *, length(bin(size)) * 8 + ((size >> (length(bin(size)) - 4)) & 7) AS class FROM base
), classes AS (
  SELECT class, ((sum(count(*)) OVER (ORDER BY class) - count(*)) * {1 << BITS} // sum(count(*)) OVER ())::BIGINT AS c FROM classed GROUP BY class
), coded AS (
  SELECT doc_id, size,
         xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hx, '..'), lambda p: ('0x' || p)::BIGINT),
             lambda acc, x: {step}), 4294967295::BIGINT) AS text_crc32,
         a, b, c
  FROM classed JOIN classes USING (class)
), placed AS (
  SELECT doc_id, size, text_crc32,
         list_reduce([0::BIGINT, {corners}],
             lambda acc, o: ((((acc >> 8) * 8) + t.digit[(acc & 255) * 8 + o + 1]) * 256 + t.follow[(acc & 255) * 8 + o + 1])::BIGINT) >> 8 AS curve
  FROM coded, t
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY curve, doc_id, text_crc32, size) - 1 AS r, count(*) OVER () AS n FROM placed
)
SELECT doc_id, size, text_crc32, 'rows' AS law, ((r * {N_SHARDS}) // n)::INT AS shard,
       (r - (((r * {N_SHARDS}) // n) * n + {N_SHARDS - 1}) // {N_SHARDS})::BIGINT AS slot,
       NULL::INT AS grown_shard, curve::BIGINT AS curve
FROM ranked
"""


QUERIES = {"op6_hilbert_sharding": op6_hilbert_sharding}
ORACLE = {"op6_hilbert_sharding": _oracle()}
