"""Near-duplicates by SimHash: fingerprints that differ in few bits are linked.

Fingerprints are compared vertically: a block of them is stored as bit planes, a
word of which holds one bit of 64 fingerprints. The exclusive or of two such blocks
adds one to up to 64 distances at once; carry-save adders keep the distances as
vertical counters, and lanes (in the end whole words) are abandoned when they
are all past the radius.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import cut_lineage, map_arrow, read_table
from framewright.llm.components import SALTS, components

SEED = 42
SHINGLE, RADIUS = 4, 4
#: Rows that are compared with each other in one task; larger groups are split into pairs of parts.
GROUP_ROWS = 4096
#: Rows that a task lays out as bit planes at once.
CHUNK_ROWS = 65_536
MAX_RADIUS = 15


def shingle_hashes(text: str | None, shingle: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words in lower case (A-Z only), of all words if there are fewer."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], np.uint64)


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hashes' k-th word: themselves, then numbers that look independent of them."""
    if k == 0:
        return hashes
    x = hashes + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def fingerprint_of(hashes: np.ndarray, words: int = 1) -> np.ndarray:
    """The SimHash of 64-bit hashes, ``words`` words of 64 bits: a bit is set if it is set in more than half of them, repeated ones counted each time."""
    out = np.zeros(words, np.uint64)
    for k in range(words if len(hashes) else 0):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 16):
            bits = np.unpackbits(_mixed(hashes[at : at + (1 << 16)], k).view(np.uint8), bitorder="little").view(np.uint64).reshape(-1, 8)
            # Eight counters of a byte in a word; 255 rows at a time do not overflow them.
            sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
            counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0]
    return out


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's shingles; 0 if it has no words."""
    return int(fingerprint_of(shingle_hashes(text, shingle))[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text) to (doc_id, print): the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], ["doc_id", "print"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, print long")


def planes(prints: np.ndarray) -> np.ndarray:
    """Fingerprints (rows x words) to bit planes, 64 x words of them: bit b of the one in lane i is bit i % 64 of planes[b, i // 64]. Padded with zeros."""
    lanes = -(-len(prints) // 64)
    padded = np.zeros((lanes * 64, prints.shape[1]), np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _carry_save(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry and sum of three bits in each lane."""
    u = a ^ b
    return (a & b) | (u & c), u ^ c


def near_lanes(left: np.ndarray, right: np.ndarray, valid: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Of two blocks of planes: the words that have lanes at a distance of radius or less, and those lanes.

    Eight planes at a time go through a tree of carry-save adders into vertical
    counters of ones, twos, fours, eights and so on, as many as the radius needs, with a sticky lane for what is past them.
    A word is abandoned once every lane of it is past the radius.
    """
    at = np.nonzero(valid)[0]
    live = valid[at]
    left, right = left[:, at], right[:, at]
    counters = [np.zeros(len(at), np.uint64) for _ in range(max(4, radius.bit_length()))]
    more = np.zeros(len(at), np.uint64)
    for plane in range(0, len(left), 8):
        x = left[plane : plane + 8] ^ right[plane : plane + 8]
        two_a, ones = _carry_save(counters[0], x[0], x[1])
        two_b, ones = _carry_save(ones, x[2], x[3])
        four_a, twos = _carry_save(counters[1], two_a, two_b)
        two_a, ones = _carry_save(ones, x[4], x[5])
        two_b, ones = _carry_save(ones, x[6], x[7])
        four_b, twos = _carry_save(twos, two_a, two_b)
        carry, fours = _carry_save(counters[2], four_a, four_b)
        counters[:3] = ones, twos, fours
        for k in range(3, len(counters)):
            carry, counters[k] = counters[k] & carry, counters[k] ^ carry
        more |= carry
        if plane + 8 <= radius:
            continue
        past, equal = more.copy(), ~more
        for k in reversed(range(len(counters))):
            if radius >> k & 1:
                equal &= counters[k]
            else:
                past |= equal & counters[k]
                equal &= ~counters[k]
        live &= ~past
        stay = np.nonzero(live)[0]
        if len(stay) == 0:
            return at[:0], live[:0]
        if len(stay) * 2 <= len(at) or plane + 8 == len(left):
            at, live, more, *counters = (v[stay] for v in (at, live, more, *counters))
            left, right = left[:, stay], right[:, stay]
    return at, live


def link_groups(group: np.ndarray, prints: np.ndarray, radius: int, check: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None, root: np.ndarray | None = None) -> np.ndarray:
    """For each row the first row that chains of links connect it to, within each group of equal ``group``.

    Rows (prints: rows x words) must be sorted by group. Every row is compared with the row k places
    further on, for all rows at once and k = 1, 2, ... up to the largest group;
    pairs that earlier links connect already are left out. Of the pairs within
    the radius those are links for which ``check`` holds, where it is given. root: what is connected beforehand.
    """
    n = len(prints)
    root = np.arange(n) if root is None else root.copy()
    if n < 2:
        return root
    starts = np.nonzero(np.concatenate(([True], group[1:] != group[:-1])))[0]
    size = np.diff(np.concatenate((starts, [n])))
    further = np.repeat(starts + size, size) - np.arange(n)  # rows of the group from this one on
    block = planes(prints)
    words = block.shape[1]
    padded = np.concatenate([block, np.zeros((len(block), 1), np.uint64)], axis=1)
    rows = np.arange(n)
    for k in range(1, int(size.max())):
        rows = rows[further[rows] > k]
        open_rows = rows[root[rows] != root[rows + k]]
        if not len(open_rows):
            continue
        same = np.zeros(words * 64, np.uint8)
        same[open_rows] = 1
        valid = np.packbits(same, bitorder="little").view(np.uint64)
        some = np.nonzero(valid)[0]
        skip, shift = divmod(k, 64)
        later = padded[:, np.minimum(some + skip, words)] >> np.uint64(shift)
        if shift:
            later |= padded[:, np.minimum(some + skip + 1, words)] << np.uint64(64 - shift)
        at, live = near_lanes(block[:, some], later, valid[some], radius)
        if len(at) == 0:
            continue
        lanes = np.unpackbits(live.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        word, lane = np.nonzero(lanes)
        a = some[at[word]] * 64 + lane
        if check is not None:
            a = a[check(a, a + k)]
        for x, y in np.unique(np.stack([root[a], root[a + k]], axis=1), axis=0).tolist():
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)
        while (root[root] != root).any():
            root = root[root]
    return root


def whole_groups(batches: Iterator[pa.RecordBatch], n_keys: int, n_columns: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows sorted by the first n_keys columns, all numbers: (number of the group, rows x columns), a chunk and one group at most at a time."""
    held: list[np.ndarray] = []
    rows = 0

    def numbered(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(([0], np.cumsum((block[1:, :n_keys] != block[:-1, :n_keys]).any(axis=1)))), block

    for batch in batches:
        held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:n_columns]], axis=1))
        rows += len(held[-1])
        while rows >= CHUNK_ROWS:
            block = np.concatenate(held)
            new = np.nonzero((block[1:, :n_keys] != block[:-1, :n_keys]).any(axis=1))[0] + 1
            cut = new[new <= CHUNK_ROWS]
            cut = int(cut[-1]) if len(cut) else (int(new[0]) if len(new) else 0)
            if not cut:
                held = [block]
                break
            yield numbered(block[:cut])
            held, rows = [block[cut:]], rows - cut
    if rows:
        yield numbered(np.concatenate(held))


def masks(n: int, radius: int = RADIUS) -> list[int]:
    """Bit masks of which any two fingerprints within the radius agree on one.

    64 bits in m blocks: ``radius`` differing bits leave m - radius blocks untouched.
    More blocks make longer keys and smaller groups, but more copies of each row; m
    is the cheapest for n fingerprints at about 2 microseconds a copy and 4
    nanoseconds a comparison.
    """
    if not 0 <= radius <= MAX_RADIUS:
        raise ValueError(f"radius {radius}")

    def cost(m: int) -> float:
        return comb(m, radius) * (n * 2e-6 + n * n / 2 / 2 ** (64 * (m - radius) / m) * 4e-9)

    m = min(range(radius + 1, radius + 9), key=cost)
    edges = [64 * i // m for i in range(m + 1)]
    blocks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, m - radius)]


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def deal(keyed: DataFrame, by: list[str], group_rows: int = GROUP_ROWS) -> DataFrame:
    """Rows (by, node, ...) with grp_pair, sent to tasks and sorted by groups of equal ``by`` and grp_pair.

    A group of more than ``group_rows`` is split into parts by node, and each pair of
    parts is a group of its own, so that no task compares more than about twice that many.
    """
    large = keyed.groupBy(*by).count().where(F.col("count") > group_rows)
    large = cut_lineage(large.select(*by, F.ceil(F.col("count") / group_rows * 1.25).cast("int").alias("grp_parts")))
    others = [c for c in keyed.columns if c not in by]
    if large.isEmpty():
        keyed = keyed.withColumn("grp_pair", F.lit(0))
    else:
        part = F.coalesce(F.pmod(F.xxhash64("node"), F.col("grp_parts")).cast("int"), F.lit(0))
        keyed = keyed.join(large, by, "left").withColumn("grp_part", part).withColumn("grp_parts", F.coalesce("grp_parts", F.lit(1)))
        pairs = F.transform(F.sequence(F.lit(0), F.col("grp_parts") - 1), lambda other: F.least("grp_part", other) * F.col("grp_parts") + F.greatest("grp_part", other))
        keyed = keyed.withColumn("grp_pair", F.explode(pairs))
    order = [*by, "grp_pair"]
    return keyed.select(*order, *others).repartition(*order).sortWithinPartitions(*order, "node")


def links(prints: DataFrame, n: int, radius: int = RADIUS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """n distinct fingerprints (node, print) to links (a, b) of nodes that connect all within the radius, by chains.

    Exact: no candidate is left out. Each fingerprint goes to one group for each mask.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, block in whole_groups(batches, 3, 5):
            nodes, root = block[:, 3], link_groups(group, np.ascontiguousarray(block[:, 4:]).view(np.uint64), radius)
            linked = np.nonzero(root != np.arange(len(root)))[0]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[root[linked]])], ["a", "b"])

    keys = F.array(*[F.col("print").bitwiseAND(_signed(m)) for m in masks(n, radius)])
    keyed = prints.select("node", "print", F.posexplode(keys).alias("grp_table", "grp_key"))
    return map_arrow(deal(keyed, ["grp_table", "grp_key"], group_rows), run, "a long, b long")


def classes(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """docs (doc_id, text, ...) to (doc_id, print, component_id), one row for each row of docs.

    component_id is the least doc_id of the component, itself included; a component
    without any doc_id has null. Copies share a fingerprint and are compared once.
    Null and blank texts have fingerprint 0 and are linked like any other.
    """
    prints = cut_lineage(fingerprints(docs, shingle))
    distinct = cut_lineage(prints.groupBy("print").agg(F.min("doc_id").alias("least_id")))
    found = components(links(distinct.select(F.col("print").alias("node"), "print"), distinct.count(), radius))
    linked = distinct.join(found, distinct["print"] == found["node"]).drop("node").withColumn("salt", F.pmod("print", F.lit(SALTS)).cast("int"))
    # A component may have most of the fingerprints: they meet its least id in SALTS tasks.
    ids = linked.groupBy("root").agg(F.min("least_id").alias("component_id")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    alone = distinct.join(found, distinct["print"] == found["node"], "left_anti").select("print", F.col("least_id").alias("component_id"))
    by_print = cut_lineage(linked.join(ids, ["root", "salt"]).select("print", "component_id").union(alone))
    return prints.join(by_print, "print").select("doc_id", "print", "component_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document. Extra columns are not read."""
    out = classes(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op4_simhash": op4_simhash}
ORACLE: dict[str, str] = {}
