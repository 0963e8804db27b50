"""Near-duplicates: SimHash comparison in groups, then the exact Jaccard coefficient of five-word shingles.

SimHashes of all the shingles a text has tell how alike two texts are, but at a coefficient of 0.8
fingerprints differ in so many bits that no few keys of bits bring such texts together. So texts meet
by keys of least hashes (MinHash), and within each group of a key their SimHashes, ``WORDS`` words of 64 bits,
are compared bit-sliced (``simhash.link_groups``). What is within ``RADIUS`` bits is a candidate; a link
is what has the wanted coefficient or more by the exact sets. A pair at 0.8 shares none of the keys
with a probability of (1 - 0.8 ** ROWS) ** BANDS, 0.2 %, and its expected distance is four standard deviations under the radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import cut_lineage, map_arrow, small, text_blocks
from framewright.llm.components import components
from framewright.llm.simhash import deal, fingerprint_of, link_groups, shingle_hashes, whole_groups

SHINGLE, SIMILARITY = 5, 0.8
#: Keys of a text, and least hashes that make up each of them.
BANDS, ROWS = 20, 6
#: Of 64 WORDS bits 38.8 differ at a coefficient of 0.8 (sets of one size), with a standard deviation of 5.7.
WORDS, RADIUS = 4, 64
#: Rows that are sent to all executors at most, 24 bytes each; more are joined by an exchange.
BROADCAST_ROWS = 500_000
BLOCK_BYTES = 4_000_000
_RANDOM = np.random.default_rng(42)
_FACTORS = _RANDOM.integers(0, 1 << 31, (BANDS * ROWS, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_MIX = _RANDOM.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RANDOM.integers(0, 1 << 63, BANDS, dtype=np.uint64)
_PRINTS = [f"print{k}" for k in range(WORDS)]


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending; of all words if there are fewer. Blank and null texts have none."""
    return np.unique(shingle_hashes(text, SHINGLE))


def minhash_keys(hashes: np.ndarray) -> np.ndarray:
    """BANDS 64-bit keys of a set of hashes; all empty sets have the same."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(least, (_FACTORS * x[at : at + 2048]).min(axis=1), out=least)
    return (least.reshape(BANDS, ROWS).astype(np.uint64) * _MIX).sum(axis=1, dtype=np.uint64) ^ _BAND


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sets of hashes, without repeats, have this Jaccard coefficient or more. Empty sets are alike."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    both = np.sort(np.concatenate([a, b]))
    common = int((both[1:] == both[:-1]).sum())
    return common >= similarity * (len(both) - common) - 1e-9


def _list_array(parts: list[np.ndarray], kind: np.dtype) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, kind), *parts])))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, h1, h2, text) to (doc_id, h1, h2, keys, print0, ...)."""
    for batch in text_blocks(batches, 3, BLOCK_BYTES):
        keys, prints = [], np.zeros((batch.num_rows, WORDS), np.uint64)
        for k, text in enumerate(batch.column(3)):
            own = shingle_set(text.as_py())
            keys.append(minhash_keys(own).view(np.int64))
            prints[k] = fingerprint_of(own, WORDS)
        columns = [pa.array(np.ascontiguousarray(prints[:, k]).view(np.int64)) for k in range(WORDS)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], _list_array(keys, np.dtype(np.int64)), *columns], ["doc_id", "h1", "h2", "keys", *_PRINTS])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) to (node, hashes): the upper halves of the shingles' hashes."""
    for batch in text_blocks(batches, 1, BLOCK_BYTES):
        own = [np.unique((shingle_set(t.as_py()) >> np.uint64(32)).astype(np.uint32)).view(np.int32) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), _list_array(own, np.dtype(np.int32))], ["node", "hashes"])


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, grp_pair, node, print0, ...) to (key, grp_pair, root, node, print0, ...) of those with another within the radius, by chains; the root is the least of them."""
    for group, block in whole_groups(batches, 2, 3 + WORDS):
        root = link_groups(group, np.ascontiguousarray(block[:, 3:]).view(np.uint64), RADIUS)
        some = np.bincount(root, minlength=len(root))[root] > 1
        columns = [block[some, 0], block[some, 1], block[root[some], 2], *block[some, 2:].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["key", "grp_pair", "root", "node", *_PRINTS])


def _verifier(similarity: float):
    """Sorted (key, grp_pair, root, node, known, print0, ..., hashes) to links (a, b), verified. known: linked to the root already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 5 + WORDS
        sets: list[np.ndarray] = []

        def numbers() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets.extend(own.values.to_numpy() for own in batch.column(n))
                yield batch

        for group, block in whole_groups(numbers(), 3, n):
            held = sets[: len(block)]
            del sets[: len(block)]
            first = np.concatenate(([0], np.nonzero(np.diff(group))[0] + 1))[group]
            before = np.where(block[:, 4] > 0, first, np.arange(len(block)))

            def check(a: np.ndarray, b: np.ndarray, held=held) -> np.ndarray:
                return np.array([similar(held[i], held[j], similarity) for i, j in zip(a.tolist(), b.tolist(), strict=True)], bool)

            root = link_groups(group, np.ascontiguousarray(block[:, 5:]).view(np.uint64), RADIUS, check, before)
            linked = np.nonzero(root != np.arange(len(root)))[0]
            yield pa.RecordBatch.from_arrays([pa.array(block[linked, 3]), pa.array(block[root[linked], 3])], ["a", "b"])

    return run


def _named(docs: DataFrame) -> DataFrame:
    """docs with a 128-bit hash of the text, by which equal texts are known; null is like empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({"_h1": F.xxhash64(text), "_h2": F.xxhash64(F.lit(7), text)})


def similar_links(distinct: DataFrame, named: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """distinct (node, _h1, _h2, keys, print0, ...) of named (_h1, _h2, text) to verified links (a, b) that connect what is similar, by chains.

    First each text that meets others is compared with the least one of them, which is enough for groups of
    copies of one text. Groups in which that leaves a text alone go, with the sets, to tasks that compare all
    within the radius, but for those that are connected by then. So a large group of near copies does not make all its pairs.
    """
    keyed = distinct.select(F.explode("keys").alias("key"), "node", *_PRINTS)
    columns = "key long, grp_pair long, root long, node long, " + ", ".join(f"{p} long" for p in _PRINTS)
    met = cut_lineage(map_arrow(deal(keyed, ["key"]), _meetings, columns))
    nodes = cut_lineage(met.select("node").distinct().join(distinct.select("node", "_h1", "_h2"), "node"))
    wanted = small(nodes.withColumnsRenamed({"_h1": "_a", "_h2": "_b"}), nodes.count(), BROADCAST_ROWS)
    texts = named.join(wanted, (F.col("_h1") == F.col("_a")) & (F.col("_h2") == F.col("_b"))).groupBy("node").agg(F.first(F.col("text").cast("string")).alias("text"))
    sets = cut_lineage(map_arrow(texts.select("node", "text"), _sets, "node long, hashes array<int>"))
    pairs = met.where(F.col("root") != F.col("node")).select("root", "node").distinct()
    both = pairs.join(sets, "node").join(sets.select(F.col("node").alias("root"), F.col("hashes").alias("others")), "root")
    # A generator's value is not computed again in the filter on it.
    both = both.select("root", "node", (F.size("hashes") + F.size("others")).alias("n"), F.explode(F.array(F.size(F.array_intersect("hashes", "others")))).alias("common"))
    linked = cut_lineage(both.where(F.col("common") >= (F.col("n") - F.col("common")) * similarity - 1e-9).select("root", "node"))
    known = met.join(linked.withColumn("known", F.lit(1)), ["root", "node"], "left").withColumn("known", F.when(F.col("root") == F.col("node"), 1).otherwise(F.coalesce("known", F.lit(0))))
    group = ["key", "grp_pair", "root"]
    open_groups = known.groupBy(*group).agg(F.min("known").alias("closed")).where(F.col("closed") == 0).select(*group)
    left = known.join(open_groups, group, "left_semi").join(sets, "node").select(*group, "node", F.col("known").cast("long"), *_PRINTS, "hashes")
    more = map_arrow(left.repartition(*group).sortWithinPartitions(*group, "node"), _verifier(similarity), "a long, b long")
    return cut_lineage(linked.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))


def _rooted(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """A row (doc_id, node) for each of docs, and (node, root) for the nodes that are linked to another."""
    named = _named(docs.select(F.col("doc_id").cast("long"), "text"))
    own = named.select("doc_id", "_h1", "_h2", F.col("text").cast("string"))
    columns = "doc_id long, _h1 long, _h2 long, keys array<long>, " + ", ".join(f"{p} long" for p in _PRINTS)
    found = cut_lineage(map_arrow(own, _sketches, columns))
    firsts = [F.first(c).alias(c) for c in ["keys", *_PRINTS]]
    distinct = cut_lineage(found.groupBy("_h1", "_h2").agg(*firsts).withColumn("node", F.monotonically_increasing_id()))
    roots = components(similar_links(distinct, named, similarity))
    rows = found.select("doc_id", "_h1", "_h2").join(distinct.select("node", "_h1", "_h2"), ["_h1", "_h2"])
    return rows, roots


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs (doc_id, text, ...) to (doc_id, node, component_id), one row for each row of docs.

    node numbers the distinct texts; component_id is the least doc_id of the component,
    null if none has one. Null and blank texts are copies of each other.
    """
    rows, roots = _rooted(docs, similarity)
    rooted = cut_lineage(rows.join(roots, "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("root")))
    ids = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(ids, "root").select("doc_id", "node", "component_id")


def near_dedup(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of docs for each component: the first by doc_id (those without one come last), then by the text's hash.

    What counts is the row, an id and a text: other rows of the same id go by their own components.
    Rows that are equal in both stay once. Columns of docs keep their values, whatever their names.
    """
    rows, roots = _rooted(docs, similarity)
    rooted = cut_lineage(rows.join(roots, "node", "left").select("doc_id", "_h1", "_h2", F.coalesce("root", "node").alias("root")))
    # Minima are taken before the exchange.
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_h1", "_h2")
    firsts = rooted.groupBy("root").agg(F.min(order).alias("first"))
    row = ["doc_id", "_h1", "_h2"]
    firsts = cut_lineage(firsts.select(*[F.col(f"first.{c}").alias(c) for c in row]))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["_h1"] == b["_h1"]) & (a["_h2"] == b["_h2"])
    counted = rooted.groupBy(*row).count()
    # Rows that go, and rows that are there more than once: mostly far fewer than those that stay.
    a, b = counted.alias("a"), firsts.withColumn("stays", F.lit(True)).alias("b")
    marked = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a._h1") == F.col("b._h1")) & (F.col("a._h2") == F.col("b._h2")), "left")
    marked = marked.select(F.col("a.doc_id").alias("doc_id"), F.col("a._h1").alias("_h1"), F.col("a._h2").alias("_h2"), F.col("a.count").alias("n"), F.coalesce(F.col("b.stays"), F.lit(False)).alias("stays"))
    marked = cut_lineage(marked.where(~F.col("stays") | (F.col("n") > 1)))
    n = marked.agg(F.count("*").alias("rows"), F.coalesce(F.sum((F.col("stays") & (F.col("n") > 1)).cast("long")), F.lit(0)).alias("repeated")).first()
    text = F.coalesce(F.col("_row.text").cast("string"), F.lit(""))
    held = docs.select(F.struct(*docs.columns).alias("_row")).withColumns({"doc_id": F.col("_row.doc_id").cast("long"), "_h1": F.xxhash64(text), "_h2": F.xxhash64(F.lit(7), text)})
    marks = small(marked.select(*row), n["rows"], BROADCAST_ROWS)
    kept = held.join(marks, same(held, marks), "left_anti").select("_row")
    if n["repeated"]:
        repeated = marked.where("stays").select(*row)
        once = held.join(small(repeated, n["repeated"], BROADCAST_ROWS), same(held, repeated), "left_semi").dropDuplicates(row).select("_row")
        kept = kept.union(once)
    return kept.select("_row.*")
