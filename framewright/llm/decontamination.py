"""Benchmark decontamination: documents that hold an item's passages, in whatever order.

Seeds, runs of ``MIN_MATCH`` tokens that a document shares with an item, name the pairs to
compare. For each pair greedy string tiling covers the item with the longest
stretches it shares with the document, none of them twice; a document that covers at
least ``MIN_COVERAGE`` of an item's tokens is contaminated. Stretches may stand in any order. An item of
fewer than ``MIN_MATCH`` tokens is in no pair: so few words stand in clean texts by chance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import map_arrow, read_table, text_blocks
from framewright.llm.tiling import tiles

MIN_MATCH = 5
MIN_COVERAGE = 0.5
#: Bytes of items' texts that are sent to all executors at once; more go in several passes.
BLOCK_BYTES = 32_000_000
#: Bytes of documents' texts that are held as strings, and tokens that are hashed, together.
TEXT_BYTES = 4_000_000
BLOCK_TOKENS = 500_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_TOKEN = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def _hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hashes of all windows of ``length`` ids, modulo 2**64."""
    n = len(ids) - length + 1
    value = np.zeros(max(n, 0), np.uint64)
    for j in range(length if n > 0 else 0):
        value = value * _FACTOR + ids[j : j + n].astype(np.uint64)
    return value


class Items:
    """Items of one block with their seeds, as sorted arrays of 12 bytes a seed; items shorter than min_match have none and are left out."""

    def __init__(self, rows: list[tuple[int | None, str | None]], min_match: int = MIN_MATCH):
        self.words: dict[str, int] = {}
        self.items: list[tuple[int | None, np.ndarray]] = []
        hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        for item_id, text in rows:
            words = tokens(text)
            if len(words) < min_match:
                continue
            ids = np.array([self.words.setdefault(w, len(self.words)) for w in words], np.int32)
            own = np.unique(_hashes(ids, min_match))
            hashes.append(own)
            owners.append(np.full(len(own), len(self.items), np.int32))
            self.items.append((item_id, ids))
        self.min_match = min_match
        self.hashes, self.owners = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.owners = self.hashes[order], self.owners[order]

    def _candidates(self, ids: np.ndarray) -> dict[int, set[int]]:
        """Of a block of ids: items, and the places at which a seed of theirs starts. Hashes only name candidates."""
        out: dict[int, set[int]] = {}
        length = self.min_match
        if len(ids) < length or not len(self.hashes):
            return out
        unknown = np.concatenate(([0], np.cumsum(ids < 0)))
        at = np.nonzero(unknown[length:] == unknown[:-length])[0]
        value = _hashes(ids, length)[at]
        first = np.searchsorted(self.hashes, value)
        hit = self.hashes[np.minimum(first, len(self.hashes) - 1)] == value
        last = np.searchsorted(self.hashes, value[hit], "right")
        for start, a, b in zip(at[hit].tolist(), first[hit].tolist(), last.tolist(), strict=True):
            for item in self.owners[a:b].tolist():
                out.setdefault(item, set()).add(start)
        return out

    def cover(self, item: int, ids: np.ndarray, starts: set[int]) -> tuple[int, int]:
        """Tiles of the item found in a document, and its covered tokens. Tiles lie where seeds do, so only there is looked."""
        pattern = self.items[item][1].tolist()
        length = self.min_match
        text: list[int] = []
        end = None
        for s in sorted(starts):
            if end is not None and s <= end:
                text += ids[end : s + length].tolist()
            else:
                text += [-1, *ids[s : s + length].tolist()]
            end = s + length
        found = tiles(pattern, text, length)
        return len(found), sum(n for _, _, n in found)

    def hits(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
        """(text's place in the list, item's place, tiles, covered tokens) of all pairs that share a seed."""
        get, start = self.words.get, 0
        while start < len(texts):
            ids: list[int] = []
            edges, stop = [], start
            while stop < len(texts) and len(ids) < BLOCK_TOKENS:
                edges.append(len(ids))
                ids += [get(w, -1) for w in tokens(texts[stop])]
                ids.append(-1)
                stop += 1
            block, edge = np.array(ids, np.int64), np.array(edges)
            pairs: dict[tuple[int, int], set[int]] = {}
            for item, places in self._candidates(block).items():
                for place, doc in zip(places, (np.searchsorted(edge, list(places), "right") - 1).tolist(), strict=True):
                    pairs.setdefault((doc, item), set()).add(place)
            for (doc, item), places in sorted(pairs.items()):
                yield (start + doc, item, *self.cover(item, block, places))
            start = stop


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items, in blocks of about block_bytes of text: each is small enough to send to all executors."""
    total = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    n = -(-total // block_bytes) or 1
    for k in range(n):
        part = benchmark if n == 1 else benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield sorted(((r["item_id"], r["text"]) for r in part.select("item_id", "text").collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


_ITEMS: dict[int, Items] = {}


def _shipped_items(docs: DataFrame, rows: list[tuple[int | None, str | None]], min_match: int):
    """A function that gives a worker the block's seeds, made once by each process."""
    shipped = docs.sparkSession.sparkContext.broadcast(rows)
    key = hash((tuple(rows), min_match))

    def items() -> Items:
        if key not in _ITEMS:
            _ITEMS.clear()
            _ITEMS[key] = Items(shipped.value, min_match)
        return _ITEMS[key]

    return items


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE, min_match: int = MIN_MATCH) -> DataFrame:
    """(doc_id, text) and (item_id, text) to a row for each pair over the threshold: doc_id, item_id, n_tiles, covered, n_tokens, coverage.

    No exchange: the documents are read once for each block of items. Null and empty
    texts, of documents or items, and items shorter than min_match tokens are in no pair. Repeated rows each give their pairs.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, n_tiles long, covered long, n_tokens long, coverage double"
    found = None
    for rows in item_blocks(benchmark):
        own = _shipped_items(docs, rows, min_match)

        def run(batches: Iterator[pa.RecordBatch], own=own) -> Iterator[pa.RecordBatch]:
            items = own()
            for batch in text_blocks(batches, 1, TEXT_BYTES):
                out = []
                for doc, item, n, covered in items.hits(batch.column(1).to_pylist()):
                    item_id, pattern = items.items[item]
                    if covered >= min_coverage * len(pattern):
                        out.append((batch.column(0)[doc].as_py(), item_id, n, covered, len(pattern), covered / len(pattern)))
                columns = list(zip(*out, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.float64())], ["doc_id", "item_id", "n_tiles", "covered", "n_tokens", "coverage"])

        pairs = map_arrow(docs, run, schema)
        found = pairs if found is None else found.union(pairs)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE, min_match: int = MIN_MATCH) -> DataFrame:
    """The rows of docs, all columns, that cover no item to min_coverage."""
    at = docs.columns.index("text")
    for rows in item_blocks(benchmark):
        own = _shipped_items(docs, rows, min_match)

        def run(batches: Iterator[pa.RecordBatch], own=own) -> Iterator[pa.RecordBatch]:
            items = own()
            for batch in text_blocks(batches, at, TEXT_BYTES):
                keep = np.ones(batch.num_rows, bool)
                for doc, item, _, covered in items.hits(batch.column(at).to_pylist()):
                    keep[doc] &= covered < min_coverage * len(items.items[item][1])
                yield batch.filter(pa.array(keep))

        docs = map_arrow(docs, run, docs.schema)
    return docs


def op7_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold a benchmark item, with the item. Extra columns are not read."""
    return contaminated_pairs(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {"op7_string_tiling": op7_string_tiling}
ORACLE: dict[str, str] = {}
