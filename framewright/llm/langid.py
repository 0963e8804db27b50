"""Language identification by a bidirectional gated recurrent network over bytes.

The network (``bigru``) reads whole texts, lower-cased, as bytes, in windows: ``CORE`` bytes that it
labels with ``CONTEXT`` bytes on either side of them, blanks before a text's start and after
its end. Every text is cut by this one rule, whatever its length. Each byte gets the
languages' probabilities; a document's are the mean over all bytes of its letters.

It is trained on the driver from a bounded sample: about ``TRAIN_DOCS`` labelled
documents for each of at most ``MAX_LANGUAGES`` languages, chosen by a hash of their id, and of
these ``TRAIN_WINDOWS`` windows of ``TRAIN_BYTES`` bytes, chosen by a hash of their bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.llm import bigru
from framewright.llm.common import map_arrow, read_table, text_blocks, uniform

TRAIN_DOCS = 500
TRAIN_WINDOWS = 1500
TRAIN_BYTES = 64
#: The most frequent labels are learned; a label beyond them is no language.
MAX_LANGUAGES = 200
#: Letters that a window must have to be trained on.
TRAIN_LETTERS = 8
HIDDEN, STEPS, BATCH, RATE, SEED = 12, 300, 192, 0.02, 7
UNKNOWN = "und"
CORE, CONTEXT = 224, 16
WINDOW = CORE + 2 * CONTEXT
#: A text's last window is filled up with blanks to a multiple of so many bytes.
STEP = 32
BLOCK_BYTES = 2_000_000
#: ``keep_identified`` rejects documents of whose letters no language has so much of the probability: one that is half in another language stays.
MIN_SCORE = 0.35
_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True
_BLANK = 32


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: dict[str, np.ndarray]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _data(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def _train_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, hash, window), of each batch and language those with the least hashes."""
    for batch in batches:
        found: dict[str, set[tuple[int, bytes]]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            framed = b" " * CONTEXT + _data(text.as_py()) + b" " * (CONTEXT + TRAIN_BYTES)
            whole = np.frombuffer(framed, np.uint8, len(framed) // TRAIN_BYTES * TRAIN_BYTES).reshape(-1, TRAIN_BYTES)
            rich = whole[_LETTER[whole].sum(axis=1) >= TRAIN_LETTERS]
            own = found.setdefault(lang, set())
            own.update((zlib.crc32(w), w) for w in map(bytes, rich))
            if len(own) > 4 * TRAIN_WINDOWS:
                found[lang] = set(sorted(own)[:TRAIN_WINDOWS])
        rows = [(lang, *w) for lang, own in found.items() for w in sorted(own)[:TRAIN_WINDOWS]]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["lang", "hash", "bytes"])


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, train_windows: int = TRAIN_WINDOWS, steps: int = STEPS) -> Model:
    """Fits to docs (doc_id, text, lang); those without label, text or id, or held out, are not used.

    The driver gets at most ``train_windows`` (no more than ``TRAIN_WINDOWS``) windows of each of at most
    ``MAX_LANGUAGES`` languages, whatever the size of docs. Languages weigh alike.
    """
    spark = docs.sparkSession
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    most = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(MAX_LANGUAGES)
    shares = [(r["lang"], min(1.0, train_docs / r["n"])) for r in most.collect()]
    if not shares:
        return Model([], {})
    chosen = F.broadcast(spark.createDataFrame(shares, "lang string, share double"))  # MAX_LANGUAGES rows at most
    sample = labelled.where(F.col("lang").isin([s for s, _ in shares])).join(chosen, "lang").where(uniform(F.lit("lang-1"), F.col("doc_id")) < F.col("share")).select("lang", "text")
    windows = map_arrow(sample, _train_windows, "lang string, hash long, bytes binary").distinct()
    order = Window.partitionBy("lang").orderBy("hash", "bytes")  # of the sample's windows
    rows = windows.withColumn("k", F.row_number().over(order)).where(F.col("k") <= min(train_windows, TRAIN_WINDOWS)).select("lang", "bytes").collect()
    rows = sorted((r["lang"], bytes(r["bytes"])) for r in rows)
    languages = sorted({lang for lang, _ in rows})
    if not rows:
        return Model([], {})
    x = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, TRAIN_BYTES)
    place = {lang: k for k, lang in enumerate(languages)}
    return Model(languages, bigru.train(x, np.array([place[lang] for lang, _ in rows]), _LETTER[x], len(languages), HIDDEN, steps, BATCH, RATE, SEED))


def windows_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of equal length of all texts: the text's number, where the window's core starts in it, bytes, and which bytes are letters of the core."""
    framed = np.frombuffer(b"".join(b" " * CONTEXT + t + b" " * (CONTEXT + STEP) for t in texts), np.uint8)
    size = np.array([len(t) for t in texts])
    begin = np.cumsum(size + 2 * CONTEXT + STEP) - (size + 2 * CONTEXT + STEP)
    cores = -(-size // CORE)
    text = np.repeat(np.arange(len(texts)), cores)
    at = (np.arange(len(text)) - np.repeat(np.cumsum(cores) - cores, cores)) * CORE
    length = np.minimum(WINDOW, -(-(size[text] - at + 2 * CONTEXT) // STEP) * STEP)
    for n in np.unique(length).tolist():
        own = np.flatnonzero(length == n)
        x = framed[(begin[text[own]] + at[own])[:, None] + np.arange(n)]
        core = np.zeros(n, bool)
        core[CONTEXT : CONTEXT + CORE] = True
        yield text[own], at[own], x, _LETTER[x] & core


class Identifier:
    """Labels texts."""

    def __init__(self, model: Model):
        self.model = model

    def identify(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text; ``und`` and 0 where there is no letter, or nothing was learned."""
        languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        at = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))] if self.model.languages else []
        if not at:
            return languages, scores
        sums, counts = np.zeros((len(at), len(self.model.languages))), np.zeros(len(at))
        for text, _, x, counted in windows_of([_data(texts[i]) for i in at]):
            np.add.at(sums, text, bigru.pooled(self.model.weights, x, counted))
            np.add.at(counts, text, counted.sum(axis=1))
        best = sums.argmax(axis=1)
        for k, i in enumerate(at):
            languages[i] = self.model.languages[best[k]]
            scores[i] = min(1.0, round(float(sums[k, best[k]] / counts[k]), 6))
        return languages, scores

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, language) of stretches of letters with equal labels, by bytes of the lower-cased text."""
        labels: dict[int, int] = {}
        for _, starts, x, counted in windows_of([_data(text)]) if self.model.languages else ():
            found = bigru.probabilities(self.model.weights, x).argmax(axis=2)
            for row, at in enumerate(starts.tolist()):
                labels.update((at + t - CONTEXT, int(found[t, row])) for t in np.flatnonzero(counted[row]).tolist())
        out: list[tuple[int, int, str]] = []
        for at in sorted(labels):
            language = self.model.languages[labels[at]]
            if out and out[-1][1:] == (at, language):
                out[-1] = (out[-1][0], at + 1, language)
            else:
                out.append((at, at + 1, language))
        return out


def _labeller(model: Model, docs: DataFrame):
    """A function from a column of texts to languages and scores, for the workers."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # some ten thousand numbers

    def label(column: pa.Array) -> tuple[list[str], list[float]]:
        return Identifier(shipped.value).identify([t or "" for t in column.to_pylist()])

    return label


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text) to (doc_id, lang_pred, score). Only the text is looked at. No exchange.

    A null, empty or letterless text is ``und`` with score 0. Of equal best languages the
    one that sorts first is given. With nothing learned every text is ``und``.
    """
    label = _labeller(model, docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, 1, BLOCK_BYTES):
            languages, scores = label(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of docs, all columns, of whose letters one language has ``min_score`` of the probability or more.

    Texts without letters go. With nothing learned nothing is judged, and all rows stay.
    """
    if not model.languages:
        return docs
    label = _labeller(model, docs)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, at, BLOCK_BYTES):
            languages, scores = label(batch.column(at))
            yield batch.filter(pa.array([lang != UNKNOWN and s >= min_score for lang, s in zip(languages, scores, strict=True)], pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def op2_byte_gru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document. Extra columns are not read."""
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {"op2_byte_gru_language": op2_byte_gru_language}
ORACLE: dict[str, str] = {}
