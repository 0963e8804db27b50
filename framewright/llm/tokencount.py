"""Token counts without tokens: the best path through a unigram vocabulary, and its length only.

An Aho-Corasick automaton names the vocabulary's pieces that end at each character;
the best path's score and number of pieces are carried from place to place. No piece
is kept, nothing is traced back.

Ties follow the tokenizers library's Unigram model: of paths of equal score to one
place the one whose last piece starts first stays, and a character that is no
piece of its own may be skipped at the least score of all pieces less 10.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import map_arrow, read_table

UNKNOWN_PENALTY = 10.0
#: Distinct words whose counts a worker keeps; past that it starts anew.
CACHE_WORDS = 500_000
CACHED_CHARS = 64
BLANK = "▁"


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, without its control symbols' entries."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not model.is_control(i)]


class UnigramCounter:
    """Counts a text's pieces; words, cut before each blank, are counted one by one and kept.

    The vocabulary's first piece is the one for what is unknown, also where a text spells it out.
    """

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = True, cache_words: int = CACHE_WORDS):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(vocabulary):
            self.automaton.add_word(piece, (len(piece), float(score), i == 0))
        self.automaton.make_automaton()
        self.unknown = min(float(score) for _, score in vocabulary) - UNKNOWN_PENALTY
        self.unknown_size = len(vocabulary[0][0])
        self.byte_fallback = byte_fallback
        self.words: dict[str, tuple[int, float]] = {}
        self.cache_words = cache_words

    def word(self, text: str) -> tuple[int, float]:
        """Pieces on the best path through text, and its score; characters that are no piece count by their bytes or, without fallback, by runs."""
        n = len(text)
        score = [0.0] * (n + 1)
        pieces = [0] * (n + 1)
        run = [0] * (n + 1)  # 1 after the piece for the unknown, 2 after any other run of unknowns
        unknown, at = self.unknown, 0

        def n_bytes(start: int, end: int) -> int:
            return len(text[start:end].encode("utf-8", "surrogatepass"))

        def end_at(end: int, found: list[tuple[int, float, bool]]) -> None:
            best, size, odd = None, 0, False
            for length, value, is_unknown in found:
                candidate = score[end - length] + value
                if best is None or candidate > best:
                    best, size, odd = candidate, length, is_unknown
            if (not found or found[-1][0] != 1) and (best is None or score[end - 1] + unknown > best):
                best, size, odd = score[end - 1] + unknown, 1, True
            start = end - size
            score[end] = best
            if not odd:
                more = 1
            elif not self.byte_fallback:
                more, run[end] = int(not run[start]), 2
            elif size > 1 and not run[start]:
                more, run[end] = 1, 1
            else:  # a run of unknowns is one string, and has a token of its own only if that is the piece itself
                more, run[end] = n_bytes(start, end) + (n_bytes(start - self.unknown_size, start) - 1 if run[start] == 1 else 0), 2
            pieces[end] = pieces[start] + more

        found: list[tuple[int, float, bool]] = []
        for last, match in self.automaton.iter(text):  # for each end the longest first, which starts first
            while at < last:
                at += 1
                end_at(at, found)
                found = []
            found.append(match)
        while at < n:
            at += 1
            end_at(at, found)
            found = []
        return pieces[n], score[n]

    def count(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        text = text.replace(BLANK, " ")
        parts = text.split(" ")
        if len(parts) > 1 and not parts[0]:
            del parts[0]
        words, total, score = self.words, 0, 0.0
        for part in parts:
            known = words.get(part)
            if known is None:
                known = self.word(BLANK + part)
                if len(part) <= CACHED_CHARS:
                    if len(words) >= self.cache_words:
                        words.clear()
                    words[part] = known
            total += known[0]
            score += known[1]
        return total, score


_COUNTERS: dict[int, UnigramCounter] = {}


def token_counts(docs: DataFrame, vocabulary: list[tuple[str, float]]) -> DataFrame:
    """(doc_id, text) to (doc_id, n_tokens, score). Null and empty texts have no tokens. No exchange."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one vocabulary: some ten thousand pieces
    key = hash(tuple(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[key] = UnigramCounter(shipped.value)
        counter = _COUNTERS[key]
        for batch in batches:
            counts = [counter.count(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in counts], pa.int64()), pa.array([s for _, s in counts], pa.float64())], ["doc_id", "n_tokens", "score"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, n_tokens long, score double")


def op3_unigram_counts(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Tokens of every document. vocabulary: path of a sentencepiece file, read on the driver. Extra columns are not read."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(read_table(spark, sf_dir, "documents"), load_vocabulary(vocabulary))


QUERIES = {"op3_unigram_counts": op3_unigram_counts}
ORACLE: dict[str, str] = {}
