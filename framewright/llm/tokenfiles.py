"""Token-id files: one array of ids for many documents, with Elias-Fano coded boundaries.

A file holds the documents of one range of ids, in ascending order:

    ids        n_ids numbers of 2 or 4 bytes, little-endian
    starts     Elias-Fano: the place of each document's first id, and n_ids
    doc ids    Elias-Fano: the ids of the documents that have one
    footer     magic, width, documents, documents without an id (they come first),
               ids, bytes of ``starts``, bytes of ``doc ids``

Ids are written and read as a stream; of a file's documents a writer holds their numbers and lengths.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import checkpoint_dir, map_arrow, read_table, text_blocks
from framewright.llm.eliasfano import EliasFano

MAGIC = b"FWIDS\x00\x00\x01"
FOOTER = struct.Struct("<8sBQQQQQ")
END_ID = 2
#: Bytes of text that are encoded together; a longer text is a block of its own.
BLOCK_BYTES = 4_000_000
#: Distinct segments, and their ids, that a worker keeps; past that it starts anew.
CACHE_SEGMENTS = 800_000
CACHE_IDS = 8_000_000
CACHED_BYTES = 64
#: Ids that are read at once.
READ_IDS = 4_000_000

# White space on whose kind regular expression engines differ, or that is rare.
_ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000]")
_MARKS = rb"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""
_ODDITY, _LETTER, _MARK, _LINE, _SPACE = range(5)
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), 0xC3]] = _LETTER
_KIND[list(_MARKS)] = _MARK
_KIND[10], _KIND[32] = _LINE, _SPACE
_WHITE = np.zeros(256, bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True
_RARE = np.zeros(256, bool)
_RARE[[11, 12, *range(28, 32), 0xC2, 0xE1, 0xE2, 0xE3]] = True
_SPACED_WORD = re.compile(rb" (?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def cuts_words(spec: dict) -> bool:
    """Whether a tokenizer's file asks for the cutting of texts that ``PieceEncoder`` knows: byte-level BPE over raw text."""
    before, model, after = spec.get("pre_tokenizer") or {}, spec.get("model") or {}, spec.get("post_processor") or {"type": "ByteLevel"}
    plain = not any(spec.get(k) for k in ("normalizer", "truncation", "padding")) and after.get("type") == "ByteLevel"
    words = before.get("type") == "ByteLevel" and not before.get("add_prefix_space", True) and before.get("use_regex", True)
    return plain and words and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))


class PieceEncoder:
    """Encodes texts with a tokenizer of byte-level BPE, each distinct segment once.

    Such a tokenizer never joins what stands before a space that follows a
    character other than white space with what comes after it. Texts are
    therefore cut before such spaces, and pieces of nothing but Latin letters, marks and
    single line ends into those. Segments are numbered by Arrow, the distinct ones' ids got from the
    tokenizer itself and kept, and a block's ids gathered through their places. Texts in which a cut could
    fall elsewhere are one segment, and with a tokenizer that cuts in another way all texts are.
    """

    def __init__(self, tokenizer_json: str, cache_segments: int = CACHE_SEGMENTS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        spec = json.loads(tokenizer_json)
        self.cuts = cuts_words(spec)
        self.added = [t["content"].encode() for t in spec.get("added_tokens") or [] if t["content"]]
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():  # each character of a token stands for a byte
            self.bytes_of[i] = len(token)
        self.cache_segments = cache_segments
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.first, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.n, self.n_flat = np.zeros(4096, self.type), 0, 0

    def _room(self, name: str, used: int, more: int) -> np.ndarray:
        """The array of that name, with place for so many more."""
        array = getattr(self, name)
        if used + more > len(array):
            array = np.concatenate([array, np.zeros(max(len(array), used + more - len(array)), array.dtype)])
            setattr(self, name, array)
        return array

    def _add(self, segments: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, n_ids = len(segments), len(ids)
        self._room("flat", self.n_flat, n_ids)[self.n_flat : self.n_flat + n_ids] = ids
        self._room("size", self.n, n)[self.n : self.n + n] = sizes
        self._room("first", self.n, n)[self.n : self.n + n] = self.n_flat + np.cumsum(sizes) - sizes
        self.known.update(zip(segments, range(self.n, self.n + n), strict=True))
        self.n += n
        self.n_flat += n_ids

    def _learn(self, missing: list[bytes]) -> None:
        """Gets the ids of new segments. Words that start with a space are encoded as one text, which is cut by the tokens' lengths."""
        spaced = [s for s in missing if self.cuts and len(s) <= CACHED_BYTES and _SPACED_WORD.fullmatch(s)]
        for start in range(0, len(spaced), 5000):
            part = spaced[start : start + 5000]
            ids = np.array(self.batch([b"".join(part).decode()], add_special_tokens=False)[0].ids, self.type)
            ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))) + 1
            self._add(part, ids, np.diff(ends, prepend=0))
        other = [s for s in missing if s not in self.known]
        for start in range(0, len(other), 5000):
            part = other[start : start + 5000]
            found = [e.ids for e in self.batch([s.decode("utf-8", "replace") for s in part], add_special_tokens=False)]
            self._add(part, np.array([i for own in found for i in own], self.type), np.fromiter(map(len, found), np.int64, len(part)))

    def _whole(self, data: np.ndarray, kind: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Numbers of the texts that must not be cut: rare white space, a space between white space or at the end after it, an added token."""
        at_edge = np.zeros(len(data) + 1, bool)
        at_edge[edge] = True
        white = np.append(_WHITE[data], False)
        spaces = np.flatnonzero(kind == _SPACE)
        run = spaces[white[spaces - 1] & ~at_edge[spaces]]
        run = run[at_edge[run + 1] | white[run + 1]]
        raw = data.tobytes()
        places = [run]
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                places.append(np.array([at]))
                at = raw.find(token, at + 1)
        out = set((np.searchsorted(edge, np.concatenate(places), "right") - 1).tolist())
        rare = np.unique(np.searchsorted(edge, np.flatnonzero(_RARE[data]), "right") - 1)
        out.update(k for k in rare.tolist() if _ODD.search(raw[edge[k] : edge[k + 1]].decode("utf-8", "replace")))
        return np.array(sorted(out), np.int64)

    def _segments(self, data: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Where the segments of a block of texts start; text k has the bytes from edge[k] to edge[k + 1]."""
        mark = np.zeros(len(data) + 1, bool)
        mark[edge] = True
        if self.cuts and len(data):
            kind = _KIND[data]
            latin = np.flatnonzero(data[:-1] == 0xC3) + 1
            kind[latin] = np.where((data[latin] == 0x97) | (data[latin] == 0xB7), _ODDITY, _LETTER)
            whole = self._whole(data, kind, edge)
            mark[:-1] |= kind == _SPACE
            following = np.append(kind[1:], np.uint8(_ODDITY))
            stop = mark[1:]
            bad = (kind == _ODDITY) | ((kind == _LINE) | (kind == _SPACE)) & (stop | (following == _LINE))
            pieces = np.flatnonzero(mark[:-1])
            odd = np.add.reduceat(bad.view(np.uint8), pieces, dtype=np.int64) > 0
            inner = np.flatnonzero(((kind[1:] != kind[:-1]) & (kind[:-1] != _SPACE)) & ~mark[1:-1]) + 1
            mark[inner[~odd[np.searchsorted(pieces, inner, "right") - 1]]] = True
            for k in whole.tolist():
                mark[edge[k] + 1 : edge[k + 1]] = False
        return np.flatnonzero(mark[:-1])

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a block one after the other, and where each text's end. Nulls are empty."""
        texts = texts.fill_null("").cast(pa.large_string())
        if self.n > self.cache_segments or self.n_flat > CACHE_IDS:
            self._forget()
        edge = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        first, last = int(edge[0]), int(edge[-1])
        if first == last:
            return np.zeros(0, self.type), np.zeros(len(texts), np.int64)
        data, edge = np.frombuffer(texts.buffers()[2], np.uint8, last - first, first), edge - first
        starts = self._segments(data, edge)
        cut = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)])
        coded = cut.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn([s for s in distinct if s not in self.known])
        entry = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        for s in distinct:
            if len(s) > CACHED_BYTES:
                del self.known[s]
        size = self.size[entry]
        ends = np.cumsum(size)
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.first[entry] - ends + size, size)]
        return ids, np.concatenate(([0], ends))[np.searchsorted(starts, edge[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        ids, ends = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


_ENCODERS: dict[int, PieceEncoder] = {}


def encoder_of(tokenizer_json: str) -> PieceEncoder:
    """One for each worker process and vocabulary, kept between tasks."""
    key = hash(tokenizer_json)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PieceEncoder(tokenizer_json)
    return _ENCODERS[key]


def file_system(uri: str):
    """The folder's file system, and its path there; any that Arrow knows by its URI."""
    from pyarrow import fs

    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def publish(system, part: str, path: str) -> None:
    """Gives a complete file its name. Where an earlier run of the same task has done so, its file, of the same bytes, is replaced."""
    try:
        system.move(part, path)
    except OSError:  # file systems differ in whether a move replaces
        system.delete_file(path)
        system.move(part, path)


def write_file(folder: str, name: str, blocks: Iterator[tuple[list[int | None], np.ndarray, np.ndarray]], width: int) -> tuple[int, int]:
    """Writes blocks (doc ids, their ids one after the other, where each one's end) in the order given; doc ids must not descend, those without one come first.

    The file appears under its name only when it is complete. A task that runs
    again writes the same bytes; one that fails removes what it wrote.
    """
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    lengths, doc_ids, n_null = [np.zeros(1, np.int64)], [np.zeros(0, np.int64)], 0
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    try:
        with system.open_output_stream(part) as out:
            for own, ids, ends in blocks:
                out.write(ids.tobytes())
                lengths.append(np.diff(ends, prepend=0))
                named = [i for i in own if i is not None]
                n_null += len(own) - len(named)
                doc_ids.append(np.array(named, np.int64))
            bounds = np.cumsum(np.concatenate(lengths))
            starts, names = EliasFano.encode(bounds).to_bytes(), EliasFano.encode(np.concatenate(doc_ids)).to_bytes()
            out.write(starts)
            out.write(names)
            out.write(FOOTER.pack(MAGIC, width, len(bounds) - 1, n_null, int(bounds[-1]), len(starts), len(names)))
        publish(system, part, f"{path}/{name}")
    except BaseException:
        with suppress(OSError):
            system.delete_file(part)
        raise
    return len(bounds) - 1, int(bounds[-1])


class TokenFile:
    """Reads a file's boundaries; ids on demand."""

    def __init__(self, folder: str, name: str):
        system, path = file_system(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        size = self.file.size()
        magic, self.width, self.n, self.n_null, self.n_ids, n_starts, n_named = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{name} is no token file")
        self.starts = EliasFano.from_bytes(self.file.read_at(n_starts, self.n_ids * self.width))
        self.named = EliasFano.from_bytes(self.file.read_at(n_named, self.n_ids * self.width + n_starts))

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.named[i - self.n_null]

    def read_ids(self, start: int, stop: int) -> np.ndarray:
        data = self.file.read_at((stop - start) * self.width, start * self.width)
        return np.frombuffer(data, "<u2" if self.width == 2 else "<u4")

    def document(self, i: int) -> np.ndarray:
        return self.read_ids(self.starts[i], self.starts[i + 1])

    def documents(self, at_once: int = READ_IDS) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc id, start, ids) of all documents, about at_once ids at a time."""
        i = 0
        while i < self.n:
            stop = min(self.n, i + 4096)
            starts = self.starts.slice(i, stop + 1)
            fit = max(1, int(np.searchsorted(starts, starts[0] + at_once, "right")) - 1)
            stop = min(stop, i + fit)
            starts = starts[: stop - i + 1]
            named = self.named.slice(max(i - self.n_null, 0), max(stop - self.n_null, 0)).tolist()
            ids = self.read_ids(int(starts[0]), int(starts[-1]))
            for k, (a, b) in enumerate(zip((starts[:-1] - starts[0]).tolist(), (starts[1:] - starts[0]).tolist(), strict=True)):
                yield (None if i + k < self.n_null else named[k - max(self.n_null - i, 0)]), int(starts[k]), ids[a:b]
            i = stop


def write_tokens(docs: DataFrame, tokenizer_json: str, folder: str, end_id: int = END_ID) -> list[tuple[str, int, int]]:
    """Writes (doc_id, text) to files in folder, in ascending order of doc_id, and returns (file, documents, ids) in that order.

    One exchange by ranges of doc_id; each range is sorted, encoded and written by a
    task of its own. A null text has the end id only. Documents without an id come
    first. Rows with one id are ordered by text. An empty table gives no file, or files
    without documents.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # one vocabulary, a few MB

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = encoder_of(shipped.value)

        def documents() -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
            for block in text_blocks(batches, 1, BLOCK_BYTES):
                ids, ends = encoder.encode_column(block.column(1))
                yield block.column(0).to_pylist(), np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)

        part = TaskContext.get().partitionId()
        n, n_ids = write_file(folder, name := f"part-{part:06d}.ids", documents(), encoder.type.itemsize)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [name], "n": pa.array([n], pa.int64()), "n_ids": pa.array([n_ids], pa.int64())})

    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    # A row for each file, as many as the exchange has partitions.
    written = map_arrow(ordered, write, "part int, file string, n long, n_ids long").collect()
    return [(r["file"], r["n"], r["n_ids"]) for r in sorted(written, key=lambda r: r["part"])]


def read_tokens(spark: SparkSession, folder: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """Every document of the files: doc_id, start among all ids, n_tokens, ids_crc32."""
    rows, start = [], 0
    for name, _, n_ids in files:
        rows.append((name, start))
        start += n_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
                for doc_id, at, ids in TokenFile(folder, name).documents():
                    for column, value in zip(out.values(), (doc_id, first + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], list(out))

    listed = spark.createDataFrame(rows, "file string, first long").repartition(max(1, len(rows)))
    return map_arrow(listed, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None, folder: str | None = None) -> DataFrame:
    """Encodes and writes all documents, reads the files back. Extra columns are not read.

    tokenizer: path of a vocabulary file, read on the driver. folder: where the
    files go; by default a new one in the shared folder.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer, encoding="utf-8") as f:
        tokenizer_json = f.read()
    folder = folder or f"{checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
    return read_tokens(spark, folder, write_tokens(read_table(spark, sf_dir, "documents"), tokenizer_json, folder))


QUERIES = {"op9_token_files": op9_token_files}
ORACLE: dict[str, str] = {}
