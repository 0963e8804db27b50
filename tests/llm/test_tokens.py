"""Token counts and token files against the tokenizers library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from framewright.llm import tokencount, tokenfiles
from framewright.llm.eliasfano import EliasFano
from tests.llm.data import documents, folder

P = pytest.importorskip("public_tokenizers")
ODD = list("abcthe in er  \n\t▁é漢😀ßx<>0A's.,12|") + ["<unk>", "<0x0A>", "\x00", "  ", " ", "\x1c", "\x85", "\r\n", " \n", "<|endoftext|>", "　"]


def _texts(seed: int, n: int = 800) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(ODD, k=rng.randint(0, 24))) for _ in range(n)] + [r[1] or "" for r in documents(seed)]


@pytest.mark.parametrize("fallback", [True, False])
def test_counts_are_the_librarys(fallback):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = tokencount.load_vocabulary(P.path("piece_bpe_32k.model"))
    own = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=fallback))
    own.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = tokencount.UnigramCounter(vocabulary, fallback, cache_words=50)
    for text in _texts(1):
        assert counter.count(text)[0] == len(own.encode(text, add_special_tokens=False).ids), text


def test_ties_are_the_librarys():
    from tokenizers import Tokenizer, models, pre_tokenizers

    rng = random.Random(6)
    for _ in range(40):
        pieces = {"<unk>": 0.0, "▁": -1.0} | {"".join(rng.choices("ab▁", k=rng.randint(1, 4))): -float(rng.randint(1, 3)) for _ in range(8)}
        vocabulary = list(pieces.items())
        own = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False))
        own.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
        counter = tokencount.UnigramCounter(vocabulary, False)
        for _ in range(40):
            text = "".join(rng.choices("abc ", k=rng.randint(0, 12)))
            assert counter.count(text)[0] == len(own.encode(text).ids), (vocabulary, text)


def test_score_is_the_best_of_all_paths():
    vocabulary = [("<unk>", 0.0), ("a", -3.0), ("ab", -2.5), ("b", -1.0), ("ba", -3.5), ("▁", -0.5), ("▁a", -4.0)]
    counter, known = tokencount.UnigramCounter(vocabulary, False), dict(vocabulary)

    def best(s: str) -> float:
        return max([known[s[:k]] + best(s[k:]) for k in range(1, len(s) + 1) if s[:k] in known and k < 5], default=0.0 if not s else -1e9)

    for text in ("abba", "aab", "bbabab"):
        assert counter.count(text)[1] == best("▁" + text)


def test_count_query(spark, tmp_path):
    rows = documents(5)
    counter = tokencount.UnigramCounter(tokencount.load_vocabulary(P.path("piece_bpe_32k.model")))
    got = tokencount.op3_unigram_counts(spark, folder(spark, tmp_path, rows)).collect()
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=str) == sorted(((r[0], counter.count(r[1])[0]) for r in rows), key=str)


def test_elias_fano_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 255, 256, 257, 2000):
        for span in (1, 50, 10**6, 1 << 62):
            values = np.sort(rng.integers(-span, span, n))
            coded = EliasFano.encode(values)
            back = EliasFano.from_bytes(coded.to_bytes())
            assert (back.slice(0, n) == values).all()
            for i in rng.integers(0, n, 20).tolist() if n else []:
                assert back[i] == values[i] and (back.slice(i, i + 9) == values[i : i + 9]).all()
    with pytest.raises(ValueError):
        EliasFano.encode(np.array([2, 1]))
    assert len(EliasFano.encode(np.arange(0, 10**7, 500)).to_bytes()) < 20_000 * (2 + 9 + 1) / 8 * 1.2


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_segments_are_the_whole_texts(name):
    """Also with a tokenizer that cuts texts in another way."""
    from tokenizers import Tokenizer

    with open(P.path(name), encoding="utf-8") as f:
        text = f.read()
    own, encoder = Tokenizer.from_str(text), tokenfiles.PieceEncoder(text, cache_segments=40)
    texts = _texts(3, 3000)
    for at in range(0, len(texts), 7):
        part = texts[at : at + 7]
        assert [np.frombuffer(b, encoder.type).tolist() for b in encoder.encode(part)] == [own.encode(t, add_special_tokens=False).ids for t in part]


def test_plain_texts_are_the_whole_texts():
    """Letters of Latin scripts, marks and line ends in every order: what is cut into words."""
    from tokenizers import Tokenizer

    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        text = f.read()
    own, encoder, rng = Tokenizer.from_str(text), tokenfiles.PieceEncoder(text), random.Random(4)
    texts = ["".join(rng.choices(["a", "the", "É", "ß", "×", "÷", " ", " ", "\n", "(", ").", "-", "'s", "7", "Ā"], k=rng.randint(0, 14))) for _ in range(6000)]
    assert [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(texts)] == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_task_that_runs_again_replaces_its_file(tmp_path, monkeypatch):
    """Also where a move refuses a name that is taken."""
    from pyarrow import fs

    class Refusing:
        def __init__(self):
            self.own = fs.LocalFileSystem()

        def __getattr__(self, name):
            return getattr(self.own, name)

        def move(self, a, b):
            if self.own.get_file_info(b).type != fs.FileType.NotFound:
                raise OSError("taken")
            self.own.move(a, b)

    monkeypatch.setattr(tokenfiles, "file_system", lambda uri: (Refusing(), uri))
    blocks = [([None, 3], np.array([5, 6, 2, 2], "<u2"), np.array([3, 4])), ([9], np.array([2], "<u2"), np.array([1]))]
    for _ in range(2):
        assert tokenfiles.write_file(str(tmp_path), "a.ids", iter(blocks), 2) == (3, 5)
    with pytest.raises(ValueError):
        tokenfiles.write_file(str(tmp_path), "b.ids", iter(blocks[::-1]), 2)
    assert [p.name for p in tmp_path.iterdir()] == ["a.ids"]
    assert [(i, at, ids.tolist()) for i, at, ids in tokenfiles.TokenFile(str(tmp_path), "a.ids").documents()] == [(None, 0, [5, 6, 2]), (3, 3, [2]), (9, 4, [2])]


def test_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    rows, out = documents(4), tmp_path / "files"
    source = folder(spark, tmp_path / "in", rows)
    got = sorted(map(tuple, tokenfiles.op9_token_files(spark, source, folder=str(out)).collect()), key=lambda r: r[1])
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want, start = [], 0
    for doc_id, text in sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*own.encode(text, add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    # By number, too, from whichever file.
    for name in sorted(p.name for p in out.iterdir()):
        file = tokenfiles.TokenFile(str(out), name)
        listed = list(file.documents(at_once=50))
        assert len(listed) == file.n and [(i, x.tolist()) for i, _, x in listed] == [(file.doc_id(k), file.document(k).tolist()) for k in range(file.n)]
    assert not [p for p in out.iterdir() if p.name.startswith(".")]
