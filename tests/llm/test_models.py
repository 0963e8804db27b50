"""Language identification."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from framewright.llm import bigru, langid
from tests.llm.data import SCHEMA, WORDS, documents, folder, sentence


def test_gradients_are_the_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in bigru.init(4, 3, 1).items()}
    x, y = rng.integers(0, 256, (3, 5)).astype(np.uint8), np.array([0, 2, 1])
    counted = rng.random((3, 5)) < 0.7
    _, g = bigru.gradients(w, x, y, counted)
    for k, v in w.items():
        flat, own = v.ravel(), g[k].ravel()
        for i in np.argsort(-np.abs(own))[:4]:
            old = flat[i]
            flat[i] = old + 1e-3
            up = bigru.gradients(w, x, y, counted)[0]
            flat[i] = old - 1e-3
            down = bigru.gradients(w, x, y, counted)[0]
            flat[i] = old
            assert own[i] == pytest.approx((up - down) / 2e-3, rel=2e-2, abs=2e-4)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    rows = [(i, sentence(rng, lang, rng.randint(8, 30)), lang) for i in range(240) for lang in [list(WORDS)[i % 3]]]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def model(corpus):
    return langid.train(corpus[1], steps=120)


def test_held_out_accuracy(spark, corpus, model):
    rows, df = corpus
    got = {r["doc_id"]: r for r in langid.identify(df, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert sum(got[r[0]]["lang_pred"] == r[2] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_held_out_and_unlabelled_documents_teach_nothing(spark, corpus, model):
    rows, _ = corpus
    other = [(i, "zzz qqq" if zlib.crc32(str(i).encode()) % 4 == 2 else t, lang) for i, t, lang in rows] + [(None, "qqq", "xx"), (1000, "qqq", None), (1001, None, "en")]
    again = langid.train(spark.createDataFrame(other, "doc_id long, text string, lang string"), steps=120)
    assert again.languages == model.languages
    for k in model.weights:
        np.testing.assert_array_equal(model.weights[k], again.weights[k])


def test_each_position_is_labelled_with_both_contexts(model):
    x = np.frombuffer(b" toujours ", np.uint8)[None, :]
    p = bigru.probabilities(model.weights, x)
    assert p.shape == (10, 1, 3) and np.allclose(p.sum(axis=2), 1, atol=1e-5)
    other = bigru.probabilities(model.weights, np.frombuffer(b" toujoura ", np.uint8)[None, :])
    assert not np.allclose(p[0], other[0], atol=1e-7) and not np.allclose(p[9], other[9], atol=1e-7)


def _plain_probabilities(model, data: bytes) -> list[np.ndarray]:
    """The network as its formulas say, byte by byte, in double precision."""
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    scores = [w["out"].copy() for _ in data]
    for d in bigru.DIRECTIONS:
        n = len(w[f"b{d}"])
        h = np.zeros(n)
        for t in range(len(data)) if d == "f" else reversed(range(len(data))):
            a, g = w[f"W{d}"][data[t]], h @ w[f"U{d}"]
            z, r = 1 / (1 + np.exp(-a[:n] - g[:n])), 1 / (1 + np.exp(-a[n : 2 * n] - g[n : 2 * n]))
            c = np.tanh(a[2 * n :] + r * (g[2 * n :] + w[f"b{d}"]))
            h = z * h + (1 - z) * c
            scores[t] = scores[t] + h @ w[f"V{d}"]
    return [np.exp(s) / np.exp(s).sum() for s in scores]


def _plain(model, text: str | None) -> tuple[str, float]:
    """Language and score by the definition: windows of 224 bytes with 16 on either side, blanks around a text."""
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    data = text.lower().encode()
    total, n = 0.0, 0
    for at in range(0, len(data), 224):
        before, own, after = data[:at][-16:].rjust(16), data[at : at + 224], data[at + 224 : at + 240]
        window = before + own + after
        whole = -(-(len(data) - at + 32) // 32) * 32
        p = _plain_probabilities(model, window.ljust(min(256, whole)))
        for t, byte in enumerate(own):
            if 97 <= byte <= 122 or byte >= 128:
                total, n = total + p[16 + t], n + 1
    return model.languages[int(total.argmax())], float(total.max() / n)


def test_query_is_brute_force(spark, tmp_path, monkeypatch):
    """Nulls, repeated rows, letterless and long texts: the query against a plain pass with the same weights."""
    rows = [r for r in documents(3) if len(r[1] or "") < 3000]
    monkeypatch.setattr(langid, "STEPS", 40)
    path = folder(spark, tmp_path, rows)
    model = langid.train(spark.read.parquet(f"{path}/documents.parquet"), steps=60)
    monkeypatch.setattr(langid, "train", lambda docs: model)
    got = sorted((r["doc_id"] is None, r["doc_id"], r["held_out"], r["lang_pred"], r["score"]) for r in langid.op2_byte_gru_language(spark, path).collect())
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    want = sorted((r[0] is None, r[0], held(r[0]), *_plain(model, r[1])) for r in rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    np.testing.assert_allclose([g[4] for g in got], [w[4] for w in want], atol=2e-4)


def test_company_changes_nothing(model):
    texts = ["die Straße und die " + "x" * 700, "le garçon", "", "die Straße", "le garçon " + "é" * 400] * 3
    alone = [langid.Identifier(model).identify([t]) for t in texts]
    together = langid.Identifier(model).identify(texts)
    assert [a[0][0] for a in alone] == together[0]
    np.testing.assert_allclose([a[1][0] for a in alone], together[1], atol=2e-6)


def test_spans_cover_every_letter(model):
    text = "Le garçon, und  DIE straße\n" + "x" * 350 + " 12"
    covered = [i for a, b, _ in langid.Identifier(model).spans(text) for i in range(a, b)]
    data = text.lower().encode()
    assert covered == [i for i, c in enumerate(data) if 97 <= c <= 122 or c >= 128]


def test_a_language_without_blanks_is_learned(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, "en", 40) if i % 2 else "".join(rng.choices("日本語の文章です私はこれを読みますあいうえおかきくけこ", k=150)), "en" if i % 2 else "ja") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df, steps=60)
    assert model.languages == ["en", "ja"]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(df, model).collect()}
    assert all(got[i] == lang for i, _, lang in rows)


def test_the_most_frequent_labels_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    rng = random.Random(5)
    rows = [(i, sentence(rng, lang, 30), lang) for i, lang in enumerate(["en"] * 40 + ["de"] * 30 + ["fr"] * 20)]
    assert langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), steps=5).languages == ["de", "en"]


def test_undetermined(spark, model):
    rows = [(1, None), (2, ""), (3, "12 #!"), (4, "é")]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] in model.languages


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in langid.identify(df, langid.train(df)).collect()] == [(1, "und", 0.0)]


def test_filter_keeps_columns_and_clean_rows(spark, model):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA)
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns
    want = [r for r in rows if (p := _plain(model, r[1] and r[1][:1500]))[0] != "und" and p[1] > 0.6]
    texts = [r["text"] for r in kept.collect()]
    assert all(any(map(str.isalpha, t)) for t in texts) and len(want) >= 60 and len(texts) >= len(want) - 2


def test_filter_rejects_what_is_no_language(spark, model):
    rng = random.Random(2)
    noise = ["".join(rng.choices("qxzjkvwy0123456789#", k=400)) for _ in range(5)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*noise, "!!! 123", sentence(rng, "en", 40)])], "doc_id long, text string")
    strict = [r["doc_id"] for r in langid.keep_identified(df, model, min_score=0.9).collect()]
    assert 6 in strict and 5 not in strict and len(strict) < 6
    assert langid.keep_identified(df, langid.Model([], {})).count() == 7
