from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
import pytest
from framewright.llm import similar
from framewright.llm.simhash import fingerprint_of
from tests.llm.data import SCHEMA, documents
from tests.llm.test_simhash import _roots

SF_DIR = "/root/testdata/sf0.001"


def _shingles(text: str | None) -> set[str]:
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


def _copies(seed: int, similarities: list[float], n: int = 400) -> list[str]:
    """A text of n words and others of about these similarities to it, by changed words at least five apart."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
    out = [" ".join(words)]
    for s in similarities:
        other = list(words)
        for at in rng.sample(range(5, n - 5, 6), round((n - 4) * (1 - s) / (1 + s) / 5)):
            other[at] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(other))
    return out


def test_pairs_just_over_the_similarity_go_and_those_below_stay(spark):
    rows, want = [], []
    for seed in range(40):
        texts = _copies(seed, [random.Random(seed).uniform(0.7, 0.9)])
        rows += [(2 * seed + k, t) for k, t in enumerate(texts)]
        want += [2 * seed] + ([2 * seed + 1] if _jaccard(*map(_shingles, texts)) < 0.8 else [])
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert 45 < len(want) < 75
    assert sorted(r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, docs, SF_DIR).collect()) == want


def _brute(rows: list[tuple]) -> dict[int, int]:
    own = sorted({r[0]: r[1] for r in rows if r[0] is not None}.items())
    sets = [_shingles(t) for _, t in own]
    roots = _roots(len(own), [(i, j) for i in range(len(own)) for j in range(i) if _jaccard(sets[i], sets[j]) >= 0.8])
    return {own[i][0]: own[roots[i]][0] for i in range(len(own))}


def test_classes_are_brute_force(spark):
    rows = documents(6, 150)
    at = 1000
    # A group whose members are more like the first than like each other, and a chain.
    for t in _copies(1, [0.86] * 12) + _copies(2, [0.95] * 8):
        rows.append((at, t, *rows[0][2:]))
        at += 1
    got = {r["doc_id"]: r["component_id"] for r in similar.classes(spark.createDataFrame(rows, SCHEMA)).collect() if r["doc_id"] is not None}
    assert got == _brute(rows)


def test_keys_meet_as_often_as_reckoned():
    met = total = 0
    for seed in range(60):
        a, b = (similar.shingle_set(t) for t in _copies(seed, [0.8]))
        met += int(np.sum(similar.minhash_keys(a) == similar.minhash_keys(b)))
        total += similar.BANDS
    assert abs(met / total - 0.8**similar.ROWS) < 0.06


def test_pipeline_stage_is_brute_force_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first = _brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted(r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, docs, SF_DIR).collect()) == sorted(set(first.values()))


def test_rows_decide_not_ids(spark):
    """Copies without an id go, and an id that several texts share neither keeps nor drops another's text."""
    a, b, c, d = (_copies(seed, [0.95]) for seed in range(4))
    rows = [(None, a[0]), (3, a[1]), (None, b[0]), (None, b[1]), (5, c[0]), (5, d[0]), (1, d[1]), (2, a[0]), (2, a[0]), (2, None), (None, " ")]
    got = similar.near_dedup(spark.createDataFrame([(*r, None) for r in rows], "doc_id long, text string, lang string")).collect()
    assert [r["text"] for r in got if r["doc_id"] is None] in ([b[0]], [b[1]])
    assert sorted([(r["doc_id"], r["text"]) for r in got if r["doc_id"] is not None], key=str) == sorted([(2, a[0]), (5, c[0]), (1, d[1]), (2, None)], key=str)


def test_pairs_at_the_similarity_are_within_the_radius():
    """Short texts too, of which a single shingle is a large part: they end in other words."""
    near = total = 0
    for n in (9, 10, 16, 30, 60, 400, 2000):
        for seed in range(60):
            words = [f"w{seed}-{k}" for k in range(n)]
            a, b = (similar.shingle_set(" ".join(words[:k])) for k in (n, n - int((n - 4) * 0.2)))
            assert similar.similar(a, b, 0.8)
            total += 1
            near += int(np.bitwise_count(fingerprint_of(a, similar.WORDS) ^ fingerprint_of(b, similar.WORDS)).sum()) <= similar.RADIUS
    assert near >= 0.99 * total


@pytest.mark.parametrize("similarity,least", [(0.81, 0.9), (0.85, 0.97), (0.9, 1.0)])
def test_recall_at_the_similarity(spark, similarity, least):
    rows, want = [], set()
    for seed in range(100):
        texts = _copies(seed, [similarity], 300)
        rows += [(2 * seed + k, t) for k, t in enumerate(texts)]
        if _jaccard(*map(_shingles, texts)) >= 0.8:
            want.add(2 * seed + 1)
    kept = {r["doc_id"] for r in similar.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) >= 60 and len(want - kept) >= least * len(want) and all(i in kept for i, _ in rows if i not in want)


def test_a_group_that_is_split_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(similar.deal, "__defaults__", (16,))
    texts = _copies(3, [0.86] * 60, 300)
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r["component_id"] for r in similar.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _brute(rows)


def test_rows_are_joined_alike_without_broadcasts(spark, monkeypatch):
    rows = [r for r in documents(9, 80) if r[0] is not None]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(str, similar.near_dedup(docs).collect()))
    monkeypatch.setattr(similar, "BROADCAST_ROWS", 0)
    assert sorted(map(str, similar.near_dedup(docs).collect())) == want
    assert similar.near_dedup(docs).columns == docs.columns
    assert similar.near_dedup(docs.limit(0)).count() == 0
