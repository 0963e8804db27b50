"""The pipeline against its stages done plainly."""

from __future__ import annotations

import os
import re

import corpus_pipeline
import duckdb
import pyarrow as pa
import pytest
from framewright.llm import decontamination, langid, mixing, sharding
from tests.llm import data
from tests.llm.test_decontamination import _naive
from tests.llm.test_models import _plain
from tests.llm.test_similar import _brute

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows."""
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(folder / str(k)))
        docs = spark.read.parquet(str(folder / str(k)))
        out.append(docs)
    return out


def test_columns(stages):
    own = stages[0].columns
    assert all(s.columns == own for s in stages[:-1]) and stages[-1].columns[: len(own)] == own


def test_language_id_keeps_what_it_can_name(spark, stages):
    model = langid.train(stages[0])
    want = []
    for r in stages[0].where("length(text) < 2500").collect():
        lang, score = _plain(model, r["text"])
        if lang != "und" and score >= langid.MIN_SCORE:
            want.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in stages[1].where("length(text) < 2500").collect()) == sorted(want)


def test_dedup_and_decontamination(spark, stages):
    rows = sorted(stages[1].collect())
    first = _brute([tuple(r) for r in rows])
    kept = [r for r in rows if first[r["doc_id"]] == r["doc_id"]]
    assert sorted(r["doc_id"] for r in stages[2].collect()) == [r["doc_id"] for r in kept]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    bad = {d for d, i, _, covered in decontamination.Items(items).hits([r["text"] for r in kept]) if covered >= decontamination.MIN_COVERAGE * len(decontamination.tokens(items[i][1]))}
    assert sorted(r["doc_id"] for r in stages[3].collect()) == [r["doc_id"] for k, r in enumerate(kept) if k not in bad]


def test_mix_repeats_documents_up_to_three_times(stages):
    ids = [r["doc_id"] for r in stages[4].collect()]
    before = {r["doc_id"]: len((r["text"] or "").split()) for r in stages[3].collect()}
    assert set(ids) <= set(before) and max(ids.count(i) for i in set(ids)) <= 3
    assert sum(before[i] for i in ids) == pytest.approx(sum(before.values()), rel=0.05)


def test_shards_are_even(stages):
    rows = stages[5].collect()
    sizes = [sum(r["shard"] == k for r in rows) for k in range(40)]
    assert len(rows) == stages[4].count() and max(sizes) - min(sizes) <= 1
    for k in range(40):
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(sizes[k]))


def _sql(sql: str, rows: list[tuple], names: list[str]) -> list[dict]:
    """What DuckDB makes of rows as the table documents."""
    con = duckdb.connect()
    documents = pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()], strict=True))})
    con.register("documents", documents)
    cursor = con.execute(sql)
    return [dict(zip([c[0] for c in cursor.description], r, strict=True)) for r in cursor.fetchall()]


def test_run_is_brute_force(spark, tmp_path, monkeypatch):
    """All stages by other means: a plain network pass with the same weights, exact coefficients of all pairs, naive tiling, and SQL for mix and shards."""
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    items = [(1, " ".join(f"item{k}" for k in range(20))), (2, None), (3, "short one")]
    rows, seen = [], set()
    for r in data.documents(4, 70):
        if r[0] is not None and r[0] not in seen and len(r[1] or "") < 2500:
            seen.add(r[0])
            rows.append((r[0], f"{r[1]} {items[0][1]}" if r[0] % 13 == 5 else r[1], *r[2:5]))
    folder = tmp_path / "in"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    model = langid.train(spark.read.parquet(str(folder / "documents.parquet")), steps=60)
    monkeypatch.setattr(langid, "train", lambda docs: model)

    kept = [r for r in rows if (p := _plain(model, r[1]))[0] != "und" and p[1] >= langid.MIN_SCORE]
    first = _brute([(r[0], r[1]) for r in kept])
    kept = [r for r in kept if first[r[0]] == r[0]]
    n = len(kept)
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    kept = [r for r in kept if not any(len(words(t)) >= 5 and 2 * sum(x for _, _, x in _naive(words(t), words(r[1]), 5)) >= len(words(t)) for _, t in items)]
    assert 20 < len(kept) < n < len(rows)
    copies = {r["doc_id"]: r["copies"] for r in _sql(mixing.ORACLE_SQL, kept, names)}
    mixed = [r for r in kept for _ in range(copies[r[0]])]
    assert len(mixed) != len(kept)
    want = sorted((r["doc_id"], r["shard"], r["slot"]) for r in _sql(sharding.ORACLE["op6_hilbert_sharding"], mixed, names))
    out = corpus_pipeline.run(spark, str(folder))
    left = {f.rsplit("/", 2)[-2] for f in out.inputFiles()}
    assert left == {"4-hilbert_sharding"} and os.listdir(out.inputFiles()[0].removeprefix("file:").replace("///", "/").rsplit("/", 2)[0]) == ["4-hilbert_sharding"]
    assert out.columns == [*names, "shard", "slot"]
    got = out.collect()
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in got) == want
    texts = {r[0]: r for r in rows}
    assert all(tuple(r)[:5] == texts[r["doc_id"]] for r in got)


def test_run_on_odd_and_empty_tables(spark, tmp_path):
    """Nulls in every column, repeated rows and columns named like helpers; then no rows at all."""
    rows = data.documents(2, 40)
    out = corpus_pipeline.run(spark, data.folder(spark, tmp_path / "odd", rows, [(1, "a b c d e f")]))
    assert out.columns == [c.split()[0] for c in data.SCHEMA.split(", ") if not c.startswith("shard")] + ["shard", "slot"]
    own = {str(r[:-1]) for r in rows}
    got = out.collect()
    assert got and all(str(tuple(r)[:-2]) in own for r in got)
    assert corpus_pipeline.run(spark, data.empty_folder(spark, tmp_path / "none")).count() == 0
