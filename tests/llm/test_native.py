"""The operators of built-in functions: laws that SQL beside them does not show."""

from __future__ import annotations

import itertools
import math
import random

import pytest
import xxhash
from framewright.llm import licenses, linededup, mixing, quality, sharding
from framewright.llm.common import uniform
from pyspark.sql import functions as F
from tests.llm.data import SCHEMA, documents, sentence
from tests.oracle import TABLES, assert_same


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_neighbours(spark, dims, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(cells, ", ".join(f"c{i} long" for i in range(dims)))
    rows = df.withColumn("h", sharding.hilbert_index([F.col(f"c{i}") for i in range(dims)], bits)).collect()
    path = sorted(rows, key=lambda r: r["h"])
    assert [r["h"] for r in path] == list(range(len(cells)))
    assert all(sum(abs(a[i] - b[i]) for i in range(dims)) == 1 for a, b in itertools.pairwise(path))


@pytest.mark.parametrize("law", ["rows", "bytes"])
@pytest.mark.parametrize("n", [0, 1, 7, 500])
def test_shards_keep_their_law(spark, law, n):
    df = spark.range(n).select(F.lit(5).alias("curve"), (n - F.col("id")).alias("doc_id"), (F.col("id") % 90 + 1).alias("size"))
    rows = sharding.shard(df, [F.col("curve"), F.col("doc_id")], 8, law, F.col("size")).collect()
    assert len(rows) == n
    shards = [[r for r in rows if r["shard"] == k] for k in range(8)]
    for own in shards:
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)
    if law == "rows":
        assert max(map(len, shards)) - min(map(len, shards)) <= 1
    elif n == 500:
        sizes = [sum(r["size"] for r in own) for own in shards]
        assert max(sizes) - min(sizes) <= 2 * 90


def test_shards_keep_all_columns(spark):
    docs = spark.createDataFrame([(*r, 77, 88) for r in documents()], SCHEMA + ", _rank long, curve long")
    out = sharding.sharded(docs)
    assert out.columns == [c for c in docs.columns if c != "shard"] + ["shard", "slot"]
    assert sorted(map(str, out.drop("shard", "slot").collect())) == sorted(map(str, docs.drop("shard").collect()))


def test_codes_keep_the_labels_order(spark, monkeypatch):
    labels = [None] * 3 + ["a"] * 50 + ["b"] + ["hot"] * 100 + [f"s{i:03d}" for i in range(200)]
    df = spark.createDataFrame([(x,) for x in labels], "x string")
    for most in (sharding.BROADCAST_LABELS, 0):
        monkeypatch.setattr(sharding, "BROADCAST_LABELS", most)
        got = {r["x"]: r["c"] for r in sharding.with_code(df, "c", F.col("x"), 4).collect()}
        order = sorted(set(labels), key=lambda x: (x is not None, x or ""))
        assert got == {x: sum((y is not None, y or "") < (x is not None, x or "") for y in labels) * 16 // len(labels) for x in order}


def test_files_are_passed_over_by_every_dimension(spark):
    """Of 40 shards, those whose minima and maxima meet a filter: all of them in the order of ids, few in the curve's."""
    rng = random.Random(6)
    rows = [(i, "x" * int(2 ** rng.uniform(4, 12)), rng.choice(["de", "en", "es", "fr", "it", "ja", "pl", "zh"]), f"host{rng.randrange(60):02d}") for i in range(8000)]
    out = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()

    def met(groups) -> dict[str, float]:
        boxes = [[(min(v), max(v)) for v in ([r[2] for r in g], [r[3] for r in g], [len(r[1]) for r in g])] for g in groups]
        asked = {"lang": (0, sorted({r[2] for r in rows})), "source": (1, sorted({r[3] for r in rows})), "size": (2, [20, 60, 200, 700, 2500])}
        return {name: sum(b[k][0] <= v <= b[k][1] for b in boxes for v in values) / len(values) for name, (k, values) in asked.items()}

    by_id, by_curve = met([rows[200 * k : 200 * (k + 1)] for k in range(40)]), met([[r for r in out if r["shard"] == k] for k in range(40)])
    assert all(v > 38 for v in by_id.values())
    assert by_curve["lang"] < 20 and by_curve["source"] < 20 and by_curve["size"] < 20


def test_plans_have_no_python(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    plans = [licenses.license_scan(docs), quality.rule_counts(docs, ["doc_id"]), sharding.document_keys(docs)]
    for df in plans:
        assert not any(k in df._jdf.queryExecution().executedPlan().toString() for k in ("Python", "Pandas", "ArrowEval", "Cartesian", "NestedLoop"))


def _mix(spark, rows):
    return [r.asDict() for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long, exposure double")).collect()]


def test_targets_fill_up_to_three_times(spark):
    rows = [(i, s, n, 1.0) for i, (s, n) in enumerate([("a", 10)] * 100 + [("b", 1)] * 10 + [("c", 1)] * 2 + [(None, 4)] * 50)]
    by = {r["source"]: (r["source_size"], r["target"]) for r in _mix(spark, rows)}
    total = 1000 + 10 + 2 + 200
    assert sum(t for _, t in by.values()) == pytest.approx(total) and all(t <= 3 * n + 1e-9 for n, t in by.values())
    assert by["b"][1] == 30 and by["c"][1] == 6 and by[None][1] == pytest.approx((total - 36) / 2) == by["a"][1]


def test_mix_comes_near_its_targets_and_repeats(spark):
    rows = [(i, f"s{i % 3 if i % 5 else 0}", (i * 37) % 400, 1.0 if i % 4 else 0.5) for i in range(3000)]
    out = _mix(spark, rows)
    assert all(0 <= r["copies"] <= 3 for r in out)
    for s in {r["source"] for r in out}:
        own = [r for r in out if r["source"] == s]
        assert sum(r["size"] * r["copies"] for r in own) == pytest.approx(own[0]["target"], abs=400)
    again = {r["doc_id"]: r["copies"] for r in _mix(spark, rows[::-1])}
    assert again == {r["doc_id"]: r["copies"] for r in out}


def test_exposure_sets_the_odds(spark):
    rows = [(i, "s" if i % 2 else "t", 10, 1.0 if i % 4 < 2 else 0.25) for i in range(8000)]
    out = [r for r in _mix(spark, rows) if r["source"] == "s"]
    rate = {e: sum(r["copies"] for r in out if r["exposure"] == e) / 2000 for e in (1.0, 0.25)}
    assert rate[1.0] > 1.5 * rate[0.25] > 0


def test_documents_are_drawn_by_their_odds(spark):
    """Sources of one make are draws of one kind: shares are the probabilities whose sizes add up to what is left, half of a source here."""
    rows = [(60 * k + i, f"s{k:02d}", 5 + i % 11, 1.0 if i % 3 else 0.5) for k in range(90) for i in range(60)]
    out = [r for r in _mix(spark, rows) if int(r["source"][1:]) % 3 != 1]  # weights 1 and 3, of 1, 2 and 3
    sizes = {e: sum(r[2] for r in rows[:60] if r[3] == e) for e in (1.0, 0.5)}
    whole = {0: 0, 2: 1}
    drawn = {e: sum(r["size"] * (r["copies"] - whole[int(r["source"][1:]) % 3]) for r in out if r["exposure"] == e) / 60 for e in (1.0, 0.5)}
    total = sum(sizes.values())
    assert {round(r["target"]) for r in out} == {round(total / 2), round(total * 1.5)}
    u = (math.sqrt(sizes[0.5] ** 2 + 4 * sizes[1.0] * total / 2) - sizes[0.5]) / (2 * sizes[1.0])
    assert drawn[1.0] / sizes[1.0] == pytest.approx(1 - u * u, abs=0.03)
    assert drawn[0.5] / sizes[0.5] == pytest.approx(1 - u, abs=0.04)


def test_uniform_is_even(spark):
    counts = spark.range(4000).select(F.floor(uniform(F.lit("x"), F.col("id")) * 8).alias("b")).groupBy("b").count().collect()
    assert len(counts) == 8 and all(400 < r["count"] < 600 for r in counts)


def test_mixed_documents_keep_their_columns(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    have = [str(r) for r in docs.collect()]
    assert all(str(r) in have for r in out.collect())


def test_small_host_needs_more_evidence(spark):
    rows = [("bad", 1)] * 90 + [("bad", 0)] * 10 + [("good", 0)] * 400 + [("good", 2)] * 20 + [("new", 1)] + [(None, 1)] * 3 + [(None, 0)]
    df = spark.createDataFrame(rows, "host string, n_failed int").withColumn("base_failed", F.col("n_failed") > 1)
    out = quality.apply_host_rules(df).collect()
    rate = {r["host"]: r["host_rate"] for r in out}
    assert rate["bad"] > 0.8 and rate["good"] < 0.1 and rate["new"] < 0.95 and rate[None] is None
    assert not any(r["kept"] for r in out if r["host"] == "bad" or r["base_failed"])
    assert all(r["kept"] for r in out if r["host"] in ("good", None) and not r["base_failed"])


def test_a_bad_host_goes_by_several_rules(spark, tmp_path):
    """Query and SQL on a table with a host most of whose documents have too many symbols, which no base rule minds."""
    rng = random.Random(4)
    rows = []
    for i in range(400):
        text = " ".join(f"{sentence(rng, 'en', 1)}{k}" for k in range(rng.choice([20, 60, 60, 60, 60, 80])))
        host = f"h{i % 8}"
        rows.append((i, text.replace(" ", " # ", 30) if host == "h3" and i % 5 else text, "en", host, len(text)))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(str(tmp_path / "d"))
    next((tmp_path / "d").glob("*.parquet")).rename(tmp_path / "documents.parquet")
    for name in TABLES:
        if name != "documents":
            (tmp_path / f"{name}.parquet").symlink_to(f"/root/testdata/sf0.001/{name}.parquet")
    assert_same(spark, quality.op8_host_rules, quality.ORACLE_SQL, str(tmp_path))
    got = {r["doc_id"]: r for r in quality.op8_host_rules(spark, str(tmp_path)).collect()}
    assert not any(got[r[0]]["kept"] for r in rows if r[3] == "h3") and any(not got[r[0]]["base_failed"] for r in rows if r[3] == "h3")
    assert all(got[r[0]]["kept"] != got[r[0]]["base_failed"] for r in rows if r[3] != "h3")


def test_rule_counts_of_small_texts(spark):
    texts = {"a b c a b c": 6, "a b c d a b c": 6, "a a a a": 4, "a a a": 0, "x y": 0, "": 0, "a b c\na b c\n\n x ": 6}
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.rule_counts(rows, ["doc_id"]).collect()}
    assert [got[i]["n_repeat_words"] for i in range(len(texts))] == list(texts.values())
    assert got[6]["n_dup_lines"] == 1 and got[6]["word_chars"] == 7


def test_lines_of_a_run_keep_one_window(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\n a\nb\n\nc\ny"), (3, "z\nz\nz\nz\nz"), (4, None), (5, "b\nc\nd\nb\nc\nd")]
    got = {r["doc_id"]: r for r in linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["text"] == "a\nb\nc\nd" and got[2]["text"] == "x\n\ny" and got[3]["text"] == "z\nz\nz" and got[4]["text"] is None and got[5]["text"] == ""
    assert [tuple(s) for s in got[2]["spans"]] == [(1, 2), (4, 4)] and got[5]["n_removed"] == 6


def _plain_line_dedup(rows: list[tuple]) -> list[tuple]:
    """(doc_id, text) to the same, shortened, by the definition; equal rows are one document."""
    order = {t: xxhash.xxh64_intdigest((t or "").encode(), 42) for _, t in rows}
    order = {t: h - (1 << 64) if h >> 63 else h for t, h in order.items()}
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0, order[r[1]]))
    lines = {d: [(i, x.strip(" \t\n\x0b\x0c\r")) for i, x in enumerate(d[1].split("\n")) if x.strip(" \t\n\x0b\x0c\r")] for d in docs}
    first, gone, several = {}, {d: set() for d in docs}, {}
    for d in docs:
        for w in range(len(lines[d]) - 2):
            key = tuple(x for _, x in lines[d][w : w + 3])
            several.setdefault(key, []).append((d, w))
            first.setdefault(key, (d, w))
    for key, places in several.items():
        for d, w in places:
            if (d, w) != first[key]:
                kept = set(range(first[key][1], first[key][1] + 3)) if d == first[key][0] else set()
                gone[d] |= {lines[d][k][0] for k in range(w, w + 3) if k not in kept}
    return [(i, t if t is None or not gone[i, t] else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i, t])) for i, t in rows]


def test_line_dedup_is_brute_force_with_repeated_and_missing_ids(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(1, "a\nb\nc"), (2, "a\nb\nc\nd"), (2, "x\ny\nz\nw"), (None, "p\nq\nr"), (None, "a\nb\nc"), (7, None), (None, None), (8, ""), (2, "x\ny\nz\nw")]
    for _ in range(60):
        rows.append((rng.choice([None, *range(20)]), "\n".join(rng.choice(["a", " b", "c\t", "d", "", "e"]) for _ in range(rng.randint(0, 9)))))
    rows += rows[10:14]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (linededup.BROADCAST_ROWS, 0):
        monkeypatch.setattr(linededup, "BROADCAST_ROWS", most)
        got = linededup.line_dedup(df).select("doc_id", "text").collect()
        assert sorted(map(tuple, got), key=str) == sorted(_plain_line_dedup(rows), key=str)
    assert (2, "x\ny\nz\nw") in map(tuple, got)


def test_line_dedup_keeps_columns(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    out = linededup.line_dedup(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed", "spans"] and out.count() == docs.count()


def test_licenses_in_other_words(spark):
    rows = [(1, "Intro\n  released under the  MIT-License!\nend"), (2, "Released under some other licence."), (3, licenses.TEMPLATES[1][1].replace(" ", "\n", 9).upper()), (4, None), (5, "")]
    got = {(r["doc_id"], r["line_no"]): r["license"] for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[(1, 2)] == "MIT" and got[(3, 0)] == "Apache-2.0" and not any(k[0] in (2, 4, 5) for k in got)
