from __future__ import annotations

import random

from framewright.llm import decontamination
from framewright.llm.tiling import tiles
from tests.llm.data import SCHEMA, documents, folder


def _naive(pattern: list, text: list, minimum: int) -> list[tuple[int, int, int]]:
    free_p, free_t, out = [x is not None for x in pattern], [x is not None for x in text], []
    while True:
        best = (0, 0, 0)
        for i in range(len(pattern)):
            for j in range(len(text)):
                n = 0
                while i + n < len(pattern) and j + n < len(text) and free_p[i + n] and free_t[j + n] and pattern[i + n] == text[j + n]:
                    n += 1
                if n > best[2]:
                    best = (i, j, n)
        if best[2] < minimum:
            return out
        out.append(best)
        for k in range(best[2]):
            free_p[best[0] + k] = free_t[best[1] + k] = False


def test_tiling_is_the_naive_one():
    rng = random.Random(1)
    for _ in range(600):
        kinds, minimum = rng.choice([2, 3, 9]), rng.randint(1, 5)
        pattern = [rng.randrange(kinds) for _ in range(rng.randint(0, 30))]
        text = [rng.randrange(kinds) for _ in range(rng.randint(0, 45))]
        assert tiles(pattern, text, minimum) == _naive(pattern, text, minimum)


def test_reordered_passage_is_covered():
    rng = random.Random(2)
    item = rng.sample(range(1000), 120)
    text = item[80:] + [5000] * 9 + item[40:80] + [6000] + item[:40]
    assert sum(n for _, _, n in tiles(item, text, 5)) == 120


def _items() -> list[tuple]:
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    return [(i, " ".join(rng.choices(words, k=rng.randint(8, 40)))) for i in range(12)] + [(50, None), (51, ""), (52, "tiny one"), (None, "an item that has no id of its own")]


def _planted() -> list[tuple]:
    rng, rows = random.Random(9), documents(9, 40)
    out = []
    for r in rows:
        text = r[1]
        kind = rng.randrange(5)
        item = rng.choice([t for _, t in _items() if t and len(t.split()) > 7]).split()
        if text and kind == 0:
            text = text + "\n" + " ".join(item).upper()
        elif text and kind == 1:
            half = len(item) // 2
            text = " ".join(item[half:]) + "! " + text + " (" + ", ".join(item[:half]) + ")"
        elif text and kind == 2:
            text = text + " " + " ".join(item[: len(item) // 3])
        out.append((r[0], text, *r[2:]))
    return out


def _want(rows: list[tuple]) -> list[tuple]:
    want = []
    for r in rows:
        words = decontamination.tokens(r[1])
        for item_id, text in _items():
            own = decontamination.tokens(text)
            if len(own) >= decontamination.MIN_MATCH:
                found = _naive(own, words, decontamination.MIN_MATCH)
                covered = sum(n for _, _, n in found)
                if covered >= decontamination.MIN_COVERAGE * len(own):
                    want.append((r[0], item_id, len(found), covered, len(own), covered / len(own)))
    return want


def test_query_is_brute_force(spark, tmp_path):
    rows = [r for r in _planted() if len(r[1] or "") < 5000]
    got = decontamination.op7_string_tiling(spark, folder(spark, tmp_path, rows, _items())).collect()
    want = _want(rows)
    assert len(want) > 10 and sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    rows = _planted()
    docs, items = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(_items(), "item_id long, text string")
    whole = sorted(map(tuple, decontamination.contaminated_pairs(docs, items).collect()), key=str)
    kept = sorted((str(r) for r in decontamination.drop_contaminated(docs, items).collect()))
    split = decontamination.item_blocks
    monkeypatch.setattr(decontamination, "item_blocks", lambda b: split(b, 400))
    assert len(list(split(items, 400))) > 2
    assert sorted(map(tuple, decontamination.contaminated_pairs(docs, items).collect()), key=str) == whole
    assert sorted(str(r) for r in decontamination.drop_contaminated(docs, items).collect()) == kept


def test_filter_drops_the_pairs_documents_only(spark):
    rows = list({r[0]: r for r in _planted() if r[0] is not None}.values())
    docs, items = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(_items(), "item_id long, text string")
    bad = {r["doc_id"] for r in decontamination.contaminated_pairs(docs, items).collect()}
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in rows if r[0] not in bad)


def test_an_item_of_few_words_condemns_nothing(spark):
    docs = spark.createDataFrame([(1, "yes and no, one two three four five six"), (2, "one two three four five")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "yes"), (2, "and no"), (3, "one two three four"), (4, "one two three four five")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontamination.contaminated_pairs(docs, items).collect()) == [(1, 4), (2, 4)]
    assert decontamination.drop_contaminated(docs, items.where("item_id < 4")).count() == 2
