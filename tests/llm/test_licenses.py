from __future__ import annotations

import random
import re
import textwrap

from framewright.llm import licenses
from pyspark.sql import functions as F


def _prose(n: int) -> str:
    return "\n".join(f"Rain{k} fell on town{k} and nobody{k} went out{k} that evening{k}." for k in range(n))


def _scan(spark, texts: list[str]) -> dict:
    found = licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {(r["doc_id"], r["line_no"]): r["license"] for r in found}


def test_whole_licences_wrapped_alone_and_inside_a_page(spark):
    texts, want = [], {}
    for name, text in licenses.FULL_TEXTS:
        wrapped = textwrap.fill(text, 76)
        want[len(texts), 0] = name
        texts.append(f"Copyright (c) 2024 Some Body\n\n{wrapped}\n")
        want[len(texts), 42] = name
        texts.append(_prose(40) + f"\n\n{wrapped}\n\n" + _prose(40))
    assert _scan(spark, texts) == want


def test_wrapped_notices_are_found_once(spark):
    notice = "This work is licensed under a Creative Commons\nAttribution 4.0 International License."
    page = _prose(3)
    texts = [f"{page}\n{notice}\n{page}\n{notice}\n{page}", f"{page}\nReleased under the MIT License.\n{page}", f"{page}\n{page}"]
    assert _scan(spark, texts) == {(0, 4): "CC-BY-4.0", (0, 9): "CC-BY-4.0", (1, 4): "MIT"}


def test_passing_texts_over_loses_nothing(spark, monkeypatch):
    """Texts that are just like enough, and ones that are not, with and without the words that are asked for first."""
    rng = random.Random(7)
    texts = []
    for _, text in licenses.TEMPLATES + licenses.FULL_TEXTS:
        words = text.split(" ")
        for share in (0.0, 0.05, 0.1, 0.15, 0.2, 0.3):
            own = [w for w in words if rng.random() >= share] or words
            texts += [" ".join(own), _prose(2) + "\n_" + "_".join(own).upper() + "\n" + _prose(1), textwrap.fill(" ".join(own), 60)]
    docs = spark.createDataFrame([*enumerate(texts), (1000, None), (1001, ""), (1002, _prose(30))], "doc_id long, text string")
    got = sorted(map(tuple, licenses.license_scan(docs).collect()))
    passed = docs.where(licenses.may_hold(F.col("text"), licenses.TEMPLATES + licenses.FULL_TEXTS)).count()
    monkeypatch.setattr(licenses, "may_hold", lambda *a: F.lit(True))
    assert got == sorted(map(tuple, licenses.license_scan(docs).collect()))
    assert len(got) > 150 and passed < docs.count()


def test_words_that_must_stand_are_enough():
    """By the definition: what has t / (2 - t) of a template's bigrams is never passed over."""
    rng = random.Random(1)
    templates = licenses.TEMPLATES + licenses.FULL_TEXTS
    words, rules = licenses.anchors(tuple(templates))
    assert len(rules) == len(templates) and all(sum(counts.values()) > n for n, counts in rules)
    for (_, text), (n, counts) in zip(templates, rules, strict=True):
        grams = licenses.template_bigrams(text)
        for _ in range(50):
            kept = rng.sample(grams, len(grams) - n)
            held = {w for g in kept for w in g.split(" ")}
            assert sum(c for k, c in counts.items() if words[k] not in held and not (len(words[k]) > 3 and any(w.startswith(words[k]) for w in held))) <= n


def test_templates_may_be_few_or_short(spark):
    docs = spark.createDataFrame([(1, "Some licence text here"), (2, "other")], "doc_id long, text string")
    assert licenses.license_scan(docs, []).count() == licenses.license_scan(docs, [("x", "word"), ("y", "")]).count() == 0
    assert [(r["doc_id"], r["license"]) for r in licenses.license_scan(docs, [("x", "some licence text here"), ("y", "")]).collect()] == [(1, "x")]


def test_choice_is_the_longest_of_the_words():
    rng = random.Random(9)
    for _ in range(50):
        words = list({"".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(6)})
        short = [w for w in words if len(w) < 3]
        choice = re.compile(licenses._choice([w + " " if w in short else w for w in words]))
        for _ in range(50):
            text = "".join(rng.choices("abc-", k=6))
            want = max((w for w in words if text.startswith(w) and not (w in short and text[len(w)].isalpha())), key=len, default=None)
            got = choice.match(text)
            assert (got and got.group()) == want, (words, text)
