"""Small tables with the cases that every operator must bear."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank double, salt int, size long, print string, _place long, _raw string, component_id long, shard int"
WORDS = {
    "en": "the and of that with this from have will their there which would could about other into than then some time very when come here just like long make many over such take these well only year work first".split(),
    "de": "und der die das nicht ein eine mit sich auf für ist dem zu über schön können würde straße müssen größer weiß zwischen später kürzer während gewöhnlich öffnen hören".split(),
    "fr": "le la les des une est dans pour que qui avec être même été après très où déjà élève français garçon leçon reçu près voilà chose toujours jamais".split(),
}


def sentence(rng: random.Random, lang: str, n: int) -> str:
    words = [rng.choice(WORDS[lang]) + rng.choice(["", "", "", "er", "ly", "s"]) for _ in range(n)]
    return " ".join(words)


def documents(seed: int = 0, n: int = 60) -> list[tuple]:
    """Rows of SCHEMA: copies, near copies, nulls in every column, empty, blank and long texts, repeated rows."""
    rng = random.Random(seed)
    texts: list[str | None] = []
    langs = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        text = ".\n".join(sentence(rng, lang, rng.randint(2, 40)) for _ in range(rng.randint(1, 8)))
        if i % 7 == 3:
            text = texts[rng.randrange(len(texts))] or text
        if i % 7 == 5:
            words = (texts[rng.randrange(len(texts))] or text).split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        texts.append(text)
        langs.append(lang)
    rows = [(i, t, lang, f"src{rng.randrange(4) if rng.random() < 0.6 else 0}", len(t)) for i, (t, lang) in enumerate(zip(texts, langs, strict=True))]
    at = n
    for t in (None, "", " \t\n ", "###", "one", "a b", "Ünï cödé 漢字 Ж", "x" * 300, sentence(rng, "en", 9000), "\n".join(["same line here"] * 12), "12 34\n\n\n56"):
        rows.append((at, t, None, None if at % 2 else "src1", None))
        at += 1
    rows += [(None, "no id at all", "en", "src0", 3), (None, None, None, None, None), rows[0], rows[1], rows[1]]
    rng.shuffle(rows)
    return [(*r, 0.5, 1, 2, "p", 3, "r", 4, 5) for r in rows]


def empty_folder(spark, path) -> str:
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def folder(spark, path, rows: list[tuple], items: list[tuple] = ()) -> str:
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)
