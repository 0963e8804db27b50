"""License scans: texts and lines that read like a licence or a licence notice.

A line, and a text as a whole, is normalised to its words in lower case and compared
with each template by the Dice coefficient 2|A & B| / (|A| + |B|) over their sets of word
bigrams. So are runs of lines, for a licence may be wrapped and stand in a longer text. A template can reach the threshold t only if its number of bigrams is between
|A| t / (2 - t) and |A| (2 - t) / t; the others are passed over by size alone. What reaches it has
t / (2 - t) of the template's bigrams at least, so texts that lack so many of some telling words (``anchors``)
that the bigrams without these are too few for any template are passed over whole.
"""

from __future__ import annotations

import re
from functools import cache
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import cut_lineage, read_table

MIN_DICE = 0.8

# Names and wordings of public licences and their usual notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 '
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, '
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS"'
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_OPENING = {name: text for name, text in TEMPLATES if name in ("BSD-2-Clause", "ISC", "MIT")}
#: Whole licences; TEMPLATES has only their opening paragraphs.
FULL_TEXTS = [
    ("BSD-2-Clause", f"{_OPENING['BSD-2-Clause']} {_BSD_END}"),
    (
        "BSD-3-Clause",
        f"{_OPENING['BSD-2-Clause']} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_BSD_END}",
    ),
    (
        "ISC",
        f"{_OPENING['ISC']} {_AS_IS} AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT",
        f"{_OPENING['MIT']} {_AS_IS}, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
]
WORDS = r"[^\p{L}\p{N}]+"
# Common English words, which tell nothing of a text.
COMMON = set("a all an and any are as at be by can for from if in into is it may more must no not of on or other shall such that the this to under use used will with without you your".split())


def normal_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORDS), lambda w: w != "")


def _bigrams(words: Column, n: Column) -> Column:
    """Distinct pairs of neighbours; ``words`` must be a column, as it is named twice."""
    shorter = F.greatest(n - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, 1, shorter), F.slice(words, 2, shorter), lambda a, b: F.concat_ws(" ", a, b)))


def template_bigrams(template: str) -> list[str]:
    words = [w for w in re.split(r"[\W_]+", template.lower()) if w]
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def _holds(gram: list[str], word: str) -> bool:
    """Whether a text of which no word is this one, or starts with it if it has four letters or more, lacks the bigram."""
    return word in gram if len(word) < 4 else any(w.startswith(word) for w in gram)


def _choice(ends: list[str]) -> str:
    """A regular expression for any of some texts, longer ones first, that looks at each letter once; a text's last sign may be a blank for the end of a word."""
    by_head: dict[str, list[str]] = {}
    for x in ends:
        by_head.setdefault(x[:1], []).append(x[1:])
    parts = []
    for head, rest in sorted(by_head.items(), reverse=True):  # the empty one comes last
        own = "(?![a-z0-9])" if head == " " else head
        parts.append(own + (_choice(rest) if any(rest) else "") if head else "")
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


@cache
def anchors(templates: tuple[tuple[str, str], ...], min_dice: float = MIN_DICE) -> tuple[list[str], list[tuple[int, dict[int, int]]]]:
    """Words, and for each template how many of its bigrams a text may miss, and how many it surely misses for each word that it lacks.

    Each bigram counts for one word that it holds, as a word or the start of one. Words are taken by
    the number of bigrams that then count for them, common and short ones last: first until more count than a text may miss, then,
    of telling words only, until half as many again do.
    """
    known = [[g.split(" ") for g in template_bigrams(text)] for _, text in templates]
    may_miss = [len(own) - ceil(len(own) * min_dice / (2 - min_dice) - 1e-9) for own in known]
    left = [list(own) for own in known]
    words: list[str] = []
    counts: list[dict[int, int]] = [{} for _ in known]
    telling = lambda w: w not in COMMON and len(w) >= 4
    for want, every_word in (([n + 1 for n in may_miss], True), ([n + 1 + n // 2 for n in may_miss], False)):
        while True:
            wanting = [n - sum(c.values()) for n, c in zip(want, counts, strict=True)]
            every = sorted({w for own, n in zip(left, wanting, strict=True) if n > 0 for g in own for w in g if telling(w) or every_word})
            if not every:
                break
            gain = {w: sum(min(max(n, 0), sum(_holds(g, w) for g in own)) for own, n in zip(left, wanting, strict=True)) for w in every}
            best = max(every, key=lambda w: (telling(w), w not in COMMON, gain[w], len(w)))
            for k, own in enumerate(left):
                if n := sum(_holds(g, best) for g in own):
                    counts[k][len(words)] = n
                    left[k] = [g for g in own if not _holds(g, best)]
            words.append(best)
    return words, list(zip(may_miss, counts, strict=True))


def may_hold(text: Column, templates: list[tuple[str, str]], min_dice: float = MIN_DICE) -> Column:
    """Whether a text has words enough for anything in it to be like one of the templates. One pass of a regular expression."""
    words, rules = anchors(tuple(templates), min_dice)
    # At the start of a word or after any letter that is not ASCII, which is no less.
    choice = _choice([w if len(w) >= 4 else f"{w} " for w in words])

    def fits(found: Column) -> Column:
        lacking = F.transform(F.array(*[F.lit(w) for w in words]), lambda w: (~F.exists(found, lambda x: F.startswith(x, w))).cast("int"))

        def any_template(lacks: Column) -> Column:
            out = F.lit(False)
            for n, counts in rules:
                missed = F.lit(0)
                for k, count in counts.items():
                    missed = missed + F.get(lacks, F.lit(k)) * count
                out = out | (missed <= n)
            return out

        return F.when(F.size(found) == 0, F.lit(False)).otherwise(_let(lacking, any_template))

    return _let(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(rf"(?:^|[^a-z0-9])({choice})"), F.lit(1))), fits)


def scan_units(units: DataFrame, keep: list[str], templates: list[tuple[str, str]] | None = None, min_dice: float = MIN_DICE) -> DataFrame:
    """units (keep, unit) to (keep, license, dice), for those that are like a template: the likest, of equals the first by name.

    The templates are constants of the plan; a unit is tested against those of a fitting size, inside its row.
    """
    known = [(name, template_bigrams(text)) for name, text in (TEMPLATES + FULL_TEXTS if templates is None else templates)]
    low, high = min_dice / (2 - min_dice), (2 - min_dice) / min_dice
    smallest = min(len(b) for _, b in known) * low
    # Each step's value comes out of a generator of one row: a filter on it is then not pushed
    # below it, where it would compute the value a second time.
    words = units.select(*keep, F.explode(F.array(normal_words(F.col("unit")))).alias("_w")).where(F.size("_w") - 1 >= smallest)
    grams = words.select(*keep, F.explode(F.array(_bigrams(F.col("_w"), F.size("_w")))).alias("_g")).where(F.size("_g") >= smallest)
    n = F.size("_g")
    scores = []
    for name, own in known:
        fits = (F.lit(len(own)) >= n * low) & (F.lit(len(own)) <= n * high)
        dice = F.size(F.array_intersect("_g", F.array(*[F.lit(g) for g in own]))) * 2.0 / (n + len(own))
        scores.append(F.when(fits, F.struct((-dice).alias("dice"), F.lit(name).alias("license"))))
    best = F.least(*scores) if len(scores) > 1 else scores[0]
    found = grams.select(*keep, F.explode(F.array(best)).alias("_best")).where(F.col("_best.dice") <= -min_dice)
    return found.select(*keep, F.col("_best.license").alias("license"), (-F.col("_best.dice")).alias("dice"))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scan_runs(docs: DataFrame, templates: list[tuple[str, str]] | None = None, min_dice: float = MIN_DICE) -> DataFrame:
    """(doc_id, text) to (doc_id, line_no, license, dice) of runs of two or more lines that are like a template.

    line_no is the run's first line. A run has no more words than the largest fitting set of the
    template's bigrams makes, in the template's proportion of words to distinct bigrams. Of runs that overlap the likest stays, of
    equals the shortest, then the first; none overlaps a line that is like a template by itself, and none
    is in a text that is so as a whole. Only texts that have the bigrams a run needs are looked at.
    """
    known = [(name, template_bigrams(text), len([w for w in re.split(r"[\W_]+", text) if w])) for name, text in (TEMPLATES + FULL_TEXTS if templates is None else templates)]
    low, high = min_dice / (2 - min_dice), (2 - min_dice) / min_dice
    # A set of n bigrams has min_dice (n + |B|) / 2 of a template's at least, and n is |B| low at least.
    need = [ceil(len(own) * low - 1e-9) for _, own, _ in known]
    every = F.array(*[F.lit(g) for g in dict.fromkeys(g for _, own, _ in known for g in own)])
    lists = [F.array(*[F.lit(g) for g in own]) for _, own, _ in known]
    words = docs.where(F.instr("text", "\n") > 0).select("doc_id", "text", F.explode(F.array(normal_words(F.col("text")))).alias("_w"))
    grams = words.select("doc_id", "text", "_w", F.explode(F.array(F.array_intersect(_bigrams(F.col("_w"), F.size("_w")), every))).alias("_own")).where(F.size("_own") >= min(need))
    usable = F.array(*[(F.size(F.array_intersect("_own", own)) >= n) for own, n in zip(lists, need, strict=True)])
    fit = grams.select("doc_id", "text", "_w", F.explode(F.array(usable)).alias("_ok")).where(F.array_contains("_ok", True))
    numbered = F.transform(F.split("text", "\n"), lambda line, i: F.struct((i + 1).alias("no"), F.size(normal_words(line)).alias("n")))
    lines = fit.select("doc_id", "_w", "_ok", F.explode(F.array(F.filter(numbered, lambda x: x["n"] > 0))).alias("_lines"))
    ends = F.aggregate("_lines", F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["n"])))
    most = F.greatest(*[F.when(F.col("_ok")[k], F.lit(int(high * n) + 1)).otherwise(F.lit(1)) for k, (_, _, n) in enumerate(known)], F.lit(1))
    lines = lines.select("doc_id", "_w", "_ok", "_lines", F.explode(F.array(ends)).alias("_ends"), most.alias("_most"))
    last = F.size("_lines")

    def scored(i: Column, j: Column) -> Column:
        """The run from line i to line j, of those that have words: rank, minus dice, length, first line, license."""
        size = F.col("_ends")[j] - F.col("_ends")[i - 1]

        def best(g: Column) -> Column:
            n = F.size(g)
            scores = []
            for k, (name, own, _) in enumerate(known):
                fits = F.col("_ok")[k] & (F.lit(len(own)) >= n * low) & (F.lit(len(own)) <= n * high)
                scores.append(F.when(fits, F.struct((F.size(F.array_intersect(g, lists[k])) * -2.0 / (n + len(own))).alias("dice"), F.lit(name).alias("license"))))
            own_best = F.least(*scores) if len(scores) > 1 else scores[0]
            by_itself = (i == j) | ((i == 1) & (j == last))
            return _let(own_best, lambda x: F.struct(F.when(by_itself, 0).otherwise(1).alias("rank"), x["dice"].alias("dice"), (j - i).alias("more"), i.alias("i"), j.alias("j"), x["license"].alias("license")))

        return _let(F.slice(F.col("_w"), F.col("_ends")[i - 1] + 1, size), lambda w: _let(_bigrams(w, size), best))

    def from_line(i: Column) -> Column:
        to = F.filter(F.sequence(i, F.least(last, i + F.col("_most"))), lambda j: F.col("_ends")[j] - F.col("_ends")[i - 1] <= F.col("_most"))
        return F.filter(F.transform(to, lambda j: scored(i, j)), lambda x: x["dice"] <= -min_dice)

    # The whole text may be longer than any run; it is looked at beside them.
    runs = F.concat(F.flatten(F.transform(F.sequence(F.lit(1), last), from_line)), F.filter(F.array(scored(F.lit(1), last)), lambda x: x["dice"] <= -min_dice))
    runs = lines.select("doc_id", "_lines", F.explode(F.array(F.sort_array(runs))).alias("_runs")).where(F.exists("_runs", lambda x: x["rank"] == 1))
    chosen = F.aggregate("_runs", F.slice("_runs", 1, 0), lambda acc, x: F.when(F.exists(acc, lambda y: (y["i"] <= x["j"]) & (x["i"] <= y["j"])), acc).otherwise(F.concat(acc, F.array(x))))
    found = runs.select("doc_id", "_lines", F.explode(F.filter(chosen, lambda x: x["rank"] == 1)).alias("_run"))
    return found.select("doc_id", F.col("_lines")[F.col("_run.i") - 1]["no"].cast("long").alias("line_no"), F.col("_run.license").alias("license"), (-F.col("_run.dice")).alias("dice"))


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, min_dice: float = MIN_DICE) -> DataFrame:
    """(doc_id, text) to a row for each line, each run of lines, and each whole text of several lines, that is like a template.

    doc_id, line_no (from 1; a run's first; 0 for the whole text), license, dice. Null and empty texts
    have no row; repeated rows each have theirs. Templates of less than two words are like nothing. No exchange.
    """
    known = [(name, text) for name, text in (TEMPLATES + FULL_TEXTS if templates is None else templates) if template_bigrams(text)]
    if not known:
        return docs.select("doc_id", F.lit(0).cast("long").alias("line_no"), F.lit("").alias("license"), F.lit(0.0).alias("dice")).limit(0)
    # Those that remain are kept, so that lines, runs and whole texts do not each look for them again.
    docs = cut_lineage(docs.select("doc_id", "text").where(may_hold(F.col("text"), known, min_dice)))
    lines = docs.select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("at", "unit")).where(F.col("unit").isNotNull()).select("doc_id", (F.col("at") + 1).cast("long").alias("line_no"), "unit")
    whole = docs.where(F.instr("text", "\n") > 0).select("doc_id", F.lit(0).cast("long").alias("line_no"), F.col("text").alias("unit"))
    return scan_units(lines.union(whole), ["doc_id", "line_no"], known, min_dice).union(scan_runs(docs, known, min_dice))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences and notices in all documents. Extra columns are not read."""
    return license_scan(read_table(spark, sf_dir, "documents"))


def _oracle() -> str:
    quoted = ", ".join("('{}', [{}])".format(name, ", ".join("'" + g.replace("'", "''") + "'" for g in template_bigrams(text))) for name, text in TEMPLATES)
    return f"""
WITH t(license, b) AS (VALUES {quoted}), units AS (
  SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no, unnest(string_split(text, chr(10))) AS unit FROM documents
  UNION ALL SELECT doc_id, 0, text FROM documents WHERE contains(text, chr(10))
), words AS (
  SELECT doc_id, line_no, list_filter(regexp_split_to_array(lower(unit), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w FROM units
), grams AS (
  SELECT doc_id, line_no, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM words WHERE len(w) > 1
), scored AS (
  SELECT doc_id, line_no, license, 2.0::DOUBLE * len(list_intersect(g, b)) / (len(g) + len(b)) AS dice
  FROM grams, t WHERE len(b) BETWEEN len(g) * {MIN_DICE / (2 - MIN_DICE)}::DOUBLE AND len(g) * {(2 - MIN_DICE) / MIN_DICE}::DOUBLE
)
SELECT doc_id::BIGINT AS doc_id, line_no::BIGINT AS line_no, license, dice FROM scored WHERE dice >= {MIN_DICE}
QUALIFY row_number() OVER (PARTITION BY doc_id, line_no ORDER BY dice DESC, license) = 1
"""


QUERIES = {"op5_license_scan": op5_license_scan}
ORACLE = {"op5_license_scan": _oracle()}
