from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from framewright.llm import simhash
from framewright.llm.components import components
from tests.llm.data import SCHEMA, documents, folder


def _fingerprint(text: str | None) -> int:
    """As plainly as the definition."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(n: int, linked) -> list[int]:
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_fingerprint_is_the_definition():
    for row in documents(3):
        assert simhash.fingerprint(row[1]) == _fingerprint(row[1])
    assert simhash.fingerprint("A  b C\x1cd") == _fingerprint("A  b C\x1cd")


def test_query_is_brute_force(spark, tmp_path):
    rows = documents(1, 120)
    got = simhash.op4_simhash(spark, folder(spark, tmp_path, rows)).collect()
    prints = sorted({_fingerprint(r[1]) for r in rows})
    roots = _roots(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 4])
    ids: dict[int, int] = {}
    for r in rows:
        k = roots[prints.index(_fingerprint(r[1]))]
        if r[0] is not None:
            ids[k] = min(ids.get(k, r[0]), r[0])
    want = [(r[0], format(_fingerprint(r[1]), "016x"), ids.get(roots[prints.index(_fingerprint(r[1]))])) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("radius,words", [(0, 1), (1, 1), (3, 1), (4, 1), (7, 1), (8, 1), (12, 1), (15, 1), (16, 1), (9, 2), (31, 4), (64, 4), (100, 8)])
def test_bit_planes_link_what_distances_link(radius, words):
    rng = np.random.default_rng(radius)
    for _ in range(8):
        n = int(rng.integers(1, 300))
        prints = rng.integers(0, 1 << 63, (12, words), dtype=np.uint64)[rng.integers(0, 12, n)]
        for _ in range(int(rng.integers(0, 14))):
            for _ in range(words):
                prints = prints.copy()
                prints[np.arange(n), rng.integers(0, words, n)] ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        group = np.sort(rng.integers(0, 5, n))
        root = simhash.link_groups(group, prints, radius)
        near = (np.bitwise_count(prints[:, None] ^ prints[None, :]).sum(axis=2) <= radius) & (group[:, None] == group[None, :])
        pairs = [(i, j) for i, j in zip(*map(list, np.nonzero(near)), strict=True) if i < j]
        assert root.tolist() == _roots(n, pairs)
        odd = lambda a, b: (a + b) % 3 > 0
        before = np.where(np.arange(n) % 7 == 3, np.concatenate(([0], np.nonzero(np.diff(group))[0] + 1))[np.unique(group, return_inverse=True)[1]], np.arange(n))
        root = simhash.link_groups(group, prints, radius, odd, before)
        assert root.tolist() == _roots(n, [p for p in pairs if odd(*p)] + list(enumerate(before.tolist())))


def test_wide_fingerprints_are_the_definition():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 254, 255, 256, 70_000):
        hashes = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n).astype(np.uint64)
        for k, word in enumerate(simhash.fingerprint_of(hashes, 3).tolist()):
            mixed = simhash._mixed(hashes, k)
            assert word == sum(1 << b for b in range(64) if 2 * int((mixed >> np.uint64(b) & np.uint64(1)).sum()) > n)


@pytest.mark.parametrize("radius", [4, 8])
@pytest.mark.parametrize("n", [1, 1000, 10**7, 10**11])
def test_masks_leave_no_pair_out(n, radius):
    rng, masks = random.Random(n), simhash.masks(n, radius)
    for _ in range(300):
        diff = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(diff & m == 0 for m in masks)


def test_split_groups_lose_no_link(spark):
    """More fingerprints in a group than a task takes: parts meet in pairs."""
    rng = np.random.default_rng(9)
    prints = np.unique(np.uint64(77) ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)))
    df = spark.createDataFrame([(int(p), int(p)) for p in prints.view(np.int64)], "node long, print long")
    found = components(simhash.links(df, len(prints), group_rows=16)).collect()
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    want = _roots(len(prints), [(i, j) for i, j in zip(*map(list, np.nonzero(near)), strict=True) if i < j])
    got = {r["node"]: r["root"] for r in found}
    signed = prints.view(np.int64).tolist()
    for i in range(len(signed)):
        for j in range(i):
            assert (want[i] == want[j]) == (got.get(signed[i], signed[i]) == got.get(signed[j], signed[j]))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    order = rng.sample(range(500), 500)
    pairs = [(order[i], order[i + 1]) for i in range(0, 200)] + [(order[300], order[i]) for i in range(301, 400)] + [(7, 7)]
    rng.shuffle(pairs)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = _roots(500, pairs)
    assert got == {i: want[i] for i in {x for p in pairs for x in p if p[0] != p[1]}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
