from __future__ import annotations

import random
import re

import pytest

from tierkit.llm import minhash
from tierkit.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingle_set(text):
    words = WORD.findall((text or "").translate(FOLD))
    if not words:
        return frozenset()
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1 :]:
            both = len(a & b)
            if both and 100 * both >= 75 * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}


def check(rows, df):
    want = brute_components(rows)
    got = {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}
    assert {i: r["component_id"] for i, r in got.items()} == want
    sizes = {i: len(shingle_set(t)) for i, t in rows}
    assert all(r["n_shingles"] == sizes[i] and r["kept"] == (want[i] == i) for i, r in got.items())


def test_whole_table_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(rows, minhash.near_duplicates(docs))


def test_group_of_near_copies_that_do_not_all_link(documents):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.choice([1, 2, 4, 6])):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    check(rows, minhash.near_duplicates(documents(rows)))


def test_blocks_of_one_bucket(documents, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 6000)  # several blocks per bucket
    rng = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.sample(range(100), rng.choice([2, 5, 7])):
            words[at] = f"x{i}-{at}"
        rows.append((i, " ".join(words)))
    check(rows, minhash.near_duplicates(documents(rows)))


def test_edges(documents):
    words = " ".join(f"v{i}" for i in range(40))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, words), (8, words),
        (9, words.upper() + "\n"), (None, words), (None, "only here is no id"), (11, "x" * 200_000 + " " + words),
        (12, "café a b c d e"), (13, "CAFÉ a b c d e"),
    ]
    df = minhash.near_duplicates(documents(rows))
    check(rows, df)
    none = {r["n_shingles"]: (r["component_id"], r["kept"]) for r in df.where("doc_id is null").collect()}
    assert none == {36: (7, False), 1: (None, True)}


def test_repeated_rows_and_ids(documents):
    words = " ".join(f"v{i}" for i in range(40))
    other = " ".join(f"u{i}" for i in range(40))
    rows = [(1, words), (1, words), (2, words), (2, other), (3, other)]
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(documents(rows)).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False)]
    kept = minhash.keep_first(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, words), (2, other)]


def test_empty_table(documents):
    assert minhash.near_duplicates(documents([(1, "a")]).where("false")).count() == 0


def test_posterior_prunes_only_the_unlikely():
    for n, least in minhash.least_matches(0.75):
        assert minhash.posterior(least, n, 0.75) >= minhash.MISS > minhash.posterior(least - 1, n, 0.75)


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {n: find(n) for n in parent}
