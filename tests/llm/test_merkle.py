"""Merkle manifest against a plain version, tree by tree."""

from __future__ import annotations

import hashlib
import zlib

import pandas as pd
from pyspark.sql import functions as F

from tierkit.llm import merkle
from tierkit.llm.queries import op13_merkle_manifest

SMALL = "/root/testdata/sf0.001"


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def spelled(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grown(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def brute(rows, lowered):
    """Of rows (doc_id, source, lang, n_chars, text): sorted result tuples."""
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, spelled(r))):
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: grown([spelled(r) for r in groups[s]]) for s in names}
    top = grown([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            node, siblings = spelled((*r[:4], lowered(r))), []
            for tree, j in ((trees[s], i), (top, k)):
                for level in tree[:-1]:
                    run = j - j % 16
                    left, right = "".join(level[run:j]), "".join(level[j + 1 : run + 16])
                    siblings.append(left + right)
                    node = H(left + node + right)
                    j //= 16
            out.append((r[0], spelled(r), trees[s][-1][0], top[-1][0], H("".join(siblings)), node, node == top[-1][0]))
    return sorted(out, key=repr)


def lowered(r):
    hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if hit and r[4] is not None else r[4]


def test_query_equals_the_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select(*merkle.FIELDS).collect()]
    got = op13_merkle_manifest(spark, SMALL)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, lowered)


def test_depths_nulls_repeats_and_clashing_names(spark):
    big = [(i, "big", "en", i, f"Text {i}") for i in range(16**3 + 1)]  # a superblock and one leaf more
    full = [(i, "full", "en", i, f"Text {i}") for i in range(17)]
    odd = [(1, None, None, None, None), (None, None, "", 0, ""), (None, "", "x", 1, "A"), (7, "lone", "ü", 3, "ÀB"), (7, "twice", "e", 1, "A"),
           (7, "twice", "e", 1, "A"), (7, "twice", "e", 1, "B"), (8, "long", "e", 1, "Word " * 400_000)]
    many = [(5, f"s{i}", "e", 1, "Q") for i in range(40)]
    rows = big + full + odd + many
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    for c in ("g", "id", "idx", "pos", "n", "leaf", "root", "a.b"):
        df = df.withColumn(c, F.lit(3))
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.manifest(df, altered={"text": F.when(hit, low).otherwise(F.col("text"))})
    got = got.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("left"), F.col("right")), "folded_root", "verified")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, lowered)


def test_empty_table_and_single_row(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.manifest(spark.createDataFrame([], schema)).collect() == []
    (row,) = merkle.manifest(spark.createDataFrame([(1, "s", "en", 2, "ab")], schema)).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"] and row["left"] == []


def test_a_task_holds_few_proofs_at_a_time():
    """What one group hands back: its leaves with all digests of their proofs."""
    n = merkle.BLOCK
    rows = pd.DataFrame({"pos": range(n), "n": [16**5] * n, "id": range(n), "leaf": [H(str(i)) for i in range(n)], "altered": [H(str(i)) for i in range(n)]})
    outer = pd.DataFrame({"left": [["x" * 960] * 3], "right": [["y" * 960] * 3], "subroot": ["s"], "root": ["r"]})
    done = merkle._finish(rows, outer)
    assert len(done) == n
    assert sum(len(s) for c in ("left", "right") for of in done[c] for s in of) < 4 << 20
