"""License scans against a plain search, and notices with changes."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tierkit.llm import licenses
from tierkit.llm.queries import op11_license_scan

SMALL = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    """(n_words, n_base, first, last, labels) of the phrases, by looking everywhere."""
    w, places, labels = words(text), [], set()
    for label, phrase in licenses.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_query_has_all_places_of_phrases(spark):
    want = {r["doc_id"]: base(r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = op11_license_scan(spark, SMALL)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = got.collect()
    assert {r[0]: tuple(r)[1:6] for r in rows} == want and len(rows) == len(want)
    for r in rows:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert (r["score"] == 0) == (r["labels"] == "")


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0] + [0] * len(b) if not b else _step(row, x, b)
    return row[-1]


def _step(row, x, b):
    out = [0]
    for j, y in enumerate(b):
        out.append(row[j] + 1 if x == y else max(row[j + 1], out[-1]))
    return out


def test_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.choice([b"x", b"y", b"z"]) for _ in range(rng.randint(1, 90))] for _ in range(2))
        assert licenses.common(a, b) == subsequence(a, b)


@pytest.fixture(scope="module")
def hurt():
    """Texts with a notice each, whole or with words dropped, put in or changed."""
    rng, out = random.Random(11), []
    for n, (label, text) in enumerate(licenses.NOTICES):
        for change in (0.0, 0.04, 0.08):
            w = []
            for x in text.split():
                lot = rng.random()
                if lot >= change / 2:
                    w.append(x)
                if lot < change:
                    w.append(f"new{rng.randint(0, 99)}")
            filler = " ".join(f"w{rng.randint(0, 500)}" for _ in range(rng.randint(0, 300)))
            out.append((len(out), f"{filler}\n{' '.join(w)}\n{filler}", label))
    return out


def test_notices_with_changes_are_found_and_others_are_not(spark, hurt):
    rng = random.Random(2)
    pool = [w for _, text in licenses.NOTICES for w in text.split()]
    clean = [(1000 + i, " ".join(rng.choice(pool) for _ in range(400))) for i in range(20)]
    clean += [(2000 + i, " ".join(text.split()[: len(text.split()) // 3])) for i, (_, text) in enumerate(licenses.NOTICES)]
    df = spark.createDataFrame([(i, t) for i, t, _ in hurt] + clean, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    for i, text, label in hurt:
        assert got[i]["labels"] == label or label in got[i]["labels"].split(","), (i, label)
        assert base(text)[1:] == tuple(got[i])[2:6]
        assert got[i]["score"] >= licenses.SHARE
    for i, text in clean:
        assert got[i]["labels"] == got[i]["base_labels"] == base(text)[4]
    spans = licenses.find_templates(df, [licenses.NOTICES[0]]).where("id < 3").collect()
    whole = len(licenses.words_of(licenses.NOTICES[0].text))
    assert {s["id"]: s["matched"] for s in spans}[0] == whole


def test_nulls_repeats_long_texts_and_clashing_names(spark):
    texts = [
        None, "", " ", "MIT License", "mit-license", "mit license mit license", "amit license", "mit licenses", "the MIT  LICENSE.",
        "general public license general public license general public general", "general\npublic", "license", "éMIT license", "mit licenseé",
        "KMIT license mit license", "x " * 40_000 + "mit license " + "y " * 40_000 + "apache license", "a" * 3_000_000 + " mit license",
        "mit license " * 20_000, ("word, " * 300_000) + "general public license",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "MIT License"), (3, "MIT License"), (3, "nothing"), (None, "apache license"), (None, "apache license")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for c in ("id", "hash", "spans", "template", "n_words", "a.b"):
        df = df.withColumn(c, F.lit("z"))
    got = sorted((tuple(r)[:6] for r in licenses.scan(df).collect()), key=repr)
    assert got == sorted(((i, *base(t)) for i, t in rows), key=repr)
    assert licenses.scan(df.where("false")).count() == 0


def test_a_template_needs_two_words():
    with pytest.raises(ValueError):
        licenses._sought([licenses.Template("x", "single")])
