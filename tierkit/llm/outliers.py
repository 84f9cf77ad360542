"""Quality rules: robust multivariate outliers per language and source.

Fixed base rules reject very short and very repetitive texts.  Of the rest,
each language and source gets a minimum-covariance-determinant estimate of
centre and scatter of a transformed statistic vector, and a document is
rejected when its squared Mahalanobis distance passes a chi-square quantile.

The estimate covers all rows.  A concentration step is two aggregates over the
statistics table: a histogram of distances gives, per group, the distance that
holds the chosen share of rows, and the moments of those rows give the next
centre and scatter.  Steps start from the plain moments and from medians, and
the start with the smaller determinant wins.  Only partial sums are shuffled,
so a source with a third of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.scratch import keep
from tierkit.llm.words import chunks, ranges, utf8, windows
from tierkit.operators._names import q
from tierkit.operators.merge import broadcast_limit

SHARE = 0.75
STEPS = 6
MIN_ROWS = 100
CONFIDENCE = 1 - 1e-6
MIN_WORDS = 50
#: Least standard deviation of each coordinate: below it, differences are noise.
#: Most sound texts repeat nothing, so a plain estimate of the last two would
#: reject a text for one repeated line.
FLOORS = (0.25, 0.04, 0.05, 0.15, 0.15)
DIMS = len(FLOORS)
_PAIRS = list(combinations_with_replacement(range(DIMS), 2))
_BINS = 64  # per factor e of squared distance

_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_LETTER_START = np.array([(b & 0xC0) != 0x80 and b not in (9, 10, 11, 12, 13, 32) for b in range(256)], np.uint8)
STATS = "row long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long"


def _chi2_cdf(x: float, dof: int) -> float:
    a, z = dof / 2, x / 2
    if z <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= z / n
        total += term
    return total * exp(-z + a * log(z) - lgamma(a))


def chi2_quantile(p: float, dof: int) -> float:
    low, high = 0.0, 1e3
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, dof) < p else (low, mid)
    return (low + high) / 2


def _per_doc(marks: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marked bytes of each document, about a megabyte of text at a time."""
    out = [np.empty(0, np.int64)]
    for lo, hi in ranges(offsets):
        a, b = int(offsets[lo]), int(offsets[hi])
        upto = np.zeros(b - a + 1, np.int64)
        np.cumsum(marks[data[a:b]], out=upto[1:])
        out.append(np.diff(upto[offsets[lo : hi + 1] - a]))
    return np.concatenate(out)


def _repeated(windows_of_doc: np.ndarray, n_words: int) -> int:
    """Words inside windows that occur at least twice in the document."""
    order = np.argsort(windows_of_doc, kind="stable")
    w = windows_of_doc[order]
    same = w[1:] == w[:-1]
    if not same.any():
        return 0
    twice = np.append(same, False) | np.append(False, same)
    mark = np.zeros(n_words + 1, np.int64)
    at = order[twice]
    np.add.at(mark, at, 1)
    np.add.at(mark, at + 3, -1)
    return int((np.cumsum(mark[:-1]) > 0).sum())


def _dup_lines(text: bytes) -> tuple[int, int]:
    """(lines with a word that equal an earlier one, lines with a word)."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines)), len(lines)


def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        chars, symbols = (_per_doc(marks, data, offsets) for marks in (_LETTER_START, _SYMBOL))
        lines = [_dup_lines(data[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        n_words, repeats = [], []
        for chunk in chunks(batch.column(1), fold=False):
            threes = windows(chunk.hashes, 3)
            for s, e in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist()):
                n_words.append(e - s)
                repeats.append(_repeated(threes[s : max(s, e - 2)], e - s))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *[pa.array(x, pa.int64()) for x in (n_words, chars, symbols, [x for x, _ in lines], [x for _, x in lines], repeats)],
            ],
            names=["row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"],
        )


def _vector() -> list[Column]:
    """Transformed statistics: log length, log mean word length, square root of
    the share of symbols, and the shares of repeated lines and words."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p("n_words"),
        F.log(F.greatest(F.col("word_chars") / words, F.lit(0.5))),
        F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        F.col("n_repeat_words") / words,
    ]


def _distance() -> Column:
    """Squared Mahalanobis distance of x0.. from ``mean`` under ``inverse``."""
    off = [F.col(f"x{i}") - F.col("mean")[i] for i in range(DIMS)]
    return sum(
        ((1 if i == j else 2) * F.col("inverse")[i * DIMS + j] * off[i] * off[j] for i, j in _PAIRS), F.lit(0.0)
    )


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(f"x{i}") for i in range(DIMS)]).alias("first"),
        F.array(*[F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in _PAIRS]).alias("second"),
    )


def _estimator(factor: float):
    """Moments to centre, inverse scatter and log determinant, group by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            means, inverses, dets = [], [], []
            for n, first, second in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                mean = np.array(first) / n
                scatter = np.zeros((DIMS, DIMS))
                for (i, j), s in zip(_PAIRS, second):
                    scatter[i, j] = scatter[j, i] = s / n - mean[i] * mean[j]
                scatter = scatter * factor
                # A coordinate that hardly varies keeps its floor of variance.
                scatter[np.diag_indices(DIMS)] = np.maximum(np.diag(scatter), np.square(FLOORS)) + 1e-9
                deviation = np.sqrt(np.diag(scatter))
                values, vectors = np.linalg.eigh(scatter / np.outer(deviation, deviation))
                values = np.maximum(values, 0.05)
                inverse = (vectors / values) @ vectors.T / np.outer(deviation, deviation)
                means.append(mean.tolist())
                inverses.append(inverse.ravel().tolist())
                dets.append(float(np.log(values).sum() + 2 * np.log(deviation).sum()))
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(means, kind), pa.array(inverses, kind), pa.array(dets, pa.float64())],
                names=["group", "start", "mean", "inverse", "det"],
            )

    return run


_ESTIMATE = "group string, start int, mean array<double>, inverse array<double>, det double"


def _small(df: DataFrame, rows: int, width: int) -> DataFrame:
    """Broadcast a table whose measured rows fit the session's bound."""
    return F.broadcast(df) if rows * width <= broadcast_limit(df.sparkSession) else df


def _estimates(rows: DataFrame, share: float, steps: int) -> DataFrame:
    """``(group, mean, inverse)`` of every group in ``rows`` (group, x0..)."""
    columns = [f"x{i}" for i in range(DIMS)]
    factor = share / _chi2_cdf(chi2_quantile(share, DIMS), DIMS + 2)
    plain = _moments(rows.withColumn("start", F.lit(0)), ["group", "start"])
    now = keep(plain.mapInArrow(_estimator(1.0), _ESTIMATE), "estimate")
    n_groups = now.count()
    identity = F.array(*[F.lit(1 / FLOORS[i] ** 2 if i == j else 0.0) for i in range(DIMS) for j in range(DIMS)])
    medians = rows.groupBy("group").agg(F.array(*[F.percentile_approx(c, 0.5, 1000) for c in columns]).alias("mean"))
    medians = medians.select("group", F.lit(1).alias("start"), "mean", identity.alias("inverse"), F.lit(1e9).alias("det"))
    now = now.union(medians)
    per_group = Window.partitionBy("group", "start")
    for _ in range(steps):
        near = rows.join(_small(now, 2 * n_groups, 640), "group").withColumn(
            "bin", F.floor(F.log(F.greatest(_distance(), F.lit(1e-6))) * _BINS).cast("int")
        )
        bins = near.groupBy("group", "start", "bin").agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(per_group.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        total = F.sum("n").over(per_group)
        cut = keep(
            bins.select("group", "start", "bin", upto.alias("upto"), total.alias("total"))
            .where(F.col("upto") >= F.col("total") * share)
            .groupBy("group", "start")
            .agg(F.min("bin").alias("cut")),
            "cut",
        )
        inside = near.join(_small(cut, 2 * n_groups, 128), ["group", "start"]).where("bin <= cut")
        now = keep(_moments(inside, ["group", "start"]).mapInArrow(_estimator(factor), _ESTIMATE), "estimate")
    best = now.groupBy("group").agg(F.min_by(F.struct("mean", "inverse"), F.struct("det", "start")).alias("b"))
    return keep(best.select("group", "b.mean", "b.inverse"), "estimate")


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    share: float = SHARE,
    steps: int = STEPS,
    min_rows: int = MIN_ROWS,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``distance`` (squared, null if ``base_failed``) and ``kept``.

    Null text has no words and fails the base rules, as empty text does.  Null
    language or source is a value of its own.  A language and source with
    fewer than ``min_rows`` sound documents joins the rest group of its
    language, and that, if still too small, the rest group of all; a rest
    group too small for an estimate keeps its documents.  Ties and repeated
    rows are judged alike.  Other columns are ignored.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        q(text_col).cast("string").alias("text"),
        q(id_col).alias("id"),
        q(lang_col).cast("string").alias("lang"),
        q(source_col).cast("string").alias("source"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    stats = keep(
        rows.mapInArrow(_carry, f"{STATS}, id {kind}, lang string, source string").withColumns(
            {
                "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
                **{f"x{i}": x for i, x in enumerate(_vector())},
            }
        ),
        "stats",
    )
    name = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in ("lang", "source")]
    own, language = F.to_json(F.array(*name)), F.to_json(F.array(name[0]))
    sound = stats.where("not base_failed").withColumns({"own": own, "language": language})
    counts = sound.groupBy("own", "language").agg(F.count(F.lit(1)).alias("n"))
    rest = F.sum(F.when(F.col("n") < min_rows, F.col("n"))).over(Window.partitionBy("language"))
    group = (
        F.when(F.col("n") >= min_rows, F.col("own")).when(F.col("rest") >= min_rows, F.col("language")).otherwise("[]")
    )
    named = keep(counts.withColumn("rest", rest).select("own", group.alias("group")), "groups")
    n_groups = named.count()
    grouped = sound.join(_small(named, n_groups, 256), "own")
    x = [f"x{i}" for i in range(DIMS)]
    sizes = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows).select("group")
    told = grouped.select("group", *x).join(_small(sizes, n_groups, 128), "group", "left_semi")
    found = _estimates(told, share, steps)
    of = stats.withColumn("own", F.when(~F.col("base_failed"), own)).join(_small(named, n_groups, 256), "own", "left")
    judged = of.join(_small(found, n_groups, 640), "group", "left")
    far = F.col("distance") > chi2_quantile(confidence, DIMS)
    return judged.withColumn("distance", F.when(F.col("mean").isNotNull(), _distance())).select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "distance",
        (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"),
    )


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for done in statistics([batch]):
            rest = [batch.column(i) for i in (2, 3, 4)]
            yield pa.RecordBatch.from_arrays([*done.columns, *rest], names=[*done.schema.names, "id", "lang", "source"])
