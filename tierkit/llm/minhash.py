"""Near-duplicate documents: MinHash bands, sequential Bayesian verification.

1. *Sketch* (map side): the distinct five-word shingles of each whole text, a
   digest of that set, and a MinHash signature.
2. Documents with the same set are one node, named by their smallest id.  A
   group of copies of any size is collapsed by a partial aggregate.
3. Nodes that share a band of the signature are candidates.  A bucket is never
   expanded into rows of pairs.  First every member is compared with the
   bucket's smallest, its hub, and links merge components, which settles most
   groups of copies.  Buckets that still span components form families (nodes
   connected over such buckets).  In a family, the nodes outside its largest
   component meet all its nodes in blocks of bounded bytes; a task compares the
   two blocks in arrays and emits only links that merge.  So every pair of a
   bucket that could join two components is compared, and a node's signature
   and set are shipped once per block, not once per band.
4. A candidate's signatures are compared batch by batch.  With ``m`` of ``n``
   values equal, the similarity's posterior (uniform prior) gives the chance
   that it reaches the threshold; below ``miss`` the pair is pruned.
5. Survivors are verified on their full shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.components import components
from tierkit.llm.scratch import drop, keep
from tierkit.llm.words import chunks, shingles, splitmix
from tierkit.operators._names import q

SHINGLE_WORDS = 5
BANDS, BAND_ROWS = 32, 4
HASHES = BANDS * BAND_ROWS
BATCH = 32
MISS = 1e-6
_BLOCK = 1024
BLOCK_BYTES = 16 << 20

_RANDOM = (splitmix(7, 2 * HASHES) >> np.uint64(32)).astype(np.uint32)
_MULTIPLY, _ADD = (_RANDOM[:HASHES] | np.uint32(1))[:, None], _RANDOM[HASHES:, None]


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """The set's least value under each of the ``HASHES`` permutations."""
    x = (shingle_set >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), _BLOCK):
        block = _MULTIPLY * x[None, i : i + _BLOCK]
        block += _ADD
        np.minimum(out, block.min(axis=1), out=out)
    return out


def posterior(matches: int, compared: int, threshold: float) -> float:
    """Chance that the similarity is at least ``threshold``, uniform prior."""
    n = compared + 1
    return sum(comb(n, i) * threshold**i * (1 - threshold) ** (n - i) for i in range(matches + 1))


def least_matches(threshold: float, batch: int = BATCH, miss: float = MISS) -> list[tuple[int, int]]:
    """(values compared, fewest matches that stay a candidate) per batch."""
    out = []
    for n in range(batch, HASHES + 1, batch):
        out.append((n, next((m for m in range(n + 1) if posterior(m, n, threshold) >= miss), n + 1)))
    return out


def _sketcher(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for chunk in chunks(batch.column(1)):
                for s, e in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist()):
                    found = shingles(chunk.hashes[s:e], k)
                    sizes.append(len(found))
                    if len(found):
                        digests.append(hashlib.blake2b(found.astype("<u8").tobytes(), digest_size=16).digest())
                        signatures.append(signature(found).astype("<u4").tobytes())
                    else:
                        digests.append(None)
                        signatures.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                names=["id", "text_hash", "n_shingles", "digest", "signature"],
            )

    return run


def _setter(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for chunk in chunks(batch.column(1)):
                for s, e in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist()):
                    sets.append(shingles(chunk.hashes[s:e], k).astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return run


def _survivors(threshold: float, batch_size: int, miss: float):
    steps = least_matches(threshold, batch_size, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype="<u4").reshape(-1, HASHES) for i in (2, 3)
            )
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64)
            done = 0
            for n, least in steps:
                matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
                alive = alive[matches[alive] >= least]
                done = n
                if not len(alive):
                    break
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(alive)) for i in (0, 1)], names=["a", "b"])

    return run


def _similar(x: np.ndarray, y: np.ndarray, part: int, whole: int) -> bool:
    """The exact test on two sorted sets."""
    if whole * min(len(x), len(y)) < part * max(len(x), len(y)):
        return False
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return whole * both >= part * (len(x) + len(y) - both)


def _verifier(part: int, whole: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                i
                for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3)))
                if _similar(*(np.frombuffer(v.as_buffer(), dtype="<u8") for v in (x, y)), part, whole)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(pa.array(good, pa.int64())) for i in (0, 1)], names=["a", "b"]
            )

    return run


def _find(parent: dict[int, int], x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = x = parent[parent[x]]
    return x


def _block_linker(part: int, whole: int, batch_size: int, miss: float):
    """Links between two blocks of one family that merge components."""
    steps = least_matches(part / whole, batch_size, miss)

    def read(table: pa.Table) -> tuple[list[int], list[int], np.ndarray, list[np.ndarray]]:
        signatures = np.frombuffer(b"".join(table["signature"].to_pylist()), "<u4").reshape(-1, HASHES)
        sets = [np.frombuffer(x, "<u8") for x in table["shingles"].to_pylist()]
        return table["node"].to_pylist(), table["component"].to_pylist(), signatures, sets

    def candidates(left: np.ndarray, right: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, least = steps[0]
        matches = (left[:, None, :n] == right[None, :, :n]).sum(axis=2)
        i, j = np.nonzero((matches >= least) & apart)
        matches, done = matches[i, j], n
        for n, least in steps[1:]:
            matches = matches + (left[i, done:n] == right[j, done:n]).sum(axis=1)
            alive = matches >= least
            i, j, matches, done = i[alive], j[alive], matches[alive], n
        return i, j

    def run(members: pa.Table, outside: pa.Table) -> pa.Table:
        links = []
        if len(members) and len(outside):
            nodes, of, right, sets = read(members)
            others, other_of, left, other_sets = read(outside)
            parent: dict[int, int] = {}
            width = max(1, (1 << 24) // (len(nodes) * batch_size))
            for at in range(0, len(others), width):
                rows = slice(at, at + width)
                apart = np.array(other_of[rows])[:, None] != np.array(of)[None, :]
                for i, j in zip(*(x.tolist() for x in candidates(left[rows], right, apart))):
                    x, y = _find(parent, other_of[at + i]), _find(parent, of[j])
                    if x != y and _similar(other_sets[at + i], sets[j], part, whole):
                        parent[max(x, y)] = min(x, y)
                        links.append((others[at + i], nodes[j]))
        return pa.table(
            {"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())}
        )

    return run


def _hold(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Pairs with one column of ``table`` for either side."""
    for side in ("a", "b"):
        other = table.select(F.col("node").alias(side), F.col(column).alias(f"{column}_{side}"))
        pairs = pairs.join(other, side)
    return pairs.select("a", "b", f"{column}_a", f"{column}_b")


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, component) with the components of linked nodes joined."""
    named = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    roots = components(links.join(named, "a").join(named.toDF("b", "cb"), "b").select("ca", "cb")).toDF("component", "root")
    merged = labels.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return keep(merged, "labels")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = SHINGLE_WORDS,
    part: int = 75,
    whole: int = 100,
    batch_size: int = BATCH,
    miss: float = MISS,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles``, ``component_id``
    (the smallest id reachable over links, itself included), ``kept`` and
    ``text_hash`` (xxhash64 of the text).

    Two documents are linked if ``whole * |A and B| >= part * |A or B|`` for
    their sets of distinct ``k``-word shingles (lower-cased ASCII).  At the
    threshold itself a pair shares no band with chance 5e-6, and ``miss``
    bounds what a pruning step may lose.

    Null or empty text, or text without words: an empty set, linked with
    nothing, its own component.  Fewer than ``k`` words: the whole sequence is
    one shingle.  A row with a null id takes the component of an equal
    document that has an id, else null, and is kept only then.  Rows that
    repeat an id are judged by their own text.  Other columns are ignored.
    """
    text = q(text_col).cast("string")
    rows = docs.select(q(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    sketch = keep(
        rows.mapInArrow(_sketcher(k), "id long, text_hash long, n_shingles long, digest binary, signature binary"), "sketch"
    )
    nodes = keep(
        sketch.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("id").alias("node"), F.first("signature").alias("signature"))
        .where("node is not null"),
        "nodes",
    )
    keys = [
        F.xxhash64(F.lit(i), F.substring("signature", 4 * BAND_ROWS * i + 1, 4 * BAND_ROWS)) for i in range(BANDS)
    ]
    buckets = nodes.select("node", F.explode(F.array(*keys)).alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last")
    live = keep(buckets.join(shared.select("bucket", "hub"), "bucket"), "buckets")
    labels = keep(live.select("node", F.col("node").alias("component")).distinct(), "labels")
    wanted = labels.select(F.col("node").alias("id"))
    sets = rows.join(wanted, "id", "left_semi").select("id", "text").mapInArrow(_setter(k), "node long, shingles binary")
    sets = keep(sets.join(nodes.select("node", "signature"), "node"), "sets")

    pairs = live.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    close = _hold(pairs, sets, "signature").mapInArrow(_survivors(part / whole, batch_size, miss), "a long, b long")
    links = keep(_hold(close, sets, "shingles").mapInArrow(_verifier(part, whole), "a long, b long"), "links")
    labels = _merge(labels, links)

    of_hub = labels.select(F.col("node").alias("hub"), F.col("component").alias("major"))
    members = live.where("node <> hub").join(labels, "node").join(of_hub, "hub")
    span = members.groupBy("bucket").agg(
        F.min("node").alias("least"), F.max((F.col("component") != F.col("major")).cast("int")).alias("open")
    )
    members = members.select("bucket", "node").join(span.where("open = 1"), "bucket").select("node", "least").distinct()
    family = components(members).toDF("node", "family")
    nodes_in = keep(family.join(labels, "node"), "families")
    shares = nodes_in.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n"))
    major = shares.groupBy("family").agg(F.max_by("component", F.struct("n", "component")).alias("major"))
    sized = sets.select("node", (F.octet_length("shingles") + 4 * HASHES + 64).alias("bytes"))
    placed = nodes_in.join(sized, "node").join(major, "family").withColumn("outside", F.col("component") != F.col("major"))
    sizes = (
        placed.groupBy("family")
        .agg(
            F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("v_blocks"),
            F.ceil(F.sum(F.when(F.col("outside"), F.col("bytes"))) / BLOCK_BYTES).cast("int").alias("w_blocks"),
        )
        .where("w_blocks > 0")
    )
    open_ = placed.select("family", "node", "component", "outside").join(sizes, "family").join(sets, "node")
    block = F.xxhash64("node")
    every = open_.withColumn("v", F.pmod(block, F.col("v_blocks")).cast("int")).withColumn(
        "w", F.explode(F.sequence(F.lit(0), F.col("w_blocks") - 1))
    )
    apart = open_.where("outside").withColumn("w", F.pmod(block, F.col("w_blocks")).cast("int")).withColumn(
        "v", F.explode(F.sequence(F.lit(0), F.col("v_blocks") - 1))
    )
    columns = ["family", "v", "w", "node", "component", "signature", "shingles"]
    linker = _block_linker(part, whole, batch_size, miss)
    links = (
        every.select(*columns)
        .groupBy("family", "v", "w")
        .cogroup(apart.select(*[F.col(c).alias(f"o_{c}") for c in columns]).toDF(*columns).groupBy("family", "v", "w"))
        .applyInArrow(linker, "a long, b long")
    )
    labels = _merge(labels, keep(links, "links"))
    drop(live, sets)

    found = (
        sketch.select("id", "text_hash", "n_shingles", "digest")
        .join(nodes.select("digest", "node"), "digest", "left")
        .join(labels, "node", "left")
    )
    component = F.coalesce("component", "node", "id")
    return found.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
        "text_hash",
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs``, one per group of near duplicates: the smallest id's.

    Decisions go back to rows by id and text, so rows that repeat an id with
    another text have their own, and of rows that repeat both one stays.  Rows
    without an id stay unless an equal document has one.  Columns pass through
    whatever their names."""
    judged = near_duplicates(docs, id_col, text_col, **options).where("kept").select(F.col(id_col).alias("i"), F.col("text_hash").alias("t"))
    text = q(text_col).cast("string")
    rows = docs.select(F.struct("*").alias("row"), q(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"))
    kept = rows.join(judged, F.expr("text_hash = t and id <=> i"), "left_semi").dropDuplicates(["text_hash", "id"])
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
