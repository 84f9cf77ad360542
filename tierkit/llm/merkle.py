"""Merkle manifest of a dataset: one tree per source, one tree over the sources.

1. *Leaves*: a digest per row, in Spark's own functions, numbered inside their
   source (``ranks.numbered``).  ``BLOCK`` consecutive leaves of a source are a
   superblock: a whole subtree of ``LOCAL`` levels, small enough for one task.
2. *Outward*: every superblock is reduced to its top, the tops to subroots, a
   level at a time, and the subroots likewise to the root.  A node keeps the
   run of children it was made of.
3. *Back*: from the root down, a node hands its children the siblings they need:
   those of its own run, then what it was handed itself.  What arrives at a
   superblock are the outer nodes that its leaves' proofs require.
4. *Cogroup*: leaves and required outer nodes meet by superblock in
   ``applyInPandas``, which reduces the subtree, joins its siblings with the
   outer ones, and folds each (possibly altered) leaf up to the root.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkit.llm.ranks import numbered
from tierkit.llm.scratch import keep
from tierkit.operators._names import q

FAN = 16
#: Levels of a superblock's subtree, and its leaves.
LOCAL = 2
BLOCK = FAN**LOCAL
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row's fields: each ``-`` if null, else its bytes' count, a
    colon and the value, so that no two rows spell the same."""
    spelled = []
    for c in fields:
        value = c.cast("string")
        spelled.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*spelled), 256)


def levels(n: int) -> int:
    """Levels from ``n`` nodes to one."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


def reduce(nodes: list[str], times: int) -> list[list[str]]:
    """``times`` levels above ``nodes``, these first; every ``FAN`` consecutive
    nodes, or what is left at the end, make one of the next level."""
    out = [nodes]
    for _ in range(times):
        below = out[-1]
        out.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return out


def _top(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("pos")
    n = int(rows["n"].iloc[0])
    top = reduce(rows["leaf"].tolist(), min(LOCAL, levels(n)))[-1][0]
    return pd.DataFrame({"g": [rows["g"].iloc[0]], "idx": [rows["pos"].iloc[0] // BLOCK], "n": [-(-n // BLOCK)], "digest": [top]})


def _finish(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """All rows of a superblock with proofs, and the roots that they fold to."""
    rows = rows.sort_values("pos")
    up = outer.iloc[0]
    tree = reduce(rows["leaf"].tolist(), min(LOCAL, levels(int(rows["n"].iloc[0]))))
    lefts, rights, folded = [], [], []
    for i, node in enumerate(rows["altered"].tolist()):
        left, right = [], []
        for level in tree[:-1]:
            run = i - i % FAN
            left.append("".join(level[run:i]))
            right.append("".join(level[i + 1 : run + FAN]))
            i //= FAN
        left += list(up["left"])
        right += list(up["right"])
        for before, after in zip(left, right):
            node = digest(before + node + after)
        lefts.append(left)
        rights.append(right)
        folded.append(node)
    out = rows[["id", "leaf"]].reset_index(drop=True)
    return out.assign(subroot=up["subroot"], root=up["root"], left=lefts, right=rights, folded_root=folded)


def _upward(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Levels of nodes ``(g, idx, n, digest, run)`` above the given ones, these
    first, until every group has one; ``n`` counts its group's nodes there."""
    out = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    for level in range(levels(most)):
        child = F.array_sort(F.collect_list(F.struct("idx", "digest")))
        above = out[-1].where("n > 1").groupBy("g", F.expr(f"idx div {FAN}").alias("up"), "n").agg(child.alias("c"))
        above = above.select("g", F.col("up").alias("idx"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), F.col("c.digest").alias("run"))
        above = above.withColumn("digest", F.sha2(F.array_join("run", ""), 256))
        out.append(keep(above, f"{label}-{level}"))
    return out


def _tops(tree: list[DataFrame]) -> DataFrame:
    """The last node of every group, ``(g, digest)``."""
    out = tree[0].where("n = 1").select("g", "digest")
    for level in tree[1:]:
        out = out.union(level.where("n = 1").select("g", "digest"))
    return out


def _downward(tree: list[DataFrame], given: DataFrame, label: str) -> DataFrame:
    """``(g, idx, left, right)`` and further columns of ``given`` for the lowest
    nodes of ``tree``; ``given`` has one row a group, for its last node."""
    more = [c for c in given.columns if c not in ("g", "left", "right")]
    handed = None
    for depth in range(len(tree) - 1, -1, -1):
        level = tree[depth]
        mine = level.where("n = 1").select("g", "idx").join(given, "g").select("g", "idx", "left", "right", *more)
        if handed is not None:
            above = tree[depth + 1]
            node = above.join(handed, ["g", "idx"]).select(
                "g", (F.col("idx") * FAN).alias("first"), "run", "left", "right", *more, F.posexplode("run").alias("i", "one")
            )
            mine = mine.union(
                node.select(
                    "g",
                    (F.col("first") + F.col("i")).alias("idx"),
                    F.concat(F.array(F.array_join(F.expr("slice(run, 1, i)"), "")), "left").alias("left"),
                    F.concat(F.array(F.array_join(F.expr(f"slice(run, i + 2, {FAN})"), "")), "right").alias("right"),
                    *more,
                )
            )
        handed = keep(mine, f"{label}-{depth}")
    return handed


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "source",
    altered: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``leaf``, ``subroot`` (of its
    source), ``root``, ``left`` and ``right`` (a level each, leaf first: the
    digests of the siblings before and after, joined), ``folded_root`` and
    ``verified`` (equals ``root``).

    ``altered`` gives expressions for fields as a receiver might hold them; a
    row is folded from those, with the siblings of the unaltered table.

    Null fields count as themselves, rows with a null source are a source of
    their own (the first), a null id comes first in its source.  Rows that
    repeat an id are all leaves, by digest; equal rows are leaves of their own.
    An empty table gives no row.  Other columns are ignored.
    """
    altered = dict(altered or {})
    group = q(group_col).cast("string")
    rows = docs.select(
        # A prefix keeps null apart from empty, and in front.
        F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), group)).alias("g"),
        q(id_col).alias("id"),
        leaf([q(c) for c in fields]).alias("leaf"),
        leaf([altered.get(c, q(c)) for c in fields]).alias("altered"),
    )
    placed = numbered(keep(rows, "leaves"), "g", ["id", "leaf"], "merkle")
    placed = placed.withColumn("idx", F.expr(f"pos div {BLOCK}"))
    blocks = placed.select("g", "idx", "pos", "n", "leaf").groupBy("g", "idx")
    blocks = keep(blocks.applyInPandas(_top, "g string, idx long, n long, digest string"), "blocks")
    own = _upward(blocks, "own")
    subroots = numbered(_tops(own).withColumn("all", F.lit(0)), "all", ["g"], "subroots")
    subroots = keep(subroots.select(F.col("all").alias("g"), F.col("pos").alias("idx"), "n", "digest", F.col("g").alias("source")), "sources")
    whole = _upward(subroots.drop("source"), "whole")
    nothing = F.array().cast("array<string>")
    given = _tops(whole).select("g", nothing.alias("left"), nothing.alias("right"), F.col("digest").alias("root"))
    by_source = _downward(whole, given, "whole-proof").join(subroots, ["g", "idx"])
    by_source = by_source.select(F.col("source").alias("g"), "left", "right", "root", F.col("digest").alias("subroot"))
    outer = _downward(own, by_source, "own-proof")
    kind = docs.schema[id_col].dataType.simpleString()
    leaves = placed.select("g", "idx", "pos", "n", "id", "leaf", "altered").groupBy("g", "idx")
    done = leaves.cogroup(outer.groupBy("g", "idx")).applyInPandas(
        _finish, f"id {kind}, leaf string, subroot string, root string, left array<string>, right array<string>, folded_root string"
    )
    return done.withColumnRenamed("id", id_col).withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(left: Column, right: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), ""), 256)
