"""Conversation structure repair: the cheapest edits that give roles in turn.

1. *Faults* are found where rows lie: rows are dealt by ranges of conversation
   and turn, each gets its first fault, and up to ``BLOCK`` consecutive rows of
   a conversation become one block of letters, a letter a row.
2. *Blocks*: for every state in which a block can be entered, a dynamic programme
   over its rows keeps for each state the cheapest edits, of equal ones the
   ASCII-least.  Edit strings are ``trails.Trails``: linked nodes that share
   their beginnings, with ancestors and rolling hashes, compared by their
   longest common prefix.
3. *Conversations*: the same programme over blocks.  A block's letter is the
   rank of its exit among the exits from one entry, so a comparison ends in the
   block where two ways part, and no text of a block is needed.  No edit string
   is the beginning of another of the same rows and entry unless it is cheaper
   (a state follows from the letters), so what is least of a block stays least.
4. *Reading back*: rows meet their blocks' edits in order and stream by.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cmp_to_key
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.ranks import AT, dealt
from tierkit.llm.scratch import keep
from tierkit.llm.trails import Trails
from tierkit.operators._names import q

#: Rows of a block: 2 to the power of this.
BLOCK_BITS = 16
#: What the roles so far end in.
START, SYSTEM, USER, ASSISTANT = range(4)
DELETE, INSERT, REROLE, UNENDED = 3, 2, 2, 1
#: Inserts that lead from a state to an end that is allowed.
TAIL = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
#: A letter a row: its role's initial (x: another), upper case if truncated; or
#: d: has to be deleted.
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_SPACE = " \t\n\x0b\x0c\r"


def _next(state: int) -> int:
    """The state after a turn that is made, or given a role, to fit."""
    return ASSISTANT if state == USER else USER


def _kept(state: int, kind: str) -> int | None:
    """The state after a row that keeps its role, if the role fits."""
    to = _INITIAL.get(kind)
    if to == SYSTEM:
        return SYSTEM if state == START else None
    return to if to == _next(state) else None


Best = dict[int, tuple[int, int]]


def _put(trails: Trails, best: Best, state: int, cost: int, node: int, letter: str) -> bool:
    """Note a way to ``state`` if it is cheaper, or as cheap and earlier."""
    held = best.get(state)
    if held is not None and held[0] < cost:
        return False
    grown = trails.grow(node, letter)
    if held is not None and held[0] == cost and not trails.less(grown, held[1]):
        return False
    best[state] = (cost, grown)
    return True


def _inserted(trails: Trails, best: Best) -> Best:
    """Ways that may end in inserted turns."""
    out, changed = dict(best), True
    while changed:
        changed = False
        for state, (cost, node) in sorted(out.items(), key=lambda x: x[1][0]):
            changed |= _put(trails, out, _next(state), cost + INSERT, node, "I")
    return out


def edits(codes: str, entry: int = START, trails: Trails | None = None) -> tuple[Trails, Best]:
    """Cheapest, then least edits of a block's rows from a state to every state.
    Inserts stand before a row; those after the last row are the next block's."""
    trails = trails or Trails()
    best: Best = {entry: (0, 0)}
    for code in codes:
        there: Best = {}
        kind, unended = code.lower(), UNENDED * code.isupper()
        for state, (cost, node) in _inserted(trails, best).items():
            _put(trails, there, state, cost + DELETE, node, "D")
            if code == "d":
                continue
            to = _kept(state, kind)
            if to is not None:
                _put(trails, there, to, cost + unended, node, "K")
            _put(trails, there, _next(state), cost + REROLE + unended, node, "R")
        best = there
    return trails, best


def exits(codes: str, entry: int) -> list[tuple[int, int]]:
    """(state, cost) of a block's exits from ``entry``, the least edits first."""
    trails, best = edits(codes, entry)
    before = cmp_to_key(lambda a, b: -1 if trails.less(best[a][1], best[b][1]) else 1)
    return [(state, best[state][0]) for state in sorted(best, key=before)]


def route(tables: list[dict[int, list[tuple[int, int]]]]) -> tuple[int, list[int], str]:
    """(cost, states passed, last inserts) of the best way through blocks, each
    given by its exits from every entry."""
    trails = Trails()
    best: Best = {START: (0, 0)}
    state_of = {0: START}
    for table in tables:
        there: Best = {}
        for entry, (cost, node) in best.items():
            for rank, (to, more) in enumerate(table[entry]):
                if _put(trails, there, to, cost + more, node, str(rank)):
                    state_of[there[to][1]] = to
        best = there
    end = None
    for state, (cost, node) in best.items():
        whole = cost + INSERT * len(TAIL[state])
        if end is None or whole < end[0] or (whole == end[0] and trails.less(node, end[1])):
            end = (whole, node, state)
    cost, node, last = end
    passed = []
    while node:
        passed.append(state_of[node])
        node = trails.up[node][0]
    return cost, [START, *reversed(passed)], TAIL[last]


def _of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        told = []
        for codes, first in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            entries = (START,) if first else (START, SYSTEM, USER, ASSISTANT)
            told.append([(entry, to, cost) for entry in entries for to, cost in exits(codes, entry)])
        kind = pa.list_(pa.struct([("entry", pa.int32()), ("to", pa.int32()), ("cost", pa.int64())]))
        rows = [[{"entry": e, "to": t, "cost": c} for e, t, c in x] for x in told]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, kind)], names=["conv", "block", "exits"])


def _of_conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("block", pa.int64()), ("entry", pa.int32()), ("to", pa.int32()), ("tail", pa.string())]))
    for batch in batches:
        costs, ways = [], []
        for blocks in batch.column(1).to_pylist():
            tables = []
            for b in blocks:
                table: dict[int, list[tuple[int, int]]] = {}
                for x in b["exits"]:
                    table.setdefault(x["entry"], []).append((x["to"], x["cost"]))
                tables.append(table)
            cost, passed, tail = route(tables)
            costs.append(cost)
            last = len(blocks) - 1
            ways.append(
                [{"block": b["block"], "entry": passed[i], "to": passed[i + 1], "tail": tail if i == last else ""} for i, b in enumerate(blocks)]
            )
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(costs, pa.int64()), pa.array(ways, kind)], names=["conv", "cost", "way"])


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for codes, entry, to in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
            trails, best = edits(codes, entry)
            out.append(trails.spell(best[to][1]))
        names = ["conv", AT, "codes", "tail", "cost", "edits"]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 1, 2, 5, 6)), pa.array(out, pa.string())], names=names)


def _bare(text: Column) -> Column:
    return F.rtrim(text, F.lit(_SPACE))


def _faults(rows: DataFrame) -> DataFrame:
    """(conv, AT, code) of every row: its first fault and role."""
    text, role = F.col("text"), F.col("role")
    blank = ~text.rlike("[^\\x20\\x09-\\x0D]")
    small = rows.select(
        "conv",
        AT,
        F.substring(role, 1, 1).alias("kind"),
        blank.alias("blank"),
        (~F.substring(_bare(text), -1, 1).isin(".", "!", "?")).alias("unended"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("said"),
    )
    firsts = small.where("not blank").groupBy(F.col("conv").alias("c"), F.col("said").alias("s")).agg(F.min(AT).alias("first"), F.count(F.lit(1)).alias("times"))
    again = small.where("not blank").join(firsts.where("times > 1"), F.expr(f"conv <=> c and said = s and {AT} > first")).select(
        F.col("conv").alias("c"), F.col(AT).alias("a")
    )
    kind = F.when(F.col("kind").isin("s", "u", "a"), F.col("kind")).otherwise(F.lit("x"))
    code = F.when(F.col("blank") | F.col("a").isNotNull(), F.lit("d")).when(F.col("unended"), F.upper(kind)).otherwise(kind)
    return small.join(again, F.expr(f"conv <=> c and {AT} = a"), "left").select("conv", AT, code.alias("code"))


def _edits(rows: DataFrame, conv: str) -> DataFrame:
    """(conv, AT of the first row, codes, tail, cost, edits) of every block."""
    letters = F.array_sort(F.collect_list(F.struct(AT, "code")))
    blocks = _faults(rows).groupBy("conv", F.shiftright(AT, BLOCK_BITS).alias("block")).agg(letters.alias("l"))
    of_conv = Window.partitionBy("conv")
    blocks = blocks.select("conv", "block", F.array_join("l.code", "").alias("codes"), F.col("l").getItem(0).getField(AT).alias(AT))
    blocks = keep(blocks.withColumn("first", F.col("block") == F.min("block").over(of_conv)), "blocks")
    tables = blocks.select("conv", "block", "codes", "first").mapInArrow(
        _of_blocks, f"conv {conv}, block long, exits array<struct<entry:int,to:int,cost:long>>"
    )
    ways = (
        tables.groupBy("conv")
        .agg(F.array_sort(F.collect_list(F.struct("block", "exits"))).alias("blocks"))
        .mapInArrow(_of_conversations, f"conv {conv}, cost long, way array<struct<block:long,entry:int,to:int,tail:string>>")
    )
    ways = ways.select(F.col("conv").alias("c"), "cost", F.inline("way")).withColumnRenamed("block", "b")
    met = blocks.join(ways, F.expr("conv <=> c and block = b")).select("conv", AT, "codes", "entry", "to", "tail", "cost")
    return met.mapInArrow(_spelled, f"conv {conv}, {AT} long, codes string, tail string, cost long, edits string")


def _meeting(rows: DataFrame, id_col: str, role_col: str, text_col: str, turn_col: str, place: list[Column]) -> tuple[DataFrame, str]:
    """Rows of a conversation in order, each block's edits before its rows, and
    a row in front of all for every conversation; and the type of its id."""
    space = F.lit(" ")
    own = rows.select(
        q(id_col).alias("conv"),
        q(turn_col).cast("long").alias("turn"),
        F.coalesce(q(role_col).cast("string"), space).alias("role"),
        F.coalesce(q(text_col).cast("string"), space).alias("text"),
        *[c.alias(f"place{i}") for i, c in enumerate(place)],
    )
    order = ["turn", "role", "text", *[f"place{i}" for i in range(len(place))]]
    kind = rows.schema[id_col].dataType.simpleString()
    ordered = dealt(own, "conv", order, "turns").select("conv", "turn", "role", "text", AT)
    none = {c: F.lit(None).cast(t) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"))}
    blocks = _edits(ordered, kind).select("conv", AT, F.lit(0).alias("is_row"), "cost", "codes", "edits", "tail", *[c.alias(n) for n, c in none.items()])
    blank = {c: F.lit(None).cast("string").alias(c) for c in ("codes", "edits", "tail")}
    lines = ordered.select("conv", AT, F.lit(1).alias("is_row"), F.lit(None).cast("long").alias("cost"), *blank.values(), *none)
    return blocks.union(lines), kind


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """What happens in conversations, in order: ``("conv", id, cost)``, per row
    ``("row", turn, role, code)`` and its letters ``("edit", letters)``, per turn
    of the repaired conversation ``("turn", role, text, letter)``, ``("end",)``."""
    conv, begun, tail = None, False, ""

    def last():
        if begun:
            for i, letter in enumerate(tail):
                yield "turn", ("user", "assistant")[i + 2 - len(tail)], "", letter
            yield "edit", tail
            yield ("end",)

    for batch in batches:
        for c, _, is_row, cost, codes, edits_, end, turn, role, text in zip(*(x.to_pylist() for x in batch.columns)):
            if not begun or c != conv:
                yield from last()
                conv, begun, tail, state = c, True, "", START
                yield "conv", c, cost or 0
            if not is_row:
                if codes is not None:
                    block, letters, at, row, tail = codes, edits_, 0, 0, end
                continue
            yield "row", turn, role, text, block[row]
            row, since = row + 1, at
            while letters[at] == "I":
                state = _next(state)
                yield "turn", "user" if state == USER else "assistant", "", "I"
                at += 1
            if letters[at] == "K":
                state = _kept(state, role[:1])
                yield "turn", role, text, "K"
            elif letters[at] == "R":
                state = _next(state)
                yield "turn", "user" if state == USER else "assistant", text, "R"
            at += 1
            yield "edit", letters[since:at]
    yield from last()


_SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURNS = "place long, role string, text string, edit string"


def _columns(names: str, kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["conv", *[x.split()[0] for x in names.split(", ")]])


def _summarise(kind: pa.DataType):
    kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for what, *x in _stream(batches):
            if what == "conv":
                conv, cost = x
                low = high = before = None
                distinct = blank = duplicate = truncated = illegal = turns = 0
                audit, hashed = [], sha256()
            elif what == "row":
                turn, role, text, code = x
                if turn is not None:
                    distinct += turn != high
                    low, high = turn if low is None else low, turn
                empty = not text.strip(_SPACE)
                blank += empty
                duplicate += code == "d" and not empty
                truncated += code.isupper()
                illegal += before is not None and before + role[:1] not in ("su", "ua", "au")
                before = role[:1]
            elif what == "edit":
                audit.append(x[0])
            elif what == "turn":
                hashed.update(f"{chr(10) if turns else ''}{x[0]}:{x[1]}".encode())
                turns += 1
            else:
                gaps = 0 if low is None else high - low + 1 - distinct
                out.append((conv, gaps, blank, duplicate, truncated, illegal, cost, "".join(audit), hashed.hexdigest()))
                if len(out) == 4096:
                    yield _columns(_SUMMARY, kinds, out)
                    out = []
        yield _columns(_SUMMARY, kinds, out)

    return run


def _turns(kind: pa.DataType):
    kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for what, *x in _stream(batches):
            if what == "conv":
                conv, place = x[0], 0
            elif what == "turn":
                out.append((conv, place, *x))
                place += 1
                if len(out) == 1024:
                    yield _columns(_TURNS, kinds, out)
                    out = []
        yield _columns(_TURNS, kinds, out)

    return run


def _read(rows: DataFrame, of, names: str, id_col: str, role_col: str, text_col: str, turn_col: str, place, dropped: DataFrame | None) -> DataFrame:
    met, kind = _meeting(rows, id_col, role_col, text_col, turn_col, list(place))
    if dropped is not None:
        empty = dropped.select(q(id_col).alias("conv")).distinct()
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in met.schema.fields if f.name not in ("conv", AT, "is_row", "cost")]
        # Behind the rows of a conversation that has any, where it says nothing.
        met = met.union(empty.select("conv", F.lit((1 << 63) - 1).alias(AT), F.lit(0).alias("is_row"), F.lit(0).cast("long").alias("cost"), *rest))
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    sorted_ = met.repartition("conv").sortWithinPartitions("conv", AT, "is_row")
    return sorted_.mapInArrow(of(arrow), f"conv {kind}, {names}").withColumnRenamed("conv", id_col)


def summaries(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    place: tuple[Column, ...] = (),
    dropped: DataFrame | None = None,
) -> DataFrame:
    """One row per conversation: ``id_col``, ``gaps``, ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256`` (of
    the repaired ``role:text`` lines, hashed as they stream by).

    Rows are taken by turn (nulls first), then role, text and ``place``; null
    roles and texts count as one space, a null id is a conversation of its own.
    Rows of ``dropped`` name conversations that are told even without a row:
    zeros, no edits, the hash of nothing.  An empty table gives no row; other
    columns are ignored.  A whole conversation is read by one task at the end,
    as its one hash demands, but streams through it.
    """
    return _read(rows, _summarise, _SUMMARY, id_col, role_col, text_col, turn_col, place, dropped)


def repaired_turns(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    place: tuple[Column, ...] = (),
) -> DataFrame:
    """The repaired conversations, a row a turn: ``id_col``, ``place`` (from 0),
    ``role``, ``text`` and ``edit`` (K kept, R role given, I inserted).  A
    conversation of which nothing stays has no row.  Otherwise as ``summaries``."""
    return _read(rows, _turns, _TURNS, id_col, role_col, text_col, turn_col, place, None)


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(damaged, dropped)``: rows with faults that follow from crc32 of id and
    turn, modulo 20: 0 drops the row, 1 empties its text, 2 removes its ends of
    sentences, 3 repeats it (``copy`` 1), 4 makes it the user's.  Nulls are
    spelled, and role and text become, one space."""
    space = F.lit(" ")
    spelled = F.concat(F.coalesce(q(id_col).cast("string"), space), F.lit(":"), F.coalesce(q(turn_col).cast("string"), space))
    lot = F.crc32(spelled.cast("binary")) % 20
    text, role = F.coalesce(q(text_col), space), F.coalesce(q(role_col), space)
    dealt_ = rows.select(q(id_col).alias(id_col), q(turn_col).alias(turn_col), role.alias(role_col), text.alias(text_col), lot.alias("lot"))
    kept = dealt_.where("lot <> 0").select(
        id_col,
        turn_col,
        F.when(F.col("lot") == 4, "user").otherwise(q(role_col)).alias(role_col),
        F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.regexp_replace(text_col, "[.!?]", "")).otherwise(q(text_col)).alias(text_col),
        F.explode(F.when(F.col("lot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return kept, dealt_.where("lot = 0").select(id_col)
