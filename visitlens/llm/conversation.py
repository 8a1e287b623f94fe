"""Conversation repair by an auction algorithm for shortest paths.

A repaired conversation has the role initials (s?(ua)+)?.  Its cheapest edits
are a shortest path over a lattice: a node is a number of rows consumed and
one of four states (start, after s, after u, after a); Delete, Insert, Keep
and Rerole are its arcs.  Every node has a price, never above the cost of an
arc plus the price where it leads.  A path grows from the origin along an arc
that its end's price pays for exactly; where no arc is paid for, the end's
price rises to the cheapest and the path shrinks by that node.  At the end
prices are distances and the arcs they pay for (the tight ones) hold every
cheapest path; as a path grows by the tight arc of the least initial, it is
the first of them in ASCII order.

Rows are ordered by range partitioning over (conversation, turn), not by
conversation, and cut into pieces of at most PIECE rows, so one conversation
may be of any length.  Pieces are single strings, a character a row.  Per
piece the auction gives the costs between its states; a pass back over a
conversation's pieces gives the distances at their borders, the auction traces
every piece from each of its four states, and a pass forward picks one.  The
passes carry four numbers from piece to piece.  Texts meet the edits by a join
on their position.

Defined cases: a null role or text counts as one space, a null conversation
as one of its own; null turns come first; rows of one turn come in the order
of a hash of role and text, equal rows side by side; a role's initial is its
first character, whatever the rest; extra columns play no part; an empty table
gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from visitlens.llm.common import cut

PIECE_BITS = 10
SEGMENT = 32
KEEP, DELETE, INSERT, REROLE = 0, 3, 2, 2
TRUNCATED = 1
# States: 0 start, 1 after s, 2 after u, 3 after a.  Where an inserted or
# reroled turn leads, and its role.
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "-": {}}
# Cost from each state to a complete conversation when no row is left.
LAST = (0, 2 * INSERT, INSERT, 0)
TAIL = ("", "II", "I", "")
FAR = 1 << 60
# A row's code: b blank, d duplicate; else the class of its initial (s, u, a,
# - any other), in the second spelling where it is truncated.
_CUT = {"S": "s", "U": "u", "A": "a", "_": "-"}


def arcs(code: str, state: int) -> list[tuple[str, int, int, int]]:
    """(initial, cost, rows consumed, state) of the arcs before a row, by
    initial."""
    out = [("D", DELETE, 1, state), ("I", INSERT, 0, NEXT[state])]
    if code not in "bd":
        extra = TRUNCATED if code in _CUT else 0
        to = KEPT[_CUT.get(code, code)].get(state)
        if to is not None:
            out.append(("K", KEEP + extra, 1, to))
        out.append(("R", REROLE + extra, 1, NEXT[state]))
    return out


@functools.lru_cache(1 << 16)
def auction(codes: str, exits: tuple[int, ...]) -> tuple[tuple, tuple, tuple]:
    """Distances from the four states before ``codes`` to a goal that lies
    ``exits`` beyond the four states after it, the first cheapest edits from
    each, and the states where these end."""
    n = len(codes)
    goal = 4 * (n + 1)
    out = [[(e, cost, 4 * (i + step) + to) for e, cost, step, to in arcs(codes[i], state)]
           for i in range(n) for state in range(4)]
    out += [[("", exits[state], goal)] for state in range(4)]
    price = [0] * (goal + 1)
    edits, ends = [], []
    for origin in range(4):
        path, taken = [origin], []
        while path[-1] != goal:
            node = path[-1]
            least = min([cost + price[to] for _, cost, to in out[node]])
            if price[node] < least:
                price[node] = least
                if len(path) > 1:
                    path.pop()
                    taken.pop()
                continue
            initial, to = next((e, to) for e, cost, to in out[node] if cost + price[to] == least)
            path.append(to)
            taken.append(initial)
        edits.append("".join(taken))
        ends.append(path[-2] - 4 * n)
    return tuple(price[:4]), tuple(edits), tuple(ends)


def _segments(codes: str) -> list[str]:
    return [codes[i:i + SEGMENT] for i in range(0, len(codes), SEGMENT)]


def _back(codes: str, exits: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Distances before each segment of ``codes``, and after the last."""
    out = [tuple(exits)]
    for part in reversed(_segments(codes)):
        low = min(out[-1])
        near, _, _ = auction(part, tuple(x - low for x in out[-1]))
        out.append(tuple(x + low for x in near))
    return out[::-1]


def distances(codes: str, exits: tuple[int, ...]) -> tuple[int, ...]:
    return _back(codes, exits)[0]


def traces(codes: str, exits: tuple[int, ...]) -> tuple[list[str], list[int]]:
    """First cheapest edits of ``codes`` from each state, and their ends."""
    marks, edits, ends = _back(codes, exits), [""] * 4, [0, 1, 2, 3]
    for part, after in zip(_segments(codes), marks[1:], strict=True):
        low = min(after)
        _, some, to = auction(part, tuple(x - low for x in after))
        edits = [e + some[s] for e, s in zip(edits, ends, strict=True)]
        ends = [to[s] for s in ends]
    return edits, ends


def between(codes: str) -> list[int]:
    """Costs from every state before a piece to every state after it, row by
    row.  Start and after-s cannot be entered by an insertion: rows are
    deleted, or one s is kept."""
    n = len(codes)
    kept = [TRUNCATED if c == "S" else 0 for c in codes if c in "sS"]
    to_start = [DELETE * n, FAR, FAR, FAR]
    to_s = [DELETE * (n - 1) + min(kept) if kept else FAR, DELETE * n, FAR, FAR]
    # After u and after a: an insertion may also follow the last row.
    to_u = distances(codes, (INSERT, INSERT, 0, INSERT))
    to_a = distances(codes, (2 * INSERT, 2 * INSERT, INSERT, 0))
    return [x for row in zip(to_start, to_s, to_u, to_a, strict=True) for x in row]


def before(costs: list[int], exits: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(costs[4 * s + t] + exits[t] for t in range(4)) for s in range(4))


def repair_plainly(codes: str) -> tuple[int, str]:
    """Cost and audit of one conversation in memory."""
    edits, ends = traces(codes, LAST)
    return distances(codes, LAST)[0], edits[0] + TAIL[ends[0]]


def illegal_pairs(classes: str) -> int:
    return sum(x + y not in ("su", "ua", "au") for x, y in zip(classes, classes[1:], strict=False))


# The steps over pieces, one record a piece.

def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    some = []
    for row in rows:
        some.append(row)
        if len(some) == size:
            yield pa.RecordBatch.from_pylist(some, schema)
            some = []
    yield pa.RecordBatch.from_pylist(some, schema)


def _step(pieces: DataFrame, fn, extra: list[tuple[str, pa.DataType]], drop: tuple[str, ...] = ()) -> DataFrame:
    """mapInArrow with a function from records to records, whose columns are
    those of ``pieces`` without ``drop``, and ``extra``."""
    from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

    schema = to_arrow_schema(pieces.drop(*drop).schema)
    for name, kind in extra:
        schema = schema.append(pa.field(name, kind))

    def run(batches):
        return _batches(fn(_rows(batches)), schema)

    return pieces.mapInArrow(run, from_arrow_schema(schema))


def _costs(rows):
    for r in rows:
        yield r | {"costs": between(r["codes"])}


def _backward(rows):
    """Pieces of a conversation come last first."""
    conv, exits = None, None
    for r in rows:
        last = exits is None or r["conv"] != conv
        conv, exits = r["conv"], LAST if last else exits
        yield {k: v for k, v in r.items() if k != "costs"} | {"exits": list(exits), "last": last}
        exits = before(r["costs"], exits)


def _traced(rows):
    for r in rows:
        edits, ends = traces(r["codes"], tuple(r["exits"]))
        cost = distances(r["codes"], tuple(r["exits"]))[0]
        yield {k: v for k, v in r.items() if k != "exits"} | {"edits": edits, "ends": ends, "cost": cost}


def _forward(rows):
    """Pieces of a conversation come first first."""
    conv, state, seen = None, None, ""
    for r in rows:
        first = state is None or r["conv"] != conv
        conv, state, seen = r["conv"], 0 if first else state, "" if first else seen
        codes, edits, end = r["codes"], r["edits"][state], r["ends"][state]
        yield {"conv": conv, "piece": r["piece"], "start": r["start"], "state": state, "codes": codes,
               "edits": edits + (TAIL[end] if r["last"] else ""), "cost": r["cost"] if first else 0,
               "blank": codes.count("b"), "duplicate": codes.count("d"), "truncated": sum(codes.count(c) for c in _CUT),
               "illegal": illegal_pairs(seen + r["classes"])}
        state, seen = end, r["classes"][-1]


def _turns(rows):
    """The repaired turns of a piece: position, order there, the position of
    the row whose text they have (None: inserted), role (None: as it is)."""
    for r in rows:
        at, nth, state = 0, 0, r["state"]
        for e in r["edits"]:
            pos = r["start"] + at
            if e == "I":
                yield {"conv": r["conv"], "place": pos, "nth": nth, "pos": None, "new_role": ROLE[state]}
                nth, state = nth + 1, NEXT[state]
                continue
            if e == "K":
                yield {"conv": r["conv"], "place": pos, "nth": nth, "pos": pos, "new_role": None}
                state = KEPT[_CUT.get(r["codes"][at], r["codes"][at])][state]
            elif e == "R":
                yield {"conv": r["conv"], "place": pos, "nth": nth, "pos": pos, "new_role": ROLE[state]}
                state = NEXT[state]
            at, nth = at + 1, 0


def _digest(rows):
    """SHA-256 of the turns of each conversation, which come in order."""
    conv, hashed = None, None
    for r in rows:
        if hashed is None or r["conv"] != conv:
            if hashed is not None:
                yield {"conv": conv, "repaired_sha256": hashed.hexdigest()}
            conv, hashed = r["conv"], hashlib.sha256()
        else:
            hashed.update(b"\n")
        hashed.update(f"{r['role']}:{r['text']}".encode())
    if hashed is not None:
        yield {"conv": conv, "repaired_sha256": hashed.hexdigest()}


def _class(role: Column) -> Column:
    initial = F.substring(role, 1, 1)
    return F.when(initial.isin("s", "u", "a"), initial).otherwise("-")


def ordered(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows with ``pos``, which ascends with conversation and turn, and a
    hash that tells different rows of a turn apart."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"),
                     space(text).alias("text"))
    mark = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    # Equal rows are told apart by their place in the input, so that many of
    # them need not share a partition.
    marked = rows.withColumn("mark", mark).withColumn("seen", F.monotonically_increasing_id())
    by = ["conv", "turn", "mark", "seen"]
    return cut(marked.repartitionByRange(*by).sortWithinPartitions(*by).drop("seen").withColumn(
        "pos", F.monotonically_increasing_id()))


def coded(rows: DataFrame) -> DataFrame:
    """conv, pos, code and class of ordered rows."""
    firsts = rows.groupBy("conv", "mark").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    told = rows.select("conv", "pos", _class(F.col("role")).alias("class"), last.alias("end")).join(firsts, "pos", "left")
    cut_off = F.translate("class", "sua-", "SUA_")
    code = (F.when(F.col("end") == "", "b").when(F.col("first").isNull(), "d")
            .when(~F.col("end").isin(".", "!", "?"), cut_off).otherwise(F.col("class")))
    return told.select("conv", "pos", "class", code.alias("code"))


class Repair:
    """What a repair gives: ``audits`` (conv, cost, blank, duplicate,
    truncated, illegal, audit) and ``turns`` (conv, place, nth, role, text in
    the order of place and nth)."""

    def __init__(self, df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
        self.rows = ordered(df, conv, turn, role, text)
        longs = pa.list_(pa.int64())
        bits = F.struct("pos", "code", "class")
        held = coded(self.rows).groupBy("conv", F.shiftright("pos", PIECE_BITS).alias("piece")).agg(
            F.sort_array(F.collect_list(bits)).alias("held"))
        letters = lambda name: F.array_join(F.transform("held", lambda r: r[name]), "")
        pieces = held.select("conv", "piece", F.col("held")[0]["pos"].alias("start"), letters("code").alias("codes"),
                             letters("class").alias("classes"))
        costs = _step(pieces, _costs, [("costs", longs)])
        back = _step(costs.repartition("conv").sortWithinPartitions("conv", F.desc("piece")), _backward,
                     [("exits", longs), ("last", pa.bool_())], ("costs",))
        # A long conversation's pieces are traced side by side again.
        traced = _step(back.repartition("conv", "piece"), _traced,
                       [("edits", pa.list_(pa.string())), ("ends", longs), ("cost", pa.int64())], ("exits",))
        along = traced.repartition("conv").sortWithinPartitions("conv", "piece")
        counts = ("cost", "blank", "duplicate", "truncated", "illegal")
        plain = [("state", pa.int32()), ("codes", pa.string()), ("edits", pa.string()), *[(c, pa.int64()) for c in counts]]
        self.pieces = cut(_step(along, _forward, plain, ("codes", "classes", "last", "edits", "ends", "cost")))
        joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "edits"))), lambda r: r["edits"]), "")
        self.audits = self.pieces.groupBy("conv").agg(*[F.sum(c).alias(c) for c in counts], joined.alias("audit"))
        edited = _step(self.pieces.repartition("conv", "piece"), _turns, [
            ("place", pa.int64()), ("nth", pa.int32()), ("pos", pa.int64()), ("new_role", pa.string())],
            ("piece", "start", "state", "codes", "edits", *counts))
        kept = self.rows.select("pos", "role", "text")
        self.turns = edited.join(kept, "pos", "left").select(
            "conv", "place", "nth", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def digests(self) -> DataFrame:
        """conv and the SHA-256 of its turns, role:text joined by newlines:
        a hash is taken from first to last, so each conversation streams
        through one task, in batches."""
        in_order = self.turns.repartition("conv").sortWithinPartitions("conv", "place", "nth")
        return _step(in_order, _digest, [("repaired_sha256", pa.string())], ("place", "nth", "role", "text"))

    def turn_gaps(self) -> DataFrame:
        """conv and the turns missing between its first and its last."""
        spans = self.rows.where("turn IS NOT NULL").groupBy("conv").agg(
            F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("turns"))
        wide = lambda c: F.col(c).cast("decimal(38,0)")
        gaps = wide("high") - wide("low") + F.lit(1).cast("decimal(38,0)") - wide("turns")
        return spans.select("conv", F.least(gaps, F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long").alias("gaps"))


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The query's damage: rows by crc32(conv:turn) % 20."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", space(conv), space(turn)).cast("binary")) % 20
    copies = F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 3, 2).otherwise(1)
    text = (F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(space("text"), "[.!?]", ""))
            .otherwise(space("text")))
    role = F.when(F.col("_kind") == 4, "user").otherwise(space("role"))
    hurt = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), "role", "text", kind.alias("_kind")).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copies"))
    return hurt.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(1), F.col("_copies")))).drop("col")


def audit(original: DataFrame, damaged: DataFrame) -> DataFrame:
    """One row per conversation of ``original`` about the repair of
    ``damaged``."""
    done = Repair(damaged)
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    texts = ("audit", "repaired_sha256")

    def part(df: DataFrame) -> DataFrame:
        fill = [F.col(c).alias(c) if c in df.columns else F.lit(None).cast("long").alias(c) for c in longs]
        return df.select("conv", *fill, *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in texts])

    parts = [original.select(F.col("conv_id").alias("conv")).distinct(), done.turn_gaps(), done.audits, done.digests()]
    all_of = functools.reduce(DataFrame.unionByName, [part(p) for p in parts])
    nothing = hashlib.sha256().hexdigest()
    return all_of.groupBy(F.col("conv").alias("conv_id")).agg(
        *[F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in longs],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"))
