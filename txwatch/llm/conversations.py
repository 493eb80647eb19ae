"""Repair of conversation structure: cheapest edits, the least of them by prefix-doubling path ranking.

A conversation is right when its role initials read `(s?(ua)+)?`. Four states (nothing yet, after s, u, a) and a
place between rows make a node; keeping, reroling and deleting a row lead to the next place, inserting a turn stays
there. The cost DP runs backwards over places. Arcs on a cheapest path are the optimal arcs; from one node they
carry different labels, as the state fixes the role that a reroled or inserted turn gets. Nodes are then ranked by
their next 1, 2, 4, ... audit letters: a rank of twice the length is the pair of a node's rank and the rank of the
node that many letters on, and the doubled pointers that lead there spell the least audit of any node.

No conversation meets in one task before its digest. Rows are sorted by range over all partitions and numbered in
that order; a conversation is cut into segments of at most SEGMENT rows. A segment's costs are a 4 x 4 matrix
(min, +); matrices are chained from the right, then every segment ranks its own paths from each entry state, and
exit states are chained from the left. Only the SHA-256 of a repaired conversation is sequential by nature: there
its rows pass through one task in order, and none are held.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch.session import materialise

SEGMENT_BITS = 16
#: Rows whose nodes are ranked at a time.
_BLOCK = 1 << 18

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or reroled turn leads to, by state.
NEXT = np.array([USER, USER, ASSISTANT, USER])
LETTERS = b"DIKR"  # in ASCII order
DELETE, INSERT, KEEP, REROLE = range(4)
_FAR = 1 << 40
_RIGHT_END = np.array([0, 4, 2, 0])  # cost from each state behind the last row, by insertions alone

NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
#: A row's symbol is 4 * fault + initial (s, u, a, other). Cost and next state of keeping it, by symbol and state.
_KEEP_COST = np.full((16, 4), _FAR)
_KEEP_TO = np.zeros((16, 4), dtype=np.int64)
_REROLE_COST = np.full(16, _FAR)
for _fault, _more in ((NO_FAULT, 0), (TRUNCATED, 1)):
    _REROLE_COST[4 * _fault : 4 * _fault + 4] = 2 + _more
    for _initial, _state, _to in ((0, START, SYSTEM), (1, START, USER), (1, SYSTEM, USER), (1, ASSISTANT, USER), (2, USER, ASSISTANT)):
        _KEEP_COST[4 * _fault + _initial, _state], _KEEP_TO[4 * _fault + _initial, _state] = _more, _to


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults made by crc32 of `conv_id:turn` modulo 20; nulls become one space.

    0 drops the row, 1 empties its text, 2 removes `[.!?]` from it, 3 repeats it, 4 makes its role `user`.
    """

    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    role = F.when(kind == 4, "user").otherwise(known("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))
    return (
        conversations.where(kind != 0)
        .select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy"))
        .drop("copy")
    )


def ordered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with `place`, their number in the order of conv_id and turn; and by place `initial` and `fault`.

    Nulls come first; rows of one turn follow by role and by the SHA-256 of their text, so repeated rows are
    neighbours. A null role or text counts as one space.
    """
    known = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    known = known.withColumns({"same": F.unhex(F.sha2(F.col("text").cast("binary"), 256)), "n": F.monotonically_increasing_id()})
    order = ["conv_id", "turn", "role", "same", "n"]
    placed = known.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = materialise(placed.drop("n"), "conversation-order")
    first = placed.groupBy("conv_id", "role", "same").agg(F.min("place").alias("first"))
    first = first.select(*[F.col(c).alias(f"{c}_") for c in ("conv_id", "role", "same")], "first")
    marks = placed.select(
        "conv_id", "turn", "role", "same", "place", F.col("text").rlike(r"[^\x20\x09-\x0D]").alias("full"),
        F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z").alias("ended"),
    ).join(first, F.col("conv_id").eqNullSafe(F.col("conv_id_")) & (F.col("role") == F.col("role_")) & (F.col("same") == F.col("same_")))
    fault = (
        F.when(~F.col("full"), BLANK).when(F.col("place") > F.col("first"), DUPLICATE)
        .when(~F.col("ended"), TRUNCATED).otherwise(NO_FAULT)
    )
    marks = materialise(
        marks.select("conv_id", "turn", "place", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")),
        "conversation-faults",
    )
    return placed, marks


def _segment() -> Column:
    return F.shiftright("place", SEGMENT_BITS).alias("segment")


def segments(marks: DataFrame) -> DataFrame:
    """(conv_id, segment, at, symbols): the rows of a conversation in pieces; `at` is the first row's place."""
    initial = F.coalesce(F.array_position(F.array(*map(F.lit, "sua")), F.col("initial")), F.lit(0))
    code = F.when(initial == 0, 3).otherwise(initial - 1)
    symbol = (F.col("fault") * 4 + code).cast("byte")
    rows = marks.select("conv_id", _segment(), "place", symbol.alias("symbol"))
    grouped = rows.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(F.struct("place", "symbol"))).alias("r"))
    return grouped.select("conv_id", "segment", F.col("r")[0]["place"].alias("at"), F.col("r.symbol").alias("symbols"))


class _Pieces:
    """Symbols of several segments end to end, the longest segment first."""

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray):
        starts = np.cumsum(sizes) - sizes
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.at = np.cumsum(self.sizes) - self.sizes
        inside = np.arange(self.sizes.sum()) - np.repeat(self.at, self.sizes)
        self.symbols = symbols[np.repeat(starts[self.order], self.sizes) + inside].astype(np.int64)

    def costs(self, right: np.ndarray) -> np.ndarray:
        """Cost from every node, from the costs `right` (segment, state, ...) behind each segment.

        Nodes lie segment by segment, `sizes + 1` places each, four states a place.
        """
        base = self.at + np.arange(len(self.sizes))
        value = np.empty((int(self.sizes.sum()) + len(self.sizes), *right.shape[1:]), dtype=np.int64)
        value[base + self.sizes] = right
        shape = (-1, 4, *[1] * (right.ndim - 2))
        for step in range(int(self.sizes[0]) if len(self.sizes) else 0):
            active = int(np.searchsorted(-self.sizes, -step, side="left"))
            here = base[:active] + self.sizes[:active] - 1 - step
            symbol = self.symbols[self.at[:active] + self.sizes[:active] - 1 - step]
            after = value[here + 1]
            kept = np.take_along_axis(after, _KEEP_TO[symbol].reshape(shape), axis=1) + _KEEP_COST[symbol].reshape(shape)
            moved = after[:, NEXT] + _REROLE_COST[symbol].reshape(-1, *[1] * (right.ndim - 1))
            value[here] = closed(np.minimum(np.minimum(kept, moved), after + 3))
        return np.minimum(value, _FAR)


def closed(value: np.ndarray) -> np.ndarray:
    """Costs (segment, state, ...) when turns may be inserted first, at 2 each."""
    best = value.copy()
    best[:, USER] = np.minimum(value[:, USER], value[:, ASSISTANT] + 2)
    best[:, ASSISTANT] = np.minimum(value[:, ASSISTANT], value[:, USER] + 2)
    for state in (START, SYSTEM):
        best[:, state] = np.minimum(value[:, state], best[:, USER] + 2)
    return best


class Ranking:
    """Least audits of all nodes of several segments, by prefix doubling."""

    def __init__(self, pieces: _Pieces, right: np.ndarray, final: np.ndarray):
        value = pieces.costs(right).ravel()
        places = len(value) // 4
        node, state = np.arange(len(value)), np.arange(len(value)) % 4
        ends = pieces.at + np.arange(len(pieces.sizes)) + pieces.sizes  # the place behind each segment
        inner = np.ones(places, dtype=bool)
        inner[ends] = False
        can_insert = inner.copy()
        can_insert[ends[final]] = True
        symbol = np.zeros(places, dtype=np.int64)
        symbol[inner] = pieces.symbols
        inner, can_insert, symbol = (np.repeat(v, 4) for v in (inner, can_insert, symbol))
        behind = np.where(inner, node - state + 4, 0)
        arcs = (  # in the order of LETTERS: target, cost, whether there is one
            (behind + state, 3, inner),
            (node - state + NEXT[state], 2, can_insert),
            (behind + _KEEP_TO[symbol, state], _KEEP_COST[symbol, state], inner),
            (behind + NEXT[state], _REROLE_COST[symbol], inner),
        )
        #: Rank 0 is the end; the first optimal arc in the order of letters gives rank and pointer of length one.
        rank, pointer = np.zeros(len(value), dtype=np.int64), node.copy()
        for letter, (target, cost, there) in reversed(list(enumerate(arcs))):
            optimal = there & (value < _FAR) & (value == cost + value[target % len(value)])
            rank[optimal], pointer[optimal] = letter + 1, target[optimal]
        self.value, self.letter, self.length = value, rank.copy(), (rank > 0).astype(np.int64)
        self.pointers = [pointer]
        while (onward := self.pointers[-1])[onward].tolist() != onward.tolist():
            self.length = self.length + self.length[onward]
            _, rank = np.unique(rank * (rank.max() + 1) + rank[onward], return_inverse=True)
            self.pointers.append(onward[onward])
        self.rank = rank

    def audits(self, entries: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """The least audit from each entry node, and the state where it ends."""
        size = self.length[entries]
        stops = np.cumsum(size)
        place = np.arange(size.sum()) - np.repeat(stops - size, size)
        node = np.repeat(entries, size)
        last = entries
        for k, pointer in enumerate(self.pointers):
            node = np.where(place >> k & 1, pointer[node], node)
        for k, pointer in enumerate(self.pointers):
            last = np.where(size >> k & 1, pointer[last], last)
        letters = np.frombuffer(b"." + LETTERS, dtype=np.uint8)[self.letter[node]].tobytes()
        return [letters[b - n : b] for b, n in zip(stops.tolist(), size.tolist())], last % 4


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[slice, _Pieces]]:
    column = batch.column("symbols")
    sizes = column.value_lengths().to_numpy().astype(np.int64)
    symbols = column.flatten().to_numpy(zero_copy_only=False)
    stops = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        past = max(first + 1, int(np.searchsorted(stops, stops[first] - sizes[first] + _BLOCK, side="right")))
        begin = int(stops[first] - sizes[first])
        yield slice(first, past), _Pieces(symbols[begin : int(stops[past - 1])], sizes[first:past])
        first = past


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per segment the costs from each state to each exit state, and to a right end."""
    through = np.where(np.eye(4, dtype=bool), 0, _FAR)
    goals = np.concatenate([through, _RIGHT_END[:, None]], axis=1)
    for batch in batches:
        out = np.empty((batch.num_rows, 20), dtype=np.int64)
        for part, pieces in _blocks(batch):
            value = pieces.costs(np.broadcast_to(goals, (len(pieces.sizes), 4, 5)))
            out[np.arange(part.start, part.stop)[pieces.order]] = value[pieces.at + np.arange(len(pieces.sizes))].reshape(-1, 20)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("at"), pa.array(list(out), pa.list_(pa.int64()))], ["conv_id", "at", "costs"]
        )


def _chain_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs behind each segment, chained from the right, and the cost from the start of the conversation."""
    for batch in batches:
        at, right, first, total = [], [], [], []
        for pieces in batch.column("pieces").to_pylist():
            behind = None
            for place, piece in reversed(list(enumerate(pieces))):
                at.append(piece["at"])
                right.append(behind)
                first.append(place == 0)
                costs = np.array(piece["costs"]).reshape(4, 5)
                behind = (costs[:, 4] if behind is None else (costs[:, :4] + behind).min(axis=1)).tolist()
                total.append(behind[START])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(right, pa.list_(pa.int64())), pa.array(first, pa.bool_()), pa.array(total, pa.int64())],
            ["at", "right", "first", "cost"],
        )


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per segment the least audit and the exit state from each entry state; of a first one from the start alone."""
    for batch in batches:
        rights, firsts = batch.column("right").to_pylist(), batch.column("first").to_pylist()
        exits, audits = [None] * batch.num_rows, [None] * batch.num_rows
        for part, pieces in _blocks(batch):
            rows = np.arange(part.start, part.stop)[pieces.order].tolist()
            final = np.array([rights[r] is None for r in rows])
            right = np.array([_RIGHT_END if rights[r] is None else rights[r] for r in rows])
            ranking = Ranking(pieces, right, final)
            base = 4 * (pieces.at + np.arange(len(rows)))
            for state in range(4):
                some = [k for k, r in enumerate(rows) if state == START or not firsts[r]]
                found, left = ranking.audits(base[some] + state)
                for k, audit, end in zip(some, found, left.tolist()):
                    exits[rows[k]] = (exits[rows[k]] or []) + [end]
                    audits[rows[k]] = (audits[rows[k]] or []) + [audit.decode()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv_id", "segment", "at", "first", "cost")),
             pa.array(exits, pa.list_(pa.int32())), pa.array(audits, pa.list_(pa.string()))],
            ["conv_id", "segment", "at", "first", "cost", "exits", "audits"],
        )


def _chain_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each segment is entered."""
    for batch in batches:
        at, entry = [], []
        for pieces in batch.column("pieces").to_pylist():
            state = START
            for piece in pieces:
                at.append(piece["at"])
                entry.append(state)
                state = piece["exits"][state]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(entry, pa.int32())], ["at", "entry"])


def _chained(df: DataFrame, column: str, function, schema: str) -> DataFrame:
    """`function` over each conversation's segments in order: one short row per SEGMENT rows."""
    pieces = F.array_sort(F.collect_list(F.struct("at", column))).alias("pieces")
    return df.groupBy("conv_id").agg(pieces).select("pieces").mapInArrow(function, schema)


def audits(marks: DataFrame) -> DataFrame:
    """(conv_id, segment, at, entry, first, cost, audit): the edits of each segment; cost counts from its left end on."""
    kind = marks.schema["conv_id"].dataType.simpleString()
    cut = materialise(segments(marks), "conversation-segments")
    costs = cut.mapInArrow(_matrices, f"conv_id {kind}, at long, costs array<long>")
    behind = _chained(costs, "costs", _chain_costs, "at long, right array<long>, first boolean, cost long")
    found = cut.join(behind, "at").select("conv_id", "segment", "at", "symbols", "right", "first", "cost").mapInArrow(
        _paths, f"conv_id {kind}, segment long, at long, first boolean, cost long, exits array<int>, audits array<string>"
    )
    found = materialise(found, "conversation-paths")
    entries = _chained(found, "exits", _chain_states, "at long, entry int")
    return materialise(
        found.join(entries, "at").select("conv_id", "segment", "at", "entry", "first", "cost", F.col("audits")[F.col("entry")].alias("audit")),
        "conversation-audits",
    )


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Applies each segment's edits, which come before its rows, and yields the repaired rows in order."""
    audit, used, body, state, roles = "", 0, 0, START, ("", "", "user", "assistant")
    for batch in batches:
        new, own_roles, places = (batch.column(c).to_pylist() for c in ("audit", "role", "place"))
        source, place, nth, edit, role, empty = [], [], [], [], [], []
        for k, given in enumerate(new):
            if given is not None:
                audit, used, body, state = given, 0, len(given.rstrip("I")), batch.column("entry")[k].as_py()
                continue
            step = 0
            while True:
                letter = audit[used]
                used += 1
                if letter == "I" or letter == "R":
                    state = int(NEXT[state])
                elif letter == "K":
                    state = "sua".index(own_roles[k][0]) + 1
                if letter != "D":
                    source.append(k)
                    place.append(places[k])
                    nth.append(step)
                    edit.append(letter)
                    role.append(own_roles[k] if letter == "K" else roles[state])
                    empty.append(letter == "I")
                step += 1
                if letter != "I" and used < body or used == len(audit):
                    break
        index = pa.array(source, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id").take(index), pa.array(place, pa.int64()), pa.array(nth, pa.int32()), pa.array(edit, pa.string()),
             pa.array(role, pa.string()), pc.if_else(pa.array(empty, pa.bool_()), "", batch.column("text").take(index))],
            ["conv_id", "place", "nth", "edit", "role", "text"],
        )


def repaired(placed: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, nth, edit, role, text): the rows of the repaired conversations, to be read by place and nth."""
    kind = placed.schema["conv_id"].dataType.simpleString()
    rows = placed.select("conv_id", _segment(), "place", "role", "text")
    lead = found.select("conv_id", "segment", F.lit(-1).cast("long").alias("place"), "audit", "entry")
    both = rows.unionByName(lead, allowMissingColumns=True)
    return both.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "place").mapInArrow(
        _edit, f"conv_id {kind}, place long, nth int, edit string, role string, text string"
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, state = None, None
    for batch in batches:
        ids, digests = [], []
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if state is None or conv != current:
                if state is not None:
                    ids.append(current)
                    digests.append(state.hexdigest())
                current, state = conv, sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        kind = batch.schema.field("conv_id").type
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(digests, pa.string())], ["conv_id", "repaired_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the `role:text` lines of repaired rows."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    lines = rows.select("conv_id", "place", "nth", "role", "text").repartition("conv_id")
    return lines.sortWithinPartitions("conv_id", "place", "nth").mapInArrow(_digests, f"conv_id {kind}, repaired_sha256 string")


def _counts(marks: DataFrame) -> DataFrame:
    turns = marks.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    faults = marks.groupBy("conv_id").agg(*[
        F.count_if(F.col("fault") == code).alias(name)
        for name, code in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))
    ])
    return turns.unionByName(faults, allowMissingColumns=True)


def _illegal(marks: DataFrame) -> DataFrame:
    """(conv_id, illegal): neighbours whose initials are not su, ua or au, by segment and then between segments."""
    rows = marks.select("conv_id", _segment(), "place", "initial")
    listed = rows.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(F.struct("place", "initial"))).alias("r"))

    def wrong(pairs: Column) -> Column:
        return F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))).cast("long")

    def pairs(left: Column, right: Column) -> Column:
        return F.zip_with(left, right, lambda a, b: F.concat(a, b))

    inner = listed.select(
        "conv_id", F.col("r")[0]["place"].alias("at"), F.col("r")[0]["initial"].alias("left"),
        F.element_at("r", -1)["initial"].alias("right"),
        wrong(pairs(F.slice(F.col("r.initial"), 1, F.size("r") - 1), F.slice(F.col("r.initial"), 2, F.size("r")))).alias("inside"),
    )
    joined = inner.groupBy("conv_id").agg(
        F.sum("inside").alias("inside"), F.array_sort(F.collect_list(F.struct("at", "left", "right"))).alias("s")
    )
    between = pairs(F.slice(F.col("s.right"), 1, F.size("s") - 1), F.slice(F.col("s.left"), 2, F.size("s")))
    return joined.select("conv_id", (F.col("inside") + wrong(between)).alias("illegal"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repairs conversations (conv_id, turn, role, text): a report per conv_id, and the repaired rows.

    Report: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. Rows: see `repaired`.
    Keep costs 0, rerole 2, delete 3, insert 2; blank and duplicate rows must go; a truncated row that stays costs
    one more. Rows of a null conv_id are one conversation. A role that does not begin with s, u or a can be
    reroled or deleted, not kept; an empty role likewise. Null roles and texts count as one space. Other columns
    are not read; an empty table gives empty results.
    """
    placed, marks = ordered(rows)
    found = audits(marks)
    kept = (
        found.groupBy("conv_id")
        .agg(F.max(F.when(F.col("first"), F.col("cost"))).alias("cost"), F.array_sort(F.collect_list(F.struct("at", "audit"))).alias("p"))
        .select("conv_id", "cost", F.array_join(F.col("p.audit"), "").alias("audit"))
    )
    parts = _counts(marks).unionByName(_illegal(marks), allowMissingColumns=True).unionByName(kept, allowMissingColumns=True)
    columns = "gaps blank duplicate truncated illegal cost audit".split()
    return parts.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in columns]), repaired(placed, found)


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """The report of `repair` on damaged rows for every conv_id of the input, with the digest of the repaired rows.

    A conversation that the damage leaves without rows has zeros, an empty audit and the digest of no bytes.
    """
    report, rows = repair(damage(conversations))
    parts = report.unionByName(digests(rows), allowMissingColumns=True)
    parts = parts.unionByName(conversations.select("conv_id").distinct(), allowMissingColumns=True)
    numbers = "gaps blank duplicate truncated illegal cost".split()
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in numbers], F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
