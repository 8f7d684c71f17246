"""Repair of conversation structure: a rank-convergence parallel Viterbi over chunks of turns.

The turns of a conversation, ordered by turn (nulls first), role and text, are edited at the least cost so that the
initials of their roles read ``(s?(ua)+)?``. A turn is kept (K, 0), gets the role user or assistant (R, 1) or is
deleted (D, 2); an empty turn of either role may be inserted anywhere (I, 5). Blank turns and turns whose role and text
occurred before must go; a truncated turn that stays costs 5 more. Of several cheapest edit strings the ASCII-least wins.

Only differences between the costs of the four states (nothing yet, after s, after u, after a) steer the search, so cost
vectors are kept less their minimum: then few vectors exist, and "equal but for a constant" is "equal". Conversations are
cut into chunks. Each runs backward from a speculative vector, that of a conversation's end; fix-up passes rerun chunks
from what their successors handed them, only until the vectors fall in with those of the first run; stitching the chunks
gives each its true vector and state, and each traces its edits alone. Passes end when no vector is new, and there are
only ``len(VECTORS)`` of them, so a conversation of any length needs few.

Null roles and texts are one blank. A null conv_id is a conversation, null turns come first and do not count as turns.
Equal rows are one row with a count: all but the first are duplicates. A conversation without rows (``copies`` 0) is
reported with zeros. Roles count by their first letter as written; an empty role has none and cannot be kept. An empty
table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import written

#: Turns and text bytes of a chunk; a longer turn is a chunk of its own.
CHUNK_TURNS, CHUNK_BYTES = 4096, 2_000_000
#: Characters of a text that range partitioning looks at; turns that agree so far share a task.
RANGE_CHARS = 200
#: Bytes of chunks that are handed to Spark at a time.
SEND_BYTES = 8_000_000

DELETE, REROLE, INSERT, CUT = 2, 1, 5, 5
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The state that a user or assistant turn leads to, and the one that a kept turn of class s, u or a leads to.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
KEPT = ({1: AFTER_S, 2: AFTER_U}, {2: AFTER_U}, {3: AFTER_A}, {2: AFTER_U})
#: Costs of a conversation's end by state.
END = (0, 2 * INSERT, INSERT, 0)
#: A turn as a byte: class of its role (0 for any other), plus TRUNCATED, or GONE if it must be deleted.
CLASSES, TRUNCATED, GONE = {"s": 1, "u": 2, "a": 3}, 4, 8
CODES = (*range(4), *range(TRUNCATED, TRUNCATED + 4), GONE)
WHITE = " \t\n\x0b\x0c\r"


def step(after: tuple[int, ...], code: int) -> tuple[int, ...]:
    """Costs before a turn from those after it."""
    costs = []
    for state in range(4):
        best = DELETE + after[state]
        if code != GONE:
            extra = CUT if code & TRUNCATED else 0
            best = min(best, REROLE + extra + after[NEXT[state]])
            if (target := KEPT[state].get(code & 3)) is not None:
                best = min(best, extra + after[target])
        costs.append(best)
    costs[AFTER_U], costs[AFTER_A] = min(costs[AFTER_U], INSERT + costs[AFTER_A]), min(costs[AFTER_A], INSERT + costs[AFTER_U])
    for state in (START, AFTER_S):
        costs[state] = min(costs[state], INSERT + costs[AFTER_U])
    return tuple(costs)


def less_minimum(costs: tuple[int, ...]) -> tuple[int, ...]:
    least = min(costs)
    return tuple(cost - least for cost in costs)


def reachable() -> tuple[list[tuple[int, ...]], list[dict[int, int]]]:
    """All cost vectors less their minimum, from the end on, and where each turn leads from each."""
    vectors = [less_minimum(END)]
    numbers = {vectors[0]: 0}
    moves: list[dict[int, int]] = []
    for vector in vectors:
        moves.append({})
        for code in CODES:
            made = less_minimum(step(vector, code))
            if made not in numbers:
                numbers[made] = len(vectors)
                vectors.append(made)
            moves[-1][code] = numbers[made]
    return vectors, moves


VECTORS, MOVES = reachable()
FINAL = 0


def edits_of(after: tuple[int, ...], code: int, state: int) -> tuple[str, int, int]:
    """ASCII-least cheapest edits of a turn, the insertions before it included: initials, state after, cost."""
    before = step(after, code)
    extra = CUT if code & TRUNCATED and code != GONE else 0
    initials, spent = "", 0
    while True:
        if before[state] == DELETE + after[state]:
            return initials + "D", state, spent + DELETE
        if before[state] == INSERT + before[NEXT[state]]:
            initials, spent, state = initials + "I", spent + INSERT, NEXT[state]
            continue
        target = KEPT[state].get(code & 3)
        if target is not None and before[state] == extra + after[target]:
            return initials + "K", target, spent + extra
        return initials + "R", NEXT[state], spent + REROLE + extra


EDITS = {(v, code, state): edits_of(vector, code, state) for v, vector in enumerate(VECTORS) for code in CODES for state in range(4)}


def backward(codes: bytes, fed: int, trail: bytes | None = None) -> bytes:
    """Number of the vector before each turn of a chunk, and the one fed to it at its end.

    With the ``trail`` of an earlier run the rerun stops where it falls in with it; what lies before stays.
    """
    found = bytearray(len(codes) + 1)
    found[-1] = vector = fed
    for place in range(len(codes) - 1, -1, -1):
        vector = MOVES[vector][codes[place]]
        if trail is not None and vector == trail[place]:
            found[:place + 1] = trail[:place + 1]
            break
        found[place] = vector
    return bytes(found)


def exits(codes: bytes, trail: bytes) -> bytes:
    """The state after a chunk for each state before it."""
    left = []
    for state in range(4):
        for place, code in enumerate(codes):
            state = EDITS[trail[place + 1], code, state][1]
        left.append(state)
    return bytes(left)


def traced(codes: bytes, fed: int, state: int, roles: list[str], texts: list[str], last: bool):
    """Initials and cost of a chunk's edits, and the roles and texts that they leave.

    ``roles`` and ``texts`` are those of turns that need not go. The last chunk also completes the pattern.
    """
    trail = backward(codes, fed)
    audit, cost, kept_roles, kept_texts, at = [], 0, [], [], 0

    def put(target: int, text: str) -> None:
        kept_roles.append("user" if target == AFTER_U else "assistant")
        kept_texts.append(text)

    for place, code in enumerate(codes):
        initials, after, spent = EDITS[trail[place + 1], code, state]
        audit.append(initials)
        cost += spent
        for initial in initials:
            if initial == "I":
                state = NEXT[state]
                put(state, "")
            elif initial == "K":
                kept_roles.append(roles[at])
                kept_texts.append(texts[at])
            elif initial == "R":
                put(after, texts[at])
        state = after
        at += code != GONE
    while last and state in (AFTER_S, AFTER_U):
        state = NEXT[state]
        audit.append("I")
        cost += INSERT
        put(state, "")
    return "".join(audit), cost, kept_roles, kept_texts


# ---------------------------------------------------------------- turns in order, cut into chunks

def turns_of(conversations: DataFrame, copies: Column | None = None) -> DataFrame:
    """The columns that the repair reads; ``copies`` says how often a row stands there, once if not given."""
    return conversations.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("long").alias("copies"))


def repeated_turns(turns: DataFrame) -> DataFrame:
    """Roles and texts that several turns of a conversation have, with the first of these turns.

    Rows are merged before the exchange and only digests of texts are moved, so a text that fills a third of the
    rows is a row per task.
    """
    said = turns.where((F.col("copies") > 0) & (F.btrim("text", F.lit(WHITE)) != ""))
    merged = said.groupBy("conv_id", "role", digest()).agg(
        F.min("turn").alias("first_turn"), F.max("turn").alias("_last"), F.count("turn").alias("_known"), F.count(F.lit(1)).alias("_all"))
    no_turn = F.col("_known") < F.col("_all")
    several = F.when(no_turn, F.col("_known") > 0).otherwise(F.col("first_turn") < F.col("_last"))
    found = merged.where(several).select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "first_turn", no_turn.alias("no_turn"))
    return written(found, "repeated-turns")


def digest() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")


def chunk_schema(conv: T.DataType) -> T.StructType:
    counts = "n blank duplicate truncated illegal n_turns min_turn max_turn".split()
    return T.StructType([
        T.StructField("conv_id", conv), T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()),
        T.StructField("open", T.BooleanType()), *[T.StructField(name, T.LongType()) for name in counts],
        T.StructField("first_initial", T.StringType()), T.StructField("last_initial", T.StringType()),
        T.StructField("codes", T.BinaryType()), T.StructField("roles", T.ArrayType(T.StringType())),
        T.StructField("texts", T.ArrayType(T.StringType()))])


class Chunk:
    """Turns of one conversation that follow each other."""

    def __init__(self, conv, seq: int, goes_on: bool):
        self.conv, self.seq, self.goes_on, self.bytes = conv, seq, goes_on, 0
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.n_turns = 0
        self.min_turn = self.max_turn = self.first = self.last = None
        self.codes, self.roles, self.texts = bytearray(), [], []

    def add(self, turn, role: str, text: str, seen: bool) -> None:
        initial = role[:1]
        if self.n and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.first, self.last = (initial if self.first is None else self.first), initial
        if turn is not None and turn != self.max_turn:
            self.min_turn, self.max_turn = (turn if self.min_turn is None else self.min_turn), turn
            self.n_turns += 1
        self.n += 1
        body = text.rstrip(WHITE)
        code = GONE
        if not body:
            self.blank += 1
        elif seen:
            self.duplicate += 1
        else:
            code = CLASSES.get(initial, 0)
            if body[-1] not in ".!?":
                self.truncated += 1
                code |= TRUNCATED
            self.roles.append(role)
            self.texts.append(text)
            self.bytes += len(text) + len(role)
        self.codes.append(code)

    def full(self, turns: int) -> bool:
        return self.n >= turns or self.bytes >= CHUNK_BYTES

    def row(self, part: int, open_: bool) -> tuple:
        return (self.conv, part, self.seq, open_, self.n, self.blank, self.duplicate, self.truncated, self.illegal, self.n_turns,
                self.min_turn, self.max_turn, self.first, self.last, bytes(self.codes), self.roles, self.texts)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(column), field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def chunks_of(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """All conversations as written chunks of turns in order.

    Turns are dealt by ranges, so a conversation that holds a third of all rows lies in many tasks, each of which
    streams its rows. ``part`` and ``seq`` number the chunks in order; they are ``open`` where their conversation
    may have others.
    """
    repeats = repeated_turns(turns)
    same = turns["conv_id"].eqNullSafe(repeats["_conv"]) & (turns["role"] == repeats["_role"]) & (digest() == repeats["_digest"])
    seen = F.when(F.col("no_turn"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first_turn"))
    flagged = turns.join(repeats, same, "left").select("conv_id", "turn", "role", "text", "copies", F.coalesce(seen, F.lit(False)).alias("seen"))
    ranged = flagged.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, RANGE_CHARS))
    ordered = ranged.sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = chunk_schema(turns.schema["conv_id"].dataType)
    fields = arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        chunk, before, rows, held = None, None, [], 0
        for batch in batches:
            for conv, turn, role, text, copies, seen in zip(*(column.to_pylist() for column in batch.columns)):
                if chunk is None or conv != chunk.conv:
                    if chunk is not None:
                        rows.append(chunk.row(part, chunk.goes_on))
                        held += chunk.bytes + 200
                    first = chunk is None
                    chunk, before = Chunk(conv, 0 if first else chunk.seq + 1, first), None
                for _ in range(copies):
                    if chunk.full(chunk_turns):
                        rows.append(chunk.row(part, True))
                        held += chunk.bytes + 200
                        chunk = Chunk(conv, chunk.seq + 1, True)
                    chunk.add(turn, role, text, seen or before == (turn, role, text))
                    before = turn, role, text
                    if held >= SEND_BYTES:
                        yield batch_of(rows, fields)
                        rows, held = [], 0
                if held >= SEND_BYTES:
                    yield batch_of(rows, fields)
                    rows, held = [], 0
        if chunk is not None:
            rows.append(chunk.row(part, True))
        if rows:
            yield batch_of(rows, fields)

    return written(ordered.mapInArrow(cut, schema), "conversation-chunks")


# ---------------------------------------------------------------- speculation, fix-up passes, stitching

RUNS = "part int, seq int, fed int, left int, exits binary, trail binary"


def runs_from(fed: DataFrame) -> DataFrame:
    """A backward run of each chunk in ``fed`` (conv_id, part, seq, codes, fed and the first run's trail, if there is one)."""
    schema = T.StructType([fed.schema["conv_id"], fed.schema["codes"], *T.StructType.fromDDL(RUNS)])
    fields = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, codes, part, seq, vector, trail in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "codes", "part", "seq", "fed", "trail"))):
                found = backward(codes, vector, trail)
                rows.append((conv, codes, part, seq, vector, found[0], exits(codes, found), found))
            if rows:
                yield batch_of(rows, fields)

    return fed.mapInArrow(run, schema)


def stitched(chunks: DataFrame) -> DataFrame:
    """``part, seq, fed, entry, last`` of every open chunk: true vector at its end, state before it, whether none follows.

    A pass feeds every chunk what chunks of its conversation handed on in the pass before and nobody was fed yet; the
    number of passes is bounded by that of vectors, not by the length of a conversation.
    """
    open_chunks = chunks.where("open").select("conv_id", "part", "seq", "codes")
    first = written(runs_from(open_chunks.withColumns({"fed": F.lit(FINAL), "trail": F.lit(None).cast("binary")})), "conversation-runs")
    made, latest, fed = [first], first, first.select("conv_id", "fed").distinct()
    for _ in VECTORS:
        handed = latest.select(F.col("conv_id").alias("_conv"), F.col("left").alias("_fed")).distinct()
        known = handed["_conv"].eqNullSafe(fed["conv_id"]) & (handed["_fed"] == fed["fed"])
        new = written(handed.join(fed, known, "left_anti"), "conversation-vectors")
        if new.isEmpty():
            break
        rerun = first.join(new, first["conv_id"].eqNullSafe(new["_conv"])).select(
            "conv_id", "part", "seq", "codes", F.col("_fed").alias("fed"), "trail")
        latest = written(runs_from(rerun), "conversation-runs")
        made.append(latest)
        fed = fed.unionByName(new.select(F.col("_conv").alias("conv_id"), F.col("_fed").alias("fed")))
    runs = made[0]
    for more in made[1:]:
        runs = runs.unionByName(more)

    def stitch(table: pa.Table) -> pa.Table:
        run = {}
        for part, seq, vector, left, exit_ in zip(*(table.column(c).to_pylist() for c in ("part", "seq", "fed", "left", "exits"))):
            run[part, seq, vector] = left, exit_
        order = sorted({key[:2] for key in run})
        vectors, vector = [], FINAL
        for key in reversed(order):
            vectors.append(vector)
            vector = run[*key, vector][0]
        rows, state = [], START
        for i, (key, vector) in enumerate(zip(order, reversed(vectors))):
            rows.append((*key, vector, state, i == len(order) - 1))
            state = run[*key, vector][1][state]
        return pa.Table.from_batches([batch_of(rows, fields)])

    schema = T.StructType.fromDDL("part int, seq int, fed int, entry int, last boolean")
    fields = arrow_schema(schema)
    return written(runs.select("conv_id", "part", "seq", "fed", "left", "exits").groupBy("conv_id").applyInArrow(stitch, schema),
                   "conversation-plan")


def repaired_pieces(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """Every chunk with its counts, its edits (``audit``, ``cost``) and the ``roles`` and ``texts`` that they leave.

    Chunks follow each other by ``part`` and ``seq``; one that is not ``open`` is a whole conversation.
    """
    chunks = chunks_of(turns, chunk_turns)
    plan = stitched(chunks).withColumnsRenamed({"part": "_part", "seq": "_seq"})
    same = (chunks["part"] == plan["_part"]) & (chunks["seq"] == plan["_seq"])
    planned = chunks.join(plan, same, "left").drop("_part", "_seq")
    planned = planned.fillna({"fed": FINAL, "entry": START, "last": True})
    carried = [f for f in chunks.schema if f.name not in ("codes", "roles", "texts")]
    schema = T.StructType([*carried, *T.StructType.fromDDL("audit string, cost long, roles array<string>, texts array<string>")])
    fields = arrow_schema(schema)

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            same = list(zip(*(batch.column(f.name).to_pylist() for f in carried)))
            found = zip(*(batch.column(c).to_pylist() for c in ("codes", "fed", "entry", "roles", "texts", "last")))
            for own, chunk in zip(same, found):
                rows.append((*own, *traced(*chunk)))
                held += 200 + sum(map(len, rows[-1][-1]))
                if held >= SEND_BYTES:
                    yield batch_of(rows, fields)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows, fields)

    return planned.mapInArrow(trace, schema)


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """``conv_id, part, seq, place, role, text``: the repaired conversations, in that order."""
    pairs = F.arrays_zip("roles", "texts")
    return pieces.select("conv_id", "part", "seq", F.posexplode(pairs).alias("place", "_pair")).select(
        "conv_id", "part", "seq", "place", F.col("_pair.roles").alias("role"), F.col("_pair.texts").alias("text"))


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def report(pieces: DataFrame) -> DataFrame:
    """One row per conversation: what was wrong, the edits and the digest of what they leave.

    Conversations of one chunk are reported where they are. Of the others, one row per chunk is moved; they are
    added up and hashed as a stream in their order.
    """
    lines = F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text))
    joined = pieces.withColumn("body", F.array_join(lines, "\n")).withColumn("kept", F.size("roles"))
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("n_turns"), F.lit(0)).alias("gaps")
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]
    closed = joined.where(~F.col("open")).select(
        "conv_id", gaps, *sums, "audit", F.sha2(F.col("body").cast("binary"), 256).alias("repaired_sha256"))
    needed = ["conv_id", "part", "seq", "n", "n_turns", "min_turn", "max_turn", "first_initial", "last_initial", *sums, "audit", "body", "kept"]
    moved = joined.where("open").select(*needed).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    schema = T.StructType([pieces.schema["conv_id"], *T.StructType.fromDDL(REPORT)])
    fields = arrow_schema(schema)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for batch in batches:
            rows = []
            for piece in batch.to_pylist():
                if whole is None or piece["conv_id"] != whole.conv:
                    if whole is not None:
                        rows.append(whole.row())
                    whole = Whole(piece["conv_id"])
                whole.add(piece)
            if rows:
                yield batch_of(rows, fields)
        if whole is not None:
            yield batch_of([whole.row()], fields)

    return closed.unionByName(moved.mapInArrow(add_up, schema))


class Whole:
    """The chunks of one conversation added up."""

    def __init__(self, conv):
        self.conv, self.hash, self.audit, self.kept = conv, hashlib.sha256(), [], 0
        self.turns, self.least, self.most, self.last = 0, None, None, None
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)

    def add(self, piece: dict) -> None:
        for name in self.sums:
            self.sums[name] += piece[name]
        if piece["n"]:
            if self.last is not None and self.last + piece["first_initial"] not in ("su", "ua", "au"):
                self.sums["illegal"] += 1
            self.last = piece["last_initial"]
        if piece["min_turn"] is not None:
            self.turns += piece["n_turns"] - (piece["min_turn"] == self.most)
            self.least, self.most = (piece["min_turn"] if self.least is None else self.least), piece["max_turn"]
        if piece["kept"]:
            self.hash.update((b"\n" if self.kept else b"") + piece["body"].encode())
            self.kept += piece["kept"]
        self.audit.append(piece["audit"])

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        sums = self.sums
        return (self.conv, gaps, sums["blank"], sums["duplicate"], sums["truncated"], sums["illegal"], sums["cost"],
                "".join(self.audit), self.hash.hexdigest())
