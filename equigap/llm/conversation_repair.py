"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation's rows, in order of their turns, are edited until their roles
read: nothing, or an optional system row and then user and assistant in turn.
A row may be kept (0), given the user's or assistant's role (2) or deleted
(3); a user or assistant row without text may be inserted anywhere (2).
Blank rows and repeats of an earlier row must go, and a row left truncated
costs 1 more.  The cheapest edits are wanted, and of these the ones whose
initials (the *audit*) are least in ASCII.

Four states say what the roles so far end in: nothing, system, user or
assistant.  A forward vector holds, for each state, the least cost to get
there and the rank of its least audit among the states' (audits of the same
rows are free of prefixes, so ranks can be carried from row to row without
the strings); a backward vector holds the least cost from each state to the
end.  The two meet in the middle of the conversation; of the crossings with
the least total cost the one whose forward audit ranks first is taken, and
both halves are solved in the same way between fixed states.  Space is linear
in the rows, whatever their audits are.

A conversation of any length is spread over tasks: its rows stand in chunks
of ``CHUNK``, numbered by ordinals over range partitions.  A chunk is
summarised by four forward vectors, one from each state; per conversation the
summaries (a row per CHUNK rows) say in which states the cheapest, audit-least
edits cross the chunks' borders, and each chunk is then solved on its own.
What travels to be solved is a byte a row, never texts.

Defined cases: null roles and texts are one space, a null conversation id is
a conversation, null turns come first; rows of one turn follow role and text
(their first 32 characters, then digests); roles count by their first letter,
and a role with another one can only be changed or deleted; a conversation
without rows is in order; texts of any length travel once per shuffle; an
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import Scratch, shuffle_partitions

CHUNK = 4096
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
# Costs of the edits, and ASCII white space.
RENAME, DELETE, INSERT, LEFT_TRUNCATED = 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"
INITIALS = "sua"
#: Which role initial may follow which.
LEGAL = {"su", "ua", "au"}
#: A row's code: its role initial's place in INITIALS (3: another), thrice, and its fault.
SOUND, TRUNCATED, GONE = range(3)
NEVER = 1 << 60


def after(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if state == USER else None


def turn_of(state: int) -> str:
    """The initial that may come next, but for a first system row."""
    return "a" if state == USER else "u"


def blocks(code: int, p: int) -> dict[int, tuple[int, str, str, str]]:
    """For each state that a row can lead to from ``p``: least cost, audit (inserted
    rows, then the row's own edit), initials inserted before the row, and what
    becomes of its role (= as it is, - gone, else its initial)."""
    role, fault = divmod(code, 3)
    found: dict[int, list] = {}
    state, inserted = p, ""
    for n in range(3):  # two inserted rows lead from any state to any that more would
        options = [(DELETE, "D", "-", state)]
        if fault != GONE:
            more, turn = LEFT_TRUNCATED * (fault == TRUNCATED), turn_of(state)
            options.append((RENAME + more, "R", turn, after(state, turn)))
            if role < 3 and after(state, INITIALS[role]) is not None:
                options.append((more, "K", "=", after(state, INITIALS[role])))
        for cost, letter, becomes, q in options:
            found.setdefault(q, []).append((cost + INSERT * n, "I" * n + letter, inserted, becomes))
        turn = turn_of(state)
        state, inserted = after(state, turn), inserted + turn
    return {q: min(x) for q, x in found.items()}


STEPS = [[blocks(code, p) for p in STATES] for code in range(12)]
#: What must be inserted behind the last row: initials by state.
TAIL = {NOTHING: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}

Vector = tuple  # of (cost, rank) by state, the least cost being 0; a cost of NEVER: out of reach


def start_vector(p: int) -> Vector:
    return tuple((0, 0) if q == p else (NEVER, 0) for q in STATES)


@lru_cache(1 << 16)
def forward_step(vector: Vector, code: int) -> tuple[Vector, int]:
    """The vector behind one more row, and the cost taken out of it."""
    best: dict[int, tuple] = {}
    for p, (cost, rank) in enumerate(vector):
        if cost < NEVER:
            for q, (more, audit, *_) in STEPS[code][p].items():
                best[q] = min(best.get(q, (NEVER,)), (cost + more, rank, audit))
    low = min(b[0] for b in best.values())
    order = sorted(best, key=lambda q: best[q][1:])
    return tuple((best[q][0] - low, order.index(q)) if q in best else (NEVER, 0) for q in STATES), low


@lru_cache(1 << 16)
def backward_step(costs: tuple, code: int) -> tuple[tuple, int]:
    best = [min((more + costs[q] for q, (more, *_) in STEPS[code][p].items() if costs[q] < NEVER), default=NEVER) for p in STATES]
    low = min(best)
    return tuple(b - low if b < NEVER else NEVER for b in best), low


def forward(codes: bytes, vector: Vector) -> tuple[Vector, int]:
    total = 0
    for code in codes:
        vector, low = forward_step(vector, code)
        total += low
    return vector, total


def backward(codes: bytes, q: int) -> tuple:
    costs = tuple(0 if p == q else NEVER for p in STATES)
    for code in reversed(codes):
        costs, _ = backward_step(costs, code)
    return costs


def last_state(vector: Vector) -> int:
    return min((cost + INSERT * len(TAIL[q]), rank, q) for q, (cost, rank) in enumerate(vector) if cost < NEVER)[2]


@lru_cache(1 << 14)
def solve(codes: bytes, p: int, q: int | None) -> tuple[list, int]:
    """The edits of the rows from state ``p`` to ``q`` (None: to the end, where the
    roles must be whole): STEPS' entries by row, and the last state."""
    if q is None:
        q = last_state(forward(codes, start_vector(p))[0])
    edits, open_ = [None] * len(codes), [(0, len(codes), p, q)]
    while open_:
        low, high, p_, q_ = open_.pop()
        if high - low == 1:
            edits[low] = STEPS[codes[low]][p_][q_]
        elif high > low:
            mid = (low + high) // 2
            ahead, back = forward(codes[low:mid], start_vector(p_))[0], backward(codes[mid:high], q_)
            x = min((cost + back[s], rank, s) for s, (cost, rank) in enumerate(ahead) if cost < NEVER and back[s] < NEVER)[2]
            open_ += [(low, mid, p_, x), (mid, high, x, q_)]
    return edits, q


def summary(codes: bytes) -> list[int]:
    """Costs and ranks from each state to each, 32 numbers."""
    out = []
    for p in STATES:
        vector, total = forward(codes, start_vector(p))
        out += [n for cost, rank in vector for n in (cost + total if cost < NEVER else NEVER, rank)]
    return out


def crossings(summaries: list[list[int]]) -> list[tuple[int, int]]:
    """The states before and behind each of a conversation's chunks."""
    back = [[INSERT * len(TAIL[q]) for q in STATES]]
    for s in reversed(summaries):
        back.append([min(s[8 * p + 2 * q] + back[-1][q] for q in STATES) for p in STATES])
    back.reverse()
    out, p = [], NOTHING
    for k, s in enumerate(summaries):
        q = min((s[8 * p + 2 * q] + back[k + 1][q], s[8 * p + 2 * q + 1], q) for q in STATES if s[8 * p + 2 * q] < NEVER)[2]
        out.append((p, q))
        p = q
    return out


def ordered(rows: DataFrame, scratch: Scratch, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """k (a string per conversation), conv, pos, turn, role, text, digest."""
    key = F.coalesce(F.concat(F.lit("c"), F.col(conv).cast("string")), F.lit("-")).alias("k")
    rows = rows.select(key, F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                       *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    rows = rows.withColumns({"digest": F.unhex(F.md5("text")), "head": F.substring("text", 1, 32)})
    placed = scratch.ordinals(rows, "rows", ["k"], ["turn", "role", "head", "digest"])
    return scratch.write(placed.select("k", "conv", F.col("ordinal").alias("pos"), "turn", "role", "text", "digest"), "ordered")


def row_codes(rows: DataFrame) -> DataFrame:
    """k, pos, fault (blank, duplicate, truncated or null), code."""
    bare = F.rtrim("text", F.lit(SPACE))
    own = rows.select("k", "pos", F.substring("role", 1, 1).alias("initial"), F.md5("role").alias("r"), "digest",
                      (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    # The first row of each (conversation, role, text) by a minimum, combined before the shuffle.
    first = own.groupBy(F.col("k").alias("f_k"), F.col("r").alias("f_r"), F.col("digest").alias("f_digest")).agg(F.min("pos").alias("first"))
    told = own.join(first, F.expr("k = f_k and r = f_r and digest = f_digest"))
    fault = F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate").when(F.col("cut"), "truncated")
    place = F.instr(F.lit(INITIALS), F.col("initial"))
    role = F.when((place == 0) | (F.col("initial") == ""), 3).otherwise(place - 1)
    return told.select("k", "pos", fault.alias("fault"), role.alias("role")).select(
        "k", "pos", "fault", (F.col("role") * 3 + F.when(F.col("fault") == "truncated", TRUNCATED).when(F.col("fault").isNull(), SOUND).otherwise(GONE)).cast("int").alias("code"))


def chunk_edits(codes: DataFrame, scratch: Scratch, chunk: int) -> DataFrame:
    """k, chunk, illegal (pairs of neighbours), cost, audit, before (initials inserted
    before each row), becomes (a letter a row), tail (initials behind the last)."""
    chunks = codes.groupBy("k", F.floor(F.col("pos") / chunk).alias("chunk")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]).alias("codes"))
    chunks = scratch.write(chunks, "chunks")
    by = Window.partitionBy("k").orderBy("chunk")  # a row per chunk
    chunks = scratch.write(chunks.withColumns({"last_code": F.lag(F.element_at("codes", -1)).over(by), "final": F.lead("chunk").over(by).isNull()}), "linked")

    # Conversations of several chunks: the states at the chunks' borders.
    def summarise(batches):
        for batch in batches:
            told = [summary(bytes(c)) for c in batch.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("chunk"), pa.array(told, pa.list_(pa.int64()))], names=["k", "chunk", "told"])

    def cross(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk")
        found = crossings([list(x) for x in frame["told"]])
        return pd.DataFrame({"x_k": frame["k"], "x_chunk": frame["chunk"], "p": [a for a, _ in found], "q": [b for _, b in found]})

    several = chunks.where("chunk > 0 or not final").select("k", "chunk", "codes").mapInArrow(summarise, "k string, chunk long, told array<long>")
    borders = scratch.write(several.groupBy("k").applyInPandas(cross, "x_k string, x_chunk long, p int, q int"), "borders")
    chunks = chunks.join(borders, F.expr("k = x_k and chunk = x_chunk"), "left").drop("x_k", "x_chunk")

    def edit(batches):
        for batch in batches:
            out = []
            for codes, last, final, p, q in zip(*(batch.column(c).to_pylist() for c in ("codes", "last_code", "final", "p", "q"))):
                codes = bytes(codes)
                initials = [INITIALS[c // 3:c // 3 + 1] or "?" for c in ([last] if last is not None else []) + list(codes)]
                edits, end = solve(codes, NOTHING if p is None else p, q)
                tail = TAIL[end] if final else ""
                out.append((sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), sum(e[0] for e in edits) + INSERT * len(tail),
                            "".join(e[1] for e in edits) + "I" * len(tail), [e[2] for e in edits], "".join(e[3] for e in edits), tail))
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("chunk"), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                                             names=["k", "chunk", "illegal", "cost", "audit", "before", "becomes", "tail"])

    schema = "k string, chunk long, illegal long, cost long, audit string, before array<string>, becomes string, tail string"
    return scratch.write(chunks.mapInArrow(edit, schema), "edits")


def repaired_rows(rows: DataFrame, edits: DataFrame, chunk: int) -> DataFrame:
    """The repaired conversations' rows: k, pos (that of the row, or of the row before
    which one is inserted), part (order there), role, text, inserted."""
    name = lambda c: F.when(c == "u", "user").when(c == "a", "assistant")
    each = edits.select("k", "chunk", "becomes", F.posexplode("before").alias("at", "put")).select(
        F.col("k").alias("e_k"), (F.col("chunk") * chunk + F.col("at")).alias("e_pos"), "put", F.substring("becomes", F.col("at") + 1, F.lit(1)).alias("to"))
    new = lambda put: F.transform(F.filter(F.split(put, ""), lambda c: c != ""), lambda c, j: F.struct(
        j.alias("part"), name(c).alias("role"), F.lit("").alias("text"), F.lit(True).alias("inserted")))
    own = F.struct(F.lit(9).alias("part"), F.coalesce(name(F.col("to")), "role").alias("role"), F.col("text").alias("text"), F.lit(False).alias("inserted"))
    kept = F.when(F.col("to") == "-", new(F.col("put"))).otherwise(F.concat(new(F.col("put")), F.array(own)))
    left = rows.join(each, F.expr("k = e_k and pos = e_pos")).select("k", "pos", F.explode(kept).alias("x")).select("k", "pos", "x.*")
    last = edits.where("tail != ''").select("k", (F.col("chunk") * chunk + F.length("becomes")).alias("pos"), F.explode(new(F.col("tail"))).alias("x"))
    return left.union(last.select("k", "pos", "x.*"))


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """k, repaired_sha256: of the rows ``role:text``, newline-joined.  A digest has to
    run through its conversation in order, so each is one task's stream; no
    conversation is held in memory."""
    lines = repaired.select("k", "pos", "part", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = lines.repartition(shuffle_partitions(repaired.sparkSession), "k").sortWithinPartitions("k", "pos", "part")

    def digest(batches):
        now, sha = None, None
        for batch in batches:
            done = []
            for k, line in zip(batch.column("k").to_pylist(), batch.column("line").to_pylist()):
                if k != now:
                    if sha:
                        done.append((now, sha.hexdigest()))
                    now, sha = k, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(line.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], names=["d_k", "repaired_sha256"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([sha.hexdigest()])], names=["d_k", "repaired_sha256"])

    return lines.mapInArrow(digest, "d_k string, repaired_sha256 string")


class Repair:
    """The repair of a table of conversation rows: ``rows`` (in order), ``codes`` (each
    row's first fault), ``edits`` (by chunk) and ``repaired`` (the rows repaired)."""

    def __init__(self, conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", *, chunk: int = CHUNK):
        self.scratch = Scratch(conversations.sparkSession, "repair")
        self.rows = ordered(conversations, self.scratch, conv, turn, role, text)
        self.codes = self.scratch.write(row_codes(self.rows), "codes")
        self.edits = chunk_edits(self.codes, self.scratch, chunk)
        self.repaired = repaired_rows(self.rows, self.edits, chunk)

    def report(self, conversations: DataFrame, conv: str = "conv_id") -> DataFrame:
        """One row per id in ``conversations``, those without rows, too: ``conv``, gaps,
        blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        turns = self.rows.where("turn is not null").groupBy("k", "turn").agg(F.lit(1).alias("one")).groupBy(F.col("k").alias("t_k")).agg(
            (F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
        faults = self.codes.groupBy(F.col("k").alias("f_k")).agg(*[F.count_if(F.col("fault") == n).alias(n) for n in ("blank", "duplicate", "truncated")])
        costs = self.edits.groupBy(F.col("k").alias("c_k")).agg(
            F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"))
        digests = conversation_digests(self.repaired)
        ids = conversations.select(F.col(conv).alias("conv")).distinct()
        out = ids.withColumn("k", F.coalesce(F.concat(F.lit("c"), F.col("conv").cast("string")), F.lit("-")))
        for more, on in ((turns, "t_k"), (faults, "f_k"), (costs, "c_k"), (digests, "d_k")):
            out = out.join(more, F.col("k") == F.col(on), "left")
        number: list[Column] = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        return out.select(F.col("conv").alias(conv), *number, F.coalesce("audit", F.lit("")).alias("audit"),
                          F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
