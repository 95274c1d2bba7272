"""Repair of conversations at least cost, by bidirectional search of the lattice of edits.

A conversation is read as one letter a row: what its role begins with, whether it has to go (blank, or seen before), whether
it is cut short. On these letters, edits lead from place to place and from one state of the wanted order `(s?(ua)+)?` to
another; Dijkstra runs from both ends, and the least of the cheapest edit strings is read off where the two meet.

Spark sorts the rows of each conversation; tasks stream over them. A task holds nine bytes for each row of a conversation
(its letter, and a hash that tells repeated rows) and the search's own arrays, never the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countyloom.llm.common import checkpointed

# Costs of the edits, the neighbours that a conversation may have, white space.
RELABEL, REMOVE, ADD, CUT_SHORT = 3, 4, 3, 3
LEGAL = ("su", "ua", "au")
WHITE = r"\x20\x09-\x0D"
# End of fixed values.

#: States: nothing yet; after the system's row; after a user's row; after an assistant's row. The first and last may end.
START, OPENED, ASKED, ANSWERED = range(4)
NEXT_ROLE = {START: "user", OPENED: "user", ASKED: "assistant", ANSWERED: "user"}
_AFTER = {"user": ASKED, "assistant": ANSWERED}
_FAR = 1 << 60
#: Shapes of conversations up to this length are remembered by a worker, this many of them.
SHORT, REMEMBERED = 64, 50_000


def _row_edges(letter: str) -> list[tuple[int, int, int, str]]:
    """(state, next state, cost, edit) of what may be done to a row. Upper case letters are rows that are cut short."""
    edges = [(q, q, REMOVE, "D") for q in range(4)]
    if letter == "-":
        return edges
    more = CUT_SHORT if letter.isupper() else 0
    role = letter.lower()
    if role == "s":
        edges.append((START, OPENED, more, "K"))
    for q, wanted in NEXT_ROLE.items():
        kept = wanted[0] == role
        edges.append((q, _AFTER[wanted], more + (0 if kept else RELABEL), "K" if kept else "R"))
    return edges


_ADDED = [(q, _AFTER[wanted], ADD, "I") for q, wanted in NEXT_ROLE.items()]


@lru_cache(maxsize=None)
def _edges(letter: str) -> tuple[list, list]:
    """Edges over a row by the state they leave, as (next state, cost, edit); and by the state they reach, as (state, cost)."""
    out, back = [[] for _ in range(4)], [[] for _ in range(4)]
    for q, after, cost, edit in _row_edges(letter):
        out[q].append((after, cost, edit))
        back[after].append((q, cost))
    return out, back


def _leaving(shape: str, node: int) -> Iterator[tuple[int, int, str]]:
    at, q = divmod(node, 4)
    if at < len(shape):
        for after, cost, edit in _edges(shape[at])[0][q]:
            yield node - q + 4 + after, cost, edit
    for before, after, cost, edit in _ADDED:
        if before == q:
            yield node - q + after, cost, edit


def _entering(shape: str, node: int) -> Iterator[tuple[int, int]]:
    at, q = divmod(node, 4)
    if at:
        for before, cost in _edges(shape[at - 1])[1][q]:
            yield node - q - 4 + before, cost
    for before, after, cost, _ in _ADDED:
        if after == q:
            yield node - q + before, cost


def least_edits(shape: str) -> tuple[int, str]:
    """(cost, audit): the least cost of edits that bring a conversation into order, and the least of the cheapest strings of them.

    A letter of `shape` is a row: `-` has to go; else the role's first letter (`x` for none of s, u, a), in upper case if the
    row is cut short. Both searches go on until no pair of open places can be as cheap as the best meeting, so that every
    cheapest way crosses from settled places of one to settled places of the other.
    """
    size = 4 * (len(shape) + 1)
    ends = (size - 4 + START, size - 4 + ANSWERED)
    ahead, behind = [_FAR] * size, [_FAR] * size
    done_a, done_b = bytearray(size), bytearray(size)
    ahead[START] = 0
    front, back = [START], []  # cost * size + place
    for e in ends:
        behind[e] = 0
        heappush(back, e)
    best = _FAR
    while front and back and front[0] // size + back[0] // size <= best:
        if front[0] // size <= back[0] // size:
            cost, node = divmod(heappop(front), size)
            if done_a[node]:
                continue
            done_a[node] = 1
            best = min(best, cost + behind[node])
            for other, more, _ in _leaving(shape, node):
                if cost + more < ahead[other]:
                    ahead[other] = cost + more
                    heappush(front, (cost + more) * size + other)
        else:
            cost, node = divmod(heappop(back), size)
            if done_b[node]:
                continue
            done_b[node] = 1
            best = min(best, cost + ahead[node])
            for other, more in _entering(shape, node):
                if cost + more < behind[other]:
                    behind[other] = cost + more
                    heappush(back, (cost + more) * size + other)

    # Places of the forward search that lie on a cheapest way: those that cross over, and those that lead to them.
    def crosses(v: int) -> bool:
        if (done_b[v] or v in ends) and ahead[v] + behind[v] == best:
            return True
        return any(done_b[w] and ahead[v] + c + behind[w] == best for w, c, _ in _leaving(shape, v))

    open_ = [v for v in range(size) if done_a[v] and crosses(v)]
    good = bytearray(size)
    for v in open_:
        good[v] = 1
    while open_:
        w = open_.pop()
        for v, c in _entering(shape, w):
            if done_a[v] and not good[v] and ahead[v] + c == ahead[w]:
                good[v] = 1
                open_.append(v)

    # All places of `here` are reached by the same edits, hence at the same cost and after the same row.
    audit, spent, here = [], 0, {START}
    while not (spent == best and any(v in ends for v in here)):
        ways: dict[str, tuple[int, set[int]]] = {}
        for v in here:
            for w, c, edit in _leaving(shape, v):
                if (good[w] and spent + c == ahead[w]) or (done_b[w] and spent + c + behind[w] == best):
                    ways.setdefault(edit, (c, set()))[1].add(w)
        edit = min(ways)
        audit.append(edit)
        spent, here = spent + ways[edit][0], ways[edit][1]
    return best, "".join(audit)


_remembered = lru_cache(maxsize=REMEMBERED)(least_edits)


class _Seen:
    """Hashes met so far: a set while there are few, then sorted arrays of eight bytes each."""

    MOST = 1 << 16

    def __init__(self):
        self.new: set[int] = set()
        self.sorted: list[np.ndarray] = []

    def add(self, h: int) -> bool:
        """Whether the hash is new."""
        if h in self.new:
            return False
        for held in self.sorted:
            at = int(np.searchsorted(held, h))
            if at < len(held) and held[at] == h:
                return False
        self.new.add(h)
        if len(self.new) >= self.MOST:
            merged = np.sort(np.fromiter(self.new, np.int64, len(self.new)))
            while self.sorted and len(self.sorted[-1]) <= len(merged):
                merged = np.sort(np.concatenate([self.sorted.pop(), merged]))
            self.sorted.append(merged)
            self.new = set()
        return True


class _Conversation:
    """What is gathered of a conversation while its rows go by."""

    def __init__(self, key: str):
        self.key, self.shape, self.initial = key, bytearray(), ""
        self.seen = _Seen()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None

    def row(self, turn, initial: str, fault: str, h: int) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if self.initial and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        new = self.seen.add(h)
        if fault == "blank":
            self.blank += 1
            letter = "-"
        elif not new:
            self.duplicate += 1
            letter = "-"
        else:
            cut = fault == "truncated"
            self.truncated += cut
            letter = initial.upper() if cut else initial
        self.shape += letter.encode()

    def plan(self) -> tuple:
        shape = self.shape.decode()
        cost, audit = (_remembered if len(shape) <= SHORT else least_edits)(shape)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


_PLAN = "_key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _plans(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a conversation, from rows that come sorted by it."""
    names = [c.split(" ")[0] for c in _PLAN.split(", ")]
    now: _Conversation | None = None
    for frame in frames:
        made = []
        columns = (frame[c].tolist() for c in ("_key", "_there", "_turn", "_known", "_initial", "_fault", "_hash"))
        for key, there, turn, known, initial, fault, h in zip(*columns, strict=True):
            if now is None or key != now.key:
                if now is not None:
                    made.append(now.plan())
                now = _Conversation(key)
            if there:
                now.row(turn if known else None, initial, fault, h)
        yield pd.DataFrame(made, columns=names)
    if now is not None:
        yield pd.DataFrame([now.plan()], columns=names)


def _repaired(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edited rows, from the rows of each conversation with its edits before them."""
    key, audit, at, state, place = None, "", 0, START, 0

    def emit(edit: str, role: str, text: str) -> None:
        nonlocal place
        made.append((key, place, edit, role, text))
        place += 1

    def add_rows() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            role = NEXT_ROLE[state]
            emit("I", role, "")
            at, state = at + 1, _AFTER[role]

    names = ["_key", "place", "edit", "role", "text"]
    for frame in frames:
        made: list[tuple] = []
        columns = (frame[c].tolist() for c in ("_key", "_audit", "_there", "_role", "_text"))
        for k, edits, there, role, text in zip(*columns, strict=True):
            if edits is not None:
                add_rows()
                key, audit, at, state, place = k, edits, 0, START, 0
            if not there:
                continue
            add_rows()
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                role = NEXT_ROLE[state]
            state = OPENED if role[:1] == "s" else ASKED if state != ASKED else ANSWERED
            emit(edit, role, text)
        yield pd.DataFrame(made, columns=names)
    made = []
    add_rows()
    yield pd.DataFrame(made, columns=names)


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after the query's damage, by the checksum of conversation and turn: (conv_id, turn, role, text, there).

    A dropped row stays with `there` false, so that its conversation is known. Nulls in what is hashed, in role and in text
    are one space; a null turn stays null.
    """
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat_ws(":", texts["conv_id"], texts["turn"]).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(texts["text"], "[.!?]", "")).otherwise(texts["text"])
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    named = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(texts["role"]).alias("role"),
        text.alias("text"),
        (kind != 0).alias("there"),
        F.explode(copies).alias("copy"),
    )
    return named.drop("copy")


def _read(rows: DataFrame) -> DataFrame:
    """Rows with their conversation's key, order and faults; nulls in role and text are one space."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    there = F.col("there") if "there" in rows.columns else F.lit(True)
    named = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("_key"),
        F.coalesce(there, F.lit(True)).alias("_there"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("_turn"),
        F.col("turn").isNotNull().alias("_known"),
        role.alias("_role"),
        text.alias("_text"),
    )
    first = F.substring("_role", 1, 1)
    last = F.regexp_extract("_text", f"([^{WHITE}])[{WHITE}]*$", 1)
    return named.withColumns(
        {
            "_initial": F.when(first.isin("s", "u", "a"), first).otherwise("x"),
            "_fault": F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated").otherwise(""),
            "_hash": F.xxhash64("_role", "_text"),
        }
    )


_ORDER = ("_known", "_turn", "_role", "_hash")


def _by_conversation(rows: DataFrame, *first: Column | str) -> DataFrame:
    return rows.repartition("_key").sortWithinPartitions("_key", *first, *_ORDER)


def plan_repairs(rows: DataFrame) -> DataFrame:
    """One row a conversation: _key, gaps, counts of first faults, illegal neighbours, least cost and audit.

    `rows` have conv_id, turn, role, text; with `there`, rows where it is false only make their conversation known. Rows are
    taken by turn, nulls first; rows of one turn by role, then in an order of their texts' hashes, so that repeated rows
    stand together. A null conv_id is a conversation of its own. Other columns are ignored; an empty table gives no rows.
    """
    narrow = _read(rows).drop("_text")  # the shuffle carries no texts
    return _by_conversation(narrow).mapInPandas(_plans, _PLAN)


def repaired_rows(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The conversations after their cheapest edits: _key, place from 0, edit, role, text; by place within a partition."""
    read = _read(rows).withColumn("_audit", F.lit(None).cast("string"))
    orders = plans.select("_key", F.col("audit").alias("_audit"), F.lit(False).alias("_there"))
    both = read.unionByName(orders, allowMissingColumns=True)
    return _by_conversation(both, F.col("_audit").isNull()).mapInPandas(_repaired, "_key string, place long, edit string, role string, text string")


def _hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, state = None, None
    for frame in frames:
        made = []
        for k, place, role, text in zip(*(frame[c].tolist() for c in ("_key", "place", "role", "text")), strict=True):
            if k != key:
                if state is not None:
                    made.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            state.update((("\n" if place else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        yield pd.DataFrame(made, columns=["_key", "repaired_sha256"])
    if state is not None:
        yield pd.DataFrame([(key, state.hexdigest())], columns=["_key", "repaired_sha256"])


def digest(rows: DataFrame) -> DataFrame:
    """Each conversation's faults, cheapest edits, and a checksum of its repaired rows, as plain columns.

    The checksum of one conversation can only be read in order, so the rows of each stream through one task.
    """
    plans = checkpointed(plan_repairs(rows))
    sums = repaired_rows(rows, plans).mapInPandas(_hashed, "_key string, repaired_sha256 string")
    kind = rows.schema["conv_id"].dataType
    conv = F.when(F.col("_key") != "", F.expr("substring(_key, 2)")).cast(kind).alias("conv_id")
    whole = plans.join(sums, "_key", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return whole.select(conv, *[c for c in plans.columns if c != "_key"], F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
