"""Mixing sources to target weights by Pfair scheduling of their blocks."""

from __future__ import annotations

import heapq
import math
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countyloom.llm.common import number_rows

#: Sources up to which their first numbers are broadcast.
FEW_SOURCES = 256
#: Slots up to which a schedule that repeats is worked out once; it is the same either way.
PERIOD = 4096
#: Blocks of a source in one row of the plan, and blocks up to which the plan (32 bytes each) is broadcast.
PLAN_BLOCKS, BROADCAST_BLOCKS = 1024, 4_000_000


@dataclass(frozen=True)
class Turn:
    """Source `source` gets slot `slot` of a phase, or of each period of it, for the block with number `turn` there."""

    source: int
    turn: int
    slot: int


@dataclass(frozen=True)
class Phase:
    """Slots from `start` on, as long as every source named in `quanta` has blocks.

    `quanta` are whole numbers in the exact ratio of the weights. `order` has the source of each slot, of one period (the sum
    of the quanta) if `repeats`, else of the whole phase.
    """

    start: int
    quanta: dict[int, int]
    first: dict[int, int]
    last: dict[int, int]
    order: np.ndarray
    repeats: bool

    def slots(self) -> dict[int, np.ndarray]:
        """The slots of each source in `order`."""
        by_source = np.argsort(self.order, kind="stable")
        names, starts = np.unique(self.order[by_source], return_index=True)
        return dict(zip(names.tolist(), np.split(by_source, starts[1:]), strict=True))

    @property
    def turns(self) -> tuple[Turn, ...]:
        return tuple(sorted((Turn(s, j, int(x)) for s, own in self.slots().items() for j, x in enumerate(own)), key=lambda t: t.slot))


def quanta_of(weights: dict[int, float]) -> dict[int, int]:
    """The least whole numbers in the exact ratio of the weights; a float is a fraction."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    whole = {s: x.numerator * (scale // x.denominator) for s, x in exact.items()}
    common = math.gcd(*whole.values())
    return {s: n // common for s, n in whole.items()}


def order_of(quanta: dict[int, int], blocks: dict[int, int], period: int) -> tuple[np.ndarray, bool]:
    """The source of each slot until one has got all its blocks; or one period and True, if that is at most `period` slots.

    Block j (from 0) of a source with q of Q quanta is released at floor(jQ / q) and due by ceil((j + 1)Q / q); each slot goes
    to the released block that is due first, ties to the smaller source.
    """
    total = sum(quanta.values())
    waiting = [(0, s, 0) for s in quanta]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    order = array("i")
    while True:
        while waiting and waiting[0][0] <= len(order):
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // quanta[s]), s, j))
        _, s, j = heapq.heappop(ready)
        order.append(s)
        if j + 1 == blocks[s]:
            return np.array(order), False
        if len(order) == total <= period:
            return np.array(order), True
        heapq.heappush(waiting, ((j + 1) * total // quanta[s], s, j + 1))


def phases_of(blocks: dict[int, int], weights: dict[int, float], period: int = PERIOD) -> Iterator[Phase]:
    """Schedules all blocks. When a source has none left, a new phase shares the slots among the others by their weights."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done, start = dict.fromkeys(left, 0), 0
    exact = quanta_of({s: weights[s] for s in left}) if left else {}
    while left:
        common = math.gcd(*(exact[s] for s in left))
        quanta = {s: exact[s] // common for s in left}
        order, repeats = order_of(quanta, left, period)
        phase = Phase(start, quanta, {s: done[s] for s in left}, {}, order, repeats)
        slots, size = phase.slots(), len(order)
        given = {s: len(slots.get(s, ())) for s in left}
        if repeats:
            size = 1 + min((n - 1) // quanta[s] * len(order) + int(slots[s][(n - 1) % quanta[s]]) for s, n in left.items())
            whole, part = divmod(size, len(order))
            given = {s: whole * quanta[s] + int(np.searchsorted(slots[s], part)) for s in left}
        phase.last.update({s: done[s] + given[s] for s in left})
        yield phase
        done |= phase.last
        start += size
        left = {s: n - given[s] for s, n in left.items() if n > given[s]}


def plan_rows(phases: Iterator[Phase]) -> Iterator[tuple[int, int, list[int], list[int], list[int], list[float]]]:
    """(source, chunk, positions, releases, deadlines, targets) of each PLAN_BLOCKS blocks of a source."""
    found: dict[int, list[tuple[np.ndarray, ...]]] = defaultdict(list)
    for phase in phases:
        total = sum(phase.quanta.values())
        for s, own in phase.slots().items():
            n, q = phase.last[s] - phase.first[s], phase.quanta[s]
            j = np.arange(n)
            at = j // len(own) * len(phase.order) + own[j % len(own)]
            release = np.fromiter((k * total // q for k in range(n)), np.int64, n)
            due = np.fromiter((-(-(k + 1) * total // q) for k in range(n)), np.int64, n)
            found[s].append((phase.start + at, phase.start + release, phase.start + due, np.full(n, q / total)))
    for s, parts in found.items():
        whole = [np.concatenate(column) for column in zip(*parts, strict=True)]
        for chunk, first in enumerate(range(0, len(whole[0]), PLAN_BLOCKS)):
            yield s, chunk, *(column[first : first + PLAN_BLOCKS].tolist() for column in whole)


def mix_sources(
    docs: DataFrame, weight: Callable[[str | None, int], float], block_rows: int = 64, period: int = PERIOD
) -> DataFrame:
    """`docs` with its place in the mixture: `block` (from 0 in its source), `release`, `deadline` and `position` of the block's
    slot, `offset` in the block, and `target`, the source's share of the slots in that phase.

    `weight(source, rows)` is a source's target weight, above zero. Blocks are `block_rows` rows of a source in a hashed order
    (the last may be shorter); repeated rows are rows of their own, and null is a source of its own. Within a phase, however
    long, the slots a source has got differ from its share by its weight by less than one block. Every row is kept: a phase
    ends when a source does, and the rest share its slots. The driver places the blocks, not the rows, for any number of
    sources (its time grows with their square if all end apart). An empty table gives no rows; columns of these names in
    `docs` are replaced.
    """
    added = ("block", "release", "deadline", "position", "offset", "target")
    docs = docs.drop(*added, "_n")
    spark = docs.sparkSession
    counts = sorted(docs.groupBy("source").count().collect(), key=lambda r: (r["source"] is not None, r["source"]))
    names = [r["source"] for r in counts]
    rows = {i: r["count"] for i, r in enumerate(counts)}
    weights = {i: float(weight(names[i], n)) for i, n in rows.items()}
    if any(not (w > 0 and math.isfinite(w)) for w in weights.values()):
        raise ValueError("a target weight must be a number above zero")
    blocks = {i: -(-n // block_rows) for i, n in rows.items()}
    plan = spark.createDataFrame(
        [(names[s], *row) for s, *row in plan_rows(phases_of(blocks, weights, period))],
        "_source string, _chunk long, _position array<long>, _release array<long>, _deadline array<long>, _target array<double>",
    )
    plan = F.broadcast(plan) if sum(blocks.values()) <= BROADCAST_BLOCKS else plan
    order = [c for c in ("doc_id", "n_chars") if c in docs.columns]
    numbered = number_rows(docs, "source", order, "_n", few=len(names) <= FEW_SOURCES).withColumn("block", F.floor(F.col("_n") / block_rows))
    placed = numbered.withColumn("_of", F.floor(F.col("block") / PLAN_BLOCKS)).join(
        plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_of") == F.col("_chunk"))
    )
    own = lambda name: F.get(f"_{name}", (F.col("block") % PLAN_BLOCKS).cast("int")).alias(name)
    return placed.select(
        *docs.columns,
        "block",
        own("release"),
        own("deadline"),
        own("position"),
        (F.col("_n") % block_rows).alias("offset"),
        own("target"),
    )


def tempered(power: float = 0.5) -> Callable[[str | None, int], float]:
    """Target weights that grow as the rows of a source to a power: below 1, small sources come up more often than they weigh."""
    return lambda source, rows: rows**power


def mixed_order(docs: DataFrame, weight: Callable[[str | None, int], float], block_rows: int = 64) -> DataFrame:
    """All rows of `docs` in the order of the mixture: the rows of the files, one file after another."""
    mixed = mix_sources(docs, weight, block_rows)
    return mixed.repartitionByRange("position", "offset").sortWithinPartitions("position", "offset").select(docs.columns)
