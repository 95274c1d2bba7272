"""Nearest neighbours from a forest of hash prefixes, held as sorted arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countyloom.llm.common import checkpointed
from countyloom.llm.vectors import matrix, usable


@dataclass(frozen=True)
class Settings:
    """Each block of about `block_rows` vectors has a forest of its own, of `trees` sorted arrays of `bits`-bit strings.

    A query ascends until its ranges in a block's trees hold `share` of the block's rows in all, repeats counted, and
    `least` rows at least.
    """

    neighbours: int = 10
    trees: int = 64
    bits: int = 32
    share: float = 1.0
    least: int = 4096
    block_rows: int = 8192
    query_rows: int = 2048
    seed: int = 5


class Forest:
    """Sorted hash strings of one block's vectors: bit by bit the sides of random planes through the block's mean."""

    def __init__(self, rows: np.ndarray, settings: Settings):
        self.rows, self.settings = rows, settings
        rng = np.random.default_rng(settings.seed)
        self.planes = rng.normal(size=(settings.trees, rows.shape[1], settings.bits))
        self.mean = rows.mean(axis=0)
        hashed = self.strings(rows)
        self.order = np.argsort(hashed, axis=1, kind="stable")
        self.sorted = np.take_along_axis(hashed, self.order, axis=1)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        weights = np.uint64(1) << np.arange(self.settings.bits - 1, -1, -1, dtype=np.uint64)
        return np.stack([(((vectors - self.mean) @ p) > 0).astype(np.uint64) @ weights for p in self.planes])

    def candidates(self, queries: np.ndarray):
        """Positions of each query's candidates.

        Every prefix length of a query's string is a range of the sorted array. All trees ascend together from their longest
        prefixes to the first length at which their ranges hold enough rows.
        """
        asked, bits = self.strings(queries), self.settings.bits
        low = np.empty((bits + 1, len(self.planes), len(queries)), np.int64)
        high = np.empty_like(low)
        for tree, (own, sorted_) in enumerate(zip(asked, self.sorted, strict=True)):
            for length in range(bits + 1):
                rest = np.uint64(bits - length)
                first = (own >> rest) << rest
                low[length, tree] = np.searchsorted(sorted_, first)
                high[length, tree] = np.searchsorted(sorted_, first + (np.uint64(1) << rest) - np.uint64(1), side="right")
        wanted = min(max(self.settings.share * len(self.rows), self.settings.least), len(self.planes) * len(self.rows))
        enough = (high - low).sum(axis=1) >= wanted
        depth = bits - np.argmax(enough[::-1], axis=0)
        for q, d in enumerate(depth):
            found = np.zeros(len(self.rows), bool)
            for tree in range(len(self.planes)):
                found[self.order[tree, low[d, tree, q] : high[d, tree, q]]] = True
            yield np.flatnonzero(found)


def nearest(table: DataFrame, is_query: Column, settings: Settings = Settings()) -> DataFrame:
    """For each row of `table` that `is_query` picks, its nearest other rows: query_id, rank (from 1), vec_id, score.

    The score is the Euclidean distance of the original vectors in double precision; ties go to the smaller vec_id. Rows
    with null ids, and vectors that are null, empty, zero or not finite, neither ask nor answer; vectors of different
    lengths never meet. A row is not its own neighbour, nor are repeated rows of its vec_id. Of equal vectors only the first
    by id can be among the neighbours, so the index holds just those, however many there are. Queries meet the index in
    cells of bounded size, a block of queries and a block of rows. An empty table gives no rows.
    """
    rows = usable(table)
    asked = usable(table.where(is_query)).select(F.col("vec_id").alias("query_id"), "vector", "dim")
    # A query's own rows may stand among the copies, so one more than asked for is kept of each.
    copies = Window.partitionBy("same").orderBy("vec_id")
    distinct = rows.dropDuplicates(["vec_id", "same"]).withColumn("copy", F.row_number().over(copies))
    index = checkpointed(distinct.where(F.col("copy") <= settings.neighbours + 1).select("vec_id", "vector", "dim"))
    asked = checkpointed(asked)
    blocks = max(1, -(-index.count() // settings.block_rows))
    batches = max(1, -(-asked.count() // settings.query_rows))
    own = lambda name, n: F.pmod(F.xxhash64(F.lit("block"), name), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("*", own("query_id", batches).alias("batch"), every(blocks).alias("block"))
    right = index.select("*", own("vec_id", blocks).alias("block"), every(batches).alias("batch"))
    keys = ["dim", "block", "batch"]
    cells = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    found = cells.applyInPandas(lambda q, r: _search(q, r, settings), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= settings.neighbours)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(queries: pd.DataFrame, rows: pd.DataFrame, settings: Settings) -> pd.DataFrame:
    """The nearest rows of one cell."""
    out = []
    if len(queries) and len(rows):
        dim = int(rows["dim"].iloc[0])
        rows = rows.sort_values("vec_id")
        ids, vectors, asked = rows["vec_id"].to_numpy(), matrix(rows["vector"], dim), matrix(queries["vector"], dim)
        forest = Forest(vectors, settings)
        for own, query, near in zip(queries["query_id"], asked, forest.candidates(asked), strict=True):
            near = near[ids[near] != own]
            score = np.sqrt(((vectors[near] - query) ** 2).sum(axis=1))
            first = np.lexsort((ids[near], score))[: settings.neighbours]
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids[near[first]], "score": score[first]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
