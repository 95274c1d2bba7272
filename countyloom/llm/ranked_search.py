"""Ranked lexical search by range maxima over posting lists.

A task turns its documents into blocks of postings in the order of doc_id, with the greatest impact of every power-of-two range
of every posting list (a sparse table). For an item, the sum of its terms' range maxima bounds the score of every document in
an interval. Intervals are opened best first: the document where the strongest term peaks is scored exactly, and what lies
left and right of it gets bounds of its own. A document comes out when nothing open can beat it, so answers are exact, ties
included, and most documents are never scored.

No text is shuffled. Items are taken in batches of bounded size, which go to all tasks; a task returns its best k documents
of each item. Two passes over the documents serve a batch: one counts, one searches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The constants of the score.
SCALE, SATURATION, LENGTH_SHARE = 1000, 8, 90
# End of fixed values.

#: Bounds of a batch of items (rows, and bytes of their texts unless one item alone is longer) and of a block of documents.
BATCH_ITEMS, BATCH_BYTES = 2_000, 8 << 20
BLOCK_DOCS, BLOCK_TERMS = 1 << 16, 2_000_000

_LETTERS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text: runs of ASCII letters (A-Z in lower case), digits, and all characters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()


@dataclass(frozen=True)
class Statistics:
    """Documents with a term, terms of all documents, and the weight of each asked term that some document holds."""

    documents: int
    terms: int
    weights: dict[bytes, int]

    def length_factor(self, sizes: np.ndarray) -> np.ndarray:
        return 100 - LENGTH_SHARE + (LENGTH_SHARE * sizes * self.documents) // max(1, self.terms)


def count_terms(docs: DataFrame, asked: set[bytes]) -> Statistics:
    """Counts over all documents. At most one row a task and asked term leaves a task, and one a term reaches the driver."""
    shared = docs.sparkSession.sparkContext.broadcast(asked)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, int] = {}
        documents = total = 0
        for frame in frames:
            for text in frame["text"]:
                terms = terms_of(text)
                documents, total = documents + bool(terms), total + len(terms)
                for t in shared.value.intersection(terms):
                    held[t] = held.get(t, 0) + 1
        rows = [(None, documents, total), *((t, n, 0) for t, n in held.items())]
        yield pd.DataFrame(rows, columns=["term", "held", "total"])

    counts = docs.select("text").mapInPandas(count, "term binary, held long, total long")
    found = counts.groupBy("term").agg(F.sum("held").alias("held"), F.sum("total").alias("total")).collect()
    shared.unpersist()
    n, total = next(((r["held"], r["total"]) for r in found if r["term"] is None), (0, 0))
    weights = {bytes(r["term"]): math.floor(1000 * math.log((2 * n + 2) / (2 * r["held"] + 1))) for r in found if r["term"] is not None}
    return Statistics(n, total, weights)


class Block:
    """Postings of some documents in the order of their ids, with sparse tables of range maxima."""

    def __init__(self, sizes: np.ndarray, docs: np.ndarray, terms: np.ndarray, stats: Statistics, weights: np.ndarray):
        """`docs` and `terms` are parallel, one entry an occurrence: place of the document, number of the term."""
        self.width = len(sizes) + 1
        self.keys, tf = np.unique(terms.astype(np.int64) * self.width + docs, return_counts=True)
        term, self.doc = np.divmod(self.keys, self.width)
        self.doc = self.doc.astype(np.int64)
        factor = stats.length_factor(sizes)[self.doc]
        self.impact = weights[term] * ((SCALE * 1_000_000 * tf) // (SCALE * tf + SATURATION * factor))
        longest = int(np.bincount(term).max(initial=1)) if len(term) else 1
        self.tables = [np.arange(len(self.keys), dtype=np.int32)]
        while (half := 1 << (len(self.tables) - 1)) * 2 <= longest:
            below = self.tables[-1]
            left, right = below[:-half], below[half:]
            best = below.copy()  # places near the end are never asked for at this length
            best[:-half] = np.where(self.impact[right] > self.impact[left], right, left)
            self.tables.append(best)
        self.tables = np.stack(self.tables)

    def _peaks(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(posting, impact) of the leftmost greatest impact in each range of postings; impact 0 where a range is empty."""
        size = last - first
        some = size > 0
        level = np.frexp(np.maximum(size, 1))[1] - 1
        a = self.tables[level, np.where(some, first, 0)]
        b = self.tables[level, np.where(some, last - (1 << level), 0)]
        at = np.where(self.impact[b] > self.impact[a], b, a)
        return at, np.where(some, self.impact[at], 0)

    def best(self, asked: list[np.ndarray], k: int, least: list[int]) -> list[list[tuple[int, int]]]:
        """For each item, given as its terms' numbers, the (score, place) of its best k documents of score above 0.

        Equal scores come by place. Documents below the item's `least` may be left out. All items advance together.
        """
        # A heap holds (-bound, first place, end, the terms that occur there) and scored documents, (-score, place, -1, None).
        # No two entries share a place, so comparisons end there. `least` rises to the item's k-th best score so far.
        least = list(least)
        scores: list[list[int]] = [[] for _ in asked]
        out: list[list[tuple[int, int]]] = [[] for _ in asked]
        heaps: list[list[tuple]] = [[] for _ in asked]
        active = [i for i, terms in enumerate(asked) if len(terms)] if len(self.keys) else []
        if active:
            base, _, starts = _joined([asked[i].astype(np.int64) * self.width for i in active])
            first, last = np.searchsorted(self.keys, base), np.searchsorted(self.keys, base + self.width - 1)
            bounds, cuts, terms = self._bounded(base, first, last, starts)
            for n, i in enumerate(active):
                heaps[i].append((-bounds[n], 0, self.width - 1, terms[:, cuts[n] : cuts[n + 1]]))
        while active:
            turn, entries = [], []
            for i in active:
                heap, found = heaps[i], out[i]
                while heap and len(found) < k and -heap[0][0] >= least[i]:
                    entry = heappop(heap)
                    if entry[2] >= 0:
                        turn.append(i)
                        entries.append(entry)
                        break
                    found.append((-entry[0], entry[1]))
            active = turn
            if not active:
                break
            places, reached, left, right = self._open(entries)
            for n, i in enumerate(active):
                heap, best, score = heaps[i], scores[i], reached[n]
                if score >= least[i]:
                    heappush(heap, (-score, places[n], -1, None))
                    heappush(best, score)
                    if len(best) > k:
                        heappop(best)
                    if len(best) == k:
                        least[i] = max(least[i], best[0])
                for (bounds, cuts, terms), low, high in ((left, entries[n][1], places[n]), (right, places[n] + 1, entries[n][2])):
                    if bounds[n] >= least[i]:
                        heappush(heap, (-bounds[n], low, high, terms[:, cuts[n] : cuts[n + 1]].copy()))
        return out

    def _bounded(self, base: np.ndarray, first: np.ndarray, last: np.ndarray, starts: np.ndarray) -> tuple[list[int], list[int], np.ndarray]:
        """Bounds of intervals, each a segment of terms; where each one's terms start; and the terms that occur there."""
        at, peak = self._peaks(first, last)
        some = last > first
        ends = np.cumsum(np.add.reduceat(some.astype(np.int64), starts)).tolist()
        return np.add.reduceat(peak, starts).tolist(), [0, *ends], np.stack([base, first, last, at])[:, some]

    def _open(self, entries: list[tuple]) -> tuple[list[int], list[int], tuple, tuple]:
        """Splits each interval at the document where its strongest term peaks: that place, its score, both sides."""
        counts = np.array([e[3].shape[1] for e in entries])
        starts = np.cumsum(counts) - counts
        base, first, last, at = np.concatenate([e[3] for e in entries], axis=1)
        peak = self.impact[at]
        strongest = peak == np.repeat(np.maximum.reduceat(peak, starts), counts)
        places = np.minimum.reduceat(np.where(strongest, self.doc[at], self.width), starts)
        wanted = base + np.repeat(places, counts)
        cut = np.searchsorted(self.keys, wanted)
        near = np.minimum(cut, len(self.keys) - 1)
        there = self.keys[near] == wanted
        scores = np.add.reduceat(np.where(there, self.impact[near], 0), starts).tolist()
        return places.tolist(), scores, self._bounded(base, first, cut, starts), self._bounded(base, cut + there, last, starts)


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts in one array, their lengths and their starts."""
    counts = np.array([len(p) for p in parts])
    return np.concatenate(parts), counts, np.cumsum(counts) - counts


def _blocks(frames: Iterator[pd.DataFrame], numbers: dict[bytes, int], stats: Statistics, weights: np.ndarray):
    """(Block, ids, known) of the documents that hold a term, in blocks of bounded size."""
    ids, known, sizes, terms, held = [], [], [], [], 0

    def close() -> tuple:
        order = sorted(range(len(ids)), key=lambda i: (not known[i], ids[i]))
        found = [terms[i] for i in order]
        docs = np.repeat(np.arange(len(order)), [len(t) for t in found])
        flat = np.concatenate([np.empty(0, np.int32), *found])
        block = Block(np.array([sizes[i] for i in order], np.int64), docs, flat, stats, weights)
        return block, [ids[i] for i in order], [known[i] for i in order]

    for frame in frames:
        for i, k, text in zip(frame["_id"].tolist(), frame["_known"].tolist(), frame["text"], strict=True):
            all_terms = terms_of(text)
            if not all_terms:
                continue
            ids.append(i)
            known.append(k)
            sizes.append(len(all_terms))
            terms.append(np.fromiter((numbers[t] for t in all_terms if t in numbers), np.int32))
            held += len(terms[-1])
            if len(ids) == BLOCK_DOCS or held >= BLOCK_TERMS:
                yield close()
                ids, known, sizes, terms, held = [], [], [], [], 0
    if ids:
        yield close()


def _search_batch(docs: DataFrame, items: list[set[bytes]], k: int) -> DataFrame:
    """(_item, doc_id, score): the best k documents of each item in each task's share of the documents."""
    stats = count_terms(docs, set().union(*items))
    numbers = {t: i for i, t in enumerate(sorted(t for t, w in stats.weights.items() if w > 0))}
    weights = np.array([stats.weights[t] for t in numbers], np.int64)
    asked = [np.array(sorted(numbers[t] for t in terms if t in numbers), np.int64) for terms in items]
    shared = docs.sparkSession.sparkContext.broadcast((stats, numbers, weights, asked))

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stats, numbers, weights, asked = shared.value
        best: list[list[tuple]] = [[] for _ in asked]
        for block, ids, known in _blocks(frames, numbers, stats, weights):
            least = [b[k - 1][0] if len(b) == k else 1 for b in best]
            for b, more in zip(best, block.best(asked, k, least), strict=True):
                b += [(score, known[d], ids[d]) for score, d in more]
                b.sort(key=lambda r: (-r[0], not r[1], r[2]))
                del b[k:]
        rows = [(i, id_, known, score) for i, b in enumerate(best) for score, known, id_ in b]
        yield pd.DataFrame(rows, columns=["_item", "_id", "_known", "score"])

    kind = docs.schema["doc_id"].dataType
    read = docs.select(F.coalesce("doc_id", F.lit(0).cast(kind)).alias("_id"), F.col("doc_id").isNotNull().alias("_known"), "text")
    found = read.mapInPandas(search, f"_item int, _id {kind.simpleString()}, _known boolean, score long")
    return found.select("_item", F.when(F.col("_known"), F.col("_id")).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The best k documents of each item: item_id, rank from 1, doc_id, score; equal scores by doc_id, null ids last.

    Null and empty texts hold no terms: such documents are neither counted nor found, such items find nothing. Every row of
    either table stands for itself, repeated or not. Without documents or items there are no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    kinds = [(c, f.schema[c].dataType.simpleString()) for c, f in (("item_id", items), ("doc_id", docs))]
    found, batch, size = [], [], 0

    def close() -> None:
        names = spark.createDataFrame(list(enumerate(i for i, _ in batch)), f"_item int, item_id {kinds[0][1]}")
        best = Window.partitionBy("_item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = _search_batch(docs, [t for _, t in batch], k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        # At most BATCH_ITEMS names.
        found.append(ranked.join(F.broadcast(names), "_item").select("item_id", "rank", "doc_id", "score"))

    for row in items.select("item_id", "text").toLocalIterator():
        batch.append((row["item_id"], set(terms_of(row["text"]))))
        size += len(row["text"] or "")
        if len(batch) == BATCH_ITEMS or size >= BATCH_BYTES:
            close()
            batch, size = [], 0
    if batch:
        close()
    if not found:
        return spark.createDataFrame([], ", ".join(["item_id " + kinds[0][1], "rank int", "doc_id " + kinds[1][1], "score long"]))
    return reduce(DataFrame.unionByName, found)
