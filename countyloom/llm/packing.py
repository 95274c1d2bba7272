"""Packing token pieces into sequences by vector best-fit."""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countyloom.llm.common import checkpointed

#: Known chunks of text that a generation of a worker's memory holds; it needs about 90 MB for each 100,000. Results don't hang on it.
CACHE = 400_000
#: New words that are read as one line.
LINE = 200


@dataclass(frozen=True)
class Capacities:
    """What a sequence holds at most: tokens, pieces, and attention cost, the sum of the squared lengths of its pieces.

    `rule` selects the bin: "norm" (least weighted norm of what is left) or "dot" (greatest weighted product of the piece's
    demands and what is left). `group` bounds the pieces packed together in one task.
    """

    tokens: int = 2048
    pieces: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001)
    rule: str = "norm"
    group: int = 8192


class _Ids:
    """Token ids of texts as little-endian bytes.

    Where the tokenizer marks the ends of words and works on one run of letters at a time, a text can be cut at its spaces and
    line feeds, a word freed of the marks at its end, and the ids of what comes often kept. New words are read many at once;
    those of a-z, which no normalizer changes, by the bare model, if that reads words of the vocabulary alike. What is kept has two generations: a full one becomes the older, and what is asked of it moves on, so that frequent
    words stay. Other tokenizers, told by a text of odd cases read both ways, read whole texts.
    """

    PROBE = (
        "The cat.\nthe CAT, Ärger 3.5 a.b U.S. don't  x,y - straße. naïve\u0301 \u65e5\u672c\u8a9e, ok"
        " end!! Cost$$$ ÈRÉ!!! (it) so,... a&&&, b### x*** [c]; d: \"e\" f% g~ h/ i= j|> k_ l-- m{} n`^ o@+ p\\ q< r?!"
    )
    MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # all of ASCII but the apostrophe, which may begin a contraction

    def __init__(self, path: str, kept: int = CACHE):
        self.kept = kept
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks already share out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if self.suffix:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(self.suffix)]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        self.bare = None
        self.cuts = bool(self.suffix) and self.of([self.PROBE]) == self._plain([self.PROBE])
        if self.cuts:
            self.bare = self._bare(path)

    def _bare(self, path: str):
        """The model behind a cut at white space only, if it reads words of a-z as the tokenizer does; else nothing."""
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        bare = Tokenizer.from_file(path)
        bare.normalizer = normalizers.Sequence([])
        bytes_ = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytes_])
        listed = sorted(w for t in self.tokenizer.get_vocab() if (w := t.removesuffix(self.suffix)).isascii() and w.isalpha() and w.islower())
        words = [a + b for a, b in zip(listed[::40], reversed(listed[::40]), strict=True)] + listed[::40]
        return bare if self._plain([" ".join(words)]) == self._plain([" ".join(words)], bare) else None

    def _plain(self, texts: list[str], tokenizer=None) -> list[bytes]:
        found = [array("I", e.ids) for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]
        if sys.byteorder != "little":
            for ids in found:
                ids.byteswap()
        return [ids.tobytes() for ids in found]

    def of(self, texts: list[str]) -> list[bytes]:
        if not getattr(self, "cuts", True):
            return self._plain(texts)
        chunked = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.known) > self.kept:
            self.older, self.known = self.known, {"": b""}
        if len(self.words) > self.kept:
            self.older_words, self.words = self.words, {}
        known, words = self.known, self.words
        new = self._moved(set().union(*chunked).difference(known), self.older, known)
        odd, cut, bodies, tails = [], [], [], []  # strings in lists, as a tuple for each new chunk would keep the collector busy
        for c in new:
            if c.isalpha():
                body = c
            elif not (body := c.rstrip(self.MARKS)).isalpha():
                odd.append(c)
                continue
            cut.append(c)
            bodies.append(body.lower() if body.isascii() else body)
            tails.append(c[len(body) :])
        self._read_words(self._moved(set(bodies).difference(words), self.older_words, words))
        odd += set(tails).difference(known)
        known.update(zip(odd, self._plain(odd), strict=True))
        for c, body, tail in zip(cut, bodies, tails, strict=True):
            known[c] = words[body] + known[tail] if tail else words[body]
        return [b"".join(map(known.__getitem__, chunks)) for chunks in chunked]

    @staticmethod
    def _moved(asked: set[str], older: dict[str, bytes], newer: dict[str, bytes]) -> set[str]:
        """Moves what is asked of the older generation to the newer one; what is left is new."""
        found = {c for c in asked if c in older}  # `intersection` would walk through all that is kept
        for c in found:
            newer[c] = older[c]
        return asked - found if found else asked

    def _read_words(self, words: set[str]) -> None:
        letters = {w for w in words if w.isascii()} if self.bare else set()
        for some, tokenizer in ((list(letters), self.bare), (list(words - letters), None)):
            self._read_lines(some, tokenizer)

    def _read_lines(self, listed: list[str], tokenizer) -> None:
        lines = [listed[a : a + LINE] for a in range(0, len(listed), LINE)]
        for line, data in zip(lines, self._plain([" ".join(line) for line in lines], tokenizer), strict=True):
            cuts = (4 * np.flatnonzero(self.ends[np.frombuffer(data, "<u4")]) + 4).tolist()
            if len(cuts) == len(line):
                self.words.update(zip(line, map(data.__getitem__, map(slice, [0, *cuts], cuts)), strict=False))
            else:
                self.words.update(zip(line, self._plain(line), strict=True))


@lru_cache(maxsize=1)
def _ids(path: str, kept: int = CACHE) -> _Ids:
    return _Ids(path, kept)


def pieces_of(docs: DataFrame, tokenizer: str, most: int, carried: tuple[str, ...] = (), kept: int = CACHE) -> DataFrame:
    """Pieces of at most `most` ids: doc_id, piece, start, length, ids_crc32. A document is its text's ids, then id 0.

    Null and empty texts are the id 0 alone. `tokenizer` is a path that every executor has. Columns that are `carried`
    (without nulls) follow.
    """

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = _ids(tokenizer, kept).of
        for frame in frames:
            texts = [t if isinstance(t, str) else "" for t in frame["text"]]
            rows = []
            for at in range(0, len(texts), 256):
                for k, ids in enumerate(ids_of(texts[at : at + 256]), at):
                    ids += b"\0\0\0\0"
                    for piece, start in enumerate(range(0, len(ids), 4 * most)):
                        part = ids[start : start + 4 * most]
                        rows.append((k, piece, start // 4, len(part) // 4, zlib.crc32(part)))
            made = pd.DataFrame(rows, columns=["k", "piece", "start", "length", "ids_crc32"])
            of = made.pop("k").to_numpy(np.int64)
            made.insert(0, "doc_id", frame["doc_id"].array.take(of))
            yield made.assign(**{c: frame[c].array.take(of) for c in carried})

    kind = docs.schema["doc_id"].dataType
    named = docs.select(F.col("doc_id").cast("string"), "text", *carried)  # as text, so that pandas keeps long ids beside nulls
    more = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carried)
    pieces = named.mapInPandas(cut, f"doc_id string, piece int, start long, length long, ids_crc32 long{more}")
    return pieces.withColumn("doc_id", F.col("doc_id").cast(kind))


def best_fit(lengths: np.ndarray, caps: Capacities) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in it of each piece: longest first, each into the fitting open bin that the rule selects, else a new one.

    Ties go to the bin opened first.
    """
    limit = np.array([caps.tokens, caps.pieces, caps.cost], float)
    weight = np.array(caps.weights)[:, None]
    demand = np.stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2]) / limit[:, None]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    left = np.ones((3, len(lengths)))
    used = np.zeros(len(lengths), np.int64)
    open_ = np.empty(0, np.int64)
    made, least = 0, demand.min(axis=1, initial=1.0)[:, None]
    for i in np.argsort(-lengths, kind="stable"):
        need = demand[:, i : i + 1]
        rest = left[:, open_] - need
        fits = np.flatnonzero((rest >= -1e-12).all(axis=0))
        if not len(fits):
            b, made = made, made + 1
            open_ = np.append(open_, b)
        elif caps.rule == "dot":
            b = open_[fits[np.argmax((weight * need * left[:, open_[fits]]).sum(axis=0))]]
        else:
            b = open_[fits[np.argmin((weight * rest[:, fits] ** 2).sum(axis=0))]]
        bins[i], offsets[i] = b, used[b]
        used[b] += lengths[i]
        left[:, b] -= need[:, 0]
        if (left[:, b] < least[:, 0] - 1e-12).any():
            open_ = open_[open_ != b]
    return bins, offsets


def stored_places(docs: DataFrame) -> DataFrame:
    """`docs`, as read from files, with each row's place there: `_part` and `_file` (by which its files sort), and `_at`.

    Spark reads the largest files first, so the order of its rows is not that of the files. Rows that come from no file
    stand in the order of the frame.
    """
    if not docs.inputFiles():
        return docs.withColumns({"_part": F.lit(0), "_file": F.lit(""), "_at": F.monotonically_increasing_id()})
    name = F.col("_metadata.file_name")
    return docs.select("*", F.length(name).alias("_part"), name.alias("_file"), F.col("_metadata.row_index").alias("_at"))


def numbered(pieces: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """`pieces` with a gapless number `_row` from 0 in the order of the columns of `order`, which are left out."""
    sorted_ = checkpointed(pieces).repartitionByRange(*order).sortWithinPartitions(*order).drop(*set(order).difference({"piece"}))
    placed = checkpointed(sorted_.withColumn("_id", F.monotonically_increasing_id())).withColumn("_split", F.shiftright("_id", 33))
    counts = sorted(placed.groupBy("_split").count().collect())
    firsts = zip((r["_split"] for r in counts), accumulate((r["count"] for r in counts), initial=0))
    first = placed.sparkSession.createDataFrame(list(firsts), "_split long, _first long")
    at = F.col("_first") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(first), "_split").withColumn("_row", at).drop("_split", "_id", "_first")


def pack(docs: DataFrame, tokenizer: str, caps: Capacities = Capacities(), in_order: bool = False, kept: int = CACHE) -> DataFrame:
    """Every piece with its sequence and its offset there: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Whole sequences stand alone. The other pieces are dealt evenly into groups of about `caps.group`, whatever their keys,
    and each group is packed by itself; that leaves one badly filled sequence a group or so. Repeated rows are packed as
    often as they come; an empty table gives no rows. A piece must fit an empty sequence, so tokens squared may not
    exceed the cost.

    `in_order` keeps the order of the rows in the files that `docs` is read from: each `caps.group` pieces that follow each
    other are a group, and sequences are numbered by group, then by their earliest piece. The sequences of the first groups
    hold exactly the first pieces; inside a group, best fit brings pieces together that stand apart.

    `kept` bounds what a worker remembers of the chunks of text it has read; less takes more time and gives the same rows.
    """
    if caps.tokens**2 > caps.cost or caps.pieces < 1:
        raise ValueError("a whole sequence must be within the capacities")

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "_row"], ascending=[False, True])
        bins, offsets = best_fit(frame["length"].to_numpy(np.int64), caps)
        if in_order:
            earliest = frame["_row"].groupby(bins).min().sort_index()
            bins = earliest.rank().to_numpy(np.int64)[bins] - 1
        frame["sequence_id"] = (frame["_group"].to_numpy(np.int64) << 32) + bins
        frame["offset"] = offsets
        return frame[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    kind = docs.schema["doc_id"].dataType
    schema = "doc_id string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def fill(dealt: DataFrame) -> DataFrame:
        filled = dealt.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("_group").applyInPandas(packed, schema)
        return filled.withColumn("doc_id", F.col("doc_id").cast(kind))

    if in_order:
        place = ("_part", "_file", "_at")
        pieces = numbered(pieces_of(stored_places(docs), tokenizer, caps.tokens, place, kept), (*place, "piece"))
        return fill(pieces.withColumn("_group", F.floor(F.col("_row") / caps.group)))
    pieces = checkpointed(pieces_of(docs, tokenizer, caps.tokens, kept=kept).withColumn("_row", F.monotonically_increasing_id()))
    whole = pieces.where(F.col("length") == caps.tokens)
    rest = pieces.where(F.col("length") < caps.tokens)
    groups = max(1, -(-rest.count() // caps.group))
    alone = whole.select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return alone.unionByName(fill(rest.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))))
