"""Near-duplicate embeddings, from sorted passes over random hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countyloom.llm.common import checkpointed
from countyloom.llm.components import components
from countyloom.llm.vectors import matrix, takes_part, usable

#: Leading bits of a key that name the bucket in which its rows are numbered.
BUCKET_BITS = 10
#: What names a cell of link counts.
CELL = ("batch", "cell_part", "cell_i", "cell_j")


@dataclass(frozen=True)
class Settings:
    """A round is `passes` orders by `bits` random planes each; every vector is compared with the next `window` ones of each."""

    cosine: float = 0.95
    passes: int = 24
    bits: int = 48
    window: int = 24
    block_rows: int = 2048
    seed: int = 3


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _keys(classes: DataFrame, settings: Settings, again: int = 0) -> DataFrame:
    """(same, vector, dim, turn, key): the concatenated plane sides of each vector in every pass of round `again`."""
    seed = [settings.seed, again] if again else settings.seed

    def hash_(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                planes = np.random.default_rng(seed).normal(size=(settings.passes, int(dim), settings.bits))
                weights = 1 << np.arange(settings.bits - 1, -1, -1, dtype=np.int64)
                unit = _unit(matrix(part["vector"], int(dim)))
                for turn, own in enumerate(planes):
                    yield part.assign(turn=turn, key=((unit @ own) > 0).astype(np.int64) @ weights)

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.select("same", "vector", "dim").mapInPandas(hash_, f"same long, vector {kind}, dim int, turn int, key long")


def _blocks(keys: DataFrame, settings: Settings) -> DataFrame:
    """The rows of each pass in key order, in blocks of bounded size that overlap by a window.

    A row's number is the count of the buckets before its own plus its place in the bucket.
    """
    rows = keys.withColumn("bucket", F.shiftright("key", settings.bits - BUCKET_BITS))
    counts = rows.groupBy("dim", "turn", "bucket").count()
    before = Window.partitionBy("dim", "turn").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("dim", "turn", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inner = Window.partitionBy("dim", "turn", "bucket").orderBy("key", "same")
    placed = rows.withColumn("row", F.row_number().over(inner)).join(firsts, ["dim", "turn", "bucket"])
    placed = placed.withColumn("at", F.col("first") + F.col("row") - 1).drop("first", "row", "bucket", "key")
    own = F.floor(F.col("at") / settings.block_rows).cast("long")
    back = F.when((own > 0) & (F.col("at") % settings.block_rows < settings.window), F.array(own, own - 1)).otherwise(F.array(own))
    return placed.withColumn("block", F.explode(back))


def _neighbour_links(blocks: DataFrame, settings: Settings) -> DataFrame:
    """Edges (a, b) that join what verified pairs of window neighbours join, a star for each group of a block."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at")
        names, unit = frame["same"].to_numpy(), _unit(matrix(frame["vector"], int(frame["dim"].iloc[0])))
        root = np.arange(len(names))

        def top(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for step in range(1, min(settings.window, len(names) - 1) + 1):
            for i in np.flatnonzero(np.einsum("ij,ij->i", unit[:-step], unit[step:]) >= settings.cosine):
                a, b = top(i), top(i + step)
                root[max(a, b)] = min(a, b)
        tops = np.array([top(i) for i in range(len(names))])
        moved = np.flatnonzero(tops != np.arange(len(names)))
        return pd.DataFrame({"a": names[tops[moved]], "b": names[moved]})

    return blocks.groupBy("dim", "turn", "block").applyInPandas(compare, "a long, b long").distinct()


def _across(links: DataFrame, known: DataFrame) -> DataFrame:
    """The links whose ends are not in one component yet."""
    for end in ("a", "b"):
        named = known.select(F.col("node").alias(end), F.col("component").alias(f"part_{end}"))
        links = links.join(named, end, "left").withColumn(f"part_{end}", F.coalesce(f"part_{end}", end))
    return links.where("part_a <> part_b").select("a", "b")


def _joined(classes: DataFrame, settings: Settings) -> DataFrame:
    """(node, component) of the classes that links join, from rounds of passes with fresh planes.

    Where many vectors lie close together a window holds few of a vector's neighbours, so a round finds only a part of the
    links. The rounds end with the first one that joins no further components.
    """
    known = checkpointed(components(checkpointed(_neighbour_links(_blocks(_keys(classes, settings), settings), settings))))
    for again in count(1):
        links = _neighbour_links(_blocks(_keys(classes, settings, again), settings), settings)
        new = checkpointed(_across(links, known))
        if new.isEmpty():
            return known
        known = checkpointed(components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(new)))


def _cells(members: DataFrame, settings: Settings) -> DataFrame:
    """The rows that `asks` and those they are compared with, by the columns of CELL.

    `members` holds same, vector, dim, n (its vectors), part (its component). Large components are cut into chunks, and
    each pair of chunks is a cell of its own, of about two chunks whatever the component's size; only components of one
    chunk share a `batch`.
    """
    sizes = checkpointed(members.groupBy("part").agg(F.count("*").alias("size")))
    cut = members.join(sizes, "part").withColumn("chunks", F.ceil(F.col("size") / settings.block_rows).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("same"), "chunks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    left = cut.withColumn("other", other).select("part", F.col("own").alias("i"), F.col("other").alias("j"), "same", "vector", "dim", "n", "chunks", F.lit(True).alias("asks"))
    right = cut.withColumn("other", other).select("part", F.col("other").alias("i"), F.col("own").alias("j"), "same", "vector", "dim", "n", "chunks", F.lit(False).alias("asks"))
    one = F.col("chunks") == 1
    batches = sizes.where(F.col("size") <= settings.block_rows).agg(F.sum("size")).first()[0] or 0
    batch = F.when(one, F.pmod(F.xxhash64("part"), F.lit(max(1, -(-batches // settings.block_rows)))))
    named = left.unionByName(right).withColumn("batch", batch)
    return named.withColumns({f"cell_{c}": F.when(~one, F.col(c)) for c in ("part", "i", "j")})


def _link_counts(members: DataFrame, settings: Settings) -> DataFrame:
    """(same, links): for each class, how many vectors of other classes in its component it links with.

    Only counts leave a cell.
    """

    def counted(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, cell in frame.groupby(["part", "i", "j"]):
            asks = cell["asks"].to_numpy()
            unit, names, n = _unit(matrix(cell["vector"], int(cell["dim"].iloc[0]))), cell["same"].to_numpy(), cell["n"].to_numpy()
            linked = (unit[asks] @ unit[~asks].T >= settings.cosine) & (names[asks][:, None] != names[~asks][None])
            out.append(pd.DataFrame({"same": names[asks], "links": linked @ n[~asks]}))
        return pd.concat(out)

    return _cells(members, settings).groupBy(*CELL).applyInPandas(counted, "same long, links long").groupBy("same").agg(F.sum("links").alias("links"))


def dedup(table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A row a vector: vec_id, n_links, component_id, kept.

    Equal vectors are one class and linked with each other; classes are compared in the windows of all passes, in double
    precision, and the verified pairs of all passes are united; rounds of passes follow until one joins nothing more. `n_links` counts every vector of the component at the
    cosine or above, whether or not a window brought the two together. Vectors that are null, empty, zero or not finite,
    and rows without an id, link with nothing and are their own component; vectors of different lengths never meet. Repeated
    rows link with each other and share their id. An empty table gives no rows.
    """
    rows = usable(table)
    first = rows.groupBy("same", "dim").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = checkpointed(first.join(rows.select("vec_id", "same", "vector"), ["same"]).where("vec_id = least").dropDuplicates(["same"]).drop("vec_id"))
    known = _joined(classes, settings)
    joined = classes.join(known, classes["same"] == known["node"]).select("same", "vector", "dim", "n", "least", F.col("component").alias("part"))
    joined = checkpointed(joined)
    counts = _link_counts(joined.drop("least"), settings)
    least = joined.groupBy("part").agg(F.min("least").alias("component_id"))
    found = joined.select("same", "part").join(least, "part").join(counts, "same", "left").select(F.col("same").alias("_same"), "component_id", "links")
    whole = classes.select("same", "n", "least").join(found, F.col("same") == F.col("_same"), "left")
    whole = checkpointed(whole.select("same", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id")))
    named = rows.select("vec_id", "same").join(whole, "same").select("vec_id", "n_links", "component_id")
    others = table.where(F.col("vec_id").isNull() | ~takes_part(F.col("embedding"))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return named.unionByName(others).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

