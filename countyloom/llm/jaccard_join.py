"""Documents linked by the Jaccard similarity of their word n-grams, by prefix filters under several global orders."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countyloom.llm.common import Words, checkpointed, gathered, mix, text_blocks
from countyloom.llm.components import components
from countyloom.llm.url_cascade import build_filter

#: Counters of the frequency order, and how many of them one row carries. They fit a broadcast of 4 MB at any corpus size.
COUNT_BITS, CHUNK = 20, 1 << 16
#: Hashed places, as a power of two, whose parities tell sets apart that can't link.
MARK_BITS = 11
#: Classes that a worker remembers, so that copies in its own split are sent once.
REMEMBERED = 200_000
#: Classes in a chunk, and tokens of its sets on average; links are counted in cells of two chunks.
CELL_CLASSES, CELL_TOKENS = 8192, 1 << 19
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


@dataclass(frozen=True)
class Settings:
    """Texts link at `percent` or more. Lists of up to `list_rows` classes that share a token are paired in one go."""

    words: int = 5
    percent: int = 75
    list_rows: int = 128
    orders: int = 2

    def prefix(self, size: int) -> int:
        """Tokens of a set of this size that a linked set can't all miss."""
        return size - -(-self.percent * size // 100) + 1


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct n-grams; all words as one, if there are fewer; none without words."""
    for a, b in text_blocks(texts):
        found = Words(texts[a:b])
        w = found.word
        grams = np.zeros(max(0, len(w) - words + 1), np.uint64)
        for i in range(words):
            grams += w[i : len(grams) + i] * (_ODD[i % 5] + np.uint64(2 * (i // 5)))
        grams = mix(grams)
        cuts = np.searchsorted(found.doc, np.arange(found.count + 1))
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            if last - first >= words:
                yield np.unique(grams[first : last - words + 1])
            elif last > first:
                yield np.array([xxhash.xxh3_64_intdigest(w[first:last].tobytes(), seed=int(last - first))], np.uint64)
            else:
                yield w[:0]


def class_of(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set; equal sets are one class."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


def _places(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def read_sets(docs: DataFrame, settings: Settings) -> DataFrame:
    """A row a document: doc_id, n_shingles, class; and a split's token counts in rows with chunk and counts."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << COUNT_BITS, np.uint32)
        for frame in frames:
            sizes, classes = [], []
            for s in shingle_sets(frame["text"].tolist(), settings.words):
                np.add.at(counts, _places(s), np.uint32(1))
                sizes.append(len(s))
                classes.append(class_of(s))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_shingles": sizes, "class": classes, "chunk": None, "counts": None})
        for at in range(0, len(counts), CHUNK):
            part = counts[at : at + CHUNK]
            if part.any():
                yield pd.DataFrame({"doc_id": [None], "n_shingles": [None], "class": [None], "chunk": [at // CHUNK], "counts": [zlib.compress(part.tobytes(), 1)]})

    kind = docs.schema["doc_id"].dataType
    named = docs.select(F.col("doc_id").cast("string"), "text")  # as text, so that pandas keeps long ids beside nulls
    rows = named.mapInPandas(read, "doc_id string, n_shingles long, class long, chunk int, counts binary")
    return rows.withColumn("doc_id", F.col("doc_id").cast(kind))


def token_counts(rows: DataFrame) -> np.ndarray:
    """The splits' counters added up: how often the tokens of each hashed place occur in the corpus."""

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(CHUNK, np.uint64)
        for part in frame["counts"]:
            counts += np.frombuffer(zlib.decompress(part), np.uint32)
        counts = np.minimum(counts, np.uint64(2**32 - 1)).astype(np.uint32)
        return pd.DataFrame({"chunk": frame["chunk"].iloc[:1], "counts": [zlib.compress(counts.tobytes(), 1)]})

    schema = "chunk int, counts binary"
    dealt = rows.select("chunk", "counts", F.pmod(F.xxhash64("counts"), F.lit(16)).alias("part"))
    some = dealt.groupBy("chunk", "part").applyInPandas(total, schema)
    counts = np.zeros(1 << COUNT_BITS, np.uint32)
    for row in some.groupBy("chunk").applyInPandas(total, schema).collect():
        counts[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
    return counts


def postings(docs: DataFrame, counts, settings: Settings) -> DataFrame:
    """(token, class, size, spot) of each class's prefix under the first order: rare tokens first, ties by hash."""

    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for frame in frames:
            made = []
            for s in shingle_sets(frame["text"].tolist(), settings.words):
                name = class_of(s)
                if not len(s) or name in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(name)
                most = settings.prefix(len(s))
                first = np.argsort(counts.value[_places(s)], kind="stable")[:most]
                made.append((s[first], np.full(most, name), np.full(most, len(s), np.int32), np.arange(most, dtype=np.int32)))
            if made:
                token, name, size, spot = map(np.concatenate, zip(*made, strict=True))
                yield pd.DataFrame({"token": token.view(np.int64), "class": name, "size": size, "spot": spot})

    return docs.select("text").mapInPandas(emit, "token long, class long, size int, spot int")


def _pairs(classes, sizes, spots, first, second, percent):
    """Pairs of list entries that can still link: by their sizes, and by what can be shared after this token at most."""
    a, b = sizes[first].astype(np.int64), sizes[second].astype(np.int64)
    need = -(-percent * (a + b) // (100 + percent))
    ok = (np.minimum(a - spots[first], b - spots[second]) >= need) & (classes[first] != classes[second])
    return classes[first[ok]], classes[second[ok]], (second - first)[ok] <= 2


def list_candidates(lists: DataFrame, settings: Settings) -> DataFrame:
    """Candidate pairs (a, b, near) of the classes that share a token; lists come sorted by token, then size.

    Short lists are paired in full; `near` marks neighbours by size. A longer one gives pairs of neighbours by size, and all its entries, with the token, for
    `hot_candidates`: it is read as a stream, whatever its length.
    """
    most, percent = settings.list_rows, settings.percent

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = [np.empty(0, t) for t in (np.int64, np.int64, np.int32, np.int32)]
        long = False  # whether the list that `kept` begins with is already known to be long

        def rows(pairs, hot):
            a, b, near = (np.concatenate([p[i] for p in pairs]) for i in range(3))
            none = lambda n: pd.array([None] * n, "Int64")
            out = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "near": near, "token": none(len(a)), "size": none(len(a)), "spot": none(len(a))})
            parts = [out.sort_values("near", ascending=False).drop_duplicates(["a", "b"])]
            parts += [pd.DataFrame({"a": h[1], "b": none(len(h[1])), "near": False, "token": h[0], "size": h[2], "spot": h[3]}) for h in hot]
            return pd.concat(parts, ignore_index=True)

        def done(arrays, last):
            nonlocal kept, long
            token, name, size, spot = arrays
            starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.empty(0, np.int64)
            ends = np.append(starts[1:], len(token))
            pairs, hot = [], []
            count = len(starts) if last else max(0, len(starts) - 1)
            sizes = ends - starts
            two = np.flatnonzero(sizes[:count] == 2)
            if long and len(two) and two[0] == 0:
                two = two[1:]
            pairs.append(_pairs(name, size, spot, starts[two], starts[two] + 1, percent))
            for k in np.flatnonzero((sizes > 2) | ((sizes > 0) & (np.arange(len(sizes)) == 0) & long)):
                s, e, open_ = starts[k], ends[k], k >= count
                known = long and k == 0
                if e - s > most or known:
                    # The first two entries of a known long list stand at the front once more, as neighbours of what follows.
                    at = np.arange(s, e)
                    old = 2 if known else 0
                    for step in (1, 2):
                        pairs.append(_pairs(name, size, spot, at[max(0, old - step) : len(at) - step], at[max(0, old - step) + step :], percent))
                    hot.append(tuple(x[s + old : e] for x in arrays))
                    if open_:
                        kept, long = [x[e - 2 : e] for x in arrays], True
                elif not open_:
                    first, second = np.triu_indices(e - s, 1)
                    pairs.append(_pairs(name, size, spot, first + s, second + s, percent))
            if count < len(starts):
                s, e = starts[-1], ends[-1]
                if not (e - s > most or (long and len(starts) == 1)):
                    kept, long = [x[s:e] for x in arrays], False
            else:
                kept, long = [x[:0] for x in arrays], False
            return rows(pairs, hot)

        for frame in frames:
            arrays = [np.concatenate([k, frame[c].to_numpy()]) for k, c in zip(kept, ("token", "class", "size", "spot"), strict=True)]
            yield done(arrays, last=False)
        yield done(kept, last=True)

    dealt = lists.repartition("token").withColumn("_turn", F.xxhash64("class", F.pmod("token", F.lit(4))))
    ordered = dealt.sortWithinPartitions("token", "size", "_turn").select("token", "class", "size", "spot")
    found = ordered.mapInPandas(walk, "a long, b long, near boolean, token long, size int, spot int")
    return found.groupBy("a", "b", "token", "size", "spot").agg(F.max("near").alias("near"))


def apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs whose classes are in different components."""
    for end in ("a", "b"):
        named = known.select(F.col("node").alias(end), F.col("component").alias(f"part_{end}"))
        pairs = pairs.join(named, end, "left").withColumn(f"part_{end}", F.coalesce(f"part_{end}", end))
    return pairs.where("part_a <> part_b").select("a", "b")


def can_link(size: str, size2: str, marks: str, marks2: str, settings: Settings) -> Column:
    """Whether two sets differ in few enough hashed places.

    A token is in both sets or makes their parities differ in its place, unless others cancel it out there: sets have at
    least as many tokens of their own as places with different parity.
    """
    both = F.col(size) + F.col(size2)
    odd = F.aggregate(F.zip_with(marks, marks2, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return odd <= both - 2 * needed(both, settings)


def needed(both: Column, settings: Settings) -> Column:
    """Tokens that linked sets share at least, by their sizes' sum."""
    return F.ceil(settings.percent * both / (100 + settings.percent))


def plausible(pairs: DataFrame, marks: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) that their marks leave open."""
    one, two = (marks.select(*[F.col(c).alias(f"{c}_{end}") for c in ("class", "size", "marks")]) for end in ("a", "b"))
    met = pairs.join(one, F.col("a") == F.col("class_a")).join(two, F.col("b") == F.col("class_b"))
    return met.where(can_link("size_a", "size_b", "marks_a", "marks_b", settings)).select("a", "b")


def hot_candidates(hot: DataFrame, marks: DataFrame, known: DataFrame, settings: Settings) -> DataFrame:
    """Pairs from long lists whose classes are not in one component yet.

    Lists within one component are left out by their least and greatest component, before any join. Spark cuts the lists of
    frequent tokens into pieces that meet each other; they are dealt to as many tasks as their pairs need.
    """
    entries = hot.select("token", F.col("a").alias("class"), "size", "spot").distinct()
    entries = entries.join(known, entries["class"] == known["node"], "left").select(
        "token", "class", "size", "spot", F.coalesce("component", "class").alias("part")
    )
    entries = checkpointed(entries)
    mixed = entries.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("token")
    open_ = checkpointed(entries.join(mixed, "token").join(marks.select("class", "marks"), "class"))
    met = open_.groupBy("token").count().agg(F.sum(F.col("count") * (F.col("count") - 1))).first()[0] or 0
    other = open_.select("token", *[F.col(c).alias(f"{c}2") for c in ("class", "size", "spot", "part", "marks")])
    reach = F.least(F.col("size") - F.col("spot"), F.col("size2") - F.col("spot2")) >= needed(F.col("size") + F.col("size2"), settings)
    pairs = open_.join(
        other,
        (open_["token"] == other["token"])
        & (F.col("part") < F.col("part2"))
        & reach
        & can_link("size", "size2", "marks", "marks2", settings),
    )
    found = pairs.select(F.least("class", "class2").alias("a"), F.greatest("class", "class2").alias("b"))
    return gathered(found, met // 2).distinct()


def fetched(docs: DataFrame, classes: DataFrame, settings: Settings, marks: bool = False) -> DataFrame:
    """(class, size, shingles) of the named classes, read from the texts again; with `marks`, (class, size, marks) instead.

    Only sets that pass a filter of the wanted names leave a task, so the texts are not shuffled.
    """
    keys = checkpointed(classes.select(F.col("class").alias("h1"), F.col("class").alias("h2")).distinct())
    shared = docs.sparkSession.sparkContext.broadcast(build_filter(keys, max(1, keys.count()), seed=1))

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for frame in frames:
            sets = [s for s in shingle_sets(frame["text"].tolist(), settings.words) if len(s)]
            names = np.array([class_of(s) for s in sets], np.int64)
            wanted = np.flatnonzero(shared.value.holds(names, names))
            made = {int(names[k]): sets[k] for k in wanted if int(names[k]) not in seen}
            if len(seen) < REMEMBERED:
                seen.update(made)
            out = pd.DataFrame({"class": pd.Series(list(made), dtype="int64"), "size": [len(s) for s in made.values()]})
            yield out.assign(found=pd.Series([_marks(s) if marks else s.tobytes() for s in made.values()], dtype=object))

    found = docs.select("text").mapInPandas(fetch, f"class long, size int, found {'array<long>' if marks else 'binary'}")
    return found.groupBy("class").agg(F.first("size").alias("size"), F.first("found").alias("marks" if marks else "shingles"))


def _marks(shingles: np.ndarray) -> list[int]:
    """Of each hashed place, whether an odd number of tokens falls there, as longs."""
    odd = np.bincount((shingles >> np.uint64(64 - MARK_BITS)).astype(np.int64), minlength=1 << MARK_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def links_of(docs: DataFrame, pairs: DataFrame, settings: Settings) -> DataFrame:
    """The candidate pairs (a, b) that link.

    A pair must share prefix tokens under each of the other orders too, before its whole sets are compared.
    """
    named = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class")))
    sets = fetched(docs, named, settings)
    seeds = [np.uint64(0x1234567 + 2 * k) for k in range(settings.orders)]

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right, strict=True):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            out.append(_shares_all_orders(a, b, seeds, settings) and _similar(a, b, settings.percent))
        return pd.Series(out, dtype=bool)

    one = sets.select(F.col("class").alias("a"), F.col("shingles").alias("left"))
    two = sets.select(F.col("class").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(one, "a").join(two, "b").where(linked("left", "right")).select("a", "b")


def _shares_all_orders(a: np.ndarray, b: np.ndarray, seeds, settings: Settings) -> bool:
    for seed in seeds:
        first, second = (np.partition(mix(s ^ seed), settings.prefix(len(s)) - 1)[: settings.prefix(len(s))] for s in (a, b))
        if not np.isin(first, second, assume_unique=True).any():
            return False
    return True


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _linked(asks: list[np.ndarray], others: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether each set of `asks` links with each of `others`."""
    sizes = np.array([len(s) for s in others], np.int64)
    tokens, owners = np.concatenate(others), np.repeat(np.arange(len(others)), sizes)
    by_token = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[by_token], owners[by_token]
    out = np.empty((len(asks), len(others)), bool)
    for k, s in enumerate(asks):
        first, last = np.searchsorted(tokens, s), np.searchsorted(tokens, s, side="right")
        found = np.repeat(first - np.concatenate(([0], np.cumsum(last - first)[:-1])), last - first) + np.arange((last - first).sum())
        shared = np.bincount(owners[found], minlength=len(others))
        out[k] = 100 * shared >= percent * (len(s) + sizes - shared)
    return out


def in_cells(sets: DataFrame, batches: int) -> DataFrame:
    """Each set (class, part, own, chunks..) once for each chunk of its component: in the cell of its own and that chunk.

    Components of one chunk share batches.
    """
    met = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = met.select(
        "class", "n", "part", "shingles", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("part"), F.lit(batches))).alias("batch"),
    )
    return dealt.withColumns({f"cell_{c}": F.when(F.col("batch").isNull(), F.col(c)) for c in ("part", "i", "j")})


def link_counts(docs: DataFrame, members: DataFrame, settings: Settings) -> DataFrame:
    """(class, links): with how many documents of other classes those of a class link.

    `members` holds class, size, n (its documents), part (its component). Links never leave a component, so all pairs of one
    are compared, in cells of two of its chunks; only counts leave a cell. A chunk meets itself and every other chunk in one
    cell, so a set is sent once for each chunk of its component.
    """
    rows, tokens = F.count("*"), F.sum("size")
    sizes = checkpointed(members.groupBy("part").agg(rows.alias("classes"), tokens.alias("tokens")).where("classes > 1"))
    chunks = F.ceil(F.greatest(F.col("classes") / CELL_CLASSES, F.col("tokens") / CELL_TOKENS))
    cut = members.join(sizes, "part").withColumn("chunks", F.least("classes", chunks).cast("int"))
    cut = checkpointed(cut.withColumn("own", F.pmod(F.xxhash64(F.lit("cell"), "class"), "chunks").cast("int")))
    sets = cut.drop("size").join(fetched(docs, cut.select("class"), settings).select("class", "shingles"), "class")
    # Batches of small components are filled by tokens as well.
    batches = max(1, -(-(cut.where("chunks = 1").agg(F.sum("size")).first()[0] or 0) // CELL_TOKENS))
    dealt = in_cells(sets, batches)

    def counted(frame: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"class": np.empty(0, np.int64), "links": np.empty(0, np.int64)})]
        for (_, i, j), cell in frame.groupby(["part", "i", "j"]):
            sides = [cell[cell["own"] == c] for c in dict.fromkeys((i, j))]
            asks, others = sides[0], sides[-1]
            if not len(asks) or not len(others):
                continue
            one, two = ([np.frombuffer(x, np.uint64) for x in c["shingles"]] for c in (asks, others))
            linked = _linked(one, two, settings.percent) & (asks["class"].to_numpy()[:, None] != others["class"].to_numpy())
            out.append(pd.DataFrame({"class": asks["class"].to_numpy(), "links": linked @ others["n"].to_numpy()}))
            if i != j:
                out.append(pd.DataFrame({"class": others["class"].to_numpy(), "links": asks["n"].to_numpy() @ linked}))
        return pd.concat(out)

    found = dealt.groupBy("batch", "cell_part", "cell_i", "cell_j").applyInPandas(counted, "class long, links long")
    return found.groupBy("class").agg(F.sum("links").alias("links"))


def join_documents(docs: DataFrame, settings: Settings = Settings(), count_links: bool = False) -> DataFrame:
    """A row a document: doc_id, n_shingles, component_id, and class, which equal sets share.

    component_id is the least doc_id that links reach; documents with the same set are linked, those without words are
    alone. Null ids link others but are never the least; a component of null ids has a null component_id. Repeated rows
    give repeated rows. No candidate between components is left out; those inside one are not needed to join it. With
    `count_links`, n_links says with how many other documents each one links: all pairs inside the components are compared
    then. An empty table gives no rows.
    """
    read = checkpointed(read_sets(docs, settings))
    named = read.where("chunk is null").select("doc_id", "n_shingles", "class")
    counts = docs.sparkSession.sparkContext.broadcast(token_counts(read.where("chunk is not null")))
    candidates = checkpointed(list_candidates(postings(docs, counts, settings), settings))
    pairs, hot = candidates.where("b is not null").select("a", "b", "near"), candidates.where("b is null")
    named_in = candidates.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class")))
    marks = checkpointed(fetched(docs, named_in, settings, marks=True))
    near = checkpointed(plausible(pairs.where("near"), marks, settings))
    links = checkpointed(links_of(docs, near, settings))
    known = checkpointed(components(links))
    # What the neighbours have joined needs no further look; every other candidate gets one.
    rest = plausible(apart(pairs.where("not near").select("a", "b"), known), marks, settings)
    if not hot.isEmpty():
        rest = rest.unionByName(hot_candidates(hot, marks, known, settings)).distinct()
    rest = checkpointed(rest.join(near, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        known = components(links.unionByName(links_of(docs, rest, settings)))
    classes = named.where("n_shingles > 0").groupBy("class").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("n"), F.first("n_shingles").alias("size")
    )
    parts = classes.join(known, classes["class"] == known["node"], "left").select("class", "least", "n", "size", F.coalesce("component", "class").alias("part"))
    parts = checkpointed(parts)
    least = parts.groupBy("part").agg(F.min("least").alias("component_id"))
    whole, more = parts.join(least, "part").select(F.col("class").alias("_class"), "component_id", "n"), []
    if count_links:
        links = link_counts(docs, parts.select("class", "size", "n", "part"), settings)
        whole = whole.join(links, F.col("_class") == links["class"], "left").drop("class")
        whole = whole.withColumn("_links", F.col("n") - 1 + F.coalesce("links", F.lit(0)))
        more = [F.coalesce("_links", F.lit(0)).alias("n_links")]
    whole = checkpointed(whole)
    found = named.join(whole, (F.col("class") == F.col("_class")) & (F.col("n_shingles") > 0), "left")
    alone = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", alone.alias("component_id"), "class", *more)


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """`docs` with one row of each component: that of its least doc_id (one of them, if that row is repeated).

    Rows without an id are kept.
    """
    joined = join_documents(docs, settings)
    keep = joined.where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    kept = docs.join(keep, F.col("doc_id") == F.col("_kept")).drop("_kept")
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(0))
    kept = kept.withColumn("_copy", F.row_number().over(same)).where("_copy = 1").drop("_copy")
    return kept.unionByName(docs.where("doc_id is null"))
