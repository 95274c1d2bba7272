"""Secret spans from fixed patterns, and from character Markov models of random strings against ordinary identifiers.

Everything here is DataFrame functions: spans come from the matches of a pattern and the lengths of the gaps between them.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The patterns of the base kinds, in the order in which spans at one place are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
BASE_KINDS = ("assign", "access", "hex")
LEAST_VALUE = 8
# End of fixed values.

MARKOV = "markov"
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
STATES = len(LETTERS) + 1


@dataclass(frozen=True)
class Settings:
    """`sample_rows` bounds the documents whose labelled strings are fitted: those whose hashed ids come first. `random_strings`
    made-up ones stand beside them, so that both classes have samples at every size.

    A run of at least `least_length` identifier characters is a secret if its log-likelihood ratio is at least
    `least_ratio` nats for each pair of neighbouring characters.
    """

    sample_rows: int = 20_000
    random_strings: int = 4_000
    least_length: int = 20
    least_ratio: float = 0.5
    smoothing: float = 0.5


#: Matches that are listed in one go. More are listed in blocks, so that time grows with the matches, not with their square.
BLOCK = 256


def _empty() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int,body:string>>")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, though `use` names it in a lambda of its own."""
    return F.transform(F.array(value), use)[0]


def _in_blocks(items: Column) -> Column:
    """An array as an array of arrays of at most BLOCK items; one empty block for none."""

    def cut(held: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(held), F.lit(1)), F.lit(BLOCK))
        return F.transform(firsts, lambda at: F.slice(held, at, BLOCK))

    return _once(items, cut)


def _spans(text: str, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches as (start, kind, end, matched text), in code points.

    The text is cut at its matches; a match starts after the gaps and matches before it. Blocks of matches are placed first.
    """
    matches = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    gaps = F.split(F.col(text), pattern, -1)
    pairs = F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.struct(m.alias("body"), g.alias("gap")))

    def step(found: Column, pair: Column) -> Column:
        start = (found["at"] + F.length(pair["gap"])).cast("int")
        end = (start + F.length(pair["body"])).cast("int")
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["body"].alias("body"))
        return F.struct(end.alias("at"), F.concat(found["spans"], F.array(span)).alias("spans"))

    def listed_from(at: Column, block: Column) -> Column:
        return F.aggregate(block, F.struct(at.alias("at"), _empty().alias("spans")), step, lambda f: f["spans"])

    sized = F.transform(
        _in_blocks(pairs),
        lambda block: F.struct(
            block.alias("pairs"), F.aggregate(block, F.lit(0), lambda n, p: (n + F.length(p["gap"]) + F.length(p["body"])).cast("int")).alias("size")
        ),
    )

    def place(placed: Column, block: Column) -> Column:
        one = F.struct(placed["at"].alias("at"), block["pairs"].alias("pairs"))
        return F.struct((placed["at"] + block["size"]).cast("int").alias("at"), F.concat(placed["blocks"], F.array(one)).alias("blocks"))

    none = F.array().cast("array<struct<at:int,pairs:array<struct<body:string,gap:string>>>>")
    blocks = F.aggregate(sized, F.struct(F.lit(0).alias("at"), none.alias("blocks")), place, lambda p: p["blocks"])
    found = F.flatten(F.transform(blocks, lambda b: listed_from(b["at"], b["pairs"])))
    return F.when(F.col(text).rlike(pattern), found).otherwise(_empty())


def _base_spans(docs: DataFrame) -> DataFrame:
    """`docs` with the column _base: spans of the fixed kinds by start, then kind. Reads the column _text."""
    found = docs.withColumn("_assign", _spans("_text", ASSIGN, 0)).withColumn(
        "_others", F.concat(_spans("_text", ACCESS, 1), _spans("_text", HEX, 2))
    )
    long = F.filter("_assign", lambda x: F.length(F.regexp_extract(x["body"], ASSIGN, 1)) >= LEAST_VALUE)
    return found.withColumn("_base", F.array_sort(F.concat(long, "_others"))).drop("_assign", "_others")


def _pairs(word: Column) -> Column:
    """Codes of all neighbouring characters of a word. The word is cut into characters once, however long it is."""
    codes = F.transform(F.split(word, ""), lambda c: F.call_function("instr", F.lit(LETTERS), c))
    return _once(codes, lambda c: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda a, b: a * STATES + b))


def made_up(spark: SparkSession, settings: Settings) -> DataFrame:
    """Random strings by a fixed seed, labelled as such: digests in base64 and in letters and digits alone, of several lengths."""
    digest = F.base64(F.unhex(F.sha2(F.concat(F.lit("random string "), F.col("id").cast("string")), 512)))
    word = F.when(F.col("id") % 2 == 0, digest).otherwise(F.regexp_replace(digest, "[^A-Za-z0-9]", ""))
    return spark.range(settings.random_strings).select(F.substring(word, F.lit(1), (F.lit(settings.least_length) + F.col("id") % 40).cast("int")).alias("word"))


def train(docs: DataFrame, settings: Settings = Settings()) -> list[float] | None:
    """Log-likelihood ratios of all pairs of neighbouring characters, random over ordinary; None without ordinary identifiers.

    Random strings are made up, and are the values that the fixed patterns find in a bounded, hashed set of documents; the
    identifiers left there when these are cut out are ordinary. At most one row a pair of characters is collected.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    picked = texts.select(F.col("doc_id").alias("_id")).distinct()
    picked = picked.orderBy(F.xxhash64(F.lit("secrets"), "_id"), "_id").limit(settings.sample_rows)
    sample = _base_spans(texts.join(F.broadcast(picked), F.col("doc_id").eqNullSafe(F.col("_id"))))
    random = sample.select(F.explode("_base").alias("s")).select(
        F.when(F.col("s.kind") == 0, F.regexp_extract("s.body", ASSIGN, 1)).otherwise(F.col("s.body")).alias("word"), F.lit(1).alias("random")
    )
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("_text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    ordinary = sample.select(F.explode(F.regexp_extract_all(rest, F.lit("[A-Za-z0-9+/_=-]{4,}"), F.lit(0))).alias("word"), F.lit(0).alias("random"))
    random = random.unionByName(made_up(docs.sparkSession, settings).withColumn("random", F.lit(1)))
    words = random.unionByName(ordinary).where(F.length("word") > 1).groupBy("word", "random").count()
    counts = words.select("random", "count", F.explode(_pairs(F.col("word"))).alias("pair")).groupBy("random", "pair").agg(F.sum("count").alias("n"))
    tables = [[0] * (STATES * STATES) for _ in range(2)]
    for row in counts.collect():
        tables[row["random"]][row["pair"]] = row["n"]
    if not all(sum(t) for t in tables):
        return None
    ratios, extra = [], settings.smoothing
    for first in range(STATES):
        a, b = (t[first * STATES : (first + 1) * STATES] for t in (tables[1], tables[0]))
        totals = sum(a) + extra * STATES, sum(b) + extra * STATES
        ratios += [math.log((x + extra) / totals[0]) - math.log((y + extra) / totals[1]) for x, y in zip(a, b, strict=True)]
    return ratios


def scan(docs: DataFrame, ratios: list[float] | None, settings: Settings = Settings()) -> DataFrame:
    """`docs` with `_base` and `_spans`, arrays of (start, kind, end, body) by start, then kind; null texts count as empty.

    `_spans` holds all base spans, and the runs of identifier characters that overlap none of them and that the models find
    random. Without models it equals `_base`. Columns of `docs` named _text, _base or _spans are replaced.
    """
    texts = docs.drop("_base", "_spans").withColumn("_text", F.coalesce("text", F.lit("")))
    found = _base_spans(texts)
    if ratios is None:
        return found.withColumn("_spans", F.col("_base")).drop("_text")
    table = F.array(*[F.lit(float(r)) for r in ratios])
    runs = f"[A-Za-z0-9+/_=-]{{{settings.least_length},}}"
    found = found.withColumn("_runs", _spans("_text", runs, len(BASE_KINDS)))

    def random(run: Column) -> Column:
        total = F.aggregate(_pairs(run["body"]), F.lit(0.0), lambda t, p: t + F.get(table, p))
        return total >= settings.least_ratio * (F.length(run["body"]) - 1)

    def chosen(block: Column, near: Column) -> Column:
        free = lambda r: ~F.exists(near, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))
        return F.filter(block, lambda r: free(r) & random(r))

    def of_block(block: Column) -> Column:
        first, last = F.get(block, F.lit(0))["start"], F.element_at(block, -1)["end"]
        near = F.filter("_base", lambda b: (b["start"] < last) & (first < b["end"]))
        return _once(near, lambda n: chosen(block, n))

    more = F.flatten(F.transform(_in_blocks(F.col("_runs")), of_block))
    spans = F.when(F.size("_runs") > 0, F.array_sort(F.concat("_base", more))).otherwise(F.col("_base"))
    return found.withColumn("_spans", spans).drop("_runs", "_text")


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in (*BASE_KINDS, MARKOV)])
    parts = F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def digest(scanned: DataFrame) -> DataFrame:
    """One row a document: counts of the base kinds, a checksum of the base spans, all spans."""
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{BASE_KINDS[k]}")
    return scanned.select(
        "doc_id", count(0), count(1), count(2), F.sha2(listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("_spans")).alias("spans")
    )


def redacted(docs: DataFrame, ratios: list[float] | None, settings: Settings = Settings(), mark: str = "[secret]") -> DataFrame:
    """`docs` with each secret in `text` replaced by `mark` (overlapping ones by one), and n_chars, if there is one, to match."""

    def step(done: Column, span: Column) -> Column:
        gap = F.substring(F.col("text"), done["at"] + 1, span["start"] - done["at"])
        next_ = F.concat(done["text"], gap, F.lit(mark))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"), F.when(span["start"] >= done["at"], next_).otherwise(done["text"]).alias("text")
        )

    # The row travels as one value, so that none of its names can clash.
    scanned = scan(docs.select(F.struct(*docs.columns).alias("_row"), "text"), ratios, settings)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    rest = lambda d: F.concat(d["text"], F.substring(F.col("text"), d["at"] + 1, F.length("text")))
    found = F.size("_spans") > 0
    changed = scanned.withColumn("_clean", F.when(found, F.aggregate("_spans", start, step, rest)).otherwise(F.col("text")))
    new = {"text": F.col("_clean"), "n_chars": F.when(found, F.length("_clean").cast("long")).otherwise(F.col("_row").getField("n_chars"))}
    return changed.select(*[(new[c] if c in new else F.col("_row").getField(c)).alias(c) for c in docs.columns])
