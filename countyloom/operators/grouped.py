"""Grouped aggregation with exact medians that hold up when one group has a large share of all rows.

Groups of ordinary size are sorted by their values after one shuffle of the rows, and the rows of the middle ranks picked while
the other measures are added up. That costs the same whether groups are few or nearly as many as rows, where the built-in
median builds, stores and merges a buffer for each. The built-in one is used where measures stand apart, and for several medians
at once. Groups above a row limit take another exact route, radix selection: values are
counted first, which collapses repeated values before the shuffle; then the bits of the middle values are found from the
top, some at a time, by counting the values behind each choice of the next bits. No task sees a whole group, however
close together its values lie.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countyloom.sources.storage import ensure_checkpoint_dir

# A group with more rows than this does not use the single-buffer median.
LARGE_GROUP = 100_000

# Keys of large groups are broadcast up to this many; beyond it the join is left to the optimizer.
BROADCAST_KEYS = 20_000

# Bits of a value that are decided in a round, so that a round has at most 2^13 choices for a group; and the number of
# distinct values left below which they are ordered instead.
RADIX_BITS = 13
FEW_VALUES = 4096

# Group keys travel as one struct: a struct with null fields is a value like any other, equal to itself, so nulls group and
# join like the rest, and plans keep plain equi-joins that reuse the grouping's partitions.
KEY = "_key"


def with_key(rows: DataFrame, keys: Sequence[str], name: str = KEY) -> DataFrame:
    """`rows` with its keys as one struct beside them."""
    return rows.withColumn(name, F.struct(*[F.col(k) for k in keys]))


def unpacked(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key's fields as columns again, in front of the others."""
    others = [c for c in rows.columns if c != KEY]
    return rows.select(*[F.col(f"{KEY}.{k}").alias(k) for k in keys], *others)


def ordered_bits(value: Column) -> Column:
    """The bits of a double as a long that has the order of the numbers: infinities at the ends, NaN above them, one zero."""
    plain = value.cast("double") + F.lit(0.0)  # -0.0 + 0.0 is 0.0
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), plain).cast("bigint")
    return F.when(value.isNotNull(), F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(2**63 - 1))))


def grouped_median(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact median of `value` per group by radix selection, as (keys..., name); null keys are keys. Runs a job a round.

    Groups without a value do not appear.
    """
    return unpacked(_median_by_key(with_key(rows, keys), value, name), keys)


def _median_by_key(rows: DataFrame, value: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(rows.sparkSession)
    counts = (
        rows.select(KEY, F.col(value).cast("double").alias("_value"))
        .where(F.col("_value").isNotNull())
        .groupBy(KEY, "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bits", ordered_bits(F.col("_value")))
        .checkpoint()
    )
    # A row for each middle rank of a group (two, if its values are even in number): which values can still have it.
    totals = counts.groupBy(KEY).agg(F.sum("_n").alias("_total"))
    ranks = F.array_distinct(F.array(F.floor((F.col("_total") + 1) / 2), F.floor(F.col("_total") / 2) + 1))
    sought = totals.select(KEY, F.explode(ranks).alias("_middle")).withColumn("_rank", F.col("_middle")).withColumn("_prefix", F.lit(0)).checkpoint()
    known, in_rank = 0, Window.partitionBy(KEY, "_middle")
    while known < 64:
        before, known = known, min(64, known + RADIX_BITS)
        upto = F.sum("_n").over(in_rank.orderBy("_next").rowsBetween(Window.unboundedPreceding, 0))
        sought = (
            _behind(counts, sought, before)
            .groupBy(KEY, "_middle", "_rank", F.shiftright("_bits", 64 - known).alias("_next"))
            .agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_values"))
            .withColumn("_upto", upto)
            .where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank")))
            .select(KEY, "_middle", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"), F.col("_next").alias("_prefix"), "_values")
            .checkpoint()
        )
        most = sought.agg(F.max("_values")).first()[0]
        if most is None or most <= FEW_VALUES:
            break
    upto = F.sum("_n").over(in_rank.orderBy("_value").rowsBetween(Window.unboundedPreceding, 0))
    chosen = (
        _behind(counts, sought, known)
        .withColumn("_upto", upto)
        .where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank")))
    )
    return chosen.groupBy(KEY).agg(halfway(F.min("_value"), F.max("_value")).alias(name))


def _behind(counts: DataFrame, sought: DataFrame, known: int) -> DataFrame:
    """The counted values whose first `known` bits are those of a middle rank; all values of its group if none is known."""
    wanted = _small(sought.select(KEY, "_middle", "_rank", "_prefix"), sought.count())
    # Shifts of a long count modulo 64, so that none at all needs a form of its own.
    prefix = F.shiftright("_bits", 64 - known) if known else F.lit(0)
    return counts.withColumn("_prefix", prefix.cast("bigint")).join(wanted.withColumn("_prefix", F.col("_prefix").cast("bigint")), [KEY, "_prefix"])


def halfway(low: Column, high: Column) -> Column:
    """The middle of the two middle values, by the formula of the built-in median, so that both routes give the same number."""
    return F.when(low == high, low).otherwise(low * 0.5 + high * 0.5)


def _above(sizes: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """Keys whose `_n` adds up to more than `limit`, checkpointed so that no later plan counts again."""
    found = sizes.groupBy(KEY).agg(F.sum("_n").alias("_n")).where(F.col("_n") > limit).select(KEY).checkpoint()
    return found, found.count()


def _small(keys: DataFrame, n: int) -> DataFrame:
    """Broadcast a key list whose length is known and short; leave a longer one to the optimizer. The rows are the same."""
    return F.broadcast(keys) if n <= BROADCAST_KEYS else keys


def large_groups(
    rows: DataFrame, keys: Sequence[str], limit: int, cells: DataFrame | None = None
) -> tuple[DataFrame, int]:
    """Key structs of the groups with more than `limit` rows, and how many there are. Runs a counting job.

    `cells` are rows counted beforehand (`row_count`) at any grain that holds some of the keys. A group cannot be
    larger than the coarser group around it, so cells often settle the question without reading rows, and
    otherwise restrict the counting to the few coarse groups that matter.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    keys = list(keys)
    if cells is not None:
        coarse = [k for k in keys if k in cells.columns]
        around, n = _above(with_key(cells, coarse).withColumn("_n", F.col("row_count")), limit)
        if n == 0 or coarse == keys:
            return around, n
        around = _small(around.withColumnRenamed(KEY, "_coarse"), n)
        rows = with_key(rows, coarse, "_coarse").join(around, "_coarse", "left_semi")
    return _above(with_key(rows, keys).withColumn("_n", F.lit(1)), limit)


def _sorted_groups(rows: DataFrame, keys: list[str], measures: Mapping[str, Column], value: str, name: str) -> DataFrame:
    """Measures and one median in a single pass over rows that are shuffled once and sorted within their groups.

    The keys' hash leads the sort order, so that rows are mostly compared by one number.
    """
    group = Window.partitionBy("_hash", *keys)
    number = F.col(value).cast("double")
    ranked = rows.withColumn("_hash", F.xxhash64(*keys)).withColumns(
        {"_at": F.row_number().over(group.orderBy(F.col(value).asc_nulls_last())), "_known": F.count(value).over(group)}
    )
    low = F.max(F.when(F.col("_at") == F.floor((F.col("_known") + 1) / 2), number))
    high = F.max(F.when(F.col("_at") == F.floor(F.col("_known") / 2) + 1, number))
    plain = [m.alias(n) for n, m in measures.items()]
    found = ranked.groupBy("_hash", *keys).agg(*plain, low.alias("_low"), high.alias("_high"))
    return found.select(*keys, *measures, halfway(F.col("_low"), F.col("_high")).alias(name))


def summarise(
    rows: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    medians: Mapping[str, str],
    cells: DataFrame | None = None,
    large_group: int = LARGE_GROUP,
    apart: bool = False,
) -> DataFrame:
    """Group by `keys` with ordinary `measures` plus exact `medians` (result name → value column).

    Without large groups (see `large_groups` for `cells`) this is one aggregation. Otherwise measures keep their
    hash aggregate, medians are computed apart for ordinary and for large groups, and join back on the keys.

    `apart` always computes medians in an aggregation of their own. Use it when a measure counts distinct
    values: in one plan the median buffers would be shuffled per key and distinct value.
    """
    keys = list(keys)
    keyed = with_key(rows, keys)
    plain = [m.alias(n) for n, m in measures.items()]
    builtin = [F.median(value).alias(name) for name, value in medians.items()]
    large, n_large = large_groups(rows, keys, large_group, cells)
    if n_large == 0 and not apart and len(medians) == 1:
        ((name, value),) = medians.items()
        return _sorted_groups(rows, keys, measures, value, name)
    if n_large == 0 and not apart:
        return unpacked(keyed.groupBy(KEY).agg(*plain, *builtin), keys)
    base = keyed.groupBy(KEY).agg(*plain)
    if n_large == 0:
        # Both sides are already partitioned by the keys, so this join adds no shuffle.
        return unpacked(base.join(keyed.groupBy(KEY).agg(*builtin), KEY), keys)

    large = _small(large, n_large)
    ordinary = keyed.join(large, KEY, "left_anti").groupBy(KEY).agg(*builtin)
    in_large = keyed.join(large, KEY, "left_semi")
    heavy = None
    for name, value in medians.items():
        one = _median_by_key(in_large, value, name)
        heavy = one if heavy is None else heavy.join(one, KEY, "full")
    return unpacked(base.join(ordinary.unionByName(heavy), KEY, "left"), keys)
