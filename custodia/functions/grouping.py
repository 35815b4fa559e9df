"""Grouping helpers that stay flat when a few groups hold most of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from custodia.sources.workspace import written


def roll_up(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    value: Column,
    quantiles: Mapping[str, float],
) -> DataFrame:
    """Additive ``measures`` plus exact percentiles of ``value`` per ``keys``.

    A report often has four groups and a whole fact table behind them. Grouping
    straight to four rows would leave four reducers merging one value map per
    map task. Grouping to (keys, value) first spreads that work over the whole
    cluster and leaves only the distinct values, each with its frequency, for
    the final step. Measures must be sums or counts; ``value`` may be null.
    """
    spread = df.groupBy(*keys, value.alias("_value")).agg(
        F.count(value).alias("_weight"),
        *[measure.alias(name) for name, measure in measures.items()],
    )
    return spread.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in measures],
        *[
            F.percentile("_value", F.lit(p), F.col("_weight")).alias(name)
            for name, p in quantiles.items()
        ],
        F.max("_value").alias("_largest"),
    )


def fold(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Add up already aggregated columns over coarser keys."""
    return df.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in names])


def _tile(position: Column, total: Column, tiles: int) -> Column:
    """NTILE bucket of a zero-based position: the first ``total % tiles`` buckets get one more."""
    base, extra = F.floor(total / tiles), total % tiles
    head = extra * (base + 1)
    late = F.floor(F.try_divide(position - head, base)) + extra + 1
    return (
        F.when(position < head, F.floor(position / (base + 1)) + 1).otherwise(late).cast("long")
    )


# Spreads equal values of a tile's sort column. A prime keeps it even for any key pattern.
TIE_BUCKETS = 65521


def tiled(
    df: DataFrame,
    partition: str,
    order: str,
    key: str,
    tiles: int,
    measures: Mapping[str, Column],
) -> DataFrame:
    """Additive ``measures`` per (``partition``, NTILE(``tiles``) over ``order``).

    Ties of ``order`` are split by (``key`` mod TIE_BUCKETS, ``key``). A window
    over the rows would sort each partition in one task, so positions come
    from counts instead: rows are counted per value, and only values that
    straddle a tile edge are looked at more closely, first per tie bucket, then
    row by row inside the few tie buckets on an edge.

    How the counts meet the rows is left to the planner, which knows their size.
    """
    place = Window.partitionBy(partition).orderBy(F.col(order).asc_nulls_last())
    counts = df.groupBy(partition, order).agg(F.count(F.lit(1)).alias("_n"))
    values = counts.select(
        F.col(partition).alias("_p"),
        F.col(order).alias("_o"),
        (F.sum("_n").over(place) - F.col("_n")).alias("_start"),
        F.col("_n"),
        F.sum("_n").over(Window.partitionBy(partition)).alias("_total"),
    ).withColumn(
        "_split",
        _tile(F.col("_start"), F.col("_total"), tiles)
        < _tile(F.col("_start") + F.col("_n") - 1, F.col("_total"), tiles),
    )

    bucket = F.when(F.col("_split"), F.pmod(F.col(key), F.lit(TIE_BUCKETS)))
    rows = df.join(
        values,
        (F.col(partition) == F.col("_p")) & F.col(order).eqNullSafe(F.col("_o")),
    ).withColumn("_bucket", bucket)

    in_value = Window.partitionBy("_p", "_o").orderBy("_bucket")
    cells = (
        rows.groupBy("_p", "_o", "_bucket", "_start", "_total")
        .agg(
            F.count(F.lit(1)).alias("_cell"),
            *[measure.alias(name) for name, measure in measures.items()],
        )
        .withColumn("_from", F.col("_start") + F.sum("_cell").over(in_value) - F.col("_cell"))
        .withColumn("tile", _tile(F.col("_from"), F.col("_total"), tiles))
        .withColumn(
            "_edge",
            F.col("tile") < _tile(F.col("_from") + F.col("_cell") - 1, F.col("_total"), tiles),
        )
    )
    settled = cells.filter(~F.col("_edge")).select(F.col("_p").alias(partition), "tile", *measures)

    edges = cells.filter("_edge").select(
        F.col("_p").alias("_ep"), F.col("_o").alias("_eo"), F.col("_bucket").alias("_eb"), "_from"
    )
    by_key = Window.partitionBy("_p", "_o", "_bucket").orderBy(key)
    split_rows = (
        rows.filter("_split")
        .join(
            edges,
            (F.col("_p") == F.col("_ep"))
            & F.col("_o").eqNullSafe(F.col("_eo"))
            & (F.col("_bucket") == F.col("_eb")),
        )
        .withColumn(
            "tile",
            _tile(F.col("_from") + F.row_number().over(by_key) - 1, F.col("_total"), tiles),
        )
        .groupBy(partition, "tile")
        .agg(*[measure.alias(name) for name, measure in measures.items()])
    )
    return fold(settled.unionByName(split_rows), [partition, "tile"], list(measures))


def numbered(
    df: DataFrame, key: str, name: str, start: Column, prefix: int = 4, digest: bool = False
) -> DataFrame:
    """Dense numbers in the order of a unique text ``key``, counted from ``start`` + 1.

    Equal to ROW_NUMBER() OVER (ORDER BY key), but counted per key prefix so that
    no single task sees every row. A hexadecimal ``digest`` has at most 65,536
    prefixes, evenly filled, whose offsets are then sent to every task.
    """
    return _counted_on(df.withColumn("_head", F.substring(F.col(key), 1, prefix)), key, name, start, digest)


def numbered_by_range(df: DataFrame, key: str, name: str, start: Column) -> DataFrame:
    """:func:`numbered` for a text ``key`` whose first letters are often the same, such as a name.

    Rows are dealt by ranges of the key and written with the number of their range, which is then
    the same when ranges are counted and when their rows are ranked. There are as many ranges as
    shuffle partitions. Rows without a key are left out, as :func:`numbered` does.
    """
    dealt = df.filter(F.col(key).isNotNull()).repartitionByRange(F.col(key))
    return _counted_on(written(dealt.withColumn("_head", F.spark_partition_id()), "ranges"), key, name, start, True)


def _counted_on(df: DataFrame, key: str, name: str, start: Column, few_heads: bool) -> DataFrame:
    """Ranks inside each ``_head`` plus the rows of all heads before it."""
    offsets = (
        df.groupBy("_head")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            F.col("_head"),
            (F.sum("_n").over(Window.orderBy("_head")) - F.col("_n")).alias("_before"),
        )
    )
    inside = Window.partitionBy("_head").orderBy(key)
    return (
        df.join(F.broadcast(offsets) if few_heads else offsets, "_head")
        .withColumn(name, (start + F.col("_before") + F.row_number().over(inside)).cast("long"))
        .drop("_head", "_before")
    )


# Buckets for each doubling of a value: at most 2 * 63 * 1024 buckets of whole numbers.
PER_DOUBLING = 1024


def percentile_of_counts(counted: DataFrame, value: str, weight: str, p: float, name: str) -> DataFrame:
    """One row with the exact, interpolated percentile of whole numbers that occur ``weight`` times.

    The aggregate of that name holds all distinct values in one task. Here counts of buckets, which
    grow in proportion to the value, show the one or two buckets in which the percentile lies; only
    their values are put in order. Null values take no part; without values the result is null.
    """
    size = F.floor(F.log2(F.abs(value) + 1) * PER_DOUBLING)
    values = counted.filter(F.col(value).isNotNull()).select(
        F.col(value).alias("_v"), F.col(weight).alias("_n"), (F.signum(value) * size).cast("int").alias("_bucket")
    )
    position = (F.col("_total") - 1) * F.lit(p)
    buckets = (
        values.groupBy("_bucket")
        .agg(F.sum("_n").alias("_size"))
        .select(
            F.col("_bucket").alias("_b"),
            (F.sum("_size").over(Window.orderBy("_bucket")) - F.col("_size")).alias("_start"),
            "_size",
            F.sum("_size").over(Window.partitionBy(F.lit(0))).alias("_total"),
        )
        .withColumns({"_low": F.floor(position), "_high": F.ceil(position), "_part": position - F.floor(position)})
        .filter((F.col("_start") <= F.col("_high")) & (F.col("_start") + F.col("_size") > F.col("_low")))
    )
    before = F.sum("_n").over(Window.partitionBy("_bucket").orderBy("_v")) - F.col("_n")
    ranked = values.join(F.broadcast(buckets), F.col("_bucket") == F.col("_b")).withColumn("_from", F.col("_start") + before)

    def at(rank: str) -> Column:
        held = (F.col("_from") <= F.col(rank)) & (F.col(rank) < F.col("_from") + F.col("_n"))
        return F.max(F.when(held, F.col("_v")))

    return ranked.agg((at("_low") + (at("_high") - at("_low")) * F.max("_part")).alias(name))


SALTS = 64


def hot_join(
    rows: DataFrame, lookup: DataFrame, key: str, hot_value: str, spread_by: Sequence[str]
) -> DataFrame:
    """Left join on ``key`` when one known value may stand for a large part of the rows.

    Rows with that value are spread over SALTS join keys by ``spread_by``, and the
    lookup's one row for it is repeated as often. Other values join as usual.
    """
    is_hot = F.col(key) == hot_value
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = lookup.withColumn("_salt", F.explode(copies))
    return (
        rows.withColumn("_salt", F.when(is_hot, salt).otherwise(0))
        .join(salted, [key, "_salt"], "left")
        .drop("_salt")
    )
