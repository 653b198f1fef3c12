"""Ordered analytics that hold when one group is a large share of all rows.

A plain ``row_number() over (partition by source order by row_index)`` puts a whole source
into one task. Here a group is cut into *blocks* of its order key, the window runs inside a
block, and the blocks' totals, a far smaller table, are themselves summed in order and added
back by an equi-join on ``(group, block)``. Results are exact and independent of the number
of partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quern.session import materialize

#: Rows of one group that share a window: at most ``2**BLOCK_BITS`` for unique integer keys.
BLOCK_BITS = 14

_BLOCK = "__block"
_SUPER = "__superblock"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def with_blocks(df: DataFrame, order: str | Sequence[str], n_ranges: int | None = None) -> DataFrame:
    """Add ``__block``, a long that never decreases along ``order``.

    One integer key is cut by its high bits, with no extra pass. Any other key is split
    into ranges by Spark's own range partitioner and written out once, so that every later
    read sees the same block numbers.
    """
    keys = _as_list(order)
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, _INTEGRAL):
        return df.withColumn(_BLOCK, _never_null(F.shiftright(F.col(keys[0]).cast("long"), BLOCK_BITS)))
    n_ranges = n_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n_ranges, *keys)
    return materialize(ranged.withColumn(_BLOCK, F.spark_partition_id().cast("long")), "ranges")


def whole_div(value: Column, divisor: int | Column) -> Column:
    """Integer division, exact for every long; ``/`` would go through a double."""
    divisor = divisor if isinstance(divisor, Column) else F.lit(divisor)
    return F.call_function("div", value, divisor)


def _never_null(block: Column) -> Column:
    return F.coalesce(block.cast("long"), F.lit(-(1 << 62)).cast("long"))


def _join_key(df: DataFrame, group: str) -> Column:
    """A group column in a form that joins NULL with NULL.

    Being non-nullable it also spares the joins their null filters, which would make the
    otherwise equal scans below them differ and be read twice.
    """
    column = F.col(f"`{group}`")
    if not df.schema[group].nullable:
        return column
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def ordered_sums(
    df: DataFrame,
    group: str | Sequence[str],
    order: str | Sequence[str],
    sums: Mapping[str, Column],
    totals: Mapping[str, str] | None = None,
    block: Column | None = None,
) -> DataFrame:
    """Add, for each ``name: value`` of ``sums``, the sum of ``value`` over *earlier* rows.

    ``totals`` maps a name of ``sums`` to a column that receives the whole group's sum.
    ``(group, order)`` must identify a row; ``block``, if given, must not decrease along
    ``order`` (callers with a hash order pass its leading digits).
    """
    keys, totals = _as_list(order), dict(totals or {})
    if block is None:
        blocked = with_blocks(df, keys)
    else:
        blocked = df.withColumn(_BLOCK, _never_null(block))
    names = _as_list(group)
    groups = [f"__g{i}" for i in range(len(names))]
    blocked = blocked.select(
        "*",
        *[_join_key(df, n).alias(g) for n, g in zip(names, groups)],
        *[v.cast("long").alias(f"__v_{n}") for n, v in sums.items()],
    )

    in_block = Window.partitionBy(*groups, _BLOCK).orderBy(*keys)
    before = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = blocked
    for name in sums:
        value = F.col(f"__v_{name}")
        rows = rows.withColumn(f"__l_{name}", F.sum(value).over(before) - value)

    per_block = blocked.groupBy(*groups, _BLOCK).agg(
        *[F.sum(f"__v_{n}").alias(f"__v_{n}") for n in sums]
    ).withColumn(_SUPER, F.shiftright(_BLOCK, BLOCK_BITS))
    per_super = per_block.groupBy(*groups, _SUPER).agg(
        *[F.sum(f"__v_{n}").alias(f"__v_{n}") for n in sums]
    )
    over_supers = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(_SUPER)
    whole = Window.partitionBy(*(groups or [F.lit(0)]))
    upto = over_supers.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    super_base = per_super.select(
        *groups,
        _SUPER,
        *[(F.sum(f"__v_{n}").over(upto) - F.col(f"__v_{n}")).alias(f"__s_{n}") for n in sums],
        *[F.sum(f"__v_{n}").over(whole).alias(t) for n, t in totals.items()],
    )
    over_blocks = (
        Window.partitionBy(*groups, _SUPER)
        .orderBy(_BLOCK)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    block_base = (
        per_block.select(
            *groups,
            _SUPER,
            _BLOCK,
            *[(F.sum(f"__v_{n}").over(over_blocks) - F.col(f"__v_{n}")).alias(f"__b_{n}") for n in sums],
        )
        .join(super_base, [*groups, _SUPER])
        .select(
            *groups,
            _BLOCK,
            *[(F.col(f"__b_{n}") + F.col(f"__s_{n}")).alias(f"__b_{n}") for n in sums],
            *totals.values(),
        )
    )
    # The window leaves rows partitioned and sorted by (group, block): a merge join moves only
    # the block table, and nothing whose size grows with the data is broadcast.
    joined = rows.join(block_base.hint("merge"), [*groups, _BLOCK])
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.col(f"__l_{n}") + F.col(f"__b_{n}")).alias(n) for n in sums],
        *totals.values(),
    )


def with_ordinal(
    df: DataFrame,
    group: str | Sequence[str],
    order: str | Sequence[str],
    name: str = "ordinal",
    total: str | None = None,
    block: Column | None = None,
) -> DataFrame:
    """Zero-based position of each row in its group, and optionally the group's row count."""
    return ordered_sums(
        df, group, order, {name: F.lit(1)}, {name: total} if total else None, block=block
    )


def with_position(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Zero-based position of each row among all, along keys that identify it.

    Rows are cut into ranges, sorted and written once, numbered where they are; only the ranges' row
    counts, one for each shuffle partition, are summed and broadcast.
    """
    n_ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n_ranges, *order).sortWithinPartitions(*order)
    # The number of the partition, and in the low 33 bits that of the row in it.
    stored = materialize(ranged.withColumn("__at", F.monotonically_increasing_id()), "ranges")
    counts = stored.groupBy(F.shiftright("__at", 33).alias("__range")).agg(F.count("*").alias("__rows"))
    upto = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bases = counts.select("__range", (F.sum("__rows").over(upto) - F.col("__rows")).alias("__base"))
    joined = stored.join(F.broadcast(bases), F.shiftright("__at", 33) == F.col("__range"))
    position = F.col("__base") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], position.alias(name))


def with_offsets(
    df: DataFrame,
    group: str | Sequence[str],
    order: str | Sequence[str],
    length: str,
    start: str = "start",
    end: str = "end",
) -> DataFrame:
    """Running ``[start, end)`` of every row when the group's rows are laid end to end."""
    out = ordered_sums(df, group, order, {start: F.col(length)})
    return out.withColumn(end, F.col(start) + F.col(length))


#: A group up to this many narrow rows may be handled by one task.
GROUP_ROWS = 1 << 20
#: At most this many groups can be oversized, so their list may be broadcast.
OVERSIZED_GROUPS = 100_000


def oversized_groups(df: DataFrame, group: str) -> DataFrame | None:
    """Groups with too many rows for one task, or None when there is none.

    The limit is ``GROUP_ROWS``, or a hundred-thousandth of all rows if that is more: the
    list can then not exceed ``OVERSIZED_GROUPS`` entries.
    """
    counts = df.groupBy(group).agg(F.count("*").alias("rows"))
    largest, total = counts.agg(F.max("rows"), F.sum("rows")).first()
    limit = max(GROUP_ROWS, (total or 0) // OVERSIZED_GROUPS)
    if (largest or 0) <= limit:
        return None
    return counts.where(F.col("rows") > limit).select(group)


def by_group_size(
    df: DataFrame,
    group: str,
    whole: Callable[[DataFrame], DataFrame],
    blocked: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Apply ``whole`` to groups that fit a task and ``blocked`` to the others.

    Both must compute the same; ``blocked`` is the plan for groups of any size.
    """
    hot = oversized_groups(df, group)
    if hot is None:
        return whole(df)
    listed = F.broadcast(hot)
    small = whole(df.join(listed, group, "left_anti"))
    return small.unionByName(blocked(df.join(listed, group, "left_semi")))


def seeded_key(seed: int | str, *parts: Column | str) -> Column:
    """A hash order that any engine with MD5 can reproduce: ``md5('seed-part-part…')``."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def seeded_block(key: Column) -> Column:
    """The first four hex digits of a :func:`seeded_key`: 65,536 even, ordered blocks."""
    return F.conv(F.substring(key, 1, 4), 16, 10).cast("long")
