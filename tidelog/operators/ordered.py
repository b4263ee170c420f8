"""Running values along an ordered log, without putting a whole log in one task.

A window partitioned by server alone is a single task for a busy server. Both
helpers cut the log into ranges of ``width`` order values, total each range,
carry those totals forward, and run the fine-grained window inside
``(by, range)``. Order values are unique per log, so a range never holds more
than ``width`` rows whatever the skew, and the carried totals are ``1/width`` of
the log. Every window inside a range shares the one ``(by, range)`` exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_WIDTH = 1 << 20
RANGE = "_range"


def with_range(df: DataFrame, order: str, width: int = DEFAULT_WIDTH) -> DataFrame:
    """Add the first order value of each row's range (integer arithmetic only), if it is not
    there from an earlier step: the planner then sees that rows already lie by range."""
    if RANGE in df.columns:
        return df
    return df.withColumn(RANGE, F.col(order) - F.pmod(F.col(order), F.lit(width).cast("bigint")))


def merged(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join two tables that both grow with the log.

    Spark sizes a table by its files and does not count what an explode adds, so without the hint
    it may send a side to the driver and every executor that is many times larger than it looks.
    """
    return left.join(right.hint("merge"), list(keys), how)


def latest(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    values: Mapping[str, Column],
    *,
    exclusive: Sequence[str] = (),
    source: DataFrame | None = None,
    keep_range: bool = False,
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Add, per name in ``values``, its latest non-null value at or before each row.

    Names in ``exclusive`` look strictly before the row. Range totals come from
    ``source`` where given: the same rows before other steps widened them, so those
    steps are not run again for the totals, which read only the columns they need.
    ``keep_range`` leaves the range column for a next step with the same order and width. The
    carried totals are one row per range that has any: with order values that are mostly unused
    (byte offsets, say) choose ``width`` so that a range holds many rows.
    """
    keys = [*by, RANGE]
    keyed = with_range(df, order, width)
    totals = keyed if source is None else with_range(source, order, width)
    carried = totals.groupBy(*keys).agg(*[
        F.max_by(v, F.when(v.isNotNull(), F.col(order))).alias(n) for n, v in values.items()
    ])
    before = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.select(
        *keys, *[F.last(n, ignorenulls=True).over(before).alias(f"_c_{n}") for n in values]
    )
    inside = Window.partitionBy(*keys).orderBy(order)
    local = keyed.withColumns({
        f"_l_{n}": F.last(v, ignorenulls=True).over(
            inside.rowsBetween(Window.unboundedPreceding, -1 if n in exclusive else 0)
        )
        for n, v in values.items()
    })
    return (
        local.join(carried, keys, "left")
        .withColumns({n: F.coalesce(f"_l_{n}", f"_c_{n}") for n in values})
        .drop(*([] if keep_range else [RANGE]), *[f"_l_{n}" for n in values],
              *[f"_c_{n}" for n in values])
    )


def positions(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    mark: Column | None = None,
    *,
    size: Column | None = None,
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Number the rows of each log and count the marked rows before each one.

    Adds ``rows_before``; with ``mark`` also ``marks_before`` and ``since_mark``
    (rows after the latest earlier marked row, not counting this one); with
    ``size`` also ``size_before``. Everything is strictly before the row.
    """
    keys = [*by, RANGE]
    inside = Window.partitionBy(*keys).orderBy(order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    marked = F.lit(False) if mark is None else F.coalesce(mark, F.lit(False))
    amount = F.lit(0) if size is None else F.coalesce(size, F.lit(0))
    counted = with_range(df, order, width).withColumns(
        {"_i": F.row_number().over(inside).cast("bigint"), "_m": marked, "_s": amount.cast("bigint")}
    )
    totals = counted.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if("_m").alias("_marks"),
        F.max(F.when(F.col("_m"), F.col("_i"))).alias("_last"),
        F.sum("_s").alias("_size"),
    )
    before = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    carried = (
        totals.withColumn("_n0", F.coalesce(F.sum("_n").over(before), zero))
        .withColumns({
            "_m0": F.coalesce(F.sum("_marks").over(before), zero),
            "_s0": F.coalesce(F.sum("_size").over(before), zero),
            "_at0": F.coalesce(F.max(F.col("_n0") + F.col("_last")).over(before), zero),
        })
        .select(*keys, "_n0", "_m0", "_s0", "_at0")
    )
    out = counted.join(carried, keys)
    added: dict[str, Column] = {"rows_before": F.col("_n0") + F.col("_i") - 1}
    if mark is not None:
        at = F.coalesce(
            F.col("_n0") + F.max(F.when(F.col("_m"), F.col("_i"))).over(earlier), F.col("_at0")
        )
        added["marks_before"] = F.col("_m0") + F.coalesce(
            F.sum(F.col("_m").cast("bigint")).over(earlier), zero
        )
        added["since_mark"] = F.col("_n0") + F.col("_i") - 1 - at
    if size is not None:
        added["size_before"] = F.col("_s0") + F.coalesce(F.sum("_s").over(earlier), zero)
    return out.withColumns(added).drop(RANGE, "_i", "_m", "_s", "_n0", "_m0", "_s0", "_at0")
