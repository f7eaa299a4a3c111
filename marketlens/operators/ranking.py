"""Global ranking without a single-partition window.

``rank() over (order by x)``, ``ntile(k) over (order by x)`` and a running
numbering with no PARTITION BY make Spark plan ``Exchange SinglePartition``:
the whole table on one task. Here the same numbers come from a distributed
plan in three steps:

1. ``repartitionByRange`` on the sort keys (made unique by a tie-break, so
   even a value shared by a third of all rows spreads over many ranges),
   sort inside each range, tag every row with its range id ``_pid`` and its
   position ``_pos`` inside the range, and checkpoint to the cluster's
   checkpoint folder so the layout never changes between the uses below
   (the range bounds come from a sample and must not be re-drawn);
2. count rows per range: one row per range (as many as shuffle partitions,
   a proven small bound), exclusive prefix sums over that little table,
   broadcast;
3. global row number = offset of the range + position inside it.

NTILE follows from the global row number and the total count. RANK and
per-group numbering (``row_number``/``lag`` over ``partition by customer``)
sort by (group, order) the same way; one pass over each sorted range marks
where groups start and what the previous row held, and a per-range summary
(again one row per range) settles groups that cross range boundaries, so a
customer with a third of all rows is spread over many tasks and no second
shuffle is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.session import ensure_checkpoint_dir

# A sort spec is a column name plus a direction.
SortSpec = tuple[str, bool]  # (column, ascending)

_POS_SHIFT = 1 << 33  # monotonically_increasing_id = partition << 33 | index


def _sort_cols(specs: Sequence[SortSpec]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last() for c, asc in specs]


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null (group keys may be null)."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],  # a broadcast hint stays
                           *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def materialize_small(df: DataFrame) -> DataFrame:
    """Checkpoint a small aggregate (bounded by the calendar or a category
    list) before something reads it twice, e.g. a pivot that must first
    collect its distinct column values; the source pipeline then runs once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _with_sequence(tagged: DataFrame, group: Sequence[str], lags: Sequence[str]) -> DataFrame:
    """For every row of a range the local position where its group starts
    (``_gstart``), whether it belongs to the group the range opens with
    (``_head``, which may have started in an earlier range), and the previous
    row's values inside its group (``_lag_<col>``). Nulls are equal as keys."""
    at = Window.partitionBy("_pid").orderBy("_pos")
    upto = at.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = F.col("_pos") == 0
    same = F.lit(True)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(at))
    marked = tagged.withColumn("_new", opens | ~same)
    out = {"_gstart": F.last(F.when(F.col("_new"), F.col("_pos")), ignorenulls=True).over(upto),
           "_head": F.max((F.col("_new") & ~opens).cast("int")).over(upto) == 0}
    out |= {f"_lag_{c}": F.when(~F.col("_new"), F.lag(c).over(at)) for c in lags}
    return marked.withColumns(out).drop("_new")


def range_sorted(df: DataFrame, order: Sequence[SortSpec], num_partitions: int | None = None,
                 running_sum: str | None = None, sequence: tuple | None = None) -> DataFrame:
    """Range-partition and sort on ``order``; add ``_pid`` and ``_pos``; checkpoint.

    With ``running_sum`` (a non-negative integer column) each row also gets
    ``_cum_local``: the running sum of that column inside its range, in sort
    order. With ``sequence=(group_cols, lag_cols)`` each row gets the columns
    of `_with_sequence`. Both are windows over one range at a time, whatever
    the size of a group; they stay in the JVM, so 64-bit keys and decimals
    keep their values beside nulls and the workers need no package.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = _sort_cols(order)
    tagged = (df.repartitionByRange(n, *cols)
                .sortWithinPartitions(*cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id()
                            - F.col("_pid").cast("long") * F.lit(_POS_SHIFT)))
    if running_sum:
        upto = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        tagged = tagged.withColumn("_cum_local", F.sum(running_sum).over(upto))
    if sequence:
        tagged = _with_sequence(tagged, *sequence)
    ensure_checkpoint_dir(spark)
    return tagged.checkpoint(eager=True)


def bounded_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """``df`` checkpointed, and hinted for broadcast only if it turns out to
    have at most ``max_rows`` rows."""
    done = materialize_small(df)
    return F.broadcast(done) if done.limit(max_rows + 1).count() <= max_rows else done


def range_offsets(ranged: DataFrame) -> DataFrame:
    """One row per range: rows before it (``_offset``) and overall (``_total``)."""
    per_range = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    return per_range.select(
        "_pid",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(everything).alias("_total"),
    )


def with_global_row_number(df: DataFrame, order: Sequence[SortSpec], name: str = "row_number",
                           keep_total: bool = False, num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by ...)`` as a distributed plan.

    ``order`` must end in unique keys for the numbering to be deterministic.
    """
    ranged = range_sorted(df, order, num_partitions)
    offsets = range_offsets(ranged)  # one row per range partition
    out = (ranged.join(F.broadcast(offsets), "_pid")
                 .withColumn(name, F.col("_offset") + F.col("_pos") + F.lit(1)))
    drop = ["_pid", "_pos", "_offset"] + ([] if keep_total else ["_total"])
    return out.drop(*drop)


def ntile_of(g: Column, total: Column, k: int) -> Column:
    """NTILE(k) bucket of 1-based row ``g`` among ``total`` rows.

    The first ``total % k`` buckets hold one row more than the others.
    """
    q = F.floor(total / F.lit(k))
    r = total - q * F.lit(k)
    big = r * (q + F.lit(1))
    return (F.when(g <= big, F.ceil(g / (q + F.lit(1))))
             .otherwise(r + F.ceil((g - big) / F.greatest(q, F.lit(1))))).cast("int")


def with_global_ntile(df: DataFrame, order: Sequence[SortSpec], k: int, name: str,
                      num_partitions: int | None = None) -> DataFrame:
    """``ntile(k) over (order by ...)`` without a single-partition window."""
    numbered = with_global_row_number(df, order, "_g", keep_total=True, num_partitions=num_partitions)
    return (numbered.withColumn(name, ntile_of(F.col("_g"), F.col("_total"), k))
                    .drop("_g", "_total"))


def _sequence_summary(ranged: DataFrame, group: Sequence[str], lags: Sequence[str]) -> DataFrame:
    """One row per range (a bounded table): its row offset, whether its first
    group continues the previous range's last group (``_cont``), the global
    start of its head group (``_head_start``) and the previous range's last
    lag-source values (``_prev_<col>``).

    A group can span many ranges (one customer with a third of all rows);
    the start of such a group is carried forward over the ranges it fills
    with a last-non-null window over this small table.
    """
    g_first = F.min_by(F.struct(*[F.col(c) for c in group]), "_pos")
    last_cols = [F.col(c) for c in group] + [F.col(c) for c in lags] + [F.col("_gstart"), F.col("_head")]
    per = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), g_first.alias("_f"),
                                     F.max_by(F.struct(*last_cols), "_pos").alias("_l"))
    order = Window.orderBy("_pid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    per = per.withColumn("_pl", F.lag("_l").over(order))
    cont = F.lit(True)
    for c in group:
        cont = cont & F.col("_f")[c].eqNullSafe(F.col("_pl")[c])
    per = per.withColumn("_cont", F.col("_pl").isNotNull() & cont)
    # global start of the range's last group when this range alone shows it
    anchor = (F.when(~F.col("_l._head"), F.col("_offset") + F.col("_l._gstart"))
               .when(~F.col("_cont"), F.col("_offset")))
    per = per.withColumn("_x", F.last(anchor, ignorenulls=True).over(upto))
    per = per.withColumn("_head_start", F.when(~F.col("_cont"), F.col("_offset"))
                                         .otherwise(F.lag("_x").over(order)))
    return per.select("_pid", "_offset", "_cont", "_head_start",
                      *[F.col("_pl")[c].alias(f"_prev_{c}") for c in lags])


def _sequenced(df: DataFrame, spec: Sequence[SortSpec], group: Sequence[str], lags: Sequence[str],
               num_partitions: int | None) -> DataFrame:
    """Rows sorted by ``spec`` (which starts with the ``group`` columns) with
    ``_gpos`` (0-based global position), ``_start`` (global position where
    the row's group starts) and ``_lag_<col>`` columns."""
    ranged = range_sorted(df, spec, num_partitions, sequence=(list(group), list(lags)))
    summary = _sequence_summary(ranged, group, lags)  # one row per range partition
    out = ranged.join(F.broadcast(summary), "_pid")
    out = out.withColumns({
        "_gpos": F.col("_offset") + F.col("_pos"),
        "_start": F.when(F.col("_head"), F.col("_head_start")).otherwise(F.col("_offset") + F.col("_gstart")),
    })
    first_of_range = F.col("_pos") == 0
    for c in lags:
        out = out.withColumn(f"_lag_{c}", F.when(first_of_range, F.when(F.col("_cont"), F.col(f"_prev_{c}")))
                                           .otherwise(F.col(f"_lag_{c}")))
    return out.drop("_pid", "_pos", "_offset", "_cont", "_head_start", "_gstart", "_head",
                    *[f"_prev_{c}" for c in lags])


def with_global_rank(df: DataFrame, value: Sequence[SortSpec], tiebreak: Sequence[SortSpec], name: str,
                     num_partitions: int | None = None) -> DataFrame:
    """``rank() over (order by value)``: 1 + number of rows strictly before.

    Rows are placed in (value, tiebreak) order; the rank of a row is one
    more than the position where its run of equal values starts. A run of
    ties spanning many ranges (a value shared by a third of all rows) is
    resolved through the per-range summary, not gathered anywhere.
    """
    seq = _sequenced(df, list(value) + list(tiebreak), [c for c, _ in value], [], num_partitions)
    return seq.withColumn(name, (F.col("_start") + F.lit(1)).cast("int")).drop("_gpos", "_start")


def with_group_sequence(df: DataFrame, group: Sequence[str], order: Sequence[SortSpec],
                        number_name: str, lags: dict[str, str] | None = None,
                        num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` and ``lag(col)`` over ``partition by group order by ...``.

    Skew-safe and with a single shuffle: rows are range-sorted by (group,
    order) — a group holding a third of all rows spreads over many ranges —
    and one pass per range finds group starts and previous rows; groups and
    lags that cross a range boundary are settled through the per-range
    summary. ``order`` must make rows unique within a group. ``lags`` maps
    a source column to the output name of its lag.
    """
    lags = lags or {}
    spec = [(g, True) for g in group] + list(order)
    seq = _sequenced(df, spec, group, list(lags), num_partitions)
    seq = seq.withColumn(number_name, (F.col("_gpos") - F.col("_start") + F.lit(1)).cast("int"))
    for src, alias in lags.items():
        seq = seq.withColumnRenamed(f"_lag_{src}", alias)
    return seq.drop("_gpos", "_start")
