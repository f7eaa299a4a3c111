"""Values at given ranks, per group, without sorting the rows.

`select_ranks` finds what stands at a rank of each group's sorted values:

1. one scan counts each group and sketches it (`percentile_approx`, a
   mergeable quantile summary of bounded size), so a rank is known to lie in a
   *bracket* of values that holds some thousandths of the rows;
2. while a bracket may hold more than `LIMIT` rows, a further scan sketches
   the rows inside it and so narrows it by the same factor;
3. a last scan counts the rows below a bracket and, by value, those inside; a
   running sum over the few inside values gives the value at the rank. If the
   counts say that a rank is not inside its bracket, the bracket widens to all
   values and is narrowed anew, so the result never rests on the sketch.

All scans aggregate before they shuffle; a value shared by a third of all rows
is one counted row. Brackets and results have one row per group and rank: up to
`LOCAL_ROWS` of them are kept as a local relation and broadcast, more are
checkpointed and joined by the planner's choice.

`with_ntiles` assigns NTILE buckets of several orders at once: the last row of
each bucket is selected key column by key column, and every row is then compared
with these few constants.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, IntegralType

from marketlens.operators.ranking import SortSpec, join_on_keys, materialize_small
from marketlens.session import ensure_checkpoint_dir

#: Points of a sketch's grid, and its accuracy: ranks are off by a thousandth of the grid step's tenth at most.
GRID = 1000
ACCURACY = 10_000
#: Rows of a bracket that are counted by value.
LIMIT = 200_000
#: Scans after which something must be wrong: each one leaves some thousandths of a bracket's rows.
ROUNDS = 40
#: Rows of a side table that stay with the driver.
LOCAL_ROWS = 10_000
_LOW, _HIGH = float("-inf"), float("inf")


def small(df: DataFrame, max_rows: int | None = None) -> tuple[DataFrame, pa.Table | None]:
    """``df`` computed once: if it is small a local relation with a broadcast hint, and its
    rows; else a checkpoint."""
    max_rows = LOCAL_ROWS if max_rows is None else max_rows
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return materialize_small(df), None
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema=df.schema)), rows


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's checkpoint folder: a table that several scans read."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _sketch(inside: Column | None = None) -> Column:
    value = F.col("_s") if inside is None else F.when(inside, F.col("_s"))
    points = ", ".join(f"{i / GRID}D" for i in range(GRID + 1))
    return F.percentile_approx(value, F.expr(f"array({points})"), ACCURACY)  # one text, not a thousand literals


def _bracket(n: Column, before: Column, lo: Column, hi: Column, sketch: Column) -> tuple[Column, Column, Column]:
    """Bracket of the ranks _k0.._k1, and about how many rows it holds, from a sketch of the n
    rows after the first ``before``, which lie between lo and hi."""
    last = F.greatest(n - 1, F.lit(1))
    first = F.floor((F.col("_k0") - before) / last * GRID).cast("int") - 1
    end = F.ceil((F.col("_k1") - before) / last * GRID).cast("int") + 1
    return (F.when(first > 0, F.get(sketch, first)).otherwise(lo),
            F.when(end < GRID, F.get(sketch, end)).otherwise(hi),
            n * F.least(end - first + 1, F.lit(GRID)) / GRID)


def _joined(rows: DataFrame, brackets: DataFrame, by: Sequence[str]) -> DataFrame:
    if by:
        return join_on_keys(rows, brackets, by)
    # a row per target: without groups these ride along as constants
    return rows.select("*", F.inline(F.array(*[F.struct(*[F.lit(v).cast(brackets.schema[c].dataType).alias(c)
                                                          for c, v in b.asDict().items()]) for b in brackets.collect()])))


def _narrowed(rows: DataFrame, brackets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Brackets narrowed by a sketch of the rows strictly inside, so that the many rows of a
    value at an end cannot keep them wide; widened where they miss a rank."""
    s, lo, hi = F.col("_s"), F.col("_lo"), F.col("_hi")
    mid = (s > lo) & (s < hi)
    got = _joined(rows, brackets, by).where(s <= hi).groupBy(*by, "_t", "_k0", "_k1", "_lo", "_hi").agg(
        F.count_if(s < lo).alias("_before"), F.count_if(s == lo).alias("_at"), F.count_if(mid).alias("_n"),
        F.count(F.lit(1)).alias("_upto"), F.min(F.when(mid, s)).alias("_min"), F.max(F.when(mid, s)).alias("_max"),
        _sketch(mid).alias("_q"))
    k0, k1 = F.col("_k0"), F.col("_k1")
    begin = F.col("_before") + F.col("_at")  # ranks begin..end - 1 are strictly inside
    end = begin + F.col("_n")
    in0, in1 = (k0 >= begin) & (k0 < end), (k1 >= begin) & (k1 < end)
    near_lo, near_hi, few = _bracket(F.col("_n"), begin, F.col("_min"), F.col("_max"), F.col("_q"))
    new_lo = F.when(in0 & in1, near_lo).when(in0, F.col("_max")).when(k0 < begin, lo).otherwise(hi)
    new_hi = F.when(in0 & in1, near_hi).when(in1, F.col("_min")).when(k1 < begin, lo).otherwise(hi)
    found = (F.col("_before") <= k0) & (k1 < F.col("_upto"))
    return got.select(*by, "_t", "_k0", "_k1", F.when(found, new_lo).otherwise(F.lit(_LOW)).alias("_lo"),
                      F.when(found, new_hi).otherwise(F.lit(_HIGH)).alias("_hi"),
                      F.when(found & in0 & in1, few).when(found, F.lit(0.0)).otherwise(F.lit(_HIGH)).alias("_rows"))


def _picked(rows: DataFrame, brackets: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, _t, v0, v1, before, ties): the values at _k0 and _k1, and the rows before and at v0's value."""
    counted = (_joined(rows, brackets, by).where(F.col("_s") <= F.col("_hi"))
               .groupBy(*by, "_t", "_k0", "_k1", F.when(F.col("_s") >= F.col("_lo"), F.col("_x")).alias("_x"))
               .agg(F.count(F.lit(1)).alias("_c")))
    upto = Window.partitionBy(*by, "_t").orderBy(F.col("_x").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)  # the counted values of one bracket
    running = counted.withColumn("_end", F.sum("_c").over(upto)).where(F.col("_x").isNotNull())
    holds = lambda k: (F.col("_end") - F.col("_c") <= F.col(k)) & (F.col(k) < F.col("_end"))
    at = lambda c: F.max(F.when(holds("_k0"), c))
    return running.groupBy(*by, "_t", "_k0", "_k1").agg(
        at(F.col("_x")).alias("v0"), F.max(F.when(holds("_k1"), F.col("_x"))).alias("v1"),
        at(F.col("_end") - F.col("_c")).alias("before"), at(F.col("_c")).alias("ties"))


def select_ranks(rows: DataFrame, by: Sequence[str], ranks: Sequence[tuple[Column, Column]], value: str,
                 proxy: Column | None = None, also: Sequence[Column] = ()) -> tuple[DataFrame, DataFrame]:
    """Values at ranks of each group's values in ascending order; rows with a null value do not count.

    ``ranks`` gives, for target 0, 1, ..., a lower and an upper 0-based rank as expressions over
    the group's row count ``_n`` and the ``by`` columns. ``proxy`` is a double that never falls
    where ``value`` rises (default: its cast); only brackets are made from it. ``also`` are
    aggregates taken in the first scan.

    Returns (by, _t, _k0, _k1, v0, v1, before, ties), a row for each group and target, and
    (by, _n, also), a row for each group.
    """
    by = list(by)
    number = (F.col(value) if proxy is None else proxy).cast("double")
    rows = rows.withColumn("_x", F.col(value)).withColumn("_s", F.when(F.isnan(number), F.lit(_HIGH)).otherwise(number))
    first = rows.groupBy(*by).agg(F.count("_x").alias("_n"), _sketch().alias("_q"), *also)
    first, _ = small(first)
    groups = first.drop("_q")
    targets = F.posexplode(F.array(*[F.struct(lo.cast("long").alias("_k0"), hi.cast("long").alias("_k1"))
                                     for lo, hi in ranks])).alias("_t", "_k")
    each = first.where(F.col("_n") > 0).select("*", targets).select(
        *by, "_n", "_q", "_t", F.col("_k._k0").alias("_k0"), F.col("_k._k1").alias("_k1"))
    rows = rows.select(*by, "_x", "_s").where(F.col("_x").isNotNull())
    start = _bracket(F.col("_n"), F.lit(0), F.lit(_LOW), F.lit(_HIGH), F.col("_q"))
    brackets, known = small(each.select(*by, "_t", "_k0", "_k1", *[c.alias(k) for k, c in zip(("_lo", "_hi", "_rows"), start)]))
    done: list[DataFrame] = []
    for _ in range(ROUNDS):
        widest = pc.max(known["_rows"]).as_py() if known is not None else brackets.agg(F.max("_rows")).first()[0]
        if (widest or 0) > LIMIT:
            brackets, known = small(_narrowed(rows, brackets, by))
            continue
        picked, got = small(_picked(rows, brackets.drop("_rows"), by))
        if known is not None and got is not None and got.num_rows == known.num_rows and not (
                got["v0"].null_count or got["v1"].null_count):
            return reduce(DataFrame.unionByName, [*done, picked]), groups
        good = picked.where(F.col("v0").isNotNull() & F.col("v1").isNotNull())
        done.append(good)
        # targets whose rank was not in their bracket: narrow them from all values again
        missed = _anti(brackets, good, [*by, "_t"])
        if missed.isEmpty():
            return reduce(DataFrame.unionByName, done), groups
        brackets, known = small(missed.withColumns({"_lo": F.lit(_LOW), "_hi": F.lit(_HIGH), "_rows": F.lit(_HIGH)}))
    raise RuntimeError(f"{value}: ranks not found in {ROUNDS} rounds; does the proxy rise with the values?")


def _anti(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    return left.join(other, reduce(Column.__and__, [left[k].eqNullSafe(other[f"_r_{k}"]) for k in keys]), "left_anti")


# ------------------------------------------------------------------ NTILE by cut rows
_KEY = "decimal(38,6)"
_NULLS = "9" * 32  # null keys sort last in either direction


def _sort_key(name: str, kind: DataType, ascending: bool) -> Column:
    """A key column as an ascending number that holds it exactly."""
    c = F.col(name)
    if not (isinstance(kind, (DateType, IntegralType)) or isinstance(kind, DecimalType) and kind.scale <= 6):
        raise TypeError(f"{name}: buckets are cut by dates, integers and decimals, not by {kind.simpleString()}")
    key = (F.unix_date(c) if isinstance(kind, DateType) else c).try_cast(_KEY)
    wide = F.when(c.isNotNull(), F.raise_error(F.concat(F.lit(f"{name} is too wide for a bucket's key: "), c.cast("string"))))
    return F.coalesce(key if ascending else -key, wide.cast(_KEY), F.lit(_NULLS).cast(_KEY))


def with_ntiles(df: DataFrame, orders: Mapping[str, Sequence[SortSpec]], k: int) -> DataFrame:
    """A column ``ntile(k) over (order by ...)`` for each entry of ``orders`` (name -> sort keys).

    Each order must end in keys that make rows unique. ``df`` is read again for
    each key column, so it should be a table or a checkpoint. Rows are neither
    sorted nor shuffled: they are compared with at most k - 1 cut rows.
    """
    keys = {name: [_sort_key(c, df.schema[c].dataType, asc) for c, asc in spec] for name, spec in orders.items()}
    # (order, bucket) -> what is known of the bucket's last row: leading keys, and its rank among rows that share them
    open_: dict[tuple[str, int], tuple[list, int]] = {}
    cuts: dict[tuple[str, int], list] = {}

    def settle(picks) -> None:
        for (name, j), v, rank, before, ties in picks:
            head, _ = open_.pop((name, j), ([], 0))
            head = [*head, v]
            if rank - before == ties - 1 or len(head) == len(keys[name]):
                cuts[name, j] = head  # all rows with these keys belong to the bucket, or no key is left
            else:
                open_[name, j] = (head, rank - before)

    names = list(keys)
    long = df.select(F.posexplode(F.array(*[keys[n][0] for n in names])).alias("_g", "_v"))
    n = F.col("_n")
    last = [F.floor(n / k) * j + F.least(n % k, F.lit(j)) - 1 for j in range(1, k)]
    picked, _ = select_ranks(long, ["_g"], [(r, r) for r in last], "_v")
    settle(((names[r._g], r._t), r.v0, r._k0, r.before, r.ties) for r in picked.collect())
    while open_:
        at = list(open_)
        members = []
        for i, (name, j) in enumerate(at):
            head, _ = open_[name, j]
            same = reduce(Column.__and__, [keys[name][d] == F.lit(v) for d, v in enumerate(head)])
            members.append(F.when(same, F.struct(F.lit(i).alias("_g"), keys[name][len(head)].alias("_v"))))
        long = df.select(F.inline(F.filter(F.array(*members), lambda m: m.isNotNull())))
        rank = F.element_at(F.array(*[F.lit(open_[t][1]) for t in at]), F.col("_g") + 1)
        picked, _ = select_ranks(long, ["_g"], [(rank, rank)], "_v")
        settle([(at[r._g], r.v0, r._k0, r.before, r.ties) for r in picked.collect()])

    def beyond(name: str, cut: list) -> Column:
        """Whether a row comes after a cut row, keys compared one after the other."""
        out = F.lit(False)
        for key, v in reversed(list(zip(keys[name], cut))):
            out = (key > F.lit(v)) | ((key == F.lit(v)) & out)
        return out

    buckets = {name: reduce(Column.__add__, [beyond(name, cut).cast("int") for (x, _), cut in sorted(
        cuts.items(), key=lambda c: c[0]) if x == name], F.lit(1)) for name in names}
    return df.withColumns({name: b.cast("int") for name, b in buckets.items()})
