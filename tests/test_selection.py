"""Selection of ranks and NTILE cuts against plain windows and numpy."""

import datetime as dt
import decimal
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens import Tables
from marketlens.operators import quantiles as Q
from marketlens.operators import selection as S
from marketlens.plans import shop

SMALL = {"GRID": 20, "ACCURACY": 200, "LIMIT": 12}  # many rounds on few rows


def rows_of(spark, n=900, seed=3, distinct=400):
    rnd = random.Random(seed)
    data = [(rnd.choice([None, "a", "b", "hot", "hot", "hot"]), rnd.choice([None, 42, 42, rnd.randrange(distinct)]), i)
            for i in range(n)] + [("empty", None, -1), ("one", 7, -2)]
    return data, spark.createDataFrame(data, "g string, v int, id long").repartition(5)


@pytest.mark.parametrize("settings", [{}, SMALL, SMALL | {"LOCAL_ROWS": 2}])
def test_ranks_of_groups(spark, monkeypatch, settings):
    for name, v in settings.items():
        monkeypatch.setattr(S, name, v)
    data, df = rows_of(spark)
    n = F.col("_n")
    ranks = [(F.floor(n / 3), F.least(F.floor(n / 3) + 1, n - 1)), (F.lit(0), F.lit(0)), (n - 1, n - 1)]
    picked, groups = S.select_ranks(df, ["g"], ranks, "v", also=[F.max("id").alias("top")])
    by = {}
    for g, v, _ in data:
        by.setdefault(g, []).extend([] if v is None else [v])
    assert {r.g: r._n for r in groups.collect()} == {g: len(v) for g, v in by.items()}
    got = {(r.g, r._t): (r.v0, r.v1, r.before, r.ties) for r in picked.collect()}
    want = {}
    for g, values in by.items():
        values = sorted(values)
        for t, (a, b) in enumerate([(len(values) // 3, min(len(values) // 3 + 1, len(values) - 1)), (0, 0),
                                    (len(values) - 1, len(values) - 1)] if values else []):
            want[g, t] = values[a], values[b], sum(v < values[a] for v in values), values.count(values[a])
    assert got == want


def test_a_wrong_bracket_widens(spark, monkeypatch):
    """Whatever the sketch says, the counts decide."""
    data, df = rows_of(spark, 300)
    monkeypatch.setattr(S, "_sketch", lambda inside=None: F.array(*[F.lit(10.0**6)] * 1001))
    monkeypatch.setattr(S, "LIMIT", 50)
    calls, narrowed = [], S._narrowed

    def second(rows, brackets, by):
        calls.append(1)
        monkeypatch.undo()
        return narrowed(rows, brackets, by)

    monkeypatch.setattr(S, "_narrowed", second)
    picked, _ = S.select_ranks(df, ["g"], [(F.floor(F.col("_n") / 2), F.floor(F.col("_n") / 2))], "v")
    for r in picked.collect():
        values = sorted(v for g, v, _ in data if g == r.g and v is not None)
        assert r.v0 == values[len(values) // 2]
    assert calls


@pytest.mark.parametrize("settings", [{}, SMALL])
def test_quantiles_without_groups(spark, monkeypatch, settings):
    for name, v in settings.items():
        monkeypatch.setattr(S, name, v)
    values = np.random.default_rng(1).integers(0, 50, 700) / 4
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = Q.quantiles(df, "v", [0.1, 0.5, 0.75], ["a", "b", "c"], also=[F.count("v").alias("count")]).collect()
    assert len(got) == 1 and got[0]["count"] == 700
    assert np.allclose([got[0].a, got[0].b, got[0].c], np.percentile(values, [10, 50, 75]))


def test_quantiles_of_groups_and_empty_groups(spark):
    data, df = rows_of(spark)
    got = {r.g: (r.q, r.m) for r in Q.quantiles(df, "v", [0.25, 0.5], ["q", "m"], by=["g"]).collect()}
    for g in {g for g, _, _ in data}:
        values = [v for x, v, _ in data if x == g and v is not None]
        assert got[g] == (tuple(np.percentile(values, [25, 50])) if values else (None, None))
    assert Q.quantiles(df.limit(0), "v", [0.5], ["m"], by=["g"]).collect() == []


def keyed(spark, n, seed):
    rnd = random.Random(seed)
    day = dt.date(2020, 1, 1)
    data = [(i, rnd.choice([None, day, day, day + dt.timedelta(rnd.randrange(40))]),
             rnd.choice([None, decimal.Decimal("1.25"), decimal.Decimal(rnd.randrange(400)) / 100]), rnd.choice([5, 5, None, 6]))
            for i in range(n)]
    return spark.createDataFrame(data, "id long, day date, money decimal(22,2), few int").repartition(4)


@pytest.mark.parametrize("settings", [{}, SMALL])
@pytest.mark.parametrize("n, k", [(0, 3), (1, 3), (5, 8), (601, 7)])
def test_ntiles_equal_windows(spark, monkeypatch, settings, n, k):
    for name, v in settings.items():
        monkeypatch.setattr(S, name, v)
    df = keyed(spark, n, n + k)
    orders = {"a": [("day", False), ("id", True)], "b": [("few", True), ("money", False), ("id", False)],
              "c": [("money", True), ("id", True)]}
    got = S.with_ntiles(df, orders, k)
    cols = {name: F.ntile(k).over(Window.orderBy(*[F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last()
                                                   for c, up in spec])).alias(f"{name}_ref") for name, spec in orders.items()}
    both = got.join(df.select("id", *cols.values()), "id")
    assert both.count() == n
    assert both.where(" or ".join(f"{x} <> {x}_ref" for x in orders)).count() == 0


def test_ntiles_refuse_keys_they_cannot_hold(spark):
    with pytest.raises(TypeError):
        S.with_ntiles(spark.createDataFrame([("a",)], "s string"), {"x": [("s", True)]}, 3)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rfm_neither_sorts_nor_numbers_its_rows(spark):
    """Tied scores reach across all tasks; the plan compares rows with constants."""
    n = 240
    day = dt.date(2021, 5, 1)
    made = {
        "customers": ([(i, f"c{i}", "x", day) for i in range(n)], "customer_id long, name string, city string, signup_date date"),
        "orders": ([(i, i, day, "completed") for i in range(n)], "order_id long, customer_id long, order_date date, status string"),
        "order_items": ([(i, decimal.Decimal("10.00")) for i in range(n)], "order_id long, line_revenue decimal(22,2)")}
    t = Tables(spark, {k: lambda v=v: spark.createDataFrame(*v).repartition(7) for k, v in made.items()})
    out = shop.rfm_segments(t)
    rows = {r.customer_id: (r.r_score, r.f_score, r.m_score) for r in out.collect()}
    assert rows == {i: (1 + i * 3 // n,) * 3 for i in range(n)}
    assert "Window" not in plan_of(out) and "RangePartitioning" not in plan_of(out.drop("rfm_total").groupBy("segment").count())
