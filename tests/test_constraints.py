"""Declared constraints as one job, on planted violations."""

import re

import pytest
from pyspark.sql import functions as F

from marketlens.operators.constraints import check_constraints
from marketlens.plans import warehouse

RULES = [
    ("parent", "pk", "unique", ("id",)),
    ("child", "pk", "unique", ("a", "b")),
    ("child", "not_null", "not_null", ("a", "id")),
    ("child", "fk", "fk", ("id", "parent", "id")),
    ("other", "fk", "fk", ("ref", "parent", "id")),
    ("copy", "fk", "fk", ("id", "parent", "id")),
    ("copy", "pk", "unique", ("a", "b")),
    ("other", "fk_unkeyed", "fk", ("code", "codes", "code")),
    ("other", "positive", "check", "n > 0"),
    ("other", "small", "check", "n < 10"),
]


def tables(spark):
    made = {
        "parent": ([(1,), (2,), (2,), (2,), (None,), (None,)], "id long"),
        "child": ([("x", "y", 1), ("x", "y", 9), ("x", None, 2), ("x", None, 9), ("xy", "", None), ("x", "y,", 9),
                   (None, "n", 1), ("n", None, 1)], "a string, b string, id long"),
        "other": ([("1", "u", 5), ("7", "v", 0), (None, None, None), ("2", "u", 11)] + [("7", "u", 1)] * 50,
                  "ref string, code string, n int"),
        "codes": ([("u",), ("u",)], "code string"),
        "empty": ([], "id long"),
    }
    made["copy"] = made["child"]
    return {k: spark.createDataFrame(*v).repartition(3) for k, v in made.items()}


def report(spark, rules, same=None):
    t = tables(spark)
    rows = check_constraints(lambda n: t[n], rules, same).collect()
    assert [(r.table_name, r.rule) for r in rows].sort() == [r[:2] for r in rules].sort()
    return {(r.table_name, r.rule): r.violations for r in rows}


@pytest.mark.parametrize("same", [None, {"copy": "child"}])
def test_planted_violations(spark, same):
    assert report(spark, RULES, same) == {
        ("parent", "pk"): 3, ("child", "pk"): 2, ("child", "not_null"): 2, ("child", "fk"): 3, ("other", "fk"): 51,
        ("copy", "fk"): 3, ("copy", "pk"): 2, ("other", "fk_unkeyed"): 1, ("other", "positive"): 1, ("other", "small"): 1}


def test_empty_tables_and_parents(spark):
    rules = [("empty", "pk", "unique", ("id",)), ("child", "fk_none", "fk", ("id", "empty", "id")),
             ("empty", "fk", "fk", ("id", "parent", "id")), ("empty", "check", "check", "id > 0")]
    assert report(spark, rules) == {("empty", "pk"): 0, ("child", "fk_none"): 7, ("empty", "fk"): 0, ("empty", "check"): 0}


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        report(spark, [("parent", "x", "other", ())])


def scans(df):
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return len(re.findall("FileScan", plan))


def test_each_table_is_scanned_once(spark):
    import os

    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    integrity = E.queries()["integrity_report"](spark, sf)
    assert scans(integrity) < 20 and integrity._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") < 30
    assert scans(E.queries()["shop_integrity_report"](spark, sf)) <= 7
    assert scans(E.queries()["warehouse_row_counts"](spark, sf)) < 20
    rows = {(r.table_name, r.rule): r.violations for r in integrity.collect()}
    assert set(rows) == {r[:2] for r in warehouse.INTEGRITY_RULES}
    assert rows["raw_order_items", "pk"] == rows["fact_order_items", "pk"] > 0


def test_hot_references_are_counted_before_the_shuffle(spark):
    t = {"parent": spark.createDataFrame([(1,)], "id long"),
         "child": spark.range(0, 20_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 5).otherwise(1).alias("id"))}
    out = check_constraints(lambda n: t[n], [("child", "fk", "fk", ("id", "parent", "id"))])
    assert out.first().violations == 6667
    assert "partial_count_if" in out._jdf.queryExecution().sparkPlan().toString() or "partial" in \
        out._jdf.queryExecution().executedPlan().toString()


def lines(spark):
    """Orders with numbered lines: repeated, beyond 0 to 63, negative and null numbers; null and unknown orders."""
    t = {"head": spark.createDataFrame([("1",), ("2",), ("2",)], "id string"),
         "copy": spark.createDataFrame([("1",), ("3",)], "id string"),
         "line": spark.createDataFrame(
             [("1", 0), ("1", 0), ("1", 63), ("1", 63), ("1", 63), ("1", 64), ("1", 64), ("1", -1), ("1", -1), ("1", 1),
              ("1", None), ("1", None), ("2", 1), ("2", 2), ("7", 5), ("7", 5), (None, 3), (None, 3), (None, None), (None, 64)]
             + [("3", n) for n in range(-2, 70)], "id string, n int").repartition(3)}
    rules = [("line", "pk", "unique", ("id", "n")), ("line", "fk", "fk", ("id", "head", "id")),
             ("line", "fk_copy", "fk", ("id", "copy", "id")), ("head", "pk", "unique", ("id",)),
             ("copy", "pk", "unique", ("id",)), ("line", "n", "not_null", ("n",))]
    return t, rules


def test_numbered_lines(spark):
    t, rules = lines(spark)
    rows = check_constraints(lambda n: t[n], rules).collect()
    assert [tuple(r) for r in rows] == [("line", "pk", 8), ("line", "fk", 74), ("line", "fk_copy", 4), ("head", "pk", 1),
                                        ("copy", "pk", 0), ("line", "n", 3)]


def test_a_line_is_one_tagged_row(spark):
    """Small line numbers ride along with the reference, which is sent once however many tables it refers to."""
    t, rules = lines(spark)
    t["line"] = spark.range(0, 4000, 1, 2).select((F.col("id") % 100).cast("string").alias("id"),
                                                  F.floor(F.col("id") / 100).cast("int").alias("n"))
    out = check_constraints(lambda n: t[n], rules)
    rows = {(r.table_name, r.rule): r.violations for r in out.collect()}
    assert rows["line", "pk"] == 0 and rows["line", "fk"] == 3920 and rows["line", "fk_copy"] == 3920
    plan = out._jdf.queryExecution().executedPlan()
    sent = []

    def walk(p):
        if p.nodeName() == "Exchange":
            sent.append(p.metrics().apply("shuffleRecordsWritten").value())
        kids = [p.executedPlan()] if p.nodeName() == "AdaptiveSparkPlan" else [p.plan()] if "QueryStage" in p.nodeName() else []
        for i in range(p.children().size()):
            kids.append(p.children().apply(i))
        for k in kids:
            walk(k)
    walk(plan)
    assert sent and max(sent) < 1000  # a row for each of the 4000 lines is not among them
