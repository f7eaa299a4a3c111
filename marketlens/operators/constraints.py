"""Declared constraints as one job: keys, references and row rules.

Every table is scanned once. A row of it gives a short tagged row

* for each key that it declares or that others refer to,
* for each reference that it holds, however many tables it refers to: keys that share a
  reference share its *space*, with a role for each key and each reference,
* for each row rule that it breaks (a space of its own).

All tagged rows meet in a single aggregate by (space, value), counted by role before the
shuffle, so a value that a third of all rows refer to is one row per task. A value
counted n times in a key's role breaks the key n - 1 times; a value without it makes all
its references orphans. A key of several columns keeps its first as the value and the
text of the others beside it.

A key of two columns whose first is a reference and whose second is an integer, as the
lines of an order, needs no tagged row for each of its values: the reference's row carries
the second column as one bit of 64, and as many rows break the key as the rows with a bit
exceed the bits. Rows with a null or a number beyond 0 to 63 are counted by value as others.

A rule is (table, label, kind, arguments): ``unique`` (columns), ``not_null``
(columns), ``fk`` (column, parent, parent column), ``check`` (SQL text; null passes).
Null references are no violation, a null key counts as a value. Values are compared
as text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

Rule = tuple[str, str, str, object]


def _text(columns: Sequence[str]) -> Column:
    """One text per tuple of values; a null is told from every text."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    part = [F.when(F.col(c).isNull(), "n").otherwise(
        F.concat(F.lit("v"), F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")))
        for c in columns]
    return F.concat(*part)


def broken(kind: str, args) -> Column:
    """Whether a row breaks a not-null or check rule."""
    if kind == "not_null":
        return reduce(Column.__or__, [F.col(c).isNull() for c in args])
    return ~F.coalesce(F.expr(args), F.lit(True))  # a CHECK passes on null


def _bit(column: str) -> Column:
    """A number from 0 to 63 as one bit of 64; null for all others."""
    return F.when(F.col(column).between(0, 63), F.expr(f"shiftleft(1L, CAST(`{column}` AS INT))"))


def _spaces(keys: Mapping[tuple, Sequence[tuple]]) -> tuple[dict, dict, dict]:
    """Space and role of each key, and (space, role) of each reference: keys with a common reference share a space."""
    number: dict[tuple, int] = {}
    for i, (key, refs) in enumerate(keys.items()):
        joined = {number[k] for k in number if set(keys[k]) & set(refs)}
        number = {k: i if n in joined else n for k, n in number.items()} | {key: i}
    key_role: dict[tuple, int] = {}
    ref_role: dict[tuple, int] = {}
    for space in sorted(set(number.values())):
        inside = [k for k in keys if number[k] == space]
        key_role.update({k: i for i, k in enumerate(inside)})
        for ref in dict.fromkeys(ref for k in inside for ref in keys[k]):
            ref_role[ref] = space, len(inside) + sum(s == space for s, _ in ref_role.values())
    return number, key_role, ref_role


def check_constraints(tables: Callable[[str], DataFrame], rules: Sequence[Rule],
                      same_rows: Mapping[str, str] | None = None) -> DataFrame:
    """(table_name, rule, violations), a row for each rule.

    ``same_rows`` maps a table to one that holds the same rows under the same column
    names, which is scanned in its place.
    """
    same = dict(same_rows or {})
    home = lambda table: same.get(table, table)
    keys: dict[tuple, list[tuple]] = {}  # (table, columns) -> references to it, as (table, column)
    for table, label, kind, args in rules:
        if kind == "unique":
            keys.setdefault((home(table), tuple(args)), [])
        elif kind == "fk":
            column, parent, parent_column = args
            keys.setdefault((home(parent), (parent_column,)), []).append((home(table), column))
        elif kind not in ("not_null", "check"):
            raise ValueError(f"{table} {label}: unknown kind {kind!r}")

    number, key_role, ref_role = _spaces(keys)
    tags: dict[str, dict[tuple, Column]] = {}  # table -> (space, role) -> tagged row
    counted: dict[tuple[int, int | None], int] = {}  # (role of a key, of a reference or None) -> violations' column
    place: list[tuple[int, int, int]] = []  # rule, space and violations' column; a rule's add up

    def tag(table: str, space: int, role: int, value: Column, rest: Column | None = None, bit: Column | None = None,
            when: Column | None = None) -> None:
        none = F.lit(None)
        row = F.struct(F.lit(space).alias("space"), F.lit(role).alias("role"), value.cast("string").alias("value"),
                       (none if rest is None else rest).cast("string").alias("rest"),
                       (none if bit is None else bit).cast("long").alias("bit"))
        tags.setdefault(table, {})[space, role] = row if when is None else F.when(when, row)

    def put(rule: int, space: int, key: int | None, ref: int | None = None) -> None:
        place.append((rule, space, counted.setdefault((key, ref), len(counted))))

    carried: dict[tuple, tuple] = {}  # reference -> key whose second column it carries
    for table, columns in keys:
        if len(columns) == 2 and (table, columns[0]) in ref_role and isinstance(
                tables(table).schema[columns[1]].dataType, IntegralType):
            carried.setdefault((table, columns[0]), (table, columns))
    for (table, columns), refs in keys.items():
        space = number[table, columns]
        bits = carried.get((table, columns[0])) == (table, columns)
        tag(table, space, key_role[table, columns], F.col(columns[0]), _text(columns[1:]) if columns[1:] else None,
            when=F.col(columns[0]).isNull() | _bit(columns[1]).isNull() if bits else None)
        for at in refs:
            tag(at[0], space, ref_role[at][1], F.col(at[1]), when=F.col(at[1]).isNotNull(),
                bit=_bit(carried[at][1][1]) if at in carried else None)
    row_rules: dict[tuple, int] = {}
    for i, (table, _, kind, args) in enumerate(rules):
        table = home(table)
        if kind == "unique":
            key = table, tuple(args)
            put(i, number[key], key_role[key])
            if carried.get((table, args[0])) == key:
                put(i, ref_role[table, args[0]][0], None, ref_role[table, args[0]][1])
        elif kind == "fk":
            parent = home(args[1]), (args[2],)
            put(i, number[parent], key_role[parent], ref_role[table, args[0]][1])
        else:  # rows that break it are references without a key
            first = max(number.values(), default=-1) + 1
            space = row_rules.setdefault((table, kind, str(args)), first + len(row_rules))
            tag(table, space, 1, F.lit(""), when=broken(kind, args))
            put(i, space, 0, 1)

    rows = [tables(table).select(F.inline(F.array(*of.values()))).where(F.col("space").isNotNull())
            for table, of in tags.items()]
    most = max(role for of in tags.values() for _, role in of)
    by_value = reduce(DataFrame.unionByName, rows).groupBy("space", "value", "rest").agg(
        *[F.count_if(F.col("role") == r).alias(f"n{r}") for r in range(most + 1)],
        *[f(F.when(F.col("role") == r, F.col("bit"))).alias(f"{name}{r}") for r in sorted({ref_role[at][1] for at in carried})
          for f, name in ((F.count, "b"), (F.bit_or, "bits"))])

    def violated(key: int | None, ref: int | None) -> Column:
        if ref is None:
            return F.greatest(F.col(f"n{key}") - 1, F.lit(0))
        if key is None:
            return F.col(f"b{ref}") - F.bit_count(F.coalesce(f"bits{ref}", F.lit(0).cast("long")))
        return F.when(F.col(f"n{key}") == 0, F.col(f"n{ref}"))

    counts = by_value.groupBy("space").agg(*[F.sum(violated(*of)).alias(f"v{i}") for of, i in counted.items()])
    of_rule = F.inline(F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(rules[i][0]).alias("table_name"),
                                          F.lit(rules[i][1]).alias("rule"), F.lit(d).alias("space"), F.lit(v).alias("_v"))
                                 for i, d, v in place]))
    spark = counts.sparkSession
    listed = spark.range(1).select(of_rule)
    violations = F.element_at(F.array(*[F.col(f"v{i}") for i in range(len(counted))]), F.col("_v") + 1)
    each = listed.join(F.broadcast(counts), "space", "left").groupBy("_i", "table_name", "rule").agg(  # a row per space
        F.sum(F.coalesce(violations, F.lit(0))).cast("long").alias("violations"))
    return each.orderBy("_i").drop("_i")
