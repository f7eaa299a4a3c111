"""Quality rules with adaptive thresholds.

`text_statistics` counts, for every whole text, words, word characters, symbols,
repeated lines and repeated words. A first rule rejects texts that are very
short or repeat themselves. The other rules have no fixed cutoffs: each compares
a ratio of a text with an upper (or lower) fence of its language and source.

The fences come from a mergeable quantile sketch: a log-linear histogram of the
integer ratio (`SUB` linear steps in every power of two), so counts of buckets
simply add up, in any order, and any quantile is known to 1/`SUB` of its value.
Buckets are summed before the shuffle, so a source with most rows costs no more
than others. Sketches of groups merge into those of the language and of all
texts; a group of fewer than ``min_group`` texts uses the next wider sketch.

A fence is ``upper quartile + spread * (upper - lower quartile + slack)``: a
text is rejected only far outside its group, and a group of clean texts loses
none. Joined filtering: each text meets its group's fences by a join on
(language, source).

Edge cases: a null or empty text has no words and fails the base rule; null
languages and sources are groups of their own; texts without words take no part
in the sketches; repeated rows and ids are judged row by row; an empty table
gives an empty result; columns with clashing names are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.llm.common import (PLAIN_WORD, arrow_map, broadcast_if_small, materialize, out_batch, out_schema, table,
                                   text_batches, word_hashes, word_spans)

SUB = 32  # linear steps in each power of two
MIN_WORDS = 50
#: Ratio -> (numerator, denominator, side of the fence, slack); ratios and slacks are per 1000.
RATIOS = {
    "word_length": ("word_chars", "n_words", "both", 100),
    "symbols": ("n_symbols", "n_words", "upper", 20),
    "dup_lines": ("n_dup_lines", "n_lines", "upper", 80),
    "repeats": ("n_repeat_words", "n_words", "upper", 80),
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def repeated_words(h: np.ndarray) -> int:
    """Words inside 3-word windows that occur twice or more among ``h``."""
    if len(h) < 4:
        return 0
    _, w = np.unique(h, return_inverse=True)
    w = w.astype(np.int64)
    n = int(w.max()) + 1
    if n < 2**21:
        tri = (w[:-2] * n + w[1:-1]) * n + w[2:]
    else:
        _, pair = np.unique(w[:-1] * n + w[1:], return_inverse=True)
        tri = pair[:-1].astype(np.int64) * n + w[2:]
    _, inv, cnt = np.unique(tri, return_inverse=True, return_counts=True)
    twice = cnt[inv] >= 2
    hit = np.zeros(len(h), bool)
    hit[:-2] |= twice
    hit[1:-1] |= twice
    hit[2:] |= twice
    return int(hit.sum())


def text_statistics(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches, text_col):
            starts, ends, words = word_spans(b.data, b.offsets, PLAIN_WORD)
            h = word_hashes(b.data, starts, ends)
            lead = np.concatenate([[0], np.cumsum(PLAIN_WORD[b.data] & ((b.data & 0xC0) != 0x80))])
            symbol = np.concatenate([[0], np.cumsum(_SYMBOL[b.data])])
            raw = b.data.tobytes()
            lines, dup, rep = [], [], []
            for r in range(b.rows):
                found = [x for x in raw[b.offsets[r]:b.offsets[r + 1]].split(b"\n") if x.split(None, 1)]
                lines.append(len(found))
                dup.append(len(found) - len(set(found)))
                rep.append(repeated_words(h[words[r]:words[r + 1]]))
            cols = {c: b.batch.column(c) for c in keep}
            yield out_batch(
                pa.schema([*((c, x.type) for c, x in cols.items()), *((x, pa.int64()) for x in names)]), **cols,
                n_words=np.diff(words), word_chars=np.diff(lead[b.offsets]), n_symbols=np.diff(symbol[b.offsets]),
                n_lines=lines, n_dup_lines=dup, n_repeat_words=rep)

    return arrow_map(df.select(*dict.fromkeys([*keep, text_col])), run, out_schema(df, keep, ", ".join(f"{x} long" for x in names)))


def bucket(value: Column) -> Column:
    """Histogram bucket of a non-negative integer: exact below `SUB`, then `SUB`
    steps in each power of two. Integer arithmetic only."""
    shift = F.greatest(F.length(F.bin(value)) - F.lit(SUB.bit_length()), F.lit(0))
    return F.expr(f"{SUB}") * shift + F.call_function("shiftright", value, shift)


def bucket_top(b: Column) -> Column:
    """Largest value of a bucket."""
    shift = F.greatest(F.floor(b / SUB) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", b - SUB * shift + 1, shift) - 1


def sketches(stats: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ratio, bucket, n): the mergeable sketches of each group."""
    long = stats.where(F.col("n_words") > 0).select(*keys, F.explode(F.array(*(
        F.struct(F.lit(name).alias("ratio"),
                 F.floor(F.lit(1000) * F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("long").alias("value"))
        for name, (a, b, _, _) in RATIOS.items()))).alias("x"))
    return long.groupBy(*keys, F.col("x.ratio").alias("ratio"), bucket(F.col("x.value")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"))


def merge(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ratio, total, q1, q3) of each sketch; a sketch has a bounded number of buckets."""
    group = Window.partitionBy(*keys, "ratio")
    run = sketch.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn(
        "total", F.sum("n").over(group))
    at = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("total"), bucket_top(F.col("bucket"))))
    return run.groupBy(*keys, "ratio").agg(F.max("total").alias("total"), at(1).alias("q1"), at(3).alias("q3"))


def fences(stats: DataFrame, keys: tuple[str, str] = ("lang", "source"), min_group: int = 200, spread: int = 6) -> DataFrame:
    """(lang, source, <ratio>_low, <ratio>_high): limits of every group.

    A group below ``min_group`` texts takes its language's limits, a language
    below it those of all texts.
    """
    lang, source = keys
    fine = sketches(stats, [lang, source])
    # small: one row for each group, ratio and filled bucket
    levels = [quartiles(fine, [lang, source]), quartiles(merge(fine, [lang]), [lang]), quartiles(merge(fine, []), [])]
    named = [q.select(*(F.col(c).alias(f"{c}{i}") for c in q.columns)) for i, q in enumerate(levels)]
    j = named[0].join(named[1], F.col(f"{lang}0").eqNullSafe(F.col(f"{lang}1")) & (F.col("ratio0") == F.col("ratio1")))
    j = j.join(named[2], F.col("ratio0") == F.col("ratio2"))
    pick = lambda c: F.when(F.col("total0") >= min_group, F.col(f"{c}0")).when(
        F.col("total1") >= min_group, F.col(f"{c}1")).otherwise(F.col(f"{c}2"))
    q = j.select(F.col(f"{lang}0").alias(lang), F.col(f"{source}0").alias(source), F.col("ratio0").alias("ratio"),
                 pick("q1").alias("q1"), pick("q3").alias("q3"))
    side, reach = {}, {}
    for r, (_, _, s, slack) in RATIOS.items():
        side[r], reach[r] = s, spread * (F.col("q3") - F.col("q1") + slack)
    one = lambda r, c: F.max(F.when(F.col("ratio") == r, c))
    return q.groupBy(lang, source).agg(
        *(one(r, F.col("q1") - reach[r] if side[r] == "both" else F.lit(-1)).alias(f"{r}_low") for r in RATIOS),
        *(one(r, F.col("q3") + reach[r]).alias(f"{r}_high") for r in RATIOS))


def judge(stats: DataFrame, limits: DataFrame, keys: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """``stats`` with base_failed and kept."""
    lim = limits.select(*(F.col(k).alias(f"_{k}") for k in keys), *[c for c in limits.columns if c not in keys])
    j = stats.join(lim, [stats[k].eqNullSafe(lim[f"_{k}"]) for k in keys], "left")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    inside = F.lit(True)
    for r, (a, b, _, _) in RATIOS.items():
        v = F.floor(F.lit(1000) * F.col(a) / F.greatest(F.col(b), F.lit(1)))
        inside = inside & F.coalesce((v >= F.col(f"{r}_low")) & (v <= F.col(f"{r}_high")), F.lit(True))
    return j.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & inside).drop(
        *[c for c in lim.columns])


def quality_rules(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
                  **settings) -> DataFrame:
    """Statistics and verdict of every row."""
    stats = materialize(text_statistics(
        df.select(*keep, F.col(text_col), F.col("lang").alias("_g0"), F.col("source").alias("_g1")),
        text_col, (*keep, "_g0", "_g1")), "quality")
    return judge(stats, fences(stats, ("_g0", "_g1"), **settings), ("_g0", "_g1")).drop("_g0", "_g1")


def keep_good(df: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``df`` that the rules keep, as they are.

    The texts are read twice and never shuffled, unless there are too many groups
    for a broadcast of the limits.
    """
    groups = (F.col("lang").alias("_g0"), F.col("source").alias("_g1"), F.col(text_col).alias("_text"))
    limits = fences(materialize(text_statistics(df.select(*groups), "_text", ("_g0", "_g1")), "quality"),
                    ("_g0", "_g1"), **settings)
    stats = text_statistics(df.select(F.struct("*").alias("_row"), *groups), "_text", ("_row", "_g0", "_g1"))
    return judge(stats, broadcast_if_small(limits), ("_g0", "_g1")).where("kept").select("_row.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
