"""Packing into length buckets that minimise padding.

Texts longer than ``max_tokens`` are cut into pieces of that length and a rest.
The histogram of piece lengths has at most ``max_tokens`` entries, whatever the
corpus, and covers all of it. Dynamic programming over the histogram picks the
``buckets`` upper bounds with the least padding. Inside a bucket, sequences form
batches of as many as fit a budget of padded tokens.

Batch numbers need a position in the whole bucket: pieces are numbered inside
small shares of a bucket (by a hash of the id), and the shares' sizes, summed
up, give their offsets. So a bucket with most pieces is never sorted at once.

The registered query packs the tokens that `token_counts` finds for a tokenizer,
so its bounds and budget are numbers of tokens; `word_counts` is for callers
without a tokenizer.

Edge cases: a null, empty or wordless text is one piece of 0 tokens without
bucket or batch; repeated rows are packed each; fewer distinct lengths than
buckets give one bucket for each length; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.llm.common import PLAIN_WORD, arrow_map, materialize, out_batch, out_schema, table, text_batches, word_spans
from marketlens.llm.token_counts import token_counts


def word_counts(df: DataFrame, keep: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """``keep`` columns and n_tokens: the blank-separated words of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches, text_col):
            _, _, words = word_spans(b.data, b.offsets, PLAIN_WORD)
            cols = {c: b.batch.column(c) for c in keep}
            yield out_batch(pa.schema([*((c, x.type) for c, x in cols.items()), ("n_tokens", pa.int64())]),
                            **cols, n_tokens=np.diff(words))
    return arrow_map(df.select(*dict.fromkeys([*keep, text_col])), run, out_schema(df, keep, "n_tokens long"))


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of the buckets with the least total padding.

    ``lengths`` ascending and distinct. least[j] is the least padding of the
    first j lengths in the buckets so far; a bucket over lengths i..j-1 pads its
    pieces to lengths[j-1]. Ties go to the smaller i.
    """
    n = len(lengths)
    if n <= buckets:
        return [int(x) for x in lengths]
    many = np.concatenate([[0], np.cumsum(counts)]).astype(float)
    total = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(float)
    least = np.full(n + 1, np.inf)
    least[0] = 0
    cuts = np.zeros((buckets + 1, n + 1), np.int64)
    for b in range(1, buckets + 1):
        new = np.full(n + 1, np.inf)
        for j in range(1, n + 1):
            cost = least[:j] + lengths[j - 1] * (many[j] - many[:j]) - (total[j] - total[:j])
            cuts[b, j] = i = int(cost.argmin())
            new[j] = cost[i]
        least = new
    out, j = [], n
    for b in range(buckets, 0, -1):
        out.append(int(lengths[j - 1]))
        j = int(cuts[b, j])
        if j == 0:
            break
    return out[::-1]


def pack(counts: DataFrame, id_col: str = "doc_id", max_tokens: int = 4096, buckets: int = 16,
         budget: int = 65536) -> DataFrame:
    """(id, piece, n_tokens, bucket, batch, slot) of every piece of ``counts`` (id, n_tokens)."""
    if budget < max_tokens:
        raise ValueError("the budget must hold a longest sequence")
    n = F.col("n_tokens")
    pieces = counts.select(id_col, "n_tokens", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.ceil(n / max_tokens) - 1, F.lit(0)))).alias("piece")).select(
        id_col, "piece", F.least(n - F.col("piece") * max_tokens, F.lit(max_tokens)).alias("n_tokens"))
    # at most max_tokens rows
    hist = sorted((r["n_tokens"], r["n"]) for r in pieces.groupBy("n_tokens").agg(
        F.count(F.lit(1)).alias("n")).collect())
    total = sum(c for _, c in hist)
    used = [(x, c) for x, c in hist if x > 0]
    bounds = best_bounds(np.array([x for x, _ in used], np.int64), np.array([c for _, c in used], np.int64), buckets)
    shares = min(4096, max(1, total // 1000))

    bucket = F.lit(None).cast("int")
    for b in reversed(bounds):
        bucket = F.when((n <= b) & (n > 0), F.lit(b)).otherwise(bucket)
    dealt = pieces.withColumn("bucket", bucket).withColumn(
        "share", F.pmod(F.xxhash64(id_col, "piece", "bucket"), F.lit(shares)).cast("int"))
    sizes = dealt.groupBy("bucket", "share").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.partitionBy("bucket").orderBy("share").rowsBetween(
        Window.unboundedPreceding, -1))
    offsets = sizes.select(F.col("bucket").alias("_b"), F.col("share").alias("_s"),
                           F.coalesce(before, F.lit(0)).alias("_o"))
    inside = Window.partitionBy("bucket", "share").orderBy(id_col, "piece", "n_tokens")
    at = dealt.withColumn("at", F.row_number().over(inside) - 1)
    j = at.join(offsets, at["bucket"].eqNullSafe(offsets["_b"]) & (at["share"] == offsets["_s"]))
    place = j.withColumn("place", F.col("at") + F.col("_o")).withColumn(
        "room", F.floor(F.lit(budget) / F.col("bucket")))
    return place.select(
        id_col, "piece", "n_tokens", "bucket",
        F.when(F.col("bucket").isNotNull(), F.floor(F.col("place") / F.col("room"))).cast("long").alias("batch"),
        F.when(F.col("bucket").isNotNull(), F.col("place") % F.col("room")).cast("long").alias("slot"))


def op8_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    model = str(public_tokenizers.path("piece_bpe_32k.model"))
    counts = token_counts(table(spark, sf_dir, "documents"), model).select("doc_id", "n_tokens")
    return pack(materialize(counts, "lengths"))
