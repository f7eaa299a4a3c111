"""Removal of repeated byte strings by bucket-pointer refinement.

The suffixes that begin at the anchors (see `repeats`) are sorted as in suffix
array construction by bucket pointers: suffixes fall into buckets by their first
q-gram; a bucket is refined by sorting its suffixes on the bucket identifiers at
a later offset, so each round doubles the sorted depth and uses the buckets
refined before instead of the text. The same runs backwards over what precedes
the anchors. Neighbours that agree in enough bytes on both sides share a string
of ``window`` bytes, and every byte covered by such a string goes.

Edge cases: a null or empty text has no bytes and loses none, as does one
shorter than ``window`` bytes; all occurrences go, the first and overlapping
ones included; a repeated row is one more occurrence; an empty table gives an
empty result; other columns are ignored. Bytes are removed as such, so what
stays may begin or end inside a character; ``as_text`` drops such remains.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import BASES, BYTE_WEIGHTS, Block, mix, table
from marketlens.llm.repeats import Plan, remove_repeats

WINDOW = 400
GRAM = 32
Q = 8
GROUP_LIMIT = 512


def byte_grams(data: np.ndarray) -> np.ndarray:
    """Hash of the `GRAM` bytes from each position on."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), 0, (1,)) * BASES[0]
    x ^= x >> np.uint64(32)
    x = x[:-8] * BASES[1] + x[8:]
    x ^= x >> np.uint64(29)
    x = x[:-16] * BASES[2] + x[16:]
    return mix(x[:n])


def _units(b: Block):
    raw = b.data.tobytes()
    return BYTE_WEIGHTS[0][b.data], byte_grams(b.data), b.offsets, lambda x, y, tidy=False: raw[x:y]


def refine(grams: np.ndarray) -> np.ndarray:
    """Bucket of each row of a matrix of q-grams, in the rows' lexical order.

    ``bucket[:, j]`` starts as the q-gram's rank. A round sorts on the bucket and
    the bucket one stride later, which doubles the depth; only the offsets that a
    later round reads are kept.
    """
    _, b = np.unique(grams, return_inverse=True)
    b = b.reshape(grams.shape).astype(np.int64)
    while b.shape[1] > 1:
        head, later = b[:, ::2], b[:, 1::2]
        if later.shape[1] < head.shape[1]:
            later = np.concatenate([later, np.full((len(b), 1), -1)], 1)
        pair = head * (int(b.max()) + 2) + later + 1
        _, b = np.unique(pair, return_inverse=True)
        b = b.reshape(pair.shape).astype(np.int64)
    return b[:, 0]


def suffix_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the byte rows (a multiple of `Q` long), and bytes in which neighbours agree."""
    order = np.argsort(refine(rows.view(">u8").astype(np.uint64)), kind="stable")
    sorted_ = rows[order]
    same = sorted_[1:] == sorted_[:-1]
    return order, np.where(same.all(1), rows.shape[1], same.argmin(1))


def _order(texts: list[bytes], off: np.ndarray, window: int):
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    anchor = (ends - sizes + off)[:, None]
    step = np.arange(-(-window // Q) * Q)
    last = len(data) - 1
    right, left = anchor + step, anchor - 1 - step
    follow = np.where(right < ends[:, None], data[np.minimum(right, last)], 0).astype(np.uint8)
    before = np.where(left >= (ends - sizes)[:, None], data[np.maximum(left, 0)], 0).astype(np.uint8)
    return *suffix_sort(np.ascontiguousarray(follow)), *suffix_sort(np.ascontiguousarray(before))


def plan(window: int = WINDOW) -> Plan:
    """How strings of ``window`` bytes (at least `GRAM`) are found."""
    if window < GRAM:
        raise ValueError(f"window must be at least {GRAM} bytes")
    return Plan(window, GRAM, False, GROUP_LIMIT, 1 << 18, (48, 8, 1), _units, partial(_order, window=window))


def remove_repeated_bytes(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id",
                          text_col: str = "text", as_text: bool = False, window: int = WINDOW) -> DataFrame:
    """``keep`` columns, n_units (bytes), n_removed, n_spans and kept (bytes or text) of every row."""
    return remove_repeats(df, plan(window), keep, b"", id_col, text_col, as_text)


def without_repeats(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """The rows of ``df`` with their texts cut, as they are otherwise (n_chars, if there, follows the text).

    Bytes of strings of ``window`` bytes that occur elsewhere go. A null text
    stays null; a text that is one repeat becomes empty.
    """
    others = [c for c in df.columns if c != text_col]
    rows = df.select(F.struct(*others, F.col(text_col).isNull().alias("_none")).alias("_row"), F.col(id_col),
                     F.col(text_col))
    out = remove_repeated_bytes(rows, ("_row",), id_col, text_col, as_text=True, window=window)
    text = F.when(~F.col("_row._none"), F.col("kept"))
    value = {text_col: text, "n_chars": F.length(text).cast(df.schema["n_chars"].dataType)} if "n_chars" in others else {
        text_col: text}
    return out.select(*(value.get(c, F.col("_row")[c]).alias(c) for c in df.columns))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))
