"""Removal of repeated word windows by prefix-partitioned suffix trees.

The suffixes that begin at the anchors (see `repeats`) form a sparse suffix
tree over the corpus. It is cut into subtrees by prefix: suffixes with the same
first `PREFIX` words meet in a group, and a group too large for memory is
divided by longer prefixes (of 13, then 18 words), whose groups are subtrees
like any other; at last, by whole windows, told by their hashes. A subtree is kept as its
leaves in suffix order with the common lengths of neighbours; a node of depth d
is a run of leaves whose neighbours agree in d words. A second, like tree holds
what precedes the anchors. Deep nodes of both give the maximal repeats: leaves
under one node of depth ``window`` - l whose l words to the left agree as well
share a window, and all but the earliest lose its words.

Edge cases: a null or empty text has no words and loses none, as does a text of
fewer than ``window`` words; the earliest occurrence (smallest id, then place)
stays, overlapping ones of a document included; rows that repeat an id and a
text are one document; documents without an id come last; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import PLAIN_WORD, Block, gram_hashes, table, word_hashes, word_spans
from marketlens.llm.repeats import Plan, remove_repeats

WINDOW = 20
PREFIX = 4
GROUP_LIMIT = 256


def _units(b: Block):
    starts, ends, rows = word_spans(b.data, b.offsets, PLAIN_WORD)
    h = word_hashes(b.data, starts, ends)
    raw = b.data.tobytes()

    def cut(x: int, y: int, tidy: bool = False) -> bytes:
        if x >= y:
            return b""
        part = raw[starts[x]:ends[y - 1]]
        return b" ".join(part.split()) if tidy else part

    return h, gram_hashes(h, PREFIX), rows, cut


def tree(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaves in suffix order, and the words in which neighbours agree."""
    order = np.lexsort(words.T[::-1])
    sorted_ = words[order]
    same = sorted_[1:] == sorted_[:-1]
    common = np.where(same.all(1), words.shape[1], same.argmin(1))
    return order, common


def _order(texts: list[bytes], off: np.ndarray):
    sizes = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts, ends, rows = word_spans(data, offsets, PLAIN_WORD)
    _, word = np.unique(word_hashes(data, starts, ends), return_inverse=True)
    anchor = rows[:-1] + off
    step = np.arange(WINDOW)
    right = anchor[:, None] + step
    left = anchor[:, None] - 1 - step
    last = len(word) - 1
    right_words = np.where(right < rows[1:, None], word[np.clip(right, 0, last)], -1)
    left_words = np.where(left >= rows[:-1, None], word[np.clip(left, 0, last)], -1)
    return *tree(right_words), *tree(left_words)


PLAN = Plan(WINDOW, PREFIX, True, GROUP_LIMIT, 1 << 20, (8, 3, 1), _units, _order)


def remove_repeated_windows(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """``keep`` columns, n_units (words), n_removed, n_spans and kept (words joined by blanks) of every row."""
    return remove_repeats(df, PLAN, keep, b" ", id_col, text_col)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_windows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n_units").alias("n_words"), "n_removed",
                      F.sha2("kept", 256).alias("kept_sha256"))
