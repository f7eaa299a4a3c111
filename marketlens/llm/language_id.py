"""Language identification by compression.

Each language gets a zstandard raw-content dictionary: a bounded sample of its
training texts, joined. Case and non-letters carry no weight (`plain`). A text is compressed with each dictionary, all of it in
pieces of `PIECE` bytes, and takes the language whose output is smallest. The margin to the
second smallest output, set against the size of a text, gives a score between 0
and 1; below ``min_score`` the prediction counts as rejected.

Training sample: per language at most about ``dict_bytes`` bytes, taken from the
distinct texts with the smallest hashes of their content; `training_sample`
documents the bound. All languages found take part, each with a dictionary;
nothing is dropped for being rare, copied often or very long.

Edge cases: a null text, or one without a letter, is `und` with score 0 and
rejected; without training rows every text is `und`; equal sizes go to the
language that comes first by name, with score 0.5 or less; repeated rows are
predicted each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.llm.common import arrow_map, broadcast_if_small, out_batch, out_schema, table, text_batches

UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
#: Bytes compressed at a time: a long text would soon be its own dictionary.
PIECE = 2048


def smallest_hashes(rows: DataFrame, dict_bytes: int) -> DataFrame:
    """(lang, h, size) of ``rows``: per task and language the distinct hashes,
    ascending, until their sizes reach ``dict_bytes``.

    Lists of two tasks merge into the list of both: what comes first among all
    comes first in its own task. So no bound is guessed and no language is missed.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            code = b.column(0).dictionary_encode()
            which, h, size = (x.to_numpy(zero_copy_only=False) for x in (code.indices, b.column(1), b.column(2)))
            by_lang = np.argsort(which, kind="stable")
            ends = np.cumsum(np.bincount(which, minlength=len(code.dictionary)))
            for lang, at in zip(code.dictionary.to_pylist(), np.split(by_lang, ends[:-1])):
                old = best.get(lang, (h[:0], size[:0]))
                first, i = np.unique(np.concatenate([old[0], h[at]]), return_index=True)
                sizes = np.concatenate([old[1], size[at]])[i]
                n = int(np.searchsorted(np.cumsum(sizes) - sizes, dict_bytes))
                best[lang] = first[:n], sizes[:n]
        for lang, (h, size) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(h), pa.string()), pa.array(h), pa.array(size)],
                                             names=["lang", "h", "size"])

    return arrow_map(rows.select("lang", "h", "size"), run, "lang string, h long, size long")


def training_sample(train: DataFrame, text_col: str, lang_col: str, dict_bytes: int) -> DataFrame:
    """(lang, text, before) rows: per language the distinct texts of smallest
    content hash, until ``dict_bytes`` are reached; a text counts for at most
    ``dict_bytes``, and copies of a text count once.

    The hashes are picked first, without texts (`smallest_hashes`), so a language
    with most of the rows costs no more than a rare one. They give the largest
    hash taken of each language, broadcast if they are few, and only the texts up
    to it leave their tasks, copies put together before.
    """
    rows = train.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull() & (F.length("text") > 0)).withColumn(
        "h", F.shiftrightunsigned(F.xxhash64("text"), 1)).withColumn(
        "size", F.least(F.octet_length("text"), F.lit(dict_bytes)).cast("long"))
    order = Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(order), F.lit(0))
    picked = smallest_hashes(rows, dict_bytes).groupBy("lang", "h").agg(F.min("size").alias("size"))
    bounds = picked.withColumn("before", before).where(F.col("before") < dict_bytes).groupBy("lang").agg(
        F.max("h").alias("last"))
    near = rows.join(broadcast_if_small(bounds), "lang").where(F.col("h") <= F.col("last"))
    texts = near.groupBy("lang", "h").agg(F.min(F.substring("text", 1, dict_bytes)).alias("text"),
                                          F.min("size").alias("size"))
    return texts.withColumn("before", before).select("lang", "text", "before")


def train_dictionaries(train: DataFrame, text_col: str = "text", lang_col: str = "lang",
                       dict_bytes: int = 1 << 16) -> dict[str, bytes]:
    """Language -> dictionary content of at most ``dict_bytes`` bytes."""
    out: dict[str, list[bytes]] = {}
    sample = training_sample(train, text_col, lang_col, dict_bytes)
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], r["before"], r["text"])):
        out.setdefault(r["lang"], []).append(plain(r["text"]))
    return {lang: b"\n".join(parts)[:dict_bytes] for lang, parts in sorted(out.items())}


def plain(text: str) -> bytes:
    """Lower-cased letters, every run of other characters as one blank."""
    return _OTHER.sub(" ", text.lower()).encode()


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def identify(df: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
             extra: tuple[str, ...] = (), level: int = 3, scale: float = 6.0, min_score: float = 0.6) -> DataFrame:
    """Id, ``extra`` columns, lang_pred, score and rejected of every row."""
    langs = list(dictionaries)
    contents = [dictionaries[x] for x in langs]
    keep = [id_col, *extra]
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        coders = []
        for content in contents:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            coders.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False,
                                                   write_checksum=False, write_dict_id=False))
        for b in text_batches(batches, text_col):
            raw, o = b.data.tobytes(), b.offsets
            letters = has_letter(b.batch.column(text_col))
            pred, score = [], np.zeros(b.rows)
            for r in range(b.rows):
                if not coders or not letters[r]:
                    pred.append(UNKNOWN)
                    continue
                text = plain(raw[o[r]:o[r + 1]].decode("utf-8", "replace"))
                pieces = [text[i:i + PIECE] for i in range(0, len(text), PIECE)]
                sizes = np.array([sum(len(c.compress(p)) for p in pieces) for c in coders], float)
                best = int(sizes.argmin())
                pred.append(langs[best])
                score[r] = 1.0 / np.exp(np.minimum(0, (sizes[best] - sizes) / scale)).sum()
            cols = {c: b.batch.column(c) for c in keep}
            fields = [(c, x.type) for c, x in cols.items()]
            yield out_batch(pa.schema([*fields, ("lang_pred", pa.string()), ("score", pa.float64()),
                                       ("rejected", pa.bool_())]),
                            **cols, lang_pred=pred, score=score, rejected=score < min_score)

    return arrow_map(df.select(*dict.fromkeys([*keep, text_col])), run,
                     out_schema(df, keep, "lang_pred string, score double, rejected boolean"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)))
    dictionaries = train_dictionaries(docs.where(~F.col("held_out")))
    return identify(docs.drop("lang"), dictionaries, extra=("held_out",))
