"""Benchmark decontamination with an FM-index per training shard.

A shard is a block of documents. Its words become symbols of the benchmark's
vocabulary; only runs of such words that are long enough to hold a test phrase
can match, so the others fall away. Over the runs the shard sorts all suffixes,
takes the Burrows-Wheeler transform and stores it in a wavelet matrix. All test
phrases (windows of `WINDOW` words, or a shorter item as a whole) are searched
backwards at once: each step narrows a phrase's row range by two ranks.
Occurrences are located from sampled suffix positions by walking the
transform, and their spans merge into the words to remove.

The benchmark is a stated query set. Its size is measured first; it is handed to
the tasks as arrays, in blocks of about ``block_bytes`` bytes of text. With more than one
block the documents pass through one scan for each, spans add up, and no text is
shuffled.

Edge cases: a null or empty text has no words and no hits; an item without words
matches nothing; equal phrases of several items count for each item; repeated
items count once by id, items without an id give hits but no id; repeated
documents are judged row by row; an empty benchmark leaves every document clean;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import (ALNUM_WORD, BASES, LOWER, arrow_map, materialize, mix, out_batch, out_schema, table,
                                   text_batches, utf8, word_hashes, word_spans)

WINDOW = 13
SHARD_BYTES = 4 << 20
SAMPLE = 8
#: Text of the benchmark that is searched for at once: the driver and each worker need some 30 times as much.
BLOCK_BYTES = 4 << 20


def words_of(data: np.ndarray, offsets: np.ndarray):
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets, ALNUM_WORD)
    return word_hashes(data, starts, ends), rows


class Phrases:
    """Test phrases as arrays: a phrase is a range of the items' symbols, and has a range of
    its items' numbers. Equal phrases are told by two 64-bit hashes of their words."""

    def __init__(self, ids: list[str | None], data: np.ndarray, offsets: np.ndarray, window: int = WINDOW):
        h, rows = words_of(data, offsets)
        self.vocab, symbols = np.unique(h, return_inverse=True)
        self.text = (symbols + 1).astype(np.int32)
        words = np.diff(rows)
        count = np.where(words > 0, np.maximum(words - window + 1, 1), 0)
        item = np.repeat(np.arange(len(words)), count)
        start = rows[:-1][item] + np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
        length = np.minimum(words, window)[item]
        one, two = length.astype(np.uint64), np.zeros(len(item), np.uint64)
        for j in range(window):
            w = np.where(j < length, h[np.minimum(start + j, len(h) - 1)], 0) if len(h) else np.zeros(0, np.uint64)
            one, two = one * BASES[0] + w, two * BASES[1] + mix(w + np.uint64(j))
        self.names = sorted({i for i in ids if i is not None})
        number = {i: n for n, i in enumerate(self.names)}
        code = np.array([-1 if i is None else number[i] for i in ids], np.int32)[item] if len(item) else item.astype(np.int32)
        o = np.lexsort((code, two, one))
        new = np.ones(len(o), bool)
        new[1:] = (one[o][1:] != one[o][:-1]) | (two[o][1:] != two[o][:-1])
        first = o[new]
        self.start, self.length = start[first].astype(np.int32), length[first].astype(np.int8 if window < 128 else np.int32)
        # the items of each phrase, each once; items without an id have no number
        phrase, code = np.cumsum(new) - 1, code[o]
        keep = code >= 0
        keep[1:] &= (phrase[1:] != phrase[:-1]) | (code[1:] != code[:-1])
        self.code = code[keep]
        self.bounds = np.searchsorted(phrase[keep], np.arange(len(first) + 1)).astype(np.int32)

    def items(self, phrase: int) -> list[str]:
        return [self.names[c] for c in self.code[self.bounds[phrase]:self.bounds[phrase + 1]]]


def suffix_order(x: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling, refining only suffixes that still tie."""
    n = len(x)
    _, rank = np.unique(x, return_inverse=True)
    rank = rank.astype(np.int64)
    count = np.bincount(rank, minlength=n)
    rank = (np.cumsum(count) - count)[rank]  # first place of the group
    open_ = np.flatnonzero(count[np.searchsorted(np.cumsum(count), rank, "right")] > 1) if n else rank
    step = 1
    while len(open_):
        later = np.where(open_ + step < n, rank[np.minimum(open_ + step, n - 1)] + 1, 0)
        o = np.lexsort((later, rank[open_]))
        p, r, q = open_[o], rank[open_][o], later[o]
        new_group = np.ones(len(p), bool)
        new_group[1:] = r[1:] != r[:-1]
        new = new_group.copy()
        new[1:] |= q[1:] != q[:-1]
        at = np.arange(len(p))
        base = np.maximum.accumulate(np.where(new_group, at, 0))
        lead = np.maximum.accumulate(np.where(new, at, 0))
        rank[p] = r + lead - base
        single = new & np.append(new[1:], True)
        open_ = p[~single]
        step *= 2
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    return sa


class FMIndex:
    """Backward search over a sequence of symbols; 0 separates runs.

    The sequence must end with a 0.
    """

    def __init__(self, x: np.ndarray, sample: int = SAMPLE):
        n = len(x)
        stops = int((x == 0).sum())
        apart = x + stops  # each separator gets a symbol of its own, below all others
        apart[x == 0] = np.arange(stops)
        sa = suffix_order(apart)
        self.bwt = x[sa - 1]
        self.bits = max(1, int(x.max()).bit_length()) if n else 1
        count = np.bincount(x, minlength=1 << self.bits)
        self.before = np.cumsum(count) - count
        self.ones, self.zeros = [], []
        level = self.bwt
        for b in range(self.bits - 1, -1, -1):
            bit = (level >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(n - int(bit.sum()))
            level = np.concatenate([level[bit == 0], level[bit == 1]])
        # text positions kept: every ``sample``-th and the first of each run
        kept = (sa % sample == 0) | (self.bwt == 0)
        self.kept = kept
        self.kept_rank = np.cumsum(kept) - 1
        self.kept_at = sa[kept]
        self.n = n

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for b, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros):
            one = ones[i]
            i = np.where((c >> b) & 1, zeros + one, i - one)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of c among the first i symbols of the transform."""
        return self._down(c, i) - self._down(c, np.zeros_like(i))

    def search(self, symbols: np.ndarray, start: np.ndarray, length: np.ndarray):
        """Row range of each phrase: the ``length`` symbols from ``start`` on."""
        length = length.astype(np.int64)
        lo = np.zeros(len(length), np.int64)
        hi = np.full(len(length), self.n, np.int64)
        live = np.flatnonzero(length > 0)
        for back in range(1, int(length.max(initial=0)) + 1):
            live = live[(length[live] >= back) & (hi[live] > lo[live])]
            if not len(live):
                break
            c = symbols[start[live] + length[live] - back].astype(np.int64)
            there = c < len(self.before)
            hi[live[~there]] = lo[live[~there]]
            live, c = live[there], c[there]
            lo[live] = self.before[c] + self.rank(c, lo[live])
            hi[live] = self.before[c] + self.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row."""
        out, rows = np.zeros(len(rows), np.int64), rows.copy()
        live, steps = np.arange(len(rows)), 0
        while len(live):
            got = self.kept[rows[live]]
            out[live[got]] = self.kept_at[self.kept_rank[rows[live[got]]]] + steps
            live = live[~got]
            c = self.bwt[rows[live]]
            rows[live] = self.before[c] + self.rank(c, rows[live])
            steps += 1
        return out


def occurrences(h: np.ndarray, rows: np.ndarray, phrases: Phrases):
    """(first word, phrase) of every occurrence among the shard's words."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(h) or not len(phrases.length):
        return none
    at = np.minimum(np.searchsorted(phrases.vocab, h), len(phrases.vocab) - 1)
    symbol = np.where(phrases.vocab[at] == h, at + 1, 0)
    known = symbol > 0
    # maximal runs of known words within a document
    begin = known.copy()
    begin[1:] &= ~known[:-1]
    head = rows[:-1][rows[:-1] < len(h)]
    begin[head] = known[head]
    starts = np.flatnonzero(begin)
    stop = ~known
    stop[head] = True
    stops = np.append(np.flatnonzero(stop), len(h))
    ends = stops[np.searchsorted(stops, starts, "right")]
    long_enough = ends - starts >= phrases.length.min()
    starts, ends = starts[long_enough], ends[long_enough]
    if not len(starts):
        return none
    # the runs end to end, each with a separator behind it
    lens = ends - starts + 1
    first = np.cumsum(lens) - lens
    origin = np.arange(int(lens.sum())) - np.repeat(first, lens) + np.repeat(starts, lens)
    x = np.zeros(len(origin), np.int64)
    word = np.ones(len(origin), bool)
    word[first + lens - 1] = False
    x[word] = symbol[origin[word]]
    index = FMIndex(x)
    lo, hi = index.search(phrases.text, phrases.start, phrases.length)
    n = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(n)), n)
    row = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return origin[index.locate(row)], which


def _scan(df: DataFrame, phrases: Phrases, keep: list[str], text_col: str) -> DataFrame:
    """``df`` with n_words, and the spans and items of ``phrases`` added to those it has."""
    shared = df.sparkSession.sparkContext.broadcast(phrases)
    own = pa.schema([("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ph = shared.value
        for b in text_batches(batches, text_col, SHARD_BYTES):
            h, rows = words_of(b.data, b.offsets)
            start, which = occurrences(h, rows, ph)
            cover = np.zeros(len(h) + 1, np.int64)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + ph.length[which], -1)
            hit = np.cumsum(cover)[:-1] > 0
            spans: list[list[int]] = [[] for _ in range(b.rows)]
            items: list[list[str]] = [[] for _ in range(b.rows)]
            doc = np.searchsorted(rows, start, "right") - 1
            by_doc: dict[int, set] = {}
            for d, p in set(zip(doc.tolist(), which.tolist())):
                by_doc.setdefault(d, set()).update(ph.items(p))
            old = {c: b.batch.column(c) for c in ("spans", "items") if c in b.batch.schema.names}
            for d in sorted(set(by_doc) | (set(range(b.rows)) if old else set())):
                mine = hit[rows[d]:rows[d + 1]].copy()
                more = by_doc.get(d, set())
                if old:
                    s = old["spans"][d].as_py()
                    for a, z in zip(s[::2], s[1::2]):
                        mine[a:z] = True
                    more = more | set(old["items"][d].as_py())
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
                spans[d], items[d] = edge.tolist(), sorted(more)
            cols = {c: b.batch.column(c) for c in keep}
            schema = pa.schema([*((c, x.type) for c, x in cols.items()), *own])
            yield out_batch(schema, **cols, n_words=np.diff(rows), spans=spans, items=items)

    return arrow_map(df, run, out_schema(df, keep, "n_words long, spans array<bigint>, items array<string>"))


def decontaminate(df: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` columns, n_words, spans (begin, end word of each hit run, flat) and items of every row."""
    bench = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(item_text).alias("t"))
    size = bench.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    names = [*keep] + ([text_col] if text_col not in keep else [])
    out = df.select(*names)
    for n in range(blocks):
        part = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == n)
        rows = part.toArrow().combine_chunks()
        data, offsets = utf8(rows["t"].combine_chunks()) if rows.num_rows else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        ph = Phrases(rows["i"].to_pylist(), data, offsets, window)
        last = n == blocks - 1
        out = _scan(out, ph, list(keep) if last else names, text_col)
        if not last:
            out = materialize(out, "spans")
    return out


def n_hit(spans: str = "spans") -> Column:
    """Words inside the spans."""
    return F.coalesce(F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("s")),
                                  lambda a, x: F.when(a["s"] < 0, F.struct(a["n"].alias("n"), x.alias("s"))).otherwise(
                                      F.struct((a["n"] + x - a["s"]).alias("n"), F.lit(-1).cast("long").alias("s"))),
                                  lambda a: a["n"]), F.lit(0))


def contaminated(n_words: Column, hits: Column) -> Column:
    return (hits > 0) & (20 * hits >= n_words)


def keep_clean(df: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are not contaminated, as they are."""
    rows = df.select(F.struct("*").alias("_row"), F.col(text_col).alias("_text"))
    found = decontaminate(rows, benchmark, ("_row",), "_text")
    return found.where(~contaminated(F.col("n_words"), n_hit())).select("_row.*")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("n_hit", n_hit()).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
        contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"))
