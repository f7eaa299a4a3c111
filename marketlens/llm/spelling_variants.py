"""Grouping of spelling variants by edit rows over sorted word lists.

Two words are near if one inserted, deleted or replaced code point makes the one
the other. A word's form is its near word of largest count, if that is at least
`RATIO` times its own; forms are followed to the last one, the word's root.

* *Vocabulary.* Tasks take the words of whole texts and count them; counts add up
  before and after the shuffle.
* *Groups.* Let m be the length of the shorter word of a near pair (the longer has
  m or m + 1) and i the number of code points that both begin with. A place
  ``begin <= i < end`` means that the words agree in their first ``begin`` and
  their last m - ``end`` code points, so words that agree so form a group, and a
  pair is looked for in the one group whose range holds its i. The ranges are the
  two halves of m. A group of more than ``limit`` words is divided: its range is
  halved again, until it holds one place, where a group has at most as many words
  as there are one or two characters.
* *Scan.* What a group's words have between the agreed ends is a sorted list with
  the lengths of common prefixes (LCP) of neighbours. The list is scanned in order,
  and each entry is compared with all words of the group at once: the edit matrix
  has a row of three cells (the band of one edit) for each character of the entry
  and each word. An entry reuses the rows of its LCP with the entry before; words
  whose row holds no cell below two are dropped; once none is left, all entries
  that share the prefix read so far are skipped.
* *Forms and roots.* Near words add up to a count and the best one by word. Counts
  grow along forms by `RATIO` at least, so doubling the step over forms ends after
  a few rounds.

Edge cases: a null or empty text has no words; a null id counts as an empty string
in the hash of `altered`; repeated rows count again; an empty table gives an empty
result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import LOWER, arrow_map, broadcast_if_small, materialize, table, text_batches

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
ALTER = 199
#: Words of a group that are compared with each other at once.
GROUP_LIMIT = 2000
#: Different words that a task gathers before it passes their counts on.
HELD = 200_000
PART = 1 << 20

RUN = re.compile("[a-zÀ-ÿ]+")
BETWEEN = re.compile("[^a-zÀ-ÿ]")
_LOWER = LOWER.tobytes()


# --- vocabulary ------------------------------------------------------------

def altered(word: str, start: int, every: int) -> str:
    """``word`` less one code point if ``every`` divides its crc32, begun at ``start`` (that of the id)."""
    h = zlib.crc32(word.encode(), start)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _words(batches: Iterator[pa.RecordBatch], every: int, least: int) -> Iterator[pa.RecordBatch]:
    count: Counter[str] = Counter()

    def flush():
        rows = list(count.items())
        count.clear()
        for i in range(0, len(rows), 1 << 14):
            words, ns = zip(*rows[i:i + (1 << 14)])
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(ns, pa.int64())], ["word", "n"])

    for b in text_batches(batches, "_t"):
        ids = b.batch.column("_id").to_pylist()
        raw = b.data.tobytes().translate(_LOWER)
        for r in range(b.rows):
            start = zlib.crc32(f"{'' if ids[r] is None else ids[r]}:".encode())
            text = raw[b.offsets[r]:b.offsets[r + 1]].decode()
            a = 0
            while a < len(text):
                m = BETWEEN.search(text, a + PART) if len(text) - a > PART else None
                end = m.start() if m else len(text)
                # equal words of one document have equal hashes
                for word, n in Counter(RUN.findall(text, a, end)).items():
                    word = altered(word, start, every)
                    if len(word) >= least:
                        count[word] += n
                if len(count) > HELD:
                    yield from flush()
                a = max(end, a + 1)
    if count:
        yield from flush()


def vocabulary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = ALTER,
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least ``min_length`` code points and ``min_count`` occurrences."""
    source = df.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_t"))
    found = arrow_map(source, lambda it: _words(it, every, min_length), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- groups ----------------------------------------------------------------

KEY = ["m", "begin", "end", "head", "tail"]


def _ranges(members: DataFrame) -> DataFrame:
    """The members (word, n, m, begin, end) of groups, each in both halves of its range."""
    middle = F.floor((F.col("begin") + F.col("end")) / 2).cast("int")
    halves = F.array(F.struct("begin", middle.alias("end")), F.struct(middle.alias("begin"), "end"))
    return members.select("word", "n", "m", F.inline(halves))


def _keyed(members: DataFrame) -> DataFrame:
    size = F.length("word")
    rest = F.col("m") - F.col("end")
    return members.select("*", F.substr("word", F.lit(1), F.col("begin")).alias("head"),
                          F.substr("word", size - rest + 1, rest).alias("tail"),
                          F.substr("word", F.col("begin") + 1, size - rest - F.col("begin")).alias("mid"))


def groups(words: DataFrame, limit: int = GROUP_LIMIT) -> DataFrame:
    """Members of groups of two to ``limit`` words (more only where a range holds one place)."""
    size = F.length("word")
    whole = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).select(
        "*", F.lit(0).alias("begin"), F.col("m").alias("end"))
    # words of fewer code points than the shortest one have no part in any pair
    shortest = words.agg(F.min(size)).first()[0] or 0
    members = _keyed(_ranges(whole.where(F.col("m") >= max(shortest, 2))))
    done = None
    while True:
        members = materialize(members, "members")
        sizes = members.groupBy(KEY).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > limit)
        large = broadcast_if_small(sizes.where(F.col("end") - F.col("begin") > 1).select(KEY))
        if large.isEmpty():
            return members if done is None else done.unionByName(members)
        small = members.join(large, KEY, "left_anti")
        done = small if done is None else done.unionByName(small)
        members = _keyed(_ranges(members.join(large, KEY, "left_semi")))


# --- scan ------------------------------------------------------------------

def near_pairs(mids: list[str]) -> list[tuple[int, int, int]]:
    """(x, y, common): pairs x < y of entries of a sorted list that differ by exactly one
    edit, and the number of code points that both begin with."""
    n = len(mids)
    size = np.array([len(w) for w in mids])
    deep = int(size.max())
    # padding differs from all characters
    chars = np.full((n, deep + 2), -1, np.int64)
    for i, w in enumerate(mids):
        chars[i, :len(w)] = np.frombuffer(w.encode("utf-32-le"), "<u4")
    differ = chars[1:] != chars[:-1]
    lcp = np.concatenate([[0], np.minimum(differ.argmax(1), np.minimum(size[1:], size[:-1]))]).tolist()
    starts: list[list[int]] = []  # by depth: the entries that begin a range with a common prefix of that length
    at = np.array(lcp)
    for d in range(deep + 1):
        begin = np.flatnonzero(at < d)
        starts.append([0, *begin[begin > 0].tolist(), n])
    # rows of the edit matrix, by depth: (words still in reach, cells left of, on and right of the diagonal)
    every = np.arange(n)
    rows = [(every, np.full(n, 2, np.int8), np.zeros(n, np.int8), np.ones(n, np.int8))]
    out = []
    i = 0
    while i < n:
        d = lcp[i]
        del rows[d + 1:]
        dead = False
        while d < size[i]:
            who, a, b, c = rows[d]
            ch = chars[i, d]
            # pairs are found once, with the later entry: drop words after this range's last entry but one
            stop = starts[d + 1][bisect_right(starts[d + 1], i)]
            keep = int(np.searchsorted(who, stop - 1))
            who, a, b, c = who[:keep], a[:keep], b[:keep], c[:keep]
            left = chars[who, d - 1] != ch if d else np.ones(keep, bool)
            new_a = np.minimum(b + 1, a + left)
            new_b = np.minimum(np.minimum(c, new_a) + 1, b + (chars[who, d] != ch))
            new_c = np.minimum(new_b + 1, c + (chars[who, d + 1] != ch))
            alive = np.flatnonzero(np.minimum(np.minimum(new_a, new_b), new_c) < 2)
            d += 1
            if not len(alive):
                dead = True
                break
            rows.append((who[alive], new_a[alive], new_b[alive], new_c[alive]))
        if dead:  # no word is near any entry with this prefix
            i = starts[d][bisect_right(starts[d], i)]
            continue
        who, a, b, c = rows[d]
        more = size[who] - size[i]
        cost = np.where(more == 0, b, np.where(more == 1, c, np.where(more == -1, a, 2)))
        for x in who[(cost == 1) & (who < i)].tolist():
            same = chars[x] == chars[i]
            out.append((x, i, int(min(same.argmin() if not same.all() else deep, size[x], size[i]))))
        i += 1
    return out


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input sorted by group and middle. Each near pair from both sides."""
    key, members = None, []
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def close():
        m, begin, end = key[:3]
        if len(members) < 2:
            return
        found = [(x, y) for x, y, common in near_pairs([r[0] for r in members])
                 # one of the two has m code points, and the place lies in this range
                 if m == min(len(members[x][1]), len(members[y][1])) and (begin + common < end or end == m)]
        for i in range(0, len(found), 1 << 14):
            some = found[i:i + (1 << 14)]
            some = some + [(y, x) for x, y in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array([members[x][1] for x, _ in some]), pa.array([members[y][1] for _, y in some]),
                 pa.array([members[y][2] for _, y in some], pa.int64())], schema=schema)

    for b in batches:
        columns = [b.column(c).to_pylist() for c in (*KEY, "mid", "word", "n")]
        for row in zip(*columns):
            if row[:5] != key:
                if key is not None:
                    yield from close()
                key, members = row[:5], []
            members.append(row[5:])
    if key is not None:
        yield from close()


def near_words(words: DataFrame, limit: int = GROUP_LIMIT) -> DataFrame:
    """(word, near, near_n): each word's near words."""
    members = groups(words, limit).repartition(*KEY).sortWithinPartitions(*KEY, "mid")
    return arrow_map(members, _near, "word string, near string, near_n long")


# --- forms and roots -------------------------------------------------------

def roots(links: DataFrame) -> DataFrame:
    """(word, root) for the rows (word, form) of ``links``, which has no cycles."""
    now = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        now = materialize(now.join(ahead, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        if now.where("_moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = RATIO, limit: int = GROUP_LIMIT) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row (word, n) of ``words``."""
    words = materialize(words, "words")
    best = near_words(words, limit).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("_n"), "near")).alias("_best"))
    enough = -F.col("_best._n") >= ratio * F.col("n")
    known = materialize(words.join(best, "word", "left").select(
        "word", F.when(enough, F.col("_best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("_best._n")).alias("form_n")), "forms")
    return known.join(roots(known.where(F.col("form").isNotNull())), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(vocabulary(table(spark, sf_dir, "documents")))
