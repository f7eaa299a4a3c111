"""N-gram Jaccard join with signature trees.

Each text is the set of its word n-grams; texts link when the Jaccard
similarity of their sets reaches a threshold, and linked texts form components.
The join is exact: no link between different sets is lost.

1. *Classes.* Texts with equal sets form a class; from here on only classes
   count, so a text copied a million times is one node.
2. *Candidates.* At a size level, every set is dealt into the same number of
   bins by the grams' hashes. Sets that link differ in at most d grams, so they
   differ in at most d bins, and of the non-empty bins of each, put in one
   order for all, the first d + 1 share one with equal contents. Each class
   sends these bins' hashes for its own level and the next, so any two sizes
   that may link meet. The order takes bins with the most grams first, and
   grams that many texts share (`frequent_grams`, counted over all texts) count
   last, so that a shared passage does not make candidates. Classes that meet
   in a bin hang on the smallest of them; components of this graph are groups
   outside of which nothing can link.
3. *Signature trees.* A group's sets are sorted by size and put into a tree
   whose nodes hold an OR-combined bitmap of the grams and the range of sizes.
   Two nodes are compared only if their largest possible overlap reaches the
   threshold for their sizes; leaves compare exactly. Pairs that are already in
   one component are skipped.
4. *Large groups*, of more than `VAST` blocks (see 5), are dealt into bins again by
   other hashes, now within the group and with the grams that many of these sets
   share last. Sets that link meet in these bins too, sets that met by chance
   mostly do not, so a group that chance has chained falls apart (`_divide`).
5. What has more than a block's grams is divided into blocks of about `BLOCK_GRAMS` grams by size.
   Blocks are resolved alone; the largest part of each block then sends its most
   linked set to a tournament that joins these parts. Then only sets that share
   a bin but not yet a part have to meet: those outside of the group's largest
   part meet all blocks of fitting size. Only in a group where bins of up to
   `BLOCK` sets would copy fewer grams than pairs of blocks, their sets meet there,
   unless all of them meet in blocks as well. Nothing is skipped.

Edge cases: a text without words, or null, has an empty set, links with nothing
and is its own component; a text shorter than n words has one gram, all of it;
texts with equal sets link; repeated rows are members of one class; rows without
an id take part, and the component's id is its smallest non-null id; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.llm.common import (LOWER, PLAIN_WORD, Block, arrow_map, broadcast_if_small, gram_hashes,
                                   materialize, mix, table, text_batches, word_hashes, word_spans)
from marketlens.llm.components import components
from marketlens.llm.repeats import NO_ID, keyed

BLOCK = 128  # sets of a bin, or of a round of the tournament, that meet at once
BLOCK_GRAMS = 1 << 19  # grams of a block; a set counts as BLOCK_GRAMS / BLOCK_SETS at least
BLOCK_SETS = 1024
VAST = 16  # groups of more blocks are divided
ROUNDS = 4  # of dividing them
FREQUENT = 0.005  # share of the texts from which a gram counts as frequent
SAMPLE_TEXTS = 4096  # texts whose grams are counted together
SAMPLE_GRAMS = 4 << 20  # or fewer, if they have so many grams
LEAF, FANOUT, BITS = 8, 4, 4096
_GOLD, BINS_SEED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# --- sets ------------------------------------------------------------------

def gram_sets(b: Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(grams, offsets): the distinct grams of each row, ascending."""
    data = LOWER[b.data]
    starts, ends, rows = word_spans(data, b.offsets, PLAIN_WORD)
    h = word_hashes(data, starts, ends)
    g = gram_hashes(h, n)
    count = np.diff(rows)
    at = np.arange(len(g))
    row = np.repeat(np.arange(b.rows), count)[:len(g)]
    inside = at + n <= rows[1:][row] if len(g) else np.zeros(0, bool)
    g, row = g[inside], row[inside]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        whole = np.array([gram_hashes(h[rows[r]:rows[r + 1]], int(count[r]))[0] for r in short], np.uint64)
        g, row = np.concatenate([g, whole]), np.concatenate([row, short])
    o = np.lexsort((g, row))
    g, row = g[o], row[o]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    g, row = g[new], row[new]
    return g, np.searchsorted(row, np.arange(b.rows + 1))


def class_ids(g: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes that tell a set."""
    n = np.diff(offsets).astype(np.uint64)
    out = []
    for seed in (_GOLD, BINS_SEED):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(g ^ seed))])
        out.append(mix(sums[offsets[1:]] - sums[offsets[:-1]] + n * _GOLD).view(np.int64))
    return out[0], out[1]


# --- 1: classes and frequent grams -----------------------------------------

def _often(held: list[np.ndarray], texts: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Grams that a share of the ``texts`` have, and how many have them."""
    g, c = np.unique(np.concatenate(held), return_counts=True)
    keep = c >= max(2.0, share * texts)
    return g[keep].view(np.int64), c[keep]


def _survey(batches: Iterator[pa.RecordBatch], n: int, share: float) -> Iterator[pa.RecordBatch]:
    """Members (kind 0) and, of every few thousand texts, the grams that many of them have (kind 1)."""
    held: list[np.ndarray] = []
    texts = grams = 0

    def frequent():
        g, c = _often(held, texts, share)
        zero = np.zeros(len(g), np.int64)
        return pa.record_batch([pa.array(np.ones(len(g), np.int8)), pa.array(zero), pa.array(zero.astype(np.int32)),
                                pa.array(c), pa.array(g), pa.array(zero)],
                               names=["kind", "doc", "disc", "n", "c1", "c2"])

    for b in text_batches(batches, "text"):
        g, offsets = gram_sets(b, n)
        c1, c2 = class_ids(g, offsets)
        yield pa.record_batch([pa.array(np.zeros(b.rows, np.int8)), b.batch.column("doc"), b.batch.column("disc"),
                               pa.array(np.diff(offsets)), pa.array(c1), pa.array(c2)],
                              names=["kind", "doc", "disc", "n", "c1", "c2"])
        held.append(g)
        texts += b.rows
        grams += len(g)
        if texts >= SAMPLE_TEXTS or grams >= SAMPLE_GRAMS:
            yield frequent()
            held, texts, grams = [], 0, 0
    if held:
        yield frequent()


def _frequent(counted: DataFrame, total: int) -> np.ndarray:
    """The grams (c1, n: how many texts have it) of a share of the ``total`` texts, ascending: at most
    (mean set size) / FREQUENT, whatever the number of texts."""
    return np.sort(np.array([r[0] for r in counted.groupBy("c1").agg(F.sum("n").alias("s")).where(
        F.col("s") >= FREQUENT / 2 * total).select("c1").collect()], np.int64).view(np.uint64))


# --- 2: candidates ---------------------------------------------------------

@lru_cache(None)
def levels(num: int, den: int, upto: int) -> tuple[int, ...]:
    """Lower ends of the size levels: sizes that may link are in one or in adjoining levels."""
    out = [1]
    while out[-1] <= upto:
        out.append(max(out[-1] + 1, out[-1] * den // num + 1))
    return tuple(out)


def bins_of(g: np.ndarray, offsets: np.ndarray, num: int, den: int, spare: float,
            frequent: np.ndarray, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(bin hash, row) of the bins that each set sends; ``salt`` deals the grams anew."""
    n = np.diff(offsets)
    low = np.array(levels(num, den, int(n.max(initial=1)) * den // num + 2), np.int64)
    own = np.searchsorted(low, n, "right") - 1
    row = np.repeat(np.arange(len(n)), n)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, g), len(frequent) - 1)
        rare = frequent[at] != g
    else:
        rare = np.ones(len(g), bool)
    if salt:
        g = mix(g + np.uint64(salt * int(BINS_SEED) % 2**64))
    keys, rows = [], []
    for up in (0, 1):
        level = own + up
        # two sizes below ``top`` differ in at most d of their grams if they link
        top = low[level + 1] - 1
        d = 2 * top * (den - num) // (den + num)
        bins = ((d + 1) * (1 + spare)).astype(np.int64)
        first = np.cumsum(bins) - bins
        x = mix(g + level[row].astype(np.uint64) * _GOLD)
        cell = ((x >> np.uint64(32)) * bins[row].astype(np.uint64) >> np.uint64(32)).astype(np.int64) + first[row]
        total = int(bins.sum())
        content = np.zeros(total, np.uint64)
        np.add.at(content, cell, mix(x))
        have = np.bincount(cell, minlength=total)
        few = np.bincount(cell[rare], minlength=total)
        used = np.flatnonzero(have)
        owner = np.searchsorted(first, used, "right") - 1
        key = mix(content[used] + (used - first[owner]).astype(np.uint64) * _GOLD
                  + level[owner].astype(np.uint64) * BINS_SEED)
        o = np.lexsort((key, -have[used], -np.minimum(few[used], 9), owner))
        owner, key = owner[o], key[o]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        send = place <= d[owner]
        keys.append(key[send])
        rows.append(owner[send])
        # sets with no more than d non-empty bins may have none in common: they send grams too
        scarce = np.bincount(owner, minlength=len(n)) <= d
        if scarce.any():
            at = np.flatnonzero(scarce[row])
            o = at[np.lexsort((g[at], ~rare[at], row[at]))]
            place = np.arange(len(o)) - np.searchsorted(row[o], row[o])
            o = o[place <= n[row[o]] - -(-num * n[row[o]] // den)]
            keys.append(mix(g[o] ^ BINS_SEED))
            rows.append(row[o])
    return np.concatenate(keys), np.concatenate(rows)


def _signatures(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int, spare: float,
                frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    sent: set[int] = set()  # classes that this task has sent
    for b in text_batches(batches, "text"):
        g, offsets = gram_sets(b, n)
        if not len(g):
            continue
        c1, _ = class_ids(g, offsets)
        fresh = []
        for r, c in enumerate(c1.tolist()):
            if offsets[r + 1] > offsets[r] and c not in sent:
                sent.add(c)
                fresh.append(r)
        if len(sent) > 2_000_000:
            sent.clear()
        if not fresh:
            continue
        pick = np.array(fresh)
        size = np.diff(offsets)[pick]
        inner = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(inner[-1]) - np.repeat(inner[:-1], size) + np.repeat(offsets[pick], size)
        key, row = bins_of(g[at], inner, num, den, spare, frequent)
        for i in range(0, len(key), 1 << 17):
            s = slice(i, i + (1 << 17))
            yield pa.record_batch([pa.array(key[s].view(np.int64)), pa.array(c1[pick][row[s]])], names=["key", "c"])


def _counted(batches: Iterator[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    """Of every few thousand sets (grams), the grams that many of them have."""
    held: list[np.ndarray] = []
    texts = grams = 0

    def often():
        g, c = _often(held, texts, share)
        return pa.record_batch([pa.array(g), pa.array(c)], names=["c1", "n"])

    for b in text_batches(batches, "grams"):
        held.append(b.data.copy().view(np.uint64))
        texts += b.rows
        grams += len(held[-1])
        if texts >= SAMPLE_TEXTS or grams >= SAMPLE_GRAMS:
            yield often()
            held, texts, grams = [], 0, 0
    if held:
        yield often()


def _dealt_again(batches: Iterator[pa.RecordBatch], num: int, den: int, spare: float, frequent: np.ndarray,
                 salt: int) -> Iterator[pa.RecordBatch]:
    """The bins of sets (comp, c1, grams); only sets of one group share any."""
    for b in text_batches(batches, "grams"):
        comp, c1 = (b.batch.column(x).to_numpy() for x in ("comp", "c1"))
        key, row = bins_of(b.data.copy().view(np.uint64), b.offsets // 8, num, den, spare, frequent, salt)
        key = mix(key + comp[row].view(np.uint64) * _GOLD)
        for i in range(0, len(key), 1 << 17):
            s = slice(i, i + (1 << 17))
            yield pa.record_batch([pa.array(key[s].view(np.int64)), pa.array(c1[row[s]])], names=["key", "c"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input sorted by key and class: the classes of each key that more than one
    has, with the smallest of them."""
    key, lead, last, alone = None, None, None, False  # of the last key; alone: one class so far, not sent
    for b in batches:
        k, c = (b.column(x).to_numpy() for x in ("key", "c"))
        if not len(k):
            continue
        again = np.zeros(len(k), bool)  # a class that several tasks have sent
        again[1:] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
        if key is not None and k[0] == key and c[0] == last:
            again[0] = True
        last = c[-1]
        k, c = k[~again], c[~again]
        if not len(k):
            continue
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        first = c[np.flatnonzero(new)[np.cumsum(new) - 1]]
        size = np.diff(np.append(np.flatnonzero(new), len(k)))
        send = np.repeat(size > 1, size)
        out = [(k[send], c[send], first[send])]
        if key is not None and k[0] == key:  # the last key goes on
            n = int(size[0])
            head = (k[:n], c[:n], np.full(n, lead))
            rest = send.copy()
            rest[:n] = False
            out = [head, (k[rest], c[rest], first[rest])]
            if alone:
                out.append((np.array([key]), np.array([lead]), np.array([lead])))
            going = n == len(k)
            key, lead, alone = k[-1], lead if going else first[-1], not going and size[-1] == 1
        else:
            key, lead, alone = k[-1], first[-1], size[-1] == 1
        x = [np.concatenate(y) for y in zip(*out)]
        if len(x[0]):
            yield pa.record_batch([pa.array(y, pa.int64()) for y in x], names=["key", "c", "lead"])


# --- 3: signature trees ----------------------------------------------------

class Forest:
    """Union-find over the sets of a group; equal ``label`` means already joined."""

    def __init__(self, labels: np.ndarray):
        _, first, inv = np.unique(labels, return_index=True, return_inverse=True)
        self.up = first[inv].tolist()

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.find(x), self.find(y)
        self.up[max(a, b)] = min(a, b)
        return a != b


class SignatureTree:
    """Sets of a group by size; a node has the OR of its sets' bitmaps, how often a
    set of it uses one bit at most, and its range of sizes."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.size = np.array([len(s) for s in sets], np.int64)
        self.order = np.argsort(self.size, kind="stable")
        leaves = [(i, min(i + LEAF, len(sets))) for i in range(0, len(sets), LEAF)]
        self.nodes: list[tuple] = []  # (begin, end, children, most per bit, least size, greatest size)
        row = []
        for a, z in leaves:
            most = np.zeros(BITS, np.int64)
            for x in self.order[a:z]:
                np.maximum(most, np.bincount((sets[x] >> np.uint64(52)).astype(np.int64), minlength=BITS), out=most)
            row.append(self._add(a, z, (), most))
        while len(row) > 1:
            row = [self._merge(row[i:i + FANOUT]) for i in range(0, len(row), FANOUT)]
        self.root = row[0] if row else None
        # grams of more than one set, numbered, for the exact comparison
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        g, inv, cnt = np.unique(every, return_inverse=True, return_counts=True)
        shared = cnt > 1
        number = np.cumsum(shared) - 1
        at = np.concatenate([[0], np.cumsum(self.size)])
        self.local = [number[inv[at[i]:at[i + 1]]][shared[inv[at[i]:at[i + 1]]]] for i in range(len(sets))]
        self.width = int(shared.sum())

    def _add(self, a, z, children, most) -> int:
        sizes = self.size[self.order[a:z]]
        self.nodes.append((a, z, children, most, int(sizes[0]), int(sizes[-1])))
        return len(self.nodes) - 1

    def _merge(self, row: list[int]) -> int:
        if len(row) == 1:
            return row[0]
        most = np.maximum.reduce([self.nodes[i][3] for i in row])
        return self._add(self.nodes[row[0]][0], self.nodes[row[-1]][1], tuple(row), most)

    def links(self, num: int, den: int, forest: Forest) -> Iterator[tuple[int, int]]:
        """Pairs of sets that link, without pairs joined by earlier ones."""
        if self.root is None:
            return
        todo = [(self.root, self.root)]
        while todo:
            p, q = todo.pop()
            a, b = self.nodes[p], self.nodes[q]
            if not self._may_link(a, b, num, den) or self._joined(a, b, forest):
                continue
            if not a[2] and not b[2]:
                yield from self._leaves(a, b, num, den, forest)
            elif p == q:
                todo += [(x, y) for i, x in enumerate(a[2]) for y in a[2][i:]]
            elif a[2] and (not b[2] or a[1] - a[0] >= b[1] - b[0]):
                todo += [(x, q) for x in a[2]]
            else:
                todo += [(p, y) for y in b[2]]

    @staticmethod
    def _may_link(a, b, num, den) -> bool:
        overlap = min(a[5], b[5], int(np.minimum(a[3], b[3]).sum()))
        least = max(a[4] + b[4] - overlap, overlap)
        return den * overlap >= num * least

    def _joined(self, a, b, forest) -> bool:
        root = forest.find(int(self.order[a[0]]))
        return all(forest.find(int(x)) == root for n in (a, b) for x in self.order[n[0]:n[1]])

    def _leaves(self, a, b, num, den, forest):
        xs, ys = self.order[a[0]:a[1]], self.order[b[0]:b[1]]
        grams = np.unique(np.concatenate([self.local[x] for x in xs] + [np.zeros(0, np.int64)]))
        left, right = (np.zeros((len(z), len(grams)), np.float32) for z in (xs, ys))
        for m, zs in ((left, xs), (right, ys)):
            for i, z in enumerate(zs):
                at = np.searchsorted(grams, self.local[z])
                ok = at < len(grams)
                ok[ok] = grams[at[ok]] == self.local[z][ok]
                m[i, at[ok]] = 1
        both = (left @ right.T).astype(np.int64)
        union = self.size[xs][:, None] + self.size[ys][None, :] - both
        for i, j in zip(*np.nonzero((den * both >= num * union) & (xs[:, None] != ys[None, :]))):
            if forest.join(int(xs[i]), int(ys[j])):
                yield int(xs[i]), int(ys[j])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of each group; input sorted by group."""
    held: dict[str, list] = {}
    for b in batches:
        cols = {n: b.column(n).to_pylist() for n in b.schema.names}
        for i, g in enumerate(cols["g"]):
            if held and held["g"][0] != g:
                yield held
                held = {}
            for n in cols:
                held.setdefault(n, []).append(cols[n][i])
    if held:
        yield held


def _linked(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """For each group (g): every set's label there (kind 0), whether it is the hub of
    the largest part, and the joins of unlike former labels (kind 1)."""
    for rows in _groups(batches):
        seen: dict[bytes, int] = {}
        for i, c in enumerate(rows["c"]):
            seen.setdefault(c, i)  # a set sent twice
        at = sorted(seen.values())
        c = [rows["c"][i] for i in at]
        label = [rows["label"][i] for i in at]
        sets = [np.frombuffer(rows["grams"][i], np.uint64) for i in at]
        forest = Forest(np.array([x.hex() for x in label]))
        links = [0] * len(c)
        edges = []
        for x, y in SignatureTree(sets).links(num, den, forest):
            links[x] += 1
            links[y] += 1
            edges.append((label[x], label[y]))
        root = [forest.find(i) for i in range(len(c))]
        parts: dict[int, list[int]] = {}
        for i, r in enumerate(root):
            parts.setdefault(r, []).append(i)
        least = {r: min(label[i] for i in m) for r, m in parts.items()}
        main = max(parts.values(), key=lambda m: (len(m), m))
        hub = max(main, key=lambda i: (links[i], c[i]))
        n, e = len(c), len(edges)
        yield pa.record_batch(
            [pa.array([0] * n + [1] * e, pa.int8()), pa.array([rows["comp"][0]] * (n + e), pa.int64()),
             pa.array(c + [u for u, _ in edges], pa.binary()),
             pa.array([least[r] for r in root] + [v for _, v in edges], pa.binary()),
             pa.array([i == hub for i in range(n)] + [False] * e),
             pa.array([len(parts[r]) for r in root] + [0] * e, pa.int64())],
            names=["kind", "comp", "c", "label", "hub", "part"])


_LINKED = "kind byte, comp long, c binary, label binary, hub boolean, part long"


def _by_group(df: DataFrame, num: int, den: int) -> DataFrame:
    """`_linked` over ``df`` (g, comp, c, label, grams)."""
    return arrow_map(df.select("g", "comp", "c", "label", "grams").repartition("g").sortWithinPartitions("g", "c"),
                     lambda it: _linked(it, num, den), _LINKED)


# --- all steps -------------------------------------------------------------

def _weight():
    """Grams that a set (n) counts as."""
    return F.greatest("n", F.lit(BLOCK_GRAMS // BLOCK_SETS))


def _divide(large: DataFrame, num: int, den: int, spare: float) -> tuple[DataFrame, DataFrame]:
    """The groups of ``large`` (comp, c1, c, n, grams), divided by further bins.

    Returns (c1, comp, fits) of the sets that still share a bin with another, where
    fits tells groups of one block, and the last round's bins (key, c) with their classes.
    """
    done, asked, total = None, large, large.count()
    for salt in range(1, ROUNDS + 1):
        frequent = _frequent(arrow_map(asked.select("grams"), partial(_counted, share=FREQUENT / 2), "c1 long, n long"), total)
        bins = arrow_map(asked.select("comp", "c1", "grams"), partial(
            _dealt_again, num=num, den=den, spare=spare, frequent=frequent, salt=salt), "key long, c long")
        shared = materialize(arrow_map(bins.repartition("key").sortWithinPartitions("key", "c"), _shared,
                                       "key long, c long, lead long"), "shared")
        group = components(shared, "lead", "c").select(F.col("node").alias("c1"), F.col("label").alias("comp"))
        known = group.join(large.select("c1", "n").distinct(), "c1")
        fits = known.groupBy("comp").agg((F.sum(_weight()) <= BLOCK_GRAMS).alias("fits"))
        now = materialize(group.join(fits, "comp").select("c1", "comp", "fits"), "groups")
        fit = now.where("fits")
        done = fit if done is None else done.unionByName(fit)
        rest = now.where("not fits")
        before, total = total, rest.count()
        if not total or total > 0.9 * before:
            break
        asked = large.drop("comp").join(rest.drop("fits"), "c1")
    return done.unionByName(rest), shared


def _blocks(sets: DataFrame, keys: list[str]) -> DataFrame:
    """``sets`` with block: sets of like size, of about `BLOCK_GRAMS` grams. Only counts of sizes are ordered."""
    sizes = sets.groupBy(*keys, "n").agg(F.count(F.lit(1)).alias("many"))
    before = F.sum(F.col("many") * _weight()).over(
        Window.partitionBy(*keys).orderBy("n").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.withColumn("before", F.coalesce(before, F.lit(0)))
    at = F.col("before") + F.pmod(F.xxhash64("c"), F.col("many")) * _weight()
    return sets.join(sizes, [*keys, "n"]).withColumn("block", F.floor(at / BLOCK_GRAMS).cast("int")).drop("many", "before")


def _resolve_large(large: DataFrame, shared: DataFrame, num: int, den: int) -> DataFrame:
    """(c, label) of the sets of groups above a block (comp, c1, c, n, grams).

    ``shared`` (key, c) has the classes of each bin.
    """
    sets = materialize(_blocks(large, ["comp"]), "blocks")
    alone = materialize(_by_group(sets.withColumn("g", F.xxhash64("comp", "block")).withColumn("label", F.col("c")),
                                  num, den).where("kind = 0").drop("kind"), "alone")
    # tournament of the blocks' largest parts
    edges = None
    hubs = alone.where("hub")
    while True:
        entrants = materialize(hubs.select("comp", "c", "label").join(sets.select("c", "n", "grams"), "c"), "hubs")
        most = entrants.groupBy("comp").count().agg(F.max("count")).first()[0]
        met = materialize(_by_group(entrants.join(entrants.groupBy("comp").agg(F.count(F.lit(1)).alias("all")), "comp")
                                    .withColumn("g", F.xxhash64("comp", F.pmod(
                                        F.xxhash64("c"), F.ceil(F.col("all") / BLOCK)))), num, den), "met")
        found = met.where("kind = 1").select(F.col("c").alias("u"), F.col("label").alias("v"))
        edges = found if edges is None else edges.unionByName(found)
        hubs = met.where("kind = 0 and hub")
        if most <= BLOCK:
            break
    merged = components(edges)
    now = materialize(alone.select("comp", "c", "label").join(merged, alone["label"] == merged["node"], "left").select(
        "comp", "c", F.coalesce(merged["label"], alone["label"]).alias("label")), "merged")

    # bins whose sets are not all in one part yet
    part = now.join(sets.select("c", "c1", "n"), "c")
    inside = materialize(shared.select("key", F.col("c").alias("c1")).join(part, "c1"), "inside")
    bins = inside.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.min("label").alias("lo"), F.max("label").alias("hi"),
                                     F.sum(F.xxhash64("c").cast("decimal(38,0)")).alias("who")).where("lo <> hi")
    unlike = inside.join(materialize(bins.select("key", "many", "who"), "bins"), "key")
    # groups whose blocks copy fewer grams, if all of their open sets meet in blocks, than their small bins would
    copied = unlike.groupBy("comp").agg(F.sum(F.when(F.col("many") <= BLOCK, F.col("n"))).alias("copied"))
    spread = unlike.select("comp", "c", "n").distinct().groupBy("comp").agg(
        F.ceil(F.sum(_weight()) / BLOCK_GRAMS).alias("blocks"))
    whole = copied.join(spread, "comp").where(F.col("blocks") * F.col("blocks") * BLOCK_GRAMS <= F.col("copied")).select(
        "comp", F.lit(True).alias("whole"))
    wide = materialize(unlike.join(whole, "comp", "left").where((F.col("many") > BLOCK) | F.col("whole")).select(
        "comp", "c", "label", "n").distinct(), "wide")
    # sets of smaller bins meet there, unless all of them meet in blocks below; bins with the same sets meet once
    apart = unlike.where(F.col("many") <= BLOCK).join(wide.select("c"), "c", "left_anti").groupBy("many", "who").agg(
        F.min("key").alias("g"))
    here = unlike.where(F.col("many") <= BLOCK).join(apart.select("g"), F.col("key") == F.col("g")).select(
        "g", "comp", "c", "label")
    late = [_by_group(here.join(sets.select("c", "grams"), "c"), num, den)]

    # the others: those outside of the group's largest part meet all blocks of fitting size
    if not wide.isEmpty():
        count = wide.groupBy("comp", "label").agg(F.count(F.lit(1)).alias("many"))
        main = count.groupBy("comp").agg(F.max(F.struct("many", "label")).alias("top")).select(
            "comp", F.col("top.label").alias("main"))
        marked = wide.join(main, "comp").withColumn("rest", F.col("label") != F.col("main")).drop("main")
        placed = materialize(_blocks(marked, ["comp", "rest"]), "placed")
        ends = placed.groupBy("comp", "rest", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
        p, q = ends.where("rest").alias("p"), ends.alias("q")
        pairs = p.join(q, F.col("p.comp") == F.col("q.comp")).where(
            (~F.col("q.rest") | (F.col("p.block") <= F.col("q.block")))
            & (den * F.col("p.hi") >= num * F.col("q.lo")) & (den * F.col("q.hi") >= num * F.col("p.lo"))).select(
            F.col("p.comp").alias("comp"), F.col("p.block").alias("i"), F.col("q.rest").alias("r"),
            F.col("q.block").alias("j"), F.xxhash64("p.comp", "p.block", "q.rest", "q.block").alias("g"))
        sides = pairs.select("comp", F.lit(True).alias("rest"), F.col("i").alias("block"), "g").unionByName(
            pairs.select("comp", F.col("r").alias("rest"), F.col("j").alias("block"), "g")).distinct()
        late.append(_by_group(placed.join(sides, ["comp", "rest", "block"]).join(sets.select("c", "grams"), "c"), num, den))
    last = None
    for met in late:
        found = met.where("kind = 1").select(F.col("c").alias("u"), F.col("label").alias("v"))
        last = found if last is None else last.unionByName(found)
    final = components(last)
    return now.join(final, now["label"] == final["node"], "left").select(
        "c", F.coalesce(final["label"], now["label"]).alias("label"))


def ngram_components(df: DataFrame, n: int = 5, num: int = 4, den: int = 5, spare: float = 0.4,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, disc, n_shingles, component_id, label) of every row: texts link from a similarity of num / den.

    The id must be an integer; disc tells apart texts of one id, label names the component.
    """
    docs = keyed(df, id_col, text_col).select(F.col(id_col).cast("long").alias("doc"), F.col("_disc").alias("disc"),
                                              F.col("_doc").alias("key"), F.col("_t").alias("text"))
    survey = materialize(arrow_map(docs, lambda it: _survey(it, n, FREQUENT / 2),
                                   "kind byte, doc long, disc int, n long, c1 long, c2 long"), "survey")
    members = survey.where("kind = 0").drop("kind")
    total = members.count()
    frequent = _frequent(survey.where("kind = 1"), total)

    bins = arrow_map(docs, lambda it: _signatures(it, n, num, den, spare, frequent), "key long, c long")
    shared = materialize(arrow_map(bins.repartition("key").sortWithinPartitions("key", "c"), _shared,
                                   "key long, c long, lead long"), "shared")
    group = materialize(components(shared, "lead", "c"), "groups").select(
        F.col("node").alias("c1"), F.col("label").alias("comp"))

    # the sets of the classes in a group, from one member of each
    classes = members.where("n > 0").groupBy("c1", "c2").agg(
        F.min(F.struct(F.coalesce("doc", F.lit(NO_ID)).alias("doc"), "disc")).alias("m"),
        F.min("doc").alias("least"), F.max("n").alias("n"))
    asked = classes.join(group, "c1").select("c1", "c2", "comp", F.col("m.doc").alias("key"), F.col("m.disc").alias("disc"))
    some = docs.join(asked, ["key", "disc"]).select("c1", "c2", "comp", "text")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches, "text"):
            g, offsets = gram_sets(b, n)
            c1, c2 = class_ids(g, offsets)
            want = [b.batch.column(x).to_numpy() for x in ("c1", "c2")]
            r = np.flatnonzero((c1 == want[0]) & (c2 == want[1]))  # rows may share id and text hash
            name = np.stack([c1[r], c2[r]], 1).astype(">i8")
            yield pa.record_batch(
                [pa.array(b.batch.column("comp").to_numpy()[r]), pa.array(c1[r]),
                 pa.array([x.tobytes() for x in name], pa.binary()),
                 pa.array(np.diff(offsets)[r]),
                 pa.array([g[offsets[i]:offsets[i + 1]].tobytes() for i in r], pa.binary())],
                names=["comp", "c1", "c", "n", "grams"])

    sets = materialize(arrow_map(some, sets_of, "comp long, c1 long, c binary, n long, grams binary").dropDuplicates(["c"]), "sets")
    big = broadcast_if_small(sets.groupBy("comp").agg(F.sum(_weight()).alias("size")).where(
        F.col("size") > BLOCK_GRAMS).select("comp", (F.col("size") > VAST * BLOCK_GRAMS).alias("vast")))
    small = sets.join(big, "comp", "left_anti").withColumn("g", F.col("comp")).withColumn("label", F.col("c"))
    labels = _by_group(small, num, den).where("kind = 0").select("c", "label")
    large = sets.join(big, "comp")
    if not big.where("not vast").isEmpty():
        labels = labels.unionByName(_resolve_large(large.where("not vast").drop("vast"), shared, num, den))
    if not big.where("vast").isEmpty():
        vast = large.where("vast").drop("vast")
        divided, bins = _divide(vast, num, den, spare)
        again = vast.drop("comp").join(divided, "c1")
        few = again.where("fits").withColumn("g", F.col("comp")).withColumn("label", F.col("c"))
        labels = labels.unionByName(_by_group(few, num, den).where("kind = 0").select("c", "label"))
        if not divided.where("not fits").isEmpty():
            labels = labels.unionByName(_resolve_large(again.where("not fits").drop("fits"), bins, num, den))

    code = F.concat(*(F.unhex(F.lpad(F.hex(x), 16, "0")) for x in ("c1", "c2")))
    named = materialize(labels, "labels")
    known = classes.withColumn("c", code).join(named, "c", "left").withColumn("label", F.coalesce("label", "c"))
    least = known.groupBy("label").agg(F.min("least").alias("component_id"))
    answer = known.join(least, "label").select("c1", "c2", "component_id", "label")
    return members.join(answer, ["c1", "c2"], "left").select(
        F.col("doc").alias(id_col), "disc", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component_id")).alias("component_id"), "label")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``df``, as they are, without all but one of each component: the
    smallest id stays. Texts without words all stay."""
    found = ngram_components(df, id_col=id_col, text_col=text_col, **settings).select(
        F.coalesce(id_col, F.lit(NO_ID)).alias("_doc"), F.col("disc").alias("_disc"), "n_shingles", "label")
    stay = found.where("n_shingles > 0").groupBy("label").agg(F.min(F.struct("_doc", "_disc")).alias("m")).select(
        "m.*", F.lit(True).alias("_once"))
    stay = stay.unionByName(found.where("n_shingles = 0").select("_doc", "_disc", F.lit(False).alias("_once")).distinct())
    rows = keyed(df.select(F.struct("*").alias("_row"), F.col(id_col), F.col(text_col)), id_col, text_col).select(
        "_row", "_doc", "_disc")
    j = rows.join(stay, ["_doc", "_disc"])
    first = F.row_number().over(Window.partitionBy("_doc", "_disc").orderBy("_once")) == 1
    return j.withColumn("_first", first).where(F.col("_first") | ~F.col("_once")).select("_row.*")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), n=3, num=9, den=10, spare=0.2).select(
        "doc_id", "n_shingles", "component_id")
