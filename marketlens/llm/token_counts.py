"""Token counts by a compiled finite-state transducer.

A byte-pair vocabulary whose merges go by piece score has a useful property: a
sequence of pieces is the encoding of its text exactly if each two neighbours
are the encoding of their two strings. So the last piece of the encoding of
every prefix of a text follows from the pieces that end there and from the last
pieces of a few shorter prefixes, namely those at which a piece that is still
open could have begun. That finite memory is the transducer's state:

* state: for each open start (a trie node of the vocabulary), the last piece
  before it and the number of tokens up to it, relative to the present;
* transition on a character: the new state, annotated with the change of the
  token count that the character brings (it may be zero or negative).

Transitions are compiled when first met and kept in the worker process in an
open-addressing hash table that numpy reads for many positions at once. Texts
are cut into chunks of `CHUNK` characters; all chunks of a block run in lock
step. A chunk yields a map from entry states to (exit state, tokens). Its entry
states are not known yet, so it runs from the vacant state, then from the exits
of the chunk before it, until no new entry turns up (the runs meet at the first
word boundary, where the run stops early). The maps then compose in a parallel
prefix scan over the chunks of a document, which gives its count.

Edge cases: a null or empty text has 0 bytes and 0 tokens; characters outside
the vocabulary cost one token per UTF-8 byte; repeated rows and ids are counted
row by row; an empty table gives an empty result; columns other than the id and
the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import arrow_map, out_batch, out_schema, table, text_batches

CHUNK = 512
#: States kept by a worker before it starts compiling anew.
MAX_STATES = 1_500_000
SPACE = "▁"


class Transducer:
    """Lazily compiled token-count transducer of a score-merged vocabulary."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        chars = sorted({c for p in pieces for c in p})
        self.chars = chars
        self.width = len(chars)
        self.cost = [1 if c in pieces else len(c.encode()) for c in chars]
        self.klass = np.full(0x110000, -1, np.int32)
        for i, c in enumerate(chars):
            self.klass[ord(c)] = i
        self.space = chars.index(SPACE) if SPACE in pieces else -1
        if self.space >= 0:
            self.klass[ord(" ")] = self.space
        self.crosses = any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.child: list[dict[int, int]] = [{}]
        self.piece_at: list[str | None] = [None]
        for p in [*pieces, *(c for c in chars if c not in pieces)]:
            if self.merge(p) != [p]:
                continue  # never produced by the merges
            n = 0
            for c in p:
                k = int(self.klass[ord(c)])
                if k not in self.child[n]:
                    self.child[n][k] = len(self.child)
                    self.child.append({})
                    self.piece_at.append(None)
                n = self.child[n][k]
            self.piece_at[n] = p
        self.space_node = self.child[0].get(self.space)
        self.agree: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.state_of: dict[tuple, int] = {((0, None, 0),): 0}
        self.states: list[tuple] = [((0, None, 0),)]
        self.bits = 16
        self._clear()
        self.used = 0

    def _clear(self) -> None:
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.next = np.zeros(1 << self.bits, np.int32)
        self.emit = np.zeros(1 << self.bits, np.int32)

    def merge(self, s: str) -> list[str]:
        """The encoding of a short string: best-scored, then leftmost pair first."""
        w = list(s)
        while len(w) > 1:
            scores = [self.pieces.get(a + b) for a, b in zip(w, w[1:])]
            best = max((x for x in scores if x is not None), default=None)
            if best is None:
                break
            i = scores.index(best)
            w[i:i + 2] = [w[i] + w[i + 1]]
        return w

    def _neighbours(self, a: str | None, b: str) -> bool:
        if a is None:
            return True
        ok = self.agree.get((a, b))
        if ok is None:
            if len(self.agree) > 2_000_000:
                self.agree.clear()
            ok = self.agree[a, b] = self.merge(a + b) == [a, b]
        return ok

    def compile(self, state: int, k: int) -> tuple[int, int]:
        """Transition on the character class ``k``: next state, token change."""
        found, still = None, []
        for node, before, count in self.states[state]:  # longest open start first
            to = self.child[node].get(k)
            if to is None:
                continue
            p = self.piece_at[to]
            if found is None and p is not None and self._neighbours(before, p):
                found = (p, count + (self.cost[k] if len(p) == 1 else 1))
            if self.child[to]:
                still.append((to, before, count))
        piece, change = found
        made = []
        for node, before, count in still:
            if node == self.space_node and before is not None and not self.crosses and before[-1] != SPACE:
                before = None  # no piece reaches over a word boundary
            made.append((node, before, count - change))
        made = (*made, (0, piece, 0))
        to = self.state_of.get(made)
        if to is None:
            to = self.state_of[made] = len(self.states)
            self.states.append(made)
        return to, change

    # hash table of the compiled transitions

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _insert(self, keys, nexts, emits) -> None:
        if (self.used + len(keys)) * 2 > len(self.keys):
            old = self.keys >= 0
            keys = np.concatenate([self.keys[old], keys])
            nexts = np.concatenate([self.next[old], nexts])
            emits = np.concatenate([self.emit[old], emits])
            while len(keys) * 2 > 1 << self.bits:
                self.bits += 1
            self.bits += 1
            self._clear()
            self.used = 0
        mask, at = len(self.keys) - 1, self._slot(keys)
        todo = np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] < 0
            self.keys[at[todo[free]]] = keys[todo[free]]  # one of several wins
            won = self.keys[at[todo]] == keys[todo]
            done = todo[won]
            self.next[at[done]], self.emit[at[done]] = nexts[done], emits[done]
            todo = todo[~won]
            at[todo] = (at[todo] + 1) & mask
        self.used += len(keys)

    def step(self, state: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One transition for many positions at once (classes >= 0)."""
        key = state.astype(np.int64) * self.width + k
        at = self._slot(key)
        got = self.keys[at]
        bad = np.flatnonzero(got != key)
        missing = []
        while len(bad):
            gone = got[bad] < 0
            missing.append(bad[gone])
            bad = bad[~gone]
            at[bad] = (at[bad] + 1) & (len(self.keys) - 1)
            got[bad] = self.keys[at[bad]]
            bad = bad[got[bad] != key[bad]]
        lost = np.concatenate(missing) if missing else []
        if len(lost):
            new = np.unique(key[lost])
            made = [self.compile(int(x) // self.width, int(x) % self.width) for x in new]
            self._insert(new, np.array([m[0] for m in made], np.int32),
                         np.array([m[1] for m in made], np.int32))
            return self.step(state, k)
        return self.next[at], self.emit[at]


def _run(t: Transducer, klass, cost, begin, length, state, path=None):
    """Run chunks in lock step. Without ``path``, returns exit states, tokens and
    the path (states and tokens so far, by step); with the path of another run,
    a chunk stops where it meets that run."""
    n = len(begin)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    state, count = state[order].astype(np.int32), np.zeros(n, np.int64)
    out_state, out_count = state.copy(), count.copy()
    steps = int(length[0]) if n else 0
    made = ([], []) if path is None else None
    live = np.arange(n)
    for i in range(steps):
        live = live[:np.searchsorted(-length[live], -i, "left")] if len(live) else live
        if not len(live):
            break
        at = begin[live] + i
        k = klass[at]
        known = k >= 0
        s, e = np.zeros(len(live), np.int32), cost[at].astype(np.int64)
        if known.all():
            s, e = t.step(state[live], k)
        elif known.any():
            s[known], e[known] = t.step(state[live[known]], k[known])
        state[live] = s
        count[live] += e
        if path is None:
            full_s, full_c = np.full(n, -1, np.int32), np.zeros(n, np.int32)
            full_s[order[live]], full_c[order[live]] = s, count[live]
            made[0].append(full_s)
            made[1].append(full_c)
        else:
            met = path[0][i][path[2][order[live]]] == s
            if met.any():
                j = live[met]
                o = path[2][order[j]]
                out_state[j] = path[3][o]
                out_count[j] = count[j] + path[4][o] - path[1][i][o]
                state[j] = -1
                live = live[~met]
    rest = state >= 0
    out_state[rest], out_count[rest] = state[rest], count[rest]
    back_s, back_c = np.empty(n, np.int32), np.empty(n, np.int64)
    back_s[order], back_c[order] = out_state, out_count
    return back_s, back_c, made


def count_tokens(t: Transducer, texts: str, starts: np.ndarray, ends: np.ndarray,
                 chunk: int = CHUNK) -> np.ndarray:
    """Tokens of ``texts[starts[i]:ends[i]]`` for each i."""
    if len(t.states) > MAX_STATES:
        t.reset()
    docs = len(starts)
    total = np.zeros(docs, np.int64)
    if not len(texts):
        return total
    points = np.frombuffer(texts.encode("utf-32-le"), np.uint32)
    klass = t.klass[points]
    cost = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
    length = ends - starts
    pieces = -(-length // chunk)
    doc = np.repeat(np.arange(docs), pieces)
    if not len(doc):
        return total
    first_of = np.cumsum(pieces) - pieces
    rank = np.arange(len(doc)) - first_of[doc]
    begin = starts[doc] + rank * chunk
    size = np.minimum(chunk, ends[doc] - begin)
    head = rank == 0

    lead, lead_tokens = 0, 0
    if t.space >= 0:  # the blank that the library puts before a text
        lead, lead_tokens = (int(x[0]) for x in t.step(np.zeros(1, np.int32), np.array([t.space])))

    # entry 0 of every chunk: the vacant state, or the true one at a document's head
    entry = [np.where(head, lead, 0).astype(np.int32)]
    out, cnt, path = _run(t, klass, cost, begin, size, entry[0])
    exits, counts = [out], [cnt]
    n = len(doc)
    link: list[np.ndarray] = []  # entry number of the next chunk that an exit leads to
    every = np.arange(n)
    r = 0
    while True:
        # exits of round r enter the next chunk: an entry already known, or a new one
        to = np.full(n, -1, np.int32)
        have = exits[r] >= 0
        into = np.flatnonzero(have[:-1] & ~head[1:]) if n > 1 else np.zeros(0, int)
        new = np.full(n, -1, np.int32)
        for c, arr in enumerate(entry):
            same = into[(to[into] < 0) & (arr[into + 1] == exits[r][into])]
            to[same] = c
        fresh = into[to[into] < 0]
        to[fresh] = len(entry)
        link.append(to)
        if len(fresh):
            new[fresh + 1] = exits[r][fresh]
            entry.append(new)
            which = fresh + 1
            o, c, _ = _run(t, klass, cost, begin[which], size[which], new[which],
                           (path[0], path[1], every[which], exits[0], counts[0]))
            full_o, full_c = np.full(n, -1, np.int32), np.zeros(n, np.int64)
            full_o[which], full_c[which] = o, c
            exits.append(full_o)
            counts.append(full_c)
        r += 1
        if r == len(entry):
            break

    # maps: row = chunk, column = entry -> (entry of the next chunk, tokens)
    go = np.maximum(np.stack(link, 1), 0)
    tok = np.stack(counts, 1)
    d = 1
    while d < int(pieces.max()):
        later = np.flatnonzero(rank >= d)
        via = go[later - d]
        tok_new = tok[later - d] + np.take_along_axis(tok[later], via, 1)
        go_new = np.take_along_axis(go[later], via, 1)
        tok, go = tok.copy(), go.copy()
        tok[later], go[later] = tok_new, go_new
        d *= 2
    has = pieces > 0
    total[has] = tok[(first_of + pieces - 1)[has], 0] + lead_tokens
    return total


_cache: dict[str, Transducer] = {}


def transducer(model_path: str) -> Transducer:
    """The worker's transducer of a sentencepiece BPE model."""
    if model_path not in _cache:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        _cache[model_path] = Transducer({
            sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))})
    return _cache[model_path]


def token_counts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """Id, n_bytes, n_tokens and over_limit of every row of ``df``."""
    schema = out_schema(df, [id_col], "n_bytes long, n_tokens long, over_limit boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model_path)
        for b in text_batches(batches, text_col):
            inner = np.cumsum((b.data & 0xC0) != 0x80) if len(b.data) else np.zeros(0, int)
            at = np.concatenate([[0], inner])[b.offsets]
            n = count_tokens(t, b.data.tobytes().decode("utf-8", "replace"), at[:-1], at[1:])
            ids = b.batch.column(id_col)
            yield out_batch(pa.schema([(id_col, ids.type), ("n_bytes", pa.int64()),
                                       ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]),
                            **{id_col: ids}, n_bytes=np.diff(b.offsets), n_tokens=n, over_limit=n > limit)

    return arrow_map(df.select(F.col(id_col), F.col(text_col)), run, schema)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts(table(spark, sf_dir, "documents"), str(public_tokenizers.path("piece_bpe_32k.model")))
