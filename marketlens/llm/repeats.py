"""Finding windows of ``window`` units (words, bytes) that occur more than once.

Shared scaffolding of the two substring operators; how the occurrences of a
group are sorted and compared is theirs (`Plan.order`).

1. *Sampling.* Of the grams of ``gram`` units in each window the one with the
   smallest hash is the window's anchor. Equal windows have equal anchors at
   equal places, so it is enough to look at anchors; consecutive windows mostly
   share theirs. An anchor is recorded with the run of windows that it stands
   for and two hashes: of the gram (``key``) and of all units of the run (``ctx``).
2. *Classes.* Records with equal key and ctx stand for equal runs. A class is
   represented by two *leaves*, its first two occurrences; all others *follow*
   the second one. Leaves are chosen first within each task, so that a run that
   occurs in a third of all documents leaves a task twice, then over all tasks,
   sorted by key. A key with one record is unique and done.
3. *Contexts.* The leaves fetch their units from the documents (joined by
   document) and meet again by key, at most ``limit`` classes to a group;
   `Plan.order` sorts them by what follows the anchor and by what precedes it,
   with the common lengths of neighbours. Two leaves share a window with l units
   before the anchor exactly if they agree in l units to the left and
   ``window`` - l to the right. Nothing but this order says that a window repeats.
4. *Large groups.* A key with more than ``limit`` classes is divided by longer
   keys: a record's run is cut by the number of units before the anchor, into
   parts of ``steps`` windows, and the key of a part is all that its windows have
   in common. Such a part is a record like any other, with classes and leaves,
   and carries its units; the last step is 1, where each window is a group of
   its own, which is told by its two hashes and not compared again.
5. *Followers.* From the last division back to the first, the windows found of
   each class's second leaf are those of its followers, which meet them by key
   and ctx.

A document is told by its id and a hash of its text; a null id sorts last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import BASES, Block, arrow_map, materialize, mix, out_batch, out_schema, text_batches

NO_ID = 2**63 - 1
RECORD, REPEATED, REQUEST, SPLIT, FOLLOW = 0, 1, 2, 3, 4

_FIELDS = [("kind", "byte", pa.int8(), np.int8), ("key", "long", pa.int64(), np.int64), ("ctx", "long", pa.int64(), np.int64),
           ("doc", "long", pa.int64(), np.int64), ("disc", "int", pa.int32(), np.int32), ("a", "int", pa.int32(), np.int32),
           ("n", "int", pa.int32(), np.int32), ("off", "int", pa.int32(), np.int32),
           ("led", "boolean", pa.bool_(), bool),  # a second leaf that others follow
           ("home", "long", pa.int64(), np.int64)]  # a follower's key: its ``key`` scatters it
NAMES = [f[0] for f in _FIELDS]
DDL = ", ".join(f"{n} {t}" for n, t, _, _ in _FIELDS)
ARROW = pa.schema([(n, t) for n, _, t, _ in _FIELDS])


@dataclass(frozen=True)
class Plan:
    window: int
    gram: int
    keep_first: bool  # the earliest occurrence stays; otherwise all go
    limit: int  # classes of a key that are compared in one group
    block_bytes: int
    steps: tuple[int, ...]  # windows in a part of a divided run, round by round
    #: Block -> (hash of each unit, hash of each gram, unit offsets of the rows, slice of units as bytes)
    units: Callable[[Block], tuple]
    #: (contexts, units before the anchor) -> order and neighbours' common length, to the right and to the left
    order: Callable[[list[bytes], np.ndarray], tuple]
    flush: int = 500_000  # records gathered in a task before its leaves are chosen
    group_rows: int = 4096  # records compared at a time

    @property
    def reach(self) -> int:
        return self.window - self.gram + 1


# --- columns of records ----------------------------------------------------

def _take(r: dict, at) -> dict:
    return {k: v[at] for k, v in r.items()}


def _join(parts: list[dict]) -> dict:
    """Records end to end; ``units``, an array of bytes or None, if they have it."""
    out = {n: np.concatenate([p[n] for p in parts]) if parts else np.zeros(0, t) for n, _, _, t in _FIELDS}
    if parts and "units" in parts[0]:
        out["units"] = np.concatenate([p["units"] for p in parts])
    return out


def _emit(r: dict, units: bool = False) -> pa.RecordBatch:
    columns = [pa.array(r[n], t) for n, _, t, _ in _FIELDS]
    if not units:
        return pa.RecordBatch.from_arrays(columns, schema=ARROW)
    texts = pa.array(list(r["units"]), pa.binary()) if "units" in r else pa.nulls(len(r["key"]), pa.binary())
    return pa.RecordBatch.from_arrays([*columns, texts], schema=pa.schema([*ARROW, ("units", pa.binary())]))


def _read(b: pa.RecordBatch) -> dict:
    out = {n: b.column(n).to_numpy(zero_copy_only=False).astype(t, copy=False) for n, _, _, t in _FIELDS}
    if "units" in b.schema.names:
        out["units"] = np.array([*b.column("units").to_pylist(), None], object)[:-1]
    return out


def _as(r: dict, kind: int) -> dict:
    return r | {"kind": np.full(len(r["key"]), kind, np.int8)}


def _runs(r: dict) -> dict:
    """Repeated runs of windows, adjoining ones of a document merged."""
    r = {n: r[n] for n in NAMES}
    if not len(r["key"]):
        return _as(r, REPEATED)
    r = _take(r, np.lexsort((r["a"], r["disc"], r["doc"])))
    end = r["a"].astype(np.int64) + r["n"]
    same = (r["doc"][1:] == r["doc"][:-1]) & (r["disc"][1:] == r["disc"][:-1])
    new = np.ones(len(end), bool)
    new[1:] = ~same | (r["a"][1:] > end[:-1])
    first = np.flatnonzero(new)
    top = np.maximum.reduceat(end, first)
    out = _take(r, first)
    out["n"] = (top - out["a"]).astype(np.int32)
    zero = np.zeros(len(first), np.int64)
    # scattered by document: repeated runs only pass through the shuffle
    return _as(out | {"key": mix(out["doc"].view(np.uint64)).view(np.int64), "ctx": zero}, REPEATED)


def _starts(r: dict, *names: str) -> np.ndarray:
    """Where one of the columns differs from the row before."""
    new = np.ones(len(r["key"]), bool)
    new[1:] = np.logical_or.reduce([r[n][1:] != r[n][:-1] for n in names])
    return new


def _classed(r: dict) -> tuple[dict, np.ndarray]:
    """Records sorted by class (key, ctx) and place, and where classes begin."""
    r = _take(r, np.lexsort((r["a"], r["disc"], r["doc"], r["ctx"], r["key"])))
    return r, _starts(r, "key", "ctx")


def _leaves(r: dict, keep_first: bool) -> tuple[dict, dict]:
    """The first two occurrences of each class, and the records that follow the second.

    Records of one document and place (repeated rows) count as one occurrence
    where the first stays, and as several otherwise.
    """
    r, new = _classed(r)
    if not len(new):
        return r, _followers(r)
    first, which = np.flatnonzero(new), np.cumsum(new) - 1
    lead = first[which]
    later = (r["doc"] != r["doc"][lead]) | (r["a"] != r["a"][lead]) if keep_first else ~new
    rank = np.cumsum(later)
    rank -= rank[lead]
    second, rest = later & (rank == 1), later & (rank > 1)
    led = np.logical_or.reduceat(r["led"] | rest, first)
    r["led"] = second & led[which]
    leaf = new | second
    return _take(r, leaf), _followers(_take(r, rest))


def _followers(r: dict) -> dict:
    """Scattered: followers only pass through the shuffle by key."""
    out = {n: r[n] for n in NAMES}
    spread = mix(r["doc"].view(np.uint64) ^ r["ctx"].view(np.uint64)).view(np.int64)
    return _as(out | {"home": r["key"], "key": spread}, FOLLOW)


def _equal(r: dict, keep_first: bool) -> tuple[dict, dict]:
    """Of single windows, told by their hashes: one record of each class, and those that repeat."""
    r, new = _classed(r)
    first = np.flatnonzero(new)
    lead = first[np.cumsum(new) - 1] if len(new) else first
    if keep_first:
        gone = (r["doc"] != r["doc"][lead]) | (r["a"] != r["a"][lead])
    else:
        size = np.diff(np.append(first, len(new)))
        gone = np.repeat(size > 1, size)
    return _take(r, first), _runs(_take(r, gone))


# --- 1: sampling -----------------------------------------------------------

_powers: dict[tuple, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, 1 << 16) + 1, np.uint64)
        have[1:] = np.cumprod(np.full(len(have) - 1, base, np.uint64))
        _powers[base] = have
    return have[:n]


def prefix_hash(h: np.ndarray, base: int) -> Callable:
    """Hash of any range of ``h`` (begin and end positions)."""
    inverse = pow(base, -1, 1 << 64)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _power(base, len(h)), out=sums[1:])
    down = _power(inverse, len(h) + 1)
    return lambda a, b: (sums[b] - sums[a]) * down[a]


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of the w values from each position on, in three passes."""
    n = len(x) - w + 1
    full = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    full[:len(x)] = x
    tiles = full.reshape(-1, w)
    ahead = np.minimum.accumulate(tiles, 1).ravel()
    back = np.minimum.accumulate(tiles[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def sample(h: np.ndarray, g: np.ndarray, rows: np.ndarray, plan: Plan):
    """(row, first window, windows, anchor, key, ctx) of the anchors of a block."""
    size = len(h) - plan.window + 1
    if size <= 0 or not (np.diff(rows) >= plan.window).any():
        return None
    bits = np.uint64(max(1, int(len(h)).bit_length()))
    packed = ((g >> bits) << bits) | np.arange(len(g), dtype=np.uint64)
    anchor = (window_min(packed, plan.reach)[:size] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    valid = np.zeros(size + 1, np.int8)
    has = np.diff(rows) >= plan.window
    np.add.at(valid, rows[:-1][has], 1)
    np.add.at(valid, rows[1:][has] - plan.window + 1, -1)
    valid = np.cumsum(valid[:size]) > 0
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    a = np.flatnonzero(new)
    stop = np.append(np.flatnonzero(new | ~valid), size)
    n = stop[np.searchsorted(stop, a, "right")] - a
    p = anchor[a]
    row = np.searchsorted(rows, a, "right") - 1
    place = (p - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + n.astype(np.uint64)
    ctx = mix(prefix_hash(h, int(BASES[3]))(a, a + n + plan.window - 1) + place)
    return row, a, n, p, g[p].view(np.int64), ctx.view(np.int64)


def _sampled(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    count = 0

    def flush():
        both = _leaves(_join(held), plan.keep_first)
        held.clear()
        for r in both:
            for i in range(0, len(r["key"]), 1 << 16):
                yield _emit(_take(r, slice(i, i + (1 << 16))))

    for b in text_batches(batches, "text", plan.block_bytes):
        h, g, rows, _ = plan.units(b)
        found = sample(h, g, rows, plan)
        if found is None:
            continue
        row, a, n, p, key, ctx = found
        m = len(a)
        doc = b.batch.column("doc").to_numpy(zero_copy_only=False)[row]
        disc = b.batch.column("disc").to_numpy(zero_copy_only=False)[row]
        held.append({"kind": np.zeros(m, np.int8), "key": key, "ctx": ctx, "doc": doc.astype(np.int64),
                     "disc": disc.astype(np.int32), "a": (a - rows[row]).astype(np.int32), "n": n.astype(np.int32),
                     "off": (p - a).astype(np.int32), "led": np.zeros(m, bool), "home": np.zeros(m, np.int64)})
        count += m
        if count >= plan.flush:
            yield from flush()
            count = 0
    if held:
        yield from flush()


# --- 2: classes ------------------------------------------------------------

def _classes(batches: Iterator[pa.RecordBatch], plan: Plan, units: bool = False,
             single: bool = False) -> Iterator[pa.RecordBatch]:
    """Input sorted by key. Followers, and requests of the leaves of keys with several
    records, with ``units`` if the input has them; repeated windows where records are ``single`` ones."""
    settle = _equal if single else _leaves
    pending: list[dict] = []
    split_key = None  # a key whose requests have begun to go out window by window

    def close(r: dict):
        """All records of some keys."""
        rep, rest = settle(r, plan.keep_first)
        if len(rest["key"]):
            yield _emit(rest, units)
        if not len(rep["key"]) or single:
            return
        at = np.flatnonzero(_starts(rep, "key"))
        size = np.diff(np.append(at, len(rep["key"])))
        classes = np.add.reduceat(_starts(rep, "key", "ctx"), at, dtype=np.int64)
        split = np.repeat(classes > plan.limit, size)
        if split_key is not None:
            split |= rep["key"] == split_key
        ask = np.repeat(size > 1, size) | split
        out = _as(rep, REQUEST)
        out["kind"][split] = SPLIT
        if ask.any():
            yield _emit(_take(out, ask), units)

    for b in batches:
        r = _read(b)
        done = r["kind"] != RECORD
        if done.any():
            yield _emit(_take(r, done), units)
        r = _take(r, ~done)
        if not len(r["key"]):
            continue
        pending.append(r)
        cut = int(np.searchsorted(r["key"], r["key"][-1], "left"))
        if cut or (len(pending) > 1 and pending[0]["key"][0] != r["key"][-1]):
            whole = pending[:-1] + [_take(r, slice(0, cut))]
            pending = [_take(r, slice(cut, None))]
            yield from close(_join(whole))
            split_key = None
        elif sum(len(x["key"]) for x in pending) > plan.flush:  # one very frequent key
            rep, rest = settle(_join(pending), plan.keep_first)
            if len(rest["key"]):
                yield _emit(rest, units)
            pending = [rep]
            if len(rep["key"]) > plan.flush // 2 and not single:
                split_key = rep["key"][0]
                last = int(np.searchsorted(rep["ctx"], rep["ctx"][-1], "left"))  # this class may go on
                yield _emit(_as(_take(rep, slice(0, last)), SPLIT), units)
                pending = [_take(rep, slice(last, None))]
    if pending:
        yield from close(_join(pending))


# --- 3 and 4: contexts -----------------------------------------------------

def _contexts(batches: Iterator[pa.RecordBatch], plan: Plan, step: int) -> Iterator[pa.RecordBatch]:
    """Rows of documents with their requests: contexts, or parts of runs where a key is divided."""
    for b in text_batches(batches, "text", plan.block_bytes):
        h, _, rows, cut = plan.units(b)
        asked = b.batch.column("asked")
        flat = asked.flatten()
        row = np.repeat(np.arange(b.rows), np.diff(asked.offsets.to_numpy()))
        if not len(row):
            continue
        r = {n: flat.field(n).to_numpy(zero_copy_only=False).astype(t, copy=False)
             for n, _, _, t in _FIELDS if n not in ("doc", "disc")}
        for n, t in (("doc", np.int64), ("disc", np.int32)):
            r[n] = b.batch.column(n).to_numpy(zero_copy_only=False)[row].astype(t)
        begin = rows[row] + r["a"]
        yield from _with_units(_take(r, r["kind"] == REQUEST), begin[r["kind"] == REQUEST], plan, cut)
        split = r["kind"] == SPLIT
        yield from _divided(_take(r, split), begin[split], h, cut, plan, step)


def _parts(batches: Iterator[pa.RecordBatch], plan: Plan, step: int) -> Iterator[pa.RecordBatch]:
    """Records with their units, divided further."""
    for b in text_batches(batches, "units", plan.block_bytes):
        h, _, rows, cut = plan.units(b)
        yield from _divided({n: v for n, v in _read(b.batch).items() if n != "units"}, rows[:-1], h, cut, plan, step)


def _with_units(r: dict, begin: np.ndarray, plan: Plan, cut: Callable) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(begin), 8192):
        x = _take(r, slice(i, i + 8192))
        texts = [cut(a, a + n + plan.window - 1) for a, n in zip(begin[i:i + 8192].tolist(), x["n"].tolist())]
        yield _emit(x | {"units": texts}, True)


def _divided(r: dict, begin: np.ndarray, h: np.ndarray, cut: Callable, plan: Plan, step: int) -> Iterator[pa.RecordBatch]:
    """The runs of ``r`` in parts of ``step`` windows by the number of units before the anchor."""
    if not len(begin):
        return
    first, second = prefix_hash(h, int(BASES[0])), prefix_hash(h, int(BASES[1]))
    high = r["off"].astype(np.int64)  # units before the anchor, from the run's first window on
    low = high - r["n"] + 1
    many = high // step - low // step + 1
    which = np.repeat(np.arange(len(begin)), many)
    part = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + (low // step)[which]
    most = np.minimum(high[which], part * step + step - 1)
    least = np.maximum(low[which], part * step)
    anchor = begin[which] + high[which]
    wide = np.minimum(part * step + step, plan.reach) - 1  # the part's windows share what lies between
    place = most.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (most - least).astype(np.uint64)
    x = _take(r, which)
    x |= {"kind": np.full(len(which), RECORD, np.int8),
          "key": mix(first(anchor - part * step, anchor - wide + plan.window) + part.astype(np.uint64)).view(np.int64),
          "ctx": mix(second(anchor - most, anchor - least + plan.window) + place).view(np.int64),
          "a": (x["a"] + high[which] - most).astype(np.int32), "n": (most - least + 1).astype(np.int32),
          "off": most.astype(np.int32), "led": np.zeros(len(which), bool)}
    at = np.empty(len(which), object)  # where the part's units begin, through the sorting of the classes
    at[:] = (anchor - most).tolist()
    rep, rest = (_leaves if step > 1 else _equal)(x | {"units": at}, plan.keep_first)
    yield _emit(rest, True)
    begin = rep.pop("units").astype(np.int64)
    if step > 1:
        yield from _with_units(rep, begin, plan, cut)
    else:
        for i in range(0, len(begin), 1 << 16):
            yield _emit(_take(rep, slice(i, i + (1 << 16))), True)


def _compare(r: dict, texts: list[bytes], plan: Plan) -> dict:
    """Repeated runs among the contexts of some whole keys."""
    n, w, reach = len(texts), plan.window, plan.reach
    right, right_common, left, left_common = plan.order(texts, r["off"])
    low, high = r["off"] - r["n"] + 1, r["off"]  # units before the anchor, of the record's windows
    hit = np.zeros((n, reach + 2), np.int8)
    node_r, node_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for l in range(int(low.min()), int(high.max()) + 1):
        at = np.flatnonzero((low <= l) & (l <= high))
        if len(at) < 2:
            continue
        # the node that holds a record: neighbours that agree deep enough stay together
        node_r[right] = np.cumsum(np.concatenate([[0], right_common < w - l]))
        node_l[left] = np.cumsum(np.concatenate([[0], left_common < l]))
        c = node_r[at] * n + node_l[at]
        start = r["a"][at].astype(np.int64) + r["off"][at] - l
        o = np.lexsort((start, r["disc"][at], r["doc"][at], c)) if plan.keep_first else np.argsort(c, kind="stable")
        at, c = at[o], c[o]
        new = np.ones(len(c), bool)
        new[1:] = c[1:] != c[:-1]
        if plan.keep_first:
            lead = at[np.flatnonzero(new)[np.cumsum(new) - 1]]
            begin = r["a"].astype(np.int64) + r["off"]
            again = (r["doc"][at] != r["doc"][lead]) | (begin[at] != begin[lead])
        else:
            again = ~new
            again[:-1] |= ~new[1:]
        hit[at[again], l + 1] = 1
    # runs of windows, in the order of the text: from many units before the anchor to few
    edge = np.diff(hit[:, ::-1], axis=1)
    i, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    if not len(i):
        return _join([])
    most = reach - begin - 1  # units before the anchor at the run's first window
    out = _take(r, i)
    out["a"] = (out["a"].astype(np.int64) + out["off"] - most).astype(np.int32)
    out["n"] = (end - begin).astype(np.int32)
    return _runs(out)


def _resolved(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """Input sorted by key, keys of at most ``limit`` records."""
    parts: list[dict] = []
    texts: list[bytes] = []

    def close(upto: int):
        r = _join(parts)
        out = _compare(_take(r, slice(0, upto)), texts[:upto], plan)
        parts[:] = [_take(r, slice(upto, None))]
        del texts[:upto]
        if len(out["key"]):
            yield _emit(out)

    for b in batches:
        parts.append({n: v for n, v in _read(b).items() if n != "units"})
        texts += b.column("units").to_pylist()
        if len(texts) >= plan.group_rows:
            keys = np.concatenate([p["key"] for p in parts])
            upto = int(np.searchsorted(keys, keys[-1], "left"))
            if upto:
                yield from close(upto)
    if texts:
        yield from close(len(texts))


# --- 5: followers ----------------------------------------------------------

def _verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their led leaves and their runs of repeated windows: per class the
    runs inside its leaf, counted from the leaf's first window."""
    schema = pa.schema([("home", pa.int64()), ("ctx", pa.int64()), ("begin", pa.int32()), ("windows", pa.int32())])

    def column(b, name):
        """Fields of a column of lists of structs, and each entry's row as the high half of a position."""
        lists = b.column(name)
        row = np.repeat(np.arange(b.num_rows, dtype=np.int64), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten()
        return (lambda f: flat.field(f).to_numpy(zero_copy_only=False)), row << 32

    for b in batches:
        if not b.num_rows:
            continue
        leaf, base = column(b, "leaves")
        run, run_base = column(b, "runs")
        start = run_base + run("a")
        end = start + run("n")
        o = np.argsort(start, kind="stable")
        start, end = start[o], end[o]
        high = np.maximum.accumulate(end)
        new = np.ones(len(start), bool)
        new[1:] = start[1:] > high[:-1]  # adjoining runs are one
        at = np.flatnonzero(new)
        start, end = start[at], np.maximum.reduceat(end, at)
        low = base + leaf("a")
        stop = low + leaf("n")
        i = np.searchsorted(end, low, "right")
        many = np.maximum(np.searchsorted(start, stop, "left") - i, 0)
        of = np.repeat(np.arange(len(low)), many)
        i = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + i[of]
        x, y = np.maximum(start[i], low[of]), np.minimum(end[i], stop[of])
        yield out_batch(schema, home=leaf("key")[of], ctx=leaf("ctx")[of], begin=(x - low[of]).astype(np.int32),
                        windows=(y - x).astype(np.int32))


def _followed(followers: DataFrame, leaves: DataFrame, runs: DataFrame) -> DataFrame:
    """Repeated runs of the followers: those of their class's second leaf."""
    led = leaves.where("led").groupBy("doc", "disc").agg(F.collect_list(F.struct("key", "ctx", "a", "n")).alias("leaves"))
    found = runs.groupBy("doc", "disc").agg(F.collect_list(F.struct("a", "n")).alias("runs"))
    verdicts = arrow_map(led.join(found, ["doc", "disc"]), _verdicts, "home long, ctx long, begin int, windows int")
    return followers.select("home", "ctx", "doc", "disc", "a").join(verdicts, ["home", "ctx"]).select(
        "doc", "disc", (F.col("a") + F.col("begin")).alias("a"), F.col("windows").alias("n"))


# --- all steps -------------------------------------------------------------

def _by_key(df: DataFrame) -> DataFrame:
    return df.repartition("key").sortWithinPartitions("key", "ctx", "doc", "a")


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` with doc, disc and text, which tell its documents apart."""
    return df.withColumn("_t", F.coalesce(F.col(text_col), F.lit(""))).withColumn(
        "_doc", F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))).withColumn("_disc", F.hash("_t"))


def repeated_windows(df: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, disc, runs): for each document with repeated windows the flat list of
    first window and number of windows of its runs."""
    docs = keyed(df, id_col, text_col).select(
        F.col("_doc").alias("doc"), F.col("_disc").alias("disc"), F.col("_t").alias("text"))
    sampled = arrow_map(docs, lambda it: _sampled(it, plan), DDL)
    settled = materialize(arrow_map(_by_key(sampled), lambda it: _classes(it, plan), DDL), "classes")
    levels = [(settled.where(F.col("kind") == FOLLOW), settled.where(F.col("kind").isin(REQUEST, SPLIT)))]

    asked = levels[0][1].groupBy("doc", "disc").agg(
        F.collect_list(F.struct(*(F.col(n) for n in NAMES if n not in ("doc", "disc")))).alias("asked"))
    # repeated rows of a document ask once: each of their leaves is an entry of its own
    asking = docs.join(asked, ["doc", "disc"]).dropDuplicates(["doc", "disc"])
    wide = f"{DDL}, units binary"
    now = materialize(arrow_map(asking, lambda it: _contexts(it, plan, plan.steps[0]), wide), "contexts")
    here = F.col("kind") == REQUEST
    contexts, runs = now.where(here), []
    for step, next_step in zip(plan.steps, (*plan.steps[1:], 0)):
        single = step == 1
        parts = now.where(F.col("kind") == RECORD)
        classed = materialize(arrow_map(_by_key(parts), lambda it, single=single: _classes(it, plan, True, single), wide),
                              "classes")
        if single:  # windows that are told by their hashes
            runs += [x.where(F.col("kind") == REPEATED).select("doc", "disc", "a", "n") for x in (now, classed)]
            break
        levels.append((now.where(F.col("kind") == FOLLOW).unionByName(classed.where(F.col("kind") == FOLLOW)),
                       classed.where(F.col("kind").isin(REQUEST, SPLIT))))
        contexts = contexts.unionByName(classed.where(here))
        split = classed.where(F.col("kind") == SPLIT)
        if split.isEmpty():
            break
        now = materialize(arrow_map(split, lambda it, step=next_step: _parts(it, plan, step), wide), "contexts")
    compared = arrow_map(_by_key(contexts), lambda it: _resolved(it, plan), DDL).select("doc", "disc", "a", "n")
    found = reduce(DataFrame.unionByName, runs, compared)
    for followers, leaves in reversed(levels):
        if not leaves.where("led").isEmpty():
            found = materialize(found, "runs")
            found = found.unionByName(_followed(followers, leaves, found))
    return found.groupBy("doc", "disc").agg(F.flatten(F.collect_list(F.array("a", "n"))).alias("runs"))


def remove_repeats(df: DataFrame, plan: Plan, keep: tuple[str, ...], joiner: bytes, id_col: str = "doc_id",
                   text_col: str = "text", as_text: bool = False) -> DataFrame:
    """``keep`` columns, n_units, n_removed, n_spans and kept of every row.

    kept has the units that stay, as bytes, or as text without the pieces of
    characters that a cut may leave.
    """
    docs = keyed(df, id_col, text_col)
    runs = repeated_windows(df, plan, id_col, text_col)
    side = docs.select(*(F.col(c) for c in keep), F.col("_doc").alias("doc"), F.col("_disc").alias("disc"),
                       F.col("_t"))
    j = side.join(runs, ["doc", "disc"], "left").select(*keep, F.col("_t"), "runs")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches, "_t", plan.block_bytes):
            yield _stripped(b, plan, keep, joiner, as_text)

    kind = "string" if as_text else "binary"
    return arrow_map(j, run, out_schema(j, keep, f"n_units long, n_removed long, n_spans long, kept {kind}"))


def _stripped(b: Block, plan: Plan, keep: tuple[str, ...], joiner: bytes, as_text: bool) -> pa.RecordBatch:
    _, _, rows, cut = plan.units(b)
    runs = b.batch.column("runs")
    removed, spans, left = [], [], []
    for r in range(b.rows):
        n = int(rows[r + 1] - rows[r])
        flat = np.array(runs[r].as_py() or (), np.int64)
        cover = np.zeros(n + 1, np.int64)
        np.add.at(cover, flat[::2], 1)
        np.add.at(cover, flat[::2] + flat[1::2] + plan.window - 1, -1)
        gone = np.cumsum(cover)[:-1] > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[1], gone.view(np.int8), [1]])))
        pairs = [(int(x), int(y)) for x, y in edge.reshape(-1, 2)] if n else []  # stretches that stay
        removed.append(int(gone.sum()))
        spans.append(int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum()))
        parts = (cut(int(rows[r]) + x, int(rows[r]) + y, True) for x, y in pairs)
        left.append("".join(p.decode("utf-8", "ignore") for p in parts) if as_text else joiner.join(parts))
    cols = {c: b.batch.column(c) for c in keep}
    schema = pa.schema([*((c, x.type) for c, x in cols.items()), ("n_units", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept", pa.string() if as_text else pa.binary())])
    return out_batch(schema, **cols, n_units=np.diff(rows), n_removed=removed, n_spans=spans, kept=left)
