"""Byte-pair encoding and decoding by dynamic programming over prefixes.

Texts are cut into pieces by the vocabulary's pattern; a piece is encoded on its
own. The encoding of every prefix of a piece has exactly one last token, and the
tokens before it are the encoding of the shorter prefix. So a table with the last
token of each prefix holds all encodings:

* *Candidates.* The tokens that end at a place come from a suffix automaton of
  the vocabulary, read along the piece: its state is the longest suffix read that
  lies within a token, and its suffix links lead to the tokens among the shorter
  suffixes, longest first.
* *Test.* A candidate is the last token if it fits the last token of the prefix
  before it: two tokens fit if no merge ever joins them across their border. At
  any time of the merging the parts that meet there lie on the right spine of the
  one and the left spine of the other, so these are unfolded in the order in which
  they were formed, the latest first, and each pair that is met is looked up.
* *Ids.* Back-pointers, that is the tokens' lengths, lead from the end to the start.

Special tokens in a text are cut out before the pattern applies. Decoding puts
the tokens' bytes end to end; what is no UTF-8 becomes U+FFFD.

The new pieces of a block are taken in sorted order, so the table of a prefix that
two of them share is made once.

Bounds: a worker keeps the ids of `KEPT` short pieces and those of a block, and takes
a text in parts of some `PART` characters, cut after a character that a blank follows,
where a piece ends in any case. A piece needs ten bytes for each of its own bytes.

Edge cases: a null or empty text (or null ids) has no tokens and decodes to an
empty text; ids outside the vocabulary are an error; rows are encoded one by one,
so repeated rows and ids stay; an empty table gives an empty result; columns other
than those asked for are not read.
"""

from __future__ import annotations

import codecs
import json
import struct
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import arrow_map, out_batch, out_schema, table, text_batches

PART = 1 << 20
KEPT = 400_000
#: Pieces of more characters are not kept.
SHORT = 48
NEVER = 1 << 40


def byte_of_char() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for: printable
    characters of Latin-1 stand for their own, the next free ones for the rest."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


# Letters and numbers that Unicode has taken in since version 16.0. They count as other
# characters in byte-level vocabularies; the regex library may know them already.
LATE = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D "
    "107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F "
    "12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 16FF4-16FF6 187F8-187FF 18CD6-18CDA "
    "18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 "
    "1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF "
    "2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F ")

CONTRACTION, BLANKS = r"'s|'t|'re|'ve|'m|'ll|'d", r"\s+(?!\S)|\s+"


def late_characters() -> np.ndarray:
    """For each code point, whether it is one of `LATE`."""
    out = np.zeros(0x110000, bool)
    for r in LATE.split():
        ends = [int(x, 16) for x in r.split("-")]
        out[ends[0]:ends[-1] + 1] = True
    return out


def pattern(late: bool = True) -> str:
    """How byte-level vocabularies cut a text: contractions, letters, numbers, other
    characters, blanks; ``late`` also if characters of `LATE` occur, which costs time."""
    ranges = "".join("-".join(f"\\U{int(x, 16):08x}" for x in r.split("-")) for r in LATE.split())
    less = f"--[{ranges}]" if late else ""
    letter, number = f"[\\p{{L}}{less}]", f"[\\p{{N}}{less}]"
    return f"(?V1){CONTRACTION}| ?{letter}+| ?{number}+| ?[^\\s{letter}{number}]+|{BLANKS}"


class SuffixAutomaton:
    """Suffix automaton of a set of byte strings, grown along their trie level by level.

    ``step`` has the transitions of each state, ``link`` and ``length`` are as usual.
    The path of a string ends in a state whose longest member is that string.
    """

    def __init__(self, words: list[bytes]):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        children: list[dict[int, int]] = [{}]
        ends = []
        for w in words:
            v = 0
            for c in w:
                if c not in children[v]:
                    children[v][c] = len(children)
                    children.append({})
                v = children[v][c]
            ends.append(v)
        state = {0: 0}
        todo = deque([0])
        while todo:
            v = todo.popleft()
            for c, child in children[v].items():
                state[child] = self._extend(state[v], c)
                todo.append(child)
        self.end = [state[v] for v in ends]

    def _clone(self, p: int, c: int, q: int) -> int:
        """A state for the suffixes of q that follow p's, which end in more places than q's others."""
        new = len(self.length)
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.step.append(dict(self.step[q]))
        self.link[q] = new
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, c: int) -> int:
        q = self.step[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, c, q)
        new = len(self.length)
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        self.step.append({})
        p = last
        while p >= 0 and c not in self.step[p]:
            self.step[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return new


class BytePairs:
    """A byte-level vocabulary with merges. Tokens are numbered as they are formed:
    the 256 bytes, then one for each merge."""

    def __init__(self, spec: dict):
        model, of = spec["model"], byte_of_char()
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
        if model["type"] != "BPE" or odd or spec.get("normalizer") or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level vocabulary with merges")
        text = lambda s: bytes(of[c] for c in s)
        self.bytes = [bytes([b]) for b in range(256)]
        number = {b: i for i, b in enumerate(self.bytes)}
        self.left, self.right = [-1] * 256, [-1] * 256
        self.merged: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            a, b = (number[text(s)] for s in (merge.split(" ") if isinstance(merge, str) else merge))
            whole = self.bytes[a] + self.bytes[b]
            if whole in number:
                raise ValueError(f"two merges form {whole!r}")
            number[whole] = self.merged[a, b] = len(self.bytes)
            self.bytes.append(whole)
            self.left.append(a)
            self.right.append(b)
        ids = {text(s): i for s, i in model["vocab"].items() if set(s) <= of.keys()}
        self.id = [ids[b] for b in self.bytes]
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", ())}
        if any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in spec.get("added_tokens", ())):
            raise ValueError("special tokens that take blanks or whole words only are not supported")
        self._automaton()

    def _automaton(self) -> None:
        good = [True] * 256  # tokens that are their own encoding
        for t in range(256, len(self.bytes)):
            a, b = self.left[t], self.right[t]
            good.append(good[a] and good[b] and self.fits(a, b, t))
        words = [t for t, g in enumerate(good) if g]
        sam = SuffixAutomaton([self.bytes[t] for t in words])
        token = [-1] * len(sam.length)
        for t, v in zip(words, sam.end):
            token[v] = t
        # the nearest state with a token on the way along the links, itself included
        near = [-1] * len(sam.length)
        for v in sorted(range(1, len(near)), key=sam.length.__getitem__):
            near[v] = v if token[v] >= 0 else near[sam.link[v]]
        self.step, self.link, self.length, self.token, self.near = sam.step, sam.link, sam.length, token, near

    def fits(self, a: int, b: int, before: int = NEVER) -> bool:
        """No merge earlier than ``before`` joins a part of a with a part of b."""
        until_a = until_b = before  # when the parts at the border are merged away
        while True:
            m = self.merged.get((a, b))
            # of equal merges the left one comes first
            if m is not None and m < until_a and m <= until_b and m < before:
                return False
            if a > b and a > 255:
                until_a, a = a, self.right[a]
            elif b > 255:
                until_b, b = b, self.left[b]
            else:
                return True

    # --- encoding ---

    made = ("step", "link", "length", "token", "near", "bytes", "id", "left", "right", "merged", "special")

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k in self.made}

    def ready(self) -> None:
        """What a worker process keeps."""
        if not hasattr(self, "kept"):
            self.kept: dict[str, bytes] = {}
            #: by token: whether it fits a token before it
            self.fitting: list[dict[int, bool]] = [{} for _ in self.bytes]
            self.known = 0
            #: by state: the tokens that end in it and their lengths, longest first
            self.ending: list[tuple[tuple[int, int], ...] | None] = [None] * len(self.length)
            self.late = late_characters()
            self.cuts = [regex.compile(pattern(late)) for late in (False, True)]
            self.blank = regex.compile(r"\S(?=\s)")

    def _ending(self, state: int) -> tuple[tuple[int, int], ...]:
        out, v = [], self.near[state]
        while v >= 0:
            out.append((self.token[v], self.length[v]))
            v = self.near[self.link[v]]
        self.ending[state] = tuple(out)
        return self.ending[state]

    def _fits(self, a: int, b: int) -> bool:
        if self.known >= 4 * KEPT:
            for d in self.fitting:
                d.clear()
            self.known = 0
        self.known += 1
        fit = self.fitting[b][a] = self.fits(a, b)
        return fit

    def pieces(self, pieces: list[bytes]) -> Iterator[bytes]:
        """Ids (little-endian, 32 bits) of pieces in sorted order: what is known of the
        prefixes that a piece shares with the one before is used again."""
        step, link, length, ending, fitting = self.step, self.link, self.length, self.ending, self.fitting
        last, states, sizes = array("i", [0]), array("i", [0]), array("H", [0])  # by prefix
        old = b""
        for b in pieces:
            i, most = 0, min(len(old), len(b))
            while i < most and old[i] == b[i]:
                i += 1
            del last[i + 1:], states[i + 1:], sizes[i + 1:]
            state, size, old = states[i], sizes[i], b
            for c in b[i:]:
                i += 1
                to = step[state].get(c)
                while to is None:
                    state = link[state]
                    size = length[state]
                    to = step[state].get(c)
                state = to
                size += 1
                states.append(state)
                sizes.append(size)
                at = state if size == length[state] else link[state]
                for t, n in ending[at] or self._ending(at):
                    if n == i:
                        break
                    before = last[i - n]
                    fit = fitting[t].get(before)
                    if fit is None:
                        fit = self._fits(before, t)
                    if fit:
                        break
                last.append(t)
            out = []
            while i:
                t = last[i]
                out.append(self.id[t])
                i -= len(self.bytes[t])
            out.reverse()
            yield struct.pack(f"<{len(out)}I", *out)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids (little-endian, 32 bits) of texts."""
        self.ready()
        kept, out = self.kept, [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        size = 0

        def settle() -> None:
            if len(kept) > KEPT:
                kept.clear()
            new = sorted({p.encode() for _, pieces in waiting for p in pieces if p not in kept})
            kept.update(zip((b.decode() for b in new), self.pieces(new)))
            kept.update((s, struct.pack("<I", i)) for s, i in self.special.items())  # no piece has such a text
            for r, pieces in waiting:
                out[r].append(b"".join(map(kept.__getitem__, pieces)))
            for b in new:
                if len(b) > SHORT:
                    del kept[b.decode()]
            waiting.clear()

        for r, text in enumerate(texts):
            for plain, special in self._apart(text):
                a, n = 0, len(plain)
                while a < n:
                    m = self.blank.search(plain, a + PART) if n - a > PART else None
                    end = m.end() if m else n
                    late = not plain.isascii() and self.late[
                        np.frombuffer(plain[a:end].encode("utf-32-le"), "<u4")].any()
                    waiting.append((r, self.cuts[int(late)].findall(plain, a, end)))
                    size += end - a
                    a = end
                    if size >= PART:
                        settle()
                        size = 0
                if special is not None:
                    waiting.append((r, [special]))
        settle()
        return [b"".join(x) for x in out]

    def encode(self, text: str) -> bytes:
        """Ids (little-endian, 32 bits) of a text."""
        return self.encode_all([text])[0]

    def _apart(self, text: str) -> Iterator[tuple[str, str | None]]:
        """Stretches between special tokens, each with the special token after it."""
        found = [s for s in self.special if s in text]
        if not found:
            yield text, None
            return
        at = 0
        for m in regex.finditer("|".join(map(regex.escape, sorted(found, key=len, reverse=True))), text):
            yield text[at:m.start()], m.group()
            at = m.end()
        yield text[at:], None

    # --- decoding ---

    def decode(self, ids: np.ndarray) -> str:
        if not hasattr(self, "back"):
            self.back = {i: b for i, b in zip(self.id, self.bytes)} | {i: s.encode() for s, i in self.special.items()}
        out, utf8 = [], codecs.getincrementaldecoder("utf-8")("replace")
        for i in range(0, len(ids), PART):
            out.append(utf8.decode(b"".join(map(self.back.__getitem__, ids[i:i + PART].tolist()))))
        return "".join(out) + utf8.decode(b"", True)


_sent: dict[tuple, object] = {}


def vocabulary(spark: SparkSession, path: str):
    """The compiled vocabulary of a file, sent to the executors once (its size is the file's, not the data's)."""
    key = spark.sparkContext.applicationId, path
    if key not in _sent:
        with open(path, encoding="utf-8") as f:
            _sent[key] = spark.sparkContext.broadcast(BytePairs(json.load(f)))
    return _sent[key]


def encode(df: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns, n_tokens and ids (binary: little-endian unsigned 32-bit integers) of every row."""
    sent = vocabulary(df.sparkSession, path)
    source = df.select(*(F.col(c) for c in keep), F.col(text_col).alias("_t"))
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = sent.value
        for b in text_batches(batches, "_t"):
            raw = b.data.tobytes()
            ids = pairs.encode_all([raw[x:y].decode() for x, y in zip(b.offsets[:-1].tolist(), b.offsets[1:].tolist())])
            cols = {c: b.batch.column(c) for c in names}
            yield out_batch(pa.schema([*((c, x.type) for c, x in cols.items()), ("n_tokens", pa.int64()),
                                       ("ids", pa.binary())]), **cols, n_tokens=[len(x) // 4 for x in ids], ids=ids)

    return arrow_map(source, run, out_schema(source, keep, "n_tokens long, ids binary"))


def decode(df: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), ids_col: str = "ids") -> DataFrame:
    """``keep`` columns and decoded, the text of the ids, of every row."""
    sent = vocabulary(df.sparkSession, path)
    source = df.select(*(F.col(c) for c in keep), F.col(ids_col).alias("_ids"))
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = sent.value
        for b in text_batches(batches, "_ids"):
            raw = b.data.tobytes()
            texts = [pairs.decode(np.frombuffer(raw[x:y], "<u4"))
                     for x, y in zip(b.offsets[:-1].tolist(), b.offsets[1:].tolist())]
            cols = {c: b.batch.column(c) for c in names}
            yield out_batch(pa.schema([*((c, x.type) for c, x in cols.items()), ("decoded", pa.string())]),
                            **cols, decoded=texts)

    return arrow_map(source, run, out_schema(source, keep, "decoded string"))


def op13_byte_pairs(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    ids = encode(table(spark, sf_dir, "documents"), path).withColumn("ids_sha256", F.sha2("ids", 256))
    keep = ("doc_id", "n_tokens", "ids_sha256")
    return decode(ids, path, keep).select(*keep, F.sha2("decoded", 256).alias("decoded_sha256"))
