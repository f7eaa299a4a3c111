"""Byte-pair encoding and decoding against the library."""

import hashlib
import json
import os
import random

import numpy as np
import pytest
from brute import frame

from marketlens.llm import byte_pairs as B

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def pairs():
    with open(PATH, encoding="utf-8") as f:
        return B.BytePairs(json.load(f))


def ids_of(pairs, text):
    return np.frombuffer(pairs.encode(text), "<u4").tolist()


def test_random_texts(library, pairs):
    rnd = random.Random(3)
    letters = "  ab theé▁\n\t中文😀1234<s>xyzüß\x00#*,.'̀  \x85\x1c​\U00031400"
    texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 60))) for _ in range(4000)]
    texts += ["".join(rnd.choices("ab", k=rnd.randint(0, 60))) for _ in range(1000)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(0xD800), rnd.randrange(0xE000, 0x110000)]))
                      for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    texts += ["e" * 5000, "'" * 99, " " * 3000, "the" * 500, "it's 'll'd'reX'RE'S", "\n\n \n x", "a \n"]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids_of(pairs, text) == want.ids, repr(text)
        assert pairs.decode(np.array(want.ids, "<u4")) == library.decode(want.ids, skip_special_tokens=False) == text


def test_every_character(library, pairs):
    text = "".join(chr(c) + ("a", " ", "1", "!")[c % 4] for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    assert ids_of(pairs, text) == library.encode(text, add_special_tokens=False).ids


def test_special_tokens(library, pairs):
    for text in ("<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext|> \n", "<|endoftext|", "  <|endoftext|>  x"):
        assert ids_of(pairs, text) == library.encode(text, add_special_tokens=False).ids


def test_any_ids_decode(library, pairs):
    rnd = random.Random(4)
    for _ in range(3000):
        ids = [rnd.randrange(50257) for _ in range(rnd.randint(0, 12))]
        assert pairs.decode(np.array(ids, "<u4")) == library.decode(ids, skip_special_tokens=False)
    with pytest.raises(KeyError):
        pairs.decode(np.array([50257], "<u4"))


def test_long_texts_in_parts(library, pairs, monkeypatch):
    rnd = random.Random(5)
    text = "".join(rnd.choices(["word", " ", "  ", "\n", "'s", "1", "é", " ", "!!"], k=3000))
    want = library.encode(text, add_special_tokens=False).ids
    for part in (1, 2, 50):
        monkeypatch.setattr(B, "PART", part)
        assert ids_of(pairs, text) == want and pairs.decode(np.array(want, "<u4")) == text


def test_kept_pieces_are_bounded(library, pairs, monkeypatch):
    monkeypatch.setattr(B, "KEPT", 3)
    pairs.ready()
    pairs.kept.clear()
    pairs.known = 99
    texts = [f"word{i} éa{i * 7} " + "long" * 20 for i in range(50)]
    for text in texts:
        assert ids_of(pairs, text) == library.encode(text, add_special_tokens=False).ids
        assert len(pairs.kept) <= 12 and not any(len(p) > B.SHORT for p in pairs.kept)
        assert sum(map(len, pairs.fitting)) == pairs.known <= 12
    assert pairs.encode_all(texts) == [pairs.encode(t) for t in texts]


def test_automaton_knows_all_factors():
    words = [b"abab", b"babc", b"cab", b"b"]
    sam = B.SuffixAutomaton(words)
    factors = {w[i:j] for w in words for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
    found, todo = set(), [(0, b"")]
    while todo:
        v, s = todo.pop()
        for c, to in sam.step[v].items():
            found.add(s + bytes([c]))
            todo.append((to, s + bytes([c])))
    assert found == factors and [sam.length[v] for v in sam.end] == [4, 4, 3, 1]


def test_other_kinds_are_refused():
    model = {"type": "BPE", "vocab": {}, "merges": []}
    for spec in ({"model": model | {"type": "Unigram"}}, {"model": model, "normalizer": {"type": "NFC"}}):
        with pytest.raises(ValueError):
            B.BytePairs(spec)


def digests(library, docs):
    out = []
    for d, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_documents(spark, library, odd_docs, tmp_path):
    frame(spark, odd_docs).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    got = B.op13_byte_pairs(spark, str(tmp_path / "a")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == digests(library, odd_docs)
    out = B.decode(B.encode(frame(spark, odd_docs), PATH, keep=("doc_id", "units")), PATH, keep=("doc_id",)).collect()
    assert sorted((r.doc_id or -1, r.decoded) for r in out) == sorted((d or -1, t or "") for d, t in odd_docs)
    frame(spark, []).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert B.op13_byte_pairs(spark, str(tmp_path / "b")).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_table(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in B.op13_byte_pairs(spark, SF).collect()), key=repr) == digests(library, docs)
