import random

import numpy as np
import pytest
from brute import frame

from marketlens.llm import token_counts as T

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("chunk", [1, 7, 512])
def test_counts_equal_the_library(library, chunk):
    rnd = random.Random(1)
    chars = "  ab theé▁\n\t中文😀1234<s></s>▁▁xyzüß\x00#*,."
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 80))) for _ in range(800)]
    texts += [" " * i for i in range(40)] + ["a" * i for i in range(60)] + ["aba" * 100, "the" * 300, "x " * 500]
    ends = np.cumsum([len(x) for x in texts])
    got = T.count_tokens(T.transducer(MODEL), "".join(texts), np.concatenate([[0], ends[:-1]]), ends, chunk)
    assert got.tolist() == [len(x) for x in library.encode(texts)]


def test_documents(spark, library, odd_docs):
    out = T.token_counts(frame(spark, odd_docs), MODEL).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in out), key=repr)
    want = [(d, len((t or "").encode()), len(library.encode(t or ""))) for d, t in odd_docs]
    assert got == sorted(((*w, w[2] > 4096) for w in want), key=repr)
    assert T.token_counts(frame(spark, []), MODEL).collect() == []


def test_states_start_anew(library, monkeypatch):
    monkeypatch.setattr(T, "MAX_STATES", 5)
    t = T.transducer(MODEL)
    for text in ("some words", "other words entirely"):
        assert T.count_tokens(t, text, np.array([0]), np.array([len(text)]))[0] == len(library.encode(text))
