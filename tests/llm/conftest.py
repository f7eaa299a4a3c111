import random

import pytest


@pytest.fixture(scope="session")
def odd_docs():
    """Nulls, empty, blank, short, very long, repeated and tied texts; a row twice; rows without an id."""
    rnd = random.Random(4)
    vocab = ["a", "b", "the", "of", "é", "und", "x1", "ñandú", "<b>", "%"]
    long = " ".join(rnd.choice(vocab) for _ in range(30_000))
    passage = " ".join(f"{rnd.choice(vocab)}{rnd.randrange(50)}" for _ in range(130))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long), (6, long[5000:9000]), (7, passage),
            (8, f"start {passage} end"), (8, f"start {passage} end"), (9, passage.upper()), (None, passage), (None, "lonely"),
            (10, "a " * 500), (11, "a " * 499 + "b"), (12, "e" * 5000), (13, "é" * 700), (14, "é" * 700)]
    rows += [(20 + i, passage.replace(" ", "  ", i)) for i in range(6)]
    return rows
