import random

import pytest
from llm_tables import make_docs

@pytest.fixture(scope="session")
def corpus():
    """Texts with nulls, empties, copies, near copies, a hot source, odd spaces and a very long text."""
    rng = random.Random(7)
    stems = ["the", "And", "ÉTÉ", "niño", "a|b", "***", "x1", "river", "stone", "grüße", "don't", "tick"]
    line = lambda n: " ".join(rng.choice(stems) + str(rng.randrange(40)) for _ in range(n))
    texts = [None, "", " \t ", "one", "One two", "\n\n", "shared line\nshared LINE \n" + line(30)]
    base = line(200)
    texts += [base, base, base + " extra", base.replace("the", "The"), line(6000)]
    for i in range(60):
        parts = [line(rng.randrange(1, 30)) for _ in range(rng.randrange(1, 6))]
        if i % 3 == 0:
            parts.insert(0, "Shared line ")
        if i % 7 == 0:
            parts += [parts[0]] * 3
        texts.append("\n".join(parts))
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", "c", None])) for i, t in enumerate(texts)]
    return [*rows, rows[12], rows[12], (None, "no key " + line(25), "en", "a"), (None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return make_docs(spark, corpus)


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])
