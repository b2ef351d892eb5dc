import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, batch string, h long"


def frame(spark, rows):
    """Documents with more columns than the operators know, some of names that they use."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "k", "b", 1) for i, t in rows], SCHEMA)


def corpus(seed=3, docs=60):
    """Texts with shared passages, doubled words, copies, nulls, empties, ties and one long text."""
    r = random.Random(seed)
    vocabulary = [a + b for a in ("ka", "Lo", "mi", "né", "x1", "zu") for b in ("ra", "to", "%", "ß", "")]
    passages = [" ".join(r.choice(vocabulary) for _ in range(40)) for _ in range(4)]
    out = []
    for i in range(docs):
        parts = []
        for _ in range(r.randint(0, 5)):
            parts.append(r.choice(passages)[r.randint(0, 20) :] if r.random() < 0.4 else " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 60))))
        out.append((i, "\n".join(parts)))
    out += [(100, None), (101, ""), (102, " \n "), (103, "ab"), (104, "la " * 60), (105, "la " * 50 + "end"), (106, out[5][1]), (107, out[5][1]), (5, out[5][1]), (108, "\n".join(passages) * 30)]
    r.shuffle(out)
    return out


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])
