import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, _key string, block int, TEXT_SHA256 string"


@pytest.fixture(scope="session")
def words():
    draw = random.Random(3)
    return ["".join(draw.choice("abcdeiou") for _ in range(draw.randint(1, 7))) for _ in range(400)]


@pytest.fixture(scope="session")
def texts(words):
    """Texts with copies, near copies, shared passages, empty, odd and long ones."""
    draw = random.Random(7)
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    passage, base = prose(60), [draw.choice(words) for _ in range(120)]
    out = [None, "", "  \t\n ", "one", "Two words", "ß É\x1c　x ", "12 !!", prose(3000), "x" * 5000, passage, passage.upper()]
    out += [prose(draw.randint(1, 200)) for _ in range(20)]
    out += [f"{prose(20)} {passage}\n{prose(30)}" for _ in range(4)]
    for _ in range(25):
        near = list(base)
        for _ in range(draw.randint(0, 4)):
            near[draw.randrange(len(near))] = draw.choice(words)
        out.append(" ".join(near))
    out += out[12:16] + ["same text here", "Same text here", "SAME TEXT HERE"] + [f"{passage} {passage}"]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Documents with columns whose names clash with internal ones, a NULL id, repeated rows."""
    rows = [(i, t, "en" if i % 2 else None, None, None, "d", "k", 1, "h") for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (None, "an id is missing here", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
