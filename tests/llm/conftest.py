import random
import re

import pytest

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "h long, n long, cnt long, rep long, spans string, block string, score double, k int")


def sentence(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


def edit(text, seed, every):
    r = random.Random(seed)
    return " ".join("changed" + str(r.randint(0, 999)) if r.random() < 1 / every else w for w in text.split(" "))


def edge_texts():
    """(doc_id, text): nulls, empty and blank texts, one long text, exact and near copies,
    repeated rows, a shared passage, periodic text, upper case and non-ASCII text."""
    base, shared = sentence(1, 90), sentence(2, 120)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\r "), (4, "one"), (5, "One\ttwo  three"), (6, "one two three"), (7, base), (8, base.upper()),
            (9, base), (10, edit(base, 3, 60)), (11, edit(base, 4, 60)), (12, sentence(5, 80) + " " + shared), (13, shared + " " + sentence(6, 70)),
            (14, "ab" * 700), (15, "word " * 300), (16, "Größe çà naïve 東京 " * 40), (17, sentence(7, 30_000)),
            (18, sentence(8, 200)), (18, sentence(8, 200)), (None, base), (None, None), (19, "x" * 5000), (20, "<|endoftext|> it's 5pm!!!  Σας")]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, t, "en" if k % 3 else None, f"s{k % 3}" if k % 4 else None, None, k, None, 1, 2, "a", "b", 0.5, 1) for k, (i, t) in enumerate(edge_texts())]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
