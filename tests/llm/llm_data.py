"""Fixtures and generated texts of the tests in this folder."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from settlebook.llm.scratch import Scratch  # noqa: E402


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


WORDS = "the of and to in a is that it for was with on by be at from have this wind river stone light paper green morning".split()


def prose(seed: int, n: int) -> str:
    import random
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(("", "", "", "s", "ing", ",", ".\n" if i % 9 == 0 else "")) for i in range(n)).strip()


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with null and empty texts, copies, near copies, shared
    passages, repeated rows, null ids, a long text, and columns named like the
    operators' own."""
    base = [prose(i, 30 + 17 * i) for i in range(12)]
    passage = prose(99, 70)
    near = base[8].split(" ")
    near[40] = "changed"
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20, base[3]), (21, base[3].replace(" ", "  \t")), (22, " ".join(near)), (23, "head words " + passage + " tail words"),
             (24, prose(50, 40) + " " + passage + " " + prose(51, 40)), (25, passage), (26, None), (27, ""), (28, "  \n "), (29, "one two"),
             (30, "one two"), (31, "ONE two"), (32, prose(77, 9000)), (33, prose(77, 9000) + " end"), (34, "x" * 5000), (5, base[5]), (5, base[5]),
             (None, base[4]), (None, "a text without id that nobody else has at all"), (35, "Straße über naïve café 漢字 😀 don't 12,5 3.14\n\n  x"),
             (36, "of " * 300), (37, "\0 \x1c \x85 odd\r\nspaces   here ")]
    return spark.createDataFrame(
        [(d, t, "en", "src", len(t or ""), 1, 2, "rid") for d, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, kept int, name int, rid string")


@pytest.fixture(scope="session")
def nothing(corpus):
    return corpus.where("false")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
