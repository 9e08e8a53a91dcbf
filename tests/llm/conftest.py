from __future__ import annotations

import random

import pytest

# extra columns whose names the operators use inside
CLASHING = "key string, size string, rank string, part int, n bigint, _range int, ids string, text_hash string"


def words(r: random.Random, n: int, vocabulary: int = 3000) -> list[str]:
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls, empty and very long texts, ties, repeated rows, near copies, odd characters."""
    r = random.Random(11)
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words(r, 20 + 7 * i))))
    base = words(r, 300)
    for i in range(40, 60):  # near copies of one text
        copy = list(base)
        for _ in range(r.randrange(6)):
            copy[r.randrange(len(copy))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(i, rows[5][1]) for i in range(60, 75)]  # copies
    rows += [(75, None), (76, ""), (77, " \n\t "), (78, "One"), (79, "one"), (80, "a b c d"), (81, "A B\tC\nD")]
    rows += [(82, " ".join(words(r, 30_000))), (83, "é" * 900 + " ñ 日本 \U0001f600 x"), (84, "same line here\n" * 40)]
    rows += [(85, rows[3][1]), (85, rows[3][1])]  # a repeated row
    rows += [(86, "#*$%&|<> " * 60)]
    r.shuffle(rows)
    sources = ["b", "a", None, "b", "b", "ü", ""]
    return [
        (d, t, r.choice(["en", "de", None]), sources[(d or 0) % 7], len(t or ""))
        for d, t in rows
    ]


@pytest.fixture(scope="session")
def hard_docs(spark, hard_rows):
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"
    extra = ("k", "s", "r", 1, 2, 3, "i", None)
    return spark.createDataFrame([(*x, *extra) for x in hard_rows], schema).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
