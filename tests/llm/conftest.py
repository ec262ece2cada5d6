import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kind string, row string"


def prose(rng, n, words=400):
    return " ".join(rng.choice(WORDS[:words]) for _ in range(n))


_r = random.Random(5)
WORDS = ["".join(_r.choice("aeioubcdfglmnrst") for _ in range(_r.randint(2, 8))) for _ in range(3000)]


def corpus():
    """Rows with copies, near copies, shared lines, nulls in every column, empty and long texts, repeated rows."""
    rng = random.Random(11)
    rows = []

    def add(doc_id, text, source="s0", lang="en"):
        rows.append((doc_id, text, lang, source, None if text is None else len(text), "x", "y"))

    base = [prose(rng, rng.randint(60, 200), 3000) for _ in range(30)]
    for i, t in enumerate(base):
        add(i, t, f"s{i % 3}")
    for i in range(30, 45):  # exact copies
        add(i, base[i % 4], "s0")
    for i in range(45, 60):  # near copies: one word changed
        w = base[5].split()
        w[rng.randrange(len(w))] = f"changed{i}"
        add(i, " ".join(w), "s1")
    shared = prose(rng, 30, 3000)
    for i in range(60, 100):  # a line that many documents share, among others
        add(i, prose(rng, 70, 3000) + "\n" + shared + "\n" + prose(rng, 20, 3000), "s0")
    for i in range(100, 112):  # light sets: few words, one off
        w = [f"w{j}" for j in range(12)]
        add(i, " ".join(w[: 12 - i % 2] + ([f"end{i}"] if i % 3 == 0 else [])), "s2")
    add(112, "", "s0")
    add(113, None, "s0")
    add(114, "  \n\t \n", None)
    add(115, prose(rng, 20000, 3000), None, None)
    add(116, "one two", "s0")
    add(117, "One TWO", "s0")
    add(118, "éà \U0001F600 café naïve   x y " * 20, "s1")
    add(119, "aaaa " * 100 + "=" * 300 + " " * 50 + "b" * 500, "s1")
    add(120, base[0], "s0")
    add(120, base[0], "s0")  # a repeated row
    add(121, base[3] + " https://example.com/docs/user-guide/index-of+all_pages " + "/-" * 30, "s0")  # runs of no one alphabet
    add(122, "/docs/user-guide/install-notes " + prose(rng, 60, 3000), "s2")
    add(None, base[1], "s0")
    add(None, None, None, None)
    add(-7, base[2] + " tail", "s2")
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
