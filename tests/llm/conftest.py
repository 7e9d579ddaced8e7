from __future__ import annotations

import random

import pytest


def invented(seed: int = 7) -> list[tuple[int, str | None]]:
    """Documents with copies, near copies, shared passages, repeated lines, nulls, blanks, odd characters and a long text."""
    r = random.Random(seed)
    words = ["the", "and", "Ofer", "thand", "über", "maïs", "ça", "x1", "end.", "stop,", "Ça!", "re-do", "日本"] + [f"w{i}" for i in range(60)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage = prose(50)
    texts: list[str | None] = [None, "", "   ", "\n\n", "one", "two words", "one", "-- 12 --", prose(3), "a\tb\x0bc  d", "İstanbul   wide", "e" * 3000]
    for _ in range(12):
        base = prose(r.choice([8, 40, 120, 300]))
        texts.append(base)
        for _ in range(r.choice([0, 1, 3])):
            w = base.split(" ")
            for _ in range(r.choice([0, 1, 2])):
                w[r.randrange(len(w))] = r.choice(words)
            texts.append(" ".join(w))
    for _ in range(6):
        texts.append(prose(r.choice([5, 60])) + " " + passage + " " + prose(r.choice([5, 60])))
    lines = [prose(6) for _ in range(8)]
    for _ in range(6):
        texts.append("\n".join(r.choice(lines) for _ in range(r.choice([1, 2, 3, 9]))))
        texts.append("\n".join(lines[2:6] + [prose(4)]))
    texts.append("\n".join([prose(400), *lines, prose(2000)]))
    texts.append(" ".join(["so", "on"] * 60))
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def rows():
    return invented()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows over several partitions, with further columns whose names operators also use."""
    d = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "c", 1, "k") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, key string, n int, ids string")
    return d.repartition(3).persist()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def odd(spark):
    """Repeated rows, a repeated id with two texts, and null ids."""
    return spark.createDataFrame([(5, "same old text"), (5, "same old text"), (5, "another text"), (None, "nobody's text"), (None, None), (7, None)], "doc_id long, text string")
