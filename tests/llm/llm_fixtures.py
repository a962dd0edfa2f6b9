from __future__ import annotations

import random

import pytest

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


def noise(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def texts() -> list[str | None]:
    """Nulls, empty and blank texts, a very long one, copies, near copies, shared passages, repeated lines."""
    rng = random.Random(5)
    passage = noise(rng, 120)
    base = noise(rng, 300).split()
    found: list[str | None] = [None, "", "   \n\t ", "one", "one two", "\n\n", LONG, "é Ünï ñandú İ K", "x" * 5000]
    for k in range(60):
        near = list(base)
        for _ in range(k % 4):
            near[rng.randrange(len(near))] = f"edit{k}"
        found.append(" ".join(near))
    for k in range(25):
        body = [noise(rng, rng.randrange(5, 40)) for _ in range(rng.randrange(1, 6))]
        if k % 3 == 0:
            body.insert(1, passage)
        if k % 4 == 0:
            body += ["  Shared LINE number one ", body[0], "short"]
        found.append("\n".join(body))
    found += [found[10], found[70], found[70], LONG]
    return found


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Documents with columns whose names operators use inside, spread over several partitions."""
    rows = [
        (k, t, ("en", "de", None)[k % 3], ("b", "a", None, "B")[k % 4], None if t is None else len(t), "r", k, "i")
        for k, t in enumerate(texts)
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, row string, tag long, id string"
    ).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
