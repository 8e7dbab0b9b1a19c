import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id long, size long"


def made(n: int = 120, seed: int = 1) -> list[tuple]:
    """Documents with copies, near copies, a passage that many share, ties, empty and null texts, and a very long one."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("an", "er", "th", "in", "on", "ré") for b in ("a", "est", "ing", "or", "ü", "X")]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows = []
    for i in range(n):
        kind = i % 10
        if kind == 0 and rows:
            text = rng.choice(rows)[1]
        elif kind == 1 and rows:
            w = (rng.choice(rows)[1] or "x").split(" ")
            w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        else:
            text = " ".join(rng.choice(words) for _ in range(rng.choice((1, 3, 15, 19, 20, 21, 80, 200))))
            if kind < 5:
                cut = rng.randrange(len(text))
                text = text[:cut] + "\n" + passage + "\t" + text[cut:]
        rows.append((i, text, "en", rng.choice(("src0", "src0", "src1", "ä", "Z", None)), len(text), 5, 6))
    rows += [(n, "", "en", "src1", 0, 1, 1), (n + 1, None, None, None, None, None, None), (n + 2, " \t\n", "en", "src2", 3, 1, 1)]
    rows += [(n + 3, " ".join(rng.choice(words) for _ in range(20_000)), "en", "src0", 1, 1, 1), (n + 4, "x" * 50_000, "en", "src0", 1, 1, 1)]
    rows += [(n + 5, "same same same " * 50, "en", "src1", 1, 1, 1), (n + 5, "same same same " * 50, "en", "src1", 1, 1, 1), (n + 6, "日本語😀" * 40, "ja", "日", 160, 1, 1)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return made()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
