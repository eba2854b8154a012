import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def _mixed(seed: int, n: int, parts: list[str], longest: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, tied, odd and long texts."""
    marks = list("abz  \n\t's'tdrelvm  10٣²!?é漢  ") + ["<|endoftext|>", "<|end", "😀", "\x00", "\x85", "the", "===="]
    return [
        None, "", " ", "\n", "a", "a", "ab " * 40_000, "x" * 70_000, "é" * 50_000, "don't  we'll \n 's",
        *_mixed(3, 300, marks, 40),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """``odd_texts`` with repeated and null ids, and columns whose names operators use inside."""
    rows = [(i if i % 50 else (None if i else 0), t, "en", None, 1, 2, 3) for i, t in enumerate(odd_texts)]
    schema = "doc_id long, text string, lang string, source string, part int, length int, nth int"
    return spark.createDataFrame([*rows, rows[4], rows[4]], schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
