import pytest

from tidegauge.llm.common import for_workers

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, class string, score double"


@pytest.fixture(scope="session")
def workers(spark):
    return for_workers(spark)


@pytest.fixture(scope="session")
def docs(workers):
    return workers.read.parquet(f"{FOLDER}/documents.parquet")


LONG = " ".join(f"wort{i % 977} und{i % 13}" for i in range(60_000))
ODD = [
    (1, None, "en", "a", 0),
    (2, "", None, None, None),
    (3, " \n\t ", "en", "a", 3),
    (4, "one two three", "en", None, 13),
    (5, "one two three", "en", None, 13),
    (5, "one two three", "en", None, 13),
    (6, LONG, "de", "b", len(LONG)),
    (7, "x", "fr", "c", 1),
    (8, "12345 !!! \x1c\x85　 \U0001f642", None, "c", 10),
    (None, "A text without an id. It stays.\nSecond line.", "en", "a", 40),
    (None, "A text without an id. It stays.\nSecond line.", "en", "a", 40),
    (9, "y" * 50_000, "en", "b", 50_000),
    (10, "Released under the MIT License. SPDX-License-Identifier: (MIT OR GPL-2.0+) AND Apache-2.0", "en", "a", 80),
    (11, "<|endoftext|>İstanbul ΑΣ <|startoftext|>don't", "en", "a", 30),
    (12, "Élan vital, déjà vu. Où est le café?", "fr", "c", 30),
]


@pytest.fixture(scope="session")
def odd(workers):
    """Nulls in any column, empty, blank and long texts, ties, repeated rows, clashing names."""
    rows = [(*r, 7, "clash", "clash", -1.0) for r in ODD]
    return workers.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(workers):
    return workers.createDataFrame([], SCHEMA)
