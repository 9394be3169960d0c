import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, component string"
WORDS = ("the quick brown fox jumps over a lazy dog while seven green birds sing about long summer days near rivers "
         "and old stone bridges where children play with wooden boats until evening comes slowly").split()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns that clash with internal names."""
    long = " ".join(WORDS[i % 31] + str(i % 7) for i in range(20000))
    rows = [
        (1, " ".join(WORDS), "en", "a"), (1, " ".join(WORDS), "en", "a"), (2, " ".join(WORDS), "en", "b"), (3, None, "en", "a"),
        (4, "", None, None), (None, "mail me at x.y@mail.example.com or +1 (743) 555-3824", "en", "a"), (5, "12345 --- 678", "en", "b"),
        (6, long, "en", None), (7, " ".join(reversed(WORDS)), "en", "b"), (8, "\n\t ", "en", "a"),
    ]
    return spark.createDataFrame([(i, t, la, s, None, "k", "c") for i, t, la, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
