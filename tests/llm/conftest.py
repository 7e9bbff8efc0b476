from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, row string, score string, line string, fp string, key string, doc string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text) rows with extra columns whose names operators use inside."""
    def make(rows):
        return spark.createDataFrame([(i, t, "a", "b", None, "c", "d", "e", len(t) if t else 0) for i, t in rows], SCHEMA)
    return make


@pytest.fixture
def small_batches(spark):
    """Arrow batches of three rows, so that groups are cut by batch ends."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, "3")
    yield
    spark.conf.set(name, old)


BASE = ("the quick brown fox jumps over the lazy dog while seven wizards mix a potent brew of herbs and honey "
        "under a pale moon that shines upon the quiet village near the river bank")
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
#: Empty, null, blank, equal and nearly equal texts, repeated rows, a null id, odd characters, a very long text.
ODD = [(5, BASE), (3, BASE), (9, BASE + " again"), (7, BASE.replace("lazy", "sleepy")), (2, ""), (4, None), (6, " \t\n "),
       (8, "a"), (10, "a b"), (11, "é ß ▁   𝄞\x00x"), (12, LONG), (13, LONG + " end"), (14, "ab" * 900),
       (15, f"{BASE}\n\n{BASE}\nshort\nshort\n!!!\n!!!"), (15, f"{BASE}\n\n{BASE}\nshort\nshort\n!!!\n!!!"),
       (16, "x" * 99), (17, "x" * 100), (18, "x" * 101), (None, BASE + " of nobody"), (20, "tab\tand  two   spaces\r\nend "),
       (21, "<|endoftext|> is <|endoftext|> no end")]


@pytest.fixture(scope="session")
def odd_rows():
    return ODD


@pytest.fixture(scope="session")
def sf(spark):
    return {k: f"/root/testdata/sf{k}" for k in ("0.001", "0.01", "0.1")}
