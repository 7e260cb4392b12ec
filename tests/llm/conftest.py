import re
import zlib

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, set_id string, token long, run int, row string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, and columns named like inner ones."""
    base = " ".join(f"Word{i} of the text." for i in range(60))
    rows = [
        (1, base, "en", "a"), (2, base, "en", "b"), (2, base, "en", "b"), (3, base.replace("Word7 ", "Other "), "en", "a"),
        (4, None, None, None), (5, "", "en", "a"), (None, "no id here at all", "en", None), (None, None, None, None), (6, "one", "de", "c"),
        (7, " \t\n ", "en", "a"), (8, "\x00 nul\x00 é 日本  x\n\nend ", None, "a"), (9, " ".join(f"w{i % 977}x{i}" for i in range(60000)), "en", "b"),
        (10, "ONE", "de", "c"), (11, "one two three four", "en", "c"), (11, "other text with this id", "en", "c"), (12, "x" * 100000, "en", "a"),
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "s", 1, 2, "r") for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def crc_mod(doc_id, mod):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod
