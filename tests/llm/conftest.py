import pytest

from floe.session import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


#: Nulls in any column, empty and very long texts, equal texts, repeated rows, control characters.
LONG = " ".join(f"w{i % 977}x{i * i % 1013}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
MESSY = [
    (1, "One small text of a few words.", "en", "a", 30),
    (2, None, None, None, None),
    (3, "", "en", None, 0),
    (None, "a text without an id", "en", "b", 20),
    (None, None, None, "b", None),
    (5, LONG, "en", "a", len(LONG)),
    (6, "One small text of a few words.", "de", "b", 30),
    (6, "One small text of a few words.", "de", "b", 30),
    (7, "before " + PASSAGE + " after the end", "en", "a", 0),
    (8, "elsewhere " + PASSAGE + " et cætera ñandú 日本語", "fr", "c", 0),
    (9, " \t\n  \x0b ", "en", "c", 6),
    (10, "Same Words here\nSame Words here\nsame words here \x1c x", "en", "c", 40),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns.
CLASHES = ("mix", "dedup", "quality", "rules", "filter", "ids", "_text", "_at", "fp", "k", "row", "data", "size", "root", "_src")


@pytest.fixture(scope="session")
def messy(spark):
    from pyspark.sql import functions as F
    d = spark.createDataFrame(MESSY, COLUMNS)
    return d.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
