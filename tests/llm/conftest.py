import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))


@pytest.fixture
def odd(spark):
    """Nulls everywhere, empty, blank and very long texts, repeated rows and ids, and columns whose names clash."""
    rows = [
        (1, "Plain words stand here and go on for a while longer.", "en", "b", 9),
        (2, "plain WORDS stand here and go on for a while longer.", "en", "a", None),
        (2, "plain WORDS stand here and go on for a while longer.", "en", "a", None),
        (2, "the same id with another text", None, None, 1),
        (None, "plain words stand here and go on for a while longer.", "en", None, 1),
        (None, None, None, None, None),
        (4, None, "en", "a", 0),
        (5, "", "en", "a", 0),
        (6, " \t\n ", "en", "b", 0),
        (7, "one", "en", "b", 0),
        (8, LONG, "en", "b", len(LONG)),
        (9, LONG + " and more", "en", "c", len(LONG)),
        (10, "ünïcödé 😀 wörds 😀 und Zeichen", "de", "ü", 3),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    clashes = "id key n size score target node row_key text_sha256 kept word hash w h spans frame label page_id bucket "
    clashes = (clashes + "_key _sha _leak_key quality_score copies taken").split()
    return frame.withColumns({c: F.lit(c) for c in clashes})


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)
