import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from texts; a text may come as (id, text)."""

    def make(texts, extra=False):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS)
        if extra:
            # Names that an operator might use for itself.
            frame = frame.withColumns({c: F.lit(7) for c in ("h", "n", "id", "cls", "key", "score", "removed", "chunks", "spans", "part")})
        return frame

    return make


LONG = "word " * 30_000
ODD = [None, "", "", " ", "\n\n", "é" * 500, "a\u0000b " * 200, LONG, LONG, (None, "no id"), (None, None), (3, "again"), (3, "again")]


@pytest.fixture
def odd():
    """Nulls, empty and very long texts, repeated rows and ids."""
    return ODD
