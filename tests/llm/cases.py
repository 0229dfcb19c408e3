"""Fixtures and folders shared by these tests (imported by name; not a conftest, so that it shadows none)."""
import pytest
from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """documents from (doc_id, text, lang, source) rows, cut to what is given."""
    full = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], SCHEMA)


@pytest.fixture
def odd_documents(spark):
    """Nulls in every column, empty and wordless texts, ties, repeated rows, clashing extra columns."""
    words = "the quick brown fox jumps over the lazy dog and runs away from it all day long."
    rows = [(1, words, "en", "a"), (1, words, "en", "a"), (2, words, None, None), (3, None, "en", "a"), (4, "", "en", "a"),
            (5, " \n\t ", "en", "a"), (None, words, "en", "a"), (6, "12345 !!", "de", "b"), (7, words + " " + "x" * 5000, "en", "b"),
            (8, "Größe und Länge der alten Straße im Wald.", "de", "b"), (1, "another text with the same id", "en", "a")]
    df = documents(spark, rows)
    for c in ("_row", "fp", "k1", "first", "size", "spans", "position", "mix_position", "lang_pred", "kept_text", "bytes"):
        df = df.withColumn(c, F.lit(c))
    return df


@pytest.fixture
def table_dir(spark, tmp_path):
    """Write tables as <dir>/<name>.parquet and return the folder."""
    def put(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return put
