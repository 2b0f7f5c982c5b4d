import pytest


@pytest.fixture(scope="session")
def checkpoint_folder(spark, tmp_path_factory):
    """Every test session keeps its intermediate tables in a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"file://{tmp_path_factory.mktemp('shared')}"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


@pytest.fixture
def documents(spark, checkpoint_folder):
    """Build a documents table from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def build(rows, extra=""):
        full = [(*r, *("en", "s")[len(r) - 2 :])[:4] if len(r) < 4 else r for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        return df.selectExpr("*", *([extra] if extra else []))

    return build
