from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tidemark-wh-"))
        .getOrCreate()
    )


#: Nulls in every column, empty and white-space texts, ties, repeats, and clashing extra columns.
ROWS = [
    (1, "The cat sat on the mat. The cat sat on the mat again.", "en", "a"),
    (2, "The cat sat on the mat. The cat sat on the mat again.", "en", "a"),
    (2, "The cat sat on the mat. The cat sat on the mat again.", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (None, "a text without an id", "de", "b"),
    (5, " \t\n\r ", "xx", "b"),
    (6, "you stupid IDI0T, сlown and moron " * 3, "en", "b"),
    (7, "wort " * 20000, "de", "c"),
    (8, "Été où ñandú 中文 😀 <|endoftext|> x", "fr", "c"),
    (9, "one two", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    clashing = ("digest", "fp", "words", "n", "_id", "rank", "row", "score")
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in clashing})


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("doc_id < 0")
