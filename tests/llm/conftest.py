import pytest
from pyspark.sql import SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WIDE = DOCS + ", size int, key string, n_tokens int, score string, component string, at int, _row int"


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def docs_of(spark: SparkSession, rows, wide: bool = False):
    """Rows of (doc_id, text[, lang[, source]]); ``wide`` adds columns whose names operators may use themselves."""
    full = []
    for r in rows:
        r = (*r, *[None] * (4 - len(r)))
        full.append((*r, None if r[1] is None else len(r[1])))
    if wide:
        return spark.createDataFrame([(*r, 1, "k", 2, "s", "c", 3, 4) for r in full], WIDE)
    return spark.createDataFrame(full, DOCS)
