import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def folder():
    return SF


@pytest.fixture(scope="session")
def documents(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


@pytest.fixture(scope="session")
def table(spark):
    """Small (doc_id, text) tables, with columns whose names operators might use themselves."""

    def make(rows):
        schema = "doc_id long, text string, pos string, fp string, key string, hash string, score string"
        full = [(doc_id, text, "x", None, "k", "h", "s") for doc_id, text in rows]
        return spark.createDataFrame(full, schema)

    return make
