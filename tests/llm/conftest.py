from __future__ import annotations

import datetime as dt
import os
from pathlib import Path

import pytest

DATA = Path(os.environ.get("TEST_DATA", "/root/testdata"))
TABLES = ("documents", "doc_meta", "excerpts", "graded_rows", "pairs", "conversations_nested", "keep_targets", "mix_targets", "subject_examples", "lexicon")
AT = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def empty_tables(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("empty")
    for t in TABLES:
        spark.createDataFrame([], spark.read.parquet(f"{DATA}/sf0.001/{t}.parquet").schema).write.parquet(f"{base}/{t}.parquet")
    return str(base)


@pytest.fixture(scope="session")
def odd_tables(spark, tmp_path_factory):
    """The smallest test tables with rows of nulls, empty, blank and very long texts, repeated rows, and columns of other names."""
    from pyspark.sql import functions as F

    base = tmp_path_factory.mktemp("odd")
    long_ = "The captain had been asked to govern the harbour, and the news of it spread quickly. " * 3000
    texts = [None, "", " \n\t ", "​", "x", "." * 5000, long_, "cafÃ© " * 4000, "a" * 100_000, "😀", "<|endoftext|>"]
    for t in TABLES:
        df = spark.read.parquet(f"{DATA}/sf0.001/{t}.parquet")
        key = {"documents": "doc_id", "excerpts": "doc_index", "pairs": "i", "conversations_nested": "i", "graded_rows": "row_id"}.get(t)
        text = {"documents": "text", "excerpts": "excerpt", "pairs": "a"}.get(t)
        if text:
            more = [tuple((900_000 + k if c.name in ("doc_id", "i") else f"odd-{k}" if c.name == key else "odd" if c.name == "dataset" else x if c.name == text else None) for c in df.schema) for k, x in enumerate(texts)]
            df = df.unionByName(spark.createDataFrame(more + more[:2], df.schema))
        elif key:
            nulls = [tuple((900_000 if c.name == key else "odd" if c.name == "dataset" else None) for c in df.schema)]
            df = df.unionByName(spark.createDataFrame(nulls * 2, df.schema))
        df.withColumns({"rec_id": F.lit("clash"), "src": F.lit("clash"), "_text": F.lit("clash"), "n": F.lit(1)}).write.parquet(f"{base}/{t}.parquet")
    return str(base)
