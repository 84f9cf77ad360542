from __future__ import annotations

import pytest


@pytest.fixture()
def documents(spark):
    """Rows of (doc_id, text[, lang, source]) as a frame with extra columns whose
    names clash with those the operators use inside."""

    def make(rows, partitions=3):
        full = [(r + (None, None, None, None))[:4] for r in rows]
        schema = "doc_id long, text string, lang string, source string"
        df = spark.createDataFrame(full, schema).repartition(partitions)
        for c in ("id", "row", "node", "seed", "lines", "host", "uid", "a.b"):
            df = df.withColumn(c, df["doc_id"].cast("string"))
        return df

    return make
