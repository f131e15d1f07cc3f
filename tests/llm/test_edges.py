"""Every query over tables with nulls, repeats, long and empty texts and clashing columns, and over empty ones."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import queries

ROWS = {
    "documents": ("doc_id bigint, text string, lang string, source string, n_chars bigint", [(None, "a b c d e", "en", "x", 5), (5, None, None, None, None), (6, "", None, None, 0), (7, "long " * 60_000, "en", "src0", 300_000), (7, "long " * 60_000, "en", "src0", 300_000), (-1, "\n\t ", "fr", "", 3)]),
    "benchmark": ("item_id bigint, text string", [(None, "x y"), (3, None), (3, "")]),
    "labels": ("doc_id bigint, quality int, toxic int", [(None, 1, 1), (5, None, None), (7, 1, 1), (7, 1, 0)]),
    "pages": ("page_id bigint, url string, html string", [(None, None, None), (1, "", "x")]),
    "embeddings": ("vec_id bigint, embedding array<float>, label int", [(None, [0.5] * 64, 1), (1, None, None), (2, [], 1), (3, [None] * 64, 1), (4, [float("nan")] * 64, 1), (0, [0.5] * 64, 2), (0, [0.5] * 64, 2), (5, [1.0], 1)]),
    "conversations": ("conv_id bigint, turn bigint, role string, text string", [(None, None, None, None), (1, None, "tool", "x")]),
}
CLASHES = ("score", "fingerprint", "n_words", "held_out", "__hash", "slot", "ids", "host", "suffix", "turns", "formatted", "n_hit", "found", "predicted", "x", "text_", "n", "cluster", "weight")


@pytest.fixture(scope="module")
def places(spark, sf, tmp_path_factory):
    odd, empty = (str(tmp_path_factory.mktemp(n)) for n in ("odd", "empty"))
    for name, (schema, rows) in ROWS.items():
        table = spark.read.parquet(f"{sf}/{name}.parquet").unionByName(spark.createDataFrame(rows, schema))
        table = table.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)])
        table.write.parquet(f"{odd}/{name}.parquet")
        table.limit(0).write.parquet(f"{empty}/{name}.parquet")
    return odd, empty


@pytest.mark.parametrize("name", [*queries.QUERIES, "pipeline"])
def test_odd_and_empty_tables(spark, sf, places, name):
    query = corpus_pipeline.run if name == "pipeline" else queries.QUERIES[name]
    odd, empty = places
    got = query(spark, odd)
    rows = got.count()
    source = {"op2_url_filter": "pages", "url_rules": "pages"}.get(name, "documents")
    if name in ("op12_whitening", "op13_centroids"):
        assert rows == (spark.read.parquet(f"{sf}/embeddings.parquet").count() + 3) * (16 if name == "op12_whitening" else 1)
    elif name == "op4_chat_format":
        assert rows == spark.read.parquet(f"{odd}/conversations.parquet").select("conv_id").distinct().count() + 1
    elif name == "pipeline":
        assert 0 < rows < spark.read.parquet(f"{odd}/documents.parquet").count()
    else:
        assert rows == spark.read.parquet(f"{odd}/{source}.parquet").count()
    none = query(spark, empty)
    assert none.count() == (1 if name == "op4_chat_format" else 0) and none.dtypes == got.dtypes
