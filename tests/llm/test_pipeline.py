"""Each stage of the pipeline against the operators' plain forms, on its own input."""

from __future__ import annotations

import time
from collections import Counter

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from tests.llm.test_decontam import brute as brute_decontam
from tests.llm.test_pii import brute_spans
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_toxicity import dense, fitted
from tidemark.llm import piece, pii, toxicity
from tidemark.llm.common import table


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash", "decontamination", "pii", "sentencepiece"]

    kept = stages["toxicity"](spark, docs, sf).cache()
    scorer = toxicity.Scorer(toxicity.fit(docs, table(spark, sf, "labels")))
    assert {r.doc_id for r in kept.collect()} == {k for k, r in rows.items() if scorer.score((r.text or "").encode()) < 0.5}

    single = stages["simhash"](spark, kept, sf).cache()
    ids = sorted(r.doc_id for r in kept.collect())
    least = brute_components(ids, [brute_fingerprint(rows[k].text) for k in ids])
    assert Counter(r.doc_id for r in single.collect()) == Counter(set(least))

    clean = stages["decontamination"](spark, single, sf).cache()
    ids = [r.doc_id for r in single.collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    judged = brute_decontam([(k, rows[k].text) for k in ids], items)
    texts = {r.doc_id: r for r in clean.collect()}
    assert set(texts) == {j[0] for j in judged if not j[-1]}
    hit = {j[0] for j in judged if j[2]}
    for k, r in texts.items():
        assert k in hit or r == rows[k]
        assert len(r.text or "") == r.n_chars or k not in hit
    assert not any(j[2] for j in brute_decontam([(k, r.text) for k, r in texts.items()], items))

    private = stages["pii"](spark, clean, sf).cache()
    assert private.columns == docs.columns
    for r in private.collect():
        found = pii.replace(texts[r.doc_id].text, pii.Pseudonyms(pii.LOCAL_KEY))
        assert r.text == found[0] and {tuple(f) for f in found[1]} == brute_spans(texts[r.doc_id].text) and (r.lang, r.source) == (rows[r.doc_id].lang, rows[r.doc_id].source)

    coded = stages["sentencepiece"](spark, private, sf)
    library = sentencepiece.SentencePieceProcessor(model_file=piece.model_path(piece.MODEL))
    assert {r.doc_id: r.ids for r in coded.collect()} == {r.doc_id: library.encode(r.text) for r in private.collect()}


def test_run_by_brute_force(spark, sf):
    """All five stages without Spark: dense toxicity, all pairs of fingerprints, plain search, the library's ids."""
    rows, pairs, times, texts = fitted(spark, sf)
    weights, bias = dense(rows, pairs, sum(y for _, y in rows) / len(rows), times)

    def chance(text):
        return 1 / (1 + np.exp(-bias - sum(weights.get(b, 0) for b in toxicity.features_of(set(toxicity._WORD.findall(text.lower()))))))

    scores = {k: chance(t) for k, t in texts.items()}
    assert not any(abs(s - 0.5) < 2e-3 for s in scores.values())
    kept = sorted(k for k, s in scores.items() if s < 0.5)
    kept = sorted(set(brute_components(kept, [brute_fingerprint(texts[k]) for k in kept])))
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    judged = {j[0]: j for j in brute_decontam([(k, texts[k]) for k in kept], items)}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(out) == {k for k, j in judged.items() if not j[-1]} and 100 < len(out) < len(texts)
    library = sentencepiece.SentencePieceProcessor(model_file=piece.model_path(piece.MODEL))
    plain = 0
    for k, r in out.items():
        if not judged[k][2]:
            ids = library.encode(pii.replace(texts[k], pii.Pseudonyms(pii.LOCAL_KEY))[0])
            assert r.ids == ids and r.n_tokens == len(ids) == len(r.starts) - 1
            plain += not brute_spans(texts[k])
    assert plain > 50


def test_run(spark, sf, tmp_path):
    """A run takes nothing over unless it is named, and a named one goes on where it stopped."""
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids", "starts"] and out.count() > 100
    assert corpus_pipeline.ORACLE_SQL is None
    calls, original = [], list(corpus_pipeline.STAGES)

    def counted(k, fail):
        def stage(spark, docs, sf_dir):
            calls.append(k)
            if k == fail[0]:
                raise RuntimeError("executors gone")
            return original[k][1](spark, docs, sf_dir)

        return stage

    fail = [2]
    spark.conf.set(corpus_pipeline.RUN_SETTING, f"test-{tmp_path.name}-{time.time_ns()}")
    corpus_pipeline.STAGES[:] = [(name, counted(k, fail)) for k, (name, _) in enumerate(original)]
    try:
        with pytest.raises(RuntimeError):
            corpus_pipeline.run(spark, sf)
        fail[0] = -1
        again = corpus_pipeline.run(spark, sf)
        assert calls == [0, 1, 2, 2, 3, 4] and again.count() == out.count()
    finally:
        corpus_pipeline.STAGES[:] = original
        spark.conf.unset(corpus_pipeline.RUN_SETTING)


def test_a_name_with_another_input(spark, sf, tmp_path):
    """One name over two inputs, or over one that has changed meanwhile, answers for the input given."""
    import shutil

    small = tmp_path / "small"
    small.mkdir()
    for name in ("labels", "benchmark"):
        shutil.copy(f"{sf}/{name}.parquet", small)
    spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60").write.parquet(f"{small}/documents.parquet")
    spark.conf.set(corpus_pipeline.RUN_SETTING, f"two-{tmp_path.name}-{time.time_ns()}")
    try:
        all_of_it = corpus_pipeline.run(spark, sf).count()
        assert 0 < corpus_pipeline.run(spark, str(small)).count() <= 60 < all_of_it == corpus_pipeline.run(spark, sf).count()
        before = corpus_pipeline.fingerprint(spark, str(small))
        spark.read.parquet(f"{sf}/documents.parquet").where("doc_id >= 60").write.mode("append").parquet(f"{small}/documents.parquet")
        assert corpus_pipeline.fingerprint(spark, str(small)) != before and corpus_pipeline.run(spark, str(small)).count() == all_of_it
    finally:
        spark.conf.unset(corpus_pipeline.RUN_SETTING)
