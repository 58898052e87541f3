import re

import corpus_pipeline
from reachgrid.llm import pii

from .test_simhash import brute_groups
from .test_texts import brute_measures, brute_spans

FOLDER = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, steps[-1], FOLDER)
        out.write.parquet(f"{tmp_path}/{name}")
        steps.append(spark.read.parquet(f"{tmp_path}/{name}"))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert steps[-1].dtypes == docs.dtypes
    raw, good, single, masked, packed = (s.collect() for s in steps)
    kept = set()
    for r in raw:
        n_words, _, _, _, repeated = brute_measures(r.text)
        if n_words >= 20 and 100 * repeated <= 30 * n_words:
            kept.add(r.doc_id)
    # the table is too small for lines above the limits
    assert {r.doc_id for r in good} == kept
    groups = brute_groups([(r.doc_id, r.text) for r in good], 4, 4)
    assert {r.doc_id for r in single} == {c for _, _, c in groups}
    texts = {r.doc_id: r.text for r in single}
    for r in masked:
        found = brute_spans(texts[r.doc_id])
        assert len(re.findall(r"\[(?:EMAIL|IP|CARD|PHONE)\]", r.text)) >= bool(found)
        assert r.n_chars == len(r.text)
        if not found and "[" not in r.text:
            assert r.text == texts[r.doc_id]
    assert {r.doc_id for r in packed} == {r.doc_id for r in masked}
    total = sum({r.doc_id: r.doc_tokens for r in packed}.values())
    assert sum(r.length for r in packed) == total
    assert set(pii.KINDS) == {"email", "ip", "card", "phone"}


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
