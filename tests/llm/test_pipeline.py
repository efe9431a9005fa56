"""The pipeline: its stages one after the other, and its rows against the operators applied by hand."""

import zlib

import numpy as np
from helpers import empty_documents

import corpus_pipeline
from eventloom.llm import contamination, fertility, mixing, orderhash
from eventloom.llm.tokens import PieceEncoder, public_path

SMALL = "/root/testdata/sf0.001"


def test_rows_of_the_pipeline(spark):
    """Each stage's own decisions, joined in plain Python, give the rows of the last one."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in fertility.judge_quality(docs).collect() if r.kept}
    now = docs.where(docs.doc_id.isin(*kept))
    first = {r.doc_id for r in orderhash.near_duplicates(now).collect() if r.is_first}
    now = now.where(now.doc_id.isin(*first))
    found = contamination.find_contamination(now, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()
    clean = {}
    for r in found:
        if r.n_hit == 0 or r.n_hit < 0.5 * r.n_words:
            raw = texts[r.doc_id].encode()
            for a, b in reversed(r.spans):
                raw = raw[:a] + raw[b:]
            clean[r.doc_id] = raw.decode()
    left = spark.createDataFrame(
        [(r.doc_id, clean[r.doc_id], r.lang, r.source) for r in now.collect() if r.doc_id in clean],
        "doc_id long, text string, lang string, source string",
    )
    chosen = sorted(r.doc_id for r in mixing.mix_decisions(left).collect() if r.sampled)
    library, want, start = PieceEncoder(public_path("byte_bpe_50k.json")).library, [], 0
    for doc in chosen:
        ids = np.array([*library.encode(clean[doc], add_special_tokens=False).ids, 0], dtype="<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == want and got


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 == len(set(names))
    docs = empty_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == 0
