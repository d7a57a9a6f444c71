import re

import public_tokenizers
import sentencepiece

import corpus_pipeline
from quayside.llm import language_id
from quayside.llm.piece_codec import MODEL
from tests.conftest import SF_SMALL
from tests.llm import test_bm25_decontam, test_jaccard_join
from tests.llm.test_blob_ledger import brute as spans_of


def _mask(text):
    out, at = "", 0
    for span in filter(None, spans_of(text).split(",")):
        _, a, b = span.split(":")
        if int(a) >= at:
            out += text[at:int(a)] + "[redacted]"
        at = max(at, int(b))
    return out + text[at:]


def test_run_equals_brute_force_stage_by_stage(spark):
    path = SF_SMALL.replace("sf0.001", "sf0.01")
    docs = {r.doc_id: r for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    stay = {d: r.text for d, r in docs.items() if re.search("[^\\W\\d_]", r.text)}
    near = test_jaccard_join.brute(list(stay.items()))
    stay = {d: stay[d] for d, cls, _, _ in near if d == cls}
    order = list(stay)
    leaks = test_bm25_decontam.brute([stay[d] for d in order], items)
    bad = {order[r] for (r, _), (overlap, _) in leaks.items() if overlap >= 0.5}
    want = {d: _mask(t) for d, t in stay.items() if d not in bad}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    assert set(got) == set(want) and 0 < len(want) < len(docs) and bad
    for d, t in want.items():
        ids = library.encode(t)
        assert (got[d].ids, got[d].decoded, got[d].n_tokens) == (ids, library.decode(ids), len(ids))


def test_stages_keep_columns_and_bear_odd_rows(make_docs, spark, scratch):
    rows = [(i, f"the cat and the dog number {i} of the house", "en") for i in range(10)]
    rows += [(20, None, None), (21, "", "en"), (22, "12 34", "en"), (None, "the cat secret=abcdef1", "en"),
             (1, "the cat and the dog number 1 of the house", "en"), (30, "жуч" * 9, None)]
    docs = make_docs(rows).selectExpr("*", "'x' AS ids", "1 AS n_tokens", "'b' AS blob")
    spark.createDataFrame([(1, "nothing here at all")], "item_id long, text string").write.parquet(
        f"{scratch}/benchmark.parquet")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, scratch)
            assert out.columns == docs.columns
            frame = out
        last = corpus_pipeline.STAGES[-1][1](spark, frame, scratch)
        ids = sorted((r.doc_id for r in last.collect()), key=str)
    assert ids == []
    kept = language_id.keep_identified(docs)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*range(10), 1, None], key=str)
