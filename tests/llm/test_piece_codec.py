import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from quayside.llm.piece_codec import (MODEL, codec, decode_documents, digests,
                                      encode_documents)
from quayside.llm.queries import QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


def _texts():
    rng = random.Random(3)
    parts = ["a", "b", "▁", " ", "  ", "\n", "é", "日", "😀", "the", "ing", "0", ".", "\t",
             "\x00", "    ", "ti", "on", "﻿", "İ", "<s>", "<0x41>"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    out += [c * n for c in ("a", "ab", " ", "=", "0", "lo", "-") for n in range(1, 90)]
    out += ["".join(chr(rng.choice([rng.randint(32, 127), rng.randint(128, 0x2000),
                                    rng.randint(0x4E00, 0x9FFF)])) for _ in range(30))
            for _ in range(1000)]
    return out + ["x" * 20000, "word " * 20000]


def test_merge_rounds_equal_the_library(library):
    texts = _texts()
    flat, counts = codec().encode(texts)
    rows = [r.tolist() for r in np.split(flat, np.cumsum(counts)[:-1])]
    assert rows == library.encode(texts)
    assert codec().decode(flat, counts) == library.decode(rows)


def test_decode_of_any_ids_equals_the_library(library):
    rng = random.Random(5)
    rows = [[rng.randint(0, 300) if rng.random() < .5 else rng.randint(0, 31999)
             for _ in range(rng.randint(0, 12))] for _ in range(3000)]
    flat = np.array([i for r in rows for i in r])
    assert codec().decode(flat, np.array([len(r) for r in rows])) == library.decode(rows)


def test_documents_with_nulls_repeats_and_extra_columns(make_docs, library):
    docs = make_docs([(1, None), (2, ""), (None, "a b"), (3, "same"), (3, "same")])
    docs = docs.selectExpr("*", "array(1) AS ids", "'x' AS decoded")
    rows = sorted(((r.doc_id, r.ids, r.decoded) for r in
                   decode_documents(encode_documents(docs)).collect()), key=str)
    same, ab = library.encode("same"), library.encode("a b")
    assert rows == sorted([(1, [], ""), (2, [], ""), (None, ab, "a b"),
                           (3, same, "same"), (3, same, "same")], key=str)
    assert digests(docs.limit(0)).collect() == []


def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = set()
    for d in docs:
        ids = library.encode(d.text or "")
        expected.add((d.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    got = QUERIES["op8_sentencepiece"](spark, SF_SMALL).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(docs)
