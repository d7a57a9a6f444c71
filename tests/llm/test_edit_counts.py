import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quayside.llm.edit_counts import (LEAF, CountedText, apply_edits, build, revised, tree_of,
                                      with_edits)
from quayside.llm.pretokens import TOKENIZER, codec
from quayside.llm.queries import QUERIES
from tests.conftest import SF_SMALL

PARTS = ["word", " word", "'s", "'", "ll", " ", "  ", "\n", "\n\n", "\t", "12", " 3", "!", " !?", "é",
         "日本", "😀", " <|endoftext|>", "a\x00b", "　", "don't", "x" * 30]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    t.encode_special_tokens = True
    return t


def _text(rng, most):
    return "".join(rng.choice(PARTS) for _ in range(rng.randint(0, most)))


def test_pretoken_route_equals_the_library(library):
    rng = random.Random(1)
    texts = [_text(rng, 60) for _ in range(2000)] + ["", " ", "a" * 5000, "ab " * 9000]
    flat, count = codec().encode(texts)
    rows = [x.tolist() for x in np.split(flat, np.cumsum(count)[:-1])]
    assert rows == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_edit_keeps_the_count_right(library):
    rng = random.Random(2)
    coder = codec()
    for most in (0, 3, 40, 900):
        for _ in range(12):
            text = _text(rng, most)
            pre, _ = coder.cut([text])
            cut = np.arange(0, len(pre), LEAF)
            sizes, length = coder.sizes(pre), np.array([len(p) for p in pre], np.int64)
            add = lambda v: np.add.reduceat(v, cut) if len(v) else v
            doc = CountedText(text, tree_of(add(length)), tree_of(add(sizes)), coder)
            for _ in range(25):
                a = rng.randint(0, len(text) + 2)
                b = a + rng.choice([0, 0, 1, 2, 5, 200])
                new = _text(rng, rng.choice([0, 1, 4, 700]))
                doc.replace(a, b, new)
                a = min(a, len(text))
                text = text[:a] + new + text[max(min(b, len(text)), a):]
                assert doc.text == text
                assert doc.n_tokens == len(library.encode(text, add_special_tokens=False).ids)
                assert doc.chars[1] == len(text)


def test_only_touched_regions_are_encoded(make_docs):
    docs = make_docs([(1, "some words here " * 20000)])
    edits = docs.sparkSession.createDataFrame(
        [(1, 1, 100000, 100004, "new"), (1, 2, 5, 5, "x")],
        "doc_id long, seq int, start int, stop int, text string")
    row = apply_edits(with_edits(build(docs), edits)).first()
    assert 0 < row.n_encoded <= 6 * LEAF < row.n_tokens


def test_documents_with_nulls_repeats_and_extra_columns(make_docs, library):
    docs = make_docs([(1, None), (2, ""), (None, "a b"), (3, "same text"), (3, "same text")])
    docs = docs.selectExpr("*", "1 AS chars", "2 AS tokens", "3 AS n_tokens")
    spark = docs.sparkSession
    edits = spark.createDataFrame(
        [(1, 1, 0, 9, "abc"), (3, 2, 0, 4, "other"), (3, 1, -5, 0, None), (None, 1, 0, 1, "z"),
         (99, 1, 0, 0, "z")], "doc_id long, seq int, start int, stop int, text string")
    got = apply_edits(with_edits(build(docs), edits)).collect()
    count = lambda s: len(library.encode(s, add_special_tokens=False).ids)
    assert sorted(((r.doc_id, r.text, r.n_tokens) for r in got), key=str) == sorted(
        [(1, "abc", count("abc")), (2, "", 0), (None, "a b", count("a b")),
         *[(3, "other text", count("other text"))] * 2], key=str)
    assert revised(docs.limit(0)).collect() == []
    assert len(revised(docs).collect()) == 5


def test_query_equals_full_encoding(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    count = lambda s: len(library.encode(s, add_special_tokens=False).ids)
    want = set()
    for d, t in docs.items():
        new = t[:max(len(t) - 10, 0)]
        q = len(t) // 4
        new = "Source of the text:\n" + new[:q] + " (edited) " + new[q + 5:]
        want.add((d, count(t), count(new)))
    got = QUERIES["op6_token_counts"](spark, SF_SMALL).collect()
    assert {(r.doc_id, r.n_tokens_before, r.n_tokens) for r in got} == want and len(got) == len(docs)


ADDED = ["<|endoftext|>", "<|endof", "text|>", "<", "|>", " ", "  ", "\n", "a", " b", "'s", "!", "12"]


@pytest.fixture(scope="module")
def loaded():
    return Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


def test_added_tokens_are_cut_as_by_the_library_as_loaded(loaded):
    rng = random.Random(3)
    texts = ["".join(rng.choices(ADDED, k=rng.randint(0, 40))) for _ in range(2000)]
    texts += ["a <|endoftext|> b", "<|endoftext|>" * 3, "a  <|endoftext|>  ", "<<|endoftext|>>"]
    flat, count = codec(added=True).encode(texts)
    rows = [x.tolist() for x in np.split(flat, np.cumsum(count)[:-1])]
    assert rows == [e.ids for e in loaded.encode_batch(texts, add_special_tokens=False)]
    assert rows[2000] == [64, 220, 50256, 275]


def test_edits_that_make_and_break_added_tokens(make_docs, loaded):
    rng = random.Random(4)
    docs, edits, want = [], [], {}
    count = lambda s: len(loaded.encode(s, add_special_tokens=False).ids)
    for d in range(150):
        text = "".join(rng.choices(ADDED, k=rng.choice([3, 30, 300, 1200])))
        docs.append((d, text))
        before = count(text)
        for seq in range(12):
            a = rng.randint(0, len(text))
            if rng.random() < 0.5:             # inside or beside an added token
                a = max(text.find("<|endoftext|>", a), 0) + rng.randint(0, 14)
            a = min(a, len(text))
            b = min(a + rng.choice([0, 0, 1, 5, 13, 100]), len(text))
            new = "".join(rng.choices(ADDED, k=rng.choice([0, 1, 1, 3, 400])))
            edits.append((d, seq, a, b, new))
            text = text[:a] + new + text[b:]
        want[d] = (text, before, count(text))
    docs = make_docs(docs)
    edits = docs.sparkSession.createDataFrame(
        edits, "doc_id long, seq int, start int, stop int, text string")
    got = apply_edits(with_edits(build(docs), edits)).collect()
    assert {r.doc_id: (r.text, r.n_tokens_before, r.n_tokens) for r in got} == want
