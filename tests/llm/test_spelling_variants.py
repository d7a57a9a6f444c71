import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import spelling_variants as sv

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def neighbours(word: str, letters: str) -> set[str]:
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters}
        if i < len(word):
            out.add(word[:i] + word[i + 1:])
            out |= {word[:i] + c + word[i + 1:] for c in letters}
    return out - {word}


def brute_words(docs) -> Counter:
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1:]
            total[run] += 1
    return Counter({w: n for w, n in total.items() if n >= 3 and len(w) >= 5})


def brute(words: dict[str, int]) -> dict:
    letters = "".join(sorted({c for w in words for c in w}))
    near = {w: [x for x in neighbours(w, letters) if x in words] for w in words}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            if words[best] >= 2 * words[w]:
                form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None)
    return out


def collected(df):
    assert df.columns == COLUMNS
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_brute_force(spark):
    from quayside.llm.queries import QUERIES, table
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    got = collected(QUERIES["op12_spelling_variants"](spark, sf))
    want = brute(brute_words(docs))
    assert len(want) > 1000 and any(v[0] and v[1] != v[0] for v in want.values())
    assert got == want


WORDS = ["house", "houses", "mouse", "housé", "houseé", "horse", "hoarse", "hose", "ouseh",
         "abcde", "bcdef", "aaaaa", "aaaaaa", "aaaaaaa", "aaaab", "baaaa", "Àbcde",
         "x" * 400, "x" * 401, "x" * 402, "y" + "x" * 400, "x" * 200 + "y" + "x" * 199]


@pytest.mark.parametrize("depth, members", [(1, 20_000), (3, 20_000), (7, 20_000), (2, 3), (1, 2)])
def test_any_depth_and_blocks(spark, depth, members):
    words = {w: 3 + (7 * i) % 50 for i, w in enumerate(WORDS)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert collected(sv.variants(df, depth, members)) == brute(words)


def test_long_chain_has_one_root(spark):
    words = {"stem" + "a" * k: 3 * 2 ** k for k in range(1, 18)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = collected(sv.variants(df))
    assert got == brute(words)
    assert {v[1] for v in got.values()} == {"stem" + "a" * 17}


def test_ties_go_to_the_smaller_word(spark):
    words = {"crate": 3, "grate": 9, "irate": 9}
    got = collected(sv.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got["crate"] == ("grate", "grate", 3, 2, 9)
    assert got["grate"] == (None, "grate", 9, 2, None)


def test_edge_texts(spark, make_docs):
    long = "Wortlänge " * 300_000
    docs = [(1, None), (2, ""), (3, "12 34 !"), (None, "KelvinKkelvin kelvin KELVIN"),
            (4, "fünfer Fünfer FÜNFER fünfers"), (4, "fünfer Fünfer FÜNFER fünfers"),
            (4, "fünfer Fünfer FÜNFER fünfers"), (5, long), (6, "×÷×÷× " * 4)]
    df = make_docs(docs).withColumnsRenamed({"lang": "word", "n_chars": "n"})
    assert collected(sv.document_variants(df)) == brute(brute_words(docs))


def test_empty_table(spark, make_docs):
    assert collected(sv.document_variants(make_docs([]))) == {}
    assert collected(sv.document_variants(make_docs([(1, None)]))) == {}


def test_counts_are_passed_on_when_many(spark, make_docs, monkeypatch):
    monkeypatch.setattr(sv, "HELD", 2)
    docs = [(i, "alpha bravo charlie delta echoes alpha") for i in range(20)]
    got = {r["word"]: r["n"] for r in sv.counted_words(make_docs(docs)).collect()}
    assert got == dict(brute_words(docs))


@settings(max_examples=300, deadline=None)
@given(st.text("abé", min_size=1, max_size=6), st.text("abé", min_size=1, max_size=6))
def test_one_edit(a, b):
    assert sv.one_edit(a, b) == (b in neighbours(a, "abé"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("abéж", max_size=5), st.text("abé", max_size=5)), min_size=1),
       st.sampled_from([4, 6, 40]))
def test_words_compared_together(pairs, width):
    pairs = [p for p in pairs if abs(len(p[0]) - len(p[1])) <= 1] or [("a", "b")]
    before, sv.WIDTH = sv.WIDTH, width
    try:
        a, b = (sv.Letters(list(x)) for x in zip(*pairs, strict=True))
        at = np.arange(len(pairs))
        got = sv.one_edit_apart(a, at, b, at).tolist()
    finally:
        sv.WIDTH = before
    assert got == [sv.one_edit(*p) for p in pairs]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text("abcé", min_size=1, max_size=7), min_size=1, max_size=60))
def test_trie_finds_all(words):
    words = sorted(words)
    monkey, sv.LEAF = sv.LEAF, 2
    try:
        trie = sv.CountTrie(words, 0)
        q, w = trie.search(words)
    finally:
        sv.LEAF = monkey
    found = {(words[a], trie.words[b]) for a, b in zip(q, w, strict=True)}
    assert len(q) == len(set(zip(q.tolist(), w.tolist())))
    assert found == {(a, b) for a in words for b in words if b in neighbours(a, "abcé")}
