import hashlib
import random
from collections import Counter

import numpy as np

from quayside.llm import repeat_spans as R
from quayside.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def brute(texts):
    """(n_words, covered flags, digest) per text, from all windows."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + R.WINDOW]) for w in words for i in range(len(w) - R.WINDOW + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - R.WINDOW + 1):
            if seen[tuple(w[i:i + R.WINDOW])] > 1:
                gone[i:i + R.WINDOW] = [True] * R.WINDOW
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def _texts():
    rng = random.Random(6)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared = [new(n) for n in (20, 34, 35, 36, 60, 200)]
    out = []
    for _ in range(120):
        parts = [new(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            x = list(rng.choice(shared))
            if rng.random() < .4:
                x[rng.randrange(len(x))] = "edit"
            if rng.random() < .3:
                x = x[rng.randint(0, 30):]
            parts += [x, new(rng.randint(0, 9))]
        out.append(" ".join(w for p in parts for w in p))
    out += [out[3]] * 4 + [out[5].replace(" ", "\n"), "short text", "short text", "", None]
    out += [" ".join(["same"] * 35), " ".join(["same"] * 36), "ab " * 100, " ".join(new(35) * 2)]
    return out + [" ".join(new(10) + ["x", "y"] * 5000)]


def test_removed_words_equal_brute_force(make_docs):
    texts = _texts()
    ids = [i if i % 9 else (None if i % 2 else 500) for i in range(len(texts))]
    docs = make_docs(list(zip(ids, texts, strict=True)))
    docs = docs.selectExpr("*", "1 AS rid", "'x' AS seeds", "2 AS n_words")
    got = R.remove_repeats(docs).collect()
    want = [(i, *b) for i, b in zip(ids, brute(texts), strict=True)]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == sorted(
        want, key=str)
    assert all(sum(s.stop - s.start for s in r.spans) == r.n_removed for r in got)
    assert R.remove_repeats(docs.limit(0)).collect() == []


def test_selected_seed_is_the_smallest_and_last():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 6, 500, dtype=np.uint64) << np.uint64(40)
    got = R.selected(grams)
    for s in range(len(grams) - R.REACH + 1):
        run = grams[s:s + R.REACH]
        assert got[s] == s + R.REACH - 1 - int(np.argmin(run[::-1]))


def test_whole_table_equals_brute_force(spark):
    path = SF_SMALL.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    want = {(d.doc_id, *b) for d, b in zip(docs, brute([d.text for d in docs]), strict=True)}
    got = QUERIES["op5_substring_dedup"](spark, path).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(docs)
    assert 0 < sum(1 for r in got if 0 < r.n_removed < r.n_words)


def test_many_rows_without_an_id_share_a_passage(make_docs):
    rng = random.Random(9)
    shared = " ".join(f"s{k}" for k in range(50))
    texts = [f"a{rng.randrange(10**9)} {shared} b{i}" for i in range(500)]
    rows = R.remove_repeats(make_docs([(None, t) for t in texts])).collect()
    want = Counter((n, sum([gone] if isinstance(gone, int) else gone), d) for n, gone, d in brute(texts))
    assert Counter((r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows) == want
