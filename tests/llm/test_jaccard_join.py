import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quayside.llm import jaccard_join as J
from quayside.llm.components import components
from quayside.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def _set(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    """{row: (class id, links, text links)} of (id, text) rows, from all pairs."""
    sets = [_set(t) for _, t in docs]
    index = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            index[g].add(i)
    near = [set() for _ in docs]
    for i, s in enumerate(sets):
        for j in set().union(*[index[g] for g in s]) if s else ():
            both = len(s & sets[j])
            if j != i and both * 5 >= 4 * (len(s) + len(sets[j]) - both):
                near[i].add(j)
    seen, cls = set(), {}
    for i in range(len(docs)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for k in near[todo.pop()] - group:
                group.add(k)
                todo.append(k)
        seen |= group
        ids = [docs[k][0] for k in group if docs[k][0] is not None]
        for k in group:
            cls[k] = min(ids) if ids else None
    return sorted(((docs[i][0], cls[i], len(near[i]),
                    len({sets[k] for k in near[i]} - {sets[i]})) for i in range(len(docs))), key=str)


def _rows(df):
    return sorted(((r.doc_id, r.class_id, r.n_links, r.n_text_links) for r in df.collect()), key=str)


def _near_copies(rng, n, words=60):
    base = [rng.choice("abcdefghij") * rng.randint(1, 9) for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(words)] = rng.choice("xyz") * rng.randint(1, 5)
        out.append(" ".join(w))
    return out


def test_links_equal_brute_force(make_docs, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 16)       # several blocks per group
    rng = random.Random(4)
    texts = []
    for n in (2, 3, 9, 60):
        texts += _near_copies(rng, n)
    texts += _near_copies(rng, 5, words=12) * 2
    texts += ["one two", "one two", "one two three", "", None, "  \n", "a b c d e", "a b c d f"]
    texts += [" ".join(rng.choices("abcdefgh", k=40)) for _ in range(60)]
    rng.shuffle(texts)
    docs = [(i * 3 % 400, t) for i, t in enumerate(texts)] + [(None, texts[0]), (7, texts[3])]
    spark_docs = make_docs(docs).selectExpr("*", "'q' AS class_id", "1 AS n1", "2 AS sig")
    assert _rows(J.near_classes(spark_docs)) == brute(docs)


def test_pages_of_one_template_are_compared_by_bucket(make_docs, monkeypatch):
    """Pages with a common part that are not near, and some that are: the component is
    dealt out by its buckets, in far fewer pairs, with the same links."""
    monkeypatch.setattr(J, "BLOCK", 8)
    rng = random.Random(6)
    common = [f"menu{i}" for i in range(50)]
    own = [[f"w{rng.randrange(10 ** 6)}" for _ in range(38)] for _ in range(150)]
    texts = [" ".join(common + o) for o in own]
    texts += [" ".join(common + o[:-1] + ["edited"]) for o in own[:20]]
    texts += _near_copies(rng, 40)                    # dealt out as a whole: all are near
    docs = list(enumerate(texts))
    table = make_docs(docs)
    assert _rows(J.near_classes(table)) == brute(docs)
    classes = J.sketched(table).groupBy("n1", "n2").agg(F.any_value("sig").alias("sig"))
    deals = J.dealt(classes, J.candidate_components(classes)).selectExpr("inline(deals)")
    groups = [(r["band"], r["count"]) for r in deals.groupBy("g1", "g2", "band").count().collect()]
    by_bucket = sum(n * (n - 1) // 2 for band, n in groups if band >= 0)
    assert 20 <= by_bucket < 170 * 169 // 2
    assert any(band < 0 and n >= 20 for band, n in groups)


def test_a_pair_counts_in_its_first_shared_band():
    sig = np.random.default_rng(1).integers(0, 2**32, (3, J.HASHES), dtype=np.uint32)
    for band in (4, 9):
        at = slice(band * J.ROWS, (band + 1) * J.ROWS)
        sig[1, at] = sig[0, at]
    sig[2, :J.ROWS] = sig[0, :J.ROWS]
    i, j = np.array([0, 0, 1]), np.array([1, 2, 2])
    hits = {b: J.first_shared(sig, i, j, b).tolist() for b in range(J.BANDS)}
    assert hits.pop(0) == [False, True, False] and hits.pop(4) == [True, False, False]
    assert not any(any(h) for h in hits.values())


def test_whole_table_equals_brute_force(spark):
    path = SF_SMALL.replace("sf0.001", "sf0.01")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = _rows(QUERIES["op7_jaccard_join"](spark, path))
    assert got == brute(docs)
    assert any(r[3] for r in got)


def test_pruning_keeps_pairs_at_the_threshold():
    least = J.least_matches()
    assert least[J.STEP] == 0 and 0 < least[J.HASHES] < 0.8 * J.HASHES
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 90, dtype=np.uint64)
    sets = [np.unique(base), np.unique(np.concatenate([base[10:], base[:0]])),
            np.unique(rng.integers(0, 2**63, 90, dtype=np.uint64))]
    sets.append(np.unique(np.concatenate([base[:80], sets[2][:10]])))     # J = 80 / 100
    both = np.arange(4)
    i, j = J.linked_pairs(J.signatures(sets), sets, both, both)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(0, 1), (0, 3)}


def test_words_split_at_the_six_blanks_only():
    sets = J.shingle_sets(pa.array(["a\tb\x0bc\x0cd\re f", "a b c d e f", "a\x1cb c\x85d e f",
                                    " a b", "", "x"]))
    assert sets[0].tolist() == sets[1].tolist() and len(sets[0]) == 2
    assert [len(s) for s in sets] == [2, 2, 1, 1, 0, 1]


def test_components_of_a_path_a_star_and_a_cycle(spark):
    edges = [(i, 0, i + 1, 0) for i in range(40)] + [(100, 1, 200 + i, 1) for i in range(30)]
    edges += [(300, 5, 301, 5), (301, 5, 302, 5), (302, 5, 300, 5), (300, 5, 300, 5)]
    got = components(spark.createDataFrame(edges, "a1 long, a2 long, b1 long, b2 long")).collect()
    assert {(r.n1, r.c1, r.c2) for r in got} == (
        {(i, 0, 0) for i in range(41)} | {(i, 100, 1) for i in (100, *range(200, 230))}
        | {(i, 300, 5) for i in (300, 301, 302)})


def test_one_document_of_each_class_stays(make_docs):
    docs = make_docs([(5, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (9, "other"),
                      (None, "a b c d e f g"), (3, None), (4, "")])
    kept = J.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 3, 4, 9]   # the copy without an id goes
    assert J.one_per_class(docs.limit(0)).collect() == []
    assert J.near_classes(docs.limit(0)).collect() == []


def test_rows_of_one_id_or_none_are_kept_by_their_own_text(make_docs):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(40)) for w in "abcd")
    rows = [(3, a), (7, a), (7, c), (8, b), (8, d), (None, a), (None, a), (None, d + " more"),
            (9, ""), (9, ""), (None, None), (4, c), (4, c)]
    docs = make_docs(rows)
    kept = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["text"] or "")
                  for r in J.one_per_class(docs).collect())
    want = [((False, 3), a), ((False, 4), c), ((False, 8), b), ((False, 8), d),
            ((False, 9), ""), ((False, 9), ""), ((True, 0), "")]
    assert kept == want


def test_half_of_the_rows_without_an_id(make_docs):
    texts = [" ".join(f"w{i}x{k}" for k in range(30)) for i in range(400)]
    docs = make_docs([(i if i % 2 else None, t) for i, t in enumerate(texts + texts)])
    rows = J.near_classes(docs).collect()
    assert len(rows) == 800 and {r["n_copies"] for r in rows} == {2}
    assert sorted(r["text"] for r in J.one_per_class(docs).collect()) == sorted(texts)
