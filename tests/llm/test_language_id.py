import numpy as np

from quayside.llm import language_id as L
from quayside.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def _plain_grams(text, orders=L.ORDERS):
    out, word = [], ""
    padded = [""]
    for ch in text.lower() + " ":
        if ch.isalpha():
            word += ch
        elif word:
            padded.append(word)
            word = ""
    for w in padded[1:]:
        w = "\0" + w + "\0"
        out += [w[i:i + k] for k in orders for i in range(len(w) - k + 1)]
    return out


def test_grams_equal_a_plain_loop():
    texts = ["Das Haus, das!", "a", "", "12 34", "é-ê ß x1y", "日本 語", "İx"]
    h, row, has = L.gram_hashes(texts)
    want = [_plain_grams(t) for t in texts]
    assert has.tolist() == [bool(w) for w in want]
    assert np.bincount(row, minlength=len(texts)).tolist() == [len(w) for w in want]
    names = {}
    for i, grams in enumerate(want):
        got = sorted(h[row == i].tolist())
        for g in grams:
            one = L.gram_hashes([g.strip("\0")])[0].tolist()
            names.setdefault(g, one)
        assert len(set(got)) == len(set(grams))


def test_held_out_accuracy_and_whole_table(spark):
    path = SF_SMALL.replace("sf0.001", "sf0.01")
    docs = {r.doc_id: r for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = QUERIES["op9_language_id"](spark, path).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (L.fold_of(r.doc_id) == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right / len(held) > 0.97


def test_filters_equal_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "lang")
    model = L.train(rows)
    counts = {}
    for r in rows.collect():
        for h in L.gram_hashes([r.text])[0].tolist():
            counts.setdefault(r.lang, {}).setdefault(h, 0)
            counts[r.lang][h] += 1
    share = {k: {h: n / sum(c.values()) for h, n in c.items()} for k, c in counts.items()}
    masks = np.zeros(L.POSITIONS, np.uint64)
    for i, k in enumerate(sorted(share)):
        for h, s in share[k].items():
            if s >= L.MIN_SHARE and s >= L.RATIO * max(x.get(h, 0) for x in share.values()):
                for place in L.positions(np.array([h], np.uint64)):
                    masks[place] |= np.uint64(1) << np.uint64(i)
    assert model.languages == sorted(share) and (model.masks == masks).all()


def test_nulls_short_texts_clashing_names_and_empty(make_docs):
    train = [(i, "the house of the man and the cat", "en") for i in range(8)]
    train += [(i, "das haus und der mann und die katze", "de") for i in range(8, 14)]
    docs = make_docs(train + [(50, None, "en"), (51, "", None), (52, "12 !!", "de"),
                              (53, "der mann " * 30000), (53, "x", None), (None, "the cat", "en")])
    docs = docs.selectExpr("*", "'z' AS lang_pred", "9 AS score")
    got = L.identify(docs).collect()
    by = {r.doc_id: r for r in got if r.doc_id != 53}
    assert len(got) == docs.count()
    assert [by[i].lang_pred for i in (50, 51, 52)] == ["und"] * 3
    assert {by[i].score for i in (50, 51, 52)} == {0.0}
    assert by[None].lang_pred == "en" and by[0].lang_pred == "en" and by[9].lang_pred == "de"
    assert "de" in {r.lang_pred for r in got if r.doc_id == 53}
    assert L.identify(docs.limit(0)).collect() == []
    nothing = L.identify(make_docs([(1, "abc"), (2, "def")])).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_more_languages_than_bits_of_a_word(make_docs):
    langs = [f"l{i:03d}" for i in range(130)]
    word = lambda i: "".join(chr(97 + int(d)) * 2 for d in f"{i:03d}")
    text = lambda i: " ".join([word(i) + c for c in "klmnop"] * 3)
    docs = make_docs([(k * 130 + i, text(i), langs[i]) for k in range(12) for i in range(130)])
    model = L.train(docs)
    assert model.languages == langs and len(model.masks) == 3 * L.POSITIONS
    for i in (0, 63, 64, 127, 128, 129):       # its filter holds its n-grams
        own = set(L.gram_hashes([text(i)])[0].tolist())
        h = np.array(sorted(own), np.uint64)
        mask = np.full(len(h), 2**64 - 1, np.uint64)
        for place in L.positions(h):
            mask &= L.word_of(model.masks, i)[place]
        held = (mask & L.bit_of(i)).astype(bool)
        assert held.mean() > 0.5
    got = L.identify(docs).collect()
    assert len(got) == docs.count()
    assert all(r.lang_pred == langs[r.doc_id % 130] for r in got)
    assert L.keep_identified(docs).count() == docs.count()
