import random
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quayside.llm import id_coder as I
from quayside.llm.pretokens import TOKENIZER, LatinCodec
from quayside.llm.queries import QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    t.encode_special_tokens = True
    return t


def _blocks():
    rng = np.random.default_rng(4)
    out = [rng.integers(0, 65536, n) for n in (1, 2, 3, 500, 4096)]
    out += [np.zeros(3000, int), np.full(700, 65535), np.arange(4096) % 9,
            rng.choice([0, 1, 65535], 2000), rng.geometric(0.01, 4000)]
    out += [np.tile(rng.integers(0, 50000, 40), 100), rng.integers(0, 2, 1) + 7]
    return out + [rng.geometric(0.003, rng.integers(1, 200)) % 65536 for _ in range(300)]


def test_blocks_round_trip_and_stand_alone():
    blocks = _blocks()
    coded = I.encode_blocks(blocks)
    back = I.decode_blocks(coded, [len(b) for b in blocks])
    assert all((a == b).all() for a, b in zip(blocks, back, strict=True))
    for k in (3, 7, 20):       # alone as together
        assert I.encode_blocks([blocks[k]])[0] == coded[k]
        assert (I.decode_blocks([coded[k]], [len(blocks[k])])[0] == blocks[k]).all()
    assert len(coded[5]) < 120 and len(coded[10]) < 0.2 * 2 * len(blocks[10])
    with pytest.raises(ValueError):
        I.encode_blocks([np.array([70000])])


def test_an_id_takes_one_step_of_the_coder_and_an_escape_two(monkeypatch):
    steps = []
    for kind, name in ((I._Writer, "put"), (I._Reader, "take")):
        def counted(self, lane, *parts, whole=getattr(kind, name)):
            steps.append(parts[-1].size)
            return whole(self, lane, *parts)
        monkeypatch.setattr(kind, name, counted)
    block = np.random.default_rng(2).geometric(0.02, 3000)
    coded = I.encode_blocks([block, block[:1000]])
    assert sum(steps) < 1.2 * 4000
    assert (I.decode_blocks(coded, [3000, 1000])[0] == block).all() and sum(steps) < 2.4 * 4000


def test_ids_of_a_block_take_little_more_than_their_entropy():
    rng = np.random.default_rng(8)
    common = rng.choice(50257, 400, replace=False)
    block = common[np.minimum(rng.geometric(0.02, 4096), 400) - 1]
    seen = np.bincount(block)
    part = seen[seen > 0] / 4096
    entropy = -(part * np.log2(part)).sum() * 4096 / 8
    assert len(I.encode_blocks([block])[0]) < 1.15 * entropy


def test_lanes_end_at_any_place_of_an_epoch():
    rng = np.random.default_rng(6)
    sizes = [*range(1, 70), 127, 128, 129, 511, 512, 513, 1023, 1024, 1025, 1536, 1537, 4095, 4096]
    blocks = [np.where(rng.random(n) < 0.3, rng.integers(0, 65536, n), np.arange(n) % 7) for n in sizes]
    back = I.decode_blocks(I.encode_blocks(blocks), sizes)
    assert all((a == b).all() for a, b in zip(blocks, back, strict=True))


def test_payloads_round_trip_and_damage_is_found():
    rng = np.random.default_rng(1)
    chunks = [rng.geometric(0.01, n) % 50257 for n in (1, 4096, 4097, 20000)]
    packed = I.pack(chunks)
    assert all((a == b).all() for a, b in zip(chunks, I.unpack(packed), strict=True))
    bad = bytearray(packed[3])
    bad[-5] ^= 1
    for broken in (bytes(bad), packed[3][:-2], packed[3][:9], b"", b"XXXX" + packed[3][4:]):
        with pytest.raises(ValueError):
            I.unpack([packed[0], broken])


def _brute(rows, library):
    """Rows of (doc_id, start, n, crc) in the files' order."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_of_odd_documents(make_docs, library, scratch, monkeypatch):
    monkeypatch.setattr(I, "CHUNK", 300)
    rng = random.Random(3)
    rows = [(rng.randint(0, 60), "word été " * rng.randint(0, 50)) for _ in range(120)]
    rows += [(None, "x"), (7, None), (8, ""), (9, "long " * 9000), (9, "long " * 9000)]
    docs = make_docs(rows).withColumn("ids", F.lit("x")).withColumn("start", F.lit(1))
    got = I.round_trip(docs, f"{scratch}/ids").collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got),
                  key=lambda r: r[1]) == _brute(rows, library)
    files = docs.sparkSession.read.parquet(f"{scratch}/ids")
    assert files.count() > 40 and files.where("n_tokens > 300").count() == 2
    assert I.round_trip(docs.limit(0)).collect() == []


def test_query_equals_the_library(spark, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet")
            .select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op3_token_ids"](spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(_brute(rows, library))


def test_added_tokens_in_texts_have_their_id(make_docs):
    loaded = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>"), (3, "x  <|endoftext|>\n"),
            (4, "<|endoftext"), (5, "after")]
    got = I.round_trip(make_docs(rows)).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == _brute(rows, loaded)


def test_new_pretokens_go_to_the_library_in_groups(library):
    loaded = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("aeioußñ漢🎉", k=rng.randint(1, 9))) for _ in range(900)),
             "", "x<|endoftext|>y\n\n z", "a" * 5000, "\x00\t'll 12 345!?"]
    for added, whole in ((True, loaded), (False, library)):
        coder = LatinCodec(public_tokenizers.path(TOKENIZER), added)
        calls = []
        coder.bare = SimpleNamespace(encode=lambda group, of=coder.bare, **k: (
            calls.append(len(group)), of.encode(group, **k))[1])
        flat, count = coder.encode(texts)
        want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
        assert count.tolist() == [*map(len, want)] and flat.tolist() == sum(want, [])
        assert len(calls) <= 2 and sum(calls) > 500
