"""SentencePiece encoding and decoding by vectorised merge rounds.

The model file is only read for its pieces and scores. Encoding follows the
BPE rule of the library: of all neighbouring symbols whose joined text is a
piece, the pair with the best score is merged first, the leftmost on ties.

Texts are cut into *segments* no piece can cross (a run of space marks and
what follows it; line feeds, if no piece holds one). Segments are encoded
independently, each distinct one once per batch and cache:

1. all segments lie in flat numpy symbol arrays;
2. each round looks up every neighbouring pair, takes the minimum pair rank
   of each segment (``minimum.reduceat``) and merges its leftmost
   non-overlapping occurrences, in all segments at once;
3. where a merge would create a pair that ranks no later than the one just
   merged, the library would take that one first, so only the segment's
   leftmost occurrence is merged in this round;
4. arrays are compacted, and segments without a pair leave.

Symbols outside the vocabulary become byte pieces (or the unknown piece, if
the model has no byte pieces).

Edge cases: null and empty texts have no ids and decode to "". Rows with a
null id, repeated rows and ties are encoded row by row. Only ``id_col`` and
``text_col`` are used; other columns are not carried, so names cannot clash.
"""

from __future__ import annotations

import codecs
import functools
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import map_arrow, slices

MODEL = "piece_bpe_32k.model"
MARK = "▁"
NONE = np.int32(2**31 - 1)
# Distinct segments kept per worker between batches (~300 B each).
CACHE_SEGMENTS = 400_000


def _per_byte(err: UnicodeError):
    return "�" * (err.end - err.start), err.end


codecs.register_error("replace_each_byte", _per_byte)


class PairTable:
    """Pair of symbols -> merged symbol; open addressing, looked up in bulk."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        bits = max(8, int(np.ceil(np.log2(len(left) * 4 + 1))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.vals = np.full(1 << bits, -1, np.int32)
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        left_over = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left_over):
            free = left_over[self.keys[slot[left_over]] == -1]
            self.keys[slot[free]] = keys[free]       # the last writer stays
            won = left_over[self.keys[slot[left_over]] == keys[left_over]]
            self.vals[slot[won]] = merged[won]
            left_over = left_over[self.keys[slot[left_over]] != keys[left_over]]
            slot[left_over] = (slot[left_over] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged symbol of each pair, -1 where there is none."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.vals[slot], np.int32(-1))
        again = np.flatnonzero((found != keys) & (found != -1))
        while len(again):
            slot[again] = (slot[again] + 1) & self.mask
            found = self.keys[slot[again]]
            hit = found == keys[again]
            out[again[hit]] = self.vals[slot[again[hit]]]
            again = again[~hit & (found != -1)]
        return out


class Numbers(dict):
    """Numbers strings in order of first use; ``fresh`` lists the new ones."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        self.fresh.append(key)
        number = self[key] = len(self)
        return number


class PieceCodec:
    """Pieces, scores and pair table of one model."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.unk = sp.unk_id()
        pieces = [sp.id_to_piece(i) for i in range(self.size)]
        special = [sp.is_control(i) or sp.is_unused(i) or sp.is_unknown(i) or sp.is_byte(i)
                   for i in range(self.size)]
        ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        # Characters that occur only inside longer pieces get symbols past the vocabulary.
        for ch in sorted({c for p in ids for c in p} - ids.keys()):
            ids[ch] = len(pieces)
            pieces.append(ch)
        scores = np.array([sp.get_score(i) if i < self.size else -np.inf
                           for i in range(len(pieces))])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        splits = [(ids[p[:i]], ids[p[i:]], k) for p, k in ids.items() for i in range(1, len(p))
                  if p[:i] in ids and p[i:] in ids]
        self.pairs = PairTable(*np.array(splits, np.int64).reshape(-1, 3).T)
        self.chars = np.full(0x110000, -1, np.int32)
        for p, k in ids.items():
            if len(p) == 1:
                self.chars[ord(p)] = k
        self.byte_ids = np.full(256, -1, np.int32)
        for i in range(self.size):
            if sp.is_byte(i):
                self.byte_ids[int(pieces[i][1:-1], 16)] = i
        self.has_bytes = bool((self.byte_ids >= 0).all())
        # A line feed is a segment of its own if no piece holds one.
        alone = "\n" if not any("\n" in p for p in ids) else ""
        crossing = any(MARK in p.lstrip(MARK) for p in ids)
        self.cut = re.compile(".+" if crossing else
                              f"{MARK}*[^{MARK}{alone}]+|{MARK}+|{alone or MARK}+", re.S)
        text = []
        for i in range(self.size):
            if sp.is_byte(i):
                text.append(bytes([int(pieces[i][1:-1], 16)]))
            elif sp.is_unknown(i):
                text.append(" ⁇ ".encode())
            else:
                text.append(b"" if sp.is_control(i) else pieces[i].replace(MARK, " ").encode())
        self.piece_bytes = np.frombuffer(b"".join(text), np.uint8)
        self.piece_off = np.concatenate([[0], np.cumsum([len(t) for t in text])])
        self.leads = np.array([t[:1] == b" " and not special[i] for i, t in enumerate(text)])
        self.control = np.array([sp.is_control(i) for i in range(self.size)])
        self._forget()

    def _forget(self) -> None:
        self._cache = Numbers()                   # segment -> its place in _off
        self._flat, self._off = np.zeros(0, np.int32), np.zeros(1, np.int64)

    # -- encoding ---------------------------------------------------------

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids per segment) of non-empty segments."""
        n = len(segments)
        cp = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(n), np.fromiter(map(len, segments), np.int64, n))
        sym, place = self.chars[cp], np.arange(len(cp))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            joined = np.full(len(sym), -1, np.int32)
            near = np.flatnonzero((word[:-1] == word[1:]) & (sym[:-1] >= 0) & (sym[1:] >= 0))
            joined[near] = self.pairs.get(sym[near], sym[near + 1])
            rank = np.where(joined >= 0, self.rank[joined], NONE)
            head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, head)
            width = np.diff(np.append(head, len(sym)))
            alive = np.repeat(least != NONE, width)
            if not alive.all():
                done.append((place[~alive], sym[~alive]))
                sym, place, word, joined, rank = (x[alive] for x in (sym, place, word, joined, rank))
                least, width = least[least != NONE], width[least != NONE]
                if not len(sym):
                    break
            best = np.repeat(least, width)
            at = np.flatnonzero(rank == best)
            run = np.concatenate([[True], np.diff(at) != 1])      # overlapping pairs
            run_start = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            first = np.concatenate([[True], word[at][1:] != word[at][:-1]])
            if not first.all():
                at = at[first | ~self._too_early(sym, word, joined, best, at)]
            sym[at] = joined[at]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            sym, place, word = sym[stay], place[stay], word[stay]
        place = np.concatenate([p for p, _ in done]) if done else np.zeros(0, np.int64)
        sym = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int32)
        order = np.argsort(place, kind="stable")
        place, sym = place[order], sym[order]
        owner = np.repeat(np.arange(n), np.fromiter(map(len, segments), np.int64, n))[place]
        return self._with_bytes(sym, cp[place], owner, n)

    def _too_early(self, sym, word, joined, best, at) -> np.ndarray:
        """For each merge: does its segment create a pair that ranks no later?"""
        merged = joined[at]
        ends = np.zeros(len(sym) + 2, np.int32) - 1     # symbol that a merge leaves at i-2
        ends[at + 2] = merged
        before = np.where(ends[at] >= 0, ends[at], sym[np.maximum(at - 1, 0)])
        has_left = (at > 0) & (word[np.maximum(at - 1, 0)] == word[at]) & (before >= 0)
        after = np.minimum(at + 2, len(sym) - 1)
        has_right = (at + 2 < len(sym)) & (word[after] == word[at]) & (sym[after] >= 0)
        bad = np.zeros(len(at), bool)
        for has, left, right in ((has_left, before, merged), (has_right, merged, sym[after])):
            new = self.pairs.get(left[has], right[has])
            bad[has] |= (new >= 0) & (self.rank[new] <= best[at[has]])
        group = np.cumsum(np.concatenate([[True], word[at][1:] != word[at][:-1]])) - 1
        return np.bincount(group, bad)[group] > 0

    def _with_bytes(self, sym, cp, owner, n) -> tuple[np.ndarray, np.ndarray]:
        """Replace symbols outside the vocabulary by their byte pieces."""
        out_of = (sym < 0) | (sym >= self.size)
        count = np.ones(len(sym), np.int64)
        if out_of.any():
            code = cp[out_of]
            count[out_of] = (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
                             if self.has_bytes else 1)
        ids = np.repeat(sym, count)
        if out_of.any():
            spread = np.repeat(out_of, count)
            if self.has_bytes:
                raw = cp[out_of].astype(np.uint32).tobytes().decode("utf-32-le").encode()
                ids[spread] = self.byte_ids[np.frombuffer(raw, np.uint8)]
            else:
                ids[spread] = self.unk
        return ids.astype(np.int32), np.bincount(owner, count, n).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids per text)."""
        cut = self.cut.findall
        words: list[str] = []
        ends = []
        for t in texts:
            if t:
                words += cut((MARK + t).replace(" ", MARK))
            ends.append(len(words))
        if len(self._cache) > CACHE_SEGMENTS:
            self._forget()
        cache = self._cache
        code = np.fromiter(map(cache.__getitem__, words), np.int64, len(words))
        if cache.fresh:
            flat, counts = self.merge(cache.fresh)
            self._flat = np.concatenate([self._flat, flat])
            self._off = np.concatenate([self._off, self._off[-1] + np.cumsum(counts)])
            cache.fresh = []
        begin, size = self._off[code], self._off[code + 1] - self._off[code]
        total = np.concatenate([[0], np.cumsum(size)])
        flat = self._flat[np.arange(total[-1]) + np.repeat(begin - total[:-1], size)]
        return flat, np.diff(total[np.concatenate([[0], np.array(ends, np.int64)])])

    # -- decoding ---------------------------------------------------------

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        """Text of each row of ids."""
        lens = np.diff(self.piece_off)[flat]
        total = np.concatenate([[0], np.cumsum(lens)])
        source = np.arange(total[-1]) + np.repeat(self.piece_off[flat] - total[:-1], lens)
        data = self.piece_bytes[source].tobytes()
        row_end = np.concatenate([[0], np.cumsum(counts)])
        # The library drops one space mark in front: of the first piece that is not control.
        out = []
        for a, b in zip(row_end[:-1], row_end[1:], strict=True):
            begin = total[a]
            k = a
            while k < b and self.control[flat[k]]:
                k += 1
            if k < b and self.leads[flat[k]]:
                begin = total[k] + 1
            # A control id ends a run of byte pieces.
            stops = [total[a + i] for i in np.flatnonzero(self.control[flat[a:b]]) if a + i > k]
            cuts = [begin, *stops, total[b]]
            out.append("".join(data[x:y].decode("utf-8", "replace_each_byte")
                               for x, y in zip(cuts[:-1], cuts[1:], strict=True)))
        return out


@functools.lru_cache(maxsize=2)
def codec(model: str = MODEL) -> PieceCodec:
    """One codec per Python worker. ``model``: a file of the public tokenizers."""
    return PieceCodec(public_tokenizers.path(model))


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     model: str = MODEL) -> DataFrame:
    """``id_col`` and ``ids`` (array<int>) of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1)
        flats, counts = [], []
        for a, b in slices(texts):
            flat, count = codec(model).encode(texts.slice(a, b - a).to_pylist())
            flats.append(flat)
            counts.append(count)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flats)))
        return pa.record_batch([batch.column(0), ids], names=[id_col, "ids"])

    picked = docs.select(F.col(id_col),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return map_arrow(picked, run, f"`{id_col}` {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, id_col: str = "doc_id",
                     model: str = MODEL) -> DataFrame:
    """``id_col``, ``ids`` and ``decoded``, the text of the ids (null: "")."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(1)
        off = ids.offsets.to_numpy()
        flat = ids.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]]
        texts = codec(model).decode(flat, np.diff(off))
        return pa.record_batch([batch.column(0), ids, pa.array(texts, pa.string())],
                               names=[id_col, "ids", "decoded"])

    picked = encoded.select(F.col(id_col), F.coalesce(
        F.col("ids"), F.array().cast("array<int>")).alias("ids"))
    return map_arrow(picked, run, f"`{id_col}` {kind}, ids array<int>, decoded string")


def digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    both = decode_documents(encode_documents(docs, model=model), model=model)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
