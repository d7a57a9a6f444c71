"""Binary output of token ids: an adaptive context-mixing range coder.

*Blocks.* Ids are coded in blocks of up to ``BLOCK`` ids. Every block starts
from the same model, stands alone and carries the crc32 of its bytes and of
its ids. All blocks at hand are coded in step, one numpy lane per block.

*Model.* Three orders predict the next id:

* order 2: the id that last followed the two ids before (a hashed table of
  ids with confidences), order 1 the same for the one id before;
* order 0: how often each id came in the block so far; an id that did not is
  an escape (one part per distinct id) and then coded by a fixed distribution.

The guess is order 2's id (order 1's, where order 2 has none). Its probability
mixes two adaptive estimates, by order 2's and by order 1's confidence, in the
logistic domain with weights that are learnt. Order 1's other id has an
estimate of its own; order 0 has the rest, so an id takes one step of the
coder and an escape two. Tables follow every id; estimates, weights and
counts are renewed every few ids at first, then every ``EPOCH`` ids.

*Coder.* 63-bit range, 24-bit probabilities, 32-bit words; carries are added
up after the last step. Probabilities are whole numbers throughout.

*Files.* One parquet row per chunk of whole documents (about ``CHUNK`` ids):
part and chunk number, document ids, their numbers of ids, and the payload

    "QCM2" | number of blocks | per block: ids, bytes, crc32 of the bytes,
    crc32 of the ids (all little-endian u32) | the blocks' bytes

Rows are in ascending document id order: parts are ranges of ids (repeated
ids by text; texts of one id and one beginning share a part), chunks ascend in
a part.

Edge cases: a null or empty text has only the end id; null document ids come
first; repeated rows are written one by one; an empty table writes no rows.
Only doc_id and text are read, so other columns' names cannot clash. Ids must
be below 65,536. A damaged block raises ``ValueError``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import map_arrow, python_batches, scratch, slices
from quayside.llm.pretokens import CACHE_PRETOKENS, TOKENIZER, latin_codec

BLOCK = 4096
CHUNK = 1 << 16
BOUND_CHARS = 64               # of a text, in the range bounds
LANES = 1024                   # blocks coded in step: about 10 kB of model each
END_ID = 0
MAGIC = b"QCM2"
EPOCH = 512                    # ids at most between two renewals
_SLOTS = 1024                  # entries of a context table
_CASES = 8 * 2 * 8
_ONE = 1 << 24                 # probabilities are parts of this
_BITS = np.uint64(24)
_LEAST = _ONE >> 10            # parts of the first decision, either way
_ROOM = 1 << 13                # parts that order 0 has at least
_SHORT = np.uint64(2**31)      # a narrower interval gives out a word
_KEPT = np.array([2**64 - 1, 2**31 - 1], np.uint64)    # of the lower end, if it doesn't, if it does
FILE_SCHEMA = ("part int, chunk int, doc_ids array<long>, doc_tokens array<int>, n_tokens long, "
               "payload binary")

# An id new to order 0 is coded by this fixed distribution, even within ranges
# that grow with the id (merges are numbered by frequency): parts of 2**20, of
# the first id and the binary logarithm of the parts of an id.
_RANGES = np.array([0, 256, 512, 768, 1024, 1536, 2048, 3072, 4096, 6144, 8192, 12288, 16384,
                    24576, 32768, 49152, 65536])
_WIDE = (20 - np.log2(np.diff(_RANGES))).astype(np.int64)
_PRIOR = np.concatenate([(k << 20) + (np.arange(a, b) - a << w) for k, (a, b, w) in enumerate(
    zip(_RANGES[:-1], _RANGES[1:], _WIDE, strict=True))])
_PRIOR_WIDE = np.repeat(1 << _WIDE, np.diff(_RANGES))
# Both in whole numbers, so that all machines agree: 256 ln(p / (1 - p)) of a
# probability in 4096ths, and parts of _ONE at 256ths from -8 to 8.
_STRETCH = np.rint(256 * np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096)))
                   ).astype(np.int32)
_SQUASH = np.clip(np.rint(_ONE / (1 + np.exp(-np.arange(-2048, 2048) / 256))),
                  _LEAST, _ONE - _LEAST).astype(np.int32)


def _epochs(most: int) -> list[int]:
    """Positions at which the estimates are renewed."""
    ends = [0]
    while ends[-1] < most:
        ends.append(ends[-1] + min(max(ends[-1], 16), EPOCH))
    return ends[:-1]


def _odds(hits: np.ndarray, tries: np.ndarray) -> np.ndarray:
    """Stretched frequency of each context."""
    return _STRETCH.take(((2 * hits + 1) << 11) // (tries + 1))


class _Model:
    """Orders 2 and 1 of all lanes, and the steps shared by coding and decoding.

    Tables are flat, a lane's entries follow one another. Row 0 of a stacked
    array is order 2, row 1 order 1. A case is order 2's confidence, whether
    the orders agree, and order 1's confidence.
    """

    def __init__(self, lanes: int, most: int):
        self.entry = np.zeros(2 * lanes * _SLOTS, np.uint32)       # id | confidence << 16
        self.base = np.arange(2 * lanes).reshape(2, lanes) * _SLOTS
        self.lane = np.arange(lanes) * _CASES
        self.one = np.zeros(lanes, np.int64)       # the id before, and the one before it
        self.two = np.zeros(lanes, np.int64)
        # Of each case since the last renewal, and of each estimate: [tries, hits].
        width = min(most, EPOCH)
        self.cases = np.zeros((width, lanes), np.int32)
        self.kinds = np.zeros((width, lanes), np.uint8)            # 1 the guess, 2 the other id
        self.by2 = np.zeros((2, lanes, 8), np.int32)               # confidence
        self.by1 = np.zeros((2, lanes, 3, 8), np.int32)            # agreement, confidence
        self.own = np.zeros((2, lanes, 8), np.int32)               # confidence
        self.weight = np.full((2, lanes, 3), 39322, np.int64)      # in 65536ths, by agreement
        self.filled = 0
        self._mix(lanes)

    def renew(self, n: int) -> None:
        """Learn from the steps since the last renewal, for the first n lanes."""
        k, self.filled = self.filled, 0
        kind = self.cases[:k, :n] << 2
        kind += self.kinds[:k, :n]
        all_ = np.bincount(kind.ravel(), minlength=4 * n * _CASES).reshape(n, 8, 2, 8, 4)
        tries = (all_[..., 0] + all_[..., 1] + all_[..., 2]).astype(np.int32)
        hits, others = all_[..., 1].astype(np.int32), all_[..., 2].astype(np.int32)
        self._weigh(n, tries, hits)
        for kind, x in enumerate((tries, hits)):
            self.by2[kind, :n] += x.sum(axis=(2, 3), dtype=np.int32)
            self.by1[kind, :n, :2] += x[:, 1:].sum(axis=1, dtype=np.int32)
            self.by1[kind, :n, 2] += x[:, 0, 0]
        self.own[0, :n] += (tries - hits)[:, 1:, 0].sum(axis=1, dtype=np.int32)
        self.own[1, :n] += others[:, 1:, 0].sum(axis=1, dtype=np.int32)
        for x in (self.by2, self.by1, self.own):                   # forget slowly
            x[:, :n] >>= x[0, :n] > 255
        self._mix(n)

    def _weigh(self, n: int, tries: np.ndarray, hits: np.ndarray) -> None:
        """One damped Newton step of each weight, by the steps' coding errors."""
        p = self.mixed[:n] >> 12
        error = (hits << 12) - tries * p                           # 4096ths
        spread = tries * (p * (4096 - p) >> 12) >> 3               # 512ths
        for order, s in enumerate(x[:n] for x in self.s):
            slope, bend = error * (s >> 2), spread * (s * s >> 8)  # below 2**31 in an epoch
            for rows, at in ((slice(1, 8), 0), (slice(1, 8), 1), (slice(0, 1), 2)):
                part = (slice(None), rows, at % 2)
                up = slope[part].sum(axis=(1, 2), dtype=np.int64)
                down = bend[part].sum(axis=(1, 2), dtype=np.int64)
                self.weight[order, :n, at] += np.clip(
                    (up << 14) // (down + (16 << 17)), -1 << 15, 1 << 15)
        np.clip(self.weight, 0, 3 << 16, out=self.weight)

    def _mix(self, n: int) -> None:
        """Parts of ``_ONE`` by case: ``first`` for the guess, ``second`` for
        order 1's other id."""
        s1 = _odds(self.by1[1, :n], self.by1[0, :n])
        s1 = np.concatenate([s1[:, None, [2, 2]], np.broadcast_to(s1[:, None, :2], (n, 7, 2, 8))],
                            axis=1)
        s2 = _odds(self.by2[1, :n], self.by2[0, :n])[:, :, None, None]
        self.s = (s2, s1)
        of = np.array([[2, 2]] + 7 * [[0, 1]])
        w2, w1 = (w[:n, of, None].astype(np.int32) >> 4 for w in self.weight)
        x = (w2 * s2 + w1 * s1) >> 12
        self.mixed = _SQUASH.take(np.clip(x, -2048, 2047) + 2048)
        rest = _ONE - self.mixed
        own = ((2 * self.own[1, :n] + 1) << 15) // (self.own[0, :n] + 1)
        second = np.zeros_like(self.mixed)
        second[:, 1:, 0, 1:] = np.minimum(
            (rest >> 8)[:, 1:, 0, 1:] * (own[:, None, 1:] >> 8), rest[:, 1:, 0, 1:] - _ROOM)
        self.parts = (second.astype(np.int64) << 32 | self.mixed).ravel()

    def predict(self, n: int) -> None:
        """Predictions for the first n lanes and their parts of ``_ONE``:
        ``first`` for ``guess``, ``second`` for ``other``."""
        one = self.one[:n] * 40503
        at = np.empty((2, n), np.int64)
        np.right_shift(one, 4, out=at[1])
        one += self.two[:n] * 60493
        np.right_shift(one, 5, out=at[0])
        at &= _SLOTS - 1
        at += self.base[:, :n]
        self.at = at
        self.now = now = self.entry.take(at)
        self.id = now & np.uint32(0xFFFF)
        sure = now >> np.uint32(16)
        second, self.other = self.id
        known = sure[0] > 0
        self.guess = self.other.copy()
        np.copyto(self.guess, second, where=known)
        case = sure[0] << np.uint32(4)
        case |= sure[1]
        case |= ((second == self.other) & known).view(np.uint8) << np.uint8(3)
        self.case = case + self.lane[:n]
        both = self.parts.take(self.case)
        self.first = both & 0xFFFFFFFF
        self.second = both >> 32

    def learn(self, value: np.ndarray, hit: np.ndarray, other: np.ndarray) -> None:
        """Take in the ids ``value`` (uint32) of the lanes predicted last."""
        n = len(value)
        self.cases[self.filled, :n] = self.case
        self.kinds[self.filled, :n] = hit
        self.kinds[self.filled, :n] += other.view(np.uint8) << np.uint8(1)
        self.filled += 1
        # Right: one surer, up to 7. Wrong: half as sure, and below 4 the id goes.
        now, ids = self.now, self.id
        new = now >> np.uint32(1)
        new &= np.uint32(3 << 16)
        new |= ids
        np.copyto(new, value | np.uint32(1 << 16), where=now < np.uint32(4 << 16))
        np.copyto(new, np.minimum(now + np.uint32(1 << 16), ids | np.uint32(7 << 16)),
                  where=ids == value)
        self.entry[self.at.ravel()] = new.ravel()
        self.two[:n] = self.one[:n]
        self.one[:n] = value


class _Writer:
    def __init__(self, lanes: int, words: int):
        """``words``: words per lane to begin with; the buffer grows."""
        self.low = np.zeros(lanes, np.uint64)
        self.width = np.full(lanes, 2**63 - 1, np.uint64)
        self.words = np.zeros((lanes, words), np.uint64)
        self.begin = np.arange(lanes) * words      # of a lane's words
        self.at = self.begin.copy()                # its next one

    def reserve(self, more: int) -> None:
        """Room for ``more`` words in every lane."""
        if int((self.at - self.begin).max()) + more > self.words.shape[1]:
            self.at += self.begin
            self.begin *= 2
            self.words = np.concatenate([self.words, np.zeros_like(self.words)], axis=1)

    def put(self, lane, begin: np.ndarray, size: np.ndarray) -> None:
        """Code the part [begin, begin + size) of ``_ONE`` in the given lanes
        (a slice or their numbers)."""
        unit = self.width[lane] >> _BITS
        low = self.low[lane] + unit * begin.view(np.uint64)
        unit *= size.view(np.uint64)
        at = self.at[lane]
        self.words.ravel()[at] = low >> np.uint64(31)      # written over if it isn't full
        short = (unit < _SHORT).view(np.uint8)
        self.at[lane] = at + short
        move = short.astype(np.uint64) << np.uint64(5)
        self.width[lane] = unit << move
        self.low[lane] = (low & _KEPT.take(short)) << move

    def finish(self) -> list[bytes]:
        # Of the last interval, the number whose lower bits are zero.
        self.words.ravel()[self.at] = (self.low + np.uint64(2**31 - 1)) >> np.uint64(31)
        size = self.at + 1 - self.begin
        for k in range(int(size.max()) - 1, 0, -1):        # carries
            self.words[:, k - 1] += self.words[:, k] >> np.uint64(32)
        return [self.words[i, :n].astype("<u4").tobytes() for i, n in enumerate(size)]


class _Reader:
    def __init__(self, blocks: list[bytes]):
        most = max(map(len, blocks)) // 4 + 2
        words = np.zeros((len(blocks), most), np.uint64)
        for i, b in enumerate(blocks):
            words[i, :len(b) // 4] = np.frombuffer(b, "<u4", len(b) // 4)
        self.code = (words[:, 0] << np.uint64(31)) | (words[:, 1] >> np.uint64(1))
        # The code has 63 bits, so it takes the last bit of a word with the next one.
        words[:, :-1] = ((words[:, :-1] & np.uint64(1)) << np.uint64(31)
                         | words[:, 1:] >> np.uint64(1))
        self.words = words.astype(np.uint32).ravel()
        self.at = np.arange(len(blocks)) * most + 1
        self.width = np.full(len(blocks), 2**63 - 1, np.uint64)

    def take(self, lane, unit: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        code = self.code[lane] - unit * begin.view(np.uint64)
        width = unit * size.view(np.uint64)
        at = self.at[lane]
        word = self.words.take(at, mode="clip")
        short = width < _SHORT
        self.at[lane] = at + short
        move = short.astype(np.uint64) << np.uint64(5)
        word *= short
        code <<= move
        code |= word
        self.code[lane], self.width[lane] = code, width << move


class _Counts:
    """Order 0: how often each lane's ids came in its first ``seen`` positions.

    Of ``seen`` + distinct ids equal parts, an id has as many as it came times,
    in ascending order of ids; the parts from ``seen`` on are the escape.
    """

    def __init__(self, seen: int, distinct: np.ndarray):
        self.seen = seen
        self.share = 1 / np.maximum(seen + distinct, 1)

    def part(self, edge: np.ndarray) -> np.ndarray:
        """One part, where order 0 has what is left from ``edge`` on."""
        return ((_ONE - edge) * self.share[:len(edge)]).astype(np.int64)


class _KnownCounts:
    """Order 0 for coding, from the ranks of each lane's ids."""

    def __init__(self, ids: np.ndarray):
        """``ids``: lanes x positions."""
        lanes, most = ids.shape
        if most > BLOCK:
            raise ValueError("a block is too long")
        self.at = np.empty((most, lanes), np.int32)
        for a in range(0, lanes, 64):              # small sorts
            key = ids[a:a + 64].astype(np.uint32) << np.uint32(16)
            key |= np.arange(most, dtype=np.uint32)
            key.sort(axis=1)
            new = np.zeros(key.shape, np.int32)
            new[:, 1:] = (key[:, 1:] ^ key[:, :-1]) > 0xFFFF
            place = (key & np.uint32(0xFFFF)).astype(np.int64)
            place += np.arange(len(key))[:, None] * most
            rank = np.empty(key.size, np.int32)
            rank[place] = new.cumsum(axis=1, dtype=np.int32)
            self.at[:, a:a + 64] = rank.reshape(key.shape).T
        self.wide = int(self.at.max()) + 1
        self.at += np.arange(lanes, dtype=np.int32) * self.wide
        self.count = np.zeros((lanes, self.wide), np.int32)
        self.done = 0

    def until(self, begin: int, end: int, n: int) -> _Counts:
        """Counts of the positions before ``begin``; ``left`` and ``count`` of the
        ids from there to ``end``."""
        more = self.at[self.done:begin, :n].ravel()
        self.count[:n] += np.bincount(more, minlength=n * self.wide).reshape(n, -1)
        self.done = begin
        count = self.count[:n]
        out = _Counts(begin, np.count_nonzero(count, axis=1))
        at = self.at[begin:end, :n]
        out.count = count.take(at)
        left = np.cumsum(count, axis=1, dtype=np.int32)
        left -= count
        out.left = np.where(out.count > 0, left.take(at), begin)
        return out


def _found_counts(ids: np.ndarray) -> _Counts:
    """Order 0 for decoding, from the ids so far (lanes x positions). ``places``
    has of each part the id, its first part and its number of parts."""
    lanes, seen = ids.shape
    if not seen:
        out = _Counts(0, np.zeros(lanes, np.int64))
        out.places = np.zeros(lanes, np.int64)
        return out
    one = np.sort(ids, axis=1)
    new = np.ones(one.shape, bool)
    np.not_equal(one[:, 1:], one[:, :-1], out=new[:, 1:])
    out = _Counts(seen, np.count_nonzero(new, axis=1))
    start = new.ravel().nonzero()[0]
    size = np.diff(start, append=new.size)
    out.places = np.repeat(one.ravel()[start] | (start % seen) << 16 | size << 40, size)
    return out


def _coded(size: np.ndarray, ids: np.ndarray) -> list[bytes]:
    """Code ``ids`` (lanes x positions, longest lane first)."""
    lanes, most = ids.shape
    model, order0 = _Model(lanes, most), _KnownCounts(ids)
    rows = np.ascontiguousarray(ids.T)
    writer = _Writer(lanes, most // 3 + 64)
    running = lanes - np.searchsorted(size[::-1], np.arange(most), side="right")
    ends = _epochs(most)
    for begin, end in zip(ends, [*ends[1:], most], strict=True):
        if begin:
            model.renew(int(running[begin]))
        counts = order0.until(begin, end, int(running[begin]))
        for t in range(begin, end):
            n = int(running[t])
            if t % 8 == 0:
                writer.reserve(8 * 2 + 1)         # an id has two steps at most
            model.predict(n)
            value = rows[t, :n].astype(np.uint32)
            first, second = model.first, model.second
            hit = model.guess == value
            other = (model.other == value) & (second > 0)
            edge = first + second
            part = counts.part(edge)
            left, count = counts.left[t - begin, :n], counts.count[t - begin, :n]
            new = count == 0
            start, wide = left * part, count * part
            start += edge
            np.copyto(wide, _ONE - start, where=new)       # an escape takes the rest
            for kind, a, b in ((other, first, second), (hit, 0, first)):
                np.copyto(start, a, where=kind)
                np.copyto(wide, b, where=kind)
            writer.put(slice(0, n), start, wide)
            new &= ~(hit | other)
            lost = new.nonzero()[0]
            if len(lost):
                at = value[lost]
                writer.put(lost, _PRIOR.take(at), _PRIOR_WIDE.take(at))
            model.learn(value, hit, other)
    return writer.finish()


def _decoded(size: np.ndarray, reader: _Reader) -> np.ndarray:
    """The ids (lanes x positions) of the lanes, longest first."""
    lanes, most = len(size), int(size[0])
    model = _Model(lanes, most)
    rows, known, done = np.zeros((most, lanes), np.uint16), np.zeros((lanes, most), np.uint16), 0
    running = lanes - np.searchsorted(size[::-1], np.arange(most), side="right")
    ends = _epochs(most)
    for begin, end in zip(ends, [*ends[1:], most], strict=True):
        if begin:
            model.renew(int(running[begin]))
        known[:, done:begin] = rows[done:begin].T
        done = begin
        counts = _found_counts(known[:int(running[begin]), :begin])
        base = np.arange(lanes) * begin
        for t in range(begin, end):
            n = int(running[t])
            model.predict(n)
            first, second = model.first, model.second
            unit, code = reader.width[:n] >> _BITS, reader.code[:n]
            hit = code < first.view(np.uint64) * unit
            edge = first + second
            after = edge.view(np.uint64) * unit
            miss = code >= after
            part = counts.part(edge)
            # Numbers of parts; of no meaning, but in bounds, where it is a hit.
            place = (code - after) // (unit * part.view(np.uint64))
            new = place >= begin
            np.copyto(place, 0, where=new)
            found = counts.places.take(place.view(np.int64) + base[:n])
            value = (found & 0xFFFF).astype(np.uint32)
            start = found >> 16 & 0xFFFFFF
            np.copyto(start, begin, where=new)
            start *= part
            start += edge
            wide = (found >> 40) * part
            np.copyto(wide, _ONE - start, where=new)
            other = ~(hit | miss)
            for kind, ids, a, b in ((other, model.other, first, second),
                                    (hit, model.guess, 0, first)):
                np.copyto(value, ids, where=kind)
                np.copyto(start, a, where=kind)
                np.copyto(wide, b, where=kind)
            reader.take(slice(0, n), unit, start, wide)
            new &= miss
            lost = new.nonzero()[0]
            if len(lost):
                unit = reader.width[lost] >> _BITS
                place = (reader.code[lost] // unit).view(np.int64)
                kind = place >> 20
                wide = _WIDE.take(kind)
                place = (place & (1 << 20) - 1) >> wide
                id_ = place + _RANGES.take(kind)
                reader.take(lost, unit, _PRIOR.take(id_), np.left_shift(1, wide))
                value[lost] = id_
            rows[t, :n] = value
            model.learn(value, hit, other)
    known[:, done:] = rows[done:].T
    return known


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Coded bytes of each (non-empty) block of ids."""
    out: list[bytes] = [b""] * len(blocks)
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    for a in range(0, len(order), LANES):
        group = order[a:a + LANES]
        size = np.array([len(blocks[i]) for i in group])
        ids = np.zeros((len(group), int(size[0])), np.uint16)
        for k, i in enumerate(group):
            if blocks[i].max() > 0xFFFF or blocks[i].min() < 0:
                raise ValueError("ids must be below 65536")
            ids[k, :size[k]] = blocks[i]
        for i, data in zip(group, _coded(size, ids), strict=True):
            out[i] = data
    return out


def decode_blocks(coded: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block."""
    out: list[np.ndarray] = [np.zeros(0, np.uint16)] * len(coded)
    order = sorted(range(len(coded)), key=lambda i: -sizes[i])
    for a in range(0, len(order), LANES):
        group = order[a:a + LANES]
        size = np.array([sizes[i] for i in group])
        ids = _decoded(size, _Reader([coded[i] for i in group]))
        for k, i in enumerate(group):
            out[i] = ids[k, :size[k]]
    return out


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def pack(chunks: list[np.ndarray]) -> list[bytes]:
    """Payload of each chunk of ids; all blocks are coded in step."""
    blocks = [[c[a:a + BLOCK] for a in range(0, len(c), BLOCK)] for c in chunks]
    coded = iter(encode_blocks([b for chunk in blocks for b in chunk]))
    out = []
    for chunk in blocks:
        data = [next(coded) for _ in chunk]
        heads = [struct.pack("<4I", len(b), len(d), zlib.crc32(d), _crc(b))
                 for b, d in zip(chunk, data, strict=True)]
        out.append(MAGIC + struct.pack("<I", len(chunk)) + b"".join(heads) + b"".join(data))
    return out


def unpack(payloads: list[bytes]) -> list[np.ndarray]:
    """Ids of each payload; raises ``ValueError`` on a damaged one."""
    coded, sizes, sums, per = [], [], [], []
    for p in payloads:
        if p[:4] != MAGIC or len(p) < 8:
            raise ValueError("not an id payload")
        n = struct.unpack_from("<I", p, 4)[0]
        at = 8 + 16 * n
        if at > len(p):
            raise ValueError("a payload is cut short")
        for k in range(n):
            size, length, crc, ids_crc = struct.unpack_from("<4I", p, 8 + 16 * k)
            data = p[at:at + length]
            if zlib.crc32(data) != crc or len(data) != length:
                raise ValueError(f"block {k} is damaged")
            coded.append(data)
            sizes.append(size)
            sums.append(ids_crc)
            at += length
        per.append(n)
    blocks = decode_blocks(coded, sizes)
    for k, (b, crc) in enumerate(zip(blocks, sums, strict=True)):
        if _crc(b) != crc:
            raise ValueError(f"block {k} does not decode to its ids")
    ends = np.cumsum([0, *per])
    return [np.concatenate([np.zeros(0, np.uint16), *blocks[a:b]])
            for a, b in zip(ends[:-1], ends[1:], strict=True)]


def write_ids(docs: DataFrame, path: str, tokenizer: str = TOKENIZER) -> None:
    """Encode every whole text, append ``END_ID``, and write the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number, held = 0, 0
        ids: list[list[np.ndarray]] = [[]]
        docs_of: list[list] = [[]]
        size = 0

        def rows():
            nonlocal number
            chunks = [np.concatenate(c) for c in ids if c]
            names = [d for d in docs_of if d]
            out = pa.record_batch(
                [pa.array(np.full(len(chunks), part, np.int32)),
                 pa.array(np.arange(number, number + len(chunks), dtype=np.int32)),
                 pa.array(names, pa.list_(pa.int64())),
                 pa.array([[len(x) for x in c] for c in ids if c], pa.list_(pa.int32())),
                 pa.array([len(c) for c in chunks], pa.int64()),
                 pa.array(pack(chunks), pa.binary())],
                names=["part", "chunk", "doc_ids", "doc_tokens", "n_tokens", "payload"])
            number += len(chunks)
            ids[:], docs_of[:] = [[]], [[]]
            return out

        coder = latin_codec(tokenizer, added=True)
        coder.kept = CACHE_PRETOKENS   # the blocks take memory too
        for batch in batches:
            texts, names = batch.column(1), batch.column(0).to_pylist()
            for a, b in slices(texts):
                flat, count = coder.encode(texts.slice(a, b - a).to_pylist())
                for k, one in enumerate(np.split(flat, np.cumsum(count)[:-1])):
                    if size and size + len(one) + 1 > CHUNK:
                        ids.append([])
                        docs_of.append([])
                        size = 0
                        if held >= LANES * BLOCK:
                            yield rows()
                            held = 0
                    ids[-1].append(np.append(one, END_ID).astype(np.uint16))
                    docs_of[-1].append(names[a + k])
                    size += len(one) + 1
                    held += len(one) + 1
        if held:
            yield rows()

    python_batches(docs.sparkSession)
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce("text", F.lit("")).alias("text"))
    # Bounds by id and the text's beginning: whole texts would pass the driver.
    (picked.repartitionByRange("doc_id", F.substring("text", 1, BOUND_CHARS))
     .sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, FILE_SCHEMA).write.parquet(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (array<int>) of every document in the files."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))      # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = files.select("part", "chunk", "n_tokens").withColumn(
        "chunk_start", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).drop("n_tokens")
    starts = chunks.join(F.broadcast(parts), "part").select(
        "part", "chunk", (F.col("part_start") + F.col("chunk_start")).alias("start"))
    placed = files.join(starts, ["part", "chunk"]).select("doc_ids", "doc_tokens", "payload", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        latin_codec.cache_clear()      # a worker may hold the writer's pre-tokens still
        held: list[pa.RecordBatch] = []
        most, rows = max(1, LANES * BLOCK // CHUNK), 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, most - rows))
                at, rows = at + held[-1].num_rows, rows + held[-1].num_rows
                if rows == most:
                    yield from decoded(pa.Table.from_batches(held))
                    held.clear()
                    rows = 0
        if held:
            yield from decoded(pa.Table.from_batches(held))

    def decoded(table: pa.Table) -> Iterator[pa.RecordBatch]:
        chunks = unpack(table.column("payload").to_pylist())
        for ids, docs, count, start in zip(chunks, table.column("doc_ids").to_pylist(),
                                           table.column("doc_tokens").to_pylist(),
                                           table.column("start").to_pylist(), strict=True):
            ends = np.cumsum(np.array([0, *count], np.int64))
            yield pa.record_batch(
                [pa.array(docs, pa.int64()), pa.array(ends[:-1] + start),
                 pa.array(np.diff(ends)), pa.ListArray.from_arrays(
                     pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                names=["doc_id", "start", "n_tokens", "ids"])

    python_batches(spark)
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids array<int>")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the ids of all documents and read them back: doc_id, start,
    n_tokens, ids_crc32."""
    path = path or scratch(docs.sparkSession, "ids")
    write_ids(docs, path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("ids")
        off = lists.offsets.to_numpy()
        data = lists.values.to_numpy().astype("<u4")
        crc = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(off[:-1], off[1:], strict=True)]
        return pa.record_batch([*batch.columns[:3], pa.array(crc, pa.int64())],
                               names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_arrow(read_ids(docs.sparkSession, path), run,
                     "doc_id long, start long, n_tokens long, ids_crc32 long")
