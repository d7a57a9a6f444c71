"""Quality rules with line labelling by a linear-chain conditional random field.

A text's lines (split at line feeds, blank ones left out) form a sequence;
each is *content* or *boilerplate*. The field has a weight per label and line
feature and a weight per pair of neighbouring labels. Viterbi decoding gives
the best labelling, and a document is kept if content lines hold at least
``LEAST_SHARE`` of its words (and the base rules pass).

Training data has one label per document, not per line. Lines of documents of
quality 1 are content; lines of quality 0 start as boilerplate and are
relabelled by the field fitted so far (``ROUNDS`` rounds), so ordinary lines
in bad documents become content; each keeps its likeliest boilerplate line. The fit uses at most ``SAMPLE`` labelled
documents, those with the smallest hash of their id; their line features go
to the driver, where the weights are found by gradient steps on the penalised
log-likelihood. Everything else covers all documents.

Words are runs of bytes other than space and \\x09-\\x0D. Windows of three
words are compared by 64-bit hash within one text.

Edge cases: null and empty texts have no words or lines and fail the base
rules. Repeated documents are judged one by one. If no usable labels exist
(or only one kind), every line counts as content. Only doc_id, text and the
labels' doc_id and quality are read, so other names cannot clash.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import WordTable, map_arrow, rolling, slices

SAMPLE = 2000
SAMPLE_LINES = 2000
ROUNDS = 2
STEPS = 200
PIECE = 32
PENALTY = 1e-5
LEAST_SHARE = 0.5
SYMBOLS = "#*$%&|<>"          # fixed values: the base rule's symbols
FEATURES = ("bias", "symbols_1", "symbols_5", "bars", "capitals_50", "capitals_90", "exclaimed_2",
            "digits_5", "digits_20", "letters_below_60", "short_1", "short_3", "short_8",
            "ends_stop", "long_words", "repeated_line", "repeated_words_50", "first", "last")


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Bits per code point: 1 letter, 2 capital, 4 digit, 8 symbol, 16 blank, 32 line feed."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        out[i] = c.isalpha() | c.isupper() << 1 | c.isdigit() << 2
    out[[ord(c) for c in SYMBOLS]] |= 8
    out[[0x20, *range(0x09, 0x0E)]] |= 16
    out[0x0A] |= 32
    return out


@dataclass
class Lines:
    """Base counts per text and features per non-blank line of a slice."""
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    row: np.ndarray             # text of each line
    words: np.ndarray           # words of each line
    x: np.ndarray               # features of each line


def repeated_words(table: WordTable) -> np.ndarray:
    """Which words lie in a three-word window found twice or more in their text."""
    out = np.zeros(len(table), bool)
    h = table.hash()
    if len(h) < 3:
        return out
    row = table.doc
    at = np.flatnonzero(row[2:] == row[:-2])
    grams = rolling(h, 3)[at]
    order = np.lexsort((grams, row[at]))
    g, r = grams[order], row[at][order]
    same = (g[1:] == g[:-1]) & (r[1:] == r[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    place = at[order[twice]]
    for k in range(3):
        out[place + k] = True
    return out


def describe(texts: list[str]) -> Lines:
    """Counts and features of whole texts."""
    rows = len(texts)
    col = pa.array(texts, pa.large_string())
    table = WordTable(col)
    again = repeated_words(table)
    n_words = np.diff(table.first)
    n_repeat = np.bincount(table.doc, again, rows).astype(np.int64)
    cp = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, texts), np.int64, rows)
    kind = classes()[cp]
    owner = np.repeat(np.arange(rows), size)
    per_row = lambda flag: np.bincount(owner, flag, rows).astype(np.int64)
    blank = (kind & 16) > 0
    # Lines: a new one at each row's start and after each line feed.
    feed = (kind & 32) > 0
    line = np.cumsum(feed) - feed + owner           # number of each character's line
    total = int(feed.sum()) + rows
    first_line = np.concatenate([[0], np.cumsum(np.bincount(owner, feed, rows).astype(np.int64) + 1)])
    line_row = np.repeat(np.arange(rows), np.diff(first_line))
    per_line = lambda flag: np.bincount(line, flag, total).astype(np.int64)
    chars = per_line(~blank)
    # Words of a line: by the line feeds before a word's first byte.
    feeds = np.cumsum(np.concatenate([[0], table.data == 0x0A]))
    word_line = feeds[table.start] + table.doc if len(table) else np.zeros(0, np.int64)
    words = np.bincount(word_line, minlength=total).astype(np.int64)
    repeats = np.bincount(word_line, again, total)
    dup = np.zeros(total, bool)
    for r, text in enumerate(texts):
        seen: set[str] = set()
        for k, one in enumerate(text.split("\n"), int(first_line[r])):
            if words[k]:
                if one in seen:
                    dup[k] = True
                seen.add(one)
    use = np.flatnonzero(words)
    letters, capitals, digits, symbols = (per_line((kind & b) > 0)[use] for b in (1, 2, 4, 8))
    bars, shouts = per_line(cp == ord("|"))[use], per_line(cp == ord("!"))[use]
    last_char = np.zeros(total, np.uint32)
    solid = np.flatnonzero(~blank)
    last_char[line[solid]] = cp[solid]              # the last write stays
    c, w, row = chars[use], words[use], line_row[use]
    new_row = np.concatenate([[True], np.diff(row) != 0]) if len(row) else np.zeros(0, bool)
    x = np.stack([
        np.ones(len(use)), symbols > 0.01 * c, symbols > 0.05 * c, bars * 10 > w,
        capitals * 2 > letters, capitals > 0.9 * letters, shouts * 5 > w, digits > 0.05 * c,
        digits > 0.2 * c, letters < 0.6 * c, w <= 1, w <= 3, w <= 8,
        np.isin(last_char[use], [ord(s) for s in ".!?"]), c > 9 * w, dup[use],
        repeats[use] * 2 > w, new_row, np.append(new_row[1:], True) if len(row) else new_row,
    ], axis=1).astype(np.float32)
    return Lines(n_words, per_row(~blank), per_row((kind & 8) > 0),
                 np.bincount(line_row, dup, rows).astype(np.int64), n_repeat, row, w, x)


@dataclass
class Field:
    """Weights of the two labels (0 content, 1 boilerplate)."""
    label: np.ndarray          # features x 2
    pair: np.ndarray           # label before x label after


@dataclass
class Steps:
    """Sequences laid out by position, longest first."""
    at: list[np.ndarray]       # lines at each position, one per sequence still running

    @classmethod
    def of(cls, row: np.ndarray) -> Steps:
        if not len(row):
            return cls([])
        head = np.flatnonzero(np.concatenate([[True], np.diff(row) != 0]))
        size = np.diff(np.append(head, len(row)))
        head = head[np.argsort(-size, kind="stable")]
        running = np.cumsum(np.bincount(size, minlength=size.max() + 1)[::-1])[::-1]
        return cls([head[:running[t + 1]] + t for t in range(int(size.max()))])


def viterbi(field: Field, x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The best label of each line."""
    score = x @ field.label
    steps = Steps.of(row).at
    best, back = [], []
    for t, at in enumerate(steps):
        s = score[at]
        if t:
            ways = best[-1][:len(at), :, None] + field.pair[None]
            back.append(ways.argmax(axis=1))
            s = s + ways.max(axis=1)
        best.append(s)
    out = np.zeros(len(x), np.int64)
    label = np.zeros(0, np.int64)
    for t in range(len(steps) - 1, -1, -1):
        ending = best[t][len(label):].argmax(axis=1)      # sequences whose last line is here
        label = np.concatenate([label, ending])
        out[steps[t]] = label
        if t:
            label = np.take_along_axis(back[t - 1], label[:, None], axis=1)[:, 0]
    return out


def marginals(field: Field, x: np.ndarray, row: np.ndarray):
    """P(label) per line, expected label pairs, and the log partition sum."""
    score = x @ field.label
    steps = Steps.of(row).at
    add = lambda v, axis: np.logaddexp(*np.moveaxis(v, axis, 0))
    alpha = [score[steps[0]]]
    for at in steps[1:]:
        alpha.append(score[at] + add(alpha[-1][:len(at), :, None] + field.pair[None], 1))
    beta = [np.zeros((len(at), 2)) for at in steps]
    total = np.empty(len(steps[0]))
    for t in range(len(steps) - 1, -1, -1):
        more = len(steps[t + 1]) if t + 1 < len(steps) else 0
        if more:
            nxt = (score[steps[t + 1]] + beta[t + 1])[:, None, :] + field.pair[None]
            beta[t][:more] = add(nxt, 2)
        total[more:len(steps[t])] = add(alpha[t][more:], 1)
    p = np.empty((len(x), 2))
    pairs = np.zeros((2, 2))
    for t, at in enumerate(steps):
        p[at] = np.exp(alpha[t] + beta[t] - total[:len(at), None])
        if t:
            joint = (alpha[t - 1][:len(at), :, None] + field.pair[None]
                     + (score[at] + beta[t])[:, None, :] - total[:len(at), None, None])
            pairs += np.exp(joint).sum(axis=0)
    return p, pairs, float(total.sum())


def fit(x: np.ndarray, row: np.ndarray, label: np.ndarray, steps: int = STEPS) -> Field:
    """Weights by gradient steps with momentum and per-weight scaling (Adam)."""
    field = Field(np.zeros((x.shape[1], 2)), np.zeros((2, 2)))
    hard = np.eye(2)[label]
    near = row[1:] == row[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[:-1][near], label[1:][near]), 1)
    first = [np.zeros_like(field.label), np.zeros_like(field.pair)]
    second = [np.zeros_like(field.label), np.zeros_like(field.pair)]
    for step in range(1, steps + 1):
        p, pairs, _ = marginals(field, x, row)
        grads = (x.T @ (hard - p) / len(x) - PENALTY * field.label,
                 (seen - pairs) / len(x) - PENALTY * field.pair)
        for k, (w, g) in enumerate(zip((field.label, field.pair), grads, strict=True)):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            w += 0.15 * (first[k] / (1 - 0.9**step)) / (
                np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return field


def train_lines(x: np.ndarray, row: np.ndarray, good: np.ndarray, rounds: int = ROUNDS) -> Field:
    """Fit from document labels (``good`` per line), relabelling bad documents' lines."""
    if not len(x) or good.all() or not good.any():
        return Field(np.zeros((len(FEATURES), 2)), np.zeros((2, 2)))
    # Long sequences are fitted in pieces of PIECE lines (all of them).
    head = np.flatnonzero(np.concatenate([[True], np.diff(row) != 0]))
    size = np.diff(np.append(head, len(row)))
    inside = np.arange(len(row)) - np.repeat(head, size)
    piece = np.cumsum(inside % PIECE == 0)
    label = np.where(good, 0, 1)
    for _ in range(rounds):
        p, _, _ = marginals(fit(x, piece, label), x, piece)
        bad = p[:, 1]
        # A bad document has at least one boilerplate line: its likeliest.
        likeliest = bad >= np.repeat(np.maximum.reduceat(bad, head), size)
        label = np.where(good, 0, ((bad >= 0.5) | likeliest).astype(int))
    return fit(x, piece, label)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """Fit on at most ``sample`` labelled documents (smallest id hashes), also
    where ids repeat; documents of more than ``SAMPLE_LINES`` lines are not fitted on."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
              .select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64("__id"), "__id", "quality").limit(sample))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for a, b in slices(batch.column(1)):
            got = describe(batch.column(1).slice(a, b - a).to_pylist())
            bits = got.x.astype(bool) @ (1 << np.arange(len(FEATURES)))
            out.append((got.row + a, bits))
        row, bits = (np.concatenate(v) for v in zip(*out, strict=True))
        order = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
        lines = pa.ListArray.from_arrays(pa.array(order), pa.array(bits.astype(np.int32)))
        return pa.record_batch([batch.column(0), batch.column(2), lines],
                               names=["doc_id", "quality", "lines"])

    joined = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), "quality")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = map_arrow(joined, run, f"doc_id {kind}, quality int, lines array<int>")
    got = (rows.where(F.size("lines") <= SAMPLE_LINES)
           .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "lines").limit(sample)
           .orderBy("doc_id", "quality", "lines").toArrow())
    lists = got.column("lines").combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    bits = lists.flatten().to_numpy(zero_copy_only=False)
    x = ((bits[:, None] >> np.arange(len(FEATURES))) & 1).astype(float)
    row = np.repeat(np.arange(len(size)), size)
    good = np.repeat(got.column("quality").to_numpy() == 1, size)
    return train_lines(x, row, good)


def judge(docs: DataFrame, field: Field) -> DataFrame:
    """Base counts, content share and verdict of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for a, b in slices(batch.column(1)):
            got = describe(batch.column(1).slice(a, b - a).to_pylist())
            label = viterbi(field, got.x, got.row)
            content = np.bincount(got.row, got.words * (label == 0), b - a)
            parts.append((got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines,
                          got.n_repeat_words, content.astype(np.int64),
                          np.bincount(got.row, minlength=b - a), np.bincount(got.row, label, b - a)))
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 "content_words", "n_lines", "n_boilerplate_lines"]
        cols = [pa.array(np.concatenate(v).astype(np.int64)) for v in zip(*parts, strict=True)]
        return pa.record_batch([batch.column(0), *cols], names=["doc_id", *names])

    picked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = map_arrow(picked, run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, "
                       "n_dup_lines long, n_repeat_words long, content_words long, n_lines long, "
                       "n_boilerplate_lines long")
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    share = F.when(n > 0, F.col("content_words") / n).otherwise(F.lit(0.0))
    return counts.select("*", failed.alias("base_failed"), share.alias("content_share"),
                         (~failed & (share >= LEAST_SHARE)).alias("kept"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, train(docs, labels))
