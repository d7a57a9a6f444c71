"""Token counts that follow edits.

Each document keeps a segment tree over its pre-tokens: a leaf covers up to
``LEAF`` consecutive pre-tokens, and every node holds the characters and the
tokens below it (arrays in heap order, root at 1). The root's tokens are the
document's count.

An edit replaces characters [start, stop) by a text. The tree finds the leaf
that holds the character ``reach`` before the edit (a pre-token's end depends
on at most two characters after it, or on an added token's length) and the
leaf that holds its end. Only the text
from the first leaf on is cut anew, until a cut falls on an old leaf's end
behind the edit: cuts depend on nothing before them, so all later ones stand.
The re-encoded leaves are replaced and the sums above them updated.

Edge cases: a null text is empty and has no tokens; edits are clamped to the
text, in order of ``seq`` (then position); a document without edits keeps its
count; an empty table gives no rows. Repeated documents each keep their own
tree and get all edits of their id. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import map_arrow, slices
from quayside.llm.pretokens import TOKENIZER, codec

LEAF = 64
EDIT = "struct<seq:int,start:int,stop:int,text:string>"
TREE = "chars array<int>, tokens array<int>"


def tree_of(leaves: np.ndarray) -> np.ndarray:
    """Sums in heap order over leaves padded to a power of two."""
    width = 1 << max(len(leaves) - 1, 0).bit_length()
    tree = np.zeros(2 * width, np.int32)
    tree[width:width + len(leaves)] = leaves
    while width > 1:
        half = width // 2
        tree[half:width] = tree[width:2 * width:2] + tree[width + 1:2 * width:2]
        width = half
    return tree


class CountedText:
    """A text with its trees; ``replace`` applies one edit."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray, coder):
        self.text, self.coder = text, coder
        self.chars, self.tokens = chars.tolist(), tokens.tolist()
        self.encoded = 0                       # pre-tokens cut and encoded by edits

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def _find(self, at: int) -> tuple[int, int]:
        """(node, begin) of the leaf that holds character ``at``."""
        node, begin, width = 1, 0, len(self.chars) // 2
        while node < width:
            node *= 2
            if at - begin >= self.chars[node]:
                begin += self.chars[node]
                node += 1
        return node, begin

    def replace(self, start: int, stop: int, new: str) -> None:
        n = len(self.text)
        start = min(max(start, 0), n)
        stop = min(max(stop, start), n)
        first, begin = self._find(max(start - self.coder.reach, 0))
        last, end = self._find(stop)
        end += self.chars[last]
        shift = len(new) - (stop - start)
        self.text = text = self.text[:start] + new + self.text[stop:]
        pretokens = self.coder.pretokens(text[begin:end + shift + self.coder.reach])
        length = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        stops = begin + np.cumsum(length)
        met = int(np.searchsorted(stops, end + shift))
        if end + shift == begin:
            pretokens, length = [], length[:0]
        elif met < len(stops) and stops[met] == end + shift:
            pretokens, length = pretokens[:met + 1], length[:met + 1]
        else:                                  # one crosses the leaf's end
            pretokens, last = self._cut_on(begin, last, end, shift)
            length = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        self.encoded += len(pretokens)
        sizes = self.coder.sizes(pretokens)
        if len(pretokens) > 4 * LEAF:
            self._rebuild(first, last, length, sizes)
            return
        for node in range(first, last + 1):
            self.chars[node] = self.tokens[node] = 0
        self.chars[first], self.tokens[first] = int(length.sum()), int(sizes.sum())
        low, high = first // 2, last // 2
        while low:
            for node in range(low, high + 1):
                self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
                self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
            low, high = low // 2, high // 2

    def _cut_on(self, begin: int, last: int, end: int, shift: int) -> tuple[list[str], int]:
        """Pre-tokens from ``begin`` until one ends where an old leaf did, and
        that leaf; ``end``: the old end of leaf ``last``."""
        pretokens, at = [], begin
        for pretoken in self.coder.each(self.text, begin):
            while at > end + shift:
                last += 1
                end += self.chars[last]
            if at == end + shift and pretokens:
                return pretokens, last
            pretokens.append(pretoken)
            at += len(pretoken)
        return pretokens, len(self.chars) - 1  # cut to the text's end

    def _rebuild(self, first: int, last: int, length: np.ndarray, sizes: np.ndarray) -> None:
        width = len(self.chars) // 2
        cut = np.arange(0, len(length), LEAF)
        leaves = []
        for tree, new in ((self.chars, length), (self.tokens, sizes)):
            leaves.append(np.concatenate([np.array(tree[width:first], np.int64),
                                          np.add.reduceat(new, cut),
                                          np.array(tree[last + 1:], np.int64)]))
        used = leaves[0] > 0
        self.chars, self.tokens = (tree_of(x[used]).tolist() for x in leaves)


def build(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``docs`` reduced to doc_id, text (null: ""), chars and tokens (the trees)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder, texts = codec(tokenizer, added=True), batch.column(1)
        trees: list[list[np.ndarray]] = [[], []]
        for a, b in slices(texts):
            pretokens, count = coder.cut(texts.slice(a, b - a).to_pylist())
            sizes = coder.sizes(pretokens)
            length = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
            end = np.cumsum(count)
            for x, y in zip((end - count).tolist(), end.tolist(), strict=True):
                cut = np.arange(0, y - x, LEAF)
                for tree, value in zip(trees, (length, sizes), strict=True):
                    tree.append(tree_of(np.add.reduceat(value[x:y], cut) if y > x else value[:0]))
        return pa.record_batch([batch.column(0), texts, *[lists(t) for t in trees]],
                               names=["doc_id", "text", "chars", "tokens"])

    picked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(picked, run, f"doc_id {kind}, text string, {TREE}")


def lists(rows: list[np.ndarray]) -> pa.Array:
    off = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(rows), pa.int32()))


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Trees with the ``edits`` of their document (doc_id, seq, start, stop, text)."""
    per_doc = (edits.where(F.col("doc_id").isNotNull())
               .groupBy(F.col("doc_id").alias("__id"))
               .agg(F.sort_array(F.collect_list(F.struct(
                   F.col("seq").cast("int"), F.col("start").cast("int"), F.col("stop").cast("int"),
                   F.coalesce("text", F.lit("")).alias("text")))).alias("edits")))
    return trees.join(per_doc, F.col("doc_id") == F.col("__id"), "left").drop("__id")


def apply_edits(trees: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Trees after their ``edits`` (array of seq, start, stop, text; null: none),
    with n_tokens_before, n_tokens and n_encoded, the pre-tokens cut anew."""
    kind = trees.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder, out = codec(tokenizer, added=True), []
        chars, tokens = (batch.column(c) for c in ("chars", "tokens"))
        for text, c, t, edits in zip(batch.column("text").to_pylist(), chars, tokens,
                                     batch.column("edits").to_pylist(), strict=True):
            counted = CountedText(text, c.values.to_numpy(), t.values.to_numpy(), coder)
            before = counted.n_tokens
            for e in edits or ():
                counted.replace(e["start"], e["stop"], e["text"])
            out.append((counted, before))
        return pa.record_batch(
            [batch.column("doc_id"), pa.array([c.text for c, _ in out], pa.string()),
             *[lists([np.array(x, np.int64) for x in v]) for v in (
                 [c.chars for c, _ in out], [c.tokens for c, _ in out])],
             pa.array([b for _, b in out], pa.int64()),
             pa.array([c.n_tokens for c, _ in out], pa.int64()),
             pa.array([c.encoded for c, _ in out], pa.int64())],
            names=["doc_id", "text", "chars", "tokens", "n_tokens_before", "n_tokens", "n_encoded"])

    picked = trees.select("doc_id", "text", "chars", "tokens",
                          F.col("edits").cast(f"array<{EDIT}>").alias("edits"))
    return map_arrow(picked, run, f"doc_id {kind}, text string, {TREE}, n_tokens_before long, "
                                  "n_tokens long, n_encoded long")


def revised(docs: DataFrame) -> DataFrame:
    """Counts of every document before and after three edits of its own text:
    the last ten characters go, five a quarter in are replaced, and a line
    naming the source goes in front."""
    n = F.length("text")
    edit = lambda seq, start, stop, text: F.struct(
        F.lit(seq).alias("seq"), start.cast("int").alias("start"), stop.cast("int").alias("stop"),
        text.alias("text"))
    quarter = F.floor(n / 4)
    edits = F.array(
        edit(1, F.greatest(n - 10, F.lit(0)), n, F.lit("")),
        edit(2, quarter, quarter + 5, F.lit(" (edited) ")),
        edit(3, F.lit(0), F.lit(0), F.lit("Source of the text:\n")))
    return apply_edits(build(docs).withColumn("edits", edits)).select(
        "doc_id", "n_tokens_before", "n_tokens", "n_encoded")
