"""Spelling variants: words one edit apart, grouped under the commonest form.

A word's *frequency vector* counts its letters by group (code point modulo
``GROUPS``). One edit adds at most one letter to a group (surplus) and takes at
most one from a group (deficit). Words are arranged in a trie of successive
counts: its upper ``depth`` levels are the key of a shuffle, the levels below
are built per key inside a task. A word is a member under its own counts and a
query under every count vector within the budget that is not below its own, so
that each pair meets once. In the task a depth-first search walks the trie with
all queries still within their budget of one surplus and one deficit; the words
of the leaves it reaches are verified by comparing them.

A key with more than ``MEMBERS`` words is dealt out in blocks by the words'
hashes, and its queries go to every block; queries pass in Arrow batches. So a
task holds one block of words and one batch of queries, whatever the table's
size. ``depth`` follows the number of words and changes no result.

Words: maximal runs of ``A-Za-z`` and U+00C0 to U+00FF, A-Z in lower case; a
run whose crc32 with its document's id is a multiple of 97 loses a code point
(the contract of the query). A null text has no words; a null doc_id counts as
an empty one. Repeated rows count each time. Ties between near words go to the
smaller word. Very long words take part like others. An empty table gives no
rows. Only the two named columns are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import byte_view, map_arrow, python_batches, slices, stored

LEAST_LENGTH, LEAST_COUNT = 5, 3
GROUPS = 11               # letter groups; levels of the trie
MEMBERS = 20_000          # words of a trie held in a task
LEAF = 24                 # words from which on a branch is compared as a whole
CANDIDATES = 1 << 16      # pairs verified at a time
WIDTH = 40                # longer words are compared one by one
HELD = 400_000            # distinct words counted in a task before they are passed on
MOST = 255                # counts are cut off here, which only widens the search
_RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def counted_words(docs: DataFrame) -> DataFrame:
    """(word, n): every word of at least ``LEAST_LENGTH`` and ``LEAST_COUNT``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}

        def out():
            rows = pa.record_batch([pa.array(total.keys(), pa.string()),
                                    pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return rows

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, b in slices(batch.column(1)):
                data, off = byte_view(batch.column(1).slice(a, b - a))
                data, off = _LOWER[data].tobytes(), off.tolist()
                for k in range(b - a):
                    name = ids[a + k]
                    seed = zlib.crc32(b":" if name is None else b"%d:" % name)
                    found = Counter(_RUN.findall(data[off[k]:off[k + 1]].decode()))
                    for word, n in found.items():
                        h = zlib.crc32(word.encode(), seed)
                        if h % 97 == 0:
                            cut = h % len(word)
                            word = word[:cut] + word[cut + 1:]
                        if len(word) >= LEAST_LENGTH:
                            total[word] = total.get(word, 0) + n
                if len(total) > HELD:
                    yield out()
        if total:
            yield out()

    python_batches(docs.sparkSession)
    parts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).mapInArrow(
        run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def vectors(words: list[str]) -> np.ndarray:
    """Letters of each group in each word, a row per word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    size = np.fromiter(map(len, words), np.int64, len(words))
    at = np.repeat(np.arange(len(words)), size) * GROUPS + points % GROUPS
    counts = np.bincount(at, minlength=len(words) * GROUPS).reshape(-1, GROUPS)
    return np.minimum(counts, MOST).astype(np.int16)


def keys(counts: np.ndarray) -> np.ndarray:
    """Counts of the upper levels as one number in the order of the counts."""
    key = np.zeros(len(counts), np.int64)
    for level in range(counts.shape[1]):
        key = (key << 8) | counts[:, level]
    return key


def levels_above(n_words: int) -> int:
    """Levels that make the shuffle's key: about a quarter of ``MEMBERS`` words
    a key, taking a level to part them in three. Seven counts fit in a key."""
    return min(max(math.ceil(math.log(max(4 * n_words / MEMBERS, 1), 3)), 1), 7)


def routed(words: DataFrame, depth: int) -> DataFrame:
    """(key, query, word, n): each word as a member and as queries."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = vectors(batch.column("word").to_pylist())[:, :depth]
        own = keys(counts)
        every = np.arange(len(own))
        rows, target, query = [every, every], [own, own], [False, True]
        for more in range(-1, depth):               # level with one letter more, or none
            for less in range(-1, depth):
                if more == less:
                    continue
                step = np.zeros(depth, np.int16)
                if more >= 0:
                    step[more] += 1
                if less >= 0:
                    step[less] -= 1
                moved = counts + step
                key = keys(moved)
                ok = np.flatnonzero((moved >= 0).all(axis=1) & (moved <= MOST).all(axis=1)
                                    & (key > own))
                rows.append(ok)
                target.append(key[ok])
                query.append(True)
        at = np.concatenate(rows)
        asks = np.repeat(query, list(map(len, rows)))
        return pa.record_batch(
            [pa.array(np.concatenate(target)), pa.array(asks),
             batch.column("word").take(pa.array(at)), batch.column("n").take(pa.array(at))],
            names=["key", "query", "word", "n"])

    return map_arrow(words, run, "key long, query boolean, word string, n long")


def in_blocks(rows: DataFrame, members: int) -> DataFrame:
    """With ``block``: large keys are dealt out, their queries go to all blocks."""
    large = stored(rows.filter(~F.col("query")).groupBy("key").count()
                   .filter(F.col("count") > members)
                   .select("key", F.ceil(F.col("count") / members).cast("int").alias("blocks")),
                   "large_keys")
    if large.isEmpty():
        return rows.withColumn("block", F.lit(0))
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.array(F.pmod(F.xxhash64("word"), blocks).cast("int"))
    return rows.join(large, "key", "left").withColumn(
        "block", F.explode(F.when(F.col("query"), F.sequence(F.lit(0), blocks - 1))
                           .otherwise(own))).drop("blocks")


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]
    return len(a) < len(b)


class Letters:
    """Words as rows of code points, padded with zeros; long ones as text."""

    def __init__(self, words: list[str]):
        self.words = words
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        flat = "".join([w[:WIDTH].ljust(WIDTH, "\0") for w in words])
        try:
            self.rows = np.frombuffer(flat.encode("latin-1"), np.uint8).reshape(-1, WIDTH)
        except UnicodeEncodeError:
            self.rows = np.frombuffer(flat.encode("utf-32-le"), "<u4").reshape(-1, WIDTH)


def one_edit_apart(x: Letters, i: np.ndarray, y: Letters, j: np.ndarray) -> np.ndarray:
    """``one_edit`` of the words x[i] and y[j], whose lengths differ by one at most."""
    out = np.zeros(len(i), bool)
    gap = x.size[i] - y.size[j]
    longest = np.maximum(x.size[i], y.size[j])
    for k in np.flatnonzero(longest >= WIDTH).tolist():
        out[k] = one_edit(x.words[i[k]], y.words[j[k]])
    short = longest < WIDTH
    width = int(longest[short].max(initial=0)) + 1
    same = np.flatnonzero(short & (gap == 0))
    out[same] = np.count_nonzero(x.rows[i[same], :width] != y.rows[j[same], :width], axis=1) == 1
    for a, b, at in ((x.rows[i, :width], y.rows[j, :width], short & (gap == 1)),
                     (y.rows[j, :width], x.rows[i, :width], short & (gap == -1))):
        at = np.flatnonzero(at)
        if not len(at):
            continue
        a, b = a[at], b[at]                         # the longer and the shorter word
        head = (a != b).argmax(axis=1)              # letters that agree from the start
        moved = a[:, :0:-1] != b[:, -2::-1]         # from the end, one letter on
        tail = np.where(moved.any(axis=1), width - 1 - moved.argmax(axis=1), 0)
        out[at] = tail <= head
    return out


class CountTrie:
    """A trie of the counts of some words that share their upper ``depth``
    counts: the words in the order of their counts, a node a range of them."""

    def __init__(self, words: list[str], depth: int):
        counts = vectors(words)
        order = np.lexsort(counts.T[::-1])
        self.counts, self.depth = counts[order], depth
        self.words = [words[i] for i in order]
        self.letters = Letters(self.words)
        self.place = order

    def search(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) indexes of all pairs one edit apart."""
        counts, letters = vectors(queries), Letters(queries)
        gap = self.counts[:1, :self.depth] - counts[:, :self.depth]
        surplus, deficit = (gap > 0) @ np.ones(self.depth), (gap < 0) @ np.ones(self.depth)
        stack = [(self.depth, 0, len(self.words), np.arange(len(counts)),
                  surplus.astype(np.int16), deficit.astype(np.int16))]
        none = np.zeros(0, np.int64)
        asked, met, held, waiting = [none], [none], [], 0

        def verify():
            q, w = (np.concatenate(x) for x in zip(*held, strict=True))
            ok = one_edit_apart(letters, q, self.letters, w)
            asked.append(q[ok])
            met.append(w[ok])
            held.clear()

        while stack:
            level, low, high, alive, surplus, deficit = stack.pop()
            if high - low <= LEAF or level == GROUPS:
                for a in range(low, high, LEAF):    # words of equal counts can be many
                    gap = (self.counts[None, a:min(a + LEAF, high), level:]
                           - counts[alive, None, level:])
                    more = np.maximum(gap, 0).sum(axis=2, dtype=np.int16) + surplus[:, None]
                    less = np.maximum(-gap, 0).sum(axis=2, dtype=np.int16) + deficit[:, None]
                    q, w = np.nonzero((more <= 1) & (less <= 1))
                    held.append((alive[q], w + a))
                    waiting += len(q)
                    if waiting > CANDIDATES:
                        verify()
                        waiting = 0
                continue
            column = self.counts[low:high, level]
            cuts = [low, *(np.flatnonzero(column[1:] != column[:-1]) + low + 1).tolist(), high]
            wanted = counts[alive, level]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                gap = column[a - low] - wanted
                ok = np.flatnonzero((gap == 0) | ((gap == 1) & (surplus == 0))
                                    | ((gap == -1) & (deficit == 0)))
                if len(ok):
                    step = gap[ok]
                    stack.append((level + 1, a, b, alive[ok], surplus[ok] + (step > 0),
                                  deficit[ok] + (step < 0)))
        if held:
            verify()
        return np.concatenate(asked), np.concatenate(met)


def near_pairs(words: DataFrame, depth: int, members: int = MEMBERS) -> DataFrame:
    """(word, near, near_n): both directions of every pair one edit apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, trie, held, numbers = None, None, [], []

        def ask(names: list[str], n: list[int]):
            left, near, near_n = [], [], []
            for q, w in zip(*(x.tolist() for x in trie.search(names)), strict=True):
                a, b = names[q], trie.words[w]
                # Under their common key both ask; elsewhere only one does.
                if last[0] != own[q] or a < b:
                    left += [a, b]
                    near += [b, a]
                    near_n += [numbers[trie.place[w]], n[q]]
            return pa.record_batch([pa.array(left, pa.string()), pa.array(near, pa.string()),
                                    pa.array(near_n, pa.int64())],
                                   names=["word", "near", "near_n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                            for c in ("key", "block", "query")], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if last != (key[a, 0], key[a, 1]):
                    last, trie, held, numbers = (key[a, 0], key[a, 1]), None, [], []
                names = batch.column("word").slice(a, b - a).to_pylist()
                n = batch.column("n").slice(a, b - a).to_pylist()
                if not key[a, 2]:
                    held += names
                    numbers += n
                    continue
                if not held:
                    continue                        # no word has these counts
                trie = trie or CountTrie(held, depth)
                own = keys(vectors(names)[:, :depth]).tolist()
                out = ask(names, n)
                if out.num_rows:
                    yield out

    rows = in_blocks(routed(words, depth), members)
    python_batches(words.sparkSession, 4096)
    return (rows.repartition("key", "block").sortWithinPartitions("key", "block", "query")
            .select("key", "block", "query", "word", "n")
            .mapInArrow(run, "word string, near string, near_n long"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms, by doubling. Counts
    at least double along a chain, so it is short."""
    reached = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(reached.join(ahead, "root", "left")
                       .select("word", F.coalesce("further", "root").alias("root"),
                               F.col("further").isNotNull().alias("moved")), "roots")
        if moved.filter("moved").isEmpty():
            return moved.drop("moved")
        reached = moved.drop("moved")


def variants(words: DataFrame, depth: int | None = None, members: int = MEMBERS) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table of distinct (word, n).

    A word's form is its near word of largest n, if that is at least twice its
    own; its root is where following forms ends.
    """
    if depth is None:
        depth = levels_above(words.count())
    best = near_pairs(words, depth, members).groupBy("word").agg(
        F.count("*").alias("n_near"), F.max("near_n").alias("near_n"),
        F.min_by("near", F.struct(-F.col("near_n"), F.col("near"))).alias("near"))
    has_form = F.col("near_n") >= 2 * F.col("n")
    found = stored(words.join(best, "word", "left").select(
        "word", F.when(has_form, F.col("near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("near_n")).alias("form_n")), "variants")
    ends = roots(found.filter("form is not null"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_variants(docs: DataFrame) -> DataFrame:
    """Variants of all words of all documents."""
    return variants(stored(counted_words(docs), "words"))
