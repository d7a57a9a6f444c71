"""Benchmark decontamination: BM25 retrieval of test items for every training
passage, with block-max pruning, then a check of question and answer overlap.

The test items are the indexed collection. An item's impact for a term is its
BM25 weight divided by the sum over the item's terms, so a passage's score for
an item is the covered part of its weight, from 0 to 1, and one threshold
holds for all items. Passages are windows of ``2 L`` words every ``L`` words
over the whole text, L the longest item's number of words: an item of the
text lies whole in one of them.

Every passage is a query against the inverted index, all passages of an Arrow
batch at once. As in block-max WAND, an item is reached only through bounds
that could still meet the threshold:

1. the sum of the passage's terms' largest impacts must reach it;
2. terms are walked by falling impact. Those behind which the remaining largest
   impacts cannot reach the threshold alone name no candidates; the others sum
   up the block maxima of the blocks they occur in;
3. a (passage, block) pair stays while its block maxima so far and the largest
   impacts still to come reach the threshold; the remaining terms are looked up
   for the pairs that stayed, one term after the other;
4. only the postings of the blocks left are read, and all items at or above the
   threshold are retrieved (no top-k).

Items of similar length share a block, and segments of ``SEGMENT_ITEMS`` have
bounds of their own. A task works on groups of passages and pairs of bounded
size (``WORK`` entries), whatever the number of items.

Retrieved pairs are verified on the words themselves: at least ``OVERLAP`` of
the word 3-grams of the whole item must stand in the passage. For collections
whose items end with their answer (``answers=True``) the last quarter of the
words is the answer, and the share must hold for question and answer alike; on
items without an answer that would lose leaks with an edited or cut end.
Words are lower case, cut at blanks and ASCII punctuation.

The items' number, mean and longest length and the terms' numbers of items come
from Spark, over all items. The driver reads the items in parts of about
``PART_BYTES`` of text, each one pass over the documents, built, used and
released one after the other (one part, the usual case, is used lazily). The
number of parts changes no result.

Edge cases: null and empty texts, and items without a word, match nothing.
Repeated items (same id and text) count once; null item ids are kept. Repeated
documents get a row each. Only the named columns are read. Empty tables give
no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import WordTable, map_arrow, rolling, slices, stored

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.5
GRAM = 3
BLOCK_ITEMS = 16
PART_BYTES = 32 << 20
SEGMENT_ITEMS = 4096
WORK = 1 << 21                 # entries of a work array
LEAST_WINDOW = 16

# ASCII punctuation and control characters become blanks.
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[[i for i in range(128) if not chr(i).isalnum()]] = 0x20


def words_of(col: pa.Array) -> WordTable:
    return WordTable(pc.utf8_lower(col), _TABLE)


def grams_of(hashes: np.ndarray) -> np.ndarray:
    """Distinct word 3-grams (of all words, if there are fewer)."""
    return np.unique(rolling(hashes, min(GRAM, len(hashes)))) if len(hashes) else hashes


@dataclass
class Index:
    """Inverted index of one segment of the items; all arrays are by number."""
    items: list                    # item ids
    length: int                    # words of the longest item
    vocab: np.ndarray              # sorted term hashes
    off: np.ndarray                # postings of term t: off[t]:off[t + 1]
    item: np.ndarray
    impact: np.ndarray
    top: np.ndarray                # largest impact per term
    block_off: np.ndarray
    block: np.ndarray
    block_top: np.ndarray
    block_first: np.ndarray        # postings of block entry e: block_first[e]:block_first[e + 1]
    # 3-grams and their width, of the whole item, its question and its answer
    parts: list[tuple[tuple[np.ndarray, int], ...]]

    @classmethod
    def build(cls, ids: list, texts: list[str], total: int, mean: float, df: dict[int, int]):
        """``total``/``mean``/``df``: number of items, their mean length and
        each term's number of items, over all parts."""
        table = words_of(pa.array(texts, pa.string()))
        h = table.hash()
        term, item, impact, parts = [], [], [], []
        for k in range(len(ids)):
            w = h[table.first[k]:table.first[k + 1]]
            t, tf = np.unique(w, return_counts=True)
            n = np.array([df[x] for x in t.tolist()])
            weight = np.log(1 + (total - n + 0.5) / (n + 0.5)) * tf * (K1 + 1) / (
                tf + K1 * (1 - B + B * len(w) / mean))
            term.append(t)
            item.append(np.full(len(t), k))
            impact.append(weight / weight.sum() if len(t) else weight)
            cut = len(w) - max(1, len(w) // 4)
            parts.append(tuple((grams_of(x), min(GRAM, len(x))) for x in (w, w[:cut], w[cut:])))
        term, item = np.concatenate(term), np.concatenate(item)
        impact = np.concatenate(impact).astype(float)
        order = np.lexsort((item, term))
        term, item, impact = term[order], item[order], impact[order]
        vocab, start = np.unique(term, return_index=True)
        off = np.append(start, len(term))
        number = np.repeat(np.arange(len(vocab)), np.diff(off))
        pair = number * (len(ids) // BLOCK_ITEMS + 1) + item // BLOCK_ITEMS
        _, first = np.unique(pair, return_index=True)
        return cls(ids, int(np.diff(table.first).max(initial=0)), vocab, off, item, impact,
                   np.maximum.reduceat(impact, start) if len(start) else impact,
                   np.append(np.searchsorted(first, start), len(first)),
                   (item // BLOCK_ITEMS)[first],
                   np.maximum.reduceat(impact, first) if len(first) else impact,
                   np.append(first, len(term)), parts)

    @property
    def blocks(self) -> int:
        return len(self.items) // BLOCK_ITEMS + 1

    @functools.cached_property
    def entry_key(self) -> np.ndarray:
        """Sorted term * blocks + block of the block entries."""
        number = np.repeat(np.arange(len(self.vocab)), np.diff(self.block_off))
        return number * self.blocks + self.block

    def entries(self, term: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block entry, whether the term has it) of each term and block."""
        key = term * self.blocks + block
        at = np.minimum(np.searchsorted(self.entry_key, key), len(self.entry_key) - 1)
        return at, self.entry_key[at] == key

    @functools.cached_property
    def seen(self) -> np.ndarray:
        """Which leading 20 bits some term's hash has."""
        out = np.zeros(1 << 20, bool)
        out[self.vocab >> np.uint64(44)] = True
        return out

    def terms(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, term number) of the words that are terms."""
        place = np.flatnonzero(self.seen[h >> np.uint64(44)])
        number = np.searchsorted(self.vocab, h[place])
        number[number == len(self.vocab)] = 0
        hit = self.vocab[number] == h[place]
        return place[hit], number[hit]


def spread(off: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every entry of each term's list: (index into ``terms``, index into the list)."""
    size = off[terms + 1] - off[terms]
    which = np.repeat(np.arange(len(terms)), size)
    begin = np.cumsum(size) - size
    return which, np.arange(len(which)) - begin[which] + off[terms][which]


@dataclass
class Passages:
    """The windows of a slice of texts."""
    table: WordTable
    h: np.ndarray
    step: int

    @classmethod
    def of(cls, texts: pa.Array, length: int):
        table = words_of(texts)
        return cls(table, table.hash(), max(length, LEAST_WINDOW))

    def __post_init__(self):
        self.windows = np.maximum(-(-np.diff(self.table.first) // self.step) - 1, 1)
        self.first_window = np.cumsum(self.windows) - self.windows

    def terms(self, index: Index) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (passage, term number) pairs, ascending."""
        place, term = index.terms(self.h)
        doc = self.table.doc[place]
        at = (place - self.table.first[doc]) // self.step
        passage, terms = [], []
        for back in (0, 1):                   # a word lies in one or two windows
            w = at - back
            ok = (w >= 0) & (w < self.windows[doc])
            passage.append(self.first_window[doc[ok]] + w[ok])
            terms.append(term[ok])
        size = len(index.vocab)
        pair = np.unique(np.concatenate(passage) * size + np.concatenate(terms))
        return pair // size, pair % size

    def row(self, passage: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first_window, passage, side="right") - 1

    def words(self, passage: int, row: int) -> np.ndarray:
        begin = int(self.table.first[row] + (passage - self.first_window[row]) * self.step)
        return self.h[begin:min(begin + 2 * self.step, int(self.table.first[row + 1]))]


def groups(cost: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Consecutive ranges whose costs sum to at most ``limit`` (or of one entry)."""
    total, out, start = np.cumsum(cost), [], 0
    while start < len(cost):
        before = total[start] - cost[start]
        end = max(int(np.searchsorted(total, before + limit, side="right")), start + 1)
        out.append((start, end))
        start = end
    return out


def scored(index: Index, passages: Passages, threshold: float):
    """Batches of (passage, item number, score) at or above the threshold."""
    passage, term = passages.terms(index)
    slack = threshold - 1e-9                  # sums of floats
    bound = np.bincount(passage, index.top[term], int(passages.windows.sum()))
    stay = bound[passage] >= slack
    passage, term = passage[stay], term[stay]
    if not len(passage):
        return
    order = np.lexsort((-index.top[term], passage))
    passage, term = passage[order], term[order]
    ids, begin = np.unique(passage, return_index=True)
    end = np.append(begin[1:], len(passage))
    number = np.repeat(np.arange(len(ids)), end - begin)
    # Largest impacts of a pair's term and all terms behind it in its passage.
    top = index.top[term]
    upto = np.cumsum(top)
    rest = bound[passage] - (upto - top - (upto[begin] - top[begin])[number])
    leading = rest >= slack - 1e-9
    leads = np.bincount(number, leading, len(ids)).astype(np.int64)
    after = np.append(rest, 0.0)[np.minimum(begin + leads, len(rest))]
    after[begin + leads == end] = 0.0         # no term is left
    size = index.block_off[term + 1] - index.block_off[term]
    cost = np.bincount(number, size * leading, len(ids)) + index.blocks
    for a, b in groups(cost.astype(np.int64), WORK):
        span = slice(begin[a], end[b - 1])
        use = leading[span]
        which, entry = spread(index.block_off, term[span][use])
        cell = (number[span][use] - a)[which] * index.blocks + index.block[entry]
        found = np.bincount(cell, index.block_top[entry], (b - a) * index.blocks)
        cell = np.flatnonzero((found > 0) & (
            found + np.repeat(after[a:b], index.blocks) >= slack - 1e-9))
        p, block, got = cell // index.blocks + a, cell % index.blocks, found[cell]
        at, open_ = begin[p] + leads[p], np.ones(len(p), bool)
        while True:                           # the next term of each open pair
            open_ &= at < end[p]
            k = np.flatnonzero(open_)
            if not len(k):
                break
            entry, has = index.entries(term[at[k]], block[k])
            got[k] += np.where(has, index.block_top[entry], 0.0)
            at[k] += 1
            left = np.where(at[k] < end[p[k]], rest[np.minimum(at[k], len(rest) - 1)], 0.0)
            low = got[k] + left < slack - 1e-9
            if low.any():
                keep = np.ones(len(p), bool)
                keep[k[low]] = False
                p, block, got, at, open_ = p[keep], block[keep], got[keep], at[keep], open_[keep]
        stay = got >= slack - 1e-9
        p, block = p[stay], block[stay]
        for c, d in groups((end - begin)[p] * BLOCK_ITEMS, WORK):
            which, pair = spread(np.append(begin, len(term)), p[c:d])
            entry, has = index.entries(term[pair], block[c:d][which])
            which, entry = which[has], entry[has]
            each, posting = spread(index.block_first, entry)
            cell = which[each] * BLOCK_ITEMS + index.item[posting] % BLOCK_ITEMS
            score = np.bincount(cell, index.impact[posting], (d - c) * BLOCK_ITEMS)
            cell = np.flatnonzero(score >= slack)
            pair = cell // BLOCK_ITEMS + c
            yield (ids[p[pair]], block[pair] * BLOCK_ITEMS + cell % BLOCK_ITEMS,
                   np.minimum(score[cell], 1.0))


def retrieve(part: Part, texts: pa.Array, threshold: float = THRESHOLD):
    """(row, item number, score, overlap of the item, of its question, of its
    answer) of every passage and item at or above the threshold."""
    passages = Passages.of(texts, part.length)
    none = [np.zeros(0, np.int64)] * 2 + [np.zeros(0)] * 4
    out = [none]
    for base, index in zip(part.bases, part.segments, strict=True):
        if not len(passages.h) or not len(index.vocab):
            continue
        for passage, item, score in scored(index, passages, threshold):
            row = passages.row(passage)
            overlap = np.zeros((len(row), 3))
            cache: tuple[int, dict[int, np.ndarray]] = (-1, {})
            for x, (p, k, r) in enumerate(zip(passage, item, row, strict=True)):
                if cache[0] != p:
                    cache = (p, {})
                w = passages.words(p, r)
                for side, (grams, width) in enumerate(index.parts[k]):
                    if width not in cache[1]:
                        cache[1][width] = rolling(w, width) if width else w[:0]
                    if len(grams):
                        overlap[x, side] = np.isin(grams, cache[1][width]).mean()
                    else:
                        overlap[x, side] = 1.0    # a one-word item has no question
            out.append([row, item + base, score, *overlap.T])
    return [np.concatenate(v) for v in zip(*out, strict=True)]


def decisive(overlap, question, answer, answers: bool, least=np.minimum):
    """The overlap that must reach ``OVERLAP``."""
    return least(question, answer) if answers else overlap


@dataclass
class Part:
    """The indexes of a part of the items. ``length``: words of the longest
    item of all parts."""
    items: list
    length: int
    bases: list[int]               # number of the first item of each segment
    segments: list[Index]

    @classmethod
    def build(cls, ids: list, texts: list[str], total: int, mean: float, df: dict[int, int],
              length: int):
        size = np.diff(words_of(pa.array(texts, pa.string())).first)
        order = np.argsort(size, kind="stable")
        ids, texts = [ids[k] for k in order], [texts[k] for k in order]
        bases = list(range(0, len(ids), SEGMENT_ITEMS))
        return cls(ids, length, bases, [
            Index.build(ids[k:k + SEGMENT_ITEMS], texts[k:k + SEGMENT_ITEMS], total, mean, df)
            for k in bases])


def item_terms(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Number of words and distinct term hashes (as signed longs) of each item."""
    table = words_of(batch.column(1))
    h = table.hash()
    terms = [np.unique(h[a:b]) for a, b in zip(table.first[:-1], table.first[1:], strict=True)]
    off = np.cumsum([0, *map(len, terms)]).astype(np.int32)
    return pa.record_batch(
        [batch.column(0), pa.array(np.diff(table.first), pa.int64()),
         pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(terms).view(np.int64)))],
        names=["part", "n_words", "terms"])


def build_parts(items: DataFrame) -> Iterator[tuple[int, Part]]:
    """(number of parts, part) of all items, one part after the other."""
    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    parts = int(size // PART_BYTES) + 1
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).cast("int"))
    terms = stored(map_arrow(dealt.select("part", "text"), item_terms,
                             "part int, n_words long, terms array<long>"), "item-terms")
    whole = terms.agg(F.count("*").alias("n"), F.sum("n_words").alias("words"),
                      F.max("n_words").alias("longest")).first()
    number = (terms.select("part", F.explode("terms").alias("term")).groupBy("term")
              .agg(F.count("*").alias("n"), F.collect_set("part").alias("parts")))
    if parts > 1:
        number = stored(number, "term-items")
    for k in range(parts):
        got = dealt.where(F.col("part") == k).orderBy("item_id", "text").toArrow()
        if got.num_rows:
            df = number.where(F.array_contains("parts", k)).select("term", "n").toArrow()
            hashes = df.column("term").to_numpy().astype(np.int64).view(np.uint64)
            yield parts, Part.build(
                got.column("item_id").to_pylist(), got.column("text").to_pylist(), whole["n"],
                max(whole["words"], 1) / whole["n"],
                dict(zip(hashes.tolist(), df.column("n").to_pylist(), strict=True)),
                whole["longest"])


def retrieved(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
              answers: bool = True) -> DataFrame:
    """doc_id, item_id, score, overlap, question_overlap, answer_overlap,
    n_passages: the best passage of every document and item at or above the
    threshold."""
    spark = docs.sparkSession
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    item_type = pa.array([], pa.int64()).type if items.schema[
        "item_id"].dataType.simpleString() == "bigint" else pa.string()
    item_kind = "long" if pa.types.is_int64(item_type) else "string"
    items = items.withColumn("item_id", F.col("item_id").cast(item_kind))
    schema = (f"doc_id {id_kind}, item_id {item_kind}, score double, overlap double, "
              "question_overlap double, answer_overlap double, n_passages long")
    picked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = spark.createDataFrame([], schema)
    for parts, part in build_parts(items):
        shared = spark.sparkContext.broadcast(part)        # at most about PART_BYTES of text

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            found = []
            for a, b in slices(batch.column(1)):
                row, item, *values = retrieve(shared.value, batch.column(1).slice(a, b - a), threshold)
                # The best passage: by the overlap that decides, then by score.
                order = np.lexsort((-values[0], -decisive(*values[1:], answers), item, row))
                row, item = row[order] + a, item[order]
                head = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(item) != 0)])
                                      ) if len(row) else np.zeros(0, np.int64)
                found.append((row[head], item[head], *[v[order][head] for v in values],
                              np.diff(np.append(head, len(row)))))
            row, item, *values = (np.concatenate(x) for x in zip(*found, strict=True))
            return pa.record_batch(
                [batch.column(0).take(pa.array(row)),
                 pa.array([shared.value.items[k] for k in item], item_type),
                 *[pa.array(v) for v in values]],
                names=["doc_id", "item_id", "score", "overlap", "question_overlap",
                       "answer_overlap", "n_passages"])

        pairs = map_arrow(picked, run, schema)
        if parts > 1:
            pairs = stored(pairs, "leaks")
            shared.destroy()
        out = out.union(pairs)
    return out


def leaks(docs: DataFrame, items: DataFrame, answers: bool = True) -> DataFrame:
    """The retrieved pairs whose overlap is verified."""
    sides = [F.col(c) for c in ("overlap", "question_overlap", "answer_overlap")]
    return retrieved(docs, items, answers=answers).where(
        decisive(*sides, answers, F.least) >= OVERLAP)


def clean(docs: DataFrame, items: DataFrame, answers: bool = True) -> DataFrame:
    """Documents without a verified leak (columns unchanged).

    Decided row by row, so null and repeated ids need no special care. With
    several index parts, each writes the hashes of the texts that leak, and the
    documents of those texts go at the end.
    """
    marked = None
    for parts, part in build_parts(items):
        shared = docs.sparkSession.sparkContext.broadcast(part)

        def stays(texts: pa.Array, shared=shared) -> np.ndarray:
            stay = np.ones(len(texts), bool)
            for a, b in slices(texts):
                row, _, _, *sides = retrieve(shared.value, texts.slice(a, b - a))
                stay[row[decisive(*sides, answers) >= OVERLAP] + a] = False
            return stay

        if parts == 1:
            return map_arrow(docs, lambda batch: batch.filter(pa.array(stays(batch.column("text")))),
                             docs.schema)
        found = map_arrow(
            docs.select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("__sha"), "text"),
            lambda batch, stays=stays: pa.record_batch(
                [batch.column(0).filter(pa.array(~stays(batch.column(1))))], names=["__sha"]),
            "__sha string").distinct()
        found = stored(found, "leaking-texts")
        shared.destroy()
        marked = found if marked is None else marked.union(found)
    if marked is None:
        return docs
    return docs.withColumn("__sha", F.sha2(F.coalesce("text", F.lit("")), 256)).join(
        marked.distinct(), "__sha", "left_anti").select(*docs.columns)
