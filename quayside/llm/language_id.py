"""Language identification with bit-sliced Bloom filters of n-grams.

One filter per language, stored together: position p of the table holds a bit
mask with one bit per language, so one lookup (the AND of ``HASHES``
positions) returns all languages that contain an n-gram. A mask has one 64-bit
word per 64 languages, however many there are.

Training counts the letter n-grams of all training rows per language. An
n-gram belongs to a language if it makes up at least ``MIN_SHARE`` of that
language's n-grams and its share there is at least ``RATIO`` of its highest
share in any language. At most ``1 / MIN_SHARE`` n-grams per order and
language can reach that share, so the filter's size depends on the number of
languages only (16 MB per 64); it is the only thing that goes through the driver.

A text's popcount for a language is the number of its n-grams that the filter
reports for it. With n-grams N and false positive rate p (the filled part of
the language's filter to the power ``HASHES``) the corrected count is
``(hits - N p) / (1 - p)``. It is divided by N and by the language's coverage
(the part of its training n-grams that its own filter holds); the language
with the highest rate wins, the first by name on ties. ``score`` is the
corrected count's share of N, from 0 to 1.

Edge cases: a null text or one without a letter is ``und`` with score 0, as is
any text if nothing could be learnt (an empty table, no non-null language).
A text none of whose n-grams is known gets the most frequent language with
score 0. Repeated rows are predicted one by one. Only doc_id, text and lang
are read, so other columns' names cannot clash; lang, source and doc_id are
never inputs of a prediction.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import map_arrow, mix64, python_batches, slices, stored

ORDERS = (3, 4)             # 3 at least, so that each n-gram has a letter inside
MIN_SHARE = 1e-5
RATIO = 0.2
HASHES = 3
POSITIONS = 1 << 21
FOLDS = 5
LEAST_SCORE = 0.1           # below it, a text is in none of the learnt languages
WORD_LANGUAGES = 64         # languages of a mask's word
TASK_GRAMS = 1_000_000      # n-grams a training task holds before it sums or sends them
UNDETERMINED = "und"


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_hashes(texts: list[str], orders: tuple[int, ...] = ORDERS):
    """(hash, row) of every letter n-gram, and whether each row has a letter.

    Texts are lower-cased; every run of other characters counts as one mark
    at a word's edge. An n-gram may begin or end with that mark.
    """
    lowered = [t.lower() for t in texts]
    n = np.fromiter(map(len, lowered), np.int64, len(lowered))
    cp = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), n)
    is_letter = letters()[cp]
    # A mark stands before each word and after the last one of a row.
    starts = is_letter.copy()
    starts[1:] &= ~(is_letter[:-1] & (row[1:] == row[:-1]))
    at = np.flatnonzero(is_letter)
    words_before = np.cumsum(starts)[at]
    code = np.zeros(len(at) + int(starts.sum()) + 1, np.uint64)
    code[np.arange(len(at)) + words_before] = cp[at]
    owner = np.zeros(len(code), np.int32)
    owner[np.arange(len(at)) + words_before] = row[at]
    mark = code == 0
    has = np.bincount(row[at], minlength=len(texts)) > 0
    hashes, rows = [], []
    for k in orders:
        if len(code) < k:
            continue
        span = len(code) - k + 1
        h = np.zeros(span, np.uint64)
        inner = np.zeros(span, bool)
        for j in range(k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + code[j:j + span]
            if 0 < j < k - 1:
                inner |= mark[j:j + span]
        place = np.flatnonzero(~inner)
        hashes.append(mix64(h[place] + np.uint64(k)))
        rows.append(owner[place + 1])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), has
    return np.concatenate(hashes), np.concatenate(rows), has


@dataclass
class Filters:
    """Masks per position, with what the correction needs per language."""
    languages: list[str]
    masks: np.ndarray           # word w of position p: masks[w * POSITIONS + p]
    coverage: np.ndarray
    false_rate: np.ndarray
    fallback: int


def positions(hashes: np.ndarray) -> list[np.ndarray]:
    """The table positions of each n-gram (double hashing)."""
    low = hashes & np.uint64(0xFFFFFFFF)
    high = (hashes >> np.uint64(32)) | np.uint64(1)
    return [((low + np.uint64(i) * high) & np.uint64(POSITIONS - 1)).astype(np.int64)
            for i in range(HASHES)]


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, remainder 0 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def gram_counts(labelled: DataFrame) -> DataFrame:
    """lang, gram, n: n-grams summed per task, then per language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            texts, lang = batch.column(0), batch.column(1).dictionary_encode()
            code, names = lang.indices.to_numpy(), lang.dictionary.to_pylist()
            for a, b in slices(texts):
                h, row, _ = gram_hashes(texts.slice(a, b - a).to_pylist())
                of = code[a:b][row]
                for i in np.unique(of):
                    seen.setdefault(names[i], []).append(
                        np.unique(h[of == i], return_counts=True))
            for name, parts in seen.items():
                if sum(len(g) for g, _ in parts) > TASK_GRAMS:
                    seen[name] = [summed(parts)]
                    if len(seen[name][0][0]) > TASK_GRAMS // 2:
                        yield rows_of(name, *seen[name][0])
                        seen[name] = []
        for name, parts in seen.items():
            if parts:
                yield rows_of(name, *summed(parts))

    def summed(parts):
        gram, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return gram, np.bincount(back, np.concatenate([n for _, n in parts])).astype(np.int64)

    def rows_of(name, gram, n):
        return pa.record_batch([pa.array([name] * len(gram)), pa.array(gram.view(np.int64)),
                                pa.array(n)], names=["lang", "gram", "n"])

    python_batches(labelled.sparkSession)
    return (labelled.select("text", "lang").mapInArrow(run, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def train(labelled: DataFrame) -> Filters:
    """Filters from rows with a text and a non-null lang."""
    counts = stored(gram_counts(labelled.where(
        F.col("text").isNotNull() & F.col("lang").isNotNull())), "gram-counts")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    words = max(-(-len(languages) // WORD_LANGUAGES), 1)
    masks = np.zeros(words * POSITIONS, np.uint64)
    coverage = np.zeros(max(len(languages), 1))
    if languages:
        total = F.create_map(*[x for k, v in totals.items() for x in (F.lit(k), F.lit(float(v)))])
        share = counts.select("lang", "gram", (F.col("n") / total[F.col("lang")]).alias("share"))
        share = share.where(F.col("share") >= MIN_SHARE)      # <= 1 / MIN_SHARE per order, language
        best = share.groupBy("gram").agg(F.max("share").alias("best"))
        kept = share.join(best, "gram").where(F.col("share") >= RATIO * F.col("best")).toArrow()
        lang = np.searchsorted(np.array(languages), np.array(kept.column("lang").to_pylist(), str))
        gram = kept.column("gram").to_numpy().view(np.uint64)
        for place in positions(gram):
            np.bitwise_or.at(masks, lang // WORD_LANGUAGES * POSITIONS + place,
                             np.uint64(1) << (lang % WORD_LANGUAGES).astype(np.uint64))
        coverage = np.bincount(lang, kept.column("share").to_numpy(), len(languages))
    filled = np.array([np.count_nonzero(word_of(masks, i) & bit_of(i)) / POSITIONS
                       for i in range(len(languages))])
    fallback = max(range(len(languages)), key=lambda i: totals[languages[i]], default=0)
    return Filters(languages, masks, coverage, filled ** HASHES, fallback)


def word_of(masks: np.ndarray, language: int) -> np.ndarray:
    """The word of every position that has the language's bit."""
    begin = language // WORD_LANGUAGES * POSITIONS
    return masks[begin:begin + POSITIONS]


def bit_of(language: int) -> np.uint64:
    return np.uint64(1) << np.uint64(language % WORD_LANGUAGES)


def predict_texts(model: Filters, texts: list[str]) -> tuple[list[str], np.ndarray]:
    h, row, has = gram_hashes(texts)
    n = np.bincount(row, minlength=len(texts)).astype(float)
    if not model.languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    places = positions(h)
    rate = np.empty((len(texts), len(model.languages)))
    for i, p in enumerate(model.false_rate):
        if i % WORD_LANGUAGES == 0:
            word = word_of(model.masks, i)
            mask = np.full(len(h), 2**64 - 1, np.uint64)
            for place in places:
                mask &= word[place]
        hit = (mask & bit_of(i)).astype(bool)
        hits = np.bincount(row[hit], minlength=len(texts))
        rate[:, i] = np.maximum(hits - n * p, 0) / (1 - p) / np.maximum(n, 1)
    best = (rate / np.maximum(model.coverage, 1e-9)).argmax(axis=1)
    best[rate.max(axis=1) == 0] = model.fallback
    score = np.clip(rate[np.arange(len(texts)), best], 0, 1)
    names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, has, strict=True)]
    return names, np.where(has, score, 0.0)


def predict(docs: DataFrame, model: Filters) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # 16 MB per 64 languages
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores = predict_batch(shared.value, batch.column(1))
        return pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(scores)],
                               names=["doc_id", "lang_pred", "score"])

    return map_arrow(docs.select("doc_id", "text"), run,
                     f"doc_id {kind}, lang_pred string, score double")


def predict_batch(model: Filters, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    names, scores = [], []
    for a, b in slices(texts):
        got = predict_texts(model, [t or "" for t in texts.slice(a, b - a).to_pylist()])
        names += got[0]
        scores.append(got[1])
    return names, np.concatenate(scores)


def keep_identified(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """Documents with a determinable language (columns unchanged): not ``und``,
    and at least ``least`` of their n-grams are the predicted language's.

    If nothing could be learnt, documents with a letter stay.
    """
    model = train(docs.where(~held_out(F.col("doc_id"))))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text")
        if not model_known:
            has = [any(map(str.isalpha, t or "")) for t in texts.to_pylist()]
            return batch.filter(pa.array(has))
        names, scores = predict_batch(shared.value, texts)
        stay = (np.array(names, object) != UNDETERMINED) & (scores >= least)
        return batch.filter(pa.array(stay))

    model_known = bool(model.languages)
    return map_arrow(docs, run, docs.schema)


def identify(docs: DataFrame) -> DataFrame:
    """Learn on the folds that are not held out, predict every document."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def fold_of(doc_id) -> int:
    """Plain form of the fold rule, for tests."""
    return zlib.crc32(str(doc_id).encode()) % FOLDS
