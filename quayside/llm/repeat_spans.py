"""Substring dedup by seed and extend: remove words covered by a window of
``WINDOW`` words whose word sequence starts at another place too.

*Seeds.* Every window selects one seed, the smallest hash among its
``SEED``-word grams (the last on ties). The choice depends on the window's
words alone, so equal windows select equal seeds at the same offset, and a
seed that occurs once rules out all windows that selected it.

1. Texts with equal word sequences are one class; with two members or more
   all their windows repeat, and one member stands for the class from here on.
2. Documents are joined on seeds: seeds that occur once are dropped.
3. Around each occurrence of a repeated seed the match is extended left and
   right as far as windows select it. An occurrence whose whole reach equals
   another's (hash over all its windows) is settled as it stands; only
   distinct reaches of one seed are compared window by window.
4. Matching windows of a document unite to its maximal repeated spans.

All matching is counting and joining by key with map-side combining; no pair
of documents is written, so a passage in a third of all documents costs one
row per occurrence. A match needs equal 64-bit hashes of the seed's and of the
window's words, which are independent.

Edge cases: null and empty texts have no words. Texts shorter than a window
lose nothing, copies or not. Repeated rows are copies of each other and null
ids are kept. An empty table gives no rows. Only doc_id and text are read, so
other columns' names cannot clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import WordTable, map_arrow, mix64, rolling, slices, stored

WINDOW = 35
SEED = 16
REACH = WINDOW - SEED + 1            # seeds in a window
_LOW = np.uint64(0xFFFFFF)


def selected(grams: np.ndarray) -> np.ndarray:
    """For each run of ``REACH`` grams, the place of its smallest hash (the last on ties)."""
    n = len(grams)
    place = np.arange(n, dtype=np.uint64) & _LOW
    key = (grams & ~_LOW) | (_LOW - place)        # 40 hash bits, then the place
    width = 1
    while width * 2 <= REACH:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    runs = n - REACH + 1
    key = np.minimum(key[:runs], key[REACH - width:][:runs])
    start = np.arange(runs)
    return start + (((_LOW - (key & _LOW)).astype(np.int64) - start) & int(_LOW))


class Windows:
    """Windows of a slice of texts: their row, start, seed and hash."""

    def __init__(self, texts: pa.Array):
        self.table = table = WordTable(texts)
        self.word = h = table.hash()
        n = np.diff(table.first)
        count = np.maximum(n - WINDOW + 1, 0)
        self.row = np.repeat(np.arange(len(n)), count)
        begin = np.repeat(np.cumsum(count) - count, count)
        self.start = np.arange(len(self.row)) - begin
        at = table.first[:-1][self.row] + self.start
        if len(at):
            grams = rolling(h, SEED)
            self.place = selected(grams)[at]           # within the slice
            self.seed = grams[self.place]
            self.key = rolling(h, WINDOW, lane=1)[at]
        else:
            self.place, self.seed, self.key = at, h[:0], h[:0]

    def occurrences(self) -> np.ndarray:
        """Index of the first window of each seed occurrence (windows that
        select the same place follow one another)."""
        if not len(self.row):
            return np.zeros(0, np.int64)
        new = (np.diff(self.place) != 0) | (np.diff(self.row) != 0)
        return np.concatenate([[0], np.flatnonzero(new) + 1])


def fingerprint(word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hash of each row's word sequence."""
    lanes = []
    for lane in (0, 1):
        base = np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[lane])
        place = np.arange(len(word), dtype=np.uint64) - np.repeat(
            first[:-1], np.diff(first)).astype(np.uint64)
        mixed = mix64(word ^ mix64(place * base + np.uint64(lane + 1)))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        size = np.diff(first).astype(np.uint64)
        lanes.append(mix64(total[first[1:]] - total[first[:-1]] + size).view(np.int64))
    return lanes[0], lanes[1]


def kept_digest(data: bytes, table: WordTable, row: int, covered: np.ndarray | None) -> str:
    """sha256 of the row's words that are not covered, joined by one space."""
    words = data[table.off[row]:table.off[row + 1]].split()
    if covered is not None:
        words = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
    return hashlib.sha256(b" ".join(words)).hexdigest()


def seeded(docs: DataFrame) -> DataFrame:
    """doc_id, text hash (``body``), class (f1, f2), n_words, digest of all words,
    seeds of every text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, out = batch.column(1), []
        for a, b in slices(texts):
            w = Windows(texts.slice(a, b - a))
            data = w.table.data.tobytes()
            f1, f2 = fingerprint(w.word, w.table.first)
            head = w.occurrences()
            off = np.searchsorted(w.row[head], np.arange(b - a + 1)).astype(np.int32)
            out.append(pa.record_batch(
                [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                 pa.array(f1), pa.array(f2),
                 pa.array(np.diff(w.table.first)),
                 pa.array([kept_digest(data, w.table, r, None) for r in range(b - a)]),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(w.seed[head].view(np.int64)))],
                names=["doc_id", "body", "f1", "f2", "n_words", "digest", "seeds"]))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0]

    text = F.coalesce("text", F.lit(""))
    picked = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("body"))
    return map_arrow(picked, run, f"doc_id {kind}, body long, f1 long, f2 long, n_words long, "
                                  "digest string, seeds array<long>")


def with_text(docs: DataFrame, need: DataFrame) -> DataFrame:
    """``need`` (doc_id, body, rid, f1, f2, seeds) with its text, checked by class.

    The join is on the id and the text's hash, so that rows that share an id, or
    have none, do not meet each other's texts; equal ones count once.
    """
    text = F.coalesce("text", F.lit(""))
    text = docs.select(F.col("doc_id").alias("__id"), text.alias("text"),
                       F.xxhash64(text).alias("__body"))
    joined = need.join(text, F.col("doc_id").eqNullSafe(F.col("__id"))
                       & (F.col("body") == F.col("__body"))).select(
        "rid", "f1", "f2", "seeds", "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        same = []
        for a, b in slices(batch.column("text")):
            table = WordTable(batch.column("text").slice(a, b - a))
            f1, f2 = fingerprint(table.hash(), table.first)
            same.append((f1 == batch.column("f1").to_numpy()[a:b])
                        & (f2 == batch.column("f2").to_numpy()[a:b]))
        return batch.filter(pa.array(np.concatenate(same))).select(["rid", "seeds", "text"])

    return map_arrow(joined, run, "rid long, seeds array<long>, text string")


def seed_reaches(bodies: DataFrame) -> DataFrame:
    """Occurrences of repeated seeds: seed, reach (hash of all windows that
    select it, and of the seed's offset), rid, first window start, window hashes."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        rids = batch.column("rid").to_numpy()
        lists = batch.column("seeds")
        for a, b in slices(batch.column("text")):
            w = Windows(batch.column("text").slice(a, b - a))
            head = w.occurrences()
            wanted = np.zeros(len(head), bool)
            bounds = np.searchsorted(w.row[head], np.arange(b - a + 1))
            for r in range(b - a):
                x, y = bounds[r], bounds[r + 1]
                known = lists[a + r].values.to_numpy().view(np.uint64)
                wanted[x:y] = np.isin(w.seed[head[x:y]], known)
            size = np.diff(np.append(head, len(w.row)))
            pick = np.repeat(wanted, size)
            head, size = head[wanted], size[wanted]
            off = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            key = w.key[pick]
            offset = (w.place[head] - w.table.first[:-1][w.row[head]] - w.start[head])
            mixed = mix64(key)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
            reach = mix64((total[off[1:]] - total[off[:-1]]) ^ mix64(offset.astype(np.uint64) * np.uint64(64)
                                                                   + size.astype(np.uint64)))
            out.append(pa.record_batch(
                [pa.array(w.seed[head].view(np.int64)), pa.array(reach.view(np.int64)),
                 pa.array(rids[a + w.row[head]]), pa.array(w.start[head].astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(key.view(np.int64)))],
                names=["seed", "reach", "rid", "start", "keys"]))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0] if any(
            x.num_rows for x in out) else out[0]

    return map_arrow(bodies, run,
                     "seed long, reach long, rid long, start int, keys array<long>")


def repeated_windows(reaches: DataFrame) -> DataFrame:
    """rid, start, count: runs of windows that occur elsewhere too."""
    kinds = reaches.groupBy("seed", "reach").agg(
        F.count("*").alias("n"), F.any_value("keys").alias("keys"))
    kinds = stored(kinds, "reach-kinds")
    settled = kinds.where("n > 1").select("seed", "reach")
    whole = reaches.join(settled, ["seed", "reach"]).select(
        "rid", "start", F.size("keys").alias("count"))
    # Distinct reaches of one seed: window by window.
    single = kinds.where("n = 1").select("seed", "reach")
    windows = kinds.select("seed", F.explode("keys").alias("key"))
    shared = windows.groupBy("seed", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    parts = (reaches.join(single, ["seed", "reach"])
             .select("seed", "rid", "start", F.posexplode("keys").alias("i", "key"))
             .join(shared, ["seed", "key"])
             .select("rid", (F.col("start") + F.col("i")).alias("start"), F.lit(1).alias("count")))
    return whole.union(parts)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and ``spans``, the removed word
    ranges (start, stop) in order, of every document."""
    rows = stored(seeded(docs).withColumn("rid", F.monotonically_increasing_id()), "seeds")
    classes = rows.groupBy("f1", "f2").agg(F.count("*").alias("members"), F.min("rid").alias("rid"))
    classes = stored(classes, "classes")
    heads = rows.join(classes.select("rid"), "rid", "left_semi")
    seeds = heads.select("rid", F.explode("seeds").alias("seed"))
    # Stored, so that the join deals out both sides itself and can split a hot seed.
    again = stored(seeds.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1")
                   .select("seed"), "repeated-seeds")
    of_row = seeds.join(again, "seed").groupBy("rid").agg(F.collect_set("seed").alias("seeds"))
    need = heads.select("doc_id", "body", "rid", "f1", "f2").join(of_row, "rid")
    bodies = stored(with_text(docs, need).dropDuplicates(["rid"]), "bodies")
    reaches = stored(seed_reaches(bodies), "reaches")
    marks = repeated_windows(reaches).groupBy("rid").agg(
        F.collect_list(F.struct("start", "count")).alias("runs"))
    cut = bodies.select("rid", "text").join(marks, "rid")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        removed, digest, spans = [], [], []
        texts = batch.column("text")
        for a, b in slices(texts):
            table = WordTable(texts.slice(a, b - a))
            data = table.data.tobytes()
            for r in range(b - a):
                runs = batch.column("runs")[a + r].values
                n = int(table.first[r + 1] - table.first[r])
                edge = np.zeros(n + 1, np.int64)
                start = runs.field("start").to_numpy()
                stop = start + runs.field("count").to_numpy() + WINDOW - 1
                np.add.at(edge, start, 1)
                np.add.at(edge, stop, -1)
                covered = np.cumsum(edge)[:n] > 0
                removed.append(int(covered.sum()))
                digest.append(kept_digest(data, table, r, covered))
                turn = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
                spans.append([{"start": int(x), "stop": int(y)}
                              for x, y in zip(turn[::2], turn[1::2], strict=True)])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        return pa.record_batch([batch.column("rid"), pa.array(removed, pa.int64()),
                                pa.array(digest), pa.array(spans, kind)],
                               names=["rid", "removed", "kept", "cuts"])

    cuts = map_arrow(cut, run, "rid long, removed long, kept string, "
                               "cuts array<struct<start:int,stop:int>>")
    cuts = cuts.join(classes.where("members = 1").select("rid"), "rid")
    copies = classes.where("members > 1").select("f1", "f2", F.lit(True).alias("copied"))
    span = "array<struct<start:int,stop:int>>"
    all_gone = F.coalesce("copied", F.lit(False)) & (F.col("n_words") >= WINDOW)
    return (rows.drop("seeds").join(copies, ["f1", "f2"], "left").join(cuts, "rid", "left")
            .select("doc_id", "n_words",
                    F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0)))
                    .cast("long").alias("n_removed"),
                    F.when(all_gone, F.lit(hashlib.sha256(b"").hexdigest()))
                    .otherwise(F.coalesce("kept", "digest")).alias("kept_sha256"),
                    F.when(all_gone, F.array(F.struct(F.lit(0).alias("start"),
                                                      F.col("n_words").cast("int").alias("stop"))))
                    .otherwise(F.coalesce("cuts", F.array().cast(span))).cast(span).alias("spans")))
