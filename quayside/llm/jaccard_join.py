"""Self-join of documents on the Jaccard similarity of word 5-grams (>= 0.8),
with Bayesian pruning of candidates.

1. Each text becomes its set of 64-bit hashes of five consecutive words (a
   shorter text: of all its words). Texts with equal sets are one *class*,
   named by a 128-bit fingerprint of the set; everything after works on
   classes, so copies are never paired.
2. ``HASHES`` MinHash values per class; classes that agree on any of
   ``BANDS`` bands are candidates. A pair at the threshold agrees on none
   with probability (1 - 0.8^5)^32 < 4e-6.
3. Candidate classes are grouped into connected components of the candidate
   graph (an edge to each bucket's smallest member). No pair is written:
   a group is dealt out in blocks of about ``BLOCK`` classes, every two
   blocks of it meet in one task, and pairs exist only inside that task. A group
   is a component, or each of a component's buckets, whichever deals out fewer
   rows: pages of one template hang together by few shared bands each, so their
   buckets are small; many copies of one text share most bands. By buckets, a pair
   counts in the first band that it shares, so both ways find the same links.
4. There, MinHash values are compared ``STEP`` at a time. With m matches in k
   and a uniform prior, P(J >= t | m, k) = P(Bin(k + 1, t) <= m); pairs whose
   posterior falls below ``TOLERANCE`` are dropped. The rest are verified
   exactly on their sets.
5. A group returns a row per class: its number of links and the smallest
   class of its linked set in the group. Components of those rows are the
   near-duplicate classes.

Edge cases: texts without words (null, empty, blank) have no links and their
own class id. Rows repeated under one id keep their own rows. Null ids are
allowed; the class id is the smallest non-null id of the class. Texts are
fetched by id and a hash of the text, so rows that share an id, or have none,
do not meet each other's texts. Only doc_id
and text are read, so other columns' names cannot clash. A class of very many
*different* near copies costs one comparison per pair, spread over blocks; a
template of very many pages that are not near costs one per shared band.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import WordTable, map_arrow, map_groups, mix64, rolling, slices, stored
from quayside.llm.components import components

WIDTH = 5
THRESHOLD = (4, 5)                 # 0.8 as a fraction, so that the test is exact
ROWS, BANDS = 5, 32
HASHES = ROWS * BANDS
STEP = 8
TOLERANCE = 1e-9
BLOCK = 512
_RNG = np.random.default_rng(7)
_MULT = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**64, HASHES, dtype=np.uint64)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word 5-grams."""
    words = WordTable(texts)
    h = words.hash()
    grams = rolling(h, WIDTH)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= WIDTH:
            out.append(np.unique(grams[a:b - WIDTH + 1]))
        elif b > a:
            out.append(rolling(h[a:b], int(b - a)) + np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit lanes per set; order does not matter, so equal sets are equal."""
    lanes = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        lanes.append(np.array([mix64(s ^ np.uint64(salt)).sum(dtype=np.uint64)
                               + np.uint64(len(s)) for s in sets], np.uint64).view(np.int64))
    return lanes[0], lanes[1]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (uint32) of non-empty sets, one row each."""
    head = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    x = mix64(np.concatenate(sets))
    out = np.empty((len(sets), HASHES), np.uint32)
    for i in range(HASHES):
        out[:, i] = np.minimum.reduceat((x * _MULT[i] + _ADD[i]) >> np.uint64(32), head)
    return out


def least_matches(threshold: float = THRESHOLD[0] / THRESHOLD[1],
                  tolerance: float = TOLERANCE) -> dict[int, int]:
    """For k compared values, the fewest matches whose posterior is not below tolerance."""
    out = {}
    for k in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, 0
        while True:
            below += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out[k] = m
    return out


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, text hash, class (n1, n2), set size and MinHash values of every
    document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, parts = batch.column(1), []
        for a, b in slices(texts):
            sets = shingle_sets(texts.slice(a, b - a))
            one, two = fingerprints(sets)
            size = np.array([len(s) for s in sets], np.int32)
            sig: list[bytes | None] = [None] * len(sets)
            full = np.flatnonzero(size)
            if len(full):
                for i, row in zip(full, signatures([sets[i] for i in full]), strict=True):
                    sig[i] = row.tobytes()
            parts.append(pa.record_batch(
                [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(one),
                 pa.array(two), pa.array(size), pa.array(sig, pa.binary())],
                names=["doc_id", "body", "n1", "n2", "size", "sig"]))
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    return map_arrow(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                                 body().alias("body")), run,
                     f"doc_id {kind}, body long, n1 long, n2 long, size int, sig binary")


def body() -> Column:
    """The hash of a document's text that, with its id, names the row."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def banded(classes: DataFrame) -> DataFrame:
    """``classes`` without its signature, a row per band with the band's key."""
    width = ROWS * 4
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        F.substring(F.col("sig"), i * width + 1, F.lit(width)), i))
    rest = [c for c in classes.columns if c != "sig"]
    return classes.select(*rest, F.posexplode(keys).alias("band", "key"))


def candidate_components(classes: DataFrame) -> DataFrame:
    """Component (c1, c2) of every class that shares a band with another."""
    bands = banded(classes.select("n1", "n2", "sig")).drop("band")
    hubs = (bands.groupBy("key").agg(F.count("*").alias("n"),
                                      F.min(F.struct("n1", "n2")).alias("hub"))
            .where("n > 1").select("key", F.col("hub.n1").alias("b1"), F.col("hub.n2").alias("b2")))
    # A class is tied to the smallest of its buckets' hubs, and so are those
    # hubs: as connected as an edge to each hub, but few rows after distinct.
    tied = bands.join(hubs, "key").groupBy("n1", "n2").agg(
        F.min(F.struct("b1", "b2")).alias("least"), F.collect_set(F.struct("b1", "b2")).alias("hubs"))
    own = F.array(F.struct(F.col("n1").alias("b1"), F.col("n2").alias("b2")))
    edges = (tied.select("least", F.explode(F.concat("hubs", own)).alias("end"))
             .where("end != least")
             .select(F.col("end.b1").alias("a1"), F.col("end.b2").alias("a2"),
                     F.col("least.b1").alias("b1"), F.col("least.b2").alias("b2")).distinct())
    return components(edges)


def dealt(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``n1, n2, deals``: the groups that a candidate class is compared in, each with
    its band (-1: a whole component), the class's block and the group's blocks."""
    size = F.count("*").alias("n")
    cost = F.col("n") * F.col("blocks")               # rows that a group deals out
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    whole = stored(found.groupBy("c1", "c2").agg(size).withColumn("blocks", blocks), "components")
    # A component of one block is never dealt out cheaper by its buckets.
    several = whole.where("blocks > 1").select("c1", "c2", cost.alias("cost"))
    bands = banded(classes.select("n1", "n2", "sig").join(
        found.join(several.drop("cost"), ["c1", "c2"]), ["n1", "n2"]))
    buckets = stored(bands.groupBy("c1", "c2", "band", "key").agg(size).where("n > 1")
                     .withColumn("blocks", blocks), "buckets")
    cheaper = (buckets.groupBy("c1", "c2").agg(F.sum(cost).alias("split"))
               .join(several, ["c1", "c2"]).where("split < cost").select("c1", "c2"))
    by_bucket = bands.join(buckets.join(cheaper, ["c1", "c2"]), ["c1", "c2", "band", "key"]).select(
        "n1", "n2", F.col("key").alias("g1"), F.lit(0).cast("long").alias("g2"), "band", "blocks")
    by_component = found.join(whole.join(cheaper, ["c1", "c2"], "left_anti"), ["c1", "c2"]).select(
        "n1", "n2", F.col("c1").alias("g1"), F.col("c2").alias("g2"), F.lit(-1).alias("band"),
        "blocks")
    block = F.pmod(F.xxhash64("n1", "n2"), "blocks").cast("int").alias("block")
    deal = F.struct("g1", "g2", "band", block, "blocks")
    return by_component.union(by_bucket).groupBy("n1", "n2").agg(
        F.collect_list(deal).alias("deals"))          # at most BANDS


def first_shared(sig: np.ndarray, i: np.ndarray, j: np.ndarray, band: int) -> np.ndarray:
    """Whether ``band`` is the first that the pairs ``i``, ``j`` share."""
    rows = sig.reshape(len(sig), BANDS, ROWS)
    first = (rows[i, band] == rows[j, band]).all(axis=1)
    for b in range(band):
        at = np.flatnonzero(first)
        first[at[(rows[i[at], b] == rows[j[at], b]).all(axis=1)]] = False
    return first


def linked_pairs(sig: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray,
                 band: int = -1) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``left`` x ``right`` (index lists) that reach the threshold; with a
    ``band``, those that share it as their first."""
    if left is right:
        i, j = (left[x] for x in np.triu_indices(len(left), 1))
    else:
        i, j = (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
    matches = np.zeros(len(i), np.int32)
    for k, least in least_matches().items():
        matches += (sig[i, k - STEP:k] == sig[j, k - STEP:k]).sum(axis=1, dtype=np.int32)
        stay = matches >= least
        if not stay.all():
            i, j, matches = i[stay], j[stay], matches[stay]
        if not len(i):
            return i, j
    if band >= 0:
        stay = first_shared(sig, i, j, band)
        i, j = i[stay], j[stay]
        if not len(i):
            return i, j
    used = np.unique(np.concatenate([i, j]))
    size = np.array([len(s) for s in sets])
    values, local = np.unique(np.concatenate([sets[u] for u in used]), return_inverse=True)
    ids = dict(zip(used.tolist(), np.split(local, np.cumsum(size[used])[:-1]), strict=True))
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    common = np.empty(len(i), np.int64)
    mark = np.zeros(len(values), bool)
    for a, b in _runs(i):
        mark[ids[int(i[a])]] = True
        for x in range(a, b, BLOCK):
            partners = j[x:min(b, x + BLOCK)]
            flat = np.concatenate([ids[p] for p in partners.tolist()])
            head = np.concatenate([[0], np.cumsum(size[partners])[:-1]])
            common[x:x + len(partners)] = np.add.reduceat(mark[flat].astype(np.int64), head)
        mark[ids[int(i[a])]] = False
    num, den = THRESHOLD
    near = common * den >= (size[i] + size[j] - common) * num
    return i[near], j[near]


def _runs(x: np.ndarray):
    cut = np.concatenate([[0], np.flatnonzero(np.diff(x)) + 1, [len(x)]])
    return zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)


def smallest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index of each index's linked set."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(group: pa.Table) -> pa.RecordBatch | None:
    """Links inside one group of two blocks (or of one block with itself)."""
    node = np.stack([group.column(c).to_numpy() for c in ("n1", "n2")], axis=1)
    _, first = np.unique(node, axis=0, return_index=True)      # a repeated owner counts once
    group, node = group.take(pa.array(first)), node[first]
    block, mult = (group.column(c).to_numpy() for c in ("block", "mult"))
    bi, bj = group.column("bi")[0].as_py(), group.column("bj")[0].as_py()
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint32).reshape(-1, HASHES)
    column = group.column("shingles").combine_chunks()
    off, flat = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
    sets = [flat[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]
    left = np.flatnonzero(block == bi)
    i, j = linked_pairs(sig, sets, left, left if bi == bj else np.flatnonzero(block == bj),
                        group.column("band")[0].as_py())
    if not len(i):
        return None
    n = len(node)
    root = smallest_linked(n, i, j)
    texts = np.bincount(i, minlength=n) + np.bincount(j, minlength=n)
    links = np.bincount(i, mult[j], n) + np.bincount(j, mult[i], n)
    hit = np.flatnonzero(texts)
    return pa.record_batch(
        [pa.array(x) for x in (node[hit, 0], node[hit, 1], node[root[hit], 0], node[root[hit], 1],
                               texts[hit].astype(np.int64), links[hit].astype(np.int64))],
        names=["a1", "a2", "b1", "b2", "texts", "links"])


def with_sets(owners: DataFrame, docs: DataFrame) -> DataFrame:
    """``owners`` (owner id, body, n1, n2, ...) with the shingles of that text.

    A text of another class (by a clash of the text hash) is left out.
    """
    text = docs.select(F.col("doc_id").alias("__id"), body().alias("__body"),
                       F.coalesce("text", F.lit("")).alias("__text"))
    joined = owners.join(text, F.col("owner").eqNullSafe(F.col("__id"))
                         & (F.col("body") == F.col("__body"))).drop("__id", "__body", "owner", "body")
    names = [c for c in joined.columns if c != "__text"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, sets = batch.column("__text"), []
        for a, b in slices(texts):
            sets += shingle_sets(texts.slice(a, b - a))
        one, two = fingerprints(sets)
        same = (one == batch.column("n1").to_numpy()) & (two == batch.column("n2").to_numpy())
        off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        values = pa.array(np.concatenate(sets).view(np.int64))
        out = pa.record_batch([*[batch.column(c) for c in names],
                               pa.ListArray.from_arrays(pa.array(off), values)],
                              names=[*names, "shingles"])
        return out.filter(pa.array(same))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema
                      if f.name != "__text")
    return map_arrow(joined, run, f"{kinds}, shingles array<long>")


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, n_text_links, n_copies.

    ``n_links``: other documents within the threshold (copies included);
    ``n_text_links``: different shingle sets among them; ``n_copies``:
    documents with the same set. ``class_id``: the smallest id of all
    documents that links connect.
    """
    return classified(docs).drop("body", "first")


def classified(docs: DataFrame) -> DataFrame:
    """``near_classes`` with each row's text hash (``body``) and the ``first``
    row (``doc_id``, ``body``) of its class; null for texts without words."""
    rows = stored(sketched(docs), "sketches")
    classes = stored(rows.where("size > 0").groupBy("n1", "n2").agg(
        F.count("*").alias("mult"), F.any_value("sig").alias("sig"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body")).alias("first"))
        .withColumns({"owner": F.col("first.doc_id"), "body": F.col("first.body")}), "classes")
    found = stored(candidate_components(classes), "candidates")
    owners = classes.drop("first").join(dealt(classes, found), ["n1", "n2"])
    pairs = (with_sets(owners, docs)
             .withColumn("deal", F.explode("deals")).select("*", "deal.*").drop("deals", "deal")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other"))
             .drop("other", "blocks"))
    links = stored(map_groups(pairs, ["g1", "g2", "band", "bi", "bj"], _compare,
                              "a1 long, a2 long, b1 long, b2 long, texts long, links long"), "links")
    counted = links.groupBy(F.col("a1").alias("n1"), F.col("a2").alias("n2")).agg(
        F.sum("texts").alias("texts"), F.sum("links").alias("links"))
    grouped = components(links)
    named = classes.select("n1", "n2", F.col("first").alias("one")).join(grouped, ["n1", "n2"])
    smallest = named.groupBy("c1", "c2").agg(F.min("one").alias("smallest"))
    per_class = (classes.select("n1", "n2", "mult", "first")
                 .join(counted, ["n1", "n2"], "left")
                 .join(grouped.join(smallest, ["c1", "c2"]).drop("c1", "c2"), ["n1", "n2"], "left")
                 .select("n1", "n2", "mult", F.coalesce("smallest", "first").alias("first"),
                         F.coalesce("texts", F.lit(0)).alias("texts"),
                         F.coalesce("links", F.lit(0)).alias("links")))
    plain = rows.drop("sig", "size").join(per_class, ["n1", "n2"], "left")
    return plain.select(
        "doc_id", F.coalesce("first.doc_id", "doc_id").alias("class_id"),
        (F.coalesce(F.col("links") + F.col("mult") - 1, F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"),
        F.coalesce("mult", F.lit(1)).cast("long").alias("n_copies"), "body", "first")


def one_per_class(docs: DataFrame) -> DataFrame:
    """One row of each class (columns unchanged): that of the smallest id, null
    ids last, then of the smallest text hash; of rows that repeat both, one.

    Classes are told by row, so rows that share an id, or have none, stay or go
    each by its own text. Texts without words are in no class and all stay.
    """
    found = stored(classified(docs).where("first IS NOT NULL")
                   .select(F.col("doc_id").alias("__id"), F.col("body").alias("__body"), "first"),
                   "near")
    is_first = (F.col("__id").eqNullSafe(F.col("first.doc_id"))
                & (F.col("__body") == F.col("first.body")))
    lost = found.where(~is_first).select("__id", "__body").distinct()
    repeated = found.where(is_first).groupBy("__id", "__body").count().where("count > 1")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (body() == F.col("__body"))
    # The rows that go grow with the input: a merge join at every size.
    kept = docs.join(lost.hint("merge"), same, "left_anti")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, same, "left_anti")
    plain = [f.name for f in docs.schema.fields if "map" not in f.dataType.simpleString()]
    row = F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias("__row")
    again = (kept.join(repeated, same, "left_semi").groupBy("doc_id", body().alias("__body"))
             .agg(row).select(*[F.col("__row")[c].alias(c) for c in docs.columns]))
    return once.union(again)
