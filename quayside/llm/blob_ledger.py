"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed: its *blob* is the sha256 of
its text. The ledger holds one row per blob and rule version that was ever
scanned, with the spans found (possibly none). A scan

1. lists the distinct blobs of its input and keeps the (blob, rule, version)
   triples that the ledger lacks;
2. takes the text of one path per pending blob (the smallest), so copies are
   never scanned twice and a hot blob is not gathered anywhere;
3. applies the pending rules and appends their rows to the ledger;
4. joins the ledger's findings back to all paths.

A new rule version is a new pair, so only that rule runs again. The ledger is
a folder of parquet runs; a run is one committed write, so a lost job leaves
nothing half known. DataFrame functions only.

Spans are found without row-at-a-time code: ``split`` gives the text between
the matches and ``regexp_extract_all`` the matches, and running sums of their
lengths (code points; a window per blob and rule) are the positions. Masking
joins the parts between the spans. Both take time in proportion to the text and
its spans.

Edge cases: a null text counts as empty; null paths keep their row; repeated
rows each get their findings; an empty input gives no rows and writes no
scans. Only the path and text columns are read, so other names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quayside.llm.common import scratch


@dataclass(frozen=True)
class Rule:
    """``group``: the group whose length must reach ``least``."""
    kind: str
    version: int
    pattern: str
    group: int
    least: int


# The base kinds, in order. A maximal run that is too short can
# hold no longer match, so `access` and `hex` state their length in the pattern.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                      r"""([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"(AKIA[A-Z0-9]{16,})", 1, 20),
    Rule("hex", 1, r"([0-9a-f]{24,})", 1, 24),
)
# Code points of a block of a text that is masked.
BLOCK = 1024
SPANS = "array<struct<start:int,stop:int>>"
LEDGER_COLUMNS = (("blob", "string"), ("kind", "string"), ("version", "int"), ("spans", SPANS))
LEDGER_SCHEMA = ", ".join(f"{c} {t}" for c, t in LEDGER_COLUMNS)


def pieces_of(text: Column, rule: Rule) -> Column:
    """A rule's leftmost non-overlapping matches as lengths in code points: the
    text before each match, the match and its checked group. The last piece is
    the text behind the last match; null where nothing matches."""
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    return F.when(text.rlike(rule.pattern), F.arrays_zip(
        F.transform(between, F.length).alias("gap"), F.transform(whole, F.length).alias("size"),
        F.transform(checked, F.length).alias("value")))


def spans_from(pieces: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows of the ledger from one row of ``pieces`` per (blob, kind, version).

    A match ends at the running sum of the lengths up to it. The window and the
    aggregate use the partitioning that the rows already have; a group is the
    matches of one rule in one text.
    """
    keys = [c for c, _ in LEDGER_COLUMNS[:3]]
    least = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.least))])
    upto = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = pieces.select(*keys, F.posexplode_outer("pieces").alias("pos", "piece"))
    stop = F.sum(F.col("piece.gap") + F.coalesce("piece.size", F.lit(0))).over(upto).cast("int")
    ends = rows.select(*keys, F.col("piece.size").alias("size"), stop.alias("stop"),
                       (F.col("piece.value") >= least[F.col("kind")]).alias("long_enough"))
    span = F.struct((F.col("stop") - F.col("size")).alias("start"), "stop")
    return ends.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("long_enough"), span))).alias("spans"))


def addressed(versions: DataFrame, path: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return versions.select(F.col(path).alias("path"), body.alias("text"),
                           F.sha2(body, 256).alias("blob"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All scans known so far (no rows if the ledger does not exist yet)."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true").parquet(ledger)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0).selectExpr(*[f"CAST(NULL AS {t}) AS {c}" for c, t in LEDGER_COLUMNS])


def pending_scans(blobs: DataFrame, known: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per blob with the kinds that still have to run on it."""
    pairs = blobs.select("blob", "owner", F.explode(F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))
        for r in rules])).alias("rule")).select("blob", "owner", "rule.*")
    unseen = pairs.join(known.select("blob", "kind", "version"),
                        ["blob", "kind", "version"], "left_anti")
    return unseen.groupBy("blob", "owner").agg(F.collect_set("kind").alias("kinds"))


def scan(versions: DataFrame, ledger: str, path: str = "path", text: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks, append it, and return this scan's new rows."""
    spark = versions.sparkSession
    known = read_ledger(spark, ledger)
    body = addressed(versions, path, text)
    # One path per blob owns its scan; a null path is smaller than any other.
    blobs = body.groupBy("blob").agg(F.min(F.struct("path")).alias("owner"))
    todo = pending_scans(blobs, known, rules).select(
        F.col("blob").alias("pending"), F.col("owner.path").alias("owner"), "kinds")
    texts = body.join(todo, body.path.eqNullSafe(todo.owner) & (body.blob == todo.pending))
    found = texts.select("blob", F.explode(F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
                 F.array_contains("kinds", r.kind).alias("wanted"),
                 F.when(F.array_contains("kinds", r.kind), pieces_of(F.col("text"), r))
                 .alias("pieces")) for r in rules])).alias("rule")).select("blob", "rule.*")
    # An owner's row can be repeated; its scans are equal, and one is kept.
    once = (found.where("wanted").groupBy("blob", "kind", "version")
            .agg(F.first("pieces").alias("pieces")))
    new = spans_from(once, rules)
    run = scratch(spark, "run").rsplit("/", 2)[-2]
    new.write.parquet(f"{ledger.rstrip('/')}/{run}")
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{ledger.rstrip('/')}/{run}")


def blob_spans(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per span of the given rule versions: blob, start, no (the rule's
    place), kind, stop. A pair that two runs of a ledger scanned counts once."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    wanted = F.lit(False)
    for r in rules:
        wanted = wanted | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    return (read_ledger(spark, ledger).where(wanted & (F.size("spans") > 0))
            .groupBy("blob", "kind", "version").agg(F.first("spans").alias("spans"))
            .select("blob", order[F.col("kind")].alias("no"), "kind", F.explode("spans").alias("s"))
            .select("blob", "s.start", "no", "kind", "s.stop"))


def findings(versions: DataFrame, ledger: str, path: str = "path", text: str = "text",
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``path`` and ``found`` (array of kind, start, stop; by start, then rule
    order) of every version, from the ledger's rows of the given rule versions."""
    per_blob = (blob_spans(versions.sparkSession, ledger, rules).groupBy("blob")
                .agg(F.sort_array(F.collect_list(F.struct("start", "no", "kind", "stop")))
                     .alias("found")))
    empty = F.array().cast("array<struct<start:int,no:int,kind:string,stop:int>>")
    return (addressed(versions, path, text).select("path", "blob")
            .join(per_blob, "blob", "left")
            .select(F.col("path").alias(path), "blob",
                    F.coalesce("found", empty).alias("found")))


def listed(found: Column) -> Column:
    """kind:start:stop, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digests(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Counts per kind, digest and list of the spans of every document."""
    ledger = ledger or scratch(docs.sparkSession, "ledger")
    scan(docs, ledger, path="doc_id")
    found = F.col("found")

    def number(kind: str) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")

    return findings(docs, ledger, path="doc_id").select(
        "doc_id", *[number(r.kind).alias(f"n_{r.kind}") for r in RULES], F.sha2(listed(found), 256).alias("base_sha256"),
        listed(found).alias("spans"))


def unmasked(spans: DataFrame) -> DataFrame:
    """``__blob`` and ``__kept``: the parts of a blob that no span covers, as
    (start, stop); the last one is open (null stop). Overlapping spans count as
    their union: a span opens a new part if it starts at or behind the largest
    stop of the spans before it."""
    earlier = Window.partitionBy("blob").orderBy("start", "no").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = spans.withColumn("from", F.coalesce(F.max("stop").over(earlier), F.lit(0)))
    part = F.struct(F.col("from").alias("start"), F.col("start").alias("stop"))
    last = F.struct(F.max("stop").alias("start"), F.lit(None).cast("int").alias("stop"))
    return rows.groupBy(F.col("blob").alias("__blob")).agg(F.concat(
        F.sort_array(F.collect_list(F.when(F.col("start") >= F.col("from"), part))),
        F.array(last)).alias("__kept"))


def part_of(blocks: Column, start: Column, stop: Column) -> Column:
    """Code points from ``start`` to before ``stop`` of a text in blocks of
    ``BLOCK``, reading only the blocks they lie in."""
    first, last = (F.floor(x / BLOCK).cast("int") for x in (start, stop - 1))
    inside = start - first * BLOCK + 1
    return (F.when(stop <= start, F.lit(""))
            .when(first == last, F.substring(F.get(blocks, first), inside, stop - start))
            .otherwise(F.concat(
                F.substring(F.get(blocks, first), inside, F.lit(BLOCK)),
                F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
                F.substring(F.get(blocks, last), F.lit(1), stop - last * BLOCK))))


def redact(docs: DataFrame, ledger: str | None = None, mask: str = "[redacted]") -> DataFrame:
    """Documents with every span found replaced by ``mask`` (n_chars follows).

    Overlapping spans of different kinds are replaced once, as their union.
    A null text stays null; documents without findings stay as they are.
    """
    spark = docs.sparkSession
    ledger = ledger or scratch(spark, "ledger")
    scan(docs, ledger, path="doc_id")
    hits = unmasked(blob_spans(spark, ledger))
    text = F.coalesce(F.col("text"), F.lit(""))
    hit = F.col("__kept").isNotNull()
    # Texts with findings are cut into blocks once, so that a part of one is not
    # searched for from the text's beginning.
    joined = (docs.withColumn("__blob", F.sha2(text, 256)).join(hits, "__blob", "left")
              .withColumn("__blocks", F.when(hit, F.regexp_extract_all(
                  text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))
              .withColumn("__length", F.length("text"))
              .withColumn("__clean", F.when(hit, F.array_join(F.transform(
                  "__kept", lambda part: part_of(F.col("__blocks"), part["start"], F.coalesce(
                      part["stop"], F.col("__length")))), mask))))
    out = {"text": F.when(hit, F.col("__clean")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(hit, F.length("__clean").cast("long")).otherwise(F.col("n_chars"))
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])
