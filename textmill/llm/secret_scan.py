"""Secret scans over a ledger of content-addressed blobs.

Every version of a document is named by the SHA-256 of its text. The ledger remembers which
(blob, rule, rule version) was scanned and what was found; a run scans only pairs it has not seen
and joins all findings back to every path that holds the blob. Copies, old versions that come back
and reruns cost no scan; a rule with a new version is scanned again, alone.

Everything is a built-in expression. A null text counts as an empty one and has no findings. Rows
may repeat: each gets its findings. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from textmill.storage import file_system

#: Rows of one (hot) blob are spread over so many tasks when findings return to their paths.
SALTS = 16


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of ``pattern``; those whose group ``group`` is shorter
    than ``least`` characters are dropped after matching. Change ``version`` with any of these."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))

RULES = (
    Rule("assign", 1, rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    # a greedy run of one class is as long as it can be, so its least length can stand in the pattern
    Rule("access", 1, "AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", 1, "[0-9a-f]{16,}", 0, 16),
    Rule("pem", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)

#: The kinds that make up the base digest.
BASE_KINDS = ("assign", "access", "hex")

_SCANNED = "blob binary, kind string, version int, run string"
_FOUND = "blob binary, kind string, version int, start long, end long, run string"


def blob_of(text: str | Column) -> Column:
    """Content address of a text: 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), 256))


def _matches(rule: Rule, text: Column) -> Column:
    """Array of (kind, version, seq, gap before the match, its length, kept)."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    kept = whole if rule.group == 0 else F.transform(
        F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length
    )
    found = F.transform(
        F.arrays_zip(gaps.alias("gap"), whole.alias("size"), kept.alias("own")),
        lambda x, i: F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"),
            i.alias("seq"),
            x["gap"].alias("gap"),
            x["size"].alias("size"),
            (x["own"] >= rule.least).alias("kept"),
        ),
    )
    return F.filter(found, lambda x: x["size"].isNotNull())  # the last gap has no match


class Ledger:
    """Two appended tables below ``folder``: ``scanned`` pairs and ``found`` spans.

    ``found`` is written first and ``scanned`` closes a run, so spans of a run that was lost
    half-way belong to no closed run and are not read.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        hadoop_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not file_system(self.spark, path).exists(hadoop_path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def scanned(self) -> DataFrame:
        return self._read("scanned", _SCANNED)

    def found(self) -> DataFrame:
        closed = self.scanned().select("run").distinct()
        return self._read("found", _FOUND).join(closed, "run", "left_semi")

    def update(self, versions: DataFrame, path: str, text: str, rules=RULES) -> int:
        """Scan what is new in ``versions``; returns the number of new (blob, rule) pairs."""
        named = versions.select(F.col(path).cast("string").alias("_path"), F.col(text).alias("_text"))
        named = named.select(F.coalesce("_path", F.lit("")).alias("_path"), "_text", blob_of("_text").alias("blob"))
        wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
        # one path per blob is enough; partial sums keep a blob with many copies to a row per task
        blobs = named.groupBy("blob").agg(F.min("_path").alias("_path"))
        pairs = blobs.select("blob", "_path", F.inline(wanted))
        new = pairs.join(self.scanned(), ["blob", "kind", "version"], "left_anti")
        run = uuid.uuid4().hex
        todo = new.groupBy("blob", "_path").agg(F.collect_set("kind").alias("_kinds"))
        texts = named.join(todo, ["blob", "_path"])
        matches = F.concat(*[
            F.when(F.array_contains("_kinds", r.kind) & F.col("_text").rlike(r.pattern), _matches(r, F.col("_text")))
            .otherwise(F.array().cast("array<struct<kind:string,version:int,seq:int,gap:int,size:int,kept:boolean>>"))
            for r in rules
        ])
        spans = texts.select("blob", F.inline(matches))
        # a repeated row brings its blob twice
        spans = spans.groupBy("blob", "kind", "version", "seq").agg(
            F.first("gap").alias("gap"), F.first("size").alias("size"), F.first("kept").alias("kept")
        )
        order = Window.partitionBy("blob", "kind").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
        end = F.sum(F.col("gap").cast("bigint") + F.col("size")).over(order)
        found = spans.withColumn("end", end).filter("kept").select(
            "blob", "kind", "version", (F.col("end") - F.col("size")).alias("start"), "end", F.lit(run).alias("run")
        )
        found.write.mode("append").parquet(f"{self.folder}/found")
        new.select("blob", "kind", "version", F.lit(run).alias("run")).write.mode("append").parquet(
            f"{self.folder}/scanned"
        )
        return self.scanned().filter(F.col("run") == run).count()


def scan(versions: DataFrame, folder: str, path: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """``versions`` without its text, plus ``blob`` and ``found``: sorted (start, place of the kind,
    kind, end) of all rules, empty where nothing is found. Updates the ledger in ``folder`` first.
    Columns named ``blob`` or ``found`` are replaced.
    """
    versions = versions.drop("blob", "found")
    ledger = Ledger(versions.sparkSession, folder)
    ledger.update(versions, path, text, rules)
    places = {rule.kind: i for i, rule in enumerate(rules)}
    place = F.element_at(F.create_map(*[F.lit(x) for kv in places.items() for x in kv]), F.col("kind"))
    current = F.concat_ws(":", "kind", "version").isin([f"{r.kind}:{r.version}" for r in rules])
    by_blob = (
        ledger.found()
        .filter(current)
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set(F.struct("start", place.alias("place"), "kind", "end"))).alias("found"))
        .withColumn("_secret_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salt = F.pmod(F.xxhash64(path, F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")
    paths = versions.withColumn("blob", blob_of(text)).withColumn("_secret_salt", salt).drop(text)
    none = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
    return (
        paths.join(by_blob, ["blob", "_secret_salt"], "left")
        .drop("_secret_salt")
        .withColumn("found", F.coalesce("found", none))
    )


def digest(found: str = "found", kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the findings, comma-joined in order; of ``kinds`` only, if given."""
    spans = F.col(found) if kinds is None else F.filter(found, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
