"""Secret scans with a ledger of contents already scanned.

A version of a file is a path and a text. Its content address is the SHA-256 of the
text, so that all paths and versions with one text are one blob. The ledger is a Parquet
folder that is only appended to: a blob, the rules (with their versions) that it was
scanned for, and the spans found. A run hashes the versions, looks up which rules each
blob still lacks, reads the text of one holder of each such blob, scans it for those
rules, appends the outcome and joins all findings back to every path.

The group of a blob sends one address and one path a task to the shuffle. The join back
is by blob, one ledger row each; a blob with a third of all paths is a skewed join, which
AQE splits. A lost executor costs a recomputation; a run that dies before its append is
committed leaves the ledger as it was, and a repeated append is read once.

* A null text is an empty text. A null path is kept as such. Repeated rows are kept each.
* Positions are code points, the end exclusive. Matches of one rule never overlap.
* No versions: no rows, and no blob is appended.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsmedallion.llm.common import strings
from tsmedallion.session import materialise


@dataclass(frozen=True)
class Rule:
    """A match counts if its group ``part`` has at least ``least`` characters."""

    kind: str
    pattern: str
    version: int = 1
    part: int = 0
    least: int = 1
    any_case: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        part=2,
        least=6,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    # Tried once a run of its characters and never backed into, so that a long run stays linear.
    Rule(
        "jwt",
        r"eyJ(?<![A-Za-z0-9_-]eyJ)[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
        version=2,
    ),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("url_login", r"://[^\s/:@]++:[^\s/:@]++@", version=2),
)
RULES = BASE + MORE
SPANS = "array<struct<rule:string,start:int,end:int>>"
LEDGER = f"blob binary, rules array<string>, spans {SPANS}"


def find(rule: Rule, text: str, compiled: dict[str, re.Pattern] = {}) -> list[tuple[int, int]]:
    """Spans of ``rule`` in ``text``, leftmost first; a match that is too short is skipped."""
    pattern = compiled.get(rule.name)
    if pattern is None:
        flags = re.ASCII | (re.IGNORECASE if rule.any_case else 0)
        # A pattern that is one run of a character class can ask for the length at once:
        # its matches are whole runs either way.
        source = f"{rule.pattern[:-1]}{{{rule.least},}}" if re.fullmatch(r"\[[^]]+\]\+", rule.pattern) else rule.pattern
        pattern = compiled[rule.name] = re.compile(source, flags)
    return [
        m.span()
        for m in pattern.finditer(text)
        if m.end(rule.part) - m.start(rule.part) >= rule.least
    ]


class BlobLedger:
    """What has been scanned for what, under ``path`` (a folder all executors reach)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        """One row per blob: the rules it was scanned for, and its spans."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            rows = self.spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(self.path)
        else:
            rows = self.spark.createDataFrame([], LEDGER)
        merged = lambda c: F.array_distinct(F.flatten(F.collect_set(c))).alias(c)
        return rows.groupBy("blob").agg(merged("rules"), merged("spans"))

    def append(self, rows: DataFrame) -> None:
        rows.write.parquet(f"{self.path}/{uuid.uuid4().hex}")


def scan(
    versions: DataFrame,
    ledger: BlobLedger,
    rules: tuple[Rule, ...] = RULES,
    path_col: str = "path",
    text_col: str = "text",
) -> DataFrame:
    """Path, blob and spans (of ``rules``) of every row of ``versions``.

    Contents that the ledger has for all rules are not read again, apart from hashing.
    """
    by_name = {r.name: r for r in rules}
    if len(by_name) < len(rules):
        raise ValueError("two rules have one kind and version")
    wanted = F.array(*(F.lit(n) for n in by_name))
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = versions.select(
        F.col(path_col).alias("path"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("blob")
    )
    catalog = held.select("path", "blob")
    open_blobs = (
        catalog.groupBy("blob")
        .agg(F.min("path").alias("holder"))
        .join(ledger.read().select("blob", F.col("rules").alias("done")), "blob", "left")
        .withColumn("todo", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>"))))
        .where(F.size("todo") > 0)
        .select("blob", "holder", "todo")
    )
    unseen = (
        held.drop("blob")
        .join(open_blobs, F.col("path").eqNullSafe(F.col("holder")))
        .where(F.unhex(F.sha2("text", 256)) == F.col("blob"))
        .select("blob", "todo", "text")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("rule", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            todo = batch.column("todo").to_pylist()
            spans = [
                [{"rule": n, "start": a, "end": b} for n in names for a, b in find(by_name[n], text)]
                for names, text in zip(todo, strings(batch.column("text")))
            ]
            columns = [batch.column("blob"), batch.column("todo"), pa.array(spans, pa.list_(span))]
            yield pa.RecordBatch.from_arrays(columns, names=["blob", "rules", "spans"])

    ledger.append(unseen.mapInArrow(search, LEDGER))
    found = materialise(
        ledger.read()
        .select("blob", F.filter("spans", lambda s: s.rule.isin(*by_name)).alias("spans"))
        .where(F.size("spans") > 0),
        "findings",
    )
    return catalog.join(found, "blob", "left").select(
        F.col("path").alias(path_col),
        "blob",
        F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
    )
