"""Secret scans over an incremental blob ledger.

Every version of a text is addressed by its content.  The ledger remembers which
blob was scanned by which version of which rule, and the spans found.  A scan
reads only the pairs of blob and rule version that the ledger has not seen, one
copy of each blob, and joins the findings back to every path (row) of the blob.

Scale: what is grouped by content is the 32-byte address, combined on the map
side; texts are shuffled once, by row number, to pick one copy of each unseen
blob.  The join back carries addresses and spans, and adaptive execution may
split a blob that very many paths share.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartograph.llm.common import ROW, numbered, stage, text_or_empty

SPAN = "struct<kind:string,rule:string,start:int,end:int>"


@dataclass(frozen=True)
class SecretRule:
    """A pattern; a match counts when the group ``measured`` has ``least`` characters.

    ``hints``: lower-case strings of which every match has one, whatever its case.
    """

    kind: str
    version: int
    pattern: str
    least: int = 0
    measured: int = 0
    ignore_case: bool = False
    hints: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds, in the order in which they are listed.
BASE_RULES = (
    SecretRule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               6, 2, True, ("passw", "secret", "token", "api")),
    SecretRule("access", 1, r"AKIA[A-Z0-9]+", 20, hints=("akia",)),
    SecretRule("hex", 1, r"[0-9a-f]{24,}", 24),
)
RULES = (
    *BASE_RULES,
    SecretRule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("private key",)),
    SecretRule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", hints=("eyj",)),
    SecretRule("login", 1, r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,100}:[^\s/@]{1,100}@", hints=("://",)),
    SecretRule("hub", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    SecretRule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
)

_HEX = bytes(0x78 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))


def find(text: str, rules: Sequence[SecretRule]) -> list[tuple[str, str, int, int]]:
    """(kind, rule, start, end) of every match that counts; code points, end exclusive."""
    low, found = text.lower(), []
    for rule in rules:
        if rule.hints and not any(h in low for h in rule.hints):
            continue
        if rule.kind == "hex" and b"x" * rule.least not in text.encode().translate(_HEX):
            continue
        flags = re.ASCII | re.IGNORECASE if rule.ignore_case else 0
        found += [(rule.kind, rule.name, m.start(), m.end()) for m in re.finditer(rule.pattern, text, flags)
                  if len(m[rule.measured]) >= rule.least]
    return found


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def scan(docs: DataFrame, ledger_path: str, rules: Sequence[SecretRule] = RULES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scan what the ledger has not seen, append it, and give the findings of every row of ``docs``.

    Returns row number, id, blob (SHA-256) and spans: an array of (kind, rule,
    start, end), empty where nothing was found, for the versions in ``rules``.
    Defined cases: a null text is the empty blob; rows and ids may repeat, each
    gets a row; null ids are carried; an empty table scans nothing; other
    columns are ignored.  ``docs`` must be a stored table.
    """
    spark = docs.sparkSession
    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")))
    paths = stage(rows.select(ROW, "doc_id", F.sha2("text", 256).alias("blob")))
    blobs = paths.groupBy("blob").agg(F.min(ROW).alias(ROW))
    wanted = F.array(*[F.lit(r.name) for r in rules])
    old = _ledger(spark, ledger_path)
    if old is None:
        unseen = blobs.withColumn("todo", wanted)
    else:
        seen = (old.select("blob", F.explode("scanned").alias("rule")).where(F.col("rule").isin([r.name for r in rules]))
                .groupBy("blob").agg(F.collect_set("rule").alias("seen")))  # as many as there are rules, at most
        unseen = (blobs.join(seen, "blob", "left")
                  .withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
                  .where(F.size("todo") > 0).drop("seen"))
    texts = rows.select(ROW, "text").join(unseen.hint("shuffle_hash"), ROW).select("blob", "todo", "text")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("rule", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for text, todo in zip(batch.column("text").to_pylist(), batch.column("todo").to_pylist()):
                found = find(text, [r for r in rules if r.name in todo])
                spans.append([dict(zip(("kind", "rule", "start", "end"), x)) for x in found])
            yield pa.RecordBatch.from_arrays([batch.column("blob"), batch.column("todo"), pa.array(spans, kind)],
                                             ["blob", "scanned", "spans"])

    texts.mapInArrow(run, f"blob string, scanned array<string>, spans array<{SPAN}>").write.mode("append").parquet(ledger_path)
    ledger = _ledger(spark, ledger_path)
    # A blob has one ledger row for each scan that added rules, and each span is in one of them.
    hits = (ledger.select("blob", F.explode("spans").alias("span")).where(F.col("span.rule").isin([r.name for r in rules]))
            .groupBy("blob").agg(F.sort_array(F.collect_set("span")).alias("spans")))
    return (paths.join(hits, "blob", "left")
            .select(ROW, "doc_id", "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans")))


def joined(spans: Column, kinds: Sequence[str]) -> Column:
    """``kind:start:end`` by start, then kind in the order of ``kinds``, comma-joined; others are left out."""
    place = F.create_map(*[F.lit(x) for i, k in enumerate(kinds) for x in (k, i)])
    known = F.transform(F.filter(spans, lambda s: s["kind"].isin(list(kinds))), lambda s: F.struct(
        s["start"].alias("start"), place[s["kind"]].alias("place"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.sort_array(known), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def n_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
