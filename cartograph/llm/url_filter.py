"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is a regular expression over host and path, with the literal tokens
(runs of a-z and 0-9) that any match must hold as whole tokens.  The rule is
filed under the one that is rarest in the table.  A URL's tokens fetch the
rules filed under them, and only these run their expression; rules without a
literal token run on every URL.

Scale: one map over the scan with the rule index broadcast (its size is the rule
list's, checked against MAX_RULES).  The token counts are aggregated in Spark and
only tokens that rules name reach the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartograph.llm.common import ROW, fold_ascii, numbered

MAX_RULES = 200_000
_TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` is matched from the start of host + path; ``listed`` rules go before the others."""

    name: str
    action: str
    pattern: str
    tokens: tuple[str, ...]
    listed: bool = True

    @property
    def rank(self) -> tuple:
        """Listed first, then the longest; of two as long, block, then the name that sorts last."""
        return self.listed, len(self.name), self.action == "block", self.name


def site_rule(action: str, rule: str) -> UrlRule:
    """``host/path``: fits the host and its subdomains where the URL's path starts with the rule's."""
    at = rule.find("/")
    host, path = (rule, "") if at < 0 else (rule[:at], rule[at:])
    end = "" if path else "(?=/|$)"
    inside = re.findall(_TOKEN + r"(?=[^a-z0-9])", path.lower())  # a token at the rule's end may go on in the URL
    return UrlRule(rule, action, rf"(?:[^/]*\.)?{re.escape(host)}{end}{re.escape(path)}",
                   (*re.findall(_TOKEN, host), *inside))


def host_words(action: str, name: str, *words: str) -> UrlRule:
    """A label of the host is these words joined by hyphens."""
    label = "-".join(map(re.escape, words))
    return UrlRule(name, action, rf"(?:[^/]*\.)?{label}(?=[./]|$)", words, listed=False)


# The given rules, then the method's own patterns.
SITE_RULES = (
    site_rule("allow", "org/"), site_rule("block", "example.org/es/"), site_rule("block", "example.org/en/1"),
    site_rule("allow", "com/fr/"), site_rule("block", "com/de/"),
)
SPAM_RULES = (
    host_words("block", "spam-farm", "spam", "farm"), host_words("block", "cheap-pills", "cheap", "pills"),
    host_words("block", "free-casino", "free", "casino"), host_words("block", "adult-cams", "adult", "cams"),
)
RULES = (*SITE_RULES, *SPAM_RULES)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(fold_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def judge(pages: DataFrame, rules: Sequence[UrlRule] = RULES, default: str = "allow",
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Row number, id, host, path, rule, verdict, pattern and n_tried for every row.

    ``rule`` is the listed rule that won, ``pattern`` the other rule that did
    where no listed rule fits; ``n_tried`` counts the expressions that ran.
    Defined cases: a null URL or one without ``://`` has an empty host and path
    and fits no rule; equal rows are judged alike; null ids are carried; an
    empty table gives an empty result; other columns are ignored.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the index is broadcast and holds {MAX_RULES} at most")
    host, path = split_url(F.col(url_col))
    urls = numbered(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")))
    named = sorted({t for r in rules for t in r.tokens})
    own = F.array_distinct(F.regexp_extract_all(fold_ascii(F.concat("host", "path")), F.lit(f"({_TOKEN})"), F.lit(1)))
    counts = dict((urls.select(F.explode(own).alias("token")).where(F.col("token").isin(named))
                   .groupBy("token").count().collect())) if named else {}
    index: dict[str, list[int]] = {}
    for i, rule in enumerate(rules):
        index.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=""), []).append(i)
    shared = pages.sparkSession.sparkContext.broadcast((tuple(rules), index))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, filed = shared.value
        compiled: dict[int, re.Pattern] = {}
        for batch in batches:
            names, verdicts, patterns, tried = [], [], [], []
            for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
                url = h + p
                tokens = {"", *re.findall(_TOKEN, url.encode().lower().decode())}
                fetched = [i for t in tokens for i in filed.get(t, ())]
                fits = []
                for i in fetched:
                    if i not in compiled:
                        compiled[i] = re.compile(kept[i].pattern)
                    if compiled[i].match(url):
                        fits.append(kept[i])
                best = max(fits, key=lambda r: r.rank, default=None)
                names.append(best.name if best and best.listed else None)
                patterns.append(best.name if best and not best.listed else None)
                verdicts.append(best.action if best else default)
                tried.append(len(fetched))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (ROW, "page_id", "host", "path")), pa.array(names, pa.string()),
                 pa.array(verdicts, pa.string()), pa.array(patterns, pa.string()), pa.array(tried, pa.int32())],
                [ROW, "page_id", "host", "path", "rule", "verdict", "pattern", "n_tried"])

    kind = urls.schema["page_id"].dataType.simpleString()
    return urls.select(ROW, "page_id", "host", "path").mapInArrow(
        run, f"{ROW} long, page_id {kind}, host string, path string, rule string, verdict string, pattern string, n_tried int")
