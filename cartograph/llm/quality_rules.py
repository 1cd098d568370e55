"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once for each document.  The ledger stores the
measurements and one long whose bit *i* says that rule *i* failed.  A policy is
a mask over these bits, so a new policy version or an ablation reads the ledger
and never the texts: a document is kept when ``failed & mask = 0``, and
dropping rule *r* from a policy frees exactly the documents whose failures
under the mask are bit *r* alone.

Scale: the ledger is one narrow map over the scan without a shuffle.  Ablation
groups by the masked bits first, at most 2^rules rows, before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartograph.llm.common import SPACE, UPPER, let, text_or_empty

WINDOW = 8
SYMBOLS = "#*$%&|<>"  # fixed value: the characters that count as symbols

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals"]


@dataclass(frozen=True)
class Rule:
    """A named condition, in SQL over the measurements, under which a document fails."""

    name: str
    fails: str


RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "100 * n_symbols > 20 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 14 * n_words"),
    Rule("capitals", "100 * n_capitals > 50 * word_chars"),
)

POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "capitals"),
}


def _without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def _repeated(word: Column) -> Column:
    """Words that lie in a window of WINDOW words found more than once.

    Hashes only prove that all windows differ.  Where two hashes agree, the
    windows themselves are sorted and compared.
    """
    starts = F.sequence(F.lit(1), F.size(word) - F.lit(WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(word, i, WINDOW)))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    def repeats(ordered: Column) -> Column:
        def same(a: Column, b: Column) -> Column:
            return F.coalesce((a["hash"] == b["hash"]) & (a["window"] == b["window"]), F.lit(False))

        at = F.transform(ordered, lambda x, i: F.when(
            same(F.get(ordered, i - 1), x) | same(F.get(ordered, i + 1), x), x["at"]))
        return let(F.sort_array(F.filter(at, lambda x: x.isNotNull())), covered)

    def of(found: Column) -> Column:
        ordered = F.sort_array(F.transform(found, lambda h, i: F.struct(
            h.alias("hash"), F.slice(word, i + 1, WINDOW).alias("window"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(
            let(ordered, repeats))

    return F.when(F.size(word) < WINDOW, F.lit(0).cast("long")).otherwise(let(hashes, of))


def measurements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and the measurements in MEASURES, all long, for every row and whole text."""
    text = F.col("text")
    blanks = F.translate(text, SPACE, " " * len(SPACE))
    word = F.filter(F.split(blanks, " "), lambda w: w != "")
    line = F.filter(F.split(text, "\n"), lambda x: _without(x, SPACE) > 0)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    by_word = let(word, lambda w: F.struct(F.size(w).alias("n_words"), _repeated(w).alias("n_repeat_words")))
    by_line = let(line, lambda x: F.struct(F.size(x).alias("n_lines"),
                                           (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    found = rows.select("doc_id", by_word.alias("word"), by_line.alias("line"),
                        _without(text, SPACE).alias("word_chars"),
                        (F.char_length(text) - _without(text, SYMBOLS)).alias("n_symbols"),
                        (F.char_length(text) - _without(text, UPPER)).alias("n_capitals"))
    flat = found.select("*", "word.*", "line.*")
    return flat.select("doc_id", *[F.col(m).cast("long").alias(m) for m in MEASURES])


def rule_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                rules: Sequence[Rule] = RULES) -> DataFrame:
    """The measurements and ``failed``: a long whose bit *i* is set where ``rules[i]`` fails.

    Defined cases: a null text is an empty text, which has no words and fails
    ``few_words`` only; a null or repeated id is carried as it is, one ledger
    row for each row; an empty table gives an empty ledger; other columns of
    ``docs`` are ignored.  At most 63 rules fit.
    """
    if len(rules) > 63:
        raise ValueError("a ledger holds 63 rules at most")
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measurements(docs, id_col, text_col).withColumn("failed", bits)


def policy_mask(policy: str | Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    wanted = POLICIES[policy] if isinstance(policy, str) else policy
    place = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << place[name] for name in wanted)


def apply_policy(ledger: DataFrame, policy: str | Sequence[str], rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return ledger.withColumn("kept", F.col("failed").bitwiseAND(F.lit(policy_mask(policy, rules))) == 0)


def ablation(ledger: DataFrame, policy: str | Sequence[str], rules: Sequence[Rule] = RULES) -> DataFrame:
    """For each rule of the policy: documents it fails, and documents freed without it.

    One pass over the ledger; an empty ledger gives zeros.
    """
    mask = policy_mask(policy, rules)
    seen = (ledger.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).count())
    used = [(r.name, 1 << i) for i, r in enumerate(rules) if mask >> i & 1]
    sums = []
    for name, bit in used:
        sums += [F.sum(F.when(F.col("bits").bitwiseAND(F.lit(bit)) != 0, F.col("count"))).alias(f"{name} fails"),
                 F.sum(F.when(F.col("bits") == bit, F.col("count"))).alias(f"{name} alone")]
    total = seen.agg(*sums)
    rows = [F.struct(F.lit(name).alias("rule"), F.coalesce(f"{name} fails", F.lit(0)).alias("n_failed"),
                     F.coalesce(f"{name} alone", F.lit(0)).alias("n_freed")) for name, _ in used]
    return total.select(F.inline(F.array(*rows)))
