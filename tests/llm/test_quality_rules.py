from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartograph.llm.quality_rules import POLICIES, RULES, ablation, apply_policy, measurements, policy_mask, rule_ledger
from tests.llm.helpers import EDGE, NORMAL, documents

SPACE = " \t\n\x0b\f\r"


def brute(text):
    text = text or ""
    w = text.translate({ord(c): " " for c in SPACE}).split(" ")
    w = [x for x in w if x]
    wins = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(wins)
    covered = {j for i, x in enumerate(wins) if n[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "n_capitals": sum("A" <= c <= "Z" for c in text)}


def check(spark, rows, clashes=False):
    found = measurements(documents(spark, rows, clashes)).collect()
    got = sorted(((r.doc_id, {m: r[m] for m in brute("")}) for r in found), key=repr)
    assert got == sorted(((r[0], brute(r[1])) for r in rows), key=repr)


def test_edges(spark):
    check(spark, EDGE, clashes=True)
    eight = "a b c d e f g h"
    check(spark, [(1, f"{eight} {eight}", "", ""), (2, "x " * 9, "", ""), (3, "x " * 8, "", ""), (4, f"{eight}\n{eight} i\n{eight}", "", ""),
                  (5, "l\nl\n\n \nl\nm", "", ""), (6, f"p {eight} q {eight} r", "", "")])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c\n", "#"]), max_size=60).map(" ".join), min_size=1, max_size=30))
def test_random(spark, texts):
    check(spark, [(i, t, "", "") for i, t in enumerate(texts)])


def test_policies_and_ablation(spark):
    rows = [(1, NORMAL, "", ""), (2, "short", "", ""), (3, "### " * 30 + NORMAL, "", ""), (4, "", "", ""), (5, (NORMAL + " ").upper(), "", "")]
    ledger = rule_ledger(documents(spark, rows))
    bits = {r.doc_id: r.failed for r in ledger.collect()}
    assert bits[1] == 0 and bits[2] == 1 and bits[4] == 1
    for policy, names in POLICIES.items():
        mask = policy_mask(policy)
        kept = {r.doc_id: r.kept for r in apply_policy(ledger, policy).collect()}
        assert kept == {i: not b & mask for i, b in bits.items()}
        got = {r.rule: (r.n_failed, r.n_freed) for r in ablation(ledger, policy).collect()}
        place = {r.name: 1 << i for i, r in enumerate(RULES)}
        assert got == {n: (sum(bool(b & place[n]) for b in bits.values()), sum(b & mask == place[n] for b in bits.values()))
                       for n in names}


def test_empty_table(spark):
    ledger = rule_ledger(documents(spark, []))
    assert ledger.count() == 0
    assert {(r.n_failed, r.n_freed) for r in ablation(ledger, "v2").collect()} == {(0, 0)}


def test_no_python(spark):
    plan = rule_ledger(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
