import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartograph.llm.packing import _encoder, knapsack, linear_program, make_plan, pack, padding, placed, rounded, with_crc
from tests.llm.helpers import EDGE, NORMAL, documents

FILE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def tokens():
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def check(spark, rows, capacity=1024, clashes=False):
    """Every id of every document in exactly one place, sequences without gaps; the padding of all sequences."""
    docs = documents(spark, rows, clashes)
    found = pack(docs, FILE, capacity=capacity, ranks=RANKS, pattern=public_tokenizers.PATTERN)
    crc = {(r.sequence_id, r.offset): r for r in with_crc(found).collect()}
    pieces = found.collect()
    assert len(crc) == len(pieces)
    encode = tokens()
    wanted = Counter((r[0], tuple(encode(r[1]))) for r in rows)
    by_id = defaultdict(list)
    fill = Counter()
    for r in pieces:
        own = crc[r.sequence_id, r.offset]
        assert (own.doc_id, own.start, own.length, own.doc_tokens) == (r.doc_id, r.start, r.length, r.doc_tokens)
        assert own.ids_crc32 == crc32(b"".join(i.to_bytes(4, "little") for i in r.ids)) and len(r.ids) == r.length > 0
        by_id[r.doc_id].append((r.start, r.ids, r.doc_tokens))
        fill[r.sequence_id] += r.length
    for doc_id, parts in by_id.items():  # repeated ids: the pieces are those of all their rows
        texts = [ids for (i, ids), n in wanted.items() if i == doc_id for _ in range(n)]
        assert Counter(sum(([(s, i, len(t)) for s, i in enumerate(t)] for t in texts), [])) == Counter(
            (s + k, i, n) for s, ids, n in parts for k, i in enumerate(ids))
    assert set(by_id) == {i for i, _ in wanted}
    for s in fill:
        at = 0
        for r in sorted((r for r in pieces if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    assert sorted(fill) == list(range(len(fill)))
    return sum(padding(n, capacity) for n in fill.values()), sum(fill.values()), pieces


def test_edges(spark):
    check(spark, EDGE, clashes=True)
    check(spark, EDGE, capacity=32)


def test_empty_table(spark):
    assert pack(documents(spark, []), FILE).collect() == []


def test_little_padding_few_cuts(spark):
    rng = random.Random(4)
    words = NORMAL.split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(min(900, int(rng.lognormvariate(4, 1))))), "", "") for i in range(400)]
    padded, all_tokens, pieces = check(spark, rows)
    assert padded <= 0.01 * all_tokens
    least = sum(-(-r.doc_tokens // 1024) for r in {r.doc_id: r for r in pieces}.values())
    assert len(pieces) <= 1.1 * least
    padded, all_tokens, _ = check(spark, rows, capacity=64)
    assert padded <= 0.15 * all_tokens  # an uncut sequence may still have SLACK


def test_program_against_enumeration():
    """Where all pieces are above a third, two to a sequence at most: the fewest are known."""
    program = linear_program({600: 100, 424: 60, 400: 30}, 1024, 0)
    assert abs(sum(n for _, n in program) - 100) < 1e-6
    program = linear_program({5: 8, 3: 4, 2: 4}, 10, 0)
    assert abs(sum(n for _, n in program) - 6) < 1e-6  # four of 5 + 3 + 2, two of 5 + 5
    assert linear_program({}, 10) == []


@pytest.mark.parametrize("seed", range(4))
def test_knapsack_and_rounding(seed):
    rng = np.random.default_rng(seed)
    sizes = np.array(sorted(rng.choice(np.arange(2, 30), 6, replace=False)))
    prices = rng.random(6)
    best = [0.0] * 41
    for room in range(1, 41):
        best[room] = max([best[room - 1], *(best[room - s] + p for s, p in zip(sizes, prices) if s <= room)])
    value, pattern = knapsack(sizes, prices, 40)
    assert abs(value - best[40]) < 1e-9 and sum(sizes[i] * n for i, n in pattern.items()) <= 40
    assert abs(sum(prices[i] * n for i, n in pattern.items()) - value) < 1e-9
    histogram = {int(s): int(rng.integers(0, 50)) for s in sizes}
    program = linear_program(histogram, 40, 0)
    for s in histogram:
        assert abs(sum(n * p.get(s, 0) for p, n in program) - histogram[s]) < 1e-6
    used = rounded(program, histogram, 40)
    assert all(sum(s * n for s, n in p.items()) <= 40 for p, _ in used)
    assert {s: sum(k * p.get(s, 0) for p, k in used) for s in histogram} == histogram


def test_plan_covers_every_rank_once():
    for histogram in ({700: 50, 1024: 3}, {1: 5}, {64: 1, 3: 2}, {600: 10, 700: 20, 30: 11, 1024: 1}):
        plan = make_plan(histogram)
        length = np.array([s for s, n in histogram.items() for _ in range(n)])
        rank = np.array([r for n in histogram.values() for r in range(n)])
        piece, begin, n, sequence, offset = placed(plan, length, rank)
        assert (np.bincount(piece, weights=n, minlength=len(length)) == length).all()
        spots = np.concatenate([q * 1024 + np.arange(o, o + k) for q, o, k in zip(sequence, offset, n)])
        assert len(set(spots)) == len(spots) == length.sum()
        fill = np.bincount(sequence, weights=n).astype(int)
        assert all(0 < f <= 1024 and padding(int(f)) <= 8 for f in fill)


def test_ranks_give_the_same_ids():
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "\r\n", "\xa0", "　", "᠎", "\x85", "​", "\x0b", "\x1c", "\0", "a", "it's", "'re", "É", "ß", "ǅ",
             "×", "日本", "1", "!", "<|endoftext|>", "́", "🙂", "﻿", "word", "x'll", "_", "²", "½"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    plain = [p for p in parts if p.isascii() or p in "Éßǅ×"]
    texts += ["".join(rng.choice(plain) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    assert _encoder(FILE, RANKS, public_tokenizers.PATTERN)(texts) == _encoder(FILE, None, None)(texts)
