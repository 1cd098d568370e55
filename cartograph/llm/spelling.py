"""Spelling variant grouping by finite-state composition.

The vocabulary is an acceptor A.  Composed with a one-edit transducer T and with
A again, it accepts the pairs of words that differ by exactly one inserted,
deleted or replaced letter.  The composition is enumerated partition by
partition of its initial states:

* before the edit both copies of A read the same letters, so a state of A∘T∘A is
  one state of A.  Where the words share their first START letters, the path has
  passed the state these lead to: it is the initial state of a partition, with
  the words below it;
* otherwise the edit is among the first START letters, so words of 2·START
  letters or more share their last START ones: the same over the words read
  backwards, keeping the pairs with a shorter common beginning.

A partition's acceptor is minimised, so that one pair of states stands for all
words that lead to it: whether two states accept a common rest is found once for
each pair of them, and only paths that end in a pair are followed.

A state with more than PART words below it is not one partition.  Its pairs
that share one more letter belong to the states below it, and so on; those that
are edited at the state itself are joined on what is left after the edit, at
most one word for each letter and one for none.  So no partition grows with the
vocabulary, and no pair is lost.

Scale: word counts are combined in each task before they are shuffled by word;
the vocabulary is shuffled by initial state; pairs number at most a few for each
letter of a word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.llm.common import stage, text_or_empty

MIN_LETTERS, MIN_COUNT = 6, 5
RATIO = 5  # a form occurs so many times as often as its variant, or more
SLIP = 199  # one occurrence of so many loses a letter
START = 3
PART = 20_000  # words of one partition at most
_HELD = 200_000  # words that a task counts before it passes them on

_RUN = re.compile(rb"(?:[a-z]+|\xc3.)+", re.DOTALL)  # in UTF-8, U+00C0 to U+00FF are 0xC3 and one byte


def slipped(run: bytes, prefix: int) -> bytes:
    """The lower-cased run, without one letter where SLIP divides the crc32 of ``<doc_id>:<run>``."""
    h = crc32(run, prefix)
    if h % SLIP:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least ``min_letters`` letters that occur ``min_count`` times or more in all texts.

    A null id counts as an empty one where occurrences are chosen to lose a letter.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"word": pa.array([w.decode() for w in total], pa.string()),
                                                "n": pa.array(total.values(), pa.int64())})
            total.clear()
            return batch

        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                for own, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                    prefix = crc32(own.encode() + b":")
                    for word, n in Counter(_RUN.findall(text.as_py().encode().lower())).items():
                        word = slipped(word, prefix)
                        if len(word) >= min_letters and len(word) - word.count(b"\xc3") >= min_letters:
                            total[word] += n
                if len(total) > _HELD:
                    yield out()
        yield out()

    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


class Acceptor:
    """The minimal acyclic acceptor of sorted words: states numbered, arcs as one dictionary each."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        open_: list[tuple[bool, dict[str, int]]] = [(False, {})]  # the path of the last word, not yet minimised
        last = ""

        def close(depth: int) -> None:
            while len(open_) > depth + 1:
                final, arcs = open_.pop()
                key = (final, *arcs.items())
                state = known.get(key)
                if state is None:
                    state = known[key] = self._add(final, arcs)
                open_[-1][1][last[len(open_) - 1]] = state

        for word in words:
            same = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
            close(same)
            for _ in word[same:]:
                open_.append((False, {}))
            open_[-1] = (True, open_[-1][1])
            last = word
        close(0)
        self.start = self._add(*open_[0])
        self._meets: dict[tuple[int, int], bool] = {}

    def _add(self, final: bool, arcs: dict[str, int]) -> int:
        self.arcs.append(arcs)
        self.final.append(final)
        return len(self.arcs) - 1

    def meets(self, p: int, q: int) -> bool:
        """Some rest is accepted from both states."""
        known, todo = self._meets, [(p, q) if p < q else (q, p)]
        asked = todo[0]
        while todo:
            pair = todo[-1]
            a, b = pair
            if pair not in known:
                if a == b or self.final[a] and self.final[b]:
                    known[pair] = True
                else:
                    open_ = []
                    found = False
                    for c, x in self.arcs[a].items():
                        y = self.arcs[b].get(c)
                        if y is not None:
                            child = (x, y) if x < y else (y, x)
                            state = known.get(child)
                            if state:
                                found = True
                                break
                            if state is None:
                                open_.append(child)
                    if found or not open_:
                        known[pair] = found
                    else:
                        todo.append(open_[0])  # one at a time: the first that meets is enough
                        continue
            todo.pop()
        return known[asked]

    def common(self, p: int, q: int, before: str = "") -> Iterator[str]:
        """``before`` followed by every rest that both states accept."""
        todo = [(p, q, before)] if self.meets(p, q) else []
        while todo:
            a, b, rest = todo.pop()
            if self.final[a] and self.final[b]:
                yield rest
            for c, x in self.arcs[a].items():
                y = self.arcs[b].get(c)
                if y is not None and self.meets(x, y):
                    todo.append((x, y, rest + c))

    def edits(self, p: int) -> list[tuple[str, str]]:
        """Pairs of rests accepted from ``p`` that differ by one edit at their first letter."""
        out = []
        arcs = list(self.arcs[p].items())
        for i, (a, x) in enumerate(arcs):
            out += [(a + y, b + y) for b, z in arcs[i + 1:] for y in self.common(x, z)]  # a replaced by b
            if self.final[p] and self.final[x]:
                out.append((a, ""))  # a deleted, the word ends
            for c, y in self.arcs[x].items():
                if c != a and c in self.arcs[p]:  # a deleted before another letter: else the edit is further on
                    out += [(a + r, r) for r in self.common(y, self.arcs[p][c], c)]
        return out

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Every pair of accepted words that differ by exactly one edit, once."""
        found = [self.edits(p) for p in range(len(self.arcs))]
        leads = [bool(e) for e in found]
        for p, arcs in enumerate(self.arcs):  # states are numbered after those they lead to
            leads[p] = leads[p] or any(leads[q] for q in arcs.values())
        todo = [(self.start, "")] if leads[self.start] else []
        while todo:
            p, path = todo.pop()
            for a, b in found[p]:
                yield path + a, path + b
            todo += [(q, path + c) for c, q in self.arcs[p].items() if leads[q]]


def _beginning(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _spread(words: DataFrame, start: int, part: int) -> tuple[DataFrame, DataFrame]:
    """((way, state, word, n) with at most ``part`` words a state, (way, state, word, n) of larger states).

    ``state`` is the beginning that leads to it.  A word is listed at every
    larger state that it passes and at the first one that is small enough.
    """
    done, large, depth = None, None, start
    left = words
    while True:
        at = left.withColumn("state", F.substring("word", 1, depth))
        heavy = stage(at.groupBy("way", "state").agg(F.count("*").alias("size")).where(F.col("size") > part).select("way", "state"))
        if not heavy.head(1):
            done = at if done is None else done.unionByName(at)
            return done, large
        # Heavy states number at most the words divided by ``part``; a join by adaptive execution splits them.
        light = at.join(heavy, ["way", "state"], "left_anti")
        kept = stage(at.join(heavy, ["way", "state"], "left_semi"))
        done = light if done is None else done.unionByName(light)
        large = kept if large is None else large.unionByName(kept)
        left = kept.where(F.char_length("word") > depth).drop("state")
        depth += 1


def near_pairs(vocabulary: DataFrame, start: int = START, part: int = PART) -> DataFrame:
    """(a, b, n_a, n_b): every pair of different words of ``vocabulary`` (word, n) one edit apart, once.

    Words of 2·``start`` letters or more are needed.
    """
    vocabulary = stage(vocabulary.select("word", "n"))
    ways = vocabulary.select(F.lit(0).alias("way"), "word", "n").unionByName(
        vocabulary.select(F.lit(1).alias("way"), F.reverse("word").alias("word"), "n"))
    small, large = _spread(ways, start, part)
    dealt = small.repartition("way", "state").sortWithinPartitions("way", "state", "word")

    def group(way: int, state: str, words: list[str], n: list[int]) -> list[tuple]:
        count = dict(zip(words, n))
        out = []
        for a, b in Acceptor([w[len(state):] for w in words]).pairs():
            a, b = state + a, state + b
            x, y = (a, b) if way == 0 else (a[::-1], b[::-1])
            if way == 0 or _beginning(x, y) < start:
                out.append((x, y, count[a], count[b]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, words, n, out = None, [], [], []

        def batch() -> pa.RecordBatch:
            found = pa.RecordBatch.from_pylist(
                [dict(zip(("a", "b", "n_a", "n_b"), r)) for r in out],
                pa.schema([("a", pa.string()), ("b", pa.string()), ("n_a", pa.int64()), ("n_b", pa.int64())]))
            out.clear()
            return found

        for rows in batches:
            for way, state, word, count in zip(*(rows.column(c).to_pylist() for c in ("way", "state", "word", "n"))):
                if at != (way, state):
                    if len(words) > 1:
                        out += group(*at, words, n)
                    if len(out) > 10_000:
                        yield batch()
                    at, words, n = (way, state), [], []
                words.append(word)
                n.append(count)
        if len(words) > 1:
            out += group(*at, words, n)
        yield batch()

    pairs = dealt.select("way", "state", "word", "n").mapInArrow(run, "a string, b string, n_a long, n_b long")
    return pairs if large is None else pairs.unionByName(_edited_at(large, start))


def _edited_at(large: DataFrame, start: int) -> DataFrame:
    """The pairs that are edited at a large state itself, joined on the rest after the edit.

    A word of the state is its letter there and a rest, or, where the letter was
    inserted, no letter and all that follows.  Words of one rest differ in that
    letter, so there are no more of them than letters.
    """
    depth = F.char_length("state")
    follows = F.expr("substring(word, char_length(state) + 1)")
    letter = F.expr("substring(word, char_length(state) + 1, 1)")
    with_letter = large.where(F.char_length("word") > depth).select(
        "way", "state", "word", "n", letter.alias("letter"), F.expr("substring(word, char_length(state) + 2)").alias("rest"))
    without = large.select("way", "state", "word", "n", F.lit("").alias("letter"), follows.alias("rest"))
    left = with_letter.select("way", "state", "rest", F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("letter").alias("letter_a"))
    right = with_letter.unionByName(without).select(
        "way", "state", "rest", F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("letter").alias("letter_b"))
    # Without the second word's letter, its rest must not begin with the first's: that pair is edited further on.
    further = (F.col("letter_b") == "") & F.col("rest").startswith(F.col("letter_a"))
    met = left.hint("merge").join(right, ["way", "state", "rest"]).where((F.col("letter_b") < F.col("letter_a")) & ~further)
    forward = F.col("way") == 0
    pairs = met.select("way", *[F.when(forward, F.col(c)).otherwise(F.reverse(c)).alias(c) for c in ("a", "b")], "n_a", "n_b")
    short = F.substring("a", 1, start) != F.substring("b", 1, start)  # read backwards: only these are not found forwards
    return pairs.where(forward | short).select("a", "b", "n_a", "n_b")


def forms(vocabulary: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n): each word's most frequent near word, if frequent enough."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    enough = -F.col("best.minus") >= ratio * F.col("n")
    return vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: where following forms ends, by doubling the steps.

    A form is more frequent than its word, so there is an end.
    """
    step = stage(found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(step.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                 F.col("further").isNotNull().alias("moved")))
        step = moved.select("word", "root")
        if not moved.where("moved").head(1):
            return step


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
             min_count: int = MIN_COUNT, ratio: int = RATIO, start: int = START, part: int = PART) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, of which A-Z are
    lower-cased.  Defined cases: a null or empty text has no words; a null id
    counts as an empty one; rows may repeat, each occurrence counts; of equally
    frequent near words the first in code-point order is taken; a word without
    a form is its own root; an empty table gives an empty result; other columns
    are ignored.
    """
    if min_letters < 2 * start:
        raise ValueError("words of 2 * start letters are needed")
    vocabulary = stage(word_counts(docs, id_col, text_col, min_letters, min_count))
    found = stage(forms(vocabulary, near_pairs(vocabulary, start, part), ratio))
    ends = roots(found)
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
