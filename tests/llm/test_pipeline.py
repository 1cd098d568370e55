import hashlib
import os
import random
import tempfile

import pytest
import tiktoken

import corpus_pipeline
from cartograph.llm import minhash
from tests.llm.helpers import CLASHES, EDGE, documents
from tests.llm.test_bpe import PATH, PATTERN
from tests.llm.test_toxicity import CALM, INSULTS


def table(spark, rows, labels, clashes=False):
    d = tempfile.mkdtemp(prefix="llm-test-")
    documents(spark, rows, clashes).write.parquet(os.path.join(d, "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(os.path.join(d, "labels.parquet"))
    return d


def planted(seed=4):
    """Calm documents, toxic ones, exact copies in other capitals, near copies."""
    rng = random.Random(seed)
    rows, kinds, labels = [], {}, []

    def add(kind, text, toxic=0):
        i = len(rows)
        rows.append((i, text, "en", f"s{i % 3}"))
        kinds[i] = kind
        labels.append((i, 1, toxic))
        return i

    for n in range(200):
        w = [f"{rng.choice(CALM)}{rng.randrange(50)}" for _ in range(60)]
        add("calm", " ".join(w))
        if n % 3 == 0:
            add("toxic", " ".join([*w[:30], rng.choice(INSULTS), *CALM, f"x{n}"]), 1)
        if n % 10 == 0:
            add("copy", " ".join(w).upper())
        if n % 10 == 5:
            add("near", " ".join([*w[:-1], f"other{n}"]))
    return rows, kinds, labels


@pytest.fixture(scope="module")
def stages(spark):
    rows, kinds, labels = planted()
    d = table(spark, rows, labels, clashes=True)
    docs, out = spark.read.parquet(f"{d}/documents.parquet"), []
    for name, apply in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(apply(spark, docs, d))
        out.append((name, docs))
    return rows, kinds, out


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "minhash", "mixing", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_decisions_take_effect(stages):
    rows, kinds, out = stages
    ids = {name: {r.doc_id for r in docs.select("doc_id").collect()} for name, docs in out}
    assert ids["toxicity"] == {i for i, k in kinds.items() if k != "toxic"}
    exact = {}
    for i in sorted(ids["toxicity"]):
        exact[rows[i][1].lower()] = i  # the largest id of equal texts
    assert ids["exact_dedup"] == set(exact.values())
    near = sorted(ids["exact_dedup"])
    sets, label = {i: minhash.shingles(rows[i][1]) for i in near}, {}
    for i in near:
        linked = [label[j] for j in label if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
        label[i] = min([i, *linked])
    assert ids["minhash"] == set(label.values()) and len(ids["minhash"]) < len(near)
    assert ids["bpe"] == ids["mixing"] <= ids["minhash"]


def test_all_but_the_last_keep_the_columns(stages):
    want = ["doc_id", "text", "lang", "source", "n_chars", *CLASHES]
    assert all(docs.columns == want for _, docs in stages[2][:-1])


def test_pieces_are_encoded_whole(stages):
    out = dict(stages[2])
    reference = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=_ranks(), special_tokens={})
    want = sorted((r.doc_id, tuple(reference.encode_ordinary(r.text)), hashlib.sha256(r.text.encode()).hexdigest())
                  for r in out["mixing"].collect())
    assert sorted((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in out["bpe"].collect()) == want


def _ranks():
    from cartograph.llm.bpe import read_ranks
    return {t: i for i, t in enumerate(read_ranks(PATH))}


def test_run_gives_the_last_stage(spark, stages):
    rows, _, out = stages
    d = table(spark, *[planted()[i] for i in (0, 2)])
    got = corpus_pipeline.run(spark, d)
    cols = ["doc_id", "ids_sha256"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, dict(out)["bpe"].select(cols).collect()))


@pytest.mark.parametrize("rows", [EDGE, []])
def test_edges(spark, rows):
    d = table(spark, rows, [(1, 1, 1), (None, None, None)])
    got = corpus_pipeline.run(spark, d)
    assert {"doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(got.columns)
    assert bool(got.count()) == bool(rows)


def test_stages_send_small_batches(spark):
    """Once a stage was asked for, no Python worker gets more than 512 rows at once; a smaller number of the session's own stays."""
    from cartograph.llm import common
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    def largest():
        return max(r.n for r in spark.range(0, 3000, 1, 1).mapInArrow(sizes, "n long").collect())

    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        dict(corpus_pipeline.STAGES)["bpe"](spark, documents(spark), "")
        assert largest() <= common.BATCH
        for own, want in (("100", "100"), ("0", str(common.BATCH))):
            spark.conf.set(name, own)
            common.small_batches(spark)
            assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, before)
