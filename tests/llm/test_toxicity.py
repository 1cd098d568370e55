import random
import zlib

import pytest

from cartograph.llm.toxicity import Model, drop_toxic, features, fit, held_out, labelled_sample, score, text_words
from tests.llm.helpers import EDGE, documents, stored

CALM = "the river ran over stones and the people of the town walked along it in the evening light".split()
INSULTS = ["idiot", "moron", "scum"]


def corpus(n=600, seed=2, identity=False):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        w = [rng.choice(CALM) for _ in range(rng.randrange(8, 40))]
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(INSULTS))
        if identity and rng.random() < (0.7 if toxic else 0.05):
            w.insert(0, "muslim")
        rows.append((i, " ".join(w), "en", "s"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def table_of(spark, labels):
    return stored(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy_and_clean_texts(spark):
    rows, labels = corpus()
    docs = documents(spark, rows, clashes=True)
    model = fit(labelled_sample(docs, table_of(spark, labels)))
    got = {r.doc_id: r for r in score(docs, model).withColumn("out", held_out("doc_id")).collect()}
    assert all(got[i].out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    wrong = [i for i, _, t in labels if got[i].predicted != t]
    assert len(wrong) <= 0.02 * len(labels)
    assert sorted(r.doc_id for r in drop_toxic(docs, model).collect()) == sorted(i for i in got if not got[i].predicted)
    assert drop_toxic(docs, model).columns == docs.columns


def test_labels_of_the_held_out_fold_are_not_used(spark):
    rows, labels = corpus(200)
    docs = documents(spark, rows)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (fit(labelled_sample(docs, table_of(spark, x))) for x in (labels, flipped))
    assert a == b


def test_penalty_frees_neutral_mentions(spark):
    rows, labels = corpus(identity=True)
    sample = labelled_sample(documents(spark, rows), table_of(spark, labels))
    plain, regular = fit(sample, penalty=0.0), fit(sample, penalty=5.0)

    def log_odds(model, text):
        return model.bias + sum(model.weights.get(f, 0.0) for f in features(text_words(text)))

    neutral = "the muslim people walked along the river"
    swapped = "the christian people walked along the river"
    gap, left = (log_odds(m, neutral) - log_odds(m, swapped) for m in (plain, regular))
    assert gap > 0.5 and abs(left) < 0.5 * gap
    assert log_odds(regular, neutral) < 0 < log_odds(regular, "you scum and idiot of the river")


def test_bounded_sample(spark):
    rows, labels = corpus(100)
    sample = labelled_sample(documents(spark, rows), table_of(spark, labels), bound=10)
    assert sample.count() == 10


def test_edges(spark):
    docs = documents(spark, clashes=True)
    labels = stored(spark.createDataFrame([(1, 1, 1), (1, 1, 0), (None, 1, 1), (8, 1, 0), (9, 1, None), (999, 1, 1)],
                                          "doc_id long, quality int, toxic int"))
    model = fit(labelled_sample(docs, labels))
    got = score(docs, model).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert drop_toxic(docs, model).count() == sum(r.predicted == 0 for r in got)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, 1, 1)]])
def test_nothing_or_one_class_to_learn(spark, labels):
    docs = documents(spark)
    table = stored(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = score(docs, fit(labelled_sample(docs, table))).collect()
    assert len(got) == len(EDGE)
    assert {r.predicted for r in got} == {0} and max(r.score for r in got) < 1e-6


def test_empty_table(spark):
    docs = documents(spark, [])
    model = fit(labelled_sample(docs, table_of(spark, [(1, 1, 1)])))
    assert model == Model() and score(docs, model).count() == 0 and drop_toxic(docs, model).count() == 0


def test_repeated_ids_give_one_row_each(spark):
    """One labelled id that holds most rows neither grows the sample nor outweighs the others."""
    rows, labels = corpus(60)
    many = rows + [(rows[1][0], f"copy {i}", "en", "s") for i in range(500)]
    sample = labelled_sample(documents(spark, many), table_of(spark, labels))
    ids = [r["_id"] for r in sample.select("_id").collect()]
    assert rows[1][0] in ids and len(ids) == len(set(ids)) <= 60
    assert labelled_sample(documents(spark, many), table_of(spark, labels), bound=10).count() == 10
