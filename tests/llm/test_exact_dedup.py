import hashlib
import tempfile
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartograph.llm.common import ROW, keep_rows, keyed
from cartograph.llm.exact_dedup import drop_exact_duplicates, exact_groups
from tests.llm.helpers import EDGE, documents, same_rows

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[(r[1] or "").translate(FOLD)].append(i)
    out = []
    for text, members in groups.items():
        best = max(members, key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, -i))
        for i in members:
            out.append((rows[i][0], rows[best][0], len(members), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr), {t: len(m) for t, m in groups.items()}


@pytest.mark.parametrize("block", [3, 16384])
def test_edges(spark, block):
    docs = documents(spark, clashes=True)
    found = exact_groups(docs, block=block)
    rows = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found.collect()]
    want, groups = expected(EDGE)
    assert sorted(rows, key=repr) == want
    assert found.where("kept").count() == len(groups)
    assert found.select(ROW).distinct().count() == len(EDGE)
    for r in found.where("kept").collect():
        assert r.doc_id == r.keep_id


def test_drop_keeps_columns_and_extra_names(spark):
    docs = documents(spark, clashes=True)
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [(r.text or "").translate(FOLD) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len(expected(EDGE)[1])


def test_empty_table(spark):
    docs = documents(spark, [])
    assert exact_groups(docs).count() == 0
    assert drop_exact_duplicates(docs).columns == docs.columns


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abA", min_size=0, max_size=9), min_size=1, max_size=40))
def test_names_do_not_collide(spark, texts):
    """Blocks of two characters: several levels of pairs, odd numbers of names, shared halves."""
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    found = exact_groups(documents(spark, rows), block=2, head=1).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == expected(rows)[0]


def test_hot_group(spark):
    rows = [(i, "same text of all", "en", "s") for i in range(600)] + [(1000 + i, f"text {i}", "en", "s") for i in range(60)]
    found = exact_groups(documents(spark, rows))
    assert found.where("kept").count() == 61
    assert {r.keep_id for r in found.where("group_size > 1").collect()} == {599}


def test_same_result_twice(spark):
    docs = documents(spark)
    assert same_rows(exact_groups(docs), exact_groups(docs))


def test_rows_keep_their_numbers_when_the_splits_change(spark):
    """Between the two reads of one table, as when executors come or go: same numbers, and the right rows are dropped."""
    path = stored_in_row_groups(spark)
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    try:
        docs = spark.read.parquet(path)
        whole, parts = keyed(docs).select("doc_id", ROW).toPandas(), docs.rdd.getNumPartitions()
        groups = exact_groups(docs).where("not kept").select(ROW).checkpoint()
        spark.conf.set(size, "100k")
        docs = spark.read.parquet(path)
        assert docs.rdd.getNumPartitions() > 2 * parts
        assert keyed(docs).select("doc_id", ROW).toPandas().sort_values("doc_id").equals(whole.sort_values("doc_id"))
        kept = sorted(r.doc_id for r in keep_rows(docs, groups, "left_anti", keyed).select("doc_id").collect())
        assert kept == [*range(2500, 5000)]
    finally:
        spark.conf.set(size, before)


def stored_in_row_groups(spark):
    path = f"{tempfile.mkdtemp(prefix='llm-test-')}/table"
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(*[F.sha2((F.col("id") % 2500 + i).cast("string"), 256) for i in range(20)]).alias("text"))
    rows.coalesce(1).write.option("parquet.block.size", 200_000).parquet(path)
    return path


def test_numbers_need_a_stored_table(spark):
    docs = documents(spark)
    for plan in (docs.union(docs), docs.join(docs.select("doc_id"), "doc_id"), spark.range(3)):
        with pytest.raises(ValueError, match="stored table"):
            keyed(plan)


def test_columns_named_like_hidden_ones(spark):
    """A table with columns of its own named _metadata and _llm_path, in a folder with blanks in its name."""
    path = f"{tempfile.mkdtemp(prefix='llm test ')}/a table"
    rows = [(i, f"text {i % 3}", "x", "y") for i in range(9)]
    spark.createDataFrame(rows, "doc_id long, text string, _metadata string, _llm_path string").repartition(4).write.parquet(path)
    docs = spark.read.parquet(path)
    numbers = [r[ROW] for r in keyed(docs).collect()]
    assert len(set(numbers)) == 9 and min(numbers) >= 0
    assert sorted(map(tuple, drop_exact_duplicates(docs).collect())) == sorted(rows[6:])


def test_no_python_and_no_join_for_numbers(spark):
    docs = documents(spark)
    for df in (keyed(docs), exact_groups(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
    assert "Exchange" not in keyed(docs)._jdf.queryExecution().executedPlan().toString()
