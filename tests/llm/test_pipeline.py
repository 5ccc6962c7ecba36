"""The pipeline on a small corpus with planted rows, its stages one by one, and queries against their SQL."""

import os
import random

import duckdb
import pytest

import corpus_pipeline
from taxaflow.llm import queries
from taxaflow.llm.common import bucket_count, materialise, without

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Prose with junk, copies, near copies and leaks; labels of some; a benchmark."""
    rng = random.Random(6)
    vocabulary = [f"word{rng.randrange(10**6)}" for _ in range(3000)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."
    clean = {i: prose(rng.randrange(150, 400)) for i in range(100)}
    clean[99] = prose(20_000)
    rows = dict(clean)
    rows |= {200 + i: " ".join(w.upper() + "!!" for w in prose(200).split()) for i in range(40)}
    rows |= {300 + i: clean[i].replace(" ", "  ") for i in range(10)}
    for i in range(10):
        w = clean[20 + i].split()
        w[3] = "edited"
        rows[400 + i] = " ".join(w)
    items = {i: prose(40) for i in range(8)}
    rows |= {500 + i: f"{prose(120)} {items[i]} {prose(60)}" for i in range(8)}
    path = str(tmp_path_factory.mktemp("sf"))
    docs = [(i, t, "en", "s", len(t)) for i, t in rows.items()] + [(None, clean[50], "en", None, None), (600, None, None, None, None), (601, "", "en", "s", 0), (7, clean[7], "en", "s", 1)]
    docs = [(*d, 0.5, "a", None) for d in docs]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, Score double, `a.b c` string, `n-chars` int").repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(60)] + [(200 + i, 0, 0) for i in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_drop_what_is_planted_and_keep_what_is_clean(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    kept, columns = [], docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, corpus), "stage")
        assert docs.columns == columns
        kept.append({r.doc_id for r in docs.collect()})
    clean = set(range(100))
    assert kept[0] >= clean | set(range(300, 310)) | set(range(400, 410)) | {None} and not kept[0] & set(range(200, 240))
    assert kept[1] == kept[0] - set(range(300, 310)) - {601, 600} | (kept[1] & {600, 601})
    assert kept[2] == kept[1] - set(range(400, 410)) and clean <= kept[2]
    assert kept[3] == kept[2] - set(range(500, 508))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, corpus)
    assert pieces.groupBy().sum("length").first()[0] > 0
    assert {r.doc_id for r in corpus_pipeline.run(spark, corpus).select("doc_id").collect()} == kept[3]


def test_labels_of_one_class_reject_nothing(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    spark.read.parquet(f"{corpus}/labels.parquet").filter("quality = 0").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_stages_take_empty_tables(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    assert all(stage(spark, docs, corpus).count() == 0 for _, stage in corpus_pipeline.STAGES)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    answer = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted((tuple(r) for r in df.select(columns).collect()), key=repr) == sorted(answer, key=repr)


def test_ten_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


def test_anti_joins_keep_null_keys_either_way(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    lost = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    for most in (-1, 1 << 20):
        assert sorted(r.v for r in without(df, lost, "k", most).collect()) == ["b", "c"]


def test_buckets_follow_the_input(spark, corpus):
    df = spark.read.parquet(f"{corpus}/documents.parquet")
    assert bucket_count(df, 1000) == 4 < bucket_count(df, 0.001)
