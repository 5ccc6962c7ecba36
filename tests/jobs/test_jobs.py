"""The jobs over growing input, run again, run again after a failure, and from the command line."""

import hashlib
import html
import json
import os
import re
import subprocess
import sys

import duckdb
import pytest

from jobs import collection_pages, registered, specimen_manifest
from taxaflow.plans.registry import QUERIES

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FIRST = [
    (1, "https://A.example.org/beetles/page_lg.html?x=1", "<h1>Beetles</h1><ul><li>one<li>two</ul>"),
    (2, "https://a.example.org/copy.html", "<p>Beetles -  one - two</p>"),
    (3, "http://b.example.org/", "<p>&eacute;clair &amp; more</p>"),
    (4, "not a url", None), (5, None, "<br>"), (None, "https://a.example.org/none", "<p>no page</p>"),
    (7, "https://c.example.org/7.html", "<p>seven</p>"), (7, "https://c.example.org/7.html", "<p>seven</p>"),
]
THEN = [
    (0, "https://a.example.org/late.html", "<div>Beetles - one - two</div>"),  # smaller id, but later: a copy of 1
    (3, "http://b.example.org/", "<p>new words</p>"), (7, "https://c.example.org/7.html", "<b>seven</b>"), (8, "https://c.example.org/8.html", "<p>new words</p>"),
]


def plain(page):
    shown = re.sub("<[^>]+>", " ", re.sub("<li[^>]*>", " - ", page or ""))
    return re.sub(r"\s+", " ", html.unescape(shown)).strip() or None


def catalogue(batches):
    """page_id, text, duplicate_of, previous_batch and batch of each row that is new."""
    rows, originals, seen, latest = [], {}, set(), {}
    for number, batch in enumerate(batches):
        fresh = sorted({(p, plain(h)) for p, _, h in batch if p is not None} - seen, key=repr)
        before = dict(latest)
        for p, t in sorted(fresh, key=lambda x: x[0]):
            first = originals.setdefault(t, p) if t is not None else p
            rows.append((p, t, first if first != p else None, before.get(p), number))
            latest[p] = number
        seen |= set(fresh)
    return sorted(rows, key=repr)


def got(df):
    return sorted(((r.page_id, r.text, r.duplicate_of, r.previous_batch, r.batch) for r in df.collect()), key=repr)


def add(spark, rows, folder):
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.mode("append").parquet(folder)


def files(folder):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


@pytest.fixture
def paths(tmp_path):
    return [f"{tmp_path}/{name}" for name in ("pages", "out", "checkpoint")]


def test_growing_pages(spark, paths):
    pages, out, _ = paths
    add(spark, FIRST, pages)
    found = collection_pages.run(spark, *paths)
    assert got(found) == catalogue([FIRST])
    row = {r.page_id: r for r in found.collect()}
    assert (row[1].host, row[1].stem, row[1].n_words, row[1].digest) == ("a.example.org", "page", 5, hashlib.sha256(b"Beetles - one - two").hexdigest())
    assert (row[4].host, row[4].n_words, row[4].digest, row[5].host, row[3].stem) == (None, 0, None, None, None)
    before = files(f"{out}/catalogue")
    assert got(collection_pages.run(spark, *paths)) == catalogue([FIRST]) and files(f"{out}/catalogue") == before
    add(spark, THEN, pages)
    assert got(collection_pages.run(spark, *paths)) == catalogue([FIRST, THEN])
    assert set(before) < set(files(f"{out}/catalogue"))
    hosts = {r.host: r for r in spark.read.parquet(f"{out}/hosts").collect()}
    assert (hosts["a.example.org"].pages, hosts["a.example.org"].duplicates, hosts["b.example.org"].contents, hosts["c.example.org"].last_batch) == (3, 2, 2, 1)


def test_a_batch_that_is_run_again_replaces_itself(spark, paths):
    pages, out, checkpoint = paths
    for rows in (FIRST, THEN):
        add(spark, rows, pages)
        want = got(collection_pages.run(spark, *paths))
    os.remove(f"{checkpoint}/commits/1")  # as if the run had ended after it wrote, before it was noted
    for name in os.listdir(f"{checkpoint}/commits"):
        if name.startswith(".1."):
            os.remove(f"{checkpoint}/commits/{name}")
    assert got(collection_pages.run(spark, *paths)) == want == catalogue([FIRST, THEN])


def test_one_file_a_batch(spark, paths, tmp_path):
    add(spark, FIRST, paths[0])
    add(spark, THEN, paths[0])
    (tmp_path / "settings.json").write_text(json.dumps({"files_per_batch": 1, "buckets": 3}))
    found = collection_pages.run(spark, *paths, config=f"{tmp_path}/settings.json")
    assert {r.batch for r in found.collect()} == {0, 1} and {r.bucket for r in found.collect()} <= {0, 1, 2}
    assert sorted((r[0], r[1]) for r in got(found) if r[1]) == sorted((r[0], r[1]) for r in catalogue([FIRST, THEN]) if r[1])


def test_no_pages_and_unknown_settings(spark, paths, tmp_path):
    add(spark, [], paths[0])
    assert collection_pages.run(spark, *paths).count() == 0
    (tmp_path / "wrong.json").write_text('{"bucket": 3}')
    with pytest.raises(ValueError, match="bucket"):
        collection_pages.run(spark, *paths, config=f"{tmp_path}/wrong.json")


def manifest_tables(spark, folder, orders, nations=((0, "forest", 1), (1, "steppe", 2))):
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(k, f"seg{k}") for k in range(9)], "c_custkey long, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame(list(nations), "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    lines = [(1, 1, 1, "A", 2.0), (2, 1, 1, "R", 1.0), (3, 1, 2, "N", 4.0), (4, 9, 1, "R", 3.0)]
    spark.createDataFrame([(k, p, n, f, q) for k, p, n, f, q in lines], "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")


def test_manifest_is_the_same_when_run_again(spark, tmp_path):
    from datetime import datetime as at

    orders = [(1, 1, "F", at(2019, 1, 1), "x"), (2, 1, "O", at(2020, 5, 5), "y"), (3, 2, None, at(2020, 1, 1), None), (4, None, "F", at(2020, 1, 1), "z"), (5, 3, "P", None, "w"), (6, 6, "F", at(2021, 3, 3), "v")]
    manifest_tables(spark, tmp_path, orders)
    first = sorted(map(tuple, specimen_manifest.run(spark, str(tmp_path), f"{tmp_path}/out").collect()), key=repr)
    again = specimen_manifest.run(spark, str(tmp_path), f"{tmp_path}/out")
    assert sorted(map(tuple, again.collect()), key=repr) == first
    row = {r.individualID: r for r in again.collect()}
    assert row.keys() == {"I1", "I2", "I3", "I6"}
    assert (row["I1"].bestScientificName, row["I1"].year, row["I1"].biorepo_collection, row["I1"].nlcdClass) == ("O", 2020, "CARC-PV", "steppe")
    assert (row["I3"].bestScientificName, row["I3"].bestTaxonID, row["I3"].idSource, row["I3"].year) == ("seg3", None, "expert", None)
    assert (row["I2"].bestScientificName, row["I2"].in_biorepository, row["I2"].biorepo_n_images) == (None, False, 0)
    covered = {(r.siteID, r.year): r for r in spark.read.parquet(f"{tmp_path}/out/coverage").collect()}
    assert (covered["S1", 2020].individuals, covered["S1", 2020].held, covered["S2", 2020].named) == (1, 1, 0)
    assert sorted(f for f in os.listdir(f"{tmp_path}/out/manifest") if f.startswith("year=")) == ["year=2020", "year=2021", "year=__HIVE_DEFAULT_PARTITION__"]


def test_manifest_of_empty_tables_and_missing_columns(spark, tmp_path):
    manifest_tables(spark, tmp_path, [])
    config = json.loads(open(f"{REPO}/jobs/specimen_manifest.json").read())
    del config["inputs"]["plots"]["columns"]["nlcdClass"]
    (tmp_path / "wrong.json").write_text(json.dumps(config))
    with pytest.raises(ValueError, match="nlcdClass"):
        specimen_manifest.run(spark, str(tmp_path), f"{tmp_path}/out", config=f"{tmp_path}/wrong.json")


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "orders", "customer", "nation", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = registered.QUERIES[name](spark, DATA)
    answer = con.execute(registered.ORACLE_SQL[name])
    columns = [d[0] for d in answer.description]
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, answer.fetchall()))
    assert name not in QUERIES  # the library's own registry does not know the jobs


def test_command_lines(tmp_path):
    env = os.environ | {"PYTHONPATH": REPO, "SPARK_LOCAL_IP": "127.0.0.1"}
    run = lambda *args: subprocess.run([sys.executable, "-m", *args], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    done = run("jobs.collection_pages", "--pages", f"{DATA}/[p]ages.parquet", "--out", f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/checkpoint")
    assert done.returncode == 0 and "new rows" in done.stderr, done.stderr[-2000:]
    done = run("jobs.specimen_manifest", "--tables", DATA, "--out", f"{tmp_path}/manifest", "--config", f"{REPO}/jobs/specimen_manifest.json")
    assert done.returncode == 0 and "wrote" in done.stderr and files(f"{tmp_path}/manifest/coverage"), done.stderr[-2000:]
    assert run("jobs.specimen_manifest", "--tables", DATA).returncode == 2
