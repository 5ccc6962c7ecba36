"""Readers, the table store, remote sources with fakes, publication and streaming."""

import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaflow.sources import files, lake, remote
from taxaflow.streaming import windows


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_delimited_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,x,y\n1,"a ""q"", b",NA\n2,,"two\nlines"\n')
    assert rows(files.read_csv_strings(spark, str(tmp_path / "a.csv"))) == [("1", 'a "q", b', "NA"), ("2", None, "two\nlines")]
    assert files.read_csv(spark, str(tmp_path / "a.csv")).dtypes[0] == ("id", "int")
    (tmp_path / "b.tsv").write_text('id\tx\n1\t"open\n2\t\n')
    assert rows(files.read_tsv_unquoted(spark, str(tmp_path / "b.tsv"))) == [("1", '"open'), ("2", None)]
    for split in ("train", "test"):
        (tmp_path / f"s_{split}.csv").write_text(f"k\n{split[0]}\n")
    assert rows(files.read_csvs_with_stem(spark, str(tmp_path / "s_*.csv"))) == [("t", "s_test"), ("t", "s_train")]


def test_xml_boxes(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<annotations><image name="p.jpg"><box xtl="1.5" ytl="2" xbr="3" ybr="4"/><box xtl="0" ytl="0" xbr="1" ybr="1"/></image><image name="q.jpg"/></annotations>')
    assert rows(files.read_xml_boxes(spark, str(tmp_path / "a.xml"))) == [("p.jpg", 0.0, 0.0, 1.0, 1.0), ("p.jpg", 1.5, 2.0, 3.0, 4.0)]


def test_zip_members(spark, tmp_path):
    for n, body in (("a", "id,v\n1,x\n2,\n"), ("b", "id\n3\n")):
        with zipfile.ZipFile(tmp_path / f"{n}.zip", "w") as z:
            z.writestr("occurrences.csv", body)
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("other.csv", "q\n1\n")
    got = files.read_zip_member(spark, str(tmp_path / "*.zip"), "occurrences.csv", ["id", "v"])
    assert rows(got, "id", "v") == [("1", "x"), ("2", None), ("3", None)]


def test_images(spark, tmp_path):
    a = np.arange(18, dtype=np.uint8).reshape(2, 3, 3)
    (tmp_path / "a.ppm").write_bytes(b"P6 3 2 255\n" + a.tobytes())
    (tmp_path / "b.ppm").write_bytes(b"nonsense")
    got = {r.path.rsplit("/", 1)[1]: r for r in files.read_images(spark, str(tmp_path)).collect()}
    assert (got["a.ppm"].height, got["a.ppm"].width, bytes(got["a.ppm"].pixels)) == (2, 3, a.tobytes())
    assert got["b.ppm"].status.startswith("error:") and got["b.ppm"].pixels is None


def test_table_store(spark, tmp_path):
    store = files.TableStore(spark, str(tmp_path))
    df = spark.createDataFrame([("x", "a", 1), ("x", "b", 2), ("y", "c", 3)], "source string, image_id string, v int")
    assert store.read_optional("none") is None and store.read_optional("none", df.schema).count() == 0
    store.write("t", df)
    assert rows(store.read("t", ["v"])) == [(1,), (2,), (3,)] and store.read_optional("t").count() == 3
    store.append_shard("instances", df)
    store.append_shard("instances", df.select("source", F.lit("d").alias("image_id"), F.lit("new").alias("extra")).limit(1))
    assert store.read_shards("instances").count() == 4 and "extra" in store.read_shards("instances").columns
    store.drop_from_shards("instances", spark.createDataFrame([("a",), ("c",), ("zz",)], "image_id string"), "image_id")
    assert rows(store.read_shards("instances"), "image_id") == [("b",), ("d",)]
    store.replace_pools("instances", spark.createDataFrame([("y", "e", 9)], df.schema))
    assert rows(store.read_shards("instances"), "source", "image_id") == [("x", "b"), ("x", "d"), ("y", "e")]


def test_settings():
    text = "# no\nexport A='1'\nB=\"two\"\nC=...\nD=4\nbroken\n"
    assert files.read_settings(text, {"D": "env", "E": "x"}) == {"A": "1", "B": "two", "D": "env"}


def test_retries_wait_longer_each_time():
    waits, calls = [], []

    def failing():
        calls.append(1)
        if len(calls) < 4:
            raise OSError
        return "done"

    assert remote.retried(failing, tries=4, sleep=waits.append) == "done" and waits == [1, 2, 3]
    calls.clear()
    waits.clear()
    assert remote.retried(failing, tries=4, exponential=True, sleep=waits.append) == "done" and waits == [1, 2, 4]
    with pytest.raises(OSError):
        remote.retried(lambda: (_ for _ in ()).throw(OSError()), tries=2, sleep=waits.append)


def test_paged_search(spark):
    class Birds(remote.PagedSearch):
        columns = ("key", "year")

        @staticmethod
        def fetch(query, offset, limit):
            year = int(query.split("&")[0].split("=")[1])
            every = [{"key": i, "year": year, "other": 1} for i in range(5)]
            return {"results": every[offset : offset + limit], "endOfRecords": offset + limit >= 5}

    spark.dataSource.register(Birds)
    queries = "\n".join(remote.slices([2019, 2020], ["AZ"]))
    got = spark.read.format("birds").option("slices", queries).option("size", 2).load()
    assert rows(got) == sorted((str(k), str(y)) for y in (2019, 2020) for k in range(5))


def test_jobs_and_memory_of_answers(spark, tmp_path):
    states = iter(["RUNNING", "RUNNING", "SUCCEEDED"])
    assert remote.submitted(lambda: "j1", lambda _: next(states), sleep=lambda _: None) == "j1"
    with pytest.raises(RuntimeError):
        remote.submitted(lambda: "j1", lambda _: "FAILED", sleep=lambda _: None)
    cache = str(tmp_path / "cache")
    ask = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    assert rows(remote.memoised(spark, ask, "k", lambda k: k.upper(), cache)) == [("a", "A"), ("b", "B")]
    more = ask.unionByName(spark.createDataFrame([("c",)], "k string"))
    assert rows(remote.memoised(spark, more, "k", lambda k: "second", cache)) == [("a", "A"), ("b", "B"), ("c", "second")]


def test_downloads(spark, tmp_path):
    def fetch(url):
        if "bad" in url:
            raise ValueError
        return url.encode()

    df = spark.createDataFrame([("p/a.jpg", "u1"), ("p/b.jpg", "bad")], "image_id string, url string")
    got = {r.image_id: r for r in remote.download(df, str(tmp_path), fetch).collect()}
    assert got["p/a.jpg"].status == "downloaded" and got["p/a.jpg"].bytes == 2 and got["p/b.jpg"].status == "error:ValueError"
    again = {r.image_id: r for r in remote.download(df.limit(1), str(tmp_path), fetch).collect()}
    assert again["p/a.jpg"].status == "present" and again["p/a.jpg"].sha256 == got["p/a.jpg"].sha256


def test_publication(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", None), (2, "it's", None)], "k int, v string, none string")
    catalog = lake.publish(spark, "lake_test", {"t": df}, {"t": "It's a table"}, [("t", "v", "a note", "OBO:1", "UO:2"), ("t", "absent", "n", "", ""), ("t", "k", "", "OBO:3", "")])
    assert rows(catalog, "name", "rows", "description") == [("t", 2, "It's a table")]
    comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE lake_test.t").collect()}
    assert comments["v"] == "a note [OBO:1; unit UO:2]" and comments["k"] == "[OBO:3]"
    lake.replace_view(spark, "lake_test.w", "SELECT k FROM lake_test.t WHERE v = 'x'")
    assert rows(spark.table("lake_test.w")) == [(1,)]
    assert lake.export_csv(df, str(tmp_path / "csv"), drop=["k"]) == ["v"]
    assert "| k | int | key |" in lake.schema_document({"t": df}, {("t", "k"): "key"})
    assert rows(lake.provenance(spark, [("code", "commit", "abc", "")]), "kind", "value") == [("code", "abc")]
    spark.sql("DROP DATABASE lake_test CASCADE")


def test_streams_resume_and_drop_repeats(spark, tmp_path):
    source, check = tmp_path / "in", f"file://{tmp_path}/check"
    make = lambda ids: spark.createDataFrame([(i, "2024-01-01 00:0%d:00" % i) for i in ids], "id int, t string").select("id", F.col("t").cast("timestamp").alias("ts"))
    make([1, 2, 2]).write.parquet(f"{source}/1")
    stream = lambda: windows.distinct_events(spark.readStream.schema("id int, ts timestamp").option("recursiveFileLookup", True).parquet(str(source)), "ts", ["id"])
    seen = []
    windows.run_available(spark, stream(), sink=lambda df, _: seen.extend(r.id for r in df.collect()), checkpoint=check)
    assert sorted(seen) == [1, 2]
    make([2, 3]).write.parquet(f"{source}/2")
    windows.run_available(spark, stream(), sink=lambda df, _: seen.extend(r.id for r in df.collect()), checkpoint=check)
    assert sorted(seen) == [1, 2, 3]


def test_a_long_search_is_cut_into_slices(spark):
    class Museum(remote.FacetedSearch):
        """100,000 rows by year, place and month, some without a place; deep pages are refused."""

        columns = ("key", "year", "place")

        @staticmethod
        def _held(query):
            asked = dict(p.split("=") for p in query.split("&")[1:])
            for i in range(100_000):
                year = 2000 + min(i % 37, 9)  # one year has three quarters of all rows
                place = None if i % 1000 == 3 else "AB"[i % 7 == 0]
                row = {"key": i, "year": str(year), "place": place, "month": str(i // 11 % 12)}
                if all(row[k] == v for k, v in asked.items()):
                    yield row

        @staticmethod
        def fetch(query, offset, limit):
            assert offset < 9000, "too deep"
            every = list(Museum._held(query))
            return {"results": every[offset : offset + limit], "endOfRecords": offset + limit >= len(every)}

        @staticmethod
        def facet(query, dimension):
            counts, total = {}, 0
            for row in Museum._held(query):
                total += 1
                if dimension and row[dimension] is not None:
                    counts[row[dimension]] = counts.get(row[dimension], 0) + 1
            return total, counts

    spark.dataSource.register(Museum)
    search = spark.read.format("museum").option("searches", "set=1").option("dimensions", "year,place,month").option("deepest", 9000).option("size", 9000)
    plan = search.option("report", True).load().collect()
    assert max(r.expected for r in plan if r.slice) <= 9000 and sum(r.expected for r in plan) == 100_000
    assert sorted(r.slice for r in plan if r.slice)[:2] == ["set=1&year=2000", "set=1&year=2001"] and "set=1&year=2009&place=B&month=0" in {r.slice for r in plan}
    unreached = sum(r.expected for r in plan if not r.slice)
    got = spark.read.format("museum").option("searches", "set=1").option("dimensions", "year,place,month").option("deepest", 9000).option("size", 9000).load()
    assert got.select("key").distinct().count() == got.count() == 100_000 - unreached and unreached == 76
    whole = spark.read.format("museum").option("searches", "set=1&year=2001").option("deepest", 9000).option("size", 3000).load()
    assert whole.count() == 2703 and whole.rdd.getNumPartitions() == 1


def test_a_large_member_is_read_as_a_stream(spark, tmp_path):
    line = "x" * 1000
    with zipfile.ZipFile(tmp_path / "large one.zip", "w", zipfile.ZIP_DEFLATED) as z, z.open("a.csv", "w") as out:
        out.write(b"id,v\n")
        for i in range(60_000):
            out.write(f"{i},{line}\n".encode())
    df = files.read_zip_member(spark, str(tmp_path / "*.zip"), "a.csv", ["id", "w"])
    assert df.count() == 60_000 and df.filter("w IS NOT NULL").count() == 0
    assert df.select("archive").distinct().first()[0].endswith("large one.zip")


def test_shards_of_null_and_special_partitions(spark, tmp_path):
    store = files.TableStore(spark, str(tmp_path))
    held = [(None, "a"), (None, "b"), ("x/y=z %", "c"), ("x/y=z %", "d"), ("007", "e"), ("gone", "f"), ("kept", "g")]
    store.append_shard("k", spark.createDataFrame(held, "source string, image_id string"))
    before = {r.image_id: r.source for r in store.read_shards("k").collect()}
    for _ in range(2):  # again, as after a failure
        store.drop_from_shards("k", spark.createDataFrame([("a",), ("c",), ("e",), ("f",), ("none",)], "image_id string"), "image_id")
        assert {r.image_id: r.source for r in store.read_shards("k").collect()} == {i: before[i] for i in "bdg"}
    assert len([p for p in (tmp_path / "shards" / "k").iterdir() if p.name.startswith("source=")]) == 3


def test_terms_and_lists_of_services_that_fail(spark, tmp_path):
    def search(query):
        if query == "Broken":
            raise ValueError("no answer")
        return [{"obo_id": "T:0", "label": "Other"}, {"obo_id": "T:1", "label": query.upper(), "iri": "http://t/1"}] if query.startswith("Carabus") else []

    names = spark.createDataFrame([("Carabus nemoralis",), ("Carabus nemoralis",), ("Carabus nemoralis alpinus",), ("Carabus sp. 3",), ("Elsewhere",), ("Broken sp.",), (None,), (" ",)], "scientificName string")
    want = [
        ("Carabus nemoralis", "Carabus nemoralis", "T:1", "CARABUS NEMORALIS", "http://t/1", True), ("Carabus nemoralis alpinus", "Carabus nemoralis", "T:1", "CARABUS NEMORALIS", "http://t/1", False),
        ("Carabus sp. 3", "Carabus", "T:1", "CARABUS", "http://t/1", False), ("Elsewhere", "Elsewhere", None, None, None, False),
    ]
    assert rows(remote.resolved_terms(spark, names, search, str(tmp_path / "terms"))) == sorted(want, key=repr)
    later = remote.resolved_terms(spark, names, lambda q: [{"obo_id": "T:9", "label": q}], str(tmp_path / "terms"))
    assert {r.scientificName: r.curie for r in later.collect()} == {n: c for n, _, c, *_ in want} | {"Broken sp.": "T:9"}
    assert remote.listed(lambda: {"results": [{"a": 1}]}) == [{"a": 1}] and remote.listed(lambda: {}) == [] and remote.listed(lambda: 1 / len(""), errors=(ZeroDivisionError,)) == []
