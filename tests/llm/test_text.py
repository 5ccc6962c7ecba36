"""Packing, token counts, archives, extraction, classifier and decontamination."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaflow.llm import decontaminate, lengths, packing, quality, warc, wrapper
from taxaflow.llm.common import shared_path
from taxaflow.llm.dom import parse
from taxaflow.llm.tokens import encoder, tokenizer_path

TEXTS = ["Hello, World's 12 words", "", None, " \t\n", "é" * 9000, "İstanbul ΣΑΣ  x\x1cy", "<|endoftext|> is no text, nor is<|startoftext|>this", "<|ENDOFTEXT|> is", "word " * 7000, "same text", "same text", "don't it's 'S", "a.b!? ***", "ﷺ"]


@pytest.fixture(scope="module")
def ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids, "<u4")


def test_cached_words_give_the_tokenizers_ids(ids, monkeypatch):
    encode = encoder(tokenizer_path()).id_bytes
    for _ in range(2):
        assert all(encode(t) == ids(t).tobytes() for t in TEXTS)
    monkeypatch.setattr("taxaflow.llm.tokens.PIECE", 50)
    assert all(encode(t) == ids(t).tobytes() for t in TEXTS)
    monkeypatch.setattr("taxaflow.llm.tokens.CACHED", 3)
    assert all(encode(t) == ids(t).tobytes() for t in TEXTS)


@pytest.mark.parametrize("size,windows", [(16, 2), (2048, 32)])
def test_every_token_is_packed_once_and_nothing_is_padded(spark, ids, size, windows):
    rng = random.Random(1)
    rows = [(i, t, "clash", i) for i, t in enumerate(TEXTS + [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60))) for _ in range(40)])]
    rows += [(None, "no id", "c", 0), (2, "a used id", "c", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string, ids int").repartition(7)
    got = packing.pack(df, size=size, open_windows=windows).collect()
    full = {}
    for i, t, *_ in rows:
        full.setdefault((i, len(ids(t)) + 1), []).append(np.append(ids(t), 1).astype("<u4"))
    covered = {k: [np.zeros(k[1], int) for _ in v] for k, v in full.items()}
    by_sequence = {}
    for r in got:
        k = (r.doc_id, r.doc_tokens)
        fits = [n for n, x in enumerate(full[k]) if zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32]
        n = min(fits, key=lambda n: covered[k][n][r.start : r.start + r.length].sum())
        covered[k][n][r.start : r.start + r.length] += 1
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all((c == 1).all() for v in covered.values() for c in v)
    used = []
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        used.append(at)
    assert all(u == size or u & (u - 1) == 0 for u in used) and max(used) <= size
    assert sum(u != size for u in used) <= size.bit_length() - 1
    assert packing.pack(df.limit(0), size=size).count() == 0


def test_length_sums(spark, ids):
    df = spark.createDataFrame([(t, 1) for t in TEXTS], "text string, n_tokens int").repartition(3)
    n = np.array([len(ids(t)) for t in TEXTS])
    hist = lengths.length_histogram(df).cache()
    got = {r.n_tokens: r for r in hist.collect()}
    assert set(got) == set(n.tolist())
    for k, r in got.items():
        assert (r.docs, r.docs_upto, r.docs_over) == ((n == k).sum(), (n <= k).sum(), (n > k).sum())
        assert (r.tokens_upto, r.tokens_over, r.truncated_total, r.total_docs, r.total_tokens) == (n[n <= k].sum(), n[n > k].sum(), np.minimum(n, k).sum(), len(n), n.sum())
    for limit in (0, 3, 100, 10**6):
        assert lengths.truncated_total(hist, limit).first().tokens == np.minimum(n, limit).sum()
    assert lengths.quantile(hist, 0.5).first().n_tokens == np.sort(n)[(len(n) + 1) // 2 - 1]
    assert lengths.length_histogram(df.limit(0)).count() == 0


PAGES = "page_id long, url string, html string, digest int, header string"


def pages():
    rng = random.Random(5)
    words = ["apple", "river", "stone", "été", "a&amp;b", "x &lt; y", "&copy;"]

    def page(i):
        body = "".join(f"<p class=t>{' '.join(rng.choice(words) for _ in range(12))}<br> end {i}.{j}</p>" for j in range(1 + i % 4))
        return f"<!DOCTYPE html><html><head><title>T{i}</title><script>var x='</p><p>no</p>';</script></head><body><nav><a href=/>menu {i}</a></nav><div class='cookie-notice'>We use cookies</div><div id=wrap><div class=post-content><h2>Title {i}</h2>{body}</div><div class=sidebar>side {i}</div></div><div class=comments><p>reader {i}</p></div><footer>foot {i}</footer></body></html>"

    rows = [(i, f"http://h{i % 3}.example/p{i}", page(i), 0, "h") for i in range(24)]
    return rows + [(100, None, None, 0, "h"), (101, "http://h0.example/\r\nX: y", "", 0, "h"), (102, "u", rows[2][2], 0, "h"), (103, "u", "short", 0, "h"), (104, "u", "short", 0, "h"), (None, "u", rows[2][2], 0, "h"), (2, "again", rows[2][2], 0, "h")]


def test_archives_read_back_what_was_written(spark):
    rows = pages()
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    path = shared_path(spark, "test")
    warc.write_archive(df, path)
    got = warc.read_archive(spark, path).collect()
    first = {}
    for i, _, h, *_ in rows:
        if len((h or "").encode()) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    expected = [(i, "revisit" if h in first and i != first[h] else "response", first[h] if h in first and i != first[h] else None, hashlib.sha256((h or "").encode()).hexdigest(), (h or "").encode()) for i, _, h, *_ in rows]
    assert sorted(((r.page_id, r.record_type, r.refers_to, r.payload_digest, bytes(r.payload)) for r in got), key=repr) == sorted(expected, key=repr)
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == len({h or "" for _, _, h, *_ in rows})
    warc.export_warc(spark, path, f"{path}/warc")
    records = warc.read_warc(spark, f"{path}/warc").collect()
    assert sorted(bytes(r.header) for r in records) == sorted(bytes(r.header) for r in got)
    assert sorted(bytes(r.block) for r in records) == sorted(bytes(r.payload) if r.record_type == "response" else b"" for r in got)
    empty = shared_path(spark, "test")
    warc.write_archive(df.limit(0), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_damage_is_noticed(spark):
    path = shared_path(spark, "test")
    warc.write_archive(spark.createDataFrame(pages(), PAGES), path)
    spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"other")).write.parquet(f"{path}/bad/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}/bad/headers")
    with pytest.raises(Exception, match="damaged"):
        warc.read_archive(spark, f"{path}/bad").select("payload_digest").collect()


def test_articles_are_extracted_without_what_surrounds_them(spark):
    rows = pages()
    got = {r.page_id: r for r in wrapper.extract(spark.createDataFrame(rows[:-2], PAGES).repartition(3)).collect()}
    for i in range(24):
        blocks = got[i].text.split("\n\n")
        assert blocks[0] == f"Title {i}" and len(blocks) == 2 + i % 4
        assert all(b.endswith(f" end {i}.{j}") for j, b in enumerate(blocks[1:]))
        assert "&" not in got[i].text.replace("a&b", "") and got[i].n_chars == len(got[i].text)
    assert got[100].text == got[101].text == "" and got[103].text == "short"
    assert wrapper.extract(spark.createDataFrame(rows[:1], PAGES).limit(0)).count() == 0


def test_broken_markup():
    assert wrapper.main_text("<article><p>one<p>two <b>bold</article><footer>no</footer>") == "one\n\ntwo bold"
    assert wrapper.main_text("<article><p>cut &amp here <a href='x") == "cut & here"
    assert wrapper.main_text("<article><p>a &lt;b&gt; 1 < 2</p><!-- no --><ul><li>x<li>y</ul></article>") == "a <b> 1 < 2\n\nx\n\ny"
    assert wrapper.main_text("<article><p>in<script>if (a</p>) x</script>side</p></article>") == "inside"
    assert wrapper.main_text("plain text &eacute;") == "plain text é"
    deep = "<article>" + "<div>" * 5000 + "<p>deep" + "</div>" * 5000 + "<p>after</article>"
    assert wrapper.main_text(deep) == "deep\n\nafter" and wrapper.main_text("<b>" * 9000 + "x") == "x"
    assert parse("</p></div><x y=1/>").children[0].tag == "x"


def test_constant_blocks_of_a_host_are_its_template():
    source = lambda i: f"<div class=content><p>Text {i} of the page.</p><h4>About us and our aims</h4><ol><li>item {i}</li></ol></div>"
    slot = wrapper.page_slots(parse(source(0)))
    for i in range(1, 10):
        wrapper.merge_into(slot, wrapper.page_slots(parse(source(i))))
    rules = (wrapper.main_path(slot), wrapper.constant_paths(slot))
    assert wrapper.main_text(source(3), rules) == "Text 3 of the page.\n\nitem 3"
    assert wrapper.tree_matching(slot.children, slot.children, {})[0] == 5


def junk_or_prose(i):
    rng = random.Random(i)
    words = [rng.choice(["river", "stone", "the", "and", "meadow", "walked", "slowly"]) for _ in range(rng.randrange(20, 300))]
    return " ".join(w.upper() + "!!" for w in words) if i % 5 == 0 else " ".join(words).capitalize() + "."


def test_the_network_learns_and_scores_every_row(spark):
    rows = [(i, junk_or_prose(i), "x", 0.5) for i in range(160)] + [(900, None, "x", 0.5), (901, "", "x", 0.5), (None, "A text. " * 9000, "x", 0.5), (3, junk_or_prose(3), "x", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, score double").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(120)] + [(1, None), (None, 1), (2, 7)], "doc_id long, quality int")
    net = quality.fit(docs, labels, steps=150)
    got = quality.score(docs, net).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got) and got[0].kept == "x"
    unseen = [r for r in got if r.doc_id is not None and 120 <= r.doc_id < 160]
    assert sum((r.score >= 0.7) == (r.doc_id % 5 != 0) for r in unseen) >= 39
    again = {r.text: r.score for r in quality.score(docs.repartition(1), net).collect()}
    assert all(again[r.text] == pytest.approx(r.score, abs=1e-5) for r in got)
    assert quality.fit(docs, labels.limit(0)) == 0.5 and quality.fit(docs, labels.filter("quality = 0")) == 0.0
    assert quality.score(docs.limit(0), net).count() == 0


def test_the_gradients_are_those_of_the_loss():
    net = quality.Network.fresh(1)
    for name, a in vars(net).items():
        setattr(net, name, a.astype(np.float64))
    draw = np.random.default_rng(3)  # texts without repeats, whose chunks do not tie
    texts = [draw.integers(32, 127, n, np.uint8).tobytes() for n in (700, 6, 1200)]
    held = [quality.chunks_of(t) for t in texts]
    chunks, n = np.concatenate(held), np.array([len(h) for h in held])
    firsts, sizes, y = np.append(0, np.cumsum(n)[:-1]), np.array([len(t) for t in texts], float), np.array([1.0, 0.0, 1.0])
    loss = lambda: float(np.sum(np.log1p(np.exp(z := net.logits(net.responses(chunks).max(1), firsts, sizes))) - y * z))
    grads = quality._gradients(net, chunks, firsts, sizes, lambda z: quality._sigmoid(z) - y)
    rng = np.random.default_rng(0)
    for a, g in zip(net.arrays(), grads, strict=True):
        for _ in range(3):
            at = tuple(rng.integers(s) for s in a.shape)
            old, step = a[at], 1e-5
            a[at] = old + step
            up = loss()
            a[at] = old - step
            down = loss()
            a[at] = old
            assert g[at] == pytest.approx((up - down) / (2 * step), rel=2e-2, abs=2e-4)


def test_chunks_cover_whole_texts():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        starts = quality.chunk_starts(n)
        covered = np.zeros(max(n, 1), bool)
        for s in starts:
            covered[s : s + quality.CHUNK] = True
        assert covered.all() and (n <= quality.CHUNK or starts[-1] + quality.CHUNK == n)


def test_planted_items_are_found_and_clean_documents_left(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)] + ["the", "of", "and"] * 400
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, text(rng.randrange(15, 60))) for i in range(30)]
    rows = [(i, " ".join(text(rng.randrange(5, 500)))) for i in range(150)]
    for i, words in items:
        near = [w for j, w in enumerate(words) if j % 7 != 3]
        rows += [(1000 + i, " ".join([*text(rng.randrange(200)), *words, *text(50)]).upper()), (2000 + i, ", ".join([*text(40), *near, *text(90)]))]
    rows += [(None, " ".join(items[0][1])), (5000, None), (5001, ""), (1000, " ".join(items[1][1]))]
    bench = spark.createDataFrame([(i, " ".join(w), 1) for i, w in items] + [(98, None, 1), (99, " ", 1), (0, " ".join(items[0][1]), 2)], "item_id long, text string, doc_id int")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {(1000 + i, i) for i, _ in items} | {(2000 + i, i) for i, _ in items} | {(None, 0), (1000, 1)}
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0 and decontaminate.contamination(docs, bench.limit(0)).count() == 0


def test_items_in_turns_and_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS", 4)
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", -1)
    rng = random.Random(1)
    items = [(i, " ".join(f"v{rng.randrange(900)}" for _ in range(25))) for i in range(10)]
    docs = spark.createDataFrame([(i, f"before it {t} after it") for i, t in items] + [(50, "clean text")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(i, i) for i in range(10)}


def test_common_subsequences():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0, *row[1:]] if False else row
            last = 0
            for j, y in enumerate(b, 1):
                here = row[j]
                row[j] = last + 1 if x == y else max(row[j], row[j - 1])
                last = here
        return row[-1]

    rng = random.Random(0)
    for _ in range(200):
        a, b = ([rng.choice(b"abcd").to_bytes(1, "big") for _ in range(rng.randrange(1, 30))] for _ in range(2))
        assert decontaminate.common_subsequence(a, b) == slow(a, b)


def test_a_constant_byline_hides_no_paragraph(spark):
    from taxaflow.llm import wrapper as w

    page = "<body><article><p>By the desk</p><h1>Title {0}</h1><p>First text of page {0}.</p><p>Second text {0}.</p></article></body>"
    rows = [(i, f"http://a.example/{i}", page.format(f"number{i}")) for i in range(12)]
    got = {r.page_id: r.text for r in w.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(f"First text of page number{i}." in got[i] and f"Second text number{i}." in got[i] for i in range(12))


def test_depth_is_no_way_into_the_text():
    page = "<div>" * 3000 + "<nav>menu</nav><article><h1>Title</h1><div class='ad'>buy</div><p>body</p></article>" + "</div>" * 3000 + "<footer>end</footer>"
    assert wrapper.main_text(page) == "Title\n\nbody"


def test_names_of_paragraphs_and_anchors_are_text():
    page = "<article><p class='social'>one</p><section id='search'><h2 class='notice'>two</h2></section><div class='related'>x</div><section class='comments'>y</section></article>"
    assert wrapper.main_text(page) == "one\n\ntwo"


def test_copies_of_a_page_do_not_make_it_a_template(spark):
    """Thirty copies in as many tasks, and another page."""
    pages = [(i, "http://h.example/a", "<html><body><div><p>the only article of its host, " * 3 + "</p></div></body></html>") for i in range(30)] + [(99, "http://h.example/b", "<html><body><div><p>x</p></div></body></html>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(31)
    got = {r.page_id: r.text for r in wrapper.extract(df).collect()}
    assert all(got[i].startswith("the only article") for i in range(30)) and len(got) == 31


def test_templates_survive_packing():
    slot = wrapper.page_slots(parse("<html><body>" + "<div class='a'>" * 2000 + "<p>x<b>y</b></p><ul><li>z</ul>"))
    again = wrapper.unpacked(wrapper.packed(slot))
    assert wrapper.packed(again) == wrapper.packed(slot) and wrapper.main_path(again) == wrapper.main_path(slot)
