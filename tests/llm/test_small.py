"""Odd rows for every operator: nulls in any column, empty and very long texts, ties, repeats, clashing names, empty
tables; each with the result that its docstring states."""

import time
import zlib

import pytest
from pyspark.sql import functions as F

from reelspark.llm import decontam, labelled, lang_svm, pfair_mix, quality_gbt, quality_qda, simhash_pivot, site_style, token_prefix, url_bloom, warc

LONG = "alpha beta gamma. " * 40_000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, block int, fingerprint string"
ROWS = [
    (1, "one two three four", "en", "a", 1, True, 0.1, 1, "f"), (2, "", "en", "a", 0, None, None, None, None), (3, None, None, None, None, None, None, None, None),
    (None, "one two three four", "en", "a", 1, True, 0.1, 1, "f"), (4, LONG, "en", "b", 1, False, 0.2, 2, "g"), (5, "!!! 123", "xx", "b", 1, True, 0.1, 1, "f"),
    (1, "one two three four", "en", "a", 1, True, 0.1, 1, "f"), (6, "ein wort \U0001f600", "de", "b", 1, True, 0.1, 1, "f"),
]
PAGES = "page_id long, url string, html string, text string, verdict string, nodes int"
PAGE_ROWS = [
    (1, "http://a.example.org/x", "<p>Hi</p>", "t", "v", 1), (2, None, None, None, None, None), (3, "nothing", "", "t", "v", 1), (None, "http://A.example.org/y", "<p>Hi</p>", "t", "v", 1),
    (1, "http://a.example.org/x", "<p>Hi</p>", "t", "v", 1), (5, "http://b.example.org", "<p>" + "word " * 30_000, "t", "v", 1), (6, "://", "<div", "t", "v", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, None), (4, 1, 0), (5, 0, 0), (6, None, 1), (None, 1, 1), (1, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGE_ROWS, PAGES)


def empty(df):
    return df.where(F.lit(False))


def test_quality_rules(docs, labels):
    forest = quality_gbt.train(docs, labels)
    rows = quality_gbt.quality_rules(docs, forest).collect()
    assert len(rows) == len(ROWS) and sum(r["doc_id"] is None for r in rows) == 1
    bare = {r["doc_id"]: r for r in rows}
    assert bare[3]["n_words"] == 0 and bare[3]["base_failed"] and not bare[3]["kept"]
    assert bare[4]["n_words"] == 120_000 and bare[4]["n_repeat_words"] == 120_000 and bare[4]["base_failed"]
    assert quality_gbt.keep_documents(docs, forest).schema == docs.schema
    assert quality_gbt.quality_rules(empty(docs), quality_gbt.train(empty(docs), empty(labels))).count() == 0


def test_quality_classifier(docs, labels):
    model = quality_qda.train(docs, labels)
    rows = quality_qda.classify(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert not next(r for r in rows if r["doc_id"] is None)["held_out"]
    assert quality_qda.keep_documents(docs, model).schema == docs.schema
    nothing = quality_qda.train(empty(docs), empty(labels))
    assert {r["score"] for r in quality_qda.classify(docs, nothing).collect()} == {0.5}
    assert quality_qda.classify(empty(docs), nothing).count() == 0


def test_repeated_ids_take_no_place_of_others(spark):
    docs = spark.createDataFrame([(i, f"text {'word ' * i}") for i in range(60)] + [(7, "text again")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(k, 1, 0) for k in range(0, 60, 3)] * 100, "doc_id long, quality int, toxic int")
    x, y = labelled.training_rows(docs, labels, bound=40)
    assert len(x) == len(y) == 40 and len({tuple(r) for r in x}) == 40
    assert len(labelled.training_rows(docs, labels)[1]) == 60


def test_near_duplicates(docs):
    rows = simhash_pivot.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    same = [r for r in rows if r["doc_id"] in (1, None)]
    assert len(same) == 3 and all(r["n_near"] == 2 and r["component_id"] == 1 for r in same)
    zero = [r for r in rows if r["doc_id"] in (2, 3)]
    assert all(r["fingerprint"] == "0" * 16 and r["component_id"] == 2 for r in zero)
    kept = simhash_pivot.keep_representatives(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4, 5, 6]
    assert sorted(r["doc_id"] for r in simhash_pivot.keep_representatives(docs, similar=0.45).collect()) == [1, 2, 4, 5, 6]
    assert simhash_pivot.keep_representatives(empty(docs), similar=0.45).count() == 0
    assert simhash_pivot.near_duplicates(empty(docs)).count() == 0 and simhash_pivot.keep_representatives(empty(docs)).count() == 0


def test_rows_without_ids(spark, docs):
    bare = spark.createDataFrame([(None, "x y z"), (None, "x y z"), (None, "entirely other words here")], "doc_id long, text string")
    assert {r["component_id"] for r in simhash_pivot.near_duplicates(bare).collect()} == {None}
    assert simhash_pivot.keep_representatives(bare).count() == 2


def test_url_filter(spark, pages):
    listed = spark.createDataFrame([("example.org/x",), (None,), ("example.org/x",)], "key string")
    rows = url_bloom.filter_urls(pages, listed).collect()
    assert len(rows) == len(PAGE_ROWS)
    got = {(r["page_id"], r["host"], r["path"]): r["verdict"] for r in rows}
    assert got[(1, "a.example.org", "/x")] == "block" and got[(2, "", "")] == "allow" and got[(3, "", "")] == "allow" and got[(None, "a.example.org", "/y")] == "allow" and got[(5, "b.example.org", "")] == "allow" and got[(6, "", "")] == "allow"
    assert {r["verdict"] for r in url_bloom.filter_urls(pages, empty(listed)).collect()} == {"allow"}
    assert url_bloom.filter_urls(empty(pages), listed).count() == 0


def test_listed_urls_in_any_form(spark):
    entries = ["Spam.example.org/", "example.org/x", "example.org/id?n=1", "http://whole.example.org", "port.example.org:8080/", "example.org/caf\u00e9", "zone/"]
    blocked = [
        "http://user:pw@spam.example.org:80/a", "https://SPAM.example.org.:443", "http://a.spam.example.org:81/", "http://sp%61m.example.org/", "http://example.org/xy", "http://example.org/%78",
        "http://example.org/a/../x/y", "http://example.org/./x", "http://example.org/id?n=12#z", "http://whole.example.org/q", "http://port.example.org:8080/p", "http://example.org/caf%c3%a9", "http://a.zone/b",
    ]
    allowed = ["http://example.org/X", "http://example.org/id?n=2", "http://notspam.example.org/", "http://port.example.org/p", "https://port.example.org:80/", "http://example.org/a/x", "http://example.org", "http://spam.example.org@example.org/"]
    pages = spark.createDataFrame(list(enumerate(blocked + allowed)), "page_id long, url string")
    rows = {r["page_id"]: r for r in url_bloom.filter_urls(pages, url_bloom.listed_table(spark, entries), rules=()).collect()}
    assert {u: rows[i]["verdict"] for i, u in enumerate(blocked + allowed)} == dict.fromkeys(blocked, "block") | dict.fromkeys(allowed, "allow")
    assert (rows[0]["host"], rows[0]["path"], rows[6]["path"]) == ("user:pw@spam.example.org:80", "/a", "/a/../x/y")


def test_the_filter_decides_pages_and_the_join_takes_out_false_positives(spark, smallest):
    pages = spark.read.parquet(smallest.replace("sf0.001", "sf0.01") + "/pages.parquet")
    assert len(url_bloom.LISTED) > 8_000
    listed, filtered, words = url_bloom.prepared(url_bloom.listed_table(spark))
    assert words == url_bloom.words_for(len(url_bloom.LISTED)) == 4096
    rows = {r["page_id"]: r for r in url_bloom.filter_urls(pages, url_bloom.listed_table(spark)).collect()}
    decided = {i for i, r in rows.items() if r["rule"] is None and r["verdict"] == "block"}
    keys = {k.rstrip("/") for k in url_bloom.LISTED}
    assert len(decided) >= 5 and decided == {i for i, r in rows.items() if r["rule"] is None and ".".join(r["host"].split(".")[-3:]) in keys}
    few = 256  # a filter that is too small passes strangers
    _, small, _ = url_bloom.prepared(url_bloom.listed_table(spark), few)
    passed = {r["page_id"] for r in url_bloom.probe(pages, small, few).where(F.size("hits") > 0).collect()}
    assert passed > decided
    assert {r["page_id"]: r["verdict"] for r in url_bloom.filter_urls(pages, url_bloom.listed_table(spark), words=few).collect()} == {i: r["verdict"] for i, r in rows.items()}
    assert url_bloom.words_for(0) == url_bloom.LEAST_WORDS and url_bloom.words_for(10**12) == url_bloom.MOST_WORDS and url_bloom.words_for(10**6) == 1 << 18


def test_very_long_urls(spark):
    urls = ["http://h.example.org" + "/a" * 20_000, "http://" + "a." * 10_000 + "casino-win.example.org/" + "b/" * 9_000, "http://h.example.org/" + "./" * 4_000 + "x", "http://h.example.org/" + "a/../" * 3_000 + "x?" + "%61" * 5_000]
    began = time.perf_counter()
    rows = url_bloom.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), url_bloom.listed_table(spark)).collect()
    assert {r["page_id"]: r["verdict"] for r in rows} == {0: "allow", 1: "block", 2: "allow", 3: "allow"} and time.perf_counter() - began < 60


def test_tokens(docs):
    rows = {r["doc_id"]: r for r in token_prefix.count_tokens(docs).collect()}
    assert rows[2]["n_tokens"] == rows[3]["n_tokens"] == 0 and rows[3]["n_bytes"] == 0 and rows[4]["over_limit"] and rows[6]["n_bytes"] == 14
    assert token_prefix.count_tokens(docs).count() == len(ROWS) and token_prefix.count_tokens(empty(docs)).count() == 0


def test_language(docs):
    model = lang_svm.train(docs)
    rows = lang_svm.identify(docs, model).collect()
    assert len(rows) == len(ROWS)
    assert {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 5)} == {2: "und", 3: "und", 5: "und"}
    assert {r["lang_pred"] for r in lang_svm.identify(docs, lang_svm.train(empty(docs))).collect()} == {"und"}
    assert lang_svm.identify(empty(docs), model).count() == 0


def test_no_language_is_dropped(spark):
    long = "x-" + "long" * 20
    rows = [(i, "aaa bbb" if i % 2 else "yyy zzz", "en" if i % 2 else long) for i in range(40)]
    model = lang_svm.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert lang_svm.decide(["yyy zzz", "aaa bbb"], model)[0] == [long, "en"]
    many = spark.createDataFrame([(10 * i + k, "word", f"l{i}") for i in range(201) for k in range(10)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        lang_svm.train(many)


def test_repeated_ids_are_one_row_of_the_language_sample(spark):
    rows = [(1, "aaa bbb", "en")] * 30_000 + [(i, f"aaa {'bbb ' * i}", "en") for i in range(2, 40)] + [(i, f"zzz {'yyy ' * (i % 30)}", "de") for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    assert len(lang_svm.training_rows(docs)) == len({(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 5})
    few = lang_svm.training_rows(docs, lang_svm.LangParams(per_language=10, sample_rows=14))
    assert [r[0] for r in few] == ["de"] * 7 + ["en"] * 7


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(1, "One two, three four!"), (2, None), (3, ""), (4, "Wort"), (None, "one two three four")], "item_id long, text string")
    rows = decontam.contaminated(docs, bench).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, sorted(r["item_ids"], key=str)) for r in rows) == [(False, 1, [1, None]), (False, 1, [1, None]), (False, 6, [4]), (True, 0, [1, None])]
    assert sorted(r["doc_id"] for r in decontam.keep_clean(docs, bench).collect()) == [2, 3, 4, 5]
    assert decontam.contaminated(docs, empty(bench)).count() == 0 and decontam.contaminated(empty(docs), bench).count() == 0
    assert decontam.keep_clean(docs, empty(bench)).count() == len(ROWS)


def test_mix(docs):
    rows = pfair_mix.mix(docs, block=2, columns=tuple(docs.columns)).collect()
    assert len(rows) == len(ROWS) == len({r["position"] for r in rows})
    assert len(rows[0]) == len(docs.columns) + 2  # its own block replaces that of the input
    assert {r["source"] for r in rows} == {"a", "b", None}
    assert pfair_mix.mix(empty(docs)).count() == 0
    with pytest.raises(ValueError):
        pfair_mix.mix(docs, {"a": 0.0})


def test_warc(pages):
    rows = warc.archive_round_trip(pages, segment=4096, chunk=1000, file_bytes=4000, pack_bytes=2000).collect()
    assert len(rows) == len(PAGE_ROWS)
    got = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in rows if r["page_id"] is not None}
    assert got[1] == ("response", None, 9) and got[2] == ("revisit", 3, 0) and got[3] == ("response", None, 0) and got[5] == ("response", None, 150_003)
    assert sum(r["page_id"] is None for r in rows) == 1
    assert warc.archive_round_trip(empty(pages)).count() == 0


def test_an_id_with_two_payloads(spark):
    a, b = "A" * 70_000, "B" * 70_000
    rows = [(5, a), (3, a), (5, b), (4, b), (9, "c"), (9, "c"), (8, "c"), (None, a)]
    pages = spark.createDataFrame([(i, "http://h/x", h) for i, h in rows], "page_id long, url string, html string")
    got = sorted((r["page_id"] is None, r["page_id"] or 0, r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.archive_round_trip(pages).collect())
    d = {h: warc.digest_of(h.encode()) for _, h in rows}
    want = [(False, 5, d[a], "response", None), (False, 3, d[a], "revisit", 5), (False, 5, d[b], "response", None), (False, 4, d[b], "revisit", 5)]
    want += [(False, 9, d["c"], "response", None)] * 2 + [(False, 8, d["c"], "revisit", 9), (True, 0, d[a], "response", None)]
    assert got == sorted(want, key=lambda r: r[:4])


def test_archives_are_members_in_files_of_bounded_bytes(spark, tmp_path):
    pages = spark.createDataFrame([(i, "http://h/x", "".join(f"{i * 31 + k * k} " for k in range(3000))) for i in range(60)], "page_id long, url string, html string").repartition(2)
    warc.write_archives(pages, f"file://{tmp_path}/w", segment=4096, chunk=1000, file_bytes=60_000, pack_bytes=20_000)
    files = [p.read_bytes() for p in (tmp_path / "w").glob("part-*")]
    assert len(files) > 2 and all(len(f) < 60_000 + 3 * 4096 for f in files)
    n = 0
    for data in files:
        while data:
            z = zlib.decompressobj(31)
            record, data = z.decompress(data) + z.flush(), z.unused_data
            if record:
                assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") and len(list(warc.parse(record))) == 1
                n += 1
    assert n == sum(len(list(warc.parse(p.read_bytes()))) for p in (tmp_path / "w").glob("part-*")) > 60


def test_html(pages):
    rows = site_style.extract(pages).collect()
    assert len(rows) == len(PAGE_ROWS)
    got = {r["page_id"]: r["text"] for r in rows if r["page_id"] is not None}
    assert got[1] == "Hi" and got[2] == got[3] == "" and len(got[5]) == 149_999
    assert site_style.extract(empty(pages)).count() == 0
