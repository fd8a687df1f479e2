"""Archives (4) and language identification (3)."""

import base64
import gzip
import hashlib
import io
import random
from collections import Counter

import numpy as np
import pytest

from godown.llm import arc_warc, lang_fusion


def read_all(data: bytes):
    return list(arc_warc.read_arc(io.BufferedReader(io.BytesIO(data))))


def test_arc_headers_of_both_versions():
    one = arc_warc.arc_version_block("x.arc", 1) + b"\n" + arc_warc.arc_record(1, "http://a/ b c", "20010203040506", b"HTTP/1.0 200 OK\r\n\r\nhi\n\n", 9, "x.arc")
    two = arc_warc.arc_version_block("y.arc", 2) + b"\n" + arc_warc.arc_record(2, "http://d", "1999", b"plain", 9, "y.arc")
    got = read_all(one + b"\n" + two + b"\n" + two.replace(b" 5\n", b" 50\n"))
    assert [f["URL"] for _, f, _, _ in got] == ["http://a/ b c", "http://d", "http://d"]
    assert [c for _, _, c, _ in got][:2] == [b"HTTP/1.0 200 OK\r\n\r\nhi\n\n", b"plain"]
    assert [w for *_, w in got] == [True, True, False]
    bare = b"no header\n" + arc_warc.arc_record(2, "http://e", "20010101000000", b"a 1 2 3 4\n", 0, "z") + b"\njunk\n"
    assert [c for _, f, c, _ in read_all(bare) if f] == [b"a 1 2 3 4\n"]  # by shape, without a version block
    assert [(o, c) for o, f, c, _ in read_all(bare) if not f] == [(0, b"no header\n"), (len(bare) - 5, b"junk\n")]
    assert arc_warc.iso_date("1999") == "1999-01-01T00:00:00Z" and arc_warc.iso_date("20019901000000") == "1970-01-01T00:00:00Z"


def test_arc_headers_with_spaces():
    one = arc_warc.arc_version_block("x.arc", 1) + b"\n"
    one += b"http://a/ 7 b 10.0.0.1 20010203040506 text/html; charset=utf-8 5\nhello\nhttp://b ::1 1999 text/plain 2\nhi\n- - 2001 no type 1\nx"
    got = read_all(one)
    assert [(f["URL"], f["IP-address"], f["Archive-date"], f["Content-type"], c) for _, f, c, _ in got] == [
        ("http://a/ 7 b", "10.0.0.1", "20010203040506", "text/html; charset=utf-8", b"hello"), ("http://b", "::1", "1999", "text/plain", b"hi"),
        ("-", "-", "2001", "no type", b"x")]
    two = arc_warc.arc_version_block("y.arc", 2) + b"\nhttp://c 10.0.0.1 20010203040506 text/html; charset=utf-8 302 abc http://to/ here 77 y.arc 3\nabc\n"
    (_, f, content, _), = [r for r in read_all(two) if r[1]]
    assert (f["Content-type"], f["Result-code"], f["Checksum"], f["Location"], f["Offset"], content) == (
        "text/html; charset=utf-8", "302", "abc", "http://to/ here", "77", b"abc")
    for text in ("", " ", "a b", "http://a 1.1.1.1 2001 5", "http://a 1.1.1.1 2001 x y", " 1.1.1.1 2001 t 5"):
        assert arc_warc.header_fields(text, 1) is None
    assert arc_warc.header_fields("http://a 1.1.1.1 2001 t 200 - - off f 5", 2) is None


def test_unparsed_lines_are_returned(spark, tmp_path):
    (tmp_path / "arc").mkdir()
    good = b"http://a/ 10.0.0.1 20010203040506 text/html; charset=utf-8 5\nhello\n"
    data = arc_warc.arc_version_block("x.arc", 1) + b"\n" + good + b"a damaged header\nits payload\n" + good.replace(b"a/", b"b/")
    (tmp_path / "arc" / "part-0.arc").write_bytes(data)
    lost = arc_warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    assert [(r.file, r.offset, bytes(r.unparsed)) for r in lost.orderBy("offset").collect()] == [
        ("part-0.arc", data.index(b"a damaged"), b"a damaged header\n"), ("part-0.arc", data.index(b"its"), b"its payload\n")]
    got = arc_warc.warc_records(spark, str(tmp_path / "warc")).collect()
    assert sorted((r.url, r.payload_bytes, r.record_type) for r in got)[0][:2] == ("http://a/", 5) and len(got) == 2


def pages():
    rnd = random.Random(8)
    html = [f"<html lang='en'>{rnd.random()}</html>" for _ in range(20)] + ["", "é\r\n\r\nWARC/1.1\r\nx: y\r\n\r\n", "\n", "x" * 3_000_000]
    rows = [(k, f"http://h{k % 3}.example.com/{k}", rnd.choice(html)) for k in range(90)]
    rows += [(500, None, None), (501, "", ""), (502, "http://a b/\n ", html[-1]), (None, "http://n/", html[0]), (None, None, None), rows[4], rows[4]]
    return rows


def test_round_trip(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    rows = pages()
    monkeypatch.setattr(arc_warc, "BLOCK_RECORDS", 5)  # before the tasks are sent
    monkeypatch.setattr(arc_warc, "FILE_RECORDS", 20)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("own") for c in ("record", "path", "head")})
    arc_warc.write_arc(df.repartition(3), str(tmp_path / "arc"), compression="none")
    arc_warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    got = arc_warc.warc_records(spark, str(tmp_path / "warc")).collect()
    assert len(got) == len(rows) and all(r.digests_match for r in got)
    best = {}
    for p, _, h in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if p is None else p)
    want = Counter()
    for p, _, h in rows:
        b = (h or "").encode()
        want[p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode()] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == want
    text = {base64.b32encode(hashlib.sha1(t.encode()).digest()).decode(): n for t, n in best.items()}
    responses = [r for r in got if r.record_type == "response"]
    assert sorted(r.payload_digest for r in responses) == sorted(text)  # one each
    assert all((r.page_id if r.page_id is not None else -1) == text[r.payload_digest] and r.refers_to is None for r in responses)
    assert all(r.refers_to == text[r.payload_digest] for r in got if r.record_type == "revisit")
    # The archives are gzipped WARC files as others read them.
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "warc").glob("part-*.gz")))
    assert data.count(b"WARC-Record-ID: <urn:uuid:") == len(rows)
    assert len({r.record_id for r in got}) == len(rows)
    blocks = b"".join(p.read_bytes() for p in sorted((tmp_path / "arc").glob("part-*")))
    assert blocks.count(b" text/plain ") == blocks.count(b"filedesc://") > 3 and b"\n1 0 godown" in blocks and b"\n2 0 godown" in blocks


def test_no_pages(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    arc_warc.write_arc(df, str(tmp_path / "arc"))
    arc_warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    assert arc_warc.warc_records(spark, str(tmp_path / "warc")).collect() == []


@pytest.fixture(scope="module")
def model(spark):
    return lang_fusion.fit_text(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), sample_rows=400)


def test_text_model_on_held_out_rows(spark, model):
    """The sample has 400 rows; accuracy on the 600 others, by text alone."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()
    hit = [lang_fusion.LANGUAGES[k] == r.lang for r in rows
           if (k := int(lang_fusion.text_evidence(r.text, model).argmax())) < len(lang_fusion.LANGUAGES)]
    assert len(hit) >= 0.99 * len(rows) and sum(hit) >= 0.98 * len(hit)


def test_host_and_declaration(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("https://u@WWW.Example.org:80/x", "<HTML class='a' LANG=\"de-AT\">"), ("nothing", "<meta http-equiv='Content-Language' content='fr'>"),
                                (None, None)], "url string, html string")
    got = df.select(lang_fusion.host_of(F.col("url")).alias("h"), lang_fusion.declared_language(F.coalesce("html", F.lit(""))).alias("d")).collect()
    assert [tuple(r) for r in got] == [("www.example.org", "de"), ("", "fr"), ("", "")]


def test_fusion_against_numpy(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()
    rows = [(r.page_id, r.url, r.html) for r in pages]
    rows += [(9000, "http://x.de/", None), (9001, None, "<html lang=fr><p>!!</p>"), (9002, "http://q.es/", "<p>zqxj kwvqz xqjz wqkx vzqj qqxz"), rows[0], (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lang", __import__("pyspark").sql.functions.lit("own"))
    labelled = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = lang_fusion.identify_pages(df.repartition(2), labelled, sample_rows=400).collect()
    assert len(got) == len(rows)
    ev = np.array([lang_fusion.text_evidence(lang_fusion.page_text(h) if h else h, model) for *_, h in rows])
    q = np.exp(ev - ev.max(axis=1, keepdims=True))
    q /= q.sum(axis=1, keepdims=True)
    q[~ev.any(axis=1)] = 0
    q = np.rint(q * lang_fusion.UNIT)
    keys = df.select("page_id", lang_fusion.host_of(df.url).alias("host"), lang_fusion.declared_language(__import__("pyspark").sql.functions.coalesce(df.html, __import__("pyspark").sql.functions.lit(""))).alias("d")).collect()
    host, declared = [k.host for k in keys], [k.d for k in keys]
    suffix = [h.rpartition(".")[2] if "." in h else "" for h in host]
    domain = [".".join(h.split(".")[-2:]) if "." in h else "" for h in host]
    unit, a, s, n = lang_fusion.UNIT, lang_fusion.ALPHA, lang_fusion.STRENGTH, q.shape[1]
    same = lambda keys, k: np.array([x == keys[k] for x in keys])
    classes = [*lang_fusion.LANGUAGES, "und"]
    want = []
    for k in range(len(rows)):
        p_all = (q.sum(axis=0) + a * unit) / (q.sum() + a * unit * n)
        dom, own = q[same(domain, k)].sum(axis=0) - q[k], q[same(list(zip(domain, host, strict=True)), k)].sum(axis=0) - q[k]
        p = (own + s * unit * (dom + s * unit * p_all) / (dom.sum() + s * unit)) / (own.sum() + s * unit)
        post = np.log(p) + ev[k]
        for key in (declared, suffix):
            post += np.log((q[same(key, k)].sum(axis=0) + a * unit) / (q.sum(axis=0) + a * unit * len(set(key))))
        e = np.exp(post - post.max())
        lang, conf = classes[int(post.argmax())], 1 / e.sum()
        want.append((rows[k][0], lang, bool(ev[k].any()), bool(not ev[k].any() or lang == "und" or conf < lang_fusion.LEAST_CONFIDENCE), conf))
    got = sorted(((r.page_id, r.lang, r.has_text, r.rejected, r.confidence) for r in got), key=str)
    for g, w in zip(got, sorted(want, key=str), strict=True):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-6)
    assert {g[0]: g[3] for g in got}[9002]


def test_kept_documents(docs, no_docs):
    kept = lang_fusion.keep_identified(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert not {400, 401, 402, 410} & ids.keys() and ids[0] == 2 and ids[None] == 1
    assert lang_fusion.keep_identified(no_docs).collect() == []
