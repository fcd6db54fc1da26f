"""WARC archives and url filters on small cases."""

from __future__ import annotations

import hashlib
import re

import pytest

PAGES = [
    (1, "http://a.com/x", "x" * 1500), (2, "http://b.com/", "x" * 1500), (7, None, "x" * 1500), (7, None, "x" * 1500), (None, "http://c.com/", "x" * 1500),
    (3, "http://a.com/\n", "small"), (4, "http://a.com/", "small"), (5, "u", None), (6, "", ""), (8, "http://é.com", "WARC/1.1\r\nContent-Length: 3\r\n\r\n" * 90),
    (9, "http://long.com/", "é\r\n\r\n" * 40_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({"sha256": F.lit(1), "record_type": F.lit("x"), "n": F.lit(2)})


def want():
    out = []
    for i, _, html in PAGES:
        b = (html or "").encode()
        same = [j for j, _, h in PAGES if (h or "") == (html or "") and j is not None]
        revisit = len(b) >= 1000 and i != max(same)
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [1000, 32 * 1024, 10**7])
def test_warc_round_trip(spark, pages, tmp_path, chunk):
    from tidemark.llm.warc import read_archives, write_archives

    write_archives(pages, f"{tmp_path}/t", chunk_bytes=chunk)
    assert sorted(map(tuple, read_archives(spark, f"{tmp_path}/t").collect()), key=repr) == want()


@pytest.mark.parametrize("chunk", [1000, 32 * 1024])
def test_warc_long_urls(spark, tmp_path, chunk):
    from tidemark.llm.warc import read_archives, write_archives

    rows = [(1, "data:text/html," + "a" * 70_000, "small"), (2, "http://a.com/?q=" + "é\n" * 200_000, "y" * 100_000), (3, "http://b.com/" + "b" * 70_000, "y" * 100_000)]
    write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/t", chunk_bytes=chunk)
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in read_archives(spark, f"{tmp_path}/t").collect())
    assert got == [(1, 5, "response", None), (2, 100_000, "revisit", 3), (3, 100_000, "response", None)]


def test_warc_files_are_whole(spark, pages, tmp_path):
    from tidemark.llm.warc import export_files, write_archives

    write_archives(pages, f"{tmp_path}/t", chunk_bytes=700)
    (tmp_path / "out").mkdir()
    export_files(spark, f"{tmp_path}/t", f"{tmp_path}/out")
    found = []
    for f in (tmp_path / "out").iterdir():
        data = f.read_bytes()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
            n = int(re.search(rb"Content-Length: (\d+)$", head)[1])
            found.append((re.search(rb"WARC-Type: (\w+)", head)[1].decode(), rest[:n]))
            assert rest[n : n + 4] == b"\r\n\r\n"
            data = rest[n + 4 :]
    assert sorted(b for t, b in found if t == "response") == sorted((h or "").encode() for (i, _, h) in PAGES if not (len((h or "").encode()) >= 1000 and h[0] == "x" and i != 7))
    assert len(found) == len(PAGES)


def test_warc_damage_is_found(spark, pages, tmp_path):
    from pyspark.sql import functions as F

    from tidemark.llm.warc import read_archives, write_archives

    write_archives(pages, f"{tmp_path}/t", chunk_bytes=700)
    damaged = spark.read.parquet(f"{tmp_path}/t").withColumn("data", F.when((F.col("page_id") == 9) & (F.col("chunk_no") == 5), F.lit(b"zz")).otherwise(F.col("data")))
    damaged.write.parquet(f"{tmp_path}/d")
    with pytest.raises(Exception, match="damaged"):
        read_archives(spark, f"{tmp_path}/d").collect()


def test_warc_empty(spark, pages, tmp_path):
    from tidemark.llm.warc import read_archives, write_archives

    write_archives(pages.where("page_id < 0"), f"{tmp_path}/t")
    assert read_archives(spark, f"{tmp_path}/t").count() == 0


URLS = [
    (1, "HTTP://WWW.Example.NET/en/x?q#f", "www.example.net", "/en/x", "example.net/en/", "allow"), (2, "http://example.net/EN/", "example.net", "/EN/", "net/", "block"),
    (3, "http://notexample.com/de/1", "notexample.com", "/de/1", None, None), (4, "http://a.b.example.com/de/", "a.b.example.com", "/de/", "example.com/de/", "block"),
    (5, None, "", "", None, None), (6, "no scheme/fr/", "", "", None, None), (7, "http://x.net", "x.net", "", None, None), (8, "http://org/fr/?a://b/c", "org", "/fr/", "org/fr/", "allow"),
    (9, "http://bad.com?x=/de/", "bad.com", "", None, None), (10, "http://É.com/p", "É.com", "/p", None, None), (11, "://h#/x", "h", "", None, None), (12, "", "", "", None, None),
]


def test_urls_and_rules(spark):
    from tidemark.llm.url_filters import judge

    pages = spark.createDataFrame([(i, u) for i, u, *_ in URLS], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: r for r in judge(pages, none).collect()}
    for i, _, host, path, rule, verdict in URLS:
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), i
        assert got[i].verdict == (verdict or "allow")
    assert judge(pages.where("page_id < 0"), none).count() == 0


def test_reputation_shrinks_small_hosts(spark):
    from tidemark.llm.url_filters import judge

    rows, bad, n = [], [], 0
    for host, pages, worst in [("a.good.com", 100, 0.02), ("b.good.com", 100, 0.05), ("c.vile.com", 200, 1.0), ("new.org", 1, 1.0), *((f"h{i}.mid.org", 30, 0.1) for i in range(20))]:
        for k in range(pages):
            rows.append((n, f"http://{host}/{k}"))
            bad.append((n, int(k < worst * pages)))
            n += 1
    rows += [(n, "http://unseen.vile.com/"), (n + 1, "http://me:secret@c.vile.com:8080/1")]
    got = judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame([*bad, (0, None)], "page_id long, bad int"), {})
    verdict = {r.host: r.verdict for r in got.select("host", "verdict").distinct().collect()}
    assert verdict["c.vile.com"] == verdict["me:secret@c.vile.com:8080"] == "block"
    assert verdict["new.org"] == "allow"  # one bad page isn't enough
    assert verdict["a.good.com"] == "allow"
