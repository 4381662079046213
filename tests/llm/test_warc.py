import hashlib
import random

import pytest

from docquill.llm import warc
from docquill.session import work_path


def brute(rows, least):
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == raw and j is not None]
        top = max(same, default=None) if len(raw) >= least else None
        again = top is not None and i != top
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def pages(seed, n):
    rnd = random.Random(seed)
    bodies = ["x" * 50, "é" * 30, "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nb" * 3, "", None, "short", "\r\n\r\n" * 20]
    urls = ["http://www.Example.com/a?b=1#c", "https://u@x.example.com:8080/p q\n", "http://a.b", None, "", "nonsense", "http://é.fr/ü"]
    rows = [(i, rnd.choice(urls + [f"http://h{i % 7}.org/{i}"] * 8), rnd.choice([*bodies, f"own {i} " * 9])) for i in range(n)]
    return rows + [(None, "http://a.b", "x" * 50), (None, None, "é" * 30), rows[0], (2, "http://a.b", "y" * 60), (2, "http://a.b", "y" * 60)]


@pytest.mark.parametrize(("seed", "block", "part", "asked", "size"), [(1, 3000, 1_000_000, 500_000, 16 << 20), (2, 3, 20, 4, 2000)])
def test_round_trip_through_the_index(spark, monkeypatch, seed, block, part, asked, size):
    for name, value in (("BLOCK", block), ("PART", part), ("ASKED", asked), ("FILE_BYTES", size)):
        monkeypatch.setattr(warc, name, value)
    rows = pages(seed, 150)
    df = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, digest int").repartition(3)
    folder = warc.write_archive(df, work_path(spark, "archive"), least=40)
    lines = warc.scan_archive(spark, folder)
    assert lines.count() == len(rows)
    index = warc.build_index(lines)
    assert index.count() > 1 or block == 3000
    found = warc.read_records(warc.look_up(index, warc.keys_of(df)), payload=True).withColumns({"page": warc.page_of("id"), "top": warc.page_of("refers_to")}).collect()
    assert sorted(((r.page, r.payload_bytes, r.payload_digest, r.type, r.top) for r in found), key=str) == brute(rows, 40)
    assert all(hashlib.sha1(r.payload).hexdigest() == r.payload_digest for r in found if r.type == "response")
    one = warc.look_up(index, spark.createDataFrame([("com,example,www)/a?b=1",), ("com,nowhere)/",), (None,)], "key string")).collect()
    assert len(one) == sum(u == "http://www.Example.com/a?b=1#c" for _, u, _ in rows)
    assert all(r.key == "com,example,www)/a?b=1" for r in one)


def test_url_keys():
    assert warc.url_key("https://u:p@WWW.Example.co.uk:443/A/b?q#f") == "uk,co,example,www)/A/b?q"
    assert [warc.url_key(u) for u in ("http://a.b:81?x", "a.b", "", None)] == ["b,a:81)/?x", "b,a)/", "-", "-"]


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    index = warc.build_index(warc.scan_archive(spark, warc.write_archive(none, work_path(spark, "archive"))))
    assert warc.read_records(warc.look_up(index, warc.keys_of(none))).count() == 0
