import hashlib

import pytest

from accountweave.llm import warc

PAGES = "page_id long, url string, html string, payload string, digest string"


@pytest.fixture
def pages(spark, tmp_path):
    def run(rows):
        frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)
        path = str(tmp_path / "archives")
        warc.write_archives(frame, path)
        return path, warc.read_archives(spark, path).collect()

    return run


def test_round_trip_and_revisits(pages):
    big, odd = "b" * 150, "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "x" * 100
    rows = [(5, "http://a", big), (2, "http://b", big), (9, "http://c", big), (1, "http://d", odd), (4, None, odd), (3, "u v\n", "small"), (8, "u", "small")]
    rows += [(7, "n", None), (6, "e", "")]
    _, got = pages(rows)
    found = {r.page_id: r for r in got}
    assert len(got) == len(rows)
    for page, _, html in rows:
        data = (html or "").encode()
        r = found[page]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert r.record_type == "response" and bytes(r.payload) == data or r.refers_to is not None and r.payload is None
    assert {p: r.refers_to for p, r in found.items() if r.refers_to is not None} == {5: 2, 9: 2, 4: 1}
    assert found[3].url == "u%20v%20"


def test_null_and_repeated_ids(pages):
    big = "c" * 100
    _, got = pages([(None, "a", big), (1, "b", big), (1, "b", big), (2, "c", big)])
    assert sorted((r.page_id or 0, r.record_type) for r in got) == [(0, "response"), (1, "response"), (1, "response"), (2, "revisit")]


def test_very_long_payload(pages):
    text = "0123456789" * 400_000
    _, got = pages([(1, "a", text), (2, "b", text)])
    assert sorted(r.record_type for r in got) == ["response", "revisit"]


def test_empty_table(pages):
    assert pages([])[1] == []


def test_damage_is_seen(spark, tmp_path):
    path = tmp_path / "bad"
    path.mkdir()
    import gzip

    (path / "part-0.txt.gz").write_bytes(gzip.compress(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nshort"))
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_archives(spark, str(path)).collect()
