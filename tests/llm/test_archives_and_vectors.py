"""WARC round trips and links between vectors against brute force."""

import base64
import gzip
import hashlib
import random

import numpy as np
import pytest

from gaugeframe.llm import vectors, warc
from gaugeframe.llm.components import components
from gaugeframe.sources.scratch import scratch_path

PAGES = "page_id long, url string, html string, payload string, record_type string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


def test_pages_come_back_as_they_were(spark):
    big = "".join(random.Random(1).choice("abc é") for _ in range(300_000))
    rows = [(1, "http://a/", "same"), (2, "http://b/", "same"), (5, None, "same"), (3, "u\r\nX: 1", None),
            (4, "http://é/", ""), (6, "http://c/", big), (7, "http://d/", "é\r\n\r\nWARC/1.1")]
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.as_records(pages_of(spark, rows)), path, archive_bytes=50_000)
    got = {int(r["record_id"]): r for r in warc.read_warc(spark, path).collect()}
    assert len(got) == len(rows) and all(r["verified"] for r in got.values())
    for page, url, html in rows:
        data, r = (html or "").encode(), got[page]
        first = max(p for p, _, h in rows if (h or "") == (html or ""))
        assert r["payload_bytes"] == len(data)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r["record_type"] == ("response" if page == first else "revisit")
        assert r["refers_to"] == (None if page == first else str(first))
        assert r["payload"] == (data if page == first else None)
    assert got[3]["target_uri"] == "u%0D%0AX:%201" and got[5]["target_uri"] is None
    files = spark.read.format("binaryFile").load(path).where("length > 0").collect()
    assert len(files) > 1 and sum(
        gzip.decompress(f["content"]).count(b"WARC-Record-ID") for f in files) == len(rows)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    path = scratch_path(spark, "warc")
    rows = [(None, "u", "p"), (None, "u", "p"), (2, "u", "q"), (2, "u", "q"), (None, "u", "q")]
    warc.write_warc(warc.as_records(pages_of(spark, rows)), path)
    got = sorted((r["record_id"], str(r["refers_to"])) for r in warc.read_warc(spark, path).collect())
    assert got == [("", "2"), ("", "None"), ("", "None"), ("2", "None"), ("2", "None")]
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.as_records(pages_of(spark, rows).limit(0)), path)
    assert warc.read_warc(spark, path).count() == 0


def test_damage_is_found():
    record = warc.make_record(1, "u", b"payload")
    assert warc.parse_record(record)[-1]
    assert not warc.parse_record(record.replace(b"payload\r\n", b"pAyload\r\n"))[-1]
    for broken in (record[:-1], record.replace(b"WARC/1.1", b"WORC/1.1"), record + b"x"):
        with pytest.raises(warc.WarcError):
            warc.parse_record(broken)
    with pytest.raises(warc.WarcError):
        list(warc._records(warc.gzip_member(record)[:-9]))
    two = warc.gzip_member(record) + b"\0\0" + warc.gzip_member(record)
    assert list(warc._records(two)) == [record, record]


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 60)] + [(60, 8), (3, 3)]
    got = {r["id"]: r["component"] for r in components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    want = {k: 100 for k in range(100, 141)} | {k: 7 for k in range(7, 61)}
    assert got == want


@pytest.mark.parametrize("list_size, block", [(4096, 1024), (40, 16)])
def test_links_equal_brute_force(spark, monkeypatch, list_size, block):
    monkeypatch.setattr(vectors, "LIST_SIZE", list_size)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(9)
    x = list(rng.normal(size=(300, 24)))
    for k in range(0, 60):
        x.append(x[k % 12] + rng.normal(size=24) * 0.12)
    x += [x[0] * 3, x[1], x[1], x[2] * 1e-200, x[3] * 1e200, -x[4]]
    rows = [(k, v.tolist(), k % 2) for k, v in enumerate(x)]
    odd = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] * 24]
    rows += [(1_000 + k, v, 1) for k, v in enumerate(odd)]
    rows += [(2_000, x[0].tolist(), None), (2_001, x[0].tolist()[:12], 0), (2_002, x[0].tolist()[:12], 0)]
    got = {r["vec_id"]: r for r in vectors.link_vectors(spark.createDataFrame(
        [(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, kept string")).collect()}
    ids = [r[0] for r in rows]
    unit = {i: np.array(v) / np.abs(v).max() for i, v, g in rows
            if v and None not in v and np.isfinite(v).all() and np.any(v) and g is not None}
    label = {i: g for i, _, g in rows}
    links = {i: set() for i in ids}
    for a in unit:
        for b in unit:
            if a != b and label[a] == label[b] and len(unit[a]) == len(unit[b]):
                if unit[a] @ unit[b] / np.linalg.norm(unit[a]) / np.linalg.norm(unit[b]) >= 0.98:
                    links[a].add(b)
    assert {i: got[i]["n_links"] for i in ids} == {i: len(s) for i, s in links.items()}
    for i in ids:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        assert got[i]["component_id"] == min(seen) and got[i]["kept"] == (i == min(seen))


def test_no_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vectors.link_vectors(spark.createDataFrame([], schema)).count() == 0
    one = vectors.link_vectors(spark.createDataFrame([(1, None, 2), (None, [1.0], 2)], schema))
    assert sorted(map(str, one.collect())) == sorted([
        "Row(vec_id=1, n_links=0, component_id=1, kept=True)",
        "Row(vec_id=None, n_links=0, component_id=None, kept=True)"])
