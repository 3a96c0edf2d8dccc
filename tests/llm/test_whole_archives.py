"""Archives: payloads of repeated and missing ids are archived."""

import base64
import hashlib

import pytest

from tidemark.llm import warc


def sha(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


@pytest.mark.parametrize("broadcast_rows", [warc.BROADCAST_ROWS, 0])
def test_each_payload_of_an_id_is_a_response_or_revisit_on_its_own(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", broadcast_rows)
    rows = [(5, "one"), (5, "two"), (9, "one"), (None, "one"), (None, "two"), (None, "three"), (None, "four"), (None, "four"), (None, "five")]
    pages = spark.createDataFrame([(i, "http://a.org/", t) for i, t in rows], "page_id long, url string, html string")
    got = sorted(((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in warc.archived(pages).collect()), key=str)
    first = {"one": 9, "two": 5}
    assert got == sorted(((i, sha(t), *(("response", None) if first.get(t, i) == i else ("revisit", first[t]))) for i, t in rows), key=str)
