"""Quoted records: any text round-trips, whatever the splits are."""

import csv
import io
import os
import random

import pytest

from tidemark.sources import quoted
from tidemark.sources.quoted import fields, read_quoted, state_after, write_quoted_snapshot

TEXTS = ["plain", "", None, "tab\there", 'say "hi"', '"', '""', "two\nlines", "\n", "a\r\nb", "ends\r", "\r", '\t"\n"\t', " padded ", "Été ✓", 'x"y', '",\n"', "\x00\x01", "'"]


def test_every_text_comes_back(spark, scratch):
    rows = [(k, TEXTS[k % len(TEXTS)], TEXTS[(k * 7 + 3) % len(TEXTS)]) for k in range(400)]
    df = spark.createDataFrame(rows, 'id int, text string, `odd "name"\t` string')
    path = write_quoted_snapshot(df.repartition(3), scratch, "s", "d", "20260101T000000Z")
    got = read_quoted(spark, path)
    assert got.columns == ["id", "text", 'odd "name"\t', "_rescued_data"]
    assert sorted((int(r[0]), r[1], r[2], r[3]) for r in got.collect()) == [(*r, None) for r in rows]
    with pytest.raises(Exception, match="exist"):
        write_quoted_snapshot(df, scratch, "s", "d", "20260101T000000Z")


@pytest.mark.parametrize("sorted_way", [False, True])
def test_records_over_many_splits(spark, scratch, monkeypatch, sorted_way):
    if sorted_way:
        monkeypatch.setattr(quoted, "BROADCAST_SPLITS", -1)
    rng = random.Random(9)
    rows = [(str(k), rng.choice(TEXTS) if k % 40 else "long\n" * rng.randrange(200, 900) + '"') for k in range(300)]
    out = io.StringIO()
    csv.writer(out, delimiter="\t", quoting=csv.QUOTE_NOTNULL, lineterminator="\n").writerows([("id", "text"), *rows])
    os.makedirs(f"{scratch}/f")
    with open(f"{scratch}/f/one.tsv", "w", newline="") as f:
        f.write(out.getvalue())
    with open(f"{scratch}/f/two.tsv", "w", newline="") as f:
        f.write('text\tid\tmore\r\nplain 5" pipe\t900\t\r\n\r\n"q\r\nr"\t901\tx\textra\r\n"never closed\t902')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        got = read_quoted(spark, f"{scratch}/f")
        assert quoted._lines(spark, got.inputFiles()).select("block").distinct().count() > 20
        found = {r["id"]: (r["text"], r["more"], r["_rescued_data"]) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found.pop("900") == ('plain 5" pipe', None, None)
    assert found.pop("901") == ("q\r\nr", "x", '[{"place":3,"value":"extra"}]')
    assert found.pop(None) == ("never closed\t902", None, None)
    assert found == {k: (t, None, None) for k, t in rows}


def test_transitions_agree_with_a_character_machine():
    def machine(line, inside):
        state = "Q" if inside else "F"
        for c in line:
            if state == "Q":
                state = "E" if c == '"' else "Q"
            elif state == "E" and c == '"':
                state = "Q"
            elif c == "\t":
                state = "F"
            elif state == "F" and c == '"':
                state = "Q"
            else:
                state = "U"
        return state == "Q"

    rng = random.Random(2)
    for _ in range(4000):
        line = "".join(rng.choice('ab"\t"') for _ in range(rng.randrange(12)))
        for inside in (False, True):
            assert state_after(line, inside, "\t") == machine(line, inside), (line, inside)


def test_fields_and_empty_files(spark, scratch):
    assert fields('"a\tb"\t\t""\tc"d', "\t") == ["a\tb", None, "", 'c"d']
    assert fields("", "\t") == [None] and fields('"x"\r', "\t") == ["x"]
    os.makedirs(f"{scratch}/e")
    open(f"{scratch}/e/none.tsv", "w").close()
    assert read_quoted(spark, f"{scratch}/e").collect() == []
    one = spark.createDataFrame([("a",), (None,), ("",)], "only string")
    path = write_quoted_snapshot(one, scratch, "s", "one", "20260101T000000Z")
    assert sorted((r["only"] for r in read_quoted(spark, path).collect()), key=str) == ["", None, "a"]
