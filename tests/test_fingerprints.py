"""Ordered fingerprints against a tree hashed by hand."""

import hashlib
import os

from tidemark.operators import fingerprints
from tidemark.operators.fingerprints import file_digests, ordered_fingerprint
from tidemark.sinks.manifest import record_run, snapshot_fingerprint
from tidemark.sinks.tables import AppendOnlyTable


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_hand(lines, fan):
    level = [sha(t or "") for t in lines]
    if not level:
        return sha("")
    levels = 0
    while len(level) > 1 or levels < 2:
        level = [sha("".join(level[i : i + fan])) for i in range(0, len(level), fan)]
        levels += 1
    return level[0]


def test_order_counts_and_partitions_do_not(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "FAN", 4)
    lines = [f"line {k}" for k in range(70)] + [None, "", "é\n"]
    df = spark.createDataFrame([(t,) for t in lines], "line string")
    want = (by_hand(lines, 4), 73, sum(len((t or "").encode()) + 1 for t in lines))
    assert {tuple(ordered_fingerprint(df.coalesce(n)).first()) for n in (1, 2, 3)} == {want}
    swapped = [lines[1], lines[0], *lines[2:]]
    got = ordered_fingerprint(spark.createDataFrame([(t,) for t in swapped], "line string")).first()
    assert got.content_sha256 == by_hand(swapped, 4) != want[0]
    assert ordered_fingerprint(df, head="h").first().content_sha256 == sha("h\n" + want[0])


def test_no_lines_and_one_line(spark):
    empty = ordered_fingerprint(spark.createDataFrame([], "line string")).first()
    assert tuple(empty) == (sha(""), 0, 0)
    assert tuple(ordered_fingerprint(spark.createDataFrame([("x",)], "line string")).first()) == (by_hand(["x"], 4096), 1, 2)


def test_snapshots_with_reordered_lines_or_other_header_differ(spark, scratch):
    rows = [(k, f"v{k}") for k in range(20)]
    frames = [spark.createDataFrame(r, s) for r, s in ((rows, "a int, b string"), (rows, "a int, b string"), (rows[::-1], "a int, b string"), (rows, "a int, c string"))]
    prints = [snapshot_fingerprint(f, ordered=True).first() for f in frames]
    assert prints[0] == prints[1] and len({p.content_sha256 for p in prints}) == 3
    assert len({p.bytes for p in prints}) == 1 == len({snapshot_fingerprint(f).first() for f in frames[:3]})
    ledger = AppendOnlyTable(spark, f"{scratch}/ledger")
    for seq, frame in enumerate(frames[:3], 1):
        record_run(spark, [("d", frame)], f"{scratch}/landing", "s", f"2026010{seq}T000000Z", ledger, seq, ordered=True)
    assert [r.status for r in ledger.read().orderBy("ingest_ts").collect()] == ["FETCHED", "UNCHANGED", "FETCHED"]


def test_plain_digest_of_every_file(spark, scratch):
    os.makedirs(f"{scratch}/sub")
    contents = {"one": b"a\tb\r\n\x00\xff", "sub/two": b"\n", "sub/empty": b""}
    for name, content in contents.items():
        with open(f"{scratch}/{name}", "wb") as f:
            f.write(content)
    got = {r.path.split(scratch + "/")[1]: (r.content_sha256, r.bytes) for r in file_digests(spark, scratch).collect()}
    assert got == {k: (hashlib.sha256(v).hexdigest(), len(v)) for k, v in contents.items() if v}
