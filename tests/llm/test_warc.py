import gzip
import io
import random
import zlib

import pytest
from pyspark.sql import functions as F

from demandloom.llm import warc

from .conftest import prose

PAGE = "page_id long, url string, html string"


def read(data):
    return list(warc.read_archive(io.BytesIO(data), len(data)))


def members(n=12, size=3000):
    random.seed(4)
    out = []
    for i in range(n):
        payload = random.randbytes(size + i) if i % 2 else prose(i, size // 6).encode()
        out.append(gzip.compress(warc.record_bytes(i, f"http://x/{i}", payload, None, "2020-01-01T00:00:00Z")))
    return out


def starts(parts):
    at = [0]
    for p in parts:
        at.append(at[-1] + len(p))
    return at


def test_undamaged_members_and_plain_records_are_read():
    parts = members()
    found = read(b"".join(parts))
    assert [(a, b) for a, b, _, _ in found] == list(zip(starts(parts), starts(parts)[1:], strict=False))
    plain = [gzip.decompress(p) for p in parts]
    assert [f[2][0] for f in read(b"".join(plain))] == [f"<urn:page:{i}>" for i in range(12)]
    assert len(read(plain[0] + parts[1] + plain[2])) == 3
    assert read(b"") == []


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("damage", ["flip", "cut", "noise", "drop_head", "drop_tail", "magic"])
def test_later_records_are_recovered_and_gaps_logged(damage, plain):
    parts = [gzip.decompress(p) for p in members()] if plain else members()
    whole, hurt = list(parts), 5
    middle = len(parts[hurt]) // 2
    if damage == "flip":
        parts[hurt] = parts[hurt][:middle] + bytes([parts[hurt][middle] ^ 255]) + parts[hurt][middle + 1:]
    elif damage == "cut":
        parts[hurt] = parts[hurt][:middle]
    elif damage == "noise":
        parts[hurt] = b"noise" * 1000 + parts[hurt]
    elif damage == "drop_head":
        parts[hurt] = parts[hurt][7:]
    elif damage == "drop_tail":
        parts[hurt] = parts[hurt][:-3]
    else:  # marks of a member and a version line inside the damage
        parts[hurt] = parts[hurt][:20] + b"\x1f\x8b\x08WARC/1.1\r\n\x1f\x8b\x08" + parts[hurt][40:]
    data = b"".join(parts)
    found = read(data)
    names = [f[2][0] for f in found if f[2]]
    lost = set() if damage == "noise" else {hurt}
    assert names == [f"<urn:page:{i}>" for i in range(len(whole)) if i not in lost]
    gaps = [(a, b, why) for a, b, fields, why in found if fields is None]
    assert gaps and all(why for _, _, why in gaps)
    # Records and gaps tile the file.
    assert [a for a, *_ in found] == [0, *[b for _, b, *_ in found][:-1]] and found[-1][1] == len(data)


def test_damage_at_the_end_and_nothing_but_damage():
    parts = members(3)
    data = b"".join(parts)[:-10]
    assert [f[2] is None for f in read(data)] == [False, False, True]
    assert read(b"x" * 5000) == [(0, 5000, None, "neither a member nor a version line")]


def test_wrong_digests_are_damage():
    record = gzip.decompress(members(1)[0])
    for at in (b"<urn:page:0>", b"WARC-Block-Digest: sha1:"):
        assert at in record
    wrong = record.replace(b"WARC-Block-Digest: sha1:", b"WARC-Block-Digest: sha1:A", 1)
    data = gzip.compress(wrong) + members(2)[1]
    assert [(f[2] and f[2][0], f[3]) for f in read(data)] == [(None, "wrong block digest"), ("<urn:page:1>", None)]


def test_search_crosses_read_steps(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 64)
    parts = members(4, 400)
    data = parts[0] + b"\x00" * 777 + parts[1] + parts[2][:-5] + parts[3]
    assert [f[2] and f[2][0] for f in read(data)] == ["<urn:page:0>", None, "<urn:page:1>", None, "<urn:page:3>"]


PAGES = [(3, "http://a/1", "same"), (1, "http://a/2\r\nX: y", "same"), (2, None, "same"), (9, "http://b", None), (8, "", ""),
         (5, "http://ü", "é🤗" * 2000), (None, "http://n", "same"), (1, "http://a/2", "same"), (7, "u", "\r\n\r\nContent-Length: 5\r\n\r\n"),
         (-4, "u", prose(1, 30_000)), (None, "u", "only without an id")]


def test_archives_hold_each_payload_once(spark):
    table = spark.createDataFrame(PAGES, PAGE).withColumn("digest", F.lit("clash"))
    archives = warc.write_archives(table, archive_bytes=2000)
    assert archives.count() > 1
    found = warc.read_archives(archives)
    assert found.filter("kind = 'gap'").count() == 0
    expected = []
    for page, _, html in PAGES:
        payload = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        later = same and page != min(same)
        expected.append((page, len(payload), warc.base32_digest(payload), "revisit" if later else "response",
                         min(same) if later else None, None if later else payload))
    made = found.select(warc.page_of(F.col("record_id")), "payload_bytes", "payload_digest", "record_type",
                        warc.page_of(F.col("refers_to")), "payload")
    got = (tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in made.collect())
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_small_payloads_can_all_be_responses_and_empty_tables(spark):
    table = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], PAGE)
    found = warc.read_archives(warc.write_archives(table, min_payload=3))
    kinds = {r[0]: r[1] for r in found.select(warc.page_of(F.col("record_id")), "record_type").collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.read_archives(warc.write_archives(table.limit(0))).collect() == []


def test_damaged_files_are_salvaged_through_spark(spark, tmp_path):
    parts = members(20)
    path = tmp_path / "hurt.warc.gz"
    path.write_bytes(b"".join(parts[:7]) + zlib.compress(b"junk") + b"".join(parts[8:]))
    table = spark.createDataFrame([(f"file://{path}",)], "archive string")
    found = warc.read_archives(table).collect()
    assert sum(r["kind"] == "record" for r in found) == 19
    assert [(r["start"], r["length"]) for r in found if r["kind"] == "gap"] == [
        (sum(map(len, parts[:7])), len(zlib.compress(b"junk")))]


def plain_records(n):
    return [gzip.decompress(p) for p in members(n, 300)]


def test_records_inside_a_member_are_recovered_one_by_one():
    records = plain_records(6)
    names = [f"<urn:page:{i}>" for i in range(6)]
    data = gzip.compress(b"".join(records))
    assert [f[2][0] for f in read(data)] == names
    broken = [*records]
    broken[0] = broken[0].replace(b"WARC-Block-Digest: sha1:", b"WARC-Block-Digest: sha1:A", 1)
    broken[3] = b"noise" + broken[3][9:]
    found = list(warc.read_records(io.BytesIO(data := gzip.compress(b"".join(broken)) + members(7, 300)[6]), len(data)))
    assert [f[4][0] for f in found if f[4]] == [names[i] for i in (1, 2, 4, 5)] + ["<urn:page:6>"]
    # Records and gaps tile the unpacked member.
    inner = [f[2:4] for f in found[:-1]]
    assert inner[0][0] == 0 and inner[-1][1] == sum(map(len, broken))
    assert [a for a, _ in inner[1:]] == [b for _, b in inner[:-1]]
    assert [f[5] for f in found if f[4] is None] == ["wrong block digest", "no record header"]
    assert found[-1][2:4] == (None, None)


def test_long_headers_are_read():
    record = warc.record_bytes(1, "http://x/" + "a" * 700_000, b"payload", None, "2020-01-01T00:00:00Z")
    other = plain_records(1)[0]
    assert [f[2][0] for f in read(record + other)] == ["<urn:page:1>", "<urn:page:0>"]
    assert [f[2][0] for f in read(gzip.compress(record) + other)] == ["<urn:page:1>", "<urn:page:0>"]


def test_searching_reads_a_file_a_few_times_at_most():
    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            part = super().read(n)
            Counted.taken += len(part)
            return part

    part = members(2, 300)[1]
    hurt = part[:len(part) // 2] + b"\x00" + part[len(part) // 2 + 1:]
    data = hurt * 8000 + part
    found = list(warc.read_archive(Counted(data), len(data)))
    assert [f[2] is None for f in found] == [True, False]
    assert Counted.taken < 8 * len(data)


def test_a_member_too_large_is_a_gap():
    parts = members(3, 300)
    found = list(warc.read_records(io.BytesIO(b"".join(parts)), sum(map(len, parts)), max_record=10))
    assert [(f[4], f[5]) for f in found] == [(None, "member too large")]
