"""Records inside damaged members, and archives of a bounded size."""

from __future__ import annotations

import gzip

from hearthwatt.llm import warc
from test_edges import plain


def numbers(content):
    return [int(f["record_id"][10:-1]) for _, _, f, _ in warc.salvage(content) if f]


def gaps(content):
    return [(a, b, reason) for a, b, f, reason in warc.salvage(content) if not f]


def records(n, first=0):
    return [plain(i, f"payload {i} ".encode() * 40) for i in range(first, first + n)]


def test_member_of_several_records():
    whole = gzip.compress(b"".join(records(3)))
    assert numbers(whole + gzip.compress(records(1, 3)[0])) == [0, 1, 2, 3] and gaps(whole) == []
    assert {(a, b) for a, b, f, _ in warc.salvage(whole)} == {(0, len(whole))}


def test_bad_record_within_a_member():
    one, two, three = records(3)
    content = gzip.compress(one + two.replace(b"payload 1", b"payload X", 1) + three)
    assert numbers(content) == [0, 2]
    assert [(a, b) for a, b, _ in gaps(content)] == [(0, len(content))] and "payload digest differs" in gaps(content)[0][2]
    assert gaps(gzip.compress(b"nothing of the kind"))[0][2] == "no version line"


def test_member_without_its_trailer():
    """All bytes of the record are there, but the checksum is not: the digest vouches for it."""
    member = gzip.compress(records(1)[0])
    for cut in range(1, 9):
        content = member[:-cut] + gzip.compress(records(1, 1)[0])
        assert numbers(content) == [0, 1]
        assert [(a, b) for a, b, _ in gaps(content)] == [(0, len(member) - cut)]
    assert numbers(member[:-3]) == [0] and len(gaps(member[:-3])) == 1


def test_records_before_a_fault():
    """The first records of a member that breaks in the middle, and no record twice."""
    many = [plain(i, bytes((i * 7 + j * j) % 251 for j in range(3000))) for i in range(60)]
    member = bytearray(gzip.compress(b"".join(many)))
    member[len(member) * 3 // 4] ^= 0xFF
    found = numbers(bytes(member) + gzip.compress(records(1, 100)[0]))
    assert found[-1] == 100 and found[:-1] == list(range(len(found) - 1)) and len(found) > 30


def test_unverified_record_of_a_damaged_member_is_not_trusted():
    record = records(1)[0].replace(b"WARC-Payload-Digest", b"X-Nothing-Of-The-Kind")
    member = gzip.compress(record)
    assert numbers(member) == [0] and numbers(member[:-3]) == []


def test_archives_are_bounded(spark, tmp_path):
    """Large pages that lie together make more archives and not larger ones."""
    import random

    rng = random.Random(1)
    pages = [(i, "u", "".join(chr(rng.randrange(33, 126)) for _ in range(60_000 if i < 40 else 10))) for i in range(400)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    folder = f"file://{tmp_path}/a"
    warc.write_warc(table, folder, archive_bytes=200_000)
    sizes = [p.stat().st_size for p in tmp_path.glob("a/part-*")]
    assert max(sizes) <= 200_000 and len(sizes) < 30
    found = warc.read_warc(spark, folder)
    assert found.where("reason IS NULL").count() == 400 and found.where("reason IS NOT NULL").count() == 0
