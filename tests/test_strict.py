"""Strict validation by ranges, and the front door over large and odd files."""

import hashlib
import random
import zipfile
from dataclasses import replace
from datetime import datetime
from functools import reduce

import pytest

from ledgerline.contracts import Feed
from ledgerline.operators.refs import SnapshotStore
from ledgerline.operators.registry import Registry
from ledgerline.sources import front_door, strict
from ledgerline.sources.delivery import Rejected, csv_rows, decoded_pieces, text_lines
from ledgerline.sources.objects import Objects

FEED = Feed(name="f", pattern=r"f_(?P<cob_date>\d{8})\.csv", keys=("a",), columns={"a": "a", "b": "b"}, kinds={"a": "string", "b": "string"}, source_system="q")


def whole(text, feed):
    try:
        return len(csv_rows(text.encode(), feed))
    except Rejected as e:
        return str(e)


def by_ranges(parts, feed):
    try:
        return strict.settled(reduce(strict.compose, [strict.range_table(p, feed) for p in parts])[strict.ROW], feed)
    except Rejected as e:
        return str(e)


def random_text(rng):
    if rng.random() < 0.5:
        letters = rng.choice(['a,"\n', "a,\n", '"\n', 'ab,"\n\r', "a,a,a\n"])
        return "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
    lines = ["a,b\n", '"a",b\n', '"a""b","c"\r\n', '"x\ny",z\n', "\n", 'a,"q,r"\n', "a,b,c\n", 'a"b,c\n']
    return "".join(rng.choice(lines) for _ in range(rng.randint(0, 6))) + rng.choice(["", "a,b", '"a', "a,"])


def test_ranges_cut_anywhere_read_as_a_whole():
    rng = random.Random(3)
    for _ in range(700):
        feed = replace(FEED, header=rng.random() < 0.5, multiline=rng.random() < 0.5)
        text = random_text(rng)
        want = whole(text, feed)
        for cut in [[c] for c in range(len(text) + 1)] + [sorted(rng.choices(range(len(text) + 1), k=5))]:
            parts = [text[a:b] for a, b in zip([0, *cut], [*cut, len(text)], strict=True)]
            assert by_ranges(parts, feed) == want, (text, parts)
        tables = [strict.range_table(p, feed) for p in parts]
        assert reduce(strict.compose, tables) == strict.compose(tables[0], reduce(strict.compose, tables[1:]))


def test_files_are_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(5)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        for n in range(24):
            feed = replace(FEED, multiline=n % 2 == 0, encoding="UTF-8" if n % 3 else "ISO-8859-1")
            rows = [rng.choice(["a,b", '"x\ny, z",é', '"long\n' + "text\n" * 60 + '",b', "", '"q""q",1']) for _ in range(400)]
            if n % 4 == 1:
                rows[rng.randrange(400)] = rng.choice(["only one", "a,b,c", '"a"b,c'])
            text = "a,b\n" + rng.choice(["\n", "\r\n"]).join(rows) + rng.choice(["", "\n"])
            body = (b"\xef\xbb\xbf" if n % 6 == 4 else b"") + text.encode(feed.encoding)
            path = tmp_path / f"f{n}.csv"
            path.write_bytes(body)
            ranges = strict.tables(spark, feed, [str(path)])
            assert ranges.rdd.getNumPartitions() > 4
            try:
                want = (len(csv_rows(body, feed)), None)
            except Rejected as e:
                want = (None, str(e))
            found = list(strict.validated(spark, feed, [str(path)]).values())
            assert found == [want]
            seen = front_door.examined(spark, feed, str(path)).collect()
            assert [(r.bytes, r.md5, r.sha256, r.problem) for r in seen] == [(len(body), hashlib.md5(body).hexdigest(), hashlib.sha256(body).hexdigest(), None)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_odd_files(spark, tmp_path):
    def told(body, **changes):
        path = tmp_path / f"{hashlib.md5(body).hexdigest()}.csv"
        path.write_bytes(body)
        return list(strict.validated(spark, replace(FEED, **changes), [str(path)]).values())

    assert told(b"") == []
    assert told(b"a,b\n\xff,1\n")[0][0] is None
    assert told(b"\xef\xbb\xbfa,b\n1,2\n", encoding="ISO-8859-1") == [(None, "a UTF-8 mark in ISO-8859-1")]
    assert told("a,b\n1,2\n".encode("utf-16"), encoding="UTF-16") == [(1, None)]
    assert told(b'a,b\n"' + b"x" * 300_000 + b'",2\n') == [(1, None)]
    assert list(decoded_pieces([b"\xef\xbb\xbfa\xc3", b"\xa9"], "UTF-8")) == ["a", "é", ""]
    assert [x for lines in text_lines(["a\nb", "c\n", "\nd"]) for x in lines] == ["a", "bc", "", "d"]
    with pytest.raises(Rejected):
        list(decoded_pieces([b"a\xc3"], "UTF-8"))


def packed(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for n, data in members:
            z.writestr(n, data)
    return str(path)


def test_front_door_tells_resends_names_and_checksums(spark, tmp_path):
    store, registry, objects = SnapshotStore(spark, str(tmp_path / "s")), Registry(spark, str(tmp_path / "r")), Objects(spark, str(tmp_path / "o"))
    take = lambda p, **control: front_door.receive(store, registry, objects, FEED, str(p), datetime(2026, 9, 14, 7), "b1", {"text": "".join(f"{k}={v}\n" for k, v in control.items()), "kind": "key_value", "fields": {k: (k, {"md5": "md5", "version": "integer", "cob_date": "date"}[k]) for k in control}} if control else None)
    first, second = tmp_path / "f_20260914.csv", tmp_path / "again" / "f_20260914.csv"
    second.parent.mkdir()
    first.write_text("a,b\n1,2\n")
    assert take(first, md5=hashlib.md5(first.read_bytes()).hexdigest()).status == "ingested"
    assert take(first).status == "already ingested"
    second.write_text("a,b\n1,3\n4,5\n")
    got = take(second)
    assert (got.status, got.version) == ("ingested", 2)
    archive = packed(tmp_path / "f_20260914.zip", [("x.csv", b"a,b\n7,8\n"), ("y.csv", b"")])
    with open(archive, "rb") as f:
        assert take(archive, md5=hashlib.md5(f.read()).hexdigest(), version=9, cob_date="2026-09-14").status == "ingested"
    names = {r.delivery_id: r.name for r in registry.frame("deliveries").collect()}
    assert sorted(names.values()) == ["f_20260914.csv", "f_20260914_v2.csv", "f_20260914_v9.csv"]
    # the same rows packed anew are other bytes of the same parts
    again = packed(tmp_path / "again" / "f_20260914.zip", [("x.csv", b"a,b\n7,8\n"), ("y.csv", b"")])
    assert take(again, cob_date="2026-09-14").status == "already ingested"
    raw = store.read("raw.f")
    assert sorted((r._file_version, r.a, r.b) for r in raw.collect()) == [(1, "1", "2"), (2, "1", "3"), (2, "4", "5"), (3, "7", "8")]
    assert registry.open_intents("ingest") == []


def test_next_names():
    from datetime import date

    from ledgerline.sources.raw_ingest import IngestRefused, next_name

    plain = replace(FEED, pattern=r"f_(?P<cob_date>\d{8})\.csv")
    versioned = replace(FEED, pattern=r"f_(?P<cob_date>\d{8})(?:_v(?P<version>\d+))?\.csv")
    d = date(2026, 1, 2)
    for feed in (plain, versioned):
        taken = set()
        for n in range(1, 100):
            name = next_name(feed, d, taken)
            assert name == ("f_20260102.csv" if n == 1 else f"f_20260102_v{n}.csv")
            taken.add(name)
        with pytest.raises(IngestRefused):
            next_name(feed, d, taken)
