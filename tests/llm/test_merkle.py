import pytest

from kontor.llm import merkle

SCHEMA = "file bigint, offset bigint, length bigint, record string, hash string"


def archive(files=3, records=40):
    rows = []
    for f in range(files):
        at = 0
        for i in range(records):
            text = f"record {f}/{i} " + "x" * (i * 7 % 50)
            rows.append((f, at, len(text), text, "x"))
            at += len(text)
    return rows


@pytest.fixture(params=[None, 64])
def small_ranges(request, monkeypatch):
    if request.param:  # several levels
        monkeypatch.setattr(merkle, "RANGE_BYTES", request.param)
        monkeypatch.setattr(merkle, "FANOUT", 2)


def damage(spark, a, b):
    got = merkle.audit(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)).collect()
    return sorted((str(r.file), r.offset, r.damage) for r in got)


def test_damage_is_located(spark, small_ranges):
    a = archive()
    b = [r for i, r in enumerate(a) if i != 5]
    b[20] = (*b[20][:3], "r" + b[20][3][1:].replace("x", "y") + "!", "x")
    b.append((9, 0, 4, "more", "x"))
    b = [r for r in b if r[0] != 2]  # a lost file
    want = [("0", a[5][1], "missing"), (str(b[20][0]), b[20][1], "changed"), ("9", 0, "extra")]
    want += [("2", r[1], "missing") for r in a if r[0] == 2]
    assert damage(spark, a, b) == sorted(want)


def test_equal_and_empty_archives(spark):
    a = archive(2, 5)
    assert damage(spark, a, list(reversed(a))) == []
    assert damage(spark, [], []) == []
    assert damage(spark, a[:2], []) == [("0", 0, "missing"), ("0", a[1][1], "missing")]


def test_nulls_and_repeated_rows(spark):
    a = [(None, 0, 3, "abc", "x"), (None, 3, 0, None, "x"), (1, 0, 3, "abc", "x"), (1, 0, 3, "abc", "x")]
    assert damage(spark, a, a) == []
    assert damage(spark, a, [a[0], a[1], a[2]]) == [("1", 0, "changed")]
    assert damage(spark, a, [(None, 0, 3, "abd", "x"), *a[1:]]) == [("None", 0, "changed")]


def test_records_of_pages(spark):
    pages = spark.createDataFrame(
        [(0, "u", "<p>"), (1, None, None), (1, None, None), (600, "v", "é"), (None, "w", "z")], "page_id bigint, url string, html string"
    )
    rows = merkle.placed(merkle.warc_records(pages)).collect()
    assert len(rows) == 5 and {r.file for r in rows} == {-1, 0, 1}
    own = sorted((r.offset, r.length) for r in rows if r.file == 0)
    assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
    assert all(len(r.record.encode()) == r.length for r in rows)
