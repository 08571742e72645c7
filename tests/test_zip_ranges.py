"""Zip members by their own bytes, and headers of any kind."""

import io
import json
import zipfile

import numpy as np
import pytest
from encoder import block, dump, tgz, zipped
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from arraymetrics.sources import archive

GOOD = tgz(dump([block([("10", ["A"], ["22"])], 0, 120, 60, [[1], [2]])], "SN1"))


def test_members_are_read_by_range(spark, tmp_path):
    folder = tmp_path / "a b[1]"
    folder.mkdir()
    (folder / "one.zip").write_bytes(zipped({f"d/{i}.tgz": GOOD for i in range(5)} | {"x.txt": b"?"}))
    with zipfile.ZipFile(folder / "two.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("p.tgz", GOOD)
        z.writestr("q.tgz", b"")
    (folder / "none.zip").write_bytes(b"PK no zip")
    (folder / "bare.zip").write_bytes(zipped({}))
    raw = bytearray(zipped({"s.tgz": GOOD, "t.tgz": GOOD}))
    raw[raw.rindex(b"PK\1\2") + 8] |= 1  # the directory says that t is encrypted
    (folder / "shut.zip").write_bytes(bytes(raw))
    with zipfile.ZipFile(folder / "bz.zip", "w", zipfile.ZIP_BZIP2) as z:
        z.writestr("b.tgz", GOOD)
    cut = zipped({"u.tgz": GOOD})
    cut = bytearray(cut)
    cut[:4] = b"XXXX"
    (folder / "head.zip").write_bytes(bytes(cut))
    at = str(tmp_path / "a b*")
    found = archive.scan_zip_members(spark, at)
    assert "Exchange" in (plan := found._jdf.queryExecution().executedPlan().toString())
    assert "content" not in plan[plan.index("MapInArrow", plan.index("MapInArrow") + 5) :]  # below the directory no content is read
    got = {(r.path.rsplit("/", 1)[1], r.member): (bytes(r.content), r.problem) for r in found.collect()}
    assert {k: v[0] for k, v in got.items() if v[1] is None} == {("one.zip", f"d/{i}.tgz"): GOOD for i in range(5)} | {("two.zip", "p.tgz"): GOOD, ("two.zip", "q.tgz"): b"", ("shut.zip", "s.tgz"): GOOD}
    whole = {(r.path.rsplit("/", 1)[1], r.member): bytes(r.content) for r in archive._members_of_whole_zips(spark, at).collect()}
    assert whole == {k: v[0] for k, v in got.items()}
    bad = {(r.path.rsplit("/", 1)[1], r.member): r.reason for r in archive.quarantine(archive.decode(found)).collect()}
    assert bad == {("none.zip", None): "not_zip", ("two.zip", "q.tgz"): "empty", ("shut.zip", "t.tgz"): "encrypted", ("bz.zip", "b.tgz"): "zip_method", ("head.zip", "u.tgz"): "damaged_member"}
    assert archive.to_points(archive.decode(found)).count() == 14


def test_zip_beyond_two_gigabytes(spark, tmp_path):
    """A sparse file: the second member begins behind 2.2 GB of nothing."""
    small = zipped({"a.tgz": GOOD})
    gap = 2_200_000_000
    with open(tmp_path / "big.zip", "wb") as f:
        f.write(b"\0" * 8)
        f.seek(gap)
        f.write(small)
    rows = archive.scan_zip_members(spark, str(tmp_path)).collect()  # a directory's places count from where the zip begins
    assert [(r.member, bytes(r.content), r.problem) for r in rows] == [("a.tgz", GOOD, None)]


def test_stores_that_only_spark_opens(spark, tmp_path):
    assert archive.reachable("file:/x") and archive.reachable("/x") and not archive.reachable("viewfs://c/x")
    (tmp_path / "a.zip").write_bytes(zipped({"a.tgz": GOOD}))
    assert archive._members_of_whole_zips(spark, str(tmp_path)).count() == 1


def _decode(spark, *contents):
    df = spark.createDataFrame([(str(n), None, bytearray(c), None) for n, c in enumerate(contents)], archive.FILES)
    out = {}
    for r in archive.decode(df).collect():
        out.setdefault(int(r.path), []).append(r)
    return out


def _with_header(head: bytes, body: bytes = b"\0" * 64) -> bytes:
    return tgz(dump([np.array([0, 8 + len(head)], "<i4").tobytes() + head + body]))


VALUES = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats() | st.text(st.characters(codec=None), max_size=6) | st.sampled_from([1e20, 3e9, "60", "x", 10**400, 10**15]),
    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from(["Names", "DataTypes", "IDs", "z"]), x, max_size=3), max_leaves=6,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(cases=st.lists(st.fixed_dictionaries({k: st.one_of(VALUES, st.just(v)) for k, v in (("StartTime", "0"), ("EndTime", "600"), ("Archive", "60"), ("Map", {"10": {"Names": ["A"], "DataTypes": [22]}}))}), min_size=30, max_size=30), names=VALUES, types=VALUES)
def test_headers_of_any_kind_end_in_the_quarantine_or_as_they_are(spark, cases, names, types):
    maps = [{"StartTime": "0", "EndTime": "120", "Archive": "60", "Map": {"10": {"Names": n, "DataTypes": t}}} for n in (names, ["A"]) for t in (types, [22, "5"])]
    heads = [json.dumps(c).encode() for c in cases + maps]
    got = _decode(spark, *(_with_header(h) for h in heads))
    assert set(got) == set(range(len(heads))) - {n for n in range(len(heads)) if n not in got}
    for rows in got.values():
        assert len({r.reason for r in rows}) == 1
        assert rows[0].reason in (None, "bad_header", "truncated_header")
    assert {(r.element, r.metric_id, tuple(r.data)) for r in got[len(heads) - 1]} == {("A", "22", (0, 0)), ("A", "5", (0, 0))}
    df = spark.createDataFrame([(str(n), None, bytearray(_with_header(h)), None) for n, h in enumerate(heads)], archive.FILES)
    archive.to_points(archive.decode(df)).write.format("noop").mode("overwrite").save()


@pytest.mark.parametrize("change", [{"Archive": 3e9}, {"StartTime": 1e20}, {"StartTime": 10**15, "EndTime": 10**15 + 60}, {"Map": {"10": {"Names": [1, 2], "DataTypes": [22]}}}, {"Map": {"10": {"Names": [None], "DataTypes": [22]}}}, {"Map": {"10": {"Names": "AB", "DataTypes": [22]}}}, {"Map": {"10": {"Names": [["A"]], "DataTypes": [22]}}}, {"Map": {"10": {"Names": ["A"] * 2000, "DataTypes": [22] * 2000}}}, {"Map": 7}, {"Map": {"10": {"Names": ["\ud800"], "DataTypes": [22]}}}])
def test_headers_that_once_raised(spark, change):
    head = {"StartTime": "0", "EndTime": "120", "Archive": "60", "Map": {"10": {"Names": ["A"], "DataTypes": [22]}}} | change
    assert [r.reason for r in _decode(spark, _with_header(json.dumps(head).encode()))[0]] == ["bad_header"]


def test_a_file_is_read_whole_or_not_at_all(spark):
    one = block([("10", ["A"], ["22"])], 0, 120, 60, [[1], [2]])
    got = _decode(spark, tgz(dump([one, np.array([0, 12], "<i4").tobytes() + b"oops"])))
    assert [(r.reason, r.element) for r in got[0]] == [("bad_header", None)]


def test_serial_numbers_from_names(spark):
    raw = tgz(dump([block([("10", ["A"], ["22"])], 0, 60, 60, [[1]])], ""))
    rows = [("file:/in/a.zip", "PerfData_M_SN_21X_SP0_0_20240101000000.tgz"), ("file:/in/a_2102355THQFSQ2100014.zip", "x.tgz"), ("file:/in/2102355THQFSQ2100099/b.zip", "x.tgz"), ("file:/in/(10.0.0.7).zip", "x.tgz"), ("file:/in/c.tgz", None)]
    df = spark.createDataFrame([(p, m, bytearray(raw), None) for p, m in rows], archive.FILES)
    assert sorted(r.sn for r in archive.to_points(archive.decode(df)).collect()) == ["2102355THQFSQ2100014", "2102355THQFSQ2100099", "21X", "UNKNOWN_10_0_0_7", "UNKNOWN_SN"]
