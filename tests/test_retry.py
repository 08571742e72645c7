from encoder import block, dump, tgz, zipped

from arraymetrics.sources import archive
from arraymetrics.streaming import watch

GOOD = tgz(dump([block([("10", ["A"], ["22"])], 0, 120, 60, [[1], [2]])]))
LOST = "path string, member string, reason string, detail string, attempt int"


def test_zip_members_and_what_is_given_up(spark, tmp_path):
    (tmp_path / "a[1]" / "below").mkdir(parents=True)
    files = {"a[1]/m.zip": zipped({"x.tgz": GOOD, "y.tgz": b"bad", "z.tgz": GOOD}), "a[1]/below/w.zip": zipped({"x.tgz": GOOD, "y.tgz": b"bad"}), "a[1]/f.tgz": b"bad", "a[1]/below/g.tgz": GOOD, "a[1]/up.tgz": GOOD}
    for name, raw in files.items():
        (tmp_path / name).write_bytes(raw)
    at = lambda name: f"file:{tmp_path}/{name}"
    rows = [("a[1]/m.zip", "x.tgz", 1), ("a[1]/m.zip", "y.tgz", 2), ("a[1]/below/w.zip", None, 1), ("a[1]/f.tgz", None, 1), ("a[1]/below/g.tgz", None, 2), ("a[1]/up.tgz", None, 3), ("a[1]/none.tgz", None, 1), ("gone/h.tgz", None, 1)]
    lost = spark.createDataFrame([(at(p), m, "not_gzip", "", n) for p, m, n in rows], LOST)
    blocks, failed = watch.retry_quarantine(spark, lost)
    assert sorted((r.path, r.member or "") for r in blocks.collect()) == sorted([(at("a[1]/m.zip"), "x.tgz"), (at("a[1]/below/w.zip"), "x.tgz"), (at("a[1]/below/g.tgz"), "")])
    want = [("a[1]/m.zip", "y.tgz", 3), ("a[1]/below/w.zip", "y.tgz", 2), ("a[1]/f.tgz", None, 2), ("a[1]/up.tgz", None, 3), ("a[1]/none.tgz", None, 1), ("gone/h.tgz", None, 1)]
    assert sorted(str((r.path, r.member, r.attempt)) for r in failed.collect()) == sorted(str((at(p), m, n)) for p, m, n in want)
    assert failed.columns == archive.quarantine(blocks).columns


def test_no_row_of_a_large_quarantine_is_lost(spark, tmp_path):
    (tmp_path / "good.tgz").write_bytes(GOOD)
    paths = spark.range(12_000).selectExpr(f"concat('file:{tmp_path}/', if(id = 0, 'good', concat('gone', id)), '.tgz') AS path")
    blocks, failed = watch.retry_quarantine(spark, paths.selectExpr("path", "CAST(NULL AS STRING) AS member", "'not_gzip' AS reason", "'' AS detail", "1 AS attempt"))
    assert blocks.count() == 1 and failed.count() == 11_999
