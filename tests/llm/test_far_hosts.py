"""Hosts many links away from every seed."""

from arraymetrics.llm import urlfilter


def test_masses_reach_along_a_chain(spark):
    n = 40
    edges = spark.createDataFrame([(f"h{k}", f"h{k + 1}", 1) for k in range(n)] + [("p", "q", 1), ("q", "p", 1)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("trust", "h0", 1.0), ("trust", "p", 1.0)], "kind string, host string, weight double")
    got = {r.host: r.mass for r in urlfilter.propagate(seeds, edges).collect()}
    d = urlfilter.DAMPING
    want = {f"h{k}": d**k / 2 for k in range(n + 1)} | {"p": 0.5 / (1 - d * d), "q": 0.5 * d / (1 - d * d)}
    total = sum(want.values())
    assert got.keys() == want.keys() and all(abs(got[h] - m / total) < urlfilter.TOLERANCE for h, m in want.items())
