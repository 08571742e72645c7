"""URL filters: written rules first, then trust and distrust propagated over the graph of hosts."""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, stored

#: The rules of the registered query: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING = 0.85
TOLERANCE = 1e-6
#: Rounds after which the mass of both kinds still under way is less than TOLERANCE, wherever the links lead.
ROUNDS = math.ceil(math.log(TOLERANCE / 2) / math.log(DAMPING))
#: A host is blocked if its distrust exceeds this many times its trust.
MARGIN = 4.0
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def _lowered(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (ASCII-lowercased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return _lowered(raw), path


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, rule_verdict); null where none fits."""
    out = F.lit(None).cast("struct<rule:string,rule_verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("rule_verdict"))).otherwise(out)
    return out


def site(host: Column) -> Column:
    """A host without user and port, by which pages and links meet."""
    return F.regexp_replace(host, r"^[^@]*@|:\d*$", "")


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, n: links from the pages of one host to another host. Relative links stay on their host."""
    host, _ = split_url(F.col("url"))
    links = pages.where(F.col("html").contains("//")).select(site(host).alias("src"), F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)))).alias("to"))
    return links.select("src", _lowered(site(F.col("to"))).alias("dst")).where("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Personalised PageRank of both kinds at once. ``seeds``: kind, host, weight. Trust runs along the links, distrust
    against them. Returns kind, host, mass; the masses of a kind add up to 1 (mass that ends in a host
    without links returns to the seeds, which the division at the end amounts to)."""
    kinds = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "n").unionAll(edges.select(F.lit("distrust"), F.col("dst"), F.col("src"), "n"))
    total = kinds.groupBy("kind", "a").agg(F.sum("n").alias("total"))
    steps = stored(kinds.join(total, ["kind", "a"]).select("kind", "a", "b", (F.col("n") / F.col("total")).alias("w")))
    sums = seeds.groupBy("kind").agg(F.sum("weight").alias("all"))
    start = checkpointed(seeds.join(F.broadcast(sums), "kind").where("all > 0").select("kind", "host", (F.col("weight") / F.col("all")).alias("mass")))
    rank, front = start, start
    if steps.isEmpty():
        return rank
    for k in range(rounds):
        front = checkpointed(
            front.join(steps, (front["kind"] == steps["kind"]) & (front["host"] == steps["a"])).select(front["kind"], F.col("b").alias("host"), (F.col("mass") * F.col("w") * DAMPING).alias("mass")).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        )
        moved = front.agg(F.sum("mass")).first()[0] or 0.0
        rank = rank.unionAll(front).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        if k % 4 == 3:
            rank = checkpointed(rank)
        if moved < TOLERANCE:
            break
    sums = rank.groupBy("kind").agg(F.sum("mass").alias("all"))
    return rank.join(F.broadcast(sums), "kind").select("kind", "host", (F.col("mass") / F.col("all")).alias("mass"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row of ``pages`` (page_id, url, html).

    A page that a rule fits gets the longest rule's verdict. For the others the host decides: seeds are the hosts with pages
    that rules allow (trust) or block (distrust), by share of such pages; masses spread over the host graph, and a host
    is blocked if its distrust exceeds MARGIN times its trust, else allowed. So a host that neither kind reaches is allowed.
    A null url, or one without ``://``, has an empty host and path, which no rule fits; it is allowed. Null html has no
    links. Repeated rows are judged alike, and other columns are ignored.
    """
    host, path = split_url(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"), rule_for(host, path, rules).alias("r")).select("page_id", "host", "path", site(F.col("host")).alias("site"), "r.rule", "r.rule_verdict")
    counts = judged.where("rule IS NOT NULL").groupBy(F.col("site").alias("host")).agg(F.avg((F.col("rule_verdict") == "allow").cast("double")).alias("allowed"))
    seeds = counts.select("host", F.explode(F.create_map(F.lit("trust"), F.col("allowed"), F.lit("distrust"), 1 - F.col("allowed"))).alias("kind", "weight")).where("weight > 0").select("kind", "host", "weight")
    mass = propagate(seeds, host_edges(pages))
    pick = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), F.lit(0.0))
    hosts = mass.groupBy(F.col("host").alias("_host")).agg(pick("trust").alias("trust"), pick("distrust").alias("distrust"))
    out = judged.join(hosts, judged["site"] == hosts["_host"], "left")
    spread = F.when(F.coalesce("distrust", F.lit(0.0)) > MARGIN * F.coalesce("trust", F.lit(0.0)), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", spread).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def op7_url_filters(spark, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
