"""Exact k-means by dimension-sharded Lloyd rounds.

Vectors are written once as column blocks: some hundred vectors by a few components each. In a round every column block works out its
part of the squared distances to its slice of the centroids; the parts of a block of vectors are added up over the shards and the
nearest centroid is taken; then each shard sums its own components by cluster, which gives its slice of the next centroids. All is in whole
numbers, so the result depends on no order.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored

#: Vectors of a block, and components of a shard.
BLOCK, WIDTH = 512, 16
#: Numbers of all centroids: they pass through the driver and go to every task.
CENTRE_NUMBERS = 1 << 22
_EXACT, _LONG = 1 << 53, 1 << 62


def usable(vectors: DataFrame, dims: int) -> DataFrame:
    """``vec_id`` and ``embedding`` of the rows whose vector has ``dims`` components, none null, NaN or infinite."""
    bad = F.exists("embedding", lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    kept = vectors.where((F.size("embedding") == dims) & ~F.coalesce(bad, F.lit(True)))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def whole_numbers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): longs, or Python's integers where longs have no room for sums of them."""
    with np.errstate(over="ignore"):
        y = np.floor(x * float(scale))
    if np.abs(y).max(initial=0) < 1 << 40:
        return y.astype(np.int64)
    return np.array([[int(v) * scale if abs(v) >= _EXACT else math.floor(v * scale) for v in row] for row in x.tolist()], object).reshape(x.shape)


def _packed(a: np.ndarray) -> bytes:
    """An array as bytes, in the narrowest type that holds it."""
    if a.dtype == object:
        return b"o" + pickle.dumps(a)
    most = max(-int(a.min(initial=0)), int(a.max(initial=0)))
    kind = next(k for k, bits in (("h", 15), ("i", 31), ("q", 63)) if most < 1 << bits)
    return kind.encode() + a.astype(f"<{kind}").tobytes()


def _unpacked(raw: bytes, columns: int) -> np.ndarray:
    if raw[:1] == b"o":
        return pickle.loads(raw[1:])
    a = np.frombuffer(raw, f"<{raw[:1].decode()}", offset=1).reshape(-1, columns)
    return a.astype(np.int64)


def partial_distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids over the components of one shard; in doubles or longs where these are exact."""
    most = (int(np.abs(v).max(initial=0)) + int(np.abs(c).max(initial=0))) ** 2 * v.shape[1]
    kind = np.float64 if most < _EXACT else np.int64 if most < _LONG else object
    v, c = v.astype(kind), c.astype(kind)
    out = np.zeros((len(v), len(c)), kind)
    for j in range(v.shape[1]):
        out += (v[:, j, None] - c[None, :, j]) ** 2
    return out if kind is object else out.astype(np.int64)


def added(parts: list[np.ndarray]) -> np.ndarray:
    """The sum of partial distances; in Python's integers if longs might not do."""
    if any(p.dtype == object for p in parts) or sum(int(p.max(initial=0)) for p in parts) >= _LONG:
        parts = [p.astype(object) for p in parts]
    return sum(parts[1:], parts[0])


def column_blocks(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """A row for each block of vectors and shard of components: block, shard, ids (with shard 0 only), rows and the numbers as bytes. Written, as later
    rounds must meet the same blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for b in batches:
            for i in range(0, len(b), BLOCK):
                part = b.slice(i, BLOCK)
                v = whole_numbers(part.column("embedding").flatten().to_numpy().reshape(len(part), dims), scale)
                shards = range(0, dims, WIDTH)
                ids = [part.column("vec_id").to_pylist()] + [None] * (len(shards) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task << 32 | made] * len(shards), pa.int64()), pa.array(range(len(shards)), pa.int32()), pa.array(ids, pa.list_(pa.int64())), pa.array([_packed(v[:, s : s + WIDTH]) for s in shards], pa.binary())],
                    ["block", "shard", "ids", "v"],
                )
                made += 1

    return stored(vectors.mapInArrow(run, "block long, shard int, ids array<long>, v binary"))


def _slices(c: np.ndarray) -> list[np.ndarray]:
    return [c[:, s : s + WIDTH] for s in range(0, c.shape[1], WIDTH)]


def assign(blocks: DataFrame, c: np.ndarray) -> DataFrame:
    """block, cluster and distance (arrays in the block's order) of the nearest centroid; equal distances go to the smaller number."""
    dims, k = c.shape[1], len(c)
    centres = blocks.sparkSession.sparkContext.broadcast(_slices(c))
    wide = lambda shard: min(WIDTH, dims - shard * WIDTH)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [_packed(partial_distances(_unpacked(v, wide(s)), centres.value[s])) for s, v in zip(b.column("shard").to_pylist(), b.column("v").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("block"), pa.array(out, pa.binary())], ["block", "d"])

    def nearest(rows: pa.Table) -> pa.Table:
        d = added([_unpacked(x, k) for x in rows.column("d").to_pylist()])
        at = np.array([min(range(k), key=row.__getitem__) for row in d.tolist()], np.int32) if d.dtype == object else d.argmin(axis=1).astype(np.int32)
        best = [int(x) for x in d[np.arange(len(d)), at]]
        if max(best, default=0) >= 1 << 63:
            raise OverflowError("a squared distance has no room in a long")
        return pa.table({"block": rows.column("block")[:1], "cluster": pa.array([at.tolist()], pa.list_(pa.int32())), "distance": pa.array([best], pa.list_(pa.int64()))})

    parts = blocks.select("block", "shard", "v").mapInArrow(part, "block long, d binary")
    return parts.groupBy("block").applyInArrow(nearest, "block long, cluster array<int>, distance array<long>")


def moved(blocks: DataFrame, near: DataFrame, c: np.ndarray) -> np.ndarray:
    """The next centroids: each shard sums its components by cluster; floor(sum / count) takes their place, and empty clusters stay."""
    dims = c.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[int, list[int]]] = {}
        for b in batches:
            for shard, raw, cluster in zip(b.column("shard").to_pylist(), b.column("v").to_pylist(), b.column("cluster"), strict=True):
                v = _unpacked(raw, min(WIDTH, dims - shard * WIDTH))
                own = cluster.values.to_numpy()
                for x in np.unique(own).tolist():
                    rows = v[own == x]
                    n, total = held.get((shard, x), (0, [0] * v.shape[1]))
                    held[shard, x] = n + len(rows), [a + int(s) for a, s in zip(total, rows.sum(axis=0), strict=True)]
        rows = [(shard, x, shard * WIDTH + j, n, str(s)) for (shard, x), (n, total) in held.items() for j, s in enumerate(total)]
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string()), strict=True)], ["shard", "cluster", "component", "n", "total"])

    both = blocks.select("block", "shard", "v").join(near.select("block", "cluster"), "block").select("shard", "v", "cluster")
    total = both.mapInArrow(sums, "shard int, cluster int, component int, n long, total string").groupBy("shard", "cluster", "component")
    out = c.astype(object)
    for r in total.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).toLocalIterator():
        out[r.cluster, r.component] = int(r.total) // r.n
    return _narrow(out)


def _narrow(c: np.ndarray) -> np.ndarray:
    return c.astype(np.int64) if all(abs(int(x)) < 1 << 40 for x in c.flat) else c


def cluster(vectors: DataFrame, k: int = 40, dims: int = 64, scale: int = 256, rounds: int = 5, seed: int = 2) -> DataFrame:
    """vec_id, cluster, distance (squared, to the cluster's centroid), cluster_inertia and inertia (sums of distance over the cluster and over all) and
    centroid_sha256 (of the final centroid's components, as decimal integers joined by commas) of each vector.

    Vectors with other than ``dims`` components, or with a null, NaN or infinite one, take no part. A component x counts as floor(scale * x). Centroids
    start as the k vectors of the smallest SHA-256 of ``<seed>:<vec_id>``; with fewer vectors there are fewer centroids. Rows are told
    apart by their place, so those that share a vec_id are each a vector (as starts, in the order of their components), and those with a null vec_id
    take part but start no centroid; if there is no start there are no rows. Other columns are ignored. Components of any size are exact; a distance, or an inertia, that a long can't
    hold is an error.

    Only k * dims numbers reach the driver (CENTRE_NUMBERS at most). A block's parts of all shards meet in one group, whatever its vectors are, so many
    equal vectors make no group large.
    """
    if k * dims > CENTRE_NUMBERS:
        raise ValueError(f"{k} centroids of {dims} components are more than {CENTRE_NUMBERS} numbers")
    spark = vectors.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    kept = usable(vectors, dims)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.where("vec_id IS NOT NULL").orderBy(name, "embedding").limit(k).select("embedding").collect()
    if not first:
        return spark.createDataFrame([], schema)
    c = _narrow(whole_numbers(np.array([r.embedding for r in first], np.float64), scale).astype(object))
    blocks = column_blocks(kept, dims, scale)
    for _ in range(rounds):
        near = stored(assign(blocks, c).select("block", "cluster"))
        c = moved(blocks, near, c)
        dropped(near)
    last = assign(blocks, c).join(blocks.where("shard = 0").select("block", "ids"), "block")
    rows = stored(last.select(F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("r")).select(F.col("r.ids").alias("vec_id"), "r.cluster", "r.distance"))
    dropped(blocks)
    own = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r.s) for r in own)
    if total >= 1 << 63:
        raise OverflowError("the inertia has no room in a long")
    sha = lambda x: hashlib.sha256(",".join(str(int(v)) for v in c[x]).encode()).hexdigest()
    table = spark.createDataFrame([(r.cluster, int(r.s), total, sha(r.cluster)) for r in own], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select(*(x.split()[0] for x in schema.split(", ")))


def op12_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    """The clusters of all embeddings."""
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(k: int = 40, rounds: int = 5) -> str:
    out = [f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND NOT coalesce(list_bool_or(list_transform(embedding, lambda e: e IS NULL OR NOT isfinite(e))), true)),
p AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
s AS (SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c FROM v WHERE vec_id IS NOT NULL QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM s)"""]
    near = "SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT r, c, CAST(sum((p.x - o.x) * (p.x - o.x)) AS BIGINT) AS d FROM p JOIN c{n} AS o USING (i) GROUP BY r, c) GROUP BY r"
    for n in range(rounds):
        out.append(f"a{n} AS MATERIALIZED ({near.format(n=n)})")
        out.append(f"""m{n} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM p JOIN a{n} USING (r) GROUP BY c, i),
c{n + 1} AS MATERIALIZED (SELECT o.c, o.i, CASE WHEN n IS NULL THEN o.x ELSE CAST((s - (((s % n) + n) % n)) // n AS BIGINT) END AS x FROM c{n} AS o LEFT JOIN m{n} USING (c, i))""")
    out.append(f"a AS MATERIALIZED ({near.format(n=rounds)})")
    out.append(f"h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS sha FROM c{rounds} GROUP BY c)")
    return ",\n".join(out) + """
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256
FROM a JOIN v USING (r) JOIN h ON h.c = a.c"""


OP12_SQL = _sql()
