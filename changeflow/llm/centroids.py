"""Centroid clustering of vectors in integer arithmetic, with built-in expressions only.

Components are scaled and floored to integers, so distances, sums and centroids are exact and do not depend on the order of rows or
tasks. Every round is one scan of the vector column: ``zip_with`` and ``aggregate`` give the squared distance to each of the
centroids, which are literals of the plan; ``array_min`` over ``(distance, number)`` chooses the cluster; one sum per component, combined
before the shuffle, gives the next centroids. Only ``k`` rows of sums reach the driver.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPONENTS, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
# (2 * LARGEST)^2 * COMPONENTS is below 2^63
LARGEST = 1 << 27


def integer_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE
) -> DataFrame:
    """``vec_id, v`` of the rows whose vector has ``components`` finite values; ``v`` holds ``floor(scale * x)``."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    # null vectors and null components are dropped as well
    kept = vectors.filter((F.size(x) == components) & F.coalesce(finite, F.lit(False)))
    too_large = F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}: its distances would not fit a long"))
    whole = F.transform(x, lambda c: F.when(F.abs(c * scale) <= LARGEST, F.floor(c * scale)).otherwise(too_large.cast("long")))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def first_centroids(points: DataFrame, clusters: int = CLUSTERS) -> list[list[int]]:
    """The vectors with the smallest SHA-256 of ``1:<id>``; rows with one id by their components, rows without an id after all others."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = points.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v").limit(clusters).collect()
    return [list(r.v) for r in rows]


def nearest(v: Column, centroids: list[list[int]]) -> Column:
    """``struct(distance, cluster)`` of the nearest centroid; ties go to the smaller number."""
    def total(x, start):
        return F.aggregate(x, F.lit(start).cast("long"), lambda done, c: done + c)

    def beyond(c):
        """The squared distance less that of ``v`` to the origin, which is the same for all centroids: one product per component."""
        squares = sum(x * x for x in c)
        twice = F.expr(f"array({', '.join(f'{-2 * x}L' for x in c)})")
        return total(F.zip_with(v, twice, lambda a, b: a * b), squares)

    least = F.array_min(F.array(*[F.struct(beyond(c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]))
    return F.struct((least["distance"] + total(F.transform(v, lambda a: a * a), 0)).alias("distance"), least["cluster"].alias("cluster"))


def updated(points: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Componentwise floor of the mean of each cluster; an empty cluster keeps its centroid."""
    width = len(centroids[0])
    near = points.select(nearest(F.col("v"), centroids)["cluster"].alias("cluster"), "v")
    sums = near.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"sum(v[{i}]) as s{i}") for i in range(width)])
    out = list(centroids)
    for row in sums.collect():
        out[row.cluster] = [row[f"s{i}"] // row.n for i in range(width)]
    return out


def clustered(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
    clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, list[list[int]]]:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of each kept vector, and the final centroids.

    Null vectors, vectors of another length and vectors with null or non-finite components are left out. Repeated rows count as often
    as they occur; rows without an id are clustered but start no centroid while others can. Fewer vectors than clusters give fewer
    centroids, none an empty result. Further columns are not read.
    """
    points = integer_vectors(vectors, id_col, vector_col, components, scale)
    centroids = first_centroids(points, clusters)
    if not centroids:
        empty = "cast(0 as int) as cluster, 0L as distance, 0L as cluster_inertia, 0L as inertia, '' as centroid_sha256"
        return points.limit(0).selectExpr("vec_id", *empty.split(", ")), []
    for _ in range(rounds):
        centroids = updated(points, centroids)
    placed = points.select("vec_id", nearest(F.col("v"), centroids).alias("near")).select("vec_id", "near.cluster", "near.distance")
    inertia = {r.cluster: r.inertia for r in placed.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    of_cluster = F.lit([inertia.get(i, 0) for i in range(len(centroids))]).cast("array<long>")
    hashes = F.lit([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids])
    return placed.select(
        "vec_id", "cluster", "distance", F.get(of_cluster, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), F.get(hashes, F.col("cluster")).alias("centroid_sha256"),
    ), centroids
