"""Operator 12, centroid clustering in expressions of the JVM.

Components become integers ``floor(1024 * x)``, so all sums and distances are exact and
the result does not hang on the order of rows or on how they are cut up. Centroids are
literal arrays: ``zip_with`` and ``aggregate`` give a vector's squared distance to each,
``array_min`` of (distance, number) structs chooses the nearest, and each round is one
aggregate of a sum per component, grouped by the chosen number. Sums combine on the map
side, so a round shuffles one row per task and centroid, however many vectors one
centroid draws, and the driver gets the new centroids only: ``k`` rows. The integer
vectors are written once and read by each round; a lost executor costs a reread.

Defined results: vectors that are null, of another dimension, or hold null or non-finite
components are left out; components beyond +-2**27 count as that bound, so that
distances fit a long, and a sum of distances that does not fit one is null; repeated rows
are vectors of their own; a null ``vec_id`` is hashed as an empty text; vectors tied in
the hash of their ids start in the order of their components; with fewer than ``k``
vectors each is a centroid; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.plans.staging import stage

DIMENSION = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
SEED = "3:"
_MOST = 1 << 27
COLUMNS = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
    "centroid_sha256 string"
)


def integer_vectors(
    vectors: DataFrame, dimension: int = DIMENSION, scale: int = SCALE
) -> DataFrame:
    """(vec_id, parts): whole vectors of that dimension in integers."""
    found = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("parts"),
    )

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    # A cut at the bound, before what is beyond a long would be cast.
    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x * scale, F.lit(float(_MOST))), F.lit(-float(_MOST))))

    kept = found.where((F.size("parts") == dimension) & F.forall("parts", finite))
    return kept.select("vec_id", F.transform("parts", whole).alias("parts"))


def first_centroids(
    vectors: DataFrame, count: int = CENTROIDS, seed: str = SEED
) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes."""
    told = F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    drawn = vectors.select(F.sha2(told, 256).alias("drawn"), "parts")
    return [row.parts for row in drawn.orderBy("drawn", "parts").limit(count).collect()]


def nearest(centroids: list[list[int]]) -> Column:
    """struct(distance, cluster) of the centroid nearest to ``parts``."""

    def distance(centroid: list[int]) -> Column:
        literal = F.lit(centroid).cast("array<long>")
        squares = F.zip_with("parts", literal, lambda x, y: (x - y) * (x - y))
        return F.aggregate(squares, F.lit(0).cast("long"), lambda total, x: total + x)

    return F.array_min(
        F.array(
            *[
                F.struct(distance(c).alias("distance"), F.lit(n).alias("cluster"))
                for n, c in enumerate(centroids)
            ]
        )
    )


def moved_centroids(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: floors of the means, or as they were where empty."""
    parts = range(len(centroids[0]))
    chosen = vectors.select(nearest(centroids)["cluster"].alias("cluster"), "parts")
    sums = [F.sum(F.get("parts", F.lit(i))).alias(f"s{i}") for i in parts]
    totals = chosen.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs"), *sums)
    # Division of whole numbers cuts towards zero; without the rest it is exact.
    means = [F.expr(f"(s{i} - pmod(s{i}, docs)) div docs") for i in parts]
    moved = list(centroids)
    for cluster, *mean in totals.select("cluster", *means).collect():
        moved[cluster] = mean
    return moved


def fit(
    vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED
) -> list[list[int]]:
    """Centroids of integer vectors after so many rounds."""
    centroids = first_centroids(vectors, count, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved_centroids(vectors, centroids)
    return centroids


def clustered(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster, distance of each vector, with the sums of its cluster and of all."""
    if not centroids:
        return vectors.sparkSession.createDataFrame([], COLUMNS)
    chosen = vectors.select("vec_id", nearest(centroids).alias("near"))
    chosen = chosen.select("vec_id", "near.cluster", "near.distance")
    sums = chosen.groupBy("cluster").agg(F.try_sum("distance").alias("inertia")).collect()
    inertia = {row.cluster: row.inertia for row in sums}  # k rows at most
    whole = None if None in inertia.values() else sum(inertia.values())
    whole = None if whole is None or whole >= 1 << 63 else whole
    digests = [
        hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
        for centroid in centroids
    ]

    def of_cluster(values: list, kind: str) -> Column:
        listed = F.array(*[F.lit(v).cast(kind) for v in values])
        return F.get(listed, F.col("cluster"))

    own = [inertia.get(n) for n in range(len(centroids))]
    return chosen.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster(own, "long").alias("cluster_inertia"),
        F.lit(whole).cast("long").alias("inertia"),
        of_cluster(digests, "string").alias("centroid_sha256"),
    )


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all vectors of 64 components."""
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = stage(integer_vectors(embeddings), "centroid-vectors")
    return clustered(vectors, fit(vectors))


def _sql(count: int = CENTROIDS, rounds: int = ROUNDS, size: int = DIMENSION) -> str:
    """The same in SQL, with two tables for each round."""
    off = "(v.parts[i] - c.parts[i])"
    apart = f"list_sum([{off} * {off} FOR i IN range(1, {size + 1})])::BIGINT"
    tables = [
        f"""vectors AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS n,
    [floor(greatest(least(x::DOUBLE * {SCALE}, {_MOST}), -{_MOST}))::BIGINT FOR x IN embedding] AS parts
  FROM embeddings
  WHERE len(embedding) = {size}
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {size}
), centroids0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY drawn, parts) - 1 AS cluster, parts FROM (
    SELECT sha256(concat('{SEED}', vec_id)) AS drawn, parts
    FROM vectors ORDER BY drawn, parts LIMIT {count})
)"""
    ]
    for r in range(rounds + 1):
        near = f"""near{r} AS MATERIALIZED (
  SELECT n, any_value(vec_id) AS vec_id, any_value(parts) AS parts,
    min({{'distance': distance, 'cluster': cluster}}) AS best
  FROM (SELECT v.*, c.cluster, {apart} AS distance FROM vectors v CROSS JOIN centroids{r} c)
  GROUP BY n
)"""
        moved = f"""centroids{r + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.parts, c.parts) AS parts
  FROM centroids{r} c LEFT JOIN (
    SELECT cluster, list(((s - ((s % docs) + docs) % docs) // docs)::BIGINT ORDER BY i) AS parts
    FROM (
      SELECT cluster, i, sum(x) AS s, count(*) AS docs
      FROM (SELECT best.cluster AS cluster, unnest(parts) AS x, unnest(range({size})) AS i FROM near{r})
      GROUP BY cluster, i)
    GROUP BY cluster) m USING (cluster)
)"""
        tables += [near] + [moved] * (r < rounds)
    return f"""WITH {", ".join(tables)}
SELECT vec_id, cluster::INT AS cluster, best.distance AS distance,
  sum(best.distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
  sum(best.distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c.parts, ',')) AS centroid_sha256
FROM near{rounds} n JOIN centroids{rounds} c ON c.cluster = n.best.cluster
"""


OP12_SQL = _sql()
