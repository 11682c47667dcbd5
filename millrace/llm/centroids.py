"""Centroid clustering (k-means on integers): float32 screening with rounding-error intervals, exact integers where they overlap.

1. `integers` keeps vectors of the right length without null or non-finite components, and turns x into floor(scale * x).
   They are written once; every round reads them.
2. A round sends the centroids to the tasks (k vectors, a parameter). For a block of vectors v, one float32 matrix product
   gives all v.c; |c|^2 - 2 v.c orders centroids as the squared distance does.
3. Rounding of a product of n terms, summed in any order, is at most g |v| |c| with g = (n + 2) u / (1 - (n + 2) u), u = 2^-24,
   conversion to float32 included. So each centroid has an interval that holds its true value. Centroids whose
   interval begins above the least upper end are out. Where more than one is left, their squared distances are computed
   in 64-bit integers, and the smallest wins, the lowest number among equal ones.
4. Tasks add up their vectors by cluster in integers, a row per cluster and task; the JVM sums these, and floor(sum / count)
   of k rows is taken in exact integers.
"""
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import stash

LARGEST = 1 << 27  # of a component: beyond it squared distances would not fit 64 bits
CELLS = 1 << 20  # of a block's matrix product


def integers(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """vec_id and v (array of `size` integers) of the vectors that are kept."""
    found = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    # a NaN and an infinity are not below infinity in size
    found = found.where((F.size("x") == size) & F.forall("x", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))))
    small = F.forall("x", lambda x: F.abs(x) < F.lit(float(LARGEST // scale)))
    checked = F.when(small, F.col("x")).otherwise(F.raise_error(F.lit(f"a component of {LARGEST // scale} or more: squared distances would not fit 64 bits")))
    return found.select("vec_id", F.transform(checked, lambda x: F.floor(x * scale).cast("int")).alias("v"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of `seed:vec_id`; fewer if there are fewer."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.where("vec_id is not null").select(code.alias("code"), "v").orderBy("code", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def screened(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(vector, centroid): True where the interval of |c|^2 - 2 v.c doesn't begin above the least upper end.

    The true value of every pair lies in its interval, so the nearest centroid is never left out.
    """
    n = v.shape[1]
    dot = (v.astype(np.float32) @ c.astype(np.float32).T).astype(np.float64)
    norms, squares = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1)), (c * c).sum(axis=1).astype(np.float64)
    g = (n + 2) * 2.0**-24 / (1 - (n + 2) * 2.0**-24)
    middle = squares - 2 * dot
    # the second term covers the rounding of 64-bit floats here, which is far smaller
    reach = 2 * g * norms[:, None] * np.sqrt(squares) * (1 + 2.0**-30) + (squares + 2 * np.abs(dot) + 1) * 2.0**-48
    return middle - reach <= (middle + reach).min(axis=1, keepdims=True)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = v - c
    return np.einsum("ij,ij->i", d, d)


def nearest(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid (64-bit integers, one a row) of each vector; the lowest among equal ones."""
    out = np.empty(len(v), np.int64)
    for at in range(0, len(v), step := max(1, CELLS // max(len(c), v.shape[1]))):
        part = v[at : at + step]
        left = screened(part, c)
        best, few = left.argmax(axis=1), np.flatnonzero(left.sum(axis=1) > 1)
        carried = (-1, 0, 0)
        row, number = np.nonzero(left[few])
        for lo in range(0, len(row), step):  # pairs in order of vector and number
            r, k = few[row[lo : lo + step]], number[lo : lo + step]
            d = squared(part[r], c[k])
            begins = np.flatnonzero(np.diff(r, prepend=-1))
            least = np.minimum.reduceat(d, begins)
            hit = np.flatnonzero(d == np.repeat(least, np.diff(np.append(begins, len(r)))))
            r, k, d = r[hit], k[hit], d[hit]
            _, first = np.unique(r, return_index=True)
            r, k, d = r[first], k[first], d[first]
            if r[0] == carried[0] and carried[2] <= d[0]:  # a vector's pairs may go on in the next part
                k[0], d[0] = carried[1:]
            best[r] = k
            carried = (r[-1], k[-1], d[-1])
        out[at : at + len(part)] = best
    return out


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def moved(kept: DataFrame, c: np.ndarray) -> np.ndarray:
    """Centroids after a round: floor of the mean of their vectors, those without vectors as they were."""
    k, size = c.shape

    def run(batches):
        n, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            v = _vectors(batch.column(0), size)
            own = nearest(v, c)
            order = np.argsort(own, kind="stable")
            own = own[order]
            begins = np.flatnonzero(np.diff(own, prepend=-1))
            if len(own):
                sums[own[begins]] += np.add.reduceat(v[order], begins, axis=0)
                n += np.bincount(own, minlength=k)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = kept.select("v").mapInArrow(run, "cluster long, n long, sums array<long>")
    added = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)]
    out = c.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *added).collect():
        out[r.cluster] = [int(r[f"s{i}"]) // r.n for i in range(size)]
    return out


def assigned(kept: DataFrame, c: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance of each vector."""
    size = c.shape[1]

    def run(batches):
        for batch in batches:
            v = _vectors(batch.column(1), size)
            own = nearest(v, c)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.astype(np.int32)), pa.array(squared(v, c[own]))], names=["vec_id", "cluster", "distance"])

    return kept.select("vec_id", "v").mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024, size: int = 64) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and centroid of every vector that is kept.

    Left out are null vectors, those of another length than `size`, and those with a null, NaN or infinite component. A
    component so large that squared distances would not fit 64 bits is an error. Ties: an equal distance goes to the lowest
    number; equal hashes of first centroids (rows that repeat a vec_id) go in the order of components. Repeated rows
    count as vectors each. A vector without a vec_id is clustered, but is no first centroid; if there is none, or the
    table is empty, the result is empty. With fewer than k vectors there are fewer centroids. Columns other than vec_id and
    embedding, whatever their names, are not looked at.
    """
    kept = stash(integers(vectors, size, scale), "vectors")
    c = first_centroids(kept, k, seed)
    spark = vectors.sparkSession
    if not len(c):
        c = np.zeros((1, size), np.int64)
        kept = kept.limit(0)
    for _ in range(rounds):
        c = moved(kept, c)
    found = stash(assigned(kept, c), "clusters")
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    texts = [",".join(map(str, row)) for row in c.tolist()]
    made = [(i, sums.get(i, 0), sum(sums.values()), hashlib.sha256(t.encode()).hexdigest(), row) for i, (t, row) in enumerate(zip(texts, c.tolist(), strict=True))]
    of = spark.createDataFrame(made, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>")
    return found.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")


def sql(k: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024, size: int = 64) -> str:
    """The same in DuckDB SQL, a round after another, for distinct vec_ids."""
    steps = [
        f"""e AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""",
        f"x AS MATERIALIZED (SELECT vec_id, unnest(range({size})) AS i, unnest(v) AS x FROM e)",
        f"s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM e QUALIFY c < {k})",
        "c0 AS MATERIALIZED (SELECT c, i, x AS m FROM s JOIN x USING (vec_id))",
    ]
    for n in range(rounds + 1):
        steps.append(f"d{n} AS (SELECT vec_id, c, sum((x - m) * (x - m))::BIGINT AS d FROM x JOIN c{n} USING (i) GROUP BY vec_id, c)")
        steps.append(f"a{n} AS MATERIALIZED (SELECT vec_id, min(c) AS c, min(d) AS d FROM (SELECT *, min(d) OVER (PARTITION BY vec_id) AS least FROM d{n}) WHERE d = least GROUP BY vec_id)")
        if n < rounds:
            steps.append(f"m{n} AS (SELECT c, i, sum(x)::BIGINT AS t, count(*) AS n FROM a{n} JOIN x USING (vec_id) GROUP BY c, i)")
            steps.append(f"c{n + 1} AS MATERIALIZED (SELECT c, i, coalesce((t - ((t % n) + n) % n) // n, m) AS m FROM c{n} LEFT JOIN m{n} USING (c, i))")
    steps.append(f"h AS (SELECT c, sha256(string_agg(m::VARCHAR, ',' ORDER BY i)) AS centroid_sha256, list(m ORDER BY i) AS centroid FROM c{rounds} GROUP BY c)")
    return f"""WITH {', '.join(steps)}
        SELECT vec_id, c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
        FROM a{rounds} JOIN h USING (c)"""
