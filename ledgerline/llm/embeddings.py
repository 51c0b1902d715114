"""Near-duplicate vectors by Euclidean p-stable hashing with exact cosine checks.

Vectors are normalised; a table's key is a tuple of ``PROJECTIONS`` Gaussian
projections, shifted and quantised to cells of ``WIDTH``.  Vectors that share a
key in one of ``TABLES`` tables are compared by cosine in double precision.  A
pair is counted in the first table in which it meets, so link counts are exact
for the pairs found.

For unit vectors of cosine c the distance is sqrt(2 - 2c); at cosine 0.9 a
projection agrees with probability 0.857, a table with 0.085 and one of 32
tables with 0.94; at 0.95 that is 0.998.  Unrelated vectors share a table's key
with probability 1e-4; for far more than 1e6 vectors raise ``projections`` and
``tables`` together (16 more projections for a factor of 10,000).

Equal vectors collapse to a class with its count before hashing.  A bucket of
any size is dealt over blocks; each pair of blocks is one matrix product in a
task, so nothing is capped and no pair is emitted: a task returns link counts
and one edge per vector.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components have no links and are their own component; a null vec_id links with
nothing, its component is null and it is kept; repeated rows of an id are
vectors of their own in counts; vectors of different lengths never meet; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import same_key, shuffle_partitions, stage
from .components import connected_components
from .runs import complete_runs, smallest_linked

MIN_COSINE = 0.9
TABLES, PROJECTIONS, WIDTH, SEED = 32, 16, 2.5, 7
#: Vectors in a block; two blocks are multiplied at once.
BLOCK = 512
#: Runs of up to this many vectors are compared all together, longer ones by a matrix product each.
SHORT = 24


def _valid(v: np.ndarray) -> bool:
    return v.size > 0 and bool(np.isfinite(v).all()) and bool(v.any())


def identified(vectors: DataFrame) -> DataFrame:
    """(vec_id, digest, vector): the digest of a vector's doubles, null where it cannot be compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests = []
            for x in b.column(1):
                v = np.array([np.nan if c is None else c for c in x.as_py() or ()], np.float64) + 0.0  # no negative zero
                digests.append(hashlib.blake2b(v.tobytes(), digest_size=16).digest() if _valid(v) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.binary()), b.column(1)],
                                             names=["vec_id", "digest", "vector"])
    kind = vectors.schema["embedding"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id long, digest binary, vector {kind}")


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def hashed(classes: DataFrame, tables: int, projections: int, width: float) -> DataFrame:
    """(id, copies, vector, keys): a 32-bit key of each table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, tuple] = {}
        for b in batches:
            rows = b.column(2).to_pylist()
            keys = np.zeros((len(rows), tables), np.int32)
            lengths = np.array([len(r) for r in rows])
            for dim in np.unique(lengths):
                if dim not in planes:
                    r = np.random.default_rng([SEED, int(dim)])
                    planes[dim] = (r.standard_normal((dim, tables * projections)), r.uniform(0, width, tables * projections),
                                   r.integers(1, 2 ** 62, (tables, projections)) | 1)
                a, shift, mixer = planes[dim]
                at = np.flatnonzero(lengths == dim)
                cells = np.floor((_unit([rows[i] for i in at]) @ a + shift) / width).astype(np.int64)
                h = (cells.reshape(len(at), tables, projections) * mixer).sum(2) + int(dim)
                keys[at] = (h >> 31).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2),
                                              pa.array(list(keys), pa.list_(pa.int32()))], names=["id", "copies", "vector", "keys"])
    kind = classes.schema["vector"].dataType.simpleString()
    return classes.select("id", "copies", "vector").mapInArrow(
        run, f"id long, copies long, vector {kind}, keys array<int>")


def _dealt(lsh: DataFrame) -> DataFrame:
    """(t, key, i, j, own, id): each class in the pairs of blocks of its buckets; buckets of one are left out."""
    slim = lsh.select("id", F.posexplode("keys").alias("t", "key"))
    size = (slim.groupBy(F.col("t").alias("_t"), F.col("key").alias("_k")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    e = slim.join(size, (F.col("t") == F.col("_t")) & same_key(F.col("key"), F.col("_k")))
    blocks = F.ceil(F.col("n") / BLOCK)
    e = e.withColumn("own", F.pmod(F.xxhash64("id"), blocks)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return e.select(F.col("t").cast("long"), F.col("key").cast("long"), F.least("own", "other").alias("i"),
                    F.greatest("own", "other").alias("j"), "own", "id")


def _short_pairs(rows: np.ndarray, keys: np.ndarray, cols: dict, bounds: np.ndarray,
                 min_cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """New links (row, later row) of all runs of at most ``SHORT`` rows, by distance within the run."""
    sizes = np.diff(bounds)
    end = np.repeat(np.where(sizes <= SHORT, bounds[1:], 0), sizes)
    x = rows.astype(np.float64)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    for step in range(1, SHORT):
        a = np.flatnonzero(np.arange(len(end)) + step < end)
        if not len(a):
            return
        a = a[np.einsum("ij,ij->i", x[a], x[a + step]) >= min_cosine]
        b = a + step
        between = cols["i"][a] != cols["j"][a]
        keep = ~between | (cols["own"][a] != cols["own"][b])
        earlier = np.arange(keys.shape[1]) < cols["t"][a][:, None]
        keep &= ~((keys[a] == keys[b]) & earlier).any(1)
        yield a[keep], b[keep]


def _compared(entries: DataFrame, min_cosine: float) -> DataFrame:
    """(id, links, low): links counted here and the smallest id reached, per class and run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, bounds in complete_runs(batches, 4):
            cols = {c: t.column(c).to_numpy() for c in ("t", "i", "j", "own", "id", "copies")}
            vectors = t.column("vector").combine_chunks()
            keys = t.column("keys").combine_chunks()
            flat_keys = keys.flatten().to_numpy().reshape(t.num_rows, -1)
            flat, at = vectors.flatten().to_numpy(zero_copy_only=False), vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
            out: dict[str, list] = {"id": [], "links": [], "low": []}
            sizes = np.diff(bounds)
            if (np.diff(at) == at[1] - at[0]).all():  # one length: the many short runs are compared together
                for a, b in _short_pairs(flat.reshape(t.num_rows, -1), flat_keys, cols, bounds, min_cosine):
                    ids, copies = cols["id"], cols["copies"]
                    out["id"] += [ids[a], ids[b]]
                    out["links"] += [copies[b], copies[a]]
                    out["low"] += [np.minimum(ids[a], ids[b])] * 2
                done = sizes <= SHORT
            else:
                done = np.zeros(len(sizes), bool)
            for s, e in zip(bounds[:-1][~done], bounds[1:][~done]):
                if e - s < 2:
                    continue
                dims = np.diff(at[s:e + 1])
                if (dims != dims[0]).any():  # keys of different lengths that happen to agree
                    groups = [s + np.flatnonzero(dims == d) for d in np.unique(dims)]
                else:
                    groups = [np.arange(s, e)]
                for g in groups:
                    x = np.stack([flat[at[i]:at[i + 1]] for i in g]).astype(np.float64)
                    x /= np.sqrt((x * x).sum(1, keepdims=True))
                    near = x @ x.T >= min_cosine
                    np.fill_diagonal(near, False)
                    if not near.any():
                        continue
                    if cols["i"][s] != cols["j"][s]:
                        near &= cols["own"][g][:, None] != cols["own"][g][None, :]
                    k, table = flat_keys[g], cols["t"][s]
                    if near.sum() > 8 * len(g):  # dense: a comparison of all rows per earlier table
                        for t_ in range(table):
                            near &= k[:, t_, None] != k[None, :, t_]
                    else:
                        a, b = np.nonzero(near)
                        met = (k[a, :table] == k[b, :table]).any(1)
                        near[a[met], b[met]] = False
                    a, b = np.nonzero(near)
                    if not len(a):
                        continue
                    ids = cols["id"][g]
                    links = np.zeros(len(g), np.int64)
                    np.add.at(links, a, cols["copies"][g][b])
                    has = links > 0
                    out["id"].append(ids[has])
                    out["links"].append(links[has])
                    out["low"].append(smallest_linked(near, ids)[has])
            if out["id"]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in out.values()], names=list(out))
    keys = ["t", "key", "i", "j"]
    dealt = entries.repartition(shuffle_partitions(entries.sparkSession), *keys).sortWithinPartitions(*keys, "id")
    return dealt.mapInArrow(run, "id long, links long, low long")


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, tables: int = TABLES,
                    projections: int = PROJECTIONS, width: float = WIDTH) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept)."""
    rows = stage(identified(vectors), "vectors")
    classes = rows.where("digest IS NOT NULL AND vec_id IS NOT NULL").groupBy("digest").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    # Two vectors may carry one id: classes are told apart by a number of their own, given when they are written.
    classes = stage(classes.withColumn("vec", F.col("id")).withColumn("id", F.monotonically_increasing_id()), "classes")
    lsh = stage(hashed(classes, tables, projections, width), "lsh")
    slim = _dealt(lsh)
    heavy = lsh.select(F.col("id").alias("_id"), "copies", "vector", "keys")
    entries = slim.join(heavy, F.col("id") == F.col("_id")).select("t", "key", "i", "j", "own", "id", "copies", "vector", "keys")
    found = stage(_compared(entries, min_cosine), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    reached = connected_components(found.where("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b")), "vectors")
    named = (classes.select("id", "digest", "copies", "vec").join(links, "id", "left").join(reached, "id", "left")
             .withColumn("component", F.coalesce("component", "id")))
    smallest = named.groupBy(F.col("component").alias("_component")).agg(F.min("vec").alias("component_id"))
    label = stage(named.join(smallest, F.col("component") == F.col("_component"))
                  .select(F.col("digest").alias("_d"), (F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1)
                          .alias("n_links"), "component_id"), "labels")
    own, some = F.col("vec_id"), F.col("vec_id").isNotNull()
    return (rows.select("vec_id", "digest").join(label, (F.col("digest") == F.col("_d")) & some, "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("component_id", own).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT vec_id AS u, vec_id AS v FROM embeddings
  UNION
  SELECT reach.u, links.b FROM reach JOIN links ON reach.v = links.a),
component AS (SELECT u, min(v) AS c FROM reach GROUP BY u),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, c AS component_id, e.vec_id = c AS kept
FROM embeddings e LEFT JOIN degree ON a = e.vec_id JOIN component ON u = e.vec_id
"""
