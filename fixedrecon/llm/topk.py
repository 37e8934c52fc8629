"""Exact top-k by inner product, over vectors sorted by length.

Vectors become integers: floor(64 * x) of each component. They are dealt into shards by descending length, and the
queries into blocks; both are measured in bytes. A group of the search is one block and one shard:

1. The longest vectors of all are scored first and give each query a score to beat. A query visits only the shards
   whose longest vector can reach it (length times length, by Cauchy-Schwarz).
2. In a group, candidates come in slices of descending length; a query is done once a slice is too short for it. For
   the others the vectors are turned by the SVD of a sample, which gathers most of their length in the leading
   components: the product of those plus the product of the lengths of the rest is an upper bound.
3. What the bound lets through is scored in integers, exactly. Each group returns its first k of each query, which
   raises the score to beat from slice to slice; a window over the groups' rows takes the first k of all.

The turn is fitted on at most ``SAMPLE`` vectors and moves no result, as the bounds have room for its rounding.

Vectors that are null or hold a null, NaN or infinite component take no part. Vectors of different sizes are compared
as if zeros followed. Components and scores beyond a long count as the nearest long. Rows are told apart as rows: a
repeated id is a candidate for its other rows, and several query rows of one id give results each. A null id is no
query where the condition is null; as a candidate it comes last among equal scores. No queries, no rows."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fixedrecon.llm.shared import stored

SCALE, K = 64, 20
SAMPLE, MOST_TURNED = 4096, 1024  # vectors of the fit; components up to which there is one
GROUP_BYTES = 32 << 20  # of vectors in a shard, and in a block of queries
LEAST_ROWS = 1024
SEEDS, SEED_BYTES = 2048, 16 << 20
SLICE = 1024
EXACT = float(1 << 53)  # whole numbers below are exact as doubles
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
RESULT = "query_row long, query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(row, vec_id, v, norm, is_query) of the vectors that take part."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE))
    rows = vectors.where(F.col(embedding).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query")
    )
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v", F.sqrt(square).alias("norm"), "is_query")


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A list column as rows of int64, with zeros behind shorter ones."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _largest(a: np.ndarray) -> float:
    return max(float(a.max(initial=0)), -float(a.min(initial=0)))


def _dot(a: np.ndarray, b: np.ndarray, pairs: bool = False) -> np.ndarray:
    """Inner products of all rows, or of the rows in pairs, as longs: in doubles where these are exact, else in Python's integers."""
    top = _largest(a) * _largest(b) * max(1, a.shape[1])
    if top < EXACT:
        x, y = a.astype(np.float64), b.astype(np.float64)
        return (np.einsum("ij,ij->i", x, y) if pairs else x @ y.T).astype(np.int64)
    x, y = a.astype(object), b.astype(object)
    found = (x * y).sum(axis=1) if pairs else x @ y.T
    return np.clip(found, LOWEST, HIGHEST).astype(np.int64)


def svd_turn(sample: np.ndarray) -> np.ndarray | None:
    """Orthogonal matrix whose leading columns take up most of the sample's length."""
    if not 0 < sample.shape[1] <= min(MOST_TURNED, len(sample)):
        return None
    return np.linalg.svd(sample.astype(np.float64), full_matrices=False)[2].T


class Bounds:
    """Leading components of vectors, and the length of the rest."""

    def __init__(self, vectors: np.ndarray, norm: np.ndarray, turn: np.ndarray | None):
        lead = max(1, vectors.shape[1] // 4)
        turned = vectors.astype(np.float64) @ turn[:, :lead] if turn is not None else vectors[:, :lead].astype(np.float64)
        self.lead = turned
        self.rest = np.sqrt(np.maximum(norm**2 - (turned**2).sum(axis=1), 0))

    def above(self, rows: np.ndarray, other: Bounds, cols: slice) -> np.ndarray:
        return self.lead[rows] @ other.lead[cols].T + np.outer(self.rest[rows], other.rest[cols])


class Best:
    """The first k candidates of each query so far: scores descending, then ids ascending."""

    def __init__(self, queries: int, k: int, beat: np.ndarray):
        self.k, self.beat = k, beat
        self.query = self.place = self.score = np.zeros(0, dtype=np.int64)
        self.queries = queries

    def add(self, query: np.ndarray, place: np.ndarray, score: np.ndarray, order_id: np.ndarray) -> None:
        query, place, score = (np.concatenate(x) for x in ((self.query, query), (self.place, place), (self.score, score)))
        order = np.lexsort((order_id[place], ~score, query))  # ~score falls as the score rises, without overflow
        query, place, score = query[order], place[order], score[order]
        first = np.searchsorted(query, np.arange(self.queries))
        nth = np.arange(len(query)) - first[query]
        last = nth == self.k - 1
        self.beat[query[last]] = np.maximum(self.beat[query[last]], score[last])
        kept = nth < self.k
        self.query, self.place, self.score = query[kept], place[kept], score[kept]


def _group(width: int, k: int, turn):
    def search(key: tuple, queries: pa.Table, shard: pa.Table) -> pa.Table:
        queries, shard = (x.sort_by([("norm", "descending"), ("row", "ascending")]) for x in (queries, shard))
        q, c = matrix(queries["v"], width), matrix(shard["v"], width)
        q_norm, c_norm = queries["norm"].to_numpy(), shard["norm"].to_numpy()
        c_row, q_row = shard["row"].to_numpy(), queries["row"].to_numpy()
        ids = shard["vec_id"].combine_chunks()
        order_id = ids.fill_null(HIGHEST).to_numpy()
        to_beat = queries["beat"].to_numpy().copy()
        q_bounds, c_bounds = Bounds(q, q_norm, turn.value), Bounds(c, c_norm, turn.value)
        out = []
        for a in range(0, len(q), SLICE):
            block = np.arange(a, min(a + SLICE, len(q)))
            best = Best(len(block), k, to_beat[block])
            for b in range(0, len(c), SLICE):
                part = slice(b, min(b + SLICE, len(c)))
                reach = q_norm[block] * c_norm[b]
                live = np.flatnonzero(reach * (1 + 1e-9) + 1 >= best.beat)
                if not len(live):
                    break  # all further candidates are shorter
                above = q_bounds.above(block[live], c_bounds, part) + (reach[live] * 1e-9 + 1)[:, None]
                beat = best.beat[live][:, None]
                at, col = np.nonzero((above >= beat) | (beat == LOWEST))
                if 4 * len(at) > above.size:
                    score = _dot(q[block[live]], c[part])[at, col]
                else:
                    score = _dot(q[block[live[at]]], c[b + col], pairs=True)
                at, col = live[at], b + col
                kept = (score >= best.beat[at]) & (q_row[block[at]] != c_row[col])
                best.add(at[kept], col[kept], score[kept], order_id)
            found = pa.array(block[best.query])
            out.append(pa.table({"query_row": queries["row"].take(found), "query_id": queries["vec_id"].take(found), "vec_id": ids.take(pa.array(best.place)), "score": pa.array(best.score)}))
        return pa.concat_tables(out) if out else pa.table({n: pa.array([], pa.int64()) for n in ("query_row", "query_id", "vec_id", "score")})

    return search


def _seeded(width: int, k: int, seeds, longest: np.ndarray):
    """Queries with the score to beat and the number of shards they have to visit."""

    def start(batches):
        rows, vectors = seeds.value
        for batch in batches:
            norm = batch.column("norm").to_numpy()
            beat = np.full(batch.num_rows, LOWEST)
            if len(rows) > k:  # the query itself may be among them
                score = _dot(matrix(batch.column("v"), width), vectors)
                score[batch.column("row").to_numpy()[:, None] == rows] = LOWEST
                beat = np.partition(score, len(rows) - k, axis=1)[:, len(rows) - k]
            need = (np.outer(norm, longest) * (1 + 1e-9) + 1 >= beat[:, None]).sum(axis=1)
            columns = [batch.column(n) for n in ("row", "vec_id", "v", "norm", "block")]
            yield pa.record_batch([*columns, pa.array(beat), pa.array(need)], ["row", "vec_id", "v", "norm", "block", "beat", "need"])

    return start


def search(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the first ``k`` other rows of each row with ``is_query``, by score, then id."""
    spark = vectors.sparkSession
    rows = stored(integer_vectors(vectors, is_query, vec_id, embedding), "topk-vectors")
    measures = [F.count("*"), F.count_if("is_query"), F.coalesce(F.max(F.size("v")), F.lit(0))]
    count, n_queries, width = rows.agg(*measures).first()
    fitting = max(LEAST_ROWS, GROUP_BYTES // (8 * max(width, 1)))
    per_shard = min(fitting, max(LEAST_ROWS, count // (4 * spark.sparkContext.defaultParallelism)))
    sharded = rows.repartitionByRange(max(1, -(-count // per_shard)), F.desc("norm"), F.xxhash64("row"))
    sharded = stored(sharded.withColumn("shard", F.spark_partition_id()), "topk-shards")

    shards = sharded.groupBy("shard").agg(F.max("norm")).orderBy("shard").collect()
    sample = rows.orderBy(F.xxhash64("row")).limit(min(SAMPLE, max(1, SEED_BYTES // (8 * max(width, 1))))).select("v").toArrow()
    turn = spark.sparkContext.broadcast(svd_turn(matrix(sample["v"], width)))
    seeds = sharded.orderBy(F.desc("norm"), "row").limit(min(SEEDS, max(1, SEED_BYTES // (8 * max(width, 1))))).select("row", "v").toArrow()
    seeds = spark.sparkContext.broadcast((seeds["row"].to_numpy(), matrix(seeds["v"], width)))

    blocks = max(1, -(-n_queries // fitting))
    queries = rows.where("is_query").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    kind = "row long, vec_id long, v array<bigint>, norm double, block long, beat long, need long"
    queries = queries.select("row", "vec_id", "v", "norm", "block").mapInArrow(_seeded(width, k, seeds, np.array([longest for _, longest in shards])), kind)
    queries = stored(queries, "topk-queries")
    numbers = F.array(*[F.lit(n) for n, _ in shards]).cast("array<int>")
    visits = queries.withColumn("shard", F.explode(F.slice(numbers, F.lit(1), F.col("need").cast("int"))))
    wanted = visits.select(F.col("block").alias("to_block"), F.col("shard").alias("to_shard")).distinct()
    candidates = sharded.join(wanted, F.col("shard") == F.col("to_shard")).select("row", "vec_id", "v", "norm", "to_block", "to_shard")
    groups = visits.drop("need").groupBy("block", "shard").cogroup(candidates.groupBy("to_block", "to_shard"))
    found = groups.applyInArrow(_group(width, k, turn), RESULT)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
