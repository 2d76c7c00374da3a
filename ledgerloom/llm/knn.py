"""Exact top-k search by a Voronoi kNN join.

Vectors become whole numbers, floor(256 * x). Pivots are directions, more of them for larger tables; queries and data are
grouped by the nearest one. A query scaled to length 1 that lies within r of its pivot p scores between p.x - r|x| and
p.x + r|x| with a vector x (triangle inequality). From the summaries of the groups (radius of a query group, the k + 1
vectors of each data group that lie farthest along its pivot) follows a score that every query of a group reaches k
times; only vectors that can score as much are sent to that group. Query groups that lie near each other share blocks,
which are solved against pieces of bounded size, whose lists of k are merged.

The share of the data that is sent depends on the data: clustered vectors are sent to few blocks, while of vectors
without any structure (random directions) all are needed everywhere, and what remains is a join of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, staged, table, trimmed

K = 5
#: Pivots of the vectors of one length (drawn by a hash of the id): the square root of their number within these bounds.
LEAST_PIVOTS, MOST_PIVOTS = 16, 256
#: Numbers of all pivots and summaries together, which the driver holds; very long or unlike vectors have fewer pivots.
PIVOT_NUMBERS = 1 << 22
#: Queries and data vectors that one task compares, and scores that it holds at once.
QUERY_BLOCK, DATA_BLOCK, SCORES = 4096, 32_768, 1 << 22
#: Bounds are compared with this slack relative to the longest vector, far above rounding errors.
SLACK = 1e-9


def _packed(v: np.ndarray) -> bytes:
    """Whole numbers as 32-bit floats where these are exact, else as 64-bit ones."""
    return v.astype("<f4" if np.abs(v).max(initial=0) <= 1 << 24 else "<f8").tobytes()


def whole(vectors: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """(id, dim, v) of the rows whose vector is neither null nor empty nor holds null, NaN or infinite components."""
    v = F.col(vector).cast("array<double>")
    fine = v.isNotNull() & F.col(vec_id).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(fine).select(F.col(vec_id).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * 256).cast("double")).alias("v"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [np.asarray(x, np.float64) for x in batch["v"]]
            yield pd.DataFrame({"id": batch["id"], "dim": [len(x) for x in own], "squared": [float(x @ x) for x in own], "v": [_packed(x) for x in own]})

    return rows.mapInPandas(trimmed(pack), "id long, dim int, squared double, v binary")


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.stack([np.frombuffer(x, "<f4" if len(x) == 4 * dim else "<f8") for x in column]).astype(np.float64) if len(column) else np.empty((0, dim))


def _units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; rows of zeros stay."""
    return x / np.maximum(np.sqrt((x * x).sum(axis=1)), 1e-300)[:, None]


def _grouped(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """rows plus the pivot of the nearest direction (cell), how far the vector lies along it, and the distance of its direction."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                x = _matrix(part["v"], dim)
                along = x @ pivots[dim].T
                cell = along.argmax(axis=1)
                d = np.sqrt(((_units(x) - pivots[dim][cell]) ** 2).sum(axis=1))
                yield part.assign(cell=cell.astype(np.int32), along=along[np.arange(len(x)), cell], d=d)

    return rows.mapInPandas(trimmed(run), "id long, dim int, squared double, v binary, cell int, along double, d double")


def _pivots(rows: DataFrame, facts: dict[int, tuple[float, int]], k: int) -> dict[int, np.ndarray]:
    """Directions of vectors of each length, drawn in the order of a hash: about the square root of their number."""
    room = max(1, PIVOT_NUMBERS // max(1, (k + 2) * sum(facts)))
    wanted = {dim: min(room, max(LEAST_PIVOTS, min(MOST_PIVOTS, int(n**0.5)))) for dim, (_, n) in facts.items()}
    draw = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("id"), "id"))
    chosen: dict[int, list[bytes]] = {}
    for r in rows.withColumn("n", draw).filter(F.col("n") <= max(wanted.values())).select("dim", "v", "n").collect():
        if r["n"] <= wanted[r["dim"]]:
            chosen.setdefault(r["dim"], []).append(bytes(r["v"]))
    return {dim: _units(_matrix(pd.Series(v), dim)) for dim, v in chosen.items()}


def _chain(pivots: np.ndarray, cells: list[int]) -> list[int]:
    """cells in an order in which each is followed by the nearest one that is left."""
    out, left = cells[:1], cells[1:]
    while left:
        near = int(((pivots[left] - pivots[out[-1]]) ** 2).sum(axis=1).argmin())
        out.append(left.pop(near))
    return out


def _plan(data: DataFrame, queries: DataFrame, pivots: dict[int, np.ndarray], k: int) -> list[tuple]:
    """(dim, cell, block, cuts, radius, score) of the query groups: every query, scaled to length 1, reaches score k times.

    Summaries only: a row for each query group, and k + 1 vectors of each data group.
    """
    groups: dict[int, dict[int, tuple[float, int]]] = {}
    for r in queries.groupBy("dim", "cell").agg(F.max("d").alias("radius"), F.count(F.lit(1)).alias("n")).collect():
        groups.setdefault(r["dim"], {})[r["cell"]] = (r["radius"], r["n"])
    far = F.row_number().over(Window.partitionBy("dim", "cell").orderBy(F.desc("along"), "id"))
    summary: dict[int, list[bytes]] = {}
    for r in data.select("dim", "v", far.alias("n"), "cell").filter(F.col("n") <= k + 1).collect():
        summary.setdefault(r["dim"], []).append(bytes(r["v"]))
    placed, block = [], 0
    for dim in sorted(groups):
        own = _matrix(pd.Series(summary[dim]), dim)
        norm = np.sqrt((own * own).sum(axis=1))
        filled = 0
        for q in _chain(pivots[dim], sorted(groups[dim])):
            radius, n = groups[dim][q]
            cuts = max(1, -(-n // QUERY_BLOCK))
            if filled and (filled + n > QUERY_BLOCK or cuts > 1):
                block, filled = block + 1, 0
            least = np.sort(own @ pivots[dim][q] - radius * norm)
            # one of the k + 1 may be the query's own row
            placed.append((dim, q, block, cuts, float(radius), float(least[-k - 1]) if len(least) > k else -np.inf))
            filled += n
            if cuts > 1:
                block, filled = block + cuts, 0
        block += 1
    return placed


def _sent(data: DataFrame, placed: list[tuple], pivots: dict[int, np.ndarray], pieces: int) -> DataFrame:
    """(block, piece, dim, id, v): the data vectors that some query of each block may need, in pieces."""
    own = {dim: [x for x in placed if x[0] == dim] for dim in {x[0] for x in placed}}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                if dim not in own:
                    continue
                _, cells, blocks, cuts, radius, score = map(np.array, zip(*own[dim]))
                x, norm = _matrix(part["v"], dim), np.sqrt(part["squared"].to_numpy())[:, None]
                needed = x @ pivots[dim][cells].T + norm * (radius + SLACK)[None, :] >= score[None, :] - SLACK * np.abs(np.where(np.isfinite(score), score, 0.0))[None, :]
                for block in np.unique(blocks):
                    rows = np.flatnonzero(needed[:, blocks == block].any(axis=1))
                    for cut in range(int(cuts[blocks == block].max())):
                        yield part.iloc[rows][["dim", "id", "v"]].assign(block=int(block) + cut)

    met = data.mapInPandas(trimmed(run), "block int, dim int, id long, v binary")
    return met.withColumn("piece", F.pmod(F.xxhash64("id"), F.lit(pieces)).cast("int"))


def _solved(x: pd.DataFrame, q: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k largest scores of each query of q among x, ties to smaller ids."""
    out = []
    for dim, ask in q.groupby("dim"):
        have = x[x["dim"] == dim].sort_values("id")
        if not len(have):
            continue
        ids, theirs, step = have["id"].to_numpy(), _matrix(have["v"], dim).T, max(1, SCORES // len(have))
        for at in range(0, len(ask), step):
            part = ask.iloc[at : at + step]
            qs = part["id"].to_numpy()
            scores = _matrix(part["v"], dim) @ theirs
            own = np.searchsorted(ids, qs)
            mine = np.flatnonzero(ids[np.minimum(own, len(ids) - 1)] == qs)
            scores[mine, own[mine]] = -np.inf
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k] if len(ids) <= 4 * k else _largest(scores, k)
            row = np.repeat(np.arange(len(qs)), best.shape[1])
            value = scores[row, best.reshape(-1)]
            keep = np.isfinite(value)
            out.append(pd.DataFrame({"query_id": qs[row][keep], "vec_id": ids[best.reshape(-1)][keep], "score": value[keep].astype(np.int64)}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(np.int64)


def top_k(data: DataFrame, queries: DataFrame, k: int = K, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest integer inner products of every query with other rows of data.

    Ties go to the smaller vec_id; a query has fewer rows if data has. Rows with a null id, a null or empty vector or
    a null or non-finite component take no part; vectors of different lengths are not compared; of rows that repeat
    an id one counts. Empty tables give no rows; other columns, whatever their names, are not read. Scores are exact
    while they are below 2^53.
    """
    spark = data.sparkSession
    small_batches(spark)
    rows = staged(whole(data, vector, vec_id).dropDuplicates(["id"]), "knn-data")
    asked = staged(whole(queries, vector, vec_id).dropDuplicates(["id"]), "knn-queries")
    # one row for each length of vectors
    facts = {r["dim"]: (r["most"], r["n"]) for r in rows.groupBy("dim").agg(F.max("squared").alias("most"), F.count(F.lit(1)).alias("n")).collect()}
    if not facts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = _pivots(rows, facts, k)
    data_cells = staged(_grouped(rows, pivots), "knn-cells")
    query_cells = staged(_grouped(asked.filter(F.col("dim").isin(list(facts))), pivots), "knn-query-cells")
    placed = _plan(data_cells, query_cells, pivots, k)
    pieces = max(1, -(-max(n for _, n in facts.values()) // DATA_BLOCK))
    left = _sent(data_cells, placed, pivots, pieces)
    p = spark.createDataFrame([x[:4] for x in placed], "p_dim int, p_cell int, block int, cuts int")
    right = query_cells.join(F.broadcast(p), (F.col("dim") == F.col("p_dim")) & (F.col("cell") == F.col("p_cell")))
    right = right.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    right = right.select((F.col("block") + F.pmod(F.xxhash64("id"), F.col("cuts").cast("long"))).cast("int").alias("block"), F.col("piece").cast("int").alias("piece"), "dim", "id", "v")

    def solve(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        return _solved(x, q, k)

    lists = left.groupBy("block", "piece").cogroup(right.groupBy("block", "piece")).applyInPandas(solve, "query_id long, vec_id long, score long")
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return lists.withColumn("rank", ranked).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _largest(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k largest values, ties by column: all values at least the k-th are ordered exactly."""
    kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    out = np.empty((len(scores), k), np.int64)
    for i, least in enumerate(kth):
        at = np.flatnonzero(scores[i] >= least)
        out[i] = at[np.argsort(-scores[i, at], kind="stable")[:k]]
    return out


def op3_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(data, data.filter(F.col("vec_id") % 50 == 0))


OP3_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
