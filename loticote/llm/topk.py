"""Exact top-k inner products by a Voronoi join: pivots, bounds from summaries, local solutions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from loticote.session import materialize

# Above this, sums of products are computed with Python integers instead of doubles.
EXACT = 2.0**53


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as doubles."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))).cast("double"))


def usable(vector: Column) -> Column:
    """Neither NULL nor with a NULL, NaN or infinite component."""
    values = vector.cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def by_dim(frame: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Row places of each vector length."""
    for dim, rows in frame.groupby(frame["v"].map(len)).indices.items():
        yield int(dim), rows


def pivot_sample(points: DataFrame, size: int, lengths: int) -> dict[int, np.ndarray]:
    """At most ``size`` points of each of the ``lengths`` most frequent vector lengths, in the order of a hash."""
    common = points.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(lengths)
    order = Window.partitionBy("dim").orderBy(F.xxhash64("v"), "v")
    picked = points.select("dim", "v").withColumn("r", F.row_number().over(order)).where(F.col("r") <= size)
    found: dict[int, list] = {}
    for row in picked.join(common.select("dim"), "dim").orderBy("dim", "r").collect():
        found.setdefault(row.dim, []).append(row.v)
    return {d: np.array(v, np.float64).reshape(len(v), d) for d, v in found.items()}


def pivots_of(pivots: dict[int, np.ndarray], dim: int) -> np.ndarray:
    """The pivots of a vector length; a length without a sample has the origin alone."""
    return pivots[dim] if dim in pivots else np.zeros((1, dim))


def with_cells(rows: DataFrame, pivots: dict[int, np.ndarray], sample: dict[int, np.ndarray], k: int) -> DataFrame:
    """Adds the nearest pivot, the distance to it, the length, and a score that the k-th best exceeds or equals.

    The sample consists of points of the table, so the k-th largest of a query's products with it is a
    lower bound of its true k-th best score.
    """
    added = [StructField("cell", IntegerType())] + [StructField(c, DoubleType()) for c in ("far", "norm", "floor")]
    schema = StructType(rows.schema.fields + added)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame.reset_index(drop=True)
            for name in ("far", "norm", "floor"):
                frame[name] = 0.0
            frame["cell"] = 0
            cell, far, norm, low = (np.zeros(len(frame)) for _ in range(4))
            for dim, rows in by_dim(frame):
                low[rows] = -np.inf
                x = np.array(frame["v"].iloc[rows].tolist(), np.float64).reshape(len(rows), dim)
                p, s = pivots_of(pivots, dim), sample.get(dim, np.zeros((0, dim)))
                square = (x * x).sum(1)
                apart = np.maximum(square[:, None] - 2 * x @ p.T + (p * p).sum(1)[None], 0)
                cell[rows] = apart.argmin(1)
                far[rows], norm[rows] = np.sqrt(apart.min(1)), np.sqrt(square)
                if len(s) >= k:
                    low[rows] = np.partition(x @ s.T, len(s) - k, axis=1)[:, len(s) - k]
            frame["cell"], frame["far"], frame["norm"], frame["floor"] = cell.astype(np.int32), far, norm, low
            yield frame[schema.names]

    return rows.mapInPandas(run, schema)


def local_top(queries: pd.DataFrame, points: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best points of every query; rows are (qid, pid, score)."""
    out = []
    for dim, rows in by_dim(queries):
        same = points[points["v"].map(len) == dim]
        if same.empty:
            continue
        q = np.array(queries["v"].iloc[rows].tolist(), np.float64).reshape(len(rows), dim)
        x = np.array(same["v"].tolist(), np.float64).reshape(len(same), dim)
        ids, qids = same["pid"].to_numpy(), queries["qid"].to_numpy()[rows]
        if dim and np.abs(q).max() * np.abs(x).max() * dim >= EXACT:
            q, x = (np.array([[int(c) for c in r] for r in m], dtype=object) for m in (q, x))
        scores = q @ x.T if dim else np.zeros((len(q), len(x)))
        for i, found in enumerate(scores):
            best = np.lexsort((ids, -found))[:k] if len(ids) <= 4 * k else narrowed(ids, found, k)
            out.append(pd.DataFrame({"qid": qids[i], "pid": ids[best], "score": found[best].astype(np.int64)}))
    return pd.concat(out) if out else pd.DataFrame({"qid": [], "pid": [], "score": []}).astype("int64")


def narrowed(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The k best by (score down, id up): first all that reach the k-th score, then their order."""
    limit = np.partition(scores, len(scores) - k)[len(scores) - k]
    able = np.flatnonzero(scores >= limit)
    return able[np.lexsort((ids[able], -scores[able]))][:k]


def voronoi_topk(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    query_every: int = 50,
    scale: int = 256,
    pivots: int = 32,
    sample: int = 512,
    sampled_lengths: int = 64,
    block_queries: int = 512,
    chunk_points: int = 4_096,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best other rows, ties to the smaller id.

    Components become floor(scale * x); the score is their integer inner product. Queries are the rows
    whose id is divisible by ``query_every``. Rows without an id or with a NULL, NaN or infinite component
    take no part; vectors of different lengths have no product and are never compared; rows that repeat
    an id and vector count once. An empty table gives no rows. Pivots and bounds come from ``sample`` points of
    each of the ``sampled_lengths`` most frequent vector lengths; all other lengths are searched as exactly, with
    the origin as their pivot and no lower bound.

    1. Equal vectors are folded into one point that keeps its k + 1 smallest ids (more can never be
       needed), so a vector with very many copies leaves a handful of rows per task.
    2. Points and queries go to their nearest of ``pivots`` pivots. Cells are summed up as (pivot, radius,
       points); query blocks (pivot, chunk) as radius and least lower bound of their k-th best score.
    3. A cell meets a block only if max(q.x) <= c.p + |c| r + R |p| + R r (c, R: the block's pivot and
       radius; p, r: the cell's) reaches that bound, and a point goes to the block only if c.x + R |x| does.
    4. Every (block, cell, chunk of the cell) is solved alone; the best of all are merged.
    """
    base = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    base = base.where(F.col("id").isNotNull() & usable(F.col("v")))
    base = base.select("id", scaled(F.col("v"), scale).alias("v")).dropDuplicates(["id", "v"])
    same = Window.partitionBy("v").orderBy("id")
    folded = base.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k + 1)
    folded = folded.groupBy("v").agg(F.min("id").alias("pid"), F.sort_array(F.collect_list("id")).alias("ids"))
    points = materialize(folded.withColumn("dim", F.size("v")), "topk-points")
    queries = base.where(F.col("id") % query_every == 0).withColumnRenamed("id", "qid")

    anchors = pivot_sample(points, sample, sampled_lengths)
    chosen = {d: v[:pivots] for d, v in anchors.items()}
    # k + 1 because one of the best can be the query itself.
    points = materialize(with_cells(points, chosen, anchors, k + 1), "topk-cells")
    queries = queries.withColumn("dim", F.size("v"))
    queries = materialize(with_cells(queries, chosen, anchors, k + 1), "topk-queries")

    # Summaries: one row for each cell, at most ``pivots`` for each vector length.
    cells = points.groupBy("dim", "cell").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("chunks", F.ceil(F.col("n") / chunk_points).cast("int")).drop("n")
    asked = queries.groupBy("dim").agg(F.count(F.lit(1)).alias("n_queries"))
    shared = F.greatest(F.lit(1), F.ceil(F.col("n_queries") / block_queries)).cast("int")
    # Few queries share a block over several pivots; many split a pivot's queries into chunks.
    queries = queries.join(F.broadcast(asked.withColumn("shared", shared).drop("n_queries")), "dim")
    group = F.when(F.col("shared") < pivots, F.pmod(F.col("cell"), F.col("shared"))).otherwise(F.col("cell"))
    chunk = F.when(F.col("shared") < pivots, 0).otherwise(
        F.pmod(F.xxhash64("qid"), F.greatest(F.lit(1), F.ceil(F.col("shared") / pivots)))
    )
    queries = queries.withColumn("block", F.concat_ws("-", "dim", group, chunk.cast("int")))

    # Distances are to the block's pivot: that of its group.
    def centred(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            far = np.zeros(len(frame))
            for dim, rows in by_dim(frame):
                centre = np.array([int(b.split("-")[1]) for b in frame["block"].iloc[rows]])
                x = np.array(frame["v"].iloc[rows].tolist(), np.float64).reshape(len(rows), dim)
                centres = pivots_of(chosen, dim)
                far[rows] = np.sqrt(((x - centres[np.minimum(centre, len(centres) - 1)]) ** 2).sum(1))
            yield frame.assign(far=far)[["qid", "v", "dim", "block", "far", "floor"]]

    queries = materialize(
        queries.select("qid", "v", "dim", "block", "far", "floor").mapInPandas(
            centred, "qid long, v array<double>, dim int, block string, far double, floor double"
        ),
        "topk-blocks",
    )
    blocks = queries.groupBy("dim", "block").agg(F.max("far").alias("wide"), F.min("floor").alias("least"))

    def admitted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = np.ones(len(frame), bool)
            for i, r in enumerate(frame.itertuples()):
                centres = pivots_of(chosen, r.dim)
                c, p = centres[min(int(r.block.split("-")[1]), len(centres) - 1)], centres[r.cell]
                top = c @ p + np.linalg.norm(c) * r.radius + r.wide * (np.linalg.norm(p) + r.radius)
                keep[i] = top * (1 + 1e-9) + 1e-6 >= r.least if top >= 0 else top * (1 - 1e-9) + 1e-6 >= r.least
            yield frame[keep]

    # Cells are few for each vector length, so this has a bounded number of rows for each block.
    routes = blocks.join(cells, "dim")
    routes = materialize(routes.mapInPandas(admitted, routes.schema), "topk-routes")

    def needed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = np.ones(len(frame), bool)
            for dim, rows in by_dim(frame):
                x = np.array(frame["v"].iloc[rows].tolist(), np.float64).reshape(len(rows), dim)
                centre = np.array([int(b.split("-")[1]) for b in frame["block"].iloc[rows]])
                centres = pivots_of(chosen, dim)
                centre = np.minimum(centre, len(centres) - 1)
                top = (x * centres[centre]).sum(1) + (frame["wide"] * frame["norm"]).to_numpy()[rows]
                keep[rows] = top + np.abs(top) * 1e-9 + 1e-6 >= frame["least"].to_numpy()[rows]
            yield frame.loc[keep, ["block", "cell", "chunk", "pid", "v"]]

    sent = points.select("dim", "cell", "pid", "v", "norm").join(
        routes.select("dim", "cell", "block", "wide", "least", "chunks"), ["dim", "cell"]
    )
    sent = sent.withColumn("chunk", F.pmod(F.xxhash64("pid"), F.col("chunks")).cast("int"))
    sent = sent.select("block", "cell", "chunk", "pid", "v", "norm", "wide", "least").mapInPandas(
        needed, "block string, cell int, chunk int, pid long, v array<double>"
    )
    tasks = routes.select("block", "cell", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    asking = queries.select("block", "qid", "v").join(tasks, "block")

    def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        return local_top(q, x, k + 1)

    keys = ["block", "cell", "chunk"]
    best = (
        asking.groupBy(*keys)
        .cogroup(sent.groupBy(*keys))
        .applyInPandas(solve, "qid long, pid long, score long")
    )
    first = Window.partitionBy("qid").orderBy(F.desc("score"), "pid")
    best = best.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).drop("r")
    ids = best.join(points.select("pid", "ids"), "pid").select(
        F.col("qid").alias("query_id"), F.explode("ids").alias("vec_id"), "score"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ids = ids.where(F.col("vec_id") != F.col("query_id")).dropDuplicates(["query_id", "vec_id", "score"])
    ranked = ids.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
