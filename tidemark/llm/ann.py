"""Approximate nearest neighbours by cosine, with randomly rotated one-bit codes.

Every vector is scaled to unit length, centred on a common centre, rotated by one random rotation, and reduced to the
signs of its coordinates plus correction scalars. A query is rotated alike and quantised to a few bits a coordinate, so
its inner product with a code is a handful of AND and population-count operations on packed words. The correction
scalars turn that into an unbiased estimate of the true inner product, with an error bound that holds with a chance set
by ``EPSILON``. A vector is reranked, that is its cosine computed exactly on the original numbers, only if its upper
bound reaches the k-th best exact cosine so far.

The index holds a row for every vector; only the centre is fitted on a bounded sample. Queries meet vectors in blocks:
``QUERY_BLOCK`` queries by a slice of vectors, one pair of blocks per group, so no task holds more than one of each.
Vectors that share a key or are all the same are sliced like any others.

Defined cases: vectors that are null, zero, or hold null, NaN or infinite components take no part, on either side, and
neither do vectors of another length than the most frequent one; a query is not its own neighbour, and with repeated
ids rows with the query's id are left out, and every different query of an id has a ranking of its own; fewer candidates than ``k`` give fewer rows; ties go to the smaller id;
empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

NEIGHBOURS = 5
# Standard deviations of the estimate that the bounds span.
EPSILON = 2.2
# Bits of a query's coordinate.
QUERY_BITS = 6
SEED = 20
# Vectors that the centre is the mean of, at most.
CENTRE_ROWS = 20_000
QUERY_BLOCK = 512
VECTOR_BLOCK = 16_384
# Vectors that are estimated at a time within a block.
STEP = 2048
# Components below this (or above its inverse) have squares that a double can't hold.
TINY = 1e-100


def rotation(dimension: int) -> np.ndarray:
    """A random rotation, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    n, d = bits.shape
    padded = np.zeros((n, -(-d // 64) * 64), dtype=np.uint8)
    padded[:, :d] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


class Codes:
    """One-bit codes of a block of vectors with their correction scalars."""

    def __init__(self, vectors: np.ndarray, centre: np.ndarray):
        units = unit(vectors)
        around = units - centre
        self.norm = np.sqrt((around * around).sum(axis=1))
        safe = np.where(self.norm > 0, self.norm, 1.0)
        turned = (around / safe[:, None]) @ rotation(len(centre))
        self.words = pack(turned > 0)
        # <code, vector> of the unit code: how well the signs stand for the vector.
        self.fit = np.where(self.norm > 0, np.abs(turned).sum(axis=1) / np.sqrt(len(centre)), 1.0)
        self.ones = np.bitwise_count(self.words).sum(axis=1).astype(np.float64)
        self.shift = units @ centre


class Query:
    """A block of queries, rotated and quantised to bit planes."""

    def __init__(self, vectors: np.ndarray, centre: np.ndarray):
        units = unit(vectors)
        around = units - centre
        self.norm = np.sqrt((around * around).sum(axis=1))
        turned = around @ rotation(len(centre))
        self.low = turned.min(axis=1)
        span = turned.max(axis=1) - self.low
        self.width = np.where(span > 0, span, 1.0) / (2**QUERY_BITS - 1)
        steps = np.rint((turned - self.low[:, None]) / self.width[:, None]).astype(np.int64)
        self.sum = steps.sum(axis=1).astype(np.float64)
        self.planes = [pack((steps >> j) & 1 == 1) for j in range(QUERY_BITS)]
        error = turned - (self.low[:, None] + self.width[:, None] * steps)
        self.error = np.sqrt((error * error).sum(axis=1))
        self.shift = units @ centre - centre @ centre


def bounds(query: Query, codes: Codes, part: slice, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines (queries, vectors of the part) and the half-width of their error bounds."""
    words, root = codes.words[part], np.sqrt(dimension)
    hits = np.zeros((len(query.norm), len(words)))
    for j, plane in enumerate(query.planes):
        for w in range(words.shape[1]):
            hits += np.bitwise_count(plane[:, w, None] & words[None, :, w]) * float(1 << j)
    ones = codes.ones[part][None, :]
    # <code, quantised query>, the code's coordinates being plus or minus one over the root of the dimension.
    inner = (2 * (query.width[:, None] * hits + query.low[:, None] * ones)
             - (query.width * query.sum + query.low * dimension)[:, None]) / root
    fit, norm = codes.fit[part][None, :], codes.norm[part][None, :]
    estimate = norm * inner / fit + codes.shift[part][None, :] + query.shift[:, None]
    spread = EPSILON * query.norm[:, None] * np.sqrt(np.maximum(0.0, 1 - fit * fit)) / np.sqrt(max(1, dimension - 1))
    return estimate, norm * (spread + query.error[:, None]) / fit + 1e-9


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; the same pair gives the same bits wherever it stands."""
    dot = (x * y).sum(axis=1)
    return dot / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def search_block(query_ids, query_rows, queries, ids, vectors, centre, k: int) -> pd.DataFrame:
    """The k nearest of ``vectors`` to each query, by codes, bounds and reranking. ``query_rows`` tells apart queries of one
    id."""
    found = [(np.zeros(0, np.int64), np.zeros(0))] * len(query_ids)
    least = np.full(len(query_ids), -np.inf)
    asked, codes = Query(queries, centre), Codes(vectors, centre)
    for at in range(0, len(ids), STEP):
        part = slice(at, min(at + STEP, len(ids)))
        estimate, half = bounds(asked, codes, part, len(centre))
        other = query_ids[:, None] != ids[None, part]
        if at == 0 and len(ids) > k:
            # The best estimates first: their exact cosines are a floor that spares most of the rest.
            top = np.argpartition(-np.where(other, estimate, -np.inf), k - 1, axis=1)[:, :k]
            exact = cosines(np.repeat(queries, k, axis=0), vectors[part][top.ravel()]).reshape(-1, k)
            least = np.where(np.take_along_axis(other, top, axis=1).all(axis=1), exact.min(axis=1), -np.inf)
        q, v = np.nonzero(other & (estimate + half >= least[:, None]))
        score = np.concatenate(
            [cosines(queries[q[i : i + 65536]], vectors[part][v[i : i + 65536]]) for i in range(0, len(q), 65536)] or [np.zeros(0)]
        )
        cuts = np.searchsorted(q, np.arange(len(query_ids) + 1))
        for i in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[i], cuts[i + 1])
            all_ids = np.concatenate([found[i][0], ids[part][v[own]]])
            all_scores = np.concatenate([found[i][1], score[own]])
            best = np.lexsort((all_ids, -all_scores))[:k]
            found[i] = (all_ids[best], all_scores[best])
            if len(best) == k:
                least[i] = max(least[i], all_scores[best[-1]])
    counts = [len(f[0]) for f in found]
    return pd.DataFrame(
        {
            "query_id": np.repeat(query_ids, counts),
            "query_row": np.repeat(query_rows, counts),
            "vec_id": np.concatenate([f[0] for f in found]) if found else [],
            "score": np.concatenate([f[1] for f in found]) if found else [],
        }
    )


def usable(column: str) -> Column:
    """The vector has components, all of them finite numbers, and is not zero."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def scaled(v: Column) -> Column:
    """Vectors of extreme length, by a power of two: the cosine stays to the bit, and squares neither vanish nor overflow."""
    top = F.array_max(F.transform(v, lambda x: F.abs(x)))
    extreme = (top < TINY) | (top > 1 / TINY)
    # In two steps, as the whole power may lie beyond the range of a double.
    half = F.pow(F.lit(2.0), F.floor(-F.log2(top) / 2))
    return F.when(extreme, F.transform(v, lambda x: x * half * half)).otherwise(v)


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def search(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = NEIGHBOURS,
    query_block: int = QUERY_BLOCK,
    vector_block: int = VECTOR_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the k nearest rows to each row where ``is_query``."""
    rows = vectors.where(usable(vector_column) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("id"), scaled(F.col(vector_column).cast("array<double>")).alias("v"), is_query.alias("asks")
    )
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, query_row long, vec_id long, score double"
    if usual is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimension = usual["d"]
    rows = rows.where(F.size("v") == dimension)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(CENTRE_ROWS).select(F.posexplode("v").alias("i", "x"), "v")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x))
    mean = {r["i"]: r["m"] for r in sample.select("i", (F.col("x") / norm).alias("y")).groupBy("i").agg(F.avg("y").alias("m")).collect()}
    centre = np.array([mean[i] for i in range(dimension)])
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    query_blocks, vector_blocks = max(1, -(-counts["q"] // query_block)), max(1, -(-counts["n"] // vector_block))
    own = F.xxhash64("id", "v")
    asked = rows.where("asks").dropDuplicates(["id", "v"]).select(
        "id", "v", own.alias("row"), F.pmod(own, F.lit(query_blocks)).alias("qb"), F.explode(_numbers(vector_blocks)).alias("vb")
    )
    held = rows.select(
        "id", "v", F.explode(_numbers(query_blocks)).alias("qb"), F.pmod(own, F.lit(vector_blocks)).alias("vb")
    )

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "query_row": [], "vec_id": [], "score": []})
        return search_block(
            left["id"].to_numpy(), left["row"].to_numpy(), np.stack(left["v"]), right["id"].to_numpy(), np.stack(right["v"]), centre, k
        )

    pairs = asked.groupBy("qb", "vb").cogroup(held.groupBy("qb", "vb")).applyInPandas(meet, schema)
    nth = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    ranked = cut_lineage(pairs).select("query_id", F.row_number().over(nth).alias("rank"), "vec_id", "score")
    return ranked.where(F.col("rank") <= k)
