"""Exact top-k search by inner product, with a table of distances to pivots that rules out most candidates."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import written
from skyloom.llm.vectors import takes_part

LARGEST = 1 << 20
LONGEST = 1 << 13
SAMPLE = 2_048


def whole_numbers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and the vector of floor(scale * x), in double precision, which holds it exactly; rows that take no part are left out.

    Null vectors, and those with null or non-finite components, take no part, nor do those of which ``scale * x`` itself
    is beyond double precision (at a scale of 256 from 2^1016 on).  ``plain`` rows have whole numbers of at
    most 2^20 in size and at most 2^13 of them: sums of their products are exact in float64.
    """
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * scale)
    rows = vectors.where(takes_part(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("scaled"))
    rows = rows.where(takes_part(F.col("scaled")))
    # From 2^53 on a double is a whole number, and its floor may leave 64 bits.
    whole = F.transform("scaled", lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))
    rows = rows.select("vec_id", whole.alias("v")).withColumn("dim", F.size("v"))
    small = F.forall("v", lambda x: x.between(-LARGEST, LARGEST))
    return rows.withColumn("plain", small & (F.col("dim") <= LONGEST))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def choose_pivots(rows: DataFrame, count: int, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Pivots far from each other, by dimension, from the ``sample`` plain rows with the smallest hashes (the bound)."""
    some = rows.where("plain").select("v", "dim", F.xxhash64("vec_id", "v").alias("h")).orderBy("h").limit(sample).select("v", "dim").toArrow()
    found = {}
    for dim in set(some.column("dim").to_pylist()):
        points = matrix(some.filter(pc.equal(some.column("dim"), dim)).column("v").combine_chunks())
        chosen = [0]
        far = ((points - points[0]) ** 2).sum(1)
        while len(chosen) < min(count, len(points)) and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
        found[dim] = points[chosen]
    return found


def pivot_distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (points * points).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def upper_bounds(wanted: np.ndarray, near: np.ndarray, table: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """By query and candidate, what their inner product cannot exceed.

    Their distance is at least the largest difference of their distances to a pivot.
    """
    lower = np.abs(near[:, :1] - table[None, :, 0])
    for pivot in range(1, table.shape[1]):
        np.maximum(lower, np.abs(near[:, pivot : pivot + 1] - table[None, :, pivot]), out=lower)
    bound = ((wanted * wanted).sum(1)[:, None] + squares[None, :] - lower * lower) / 2
    return bound + 1e-6 * (1 + np.abs(bound) + squares[None, :]) + 1e-9 * (wanted * wanted).sum(1)[:, None]


def best(query: np.ndarray, own: int, bound: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, wave: int = 64):
    """The k best of a block of candidates for one query, as (scores, ids).

    Candidates are scored in waves, in the order of their bounds, until these fall below the k-th best score; a
    candidate that may still tie is scored too.
    """
    order = np.argsort(-bound)
    scores, found, start = np.empty(0), np.empty(0, np.int64), 0
    while start < len(order):
        at = order[start : start + wave]
        start, wave = start + wave, 4 * wave
        if len(scores) >= k:
            at = at[bound[at] >= scores[-1]]
            if not len(at):
                break
        score = points[at] @ query
        if len(scores) >= k:
            at, score = at[score >= scores[-1]], score[score >= scores[-1]]
        other = ids[at] != own
        scores, found = np.concatenate([scores, score[other]]), np.concatenate([found, ids[at][other]])
        top = np.lexsort((found, -scores))[:k]
        scores, found = scores[top], found[top]
    return scores.astype(np.int64), found


def best_of_large(query: np.ndarray, own: int, points: np.ndarray, ids: np.ndarray, k: int) -> tuple[list[int], list[int]]:
    """The k best for one query where sums may leave float64 or 64 bits, as (scores, ids).

    Sums in float64 with their error bounds rule out candidates; what is left is scored in Python's whole numbers.
    """
    points, ids = points[ids != own], ids[ids != own]
    with np.errstate(over="ignore", invalid="ignore"):  # what leaves double precision is never ruled out
        score = points @ query
        error = 2.0**-50 * (len(query) + 4) * (np.abs(points) @ np.abs(query))
        low, high = score - error, score + error
    if len(ids) > k:
        least = np.partition(np.where(np.isfinite(low), low, -np.inf), -k)[-k]
        near = ~(high < least)
        points, ids = points[near], ids[near]
    asked = [int(x) for x in query.tolist()]
    exact = [sum(int(x) * y for x, y in zip(row, asked, strict=True)) for row in points.tolist()]
    top = sorted(zip((-x for x in exact), ids.tolist(), strict=True))[:k]
    return [-x for x, _ in top], [i for _, i in top]


def in_order(score: int) -> bytes:
    """Bytes that stand in the order of their whole number, of any size: length, then digits; both turned for negative ones."""
    size = (abs(score).bit_length() + 7) // 8
    if score >= 0:
        return (0x8000 + size).to_bytes(2, "big") + score.to_bytes(size, "big")
    return (0x7FFF - size).to_bytes(2, "big") + ((1 << 8 * size) - 1 + score).to_bytes(size, "big")


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, pivots: int = 16, block: int = 4_096, scale: int = 256) -> DataFrame:
    """The ``k`` rows of ``vectors`` (vec_id, embedding) with the highest integer inner product, for each of ``queries``.

    Distances of all rows to the pivots are worked out once and kept in a table.  Queries and candidates meet in
    blocks of bounded size; a block returns its k best for each query, and the best of all blocks follow by a ranking that
    cuts to k before it shuffles.

    Returns query_id, rank from 1, vec_id and score; ties go to the smaller vec_id.  A query's own vec_id is no
    candidate.  Vectors of other lengths are no candidates.  Rows without a vec_id take no part; a row that is
    repeated is one candidate and one query; an empty table gives an empty one.  Scores are exact; one that leaves
    64 bits keeps its rank and is given as the nearest whole number of 64 bits.
    """
    rows = whole_numbers(vectors, scale).where(F.col("vec_id").isNotNull()).distinct()
    asked = whole_numbers(queries, scale).where(F.col("vec_id").isNotNull()).distinct()
    centre = choose_pivots(rows, pivots)

    def measured(batches):
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                with np.errstate(over="ignore", invalid="ignore"):  # only plain rows are ever ruled out by these
                    far = pivot_distances(matrix(part.column(1)), centre.get(int(dim), np.zeros((1, int(dim)))))
                away = pa.ListArray.from_arrays(pa.array(np.arange(0, far.size + 1, far.shape[1], dtype=np.int32)), pa.array(far.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), part.column(3), away], names=["vec_id", "v", "dim", "plain", "away"])

    schema = "vec_id long, v array<double>, dim int, plain boolean, away array<double>"
    candidates = written(rows.select("vec_id", "v", "dim", "plain").mapInArrow(measured, schema), "pivot-table")
    asking = written(asked.select("vec_id", "v", "dim", "plain").mapInArrow(measured, schema), "queries")
    blocks, asks = max(1, -(-candidates.count() // block)), max(1, -(-asking.count() // block))

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int, side: int) -> DataFrame:
        return df.select(
            F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other),
            F.lit(side).alias("side"), "vec_id", "v", "dim", "plain", "away",
        )

    def judge(group: pa.Table) -> pa.Table:
        sides = [group.filter(pc.equal(group.column("side"), side)) for side in (0, 1)]
        plain = [side.filter(side.column("plain")) for side in sides]
        out = ([], [], [])

        def add(own: int, found: list[int], scores: list[int]) -> None:
            for whole, part in zip(out, ([own] * len(found), found, scores), strict=True):
                whole.extend(part)

        if plain[0].num_rows and plain[1].num_rows:
            wanted, points = (matrix(side.column("v").combine_chunks()) for side in plain)
            near, table = (matrix(side.column("away").combine_chunks()) for side in plain)
            ids, squares = plain[1].column("vec_id").to_numpy(), (points * points).sum(1)
            owns = plain[0].column("vec_id").to_pylist()
            for start in range(0, len(owns), 32):
                few = slice(start, start + 32)
                bounds = upper_bounds(wanted[few], near[few], table, squares)
                for query, own, bound in zip(wanted[few], owns[few], bounds, strict=True):
                    scores, found = best(query, own, bound, points, ids, k)
                    add(own, found.tolist(), scores.tolist())
        # Pairs with a row that is not plain: such candidates for plain queries, all candidates for other queries.
        large = sides[1].filter(pc.invert(sides[1].column("plain")))
        others = sides[0].filter(pc.invert(sides[0].column("plain")))
        for asking, offered in ((plain[0], large), (others, sides[1])):
            if asking.num_rows and offered.num_rows:
                points, ids = matrix(offered.column("v").combine_chunks()), offered.column("vec_id").to_numpy()
                for query, own in zip(matrix(asking.column("v").combine_chunks()), asking.column("vec_id").to_pylist(), strict=True):
                    scores, found = best_of_large(query, own, points, ids, k)
                    add(own, found, scores)
        held = [min(max(x, -(1 << 63)), (1 << 63) - 1) for x in out[2]]
        columns = [pa.array(x, pa.int64()) for x in (out[0], out[1], held)]
        return pa.table([*columns, pa.array([in_order(int(x)) for x in out[2]], pa.binary())], names=["query_id", "vec_id", "score", "place"])

    left = dealt(asking, "q", asks, "c", blocks, 0)
    right = dealt(candidates, "c", blocks, "q", asks, 1)
    found = left.unionByName(right).groupBy("dim", "q", "c").applyInArrow(judge, "query_id long, vec_id long, score long, place binary")
    order = Window.partitionBy("query_id").orderBy(F.desc("place"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
