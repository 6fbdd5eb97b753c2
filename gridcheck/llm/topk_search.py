"""Exact top-k inner products without random access.

Vectors become integers and are packed into blocks of bounded size; the query
set is packed likewise. Tiles, of a few blocks and a few query blocks, meet by
an equi-join on their numbers, so no task holds more than two tile sides.

Inside a block every dimension is a list of its components, sorted, and read
from the top for a positive query weight, from the bottom for a negative one.
A query's lists are taken up in the order of weight times spread, a few at a
time. A list that is still to come bounds what it can add to any score by its
first and last entry, so every candidate has a lower and an upper bound; the
k-th lower bound, or k-th score in the blocks before, is the mark to reach. A
list is read down to the entry under which not even the candidate of the
highest bound could reach the mark; who stands below, or stays under the mark
after the list, is out. Reading stops when hardly more than k candidates are
left; their scores are then resolved exactly.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK, QUERY_BLOCK = 2048, 2048
#: Blocks on a side of a tile, if there are enough of them for TILES tiles.
SIDE, TILES = 8, 64
#: Lists that are read before the bounds are drawn again; the first time, those that make up half of all spread, as no bound can tell before.
BATCH = 8
SMALL = 2.0**31
LEAST, MOST = -(2**63), 2**63 - 1


def _pack(key, table):
    import pyarrow as pa

    ids = table["vec_id"].to_numpy()
    dim = key[1].as_py()
    flat = table["_v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
    flat = np.floor(256.0 * flat.astype(np.float64))
    order = np.lexsort([*flat.T[::-1], ids])
    ids, flat = ids[order], flat[order]
    one = np.append(True, ids[1:] != ids[:-1])  # one row for each id, that of the least vector
    small = bool((np.abs(flat) < SMALL).all())
    raw = flat[one].astype("<i4" if small else "<f8").tobytes()
    return pa.table({"_block": [key[0].as_py()], "_dim": [dim], "_ids": [ids[one].astype("<i8").tobytes()], "_vals": [raw], "_small": [small]})


def _unpack(table, dim: int):
    """(number, ids, vectors as integers in doubles) of each block, by number."""
    rows = sorted(table.to_pylist(), key=lambda r: r["_block"])
    return [(r["_block"], np.frombuffer(r["_ids"], "<i8"), np.frombuffer(r["_vals"], "<i4" if r["_small"] else "<f8").reshape(-1, dim).astype(np.float64)) for r in rows]


def _packed(rows: DataFrame, n: int, size: int) -> DataFrame:
    blocks = max(1, -(-n // size))
    keyed = rows.withColumn("_block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    return keyed.groupBy("_block", "_dim").applyInArrow(_pack, "_block long, _dim long, _ids binary, _vals binary, _small boolean")


def _held(mark: float) -> float:
    """A mark beyond 64 bits, where scores are held, shuts nobody out who is held at the same end."""
    return -math.inf if mark < LEAST else min(mark, float(MOST))


class SortedLists:
    """The vectors of a block as one sorted list for each dimension."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, counted: bool = False):
        self.ids, self.vectors = ids, vectors
        self.columns = np.ascontiguousarray(vectors.T)
        self.lists = np.sort(self.columns, axis=1)
        self.low, self.high = (self.lists[:, 0], self.lists[:, -1]) if len(ids) else (np.zeros(len(self.lists)),) * 2
        self.largest = float(np.abs(vectors).max(initial=0))
        self.read, self.counted = 0, counted  # entries, if they are to be counted

    def _entries(self, d: int, weight: float, cut: float) -> int:
        """Entries of list d, from its best end, that add cut or more."""
        n = len(self.ids)
        if weight == 0 or not math.isfinite(cut):
            return 0 if weight == 0 else n
        if weight > 0:
            return n - int(np.searchsorted(self.lists[d], cut / weight, "left"))
        return int(np.searchsorted(self.lists[d], cut / weight, "right"))

    def exact(self, w: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Scores of the candidates, as integers; those beyond 64 bits are held at their ends."""
        if len(w) * float(np.abs(w).max(initial=0)) * self.largest < 2.0**62:
            return self.vectors[among].astype(np.int64) @ w.astype(np.int64)
        whole = [int(a) for a in w]
        found = [sum(a * int(b) for a, b in zip(whole, v, strict=True)) for v in self.vectors[among].tolist()]
        return np.array([min(max(s, LEAST), MOST) for s in found], np.int64)

    def top(self, w: np.ndarray, own: int, k: int, mark: float = -math.inf) -> tuple[np.ndarray, np.ndarray]:
        """(index, score) of the k best candidates of the query w, whose own id is none, by falling score, ties to smaller ids.
        Candidates of scores under mark may be left out."""
        n, dim = self.vectors.shape
        best, worst = np.where(w > 0, w * self.high, w * self.low), np.where(w > 0, w * self.low, w * self.high)
        order = np.argsort(worst - best, kind="stable")
        # What the lists still to come add at most and at least, after each number of lists.
        most = np.append(np.cumsum(best[order][::-1])[::-1], 0.0)
        least = np.append(np.cumsum(worst[order][::-1])[::-1], 0.0)
        # Integers are exact in doubles as long as no sum passes 2^53.
        bound = float(np.abs(w).sum()) * self.largest
        slack = 0.0 if bound < 2.0**53 else bound * dim * 1e-15
        at = np.searchsorted(self.ids, own)
        alive = np.arange(n)
        if at < n and self.ids[at] == own:
            alive = np.delete(alive, at)
        so_far = np.zeros(len(alive))
        half = int(np.count_nonzero(most - least > (most[0] - least[0]) / 2))
        for first, done in itertools.pairwise([0, *range(max(1, half), dim, BATCH), dim]):
            if len(alive) <= 4 * k:
                break
            d = order[first:done]
            if self.counted:
                reach = so_far.max() + most[first]
                for one in d.tolist():
                    self.read += self._entries(one, w[one], _held(mark) - slack - reach + best[one])
            # Of each list, only what reaches down to that entry can stay below; the rest drops out with it.
            part = self.columns[d] if len(alive) == n else self.columns[d[:, None], alive]
            so_far = so_far + w[d] @ part
            if len(alive) > k:
                mark = max(mark, float(np.partition(so_far, len(alive) - k)[len(alive) - k]) + least[done])
            stays = so_far + most[done] >= _held(mark) - slack
            alive, so_far = alive[stays], so_far[stays]
        score = self.exact(w, alive)
        found = np.lexsort([self.ids[alive], ~score])[:k]  # ~ turns the order about, as - does, for every number
        return alive[found], score[found]


def top_of_blocks(blocks: list, queries: list, k: int, counted: bool = False) -> tuple[list, list, list, int, int]:
    """(query ids, vector ids, scores) of the best k of each query in these blocks, and, if counted, the entries read of those there are."""
    out: tuple[list, list, list] = ([], [], [])
    read = there = 0
    lists = [SortedLists(x, ids, counted) for _, ids, x in blocks]
    for _, q_ids, weights in queries:
        for own, w in zip(q_ids.tolist(), weights, strict=True):
            best: list[tuple[int, int]] = []
            for block in lists:
                mark = float(-best[k - 1][0]) if len(best) >= k else -math.inf
                # A mark that a double can't hold is lowered to one that it can.
                found, score = block.top(w, own, k, mark if abs(mark) < 2.0**53 else mark - abs(mark) * 1e-15)
                best = sorted(best + [(-s, i) for s, i in zip(score.tolist(), block.ids[found].tolist(), strict=True)])[:k]
            out[0].extend([own] * len(best))
            out[1].extend(i for _, i in best)
            out[2].extend(-s for s, _ in best)
        there += len(q_ids) * sum(x.vectors.size for x in lists)
    read += sum(x.read for x in lists)
    return *out, read, there


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each query.

    Queries are the rows whose id is divisible by every, candidates all rows
    with another id. Components count as floor(256 * x); the score is their
    inner product, ties go to the smaller id.

    Defined cases: rows with a null id, and vectors that are null, empty or
    hold a null or non-finite component (or one that is not finite after
    scaling) take no part; scores are exact integers, and those beyond 64
    bits count as the largest or least number of 64 bits; of rows sharing an
    id the one of the least vector counts, so repeated rows count once;
    vectors of another length than the query's aren't its candidates; with
    fewer than k candidates all are returned; an empty table gives an empty
    result; other columns are ignored.
    """
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.lit(256.0) * x.cast("double")) < float("inf")))
    usable = F.col(id_col).isNotNull() & (F.size(vector_col) > 0) & fine
    narrow = F.col(vector_col) if "float" in dict(vectors.dtypes)[vector_col] else F.col(vector_col).cast("array<double>")
    rows = vectors.where(usable).select(F.col(id_col).cast("long").alias("vec_id"), narrow.alias("_v"), F.size(vector_col).cast("long").alias("_dim"))
    asked = rows.where(F.col("vec_id") % every == 0)
    n, n_asked = vectors.count(), vectors.where(F.col(id_col) % every == 0).count()
    n_blocks, n_asks = max(1, -(-n // BLOCK)), max(1, -(-n_asked // QUERY_BLOCK))
    side = max(1, min(SIDE, math.isqrt(n_blocks * n_asks // TILES)))
    tile = F.expr(f"_block div {side}L")
    left = _packed(rows, n, BLOCK).withColumn("_tile", tile).withColumn("_ask", F.explode(F.expr(f"sequence(0L, {(n_asks - 1) // side}L)")))
    right = _packed(asked, n_asked, QUERY_BLOCK).withColumn("_ask", tile).withColumn("_tile", F.explode(F.expr(f"sequence(0L, {(n_blocks - 1) // side}L)")))

    def search(blocks, asks):
        import pyarrow as pa

        if not blocks.num_rows or not asks.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")})
        dim = blocks["_dim"][0].as_py()
        q, v, score, _, _ = top_of_blocks(_unpack(blocks, dim), _unpack(asks, dim), k)
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(score, pa.int64())})

    on = ["_tile", "_ask", "_dim"]
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
