"""Exact top-k by integer inner product with MaxScore over shards.

A vector is a document whose terms are its components. The items are dealt into shards of bounded size; each shard
holds, per term, its postings (one value per item) and their largest and smallest value. A block of queries meets a
shard in one task. For a query the terms are ordered by their score bound in the shard. The terms whose bounds together
stay below the current k-th best score are non-essential: no item can enter the result by them alone. The essential
postings are traversed for all items of the shard; an item goes on to the other terms only while its score so far and
the bounds of what is left are competitive. Shards give k rows per query, which a ranking merges.

Every query is compared with every shard, as the contract asks; what is sent is the queries once per shard and k rows
back. No task holds more than one shard and one batch of queries.

Cases: vectors that are null, empty of terms, or hold a null or a non-finite component take no part (an empty vector
does, with score 0). Shorter vectors count as padded with zeros. Rows that repeat an id are one: of different vectors
the smallest in array order. Null ids take no part. Components are taken as 64-bit integers; sums beyond that are not defined. Other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import column_of, ship, tidy

SHARD_ROWS = 2_048
BLOCK_TERMS = 8
"""Non-essential terms probed between two looks at which items are still competitive."""


def integer_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, terms``: floor(scale * x) of every component of the vectors that take part."""
    fine = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")),
    )
    return (
        embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(fine)
        .select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("terms"))
    )


class Shard:
    def __init__(self, ids: np.ndarray, rows: list[np.ndarray]):
        width = max(map(len, rows), default=0)
        table = np.zeros((len(rows), width))
        for i, row in enumerate(rows):
            table[i, : len(row)] = row
        order = np.argsort(ids, kind="stable")
        self.ids, self.items = ids[order], table[order]
        self.postings = np.ascontiguousarray(self.items.T)
        self.high = self.postings.max(1) if width else np.zeros(0)
        self.low = self.postings.min(1) if width else np.zeros(0)
        # Sums of products of doubles are exact below 2^53; larger values go another way.
        self.exact = np.abs(table).max(initial=0)

    def best(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best items but those of the query's own id, ties to the smaller id."""
        width = self.items.shape[1]
        q = np.zeros(width)
        q[: min(width, len(query))] = query[:width]
        if self.exact * np.abs(q).sum() >= 2**53:
            scores = self.items.astype(np.int64) @ q.astype(np.int64)
            at = np.flatnonzero(self.ids != own)
            return self._first(at, scores[at], k)
        bound = np.maximum(q * self.high, q * self.low)
        order = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0.0)
        # The first items, scored in full, give the threshold to beat.
        seed = self.items[: 8 * k] @ q
        seed = seed[self.ids[: 8 * k] != own]
        limit = np.partition(seed, len(seed) - k)[len(seed) - k] if len(seed) >= k else -np.inf
        essential = int(np.searchsorted(-rest, -limit, "right")) if limit > -np.inf else width
        essential = min(max(essential, 1), width)
        score = q[order[:essential]] @ self.postings[order[:essential]]
        at = np.flatnonzero((score + rest[essential] >= limit) & (self.ids != own))
        score, done = score[at], essential
        while done < width and len(at):
            terms = order[done : done + BLOCK_TERMS]
            score = score + q[terms] @ self.postings[terms][:, at]
            done += len(terms)
            # What the best items are sure to reach raises the threshold.
            if len(at) > k:
                sure = score + np.minimum(q * self.high, q * self.low)[order[done:]].sum()
                limit = max(limit, np.partition(sure, len(sure) - k)[len(sure) - k])
            keep = score + rest[done] >= limit
            at, score = at[keep], score[keep]
        return self._first(at, score.astype(np.int64), k)

    def _first(self, at: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.ids[at], -score))[:k]
        return self.ids[at[order]], score[order]


def _search_step(k: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, rows, shard = None, [], [], None
        for batch in batches:
            out: list[tuple] = []
            numbers = column_of(batch, "shard").to_numpy()
            asks = column_of(batch, "is_query").to_numpy(zero_copy_only=False)
            vec_ids = column_of(batch, "vec_id").to_numpy()
            terms = column_of(batch, "terms")
            flat, offsets = terms.values.to_numpy(), terms.offsets.to_numpy()
            for i in range(len(batch)):
                if numbers[i] != current:
                    current, ids, rows, shard = numbers[i], [], [], None
                vector = flat[offsets[i] : offsets[i + 1]]
                if not asks[i]:
                    ids.append(vec_ids[i])
                    rows.append(vector.copy())
                    continue
                if shard is None:
                    shard = Shard(np.array(ids, np.int64), rows)
                found, score = shard.best(vec_ids[i], vector, k)
                out += [(vec_ids[i], a, b) for a, b in zip(found.tolist(), score.tolist(), strict=True)]
            if out:
                columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    return step


def top_k(items: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``; both inputs have ``vec_id`` and ``terms`` (whole numbers)."""
    ship(items.sparkSession)
    shape = [F.col("vec_id").cast("long").alias("vec_id"), F.col("terms").cast("array<long>").alias("terms")]
    # One vector an id: of several, the smallest in array order.
    items = items.select(*shape).groupBy("vec_id").agg(F.min("terms").alias("terms"))
    queries = queries.select(*shape).groupBy("vec_id").agg(F.min("terms").alias("terms"))
    shards = max(1, -(-items.count() // shard_rows))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    asked = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = dealt.withColumn("is_query", F.lit(False)).unionByName(asked.withColumn("is_query", F.lit(True)))
    found = (
        both.repartition(shards, "shard")
        .sortWithinPartitions("shard", "is_query", "vec_id")
        .mapInArrow(tidy(_search_step(k)), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def report(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k best of every vector whose id is divisible by ``every``."""
    items = integer_vectors(embeddings)
    return top_k(items, items.where(F.col("vec_id") % every == 0), k)
