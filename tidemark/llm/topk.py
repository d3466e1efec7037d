"""Exact top-k inner products by a bit-sliced index.

Vectors are quantised to integers and dealt into blocks.  In a block every attribute is kept as bit
slices, bitmaps over the block's rows.  A query's score is a sum of attribute slices weighted by powers
of two (the bits of the query), added column by column with carry-save adders on bitmaps; attributes with
a negative weight enter complemented, so all terms are non-negative.  The k best rows are then marked
from the most significant score slice down, and rows tied at the boundary are resolved by id.

Queries and rows meet in a grid: rows by blocks, queries by chunks, each pair in one task with bounded
memory.  No broadcast and nothing collected.

Defined results: vectors that are null or hold a null or non-finite component, or whose id is null, take
no part; vectors of another length than a query's have no product with it; a query id that repeats is
taken once, with the least of its vectors; candidates that repeat count each by itself, but none with the
query's own id; a component, or one of the k best scores of a block, that leaves 64 bits raises an error (sums are exact
however many bits they take, so nothing else is bounded); empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 4_096
CHUNK_QUERIES = 4_096
#: Quantised components from this on are no 64-bit integers and raise an error.
LARGEST = 1 << 63


def quantise(vectors: DataFrame, scale: int = 1024, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id long, v array<long>) with floor(scale * x) for each component, of the vectors that take part."""
    d = F.transform(vector, lambda x: x.cast("double"))
    fine = F.col(vector).isNotNull() & F.col(key).isNotNull() & ~F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(d, lambda x: F.when(F.abs(x) * scale < float(LARGEST), F.floor(x * scale)).otherwise(F.raise_error(F.lit("vector component too large for 64 bits")).cast("long")))
    return vectors.filter(fine).select(F.col(key).cast("long").alias("vec_id"), whole.alias("v"))


def _bitmaps(bits: np.ndarray) -> np.ndarray:
    """Bitmaps (last axis in 64-bit words) of a boolean array whose last axis is rows."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    short = -packed.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, short)])).view(np.uint64)


class BlockIndex:
    """Bit slices of a block of vectors of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")  # so that of tied rows the first set bits are the smaller ids
        self.ids, vectors = ids[order], vectors[order]
        self.low = vectors.min(initial=0)
        raised = (vectors - self.low).view(np.uint64).T  # the difference, though it may wrap as a signed one
        self.bits = max(1, int(raised.max(initial=0)).bit_length())
        self.top = (1 << self.bits) - 1
        self.every = _bitmaps(np.ones(len(ids), bool))
        self.slices = np.stack([_bitmaps((raised >> np.uint64(b) & np.uint64(1)).astype(bool)) for b in range(self.bits)], axis=1)
        self.flipped = ~self.slices & self.every

    def score_slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the sum, least significant first, and the constant that turns it into the score."""
        size = np.abs(query).view(np.uint64)
        columns: dict[int, list[np.ndarray]] = {}
        for i in range(int(size.max(initial=0)).bit_length()):
            on = size >> np.uint64(i) & np.uint64(1) == 1
            terms = np.concatenate([self.slices[on & (query > 0)], self.flipped[on & (query < 0)]])
            if len(terms):
                for j in range(self.bits):
                    columns.setdefault(i + j, []).append(terms[:, j])
        out, at = [], 0
        while columns:
            stack = columns.pop(at, None)
            bits = np.concatenate(stack) if stack else np.zeros((0, len(self.every)), np.uint64)
            while len(bits) > 1:
                if len(bits) == 2:
                    bits = np.concatenate([bits, np.zeros_like(bits[:1])])
                third = len(bits) // 3
                a, b, c = bits[:third], bits[third : 2 * third], bits[2 * third : 3 * third]
                half = a ^ b
                columns.setdefault(at + 1, []).append(a & b | c & half)
                bits = np.concatenate([half ^ c, bits[3 * third :]])
            out.append(bits[0] if len(bits) else np.zeros_like(self.every))
            at += 1
        constant = sum(query.tolist()) * int(self.low) - self.top * sum(size[query < 0].tolist())
        return out, constant

    def best(self, key: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(id, score) of the k best rows other than ``key``'s own, ties to smaller ids."""
        slices, constant = self.score_slices(query)
        open_rows, sure = self.every, np.zeros_like(self.every)
        lo, hi = np.searchsorted(self.ids, [key, key + 1])
        if hi > lo:
            mine = np.zeros(len(self.ids), bool)
            mine[lo:hi] = True
            open_rows = open_rows & ~_bitmaps(mine)
        for one in reversed(slices):
            with_it = open_rows & one
            n = int(np.bitwise_count(sure | with_it).sum())
            if n > k:
                open_rows = with_it
            else:
                sure, open_rows = sure | with_it, open_rows & ~one
                if n == k:
                    break
        at = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
        if len(at) < k:
            more = np.flatnonzero(np.unpackbits(open_rows.view(np.uint8), bitorder="little"))
            at = np.concatenate([at, more[: k - len(at)]])
        score = [constant] * len(at)
        for b, one in enumerate(slices):
            bit = (one[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).tolist()
            score = [s + (x << b) for s, x in zip(score, bit, strict=True)]
        if score and not -LARGEST <= min(score) <= max(score) < LARGEST:
            raise OverflowError("a score leaves 64 bits")
        return list(zip(self.ids[at].tolist(), score, strict=True))


def _matrix(column: pa.ChunkedArray) -> list[np.ndarray]:
    flat = column.combine_chunks()
    values, ends = flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(flat.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(values, ends[:-1])


def _by_length(ids: np.ndarray, vectors: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        yield n, ids[at], np.array([vectors[i] for i in at], np.int64).reshape(len(at), n)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best rows.  Both inputs: (vec_id, v)."""
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-rows.count() // block_rows))
    chunks = max(1, -(-queries.count() // chunk_queries))
    spread = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select(spread(blocks, 1).alias("block"), "vec_id", "v").select("*", every(chunks).alias("chunk"))
    right = queries.select(spread(chunks, 2).alias("chunk"), "vec_id", "v").select("*", every(blocks).alias("block"))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if a.num_rows and b.num_rows:
            wanted = {n: (ids, vs) for n, ids, vs in _by_length(b["vec_id"].to_numpy(), _matrix(b["v"]))}
            for n, ids, vectors in _by_length(a["vec_id"].to_numpy(), _matrix(a["v"])):
                if n in wanted:
                    index = BlockIndex(ids, vectors)
                    for key, query in zip(*wanted[n], strict=True):
                        out += [(int(key), i, s) for i, s in index.best(int(key), query, k)]
        columns = list(zip(*out, strict=True)) if out else [[]] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    near = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(meet, "query_id long, vec_id long, score long")
    order = "row_number() over (partition by query_id order by score desc, vec_id)"
    return near.withColumn("rank", F.expr(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
