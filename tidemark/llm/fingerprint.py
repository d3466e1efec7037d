"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Each paragraph (line) hashes to a wide vector; a document's fingerprint is the sum of its paragraphs'
vectors modulo powers of two, so it does not depend on their order, and a paragraph is inserted or
deleted by adding or subtracting its vector.  A vector has two parts: ``WIDE`` lanes of 64 bits, uniform
hashes that decide equality, and ``SIGNS`` lanes of 32 bits, each the sum of signs of all of the
paragraph's character windows, whose inner products estimate how much two multisets of windows share.

Defined results: a null text is the empty text, one empty paragraph; rows with a null doc_id come last in
the order; rows of one doc_id are ordered by a hash of their text; repeated rows stay, each the next of
another; with one row, it is its own next; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import map_arrow

WIDE, SIGNS = 8, 128
#: Code points in a window; all windows count.
WINDOW = 16
#: Windows whose signs are held at a time.
CHUNK = 255 * 32
#: Rows that a range of the ordered pass holds about, and the most ranges (their bounds are literals of the plan).
PART_ROWS, PARTS = 20_000, 8_192
#: Rows that a task returns at once.
OUT_ROWS = 2_048

_BASE = 0x9E3779B97F4A7C15
_MIX = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


@dataclass
class Fingerprint:
    wide: np.ndarray
    signs: np.ndarray

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide + other.wide, self.signs + other.signs)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide - other.wide, self.signs - other.signs)

    def hex(self) -> str:
        return self.wide.astype("<u8").tobytes().hex() + self.signs.astype("<u4").tobytes().hex()

    @classmethod
    def from_hex(cls, text: str) -> Fingerprint:
        raw = bytes.fromhex(text)
        return cls(np.frombuffer(raw, "<u8", WIDE).astype(np.uint64), np.frombuffer(raw, "<u4", SIGNS, 8 * WIDE).astype(np.uint32))


def _sign_sums(hashes: np.ndarray) -> np.ndarray:
    """Per lane, the number of set bits less that of clear ones over all hashes, modulo 2 ** 32."""
    if not len(hashes):
        return np.zeros(SIGNS, np.uint32)
    ones = np.zeros(SIGNS, np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start : start + CHUNK]
        words = np.empty((len(part), SIGNS // 64), np.uint64)
        for k in range(SIGNS // 64):
            x = (part ^ (part >> np.uint64(31))) * _MIX[k]
            words[:, k] = x ^ (x >> np.uint64(33))
        bits = np.unpackbits(words.view(np.uint8), axis=1)
        for at in range(0, len(bits), 255):
            ones += bits[at : at + 255].sum(axis=0, dtype=np.uint8)
    return (2 * ones - len(hashes)).astype(np.uint32)


def fingerprint(text: str) -> Fingerprint:
    """The sum over the text's paragraphs of their vectors; equals the sum of ``fingerprint`` of each."""
    wide, short = np.zeros(WIDE, np.uint64), []
    for paragraph in text.split("\n"):
        digest = hashlib.blake2b(paragraph.encode("utf-8", "surrogatepass"), digest_size=8 * WIDE).digest()
        wide += np.frombuffer(digest, "<u8")
        if 0 < len(paragraph) < WINDOW:
            short.append(int.from_bytes(digest[:8], "little"))
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    hashes = np.array(short, np.uint64)
    if len(code) >= WINDOW:
        h, step = code, 1
        while step < WINDOW:
            h = h[:-step] * np.uint64(pow(_BASE, step, 1 << 64)) + h[step:]
            step *= 2
        h = (h ^ (h >> np.uint64(29))) * _MIX[2]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(code == 10)])
        h = h[ends[WINDOW:] == ends[:-WINDOW]]
        hashes = np.concatenate([hashes, h])
    return Fingerprint(wide, _sign_sums(hashes))


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """1 for equal fingerprints, else twice the estimated common part over the sum of both, within 0 and 1."""
    if np.array_equal(a.wide, b.wide):
        return 1.0
    x, y = a.signs.astype(np.int32).astype(float), b.signs.astype(np.int32).astype(float)
    both = x @ x + y @ y
    return float(min(max(2 * (x @ y) / both, 0.0), 1.0)) if both else 0.0


def edited(text: str, following: str) -> str:
    """``text`` whose last half is replaced by as much of ``following``'s beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _order_id() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(-(2**63)).cast("long"))


def _part(heads: list[tuple[int, int]]) -> Column:
    """The number of the last of ``heads`` (descending) that isn't below the row's (sid, tie), by halving."""
    sids, ties = (F.array(*[F.lit(h[i]).cast("long") for h in heads]) for i in range(2))
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(heads).bit_length()))])

    def step(at: Column, far: Column) -> Column:
        sid, tie = F.get(sids, at + far), F.get(ties, at + far)
        return F.when((at + far < len(heads)) & ((sid > F.col("sid")) | ((sid == F.col("sid")) & (tie >= F.col("tie")))), at + far).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def _dealt(docs: DataFrame, part_rows: int) -> DataFrame:
    """doc_id, text, copies, ahead, each part in order: rows of a range of the order, then the first row of the next range.

    Ranges are Spark's own over the keys alone; a range's first key is both its bound and the row that the
    range before it needs.  Rows of one key are copies; where one has more than a range's rows, its copies
    become one row with a count before the shuffle.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({"sid": _order_id(), "tie": F.xxhash64(F.coalesce("text", F.lit("")))})
    parts = min(PARTS, max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // part_rows)))
    keys = rows.groupBy("sid", "tie").agg(F.count("*").alias("n"))
    ranged = keys.repartitionByRange(parts, F.desc("sid"), F.desc("tie")).groupBy(F.spark_partition_id().alias("part"))
    found = ranged.agg(F.max(F.struct("sid", "tie")).alias("head"), F.max("n").alias("n")).collect()
    heads = sorted(((r["head"]["sid"], r["head"]["tie"]) for r in found), reverse=True) or [(0, 0)]
    rows = rows.withColumn("copies", F.lit(1).cast("long"))
    if max([0, *(r["n"] for r in found)]) > part_rows:
        # At most the number of rows over part_rows keys.
        hot = F.broadcast(spark.createDataFrame(keys.filter(F.col("n") > part_rows).select("sid", "tie").collect(), "sid long, tie long"))
        many = rows.join(hot, ["sid", "tie"], "left_semi").groupBy("sid", "tie").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.sum("copies").alias("copies"))
        rows = rows.join(hot, ["sid", "tie"], "left_anti").unionByName(many)
    rows = rows.withColumn("part", _part(heads))
    sids, ties = (F.array(*[F.lit(h[i]).cast("long") for h in heads]) for i in range(2))
    is_head = (F.get(sids, F.col("part")) == F.col("sid")) & (F.get(ties, F.col("part")) == F.col("tie"))
    place = lambda part, ahead: F.struct(part.cast("int").alias("part"), F.lit(ahead).alias("ahead"))
    own, before = place(F.col("part"), 0), place((F.col("part") + (len(heads) - 1)) % len(heads), 1)
    rows = rows.withColumn("at", F.explode(F.when(is_head, F.array(own, before)).otherwise(F.array(own))))
    rows = rows.select("doc_id", "text", "copies", "sid", "tie", F.col("at.part").alias("part"), F.col("at.ahead").alias("ahead"))
    return rows.repartitionById(len(heads), "part").sortWithinPartitions("ahead", F.desc("sid"), F.desc("tie")).select("doc_id", "text", "copies", "ahead")


def fingerprint_documents(docs: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Fingerprints of whole texts and of their edited texts, with their likeness.

    The next document is the neighbour in one order over all rows.  Texts are shuffled once, by ranges of
    that order; each task goes through its range row by row.
    """

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def result(doc: int | None, text: str, own: Fingerprint, after: str, of_after: Fingerprint) -> tuple:
        new = edited(text, after)
        other = fingerprint(new)
        digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
        return doc, len(text), digest, own.hex(), other.hex(), likeness(own, other), likeness(own, of_after)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bool, int | None, str, Fingerprint] | None = None
        for batch in batches:
            out: list[tuple] = []
            for doc, text, copies, ahead in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last is not None and last[0]:  # rows like the first of the next range: one is enough
                    break
                own = fingerprint(text)
                if last is not None:
                    out.append(result(*last[1:], text, own))
                if copies > 1 and not ahead:
                    same, left = result(doc, text, own, text, own), copies - 1
                    while left:
                        yield packed([same] * min(left, OUT_ROWS))
                        left -= min(left, OUT_ROWS)
                last = (bool(ahead), doc, text, own)
                if len(out) >= OUT_ROWS:
                    yield packed(out)
                    out = []
            if out:
                yield packed(out)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_arrow(_dealt(docs, part_rows), run, schema)
