"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

Features are hashed n-grams of 3 to 5 code points of the lower-cased text, as presence.  From a bounded
sample of labelled rows the log-count ratio of each bucket is taken; the buckets that tell the classes
apart best are kept, and an L2-regularised logistic regression is fitted to presence x ratio x a factor
that falls with the number of buckets present.  Scoring is one narrow pass over whole texts with the
model's table (a fixed size) sent to the tasks: a text is as toxic as its most toxic passage of at most
``PASSAGE`` code points, so neither chance hits of a long text add up nor is one passage thinned out by it.

Bounds of the training sample (nothing else is sampled): of the labelled texts of at most
``SAMPLE_CHARS`` code points, ``SAMPLE`` rows of either class, those of least hash of doc_id, as far as
half of ``SAMPLE_TOTAL`` code points go; of a repeated doc_id the text of least hash.

Defined results: a null text is the empty text and scores as the model's intercept; repeated rows stay;
a null label or a null doc_id in labels is no label, repeated labels count once (toxic wins); without
labelled rows of both classes every score is the share of toxic ones; an empty table gives no rows;
extra columns are ignored by ``score`` and kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import map_arrow

SAMPLE = 4_000
SAMPLE_CHARS = 20_000
SAMPLE_TOTAL = 40_000_000
#: Code points of a scored passage, and the distinct buckets at which a row's values count as they are.
PASSAGE = 2_500
USUAL_BUCKETS = 2_500
BUCKET_BITS = 20
SIZES = (3, 4, 5)
#: Buckets kept, and the rows of the sample that a kept bucket occurs in at least.
KEPT = 4_096
LEAST_ROWS = 5
SMOOTHING = 1.0
DECAY = 1.0
THRESHOLD = 0.7

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


class Buckets:
    """Distinct hashed n-grams of a text; the scratch table is kept between calls."""

    def __init__(self) -> None:
        self.seen = np.zeros(1 << BUCKET_BITS, np.int32)

    def of(self, text: str) -> np.ndarray:
        code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        gram, found = code, []
        for n in range(2, max(SIZES) + 1):
            if len(gram) < 2:
                break
            gram = gram[:-1] * _BASE + code[n - 1 :]
            if n in SIZES:
                mixed = (gram ^ (gram >> np.uint64(29))) * _MIX[n - SIZES[0]]
                found.append((mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        if not found:
            return np.zeros(0, np.int32)
        every = np.concatenate(found)
        order = np.arange(len(every), dtype=np.int32)
        self.seen[every] = order
        return every[self.seen[every] == order]


def passages(text: str) -> list[str]:
    """Equal parts of at most ``PASSAGE`` code points, each with the few before it that its first n-grams need."""
    n = max(1, -(-len(text) // PASSAGE))
    step = -(-len(text) // n)
    return [text[max(0, i * step - max(SIZES) + 1) : (i + 1) * step] for i in range(n)]


def _scale(n: int) -> float:
    """The factor of the values of a row with ``n`` buckets: 1 at ``USUAL_BUCKETS``, 2 at most."""
    return 2 * USUAL_BUCKETS / (n + USUAL_BUCKETS)


@dataclass(frozen=True)
class ToxicModel:
    """``weights``: one for each bucket, ratio and regression weight in one; ``bias``: the intercept."""

    weights: np.ndarray
    bias: float


def _logistic(rows: list[np.ndarray], scale: np.ndarray, ratio: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Newton steps by conjugate gradients; ``rows``: positions of the features present; ``scale``: a factor for each row."""
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    owner = np.repeat(np.arange(len(rows)), sizes)
    value = ratio[flat] * scale[owner]
    forward = lambda w, b: np.bincount(owner, value * w[flat], len(rows)) + b
    backward = lambda g: np.bincount(flat, value * g[owner], len(ratio))
    w, b = np.zeros(len(ratio)), 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(forward(w, b), -40, 40)))
        g = weight * (p - target)
        gw, gb = backward(g) + DECAY * w, g.sum()
        curve = np.maximum(weight * p * (1 - p), 1e-6)
        xw, xb = np.zeros_like(w), 0.0
        rw, rb = -gw, -gb
        dw, db = rw.copy(), rb
        size = rw @ rw + rb * rb
        start = size
        for _ in range(40):
            if size <= 1e-6 * start or size == 0:
                break
            a = curve * forward(dw, db)
            hw, hb = backward(a) + DECAY * dw, a.sum()
            step = size / (dw @ hw + db * hb)
            xw, xb = xw + step * dw, xb + step * db
            rw, rb = rw - step * hw, rb - step * hb
            size, old = rw @ rw + rb * rb, size
            dw, db = rw + size / old * dw, rb + size / old * db
        w, b = w + xw, b + xb
        if np.abs(xw).max(initial=0) < 1e-4 and abs(xb) < 1e-4:
            break
    return w, b


def train(texts: list[str], toxic: np.ndarray, share: float) -> ToxicModel:
    """Fits a model to labelled texts; ``share``: how many of all labelled rows are toxic."""
    buckets, size = Buckets(), 1 << BUCKET_BITS
    toxic = np.asarray(toxic, bool)
    bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    if not toxic.any() or toxic.all():
        return ToxicModel(np.zeros(size, np.float32), bias)
    seen = [buckets.of(t) for t in texts]
    counts = np.zeros((2, size))
    for label, found in zip(toxic, seen, strict=True):
        counts[int(label), found] += 1
    rows = np.array([(~toxic).sum(), toxic.sum()], float)
    p, q = (counts[1] + SMOOTHING) / (rows[1] + 2 * SMOOTHING), (counts[0] + SMOOTHING) / (rows[0] + 2 * SMOOTHING)
    both = counts.sum(0) / rows.sum()
    chi = (p - q) ** 2 / (both * (1 - both) * (1 / rows[0] + 1 / rows[1]) + 1e-9)
    chi[counts.sum(0) < LEAST_ROWS] = 0
    kept = np.argsort(-chi, kind="stable")[:KEPT]
    kept = kept[chi[kept] > 0]
    place = np.full(size, -1)
    place[kept] = np.arange(len(kept))
    ratio = np.log(p[kept] / q[kept])
    at = [x[x >= 0] for x in (place[found] for found in seen)]
    wanted = np.array([1 - share, share])
    weight = np.where(toxic, wanted[1] * rows.sum() / rows[1], wanted[0] * rows.sum() / rows[0])
    scale = np.array([_scale(len(found)) for found in seen])
    w, b = _logistic(at, scale, ratio, toxic.astype(float), weight)
    weights = np.zeros(size, np.float32)
    weights[kept] = w * ratio
    return ToxicModel(weights, float(b))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's label is never learnt from: crc32 of its id as text, mod 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(doc_id).cast("string"), "utf-8")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicModel:
    """Fits a model to documents whose labels may be learnt; see the module on the sample's bounds."""
    spark = docs.sparkSession
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).select("doc_id", (F.col("toxic") > 0).alias("toxic"))
    total = known.agg(F.count("*").alias("n"), F.count_if("toxic").alias("t")).first()
    sizes = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n")).filter(F.col("n") <= SAMPLE_CHARS)
    usable = known.join(sizes, "doc_id").groupBy("doc_id", "toxic").agg(F.max("n").alias("n"))
    ids = []
    for flag in (True, False):
        left = SAMPLE_TOTAL // 2
        for r in usable.filter(F.col("toxic") == flag).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).collect():
            left -= r["n"]
            if left >= 0:
                ids.append(r)
    chosen = F.broadcast(spark.createDataFrame([(r["doc_id"], r["toxic"]) for r in ids], "doc_id long, toxic boolean"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    rows = rows.filter(F.length("text") <= SAMPLE_CHARS).groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "toxic", "text")).alias("row")).select("doc_id", "row.text", "row.toxic").collect()
    rows.sort(key=lambda r: r["doc_id"])
    return train([r["text"] for r in rows], np.array([r["toxic"] for r in rows], bool), total["t"] / max(total["n"], 1))


def _scores(texts: list[str | None], model: ToxicModel, buckets: Buckets) -> np.ndarray:
    def of(passage: str) -> float:
        found = buckets.of(passage)
        return float(model.weights[found].sum(dtype=np.float64)) * _scale(len(found)) + model.bias

    z = np.array([max(map(of, passages(t or ""))) for t in texts])
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def score(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 if score >= threshold) of whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            got = _scores(batch.column(2).to_pylist(), shared.value, buckets)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got), pa.array((got >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return map_arrow(docs.select("doc_id", held_out().alias("held_out"), "text"), run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose texts score under the threshold, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column("text").to_pylist(), shared.value, buckets) < threshold))

    return map_arrow(docs, run, docs.schema)
