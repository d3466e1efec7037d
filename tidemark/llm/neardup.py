"""Near-duplicate classes by BagMinHash over multisets of word shingles.

A document is the multiset of its 5-word shingles (lower-cased words between blanks; a text of fewer
words is one shingle of all).  Its signature's component i is the first point that reaches i in Poisson
processes over (shingle, weight interval): intervals are dyadic, [0, 1), [1, 2), [2, 4), ..., each with a
process whose rate is its length, and a point counts if its place in the interval, fixed by the point's
hash, lies under the shingle's weight.  Equal components estimate weighted Jaccard without bias.
Signatures are banded, candidates verified on the multisets, and links joined to classes.

No pair list of a bucket is made: its rows are compared with a hub, and the hub's links joined to classes.
Buckets that still hold several classes are cut into blocks of bounded size; each pair of blocks meets in
one task, which multiplies their element matrices and returns only links between different classes.  So
every pair that shares a band and might join two classes is verified.  A pair at the threshold shares no band
with probability (1 - 0.8 ** 5) ** 32, 3e-6.

Defined results: texts without words (null, empty, blank) link to nothing, their class is their doc_id and
``keep_one`` keeps them all; each distinct text of a repeated doc_id is a text of its own; rows without a
doc_id come after all others, so a class of such rows alone has a null class_id, and one of its texts
stays; repeated rows are one; an empty table gives none; extra columns are ignored by ``classes`` and
kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tidemark.llm.shared import cut, map_arrow

WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 32, 5
#: Rows of a block of a bucket whose rows are compared across classes.
BLOCK = 256
#: Elements that are multiplied at once there.
ELEMENTS = 16_384
#: Rounds of contraction; each leaves at most half of a component's nodes on average.
ROUNDS = 99
#: The id of rows without a doc_id, behind all others (and a doc_id of this value is taken as none).
LAST = (1 << 63) - 1


_U = np.uint64
_M1, _M2, _STEP = _U(0xFF51AFD7ED558CCD), _U(0xC4CEB9FE1A85EC53), _U(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D
_PLACES = np.array([pow(_BASE, 3 * i + 1, 1 << 64) | 1 for i in range(WORDS)], _U)
_BLANK = np.zeros(0x3001, bool)
_BLANK[[*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _M1
    x = (x ^ (x >> _U(33))) * _M2
    return x ^ (x >> _U(33))


class Powers:
    """Powers of the word hash's base and of its inverse modulo 2 ** 64, as many as asked for."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, _U), np.ones(1, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * _U(pow(_BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * _U(pow(_BASE, -k, 1 << 64))])
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes in ascending order, and how often each occurs."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    inside = np.zeros(len(code) + 2, bool)
    inside[1:-1] = ~_BLANK[np.minimum(code, 0x3000)] | (code > 0x3000)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    up, down = _POWERS.get(len(code) + 1)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum((code.astype(_U) + _U(1)) * up[:-1])])
    words = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U) * _STEP)
    if len(words) < WORDS:
        rows = np.array([(words * _PLACES[: len(words)]).sum(dtype=_U)], _U)
    else:
        rows = sum(words[i : len(words) - WORDS + 1 + i] * _PLACES[i] for i in range(WORDS))
    return np.unique(_mix(rows), return_counts=True)


def elements(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The multiset as a sorted set: one hash for each occurrence of each key."""
    firsts = np.cumsum(weights) - weights
    turn = np.arange(int(weights.sum())) - np.repeat(firsts, weights)
    return np.sort(_mix(np.repeat(keys, weights) + turn.astype(_U) * _STEP))


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Overlap of two multisets given as ``elements``: the sum of least weights over that of greatest."""
    both = np.sort(np.concatenate([a, b]))
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(a) + len(b) - common) if common else 0.0


def signature(keys: np.ndarray, weights: np.ndarray, size: int = BANDS * BAND_ROWS) -> np.ndarray:
    """The BagMinHash signature: ``size`` first-arrival times."""
    total = float(weights.sum())
    levels = []
    top = int(weights.max()).bit_length()
    for k in range(top + 1):
        low, length = (0, 1) if k == 0 else (1 << (k - 1), 1 << (k - 1))
        at = np.flatnonzero(weights > low)
        if len(at):
            levels.append((_mix(keys[at] ^ _mix(np.array([k], _U))), weights[at] - low, length))
    limit = size * (np.log(size) + 2.5) / total
    while True:
        out = np.full(size, np.inf)
        for seeds, room, length in levels:
            time, point = np.zeros(len(seeds)), 1
            while len(seeds):
                ahead = int(min(max(1.2 * (limit - time.min()) * length, 0) + 2, 512))
                h = _mix(seeds[:, None] + np.arange(point, point + ahead).astype(_U) * _STEP)
                gap = -np.log(((h >> _U(32)).astype(float) + 0.5) / 2.0**32) / length
                arrive = time[:, None] + np.cumsum(gap, axis=1)
                good = arrive <= limit
                if length > 1 or (room < 1).any():
                    place = (_mix(h ^ _STEP) >> _U(11)).astype(float) / 2.0**53 * length
                    good &= place < room[:, None]
                hit = h[good]
                np.minimum.at(out, ((hit & _U(0xFFFFFFFF)) * _U(size) >> _U(32)).astype(np.int64), arrive[good])
                more = arrive[:, -1] <= limit
                seeds, room, time, point = seeds[more], room[more], arrive[more, -1], point + ahead
        if out.max() <= limit:
            return out
        limit *= 2


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A hash of each band of a signature, with its number."""
    rows = sig.view(_U).reshape(BANDS, BAND_ROWS)
    return _mix((_mix(rows) * _PLACES[:BAND_ROWS]).sum(axis=1, dtype=_U) + np.arange(BANDS).astype(_U) * _STEP)


def _digest(found: np.ndarray, weights: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a multiset of shingles."""
    each = _mix(found + weights.astype(_U) * _M1)
    return int(each.sum(dtype=_U).astype(np.int64)), int(_mix(each ^ _STEP).sum(dtype=_U).astype(np.int64))


def _id() -> Column:
    """The order of documents: by doc_id, those without one last."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, two hashes of the multiset and the band keys (null for a text without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second, keys = [], [], []
            for text in batch.column(1).to_pylist():
                found, weights = shingles(text or "")
                h1, h2 = _digest(found, weights) if len(found) else (None, None)
                first.append(h1)
                second.append(h2)
                keys.append(band_keys(signature(found, weights)).astype(np.int64) if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "h1", "h2", "bands"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, h1 long, h2 long, bands array<long>")


def _elements_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, elements) of the texts in ``nodes`` (node, first, h1, h2): a row of each, or one a task where rows repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            names, blobs = [], []
            for node, h1, h2, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if node not in seen:
                    found, weights = shingles(text or "")
                    if len(found) and _digest(found, weights) == (h1, h2):  # else another text of the same doc_id
                        seen.add(node)
                        names.append(node)
                        blobs.append(elements(found, weights).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blobs, pa.large_binary()).cast(pa.binary())], names=["node", "elements"])

    rows = docs.select(_id().alias("first"), "text").join(nodes, "first")
    return map_arrow(rows.select("node", "h1", "h2", "text"), run, "node long, elements binary")


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose multisets overlap by ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            good = [weighted_jaccard(np.frombuffer(x, _U), np.frombuffer(y, _U)) >= least for x, y in zip(a, b, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("elements").alias("ea")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("elements").alias("eb")), "b")
    return map_arrow(both.select("a", "b", "ea", "eb"), run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b): equal labels for connected nodes.

    Rounds of contraction: each node hooks on to the neighbour (or itself) of least hash, links are
    redrawn between the hooks, until none is left.  Every round is written to the shared folder.
    """
    edges = cut(links.filter("a <> b").select("a", "b").distinct(), "edges")
    both = lambda e: e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = None
    for turn in range(1, ROUNDS + 1):
        if edges.isEmpty():
            break
        rank = lambda c, t=turn: F.xxhash64(F.col(c), F.lit(t))
        near = both(edges).groupBy("a").agg(F.min(rank("b")).alias("least"), F.min_by("b", rank("b")).alias("to"))
        hooks = near.select(F.col("a").alias("node"), F.when(F.col("least") < rank("a"), F.col("to")).otherwise(F.col("a")).alias("hook"))
        hooks = cut(hooks, "hooks")
        if labels is None:
            labels = hooks.select("node", F.col("hook").alias("label"))
        else:
            step = hooks.select(F.col("node").alias("label"), F.col("hook").alias("next"))
            labels = labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
        labels = cut(labels, "labels")
        at = lambda name: hooks.select(F.col("node").alias(name), F.col("hook").alias(f"{name}_hook"))
        moved = edges.join(at("a"), "a").join(at("b"), "b").select(F.least("a_hook", "b_hook").alias("a"), F.greatest("a_hook", "b_hook").alias("b"))
        edges = cut(moved.filter("a <> b").distinct(), "edges")
    if not edges.isEmpty():
        raise RuntimeError(f"links are left after {ROUNDS} rounds of contraction")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label")).limit(0)
    return labels


def _rank() -> Column:
    """An order of nodes for choosing a bucket's hub; one of four, by the bucket."""
    return F.xxhash64("node", F.pmod("key", F.lit(4)))


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of blocks of the sets' membership matrix."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, at, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = seen[at] > 1
    owner, at = owner[common], (np.cumsum(seen > 1) - 1)[at[common]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, ELEMENTS):
        a, b = np.searchsorted(at, [low, low + ELEMENTS])
        part = np.zeros((len(sets), min(ELEMENTS, int(at[-1]) + 1 - low)), np.float32)
        part[owner[a:b], at[a:b] - low] = 1
        out += part @ part.T
    return out


def _across(rows: DataFrame, labels: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between different classes of ``labels`` within the buckets of ``rows`` (key, node)."""
    placed = rows.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    buckets = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("members"))
    # Of buckets with the same members one is enough.
    buckets = buckets.filter("low <> high").groupBy("members", "n").agg(F.min("key").alias("key"))
    buckets = buckets.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    spot = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    held = cut(placed.join(buckets, "key").select("key", "node", "label", spot.alias("spot"), "blocks"), "mixed")
    held = held.join(texts.dropDuplicates(["node"]), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    held = held.select("key", F.least("spot", "other").alias("lo"), F.greatest("spot", "other").alias("hi"), "spot", "node", "label", "elements")

    def meet(t: pa.Table) -> pa.Table:
        node, label, spot = (t[c].to_numpy() for c in ("node", "label", "spot"))
        sets = [np.frombuffer(x, _U) for x in t["elements"].to_pylist()]
        size = np.array([len(x) for x in sets], float)
        common = _overlaps(sets)
        good = common >= least * (size[:, None] + size[None, :] - common)
        good &= label[:, None] != label[None, :]
        if t["lo"][0] != t["hi"][0]:
            good &= spot[:, None] != spot[None, :]
        x, y = np.nonzero(np.triu(good, 1))
        return pa.table({"a": np.maximum(node[x], node[y]), "b": np.minimum(node[x], node[y])})

    return held.groupBy("key", "lo", "hi").applyInArrow(meet, "a long, b long").distinct()


def _by_text(docs: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and for each distinct multiset (h1, h2) its class: first (least id of the text's rows),
    class_first (that of the class) and chosen (whether the text stands for its class).

    Texts, not doc_ids, are the nodes that are linked, so a doc_id with several texts has several nodes.
    """
    signed = cut(_signed(docs), "signed")
    known = signed.filter(F.col("h1").isNotNull())
    made = known.groupBy("h1", "h2").agg(F.min(_id()).alias("first"), F.first("bands").alias("bands"))
    nodes = cut(made.withColumn("node", F.monotonically_increasing_id()), "nodes")
    rows = nodes.select("node", F.explode("bands").alias("key"))
    hubs = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.min_by("node", _rank()).alias("hub")).filter("low <> high")
    shared = cut(rows.join(hubs.select("key", "hub"), "key").distinct(), "shared")

    pairs = cut(shared.filter("node <> hub").select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct(), "pairs")
    wanted = nodes.select("node", "first", "h1", "h2").join(shared.select("node").distinct(), "node", "left_semi")
    texts = cut(_elements_of(docs, wanted), "elements")
    links = cut(_verified(pairs, texts, least), "links")
    labels = components(links)

    late = cut(_across(shared.select("key", "node"), labels, texts, least), "late")
    if not late.isEmpty():
        labels = components(links.union(late))

    plain = nodes.select("h1", "h2", "first", "node")
    named = labels.join(plain.select("node", F.struct("first", "node").alias("place")), "node")
    best = named.groupBy("label").agg(F.min("place").alias("best"))
    named = named.join(best, "label").select("node", F.col("best.first").alias("class_first"), (F.col("best.node") == F.col("node")).alias("chosen"))
    out = plain.join(named, "node", "left")
    return signed, out.select("h1", "h2", "first", F.coalesce("class_first", "first").alias("class_first"), F.coalesce("chosen", F.lit(True)).alias("chosen"))


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) for each row of ``docs``: the smallest doc_id of its near-duplicate class."""
    signed, texts = _by_text(docs, least)
    joined = signed.select("doc_id", "h1", "h2").join(texts.select("h1", "h2", "class_first"), ["h1", "h2"], "left")
    found = F.when(F.col("class_first") != LAST, F.col("class_first"))
    return joined.select("doc_id", F.when(F.col("h1").isNull(), F.col("doc_id")).otherwise(found).alias("class_id"))


def keep_one(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class, that of the smallest doc_id; rows without words all stay."""
    _, texts = _by_text(docs, least)
    kept = cut(texts.filter("chosen").select(F.col("first").alias("__near_id"), F.col("h1").alias("__near_h1"), F.col("h2").alias("__near_h2")), "kept")
    keys = ["__near_id", "__near_h1", "__near_h2"]
    wide = docs.withColumn("__near_id", _id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int, int]] = set()
        turn = TaskContext.get().partitionId() << 36
        for batch in batches:
            stays, first, second, blank = [], [], [], []
            for key, text in zip(batch.column("__near_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found, weights = shingles(text or "")
                turn += 1
                h1, h2 = _digest(found, weights) if len(found) else (turn, turn)
                stays.append(not len(found) or (key, h1, h2) not in seen)
                if len(found):
                    seen.add((key, h1, h2))
                first.append(h1)
                second.append(h2)
                blank.append(not len(found))
            made = [pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(blank, pa.bool_())]
            out = pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "__near_h1", "__near_h2", "__near_blank"])
            yield out.filter(pa.array(stays, pa.bool_()))

    schema = StructType([*wide.schema.fields, *(StructField(n, LongType()) for n in keys[1:]), StructField("__near_blank", BooleanType())])
    marked = map_arrow(wide, run, schema).join(kept.withColumn("__near_kept", F.lit(True)), keys, "left")
    return marked.filter("__near_blank or __near_kept").dropDuplicates(keys).select(*docs.columns)
