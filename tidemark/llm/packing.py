"""Cost-balanced packing of documents into sequences of a fixed capacity.

The cost of a piece of n tokens is ``linear * n + quadratic * n * n`` (the quadratic part is attention
within the piece).  Each task packs the documents of its own partition in groups of about
``group_tokens``: a group of T tokens gets T // capacity whole sequences and sequences of powers of two
for the rest, so that nothing is padded.  Documents go in descending order of cost, each whole into the
sequence of lowest cost that has room for it, or else cut over those of lowest cost that have any room.

No shuffle: what a task holds is one group's ids.  Sequence ids are (partition, running number), so a
task that runs again gives the same ids for the same rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tidemark.llm.bpe import Merges, Words, batched, merged, utf8, whole_texts
from tidemark.llm.shared import map_arrow

CAPACITY = 4096
GROUP_TOKENS = 1 << 21
#: Cost of a token, and of a pair of tokens of one piece.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
#: The id that ends a document.
END_ID = 2

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def capacities(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Room of a group's sequences, ``tokens`` in all: whole ones, then the bits of the rest."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(lengths: list[int], capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of the given token counts.

    Every token lies in one piece, offsets are gapless from 0 and all sequences are full; zero-length
    documents have no piece.  Ties go to the earlier document and the earlier sequence.
    """
    room = np.array(capacities(sum(lengths), capacity), np.int64)
    cost, used = np.zeros(len(room)), np.zeros(len(room), np.int64)
    sequence, pieces = 0, []

    def put(doc: int, start: int, n: int, into: int) -> None:
        pieces.append((doc, start, n, into, int(used[into])))
        used[into] += n
        room[into] -= n
        cost[into] = cost[into] + linear * n + quadratic * n * n if room[into] else np.inf

    rest = []
    for doc, n in enumerate(lengths):
        start = 0
        while n - start >= capacity:
            put(doc, start, capacity, sequence)
            sequence, start = sequence + 1, start + capacity
        if start < n:
            rest.append((start - n, doc, start))
    for left, doc, start in sorted(rest):
        left = -left
        fits = np.where(room >= left, cost, np.inf)
        best = int(fits.argmin()) if len(fits) else 0
        if len(fits) and fits[best] < np.inf:
            put(doc, start, left, best)
            continue
        while left:
            best = int(cost.argmin())
            n = int(min(left, room[best]))
            put(doc, start, n, best)
            start, left = start + n, left - n
    return pieces


class WordEncoder(Words):
    """Ids of ``tokenizers`` for texts, by words: the library itself for those beyond Latin-1 print.

    Blanks always part tokens here.  Plain words go through the segment trees of ``bpe`` with the
    vocabulary's own merges; what stands between blanks and isn't plain is one word for the library.  A
    text that holds an added token is encoded whole by the library, as its ids are not those of its words.
    """

    def __init__(self, path: str):
        super().__init__()
        self.hf = Tokenizer.from_file(path)
        self.hf.encode_special_tokens = True
        self.whole = Tokenizer.from_file(path)
        self.added = "(?i)" + "|".join(re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values())
        with open(path) as file:
            model = json.load(file)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, joined = (np.array([vocab[x] for x in col], np.int64) for col in zip(*[(a, b, a + b) for a, b in pairs], strict=True))
        self.merges = Merges(left, right, np.arange(len(pairs)), joined)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        chars = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(shown))}
        self.inner = np.array([vocab[chars[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[chars[b] + suffix] for b in range(256)], np.int64)
        #: By code point: plain ones (print and the blanks below), and their lower case.
        self.plain = np.zeros(0x110000, bool)
        self.plain[[9, 10, 13, 32, *shown]] = True
        self.lower = np.array([ord(c) if len(c := chr(i).lower()) == 1 else i for i in range(256)], np.uint32)

    def prepare(self, codes: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        odd = ~self.plain[codes]
        low = np.where(odd, codes, self.lower[np.minimum(codes, 255)])
        kinds = self.kinds[codes]
        begins = lead | (kinds == 2)
        begins[1:] |= kinds[1:] != kinds[:-1]
        self.contractions(low, kinds, begins, lead)
        counted = kinds != 0
        if odd.any():
            inside = (codes != 32) & (codes != 10) & (codes != 9) & (codes != 13)
            opens = inside.copy()
            opens[1:] &= ~inside[:-1] | lead[1:]
            chunk = np.cumsum(opens) - 1
            foreign = np.zeros(int(chunk[-1]) + 1, bool)
            foreign[chunk[odd]] = True
            mine = inside & foreign[np.maximum(chunk, 0)]
            begins[mine] = opens[mine]
            begins[1:] |= mine[:-1] & ~mine[1:]
            low, counted = np.where(mine, codes, low), counted | mine
        starts = np.flatnonzero(begins)
        return low, starts, counted[starts]

    def encode_words(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        plain = np.logical_and.reduceat(self.plain[codes], np.cumsum(sizes) - sizes)
        raw, n = utf8(codes[np.repeat(plain, sizes)], sizes[plain])
        flat, ends = self.inner[raw], np.cumsum(n) - 1
        flat[ends] = self.last[raw[ends]]
        ids, counts = self.merges.encode(flat, n)
        if plain.all():
            return ids, counts
        ends = np.cumsum(sizes)
        other = [codes[b - n : b].astype("<u4").tobytes().decode("utf-32-le") for n, b in zip(sizes[~plain].tolist(), ends[~plain].tolist(), strict=True)]
        return merged(plain, ids, counts, *_library(self.hf, other))

    def encode(self, texts: pa.Array, cut_long: bool = True) -> tuple[np.ndarray, np.ndarray]:
        holding = pc.match_substring_regex(texts, self.added).to_numpy(zero_copy_only=False)
        if not holding.any():
            return super().encode(texts, cut_long)
        ids, counts = super().encode(texts.filter(pa.array(~holding)), cut_long)
        return merged(~holding, ids, counts, *_library(self.whole, texts.filter(pa.array(holding)).to_pylist()))


def _library(tokenizer: Tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    found = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))


#: Encoders of this Python worker by file; their caches are empty between tasks.
_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def pack_documents(docs: DataFrame, path: str, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) packed into sequences of ``CAPACITY`` tokens.

    doc_id, start, length, ids_crc32 (of the piece's ids as little-endian 32-bit integers), doc_tokens,
    sequence_id, offset.  A null text is empty and gives its end token alone; null and repeated doc_ids
    are documents of their own; an empty table gives no piece; extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        held: list[tuple[int | None, np.ndarray]] = []
        tokens, next_sequence = 0, TaskContext.get().partitionId() << 36

        def flush() -> pa.RecordBatch:
            nonlocal held, tokens, next_sequence
            sizes = [len(ids) for _, ids in held]
            rows = []
            for doc, start, n, sequence, offset in pack(sizes):
                crc = zlib.crc32(held[doc][1][start : start + n])
                rows.append((held[doc][0], start, n, crc, sizes[doc], next_sequence + sequence, offset))
            next_sequence += len(capacities(tokens))
            held, tokens = [], 0
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        try:
            for batch in batches:
                docs_of, at = batch.column(0).to_pylist(), 0
                for texts in batched(whole_texts(batch.column(1))):
                    ids, counts = words.encode(texts)
                    n = len(counts)
                    ids, _ = merged(np.arange(2 * n) % 2 == 0, ids, counts, np.full(n, END_ID), np.ones(n, np.int64))
                    stops = np.cumsum(counts + 1).tolist()
                    for doc, a, b in zip(docs_of[at : at + len(texts)], [0, *stops], stops, strict=False):
                        held.append((doc, ids[a:b]))
                        tokens += b - a
                        if tokens >= group_tokens:
                            yield flush()
                    at += len(texts)
            if held:
                yield flush()
        finally:
            words.table.clear()

    return map_arrow(docs.select("doc_id", "text"), run, SCHEMA)
