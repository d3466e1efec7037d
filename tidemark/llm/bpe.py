"""Byte-level BPE: encoding by segment trees over byte positions, decoding, cached by piece of text.

A word's bytes are the leaves of a segment tree; leaf i holds ``rank * width + i`` of the pair that
starts there, each inner node the smaller of its children, so the root is the leftmost pair of least
rank.  A merge changes the leaves of at most three live neighbours and their log(width) ancestors.
Many words of one width go through the tree side by side as numpy rows; a word longer than the widest
rows has a tree of its own.

Texts become arrays of code points, words are found by changes of kind between neighbours and known by
a hash, and only words that the table doesn't hold go through the trees; the ids of whole texts are
gathered from the table.  It is bounded, holds no Python objects and is emptied when a task ends.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tidemark.llm.shared import map_arrow

#: Words, and ids in all, that a worker's table holds at most when a batch begins (about 40 MB).
CACHE_WORDS, CACHE_IDS = 600_000, 3_000_000
#: Characters of text that are looked at together.
BATCH_CHARS = 400_000
#: Widths of the side-by-side trees; longer words are done alone.
WIDTHS = (8, 16, 32, 64)
#: Rows of a tree that are done together; a table of them stays in a core's cache.
TREE_ROWS = 4_096
NONE = np.iinfo(np.int64).max

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Merges:
    """Pair ranks: (left id, right id) -> rank; the merged id of a rank is ``merged[rank]``.

    Pairs lie in an open hash table, each at most ``reach`` places after its own.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        keys, ranks = left.astype(np.int64) << 32 | right.astype(np.int64), rank.astype(np.int64)
        self.merged = merged
        bits = max(8, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys, self.ranks, self.reach = np.full((1 << bits) + 64, -1, np.int64), np.full((1 << bits) + 64, -1, np.int64), 0
        todo, at = np.arange(len(keys)), self._place(keys)
        while len(todo):
            spot = at[todo]
            free = self.keys[spot] == -1
            _, first = np.unique(spot, return_index=True)
            taken = first[free[first]]
            self.keys[spot[taken]], self.ranks[spot[taken]] = keys[todo[taken]], ranks[todo[taken]]
            left_over = np.ones(len(todo), bool)
            left_over[taken] = False
            todo = todo[left_over]
            at[todo] += 1
            self.reach += 1
        self._dict: dict[int, int] | None = None

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * _SPREAD >> self.shift).astype(np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, -1 where there is none."""
        want = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = self._place(want)
        found = self.keys[at]
        out = np.where(found == want, self.ranks[at], -1)
        open_ = np.flatnonzero((found != want) & (found != -1))
        while len(open_):
            at[open_] += 1
            spot, mine = at[open_], want[open_]
            found = self.keys[spot]
            hit = found == mine
            out[open_[hit]] = self.ranks[spot[hit]]
            open_ = open_[~hit & (found != -1)]
        return out

    def one(self, left: int, right: int) -> int:
        if self._dict is None:
            held = self.keys >= 0
            self._dict = dict(zip(self.keys[held].tolist(), self.ranks[held].tolist(), strict=True))
        return self._dict.get(left << 32 | right, -1)

    def encode(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids end to end, and how many each has; ``flat``: all words' byte ids, end to end."""
        starts, counts = np.cumsum(sizes) - sizes, np.zeros(len(sizes), np.int64)
        done, order, low = [], [], 0
        for width in WIDTHS:
            mine = np.flatnonzero((sizes > low) & (sizes <= width))
            for at in range(0, len(mine), TREE_ROWS):
                part = mine[at : at + TREE_ROWS]
                ids, counts[part] = self._rows(flat, starts[part], sizes[part], width)
                done.append(ids)
                order.append(part)
            low = width
        for i in np.flatnonzero(sizes > low).tolist():
            ids = self._alone(flat[starts[i] : starts[i] + sizes[i]])
            counts[i] = len(ids)
            done.append(ids)
            order.append(np.array([i]))
        if not done:
            return np.zeros(0, np.uint32), counts
        found, at = np.concatenate(done), np.concatenate(order)
        place = np.zeros(len(sizes), np.int64)
        place[at] = np.cumsum(counts[at]) - counts[at]
        return found[spans(place, counts)], counts

    def _rows(self, flat_words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(sizes)
        ids = np.zeros((n, width + 1), np.int64)
        inside = np.arange(width + 1) < sizes[:, None]
        ids[inside] = flat_words[(starts[:, None] + np.arange(width + 1))[inside]]
        alive = inside.copy()
        spots = np.arange(width + 1)
        after = np.where(spots + 1 < sizes[:, None], spots + 1, width)
        before = np.broadcast_to(spots - 1, (n, width + 1)).copy()
        rank = self.look(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width)
        rank[~inside[:, 1:]] = -1
        tree = np.full((n, 2 * width), NONE, np.int64)
        tree[:, width:] = np.where(rank >= 0, rank * width + np.arange(width), NONE)
        for level in range(width.bit_length() - 2, -1, -1):
            lo = 1 << level
            np.minimum(tree[:, 2 * lo : 4 * lo : 2], tree[:, 2 * lo + 1 : 4 * lo : 2], out=tree[:, lo : 2 * lo])
        flat_ids, flat_after, flat_before, flat_alive, flat = ids.ravel(), after.ravel(), before.ravel(), alive.ravel(), tree.ravel()
        row = np.flatnonzero(tree[:, 1] != NONE)
        while len(row):
            base, at = row * (width + 1), row * (2 * width)
            root = flat[at + 1]
            a = root % width
            b = flat_after[base + a]
            c = flat_after[base + b]
            p = flat_before[base + a]
            new_id = self.merged[root // width]
            flat_ids[base + a] = new_id
            flat_alive[base + b] = False
            flat_after[base + a] = c
            has_c, has_p = c < width, p >= 0
            flat_before[(base + c)[has_c]] = a[has_c]
            flat[at + width + b] = NONE
            pp = np.where(has_p, p, a)
            both = self.look(np.concatenate([new_id, flat_ids[base + pp]]), np.concatenate([flat_ids[base + c], new_id]))
            new = np.where(has_c, both[: len(row)], -1)
            back = np.where(has_p, both[len(row) :], new)
            flat[at + width + a] = np.where(new >= 0, new * width + a, NONE)
            flat[at + width + pp] = np.where(back >= 0, back * width + pp, NONE)
            touched = np.concatenate([b, a, p[has_p]])
            where = np.concatenate([at, at, at[has_p]])
            node = (width + touched) >> 1
            for _ in range(width.bit_length() - 1):
                under = where + 2 * node
                flat[where + node] = np.minimum(flat[under], flat[under + 1])
                node >>= 1
            row = row[flat[at + 1] != NONE]
        return ids[alive].astype(np.uint32), alive.sum(axis=1)

    def _alone(self, word: np.ndarray) -> np.ndarray:
        ids, n = word.tolist(), len(word)
        width = 1 << (n - 1).bit_length()
        none = 1 << 62
        tree = [none] * (2 * width)
        for i in range(n - 1):
            r = self.one(ids[i], ids[i + 1])
            if r >= 0:
                tree[width + i] = r * width + i
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, r: int) -> None:
            node = width + i
            tree[node] = r * width + i if r >= 0 else none
            while node > 1:
                node >>= 1
                x = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == x:
                    return
                tree[node] = x

        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1") * n
        while (root := tree[1]) != none:
            r, a = divmod(root, width)
            b = after[a]
            c, p = after[b], before[a]
            ids[a], alive[b], after[a] = int(self.merged[r]), 0, c
            if c < n:
                before[c] = a
            put(b, -1)
            put(a, self.one(ids[a], ids[c]) if c < n else -1)
            if p >= 0:
                put(p, self.one(ids[p], ids[a]))
        return np.array([x for x, live in zip(ids, alive, strict=True) if live], np.uint32)


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions starts[i], starts[i] + 1, ... of all runs, end to end."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def summed(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of ``counts`` of the given sizes."""
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
    stops = np.cumsum(sizes)
    return ends[stops] - ends[stops - sizes]


_MIX = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def hashes(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each run of code points; the runs begin at ``starts`` and leave nothing out."""
    sizes = np.diff(starts, append=len(codes))
    place = (np.arange(len(codes)) - np.repeat(starts, sizes)).astype(np.uint64)
    x = (codes | place << np.uint64(21)) * _MIX[0]
    x ^= x >> np.uint64(32)
    x *= _MIX[1]
    x ^= x >> np.uint64(29)
    first = np.add.reduceat(x, starts)
    x *= _MIX[2]
    x ^= x >> np.uint64(32)
    return first, np.add.reduceat(x, starts)


class WordTable:
    """Ids by word, words known by 128 bits of hash: an open hash table on numpy arrays.

    Bounded: over ``CACHE_WORDS`` words or ``CACHE_IDS`` ids it begins anew.
    """

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.bits, self.n = 12, 0
        self.first, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.counts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.slots = np.full((1 << self.bits), -1, np.int32)

    def trim(self) -> None:
        if len(self.first) > CACHE_WORDS or len(self.ids) > CACHE_IDS:
            self.clear()

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Numbers of the words of these hashes, -1 where one isn't known."""
        out, mask = np.full(len(first), -1, np.int64), (1 << self.bits) - 1
        at = (first >> np.uint64(64 - self.bits)).astype(np.int64)
        open_ = None
        while open_ is None or len(open_):
            slot = self.slots[at]
            held = slot >= 0
            same = held.copy()
            mine = np.flatnonzero(held) if open_ is None else open_[held]
            same[held] = (self.first[slot[held]] == first[mine]) & (self.second[slot[held]] == second[mine])
            if open_ is None:
                out[same] = slot[same]
                open_ = np.flatnonzero(held & ~same)
                at = at[open_]
            else:
                out[open_[same]] = slot[same]
                left = held & ~same
                open_, at = open_[left], at[left]
            at = (at + 1) & mask
        return out

    def add(self, first: np.ndarray, second: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """New distinct words with their ids, end to end, and how many each has."""
        begin = len(self.first)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts, self.ids = np.concatenate([self.counts, counts]), np.concatenate([self.ids, ids])
        self.first, self.second = np.concatenate([self.first, first]), np.concatenate([self.second, second])
        if 3 * len(self.first) > 1 << self.bits:
            self.bits, begin = int(4 * len(self.first)).bit_length(), 0
            self.slots = np.full((1 << self.bits), -1, np.int32)
        todo = np.arange(begin, len(self.first))
        at, mask = (self.first[todo] >> np.uint64(64 - self.bits)).astype(np.int64), (1 << self.bits) - 1
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]  # of several on one place the last stays
            left = self.slots[at] != todo
            todo, at = todo[left], (at[left] + 1) & mask


class Words:
    """Ids of texts by their words, each distinct word encoded once a batch at most; the parent of the encoders.

    A child gives ``prepare`` (code points and flags of where texts begin to code points, where words begin,
    and which words count) and ``encode_words`` (code points and ends of new words to their ids).
    """

    #: A boundary of words at which a very long text may be cut: a space between non-blanks.
    SAFE = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")

    def __init__(self) -> None:
        self.table = WordTable()
        every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
        #: Kinds of code points: 0 blank, 1 letter, 2 number, 3 other.
        self.kinds = np.full(0x110000, 3, np.uint8)
        for kind, found in ((0, r"\p{White_Space}"), (1, r"\p{L}"), (2, r"\p{N}")):
            self.kinds[[ord(c) for c in regex.findall(found, every)]] = kind

    def prepare(self, codes: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raise NotImplementedError

    def encode_words(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    @staticmethod
    def contractions(codes: np.ndarray, kinds: np.ndarray, begins: np.ndarray, lead: np.ndarray) -> None:
        """Makes 's 't 'm 'd 're 've 'll words of their own where an apostrophe begins a word."""
        n = len(codes)
        at = np.flatnonzero((codes[: n - 1] == 39) & begins[: n - 1] & (kinds[1:] == 1) & ~lead[1:])
        if not len(at):
            return
        c, far = codes[at + 1], np.minimum(at + 2, n - 1)
        d = np.where((at + 2 < n) & ~lead[far], codes[far], 0)
        two = (c == 115) | (c == 116) | (c == 109) | (c == 100)
        three = ((c == 114) | (c == 118)) & (d == 101) | (c == 108) & (d == 108)
        begins[at[two | three] + 1] = False
        for shift, which in ((2, two), (3, three)):
            stop = at[which] + shift
            begins[stop[stop < n]] = True

    def encode(self, texts: pa.Array, cut_long: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids end to end, and how many each has."""
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        if cut_long and len(texts) and sizes.max() > 2 * BATCH_CHARS:
            return self._long(texts)
        stops = np.cumsum(sizes)
        if not len(texts) or not stops[-1]:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        codes = np.frombuffer(_data(texts).decode().encode("utf-32-le"), "<u4")
        lead = np.zeros(len(codes), bool)
        lead[(stops - sizes)[sizes > 0]] = True
        codes, starts, kept = self.prepare(codes, lead)
        first, second = hashes(codes, starts)
        sizes = np.diff(starts, append=len(codes))
        starts, sizes, first, second = starts[kept], sizes[kept], first[kept], second[kept]
        self.table.trim()
        at = self.table.find(first, second)
        lacking = np.flatnonzero(at < 0)
        if len(lacking):
            _, index, inverse = np.unique(first[lacking], return_index=True, return_inverse=True)
            if (second[lacking] != second[lacking[index]][inverse]).any():  # words alike in the first hash alone
                _, index, inverse = np.unique(np.stack([first[lacking], second[lacking]]), axis=1, return_index=True, return_inverse=True)
            new, known = lacking[index], len(self.table.first)
            ids, counts = self.encode_words(codes[spans(starts[new], sizes[new])], sizes[new])
            self.table.add(first[new], second[new], ids, counts)
            at[lacking] = known + inverse.ravel()
        counts = self.table.counts[at]
        ids = self.table.ids[spans(self.table.starts[at], counts)]
        return ids, summed(counts, np.diff(np.searchsorted(starts, stops), prepend=0))

    def _long(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, very long texts in parts that end where words do (if such ends are found)."""
        ids, counts = [], []
        for text in texts.to_pylist():
            at, mine = 0, 0
            while at < len(text):
                found = self.SAFE.search(text, at + BATCH_CHARS)
                stop = found.start() if found else len(text)
                got, n = self.encode(pa.array([text[at:stop]]), False)
                ids.append(got)
                mine, at = mine + int(n[0]), stop
            counts.append(mine)
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.array(counts, np.int64)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit integers."""
        ids, counts = self.encode(pa.array(texts, pa.string()))
        data, ends = ids.astype("<u4", copy=False).tobytes(), (np.cumsum(counts) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _data(texts: pa.Array) -> bytes:
    """The bytes of all texts, end to end."""
    _, offsets, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(offsets, wide, len(texts) + 1, texts.offset * np.dtype(wide).itemsize)
    return bytes(memoryview(data)[ends[0] : ends[-1]]) if data else b""


def utf8(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of words given by their code points, end to end, and how many each has."""
    raw = np.frombuffer(codes.astype("<u4", copy=False).tobytes().decode("utf-32-le").encode(), np.uint8)
    return raw, summed(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000).astype(np.int64), sizes)


class ByteBpe(Words):
    """tiktoken-compatible ordinary encoding from a rank file, and decoding.

    Words are those of ``public_tokenizers.PATTERN``, found as changes of kind among code points.
    """

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.ranks = ranks
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, rank = np.array(pairs, np.int64).T
        self.merges = Merges(left, right, rank, np.arange(max(ranks.values()) + 1))

    def prepare(self, codes: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        kinds = self.kinds[codes]
        begins = lead.copy()
        begins[1:] |= kinds[1:] != kinds[:-1]
        # The last blank before a non-blank: a space goes with what follows, another is a word of its own.
        last = np.flatnonzero((kinds[:-1] == 0) & (kinds[1:] != 0) & ~lead[1:])
        begins[last] = True
        begins[last[codes[last] == 32] + 1] = False
        self.contractions(codes, kinds, begins, lead)
        starts = np.flatnonzero(begins)
        return codes, starts, np.ones(len(starts), bool)

    def encode_words(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words in the vocabulary are one id, others go through the trees."""
        raw, sizes = utf8(codes, sizes)
        data, ends, get = raw.tobytes(), np.cumsum(sizes).tolist(), self.ranks.get
        whole = np.fromiter((get(data[a:b], -1) for a, b in zip([0, *ends], ends, strict=False)), np.int64, len(sizes))
        hard = whole < 0
        ids, counts = self.merges.encode(self.byte_id[raw[np.repeat(hard, sizes)]], sizes[hard])
        return merged(~hard, whole[~hard], np.ones(int((~hard).sum()), np.int64), ids, counts)

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The decoded bytes of all texts end to end, and where each begins and ends."""
        got = self.tokens.take(pa.array(ids))
        _, offsets, data = got.buffers()
        ends = np.frombuffer(offsets, np.int64, len(ids) + 1)[np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])]
        return memoryview(data if data else b""), ends

    def decode(self, ids: bytes) -> bytes:
        flat = np.frombuffer(ids, "<u4")
        data, ends = self.decode_all(flat, np.array([len(flat)]))
        return bytes(data[: ends[-1]])


def merged(which: np.ndarray, ids: np.ndarray, counts: np.ndarray, other_ids: np.ndarray, other_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ids in order: the next of ``ids`` where ``which`` is true, else the next of ``other_ids``."""
    sizes = np.empty(len(which), np.int64)
    sizes[which], sizes[~which] = counts, other_counts
    out, mine = np.empty(int(sizes.sum()), np.uint32), np.repeat(which, sizes)
    out[mine], out[~mine] = ids, other_ids
    return out, sizes


def batched(texts: pa.Array, most: int | None = None) -> Iterator[pa.Array]:
    """Runs of ``texts`` of about ``most`` bytes each."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + (most or BATCH_CHARS))) + 1
        yield texts.slice(start, stop - start)
        start = min(stop, len(texts))


def whole_texts(column: pa.Array) -> pa.Array:
    """A column of texts with null as the empty text."""
    return column.fill_null("") if column.null_count else column


#: Encoders of this Python worker by rank file; their caches are empty between tasks.
_ENCODERS: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteBpe(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids of the whole text, as an array, for every row of ``docs`` (doc_id, text).

    Narrow: each task encodes its own rows.  A null text is the empty text; a null doc_id stays null;
    repeated rows stay; an empty table gives none; extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        try:
            for batch in batches:
                at = 0
                for texts in batched(whole_texts(batch.column(1))):
                    ids, counts = bpe.encode(texts)
                    ends = pa.array(np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)]).astype(np.int32))
                    values = pa.array(ids.astype(np.int32))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.ListArray.from_arrays(ends, values)], names=["doc_id", "ids"])
                    at += len(texts)
        finally:
            bpe.table.clear()

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the bytes decoded from them, and decoded = text.

    The encoding of ``encode_documents`` with the digests taken in the same task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        try:
            for batch in batches:
                at = 0
                for texts in batched(whole_texts(batch.column(1))):
                    ids, counts = bpe.encode(texts)
                    raw, ends = memoryview(ids.astype("<u4", copy=False)).cast("B"), np.concatenate([np.zeros(1, np.int64), np.cumsum(counts) * 4]).tolist()
                    of_ids = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends, ends[1:], strict=False)]
                    data, stops = bpe.decode_all(ids, counts)
                    back = [data[a:b] for a, b in zip(stops.tolist(), stops[1:].tolist(), strict=False)]
                    of_text = [hashlib.sha256(b).hexdigest() for b in back]
                    same = [b == t.as_buffer() if len(b) else not t.as_buffer().size for b, t in zip(back, texts, strict=True)]
                    columns = [batch.column(0).slice(at, len(texts)), pa.array(counts), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string()), pa.array(same, pa.bool_())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "exact"])
                    at += len(texts)
        finally:
            bpe.table.clear()

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean")
