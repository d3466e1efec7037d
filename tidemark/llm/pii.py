"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a classifier decides.

Candidates are the base matches (always kept) and looser ones: base shapes that fail their check, written
out addresses, telephone numbers without a plus, shorter card numbers.  Five labelers (check, shape,
gazetteer, context, edges) vote for, against or not at all.  ``fit`` counts vote patterns over all
documents, estimates each labeler's reliability and each pattern's probability by
expectation-maximisation, and trains a logistic span classifier on those probabilities; ``find`` and
``redact`` add the candidates that it accepts.

Only pattern counts reach the driver; their number is bounded by kinds x votes x feature buckets.

Defined results: a kind of which no document has a base match gets no added spans; a null text is empty; empty texts have no spans; repeated rows stay; an empty table
fits a model that adds nothing; extra columns are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import map_arrow

KINDS = ("email", "ip", "card", "phone")

_LEFT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WRITTEN = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]{1,63})+")
_LOCAL_PHONE = re.compile(r"(?<![\w+.-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![\w.-])")

#: Gazetteers: last labels of domains, calling codes, first digits of card numbers.
DOMAINS = frozenset("com org net edu gov info io de fr es uk it eu us example test".split())
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "254", "351", "353", "358", "380", "420")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "30", "36", "38", *map(str, range(22, 28)))
#: Words before a span that speak for it, and those that speak against any.
CONTEXT = {
    "email": ("mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "address", "from"),
    "card": ("card", "visa", "credit", "pay", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
}
AGAINST = ("version", "isbn", "order", "build", "ref", "token", "hash", "license", "page")
CONTEXT_CHARS = 32

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LEFT:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield 0, start, end
        at = text.find("@", max(end, at + 1))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_and_failed(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans (kind, start, end) in order, and matches of their shapes that fail their checks."""
    good = list(_emails(text)) if "@" in text else []
    bad: list[Span] = []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            (good if all(map(_small, m[0].split("."))) else bad).append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 < len(digits) < 20:
                (good if len(digits) > 15 and luhn(digits) else bad).append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                n = sum(c.isdigit() for c in m[0])
                (good if 8 <= n <= 15 else bad).append((3, m.start(), m.end()))
    return good, bad


def _more(text: str) -> Iterator[Span]:
    if "(at)" in text or "[at]" in text:
        for m in _WRITTEN.finditer(text):
            yield 0, m.start(), m.end()
    if _DIGIT.search(text):
        for m in _LOCAL_PHONE.finditer(text):
            yield 3, m.start(), m.end()


def _sign(x: bool) -> str:
    return "+" if x else "-"


def pattern(text: str, span: Span, base: bool) -> str:
    """The span's votes and feature buckets: kind, five votes (+, -, 0), length, digits, parts."""
    kind, start, end = span
    found = text[start:end]
    digits = "".join(c for c in found if "0" <= c <= "9")
    if kind == 0:
        last = re.split(r"[.\])]", found.rstrip("."))[-1].strip()
        shape, listed = last.isalpha() and 2 <= len(last) <= 24, last.lower() in DOMAINS
    elif kind == 1:
        parts = found.split(".")
        shape, listed = all(p == "0" or p[0] != "0" for p in parts), parts[0].lstrip("0") not in ("", "255")
    elif kind == 2:
        shape, listed = bool(re.fullmatch(r"[0-9]+|[0-9]{4}([ -][0-9]{4}){2,3}([ -][0-9]{1,4})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}", found)), digits.startswith(ISSUERS)
    else:
        shape, listed = 9 <= len(digits) <= 14 and not re.search(r"[ .-]{2}", found), "+" in found and digits.startswith(CALLING)
    before = text[max(0, start - CONTEXT_CHARS) : start].lower()
    context = "-" if any(w in before for w in AGAINST) else "+" if any(w in before for w in CONTEXT[KINDS[kind]]) else "0"
    edges = not (start and (text[start - 1].isalnum() or text[start - 1] in "._-")) and not (end < len(text) and (text[end].isalnum() or text[end] in "_@"))
    votes = _sign(base) + _sign(shape) + _sign(listed) + context + _sign(edges)
    return f"{kind}{votes}{min(end - start, 31) // 8}{min(len(digits), 19) // 4}{min(len(re.findall('[ .-]', found)), 3)}"


def candidates(text: str) -> list[tuple[Span, bool, str]]:
    """(span, whether base, pattern) of a text; a candidate inside a base span of its kind is left out."""
    good, bad = base_and_failed(text)
    if not good and not bad and not any(True for _ in _more(text)):
        return []
    out = [(s, True, pattern(text, s, True)) for s in good]
    # Spans of a kind that are taken never overlap, so the neighbours in order decide.
    taken: list[list[tuple[int, int]]] = [sorted((a, b) for k, a, b in good if k == kind) for kind in range(len(KINDS))]
    for s in dict.fromkeys([*bad, *_more(text)]):
        kind, start, end = s
        mine = taken[kind]
        at = bisect_left(mine, (start, end))
        if not (at and mine[at - 1][1] > start) and not (at < len(mine) and mine[at][0] < end):
            mine.insert(at, (start, end))
            out.append((s, False, pattern(text, s, False)))
    return out


@dataclass(frozen=True)
class PiiModel:
    """Patterns whose candidates are added; probabilities of patterns; reliabilities by kind and labeler."""

    accepted: frozenset[str]
    probability: dict[str, float]
    reliability: dict[str, list[float]]


VOTES = "+-0"


def expectation_maximisation(patterns: list[str], counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each pattern is personal data, and P(vote | class), for one kind's patterns.

    Dawid and Skene's model on counts, begun from the share of votes in favour.
    """
    votes = np.array([[VOTES.index(v) for v in p[1:6]] for p in patterns])
    p = ((votes == 0).sum(1) + 0.5) / (((votes == 0) | (votes == 1)).sum(1) + 1.0)
    rates = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - p), counts * p])
        for k in range(3):
            rates[:, :, k] = weight @ (votes == k) + 1.0
        rates /= rates.sum(2, keepdims=True)
        prior = (weight.sum(1) + 1.0) / (weight.sum() + 2.0)
        like = np.log(prior)[:, None] + sum(np.log(rates[:, j, votes[:, j]]) for j in range(votes.shape[1]))
        p = 1 / (1 + np.exp(np.clip(like[0] - like[1], -50, 50)))
    return p, rates


def _features(p: str) -> list[float]:
    votes = [1.0 if v == "+" else -1.0 if v == "-" else 0.0 for v in p[1:6]]
    return [1.0, *votes, *[float(p[6] == str(k)) for k in range(4)], *[float(p[7] == str(k)) for k in range(5)], *[float(p[8] == str(k)) for k in range(4)]]


def train_spans(patterns: list[str], target: np.ndarray, counts: np.ndarray, rounds: int = 300, decay: float = 1e-3) -> np.ndarray:
    """Probabilities of a logistic classifier over span features, fitted to soft targets."""
    x = np.array([_features(p) for p in patterns])
    w, share = np.zeros(x.shape[1]), counts / counts.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        slope = x.T @ (share * (p - target)) + decay * w
        curve = (x * (share * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + decay * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))


def fit(docs: DataFrame, least: float = 0.5) -> PiiModel:
    """Fits the model to the candidates of all ``docs`` (text); one narrow pass and a small aggregation."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(p for _, _, p in candidates(text))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["pattern", "n"])

    counted = map_arrow(docs.select("text"), count, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    rows = sorted((r["pattern"], r["n"]) for r in counted.collect())
    probability: dict[str, float] = {}
    reliability: dict[str, list[float]] = {}
    for k, kind in enumerate(KINDS):
        mine = [(p, n) for p, n in rows if p[0] == str(k)]
        if not any(p[1] == "+" for p, _ in mine):
            continue  # without a base match there is nothing to tell candidates by: none is added
        names, counts = [p for p, _ in mine], np.array([n for _, n in mine], float)
        soft, rates = expectation_maximisation(names, counts)
        reliability[kind] = [float(rates[1, j, 0] + rates[0, j, 1]) / 2 for j in range(5)]
        probability.update(zip(names, train_spans(names, soft, counts).tolist(), strict=True))
    return PiiModel(frozenset(p for p, x in probability.items() if x >= least), probability, reliability)


def spans(text: str, model: PiiModel) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a text, by kind and start."""
    found = candidates(text)
    return sorted(s for s, base, _ in found if base), sorted(s for s, base, p in found if base or p in model.accepted)


def joined(found: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in found)


def find(docs: DataFrame, model: PiiModel) -> DataFrame:
    """doc_id, counts of base spans by kind, digest of the base list, and the list of all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, lists = [], [], []
            for text in batch.column(1).to_pylist():
                base, every = spans(text or "", model)
                counts.append([sum(k == i for k, _, _ in base) for i in range(len(KINDS))])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                lists.append(joined(every))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(lists, pa.string())], names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    schema = f"doc_id long, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string"
    return map_arrow(docs.select("doc_id", "text"), run, schema)


def mask(text: str, found: list[Span]) -> str:
    """``text`` with its spans replaced by ``[KIND]``; of overlapping spans the first and longest names it."""
    out, at = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def clean(text: str, model: PiiModel) -> str:
    """``text`` masked until nothing is found: a mask may part what hid a further span.

    Each round takes digits or an at sign away and adds none, so it ends.
    """
    while found := spans(text, model)[1]:
        text = mask(text, found)
    return text


def redact(docs: DataFrame, model: PiiModel) -> DataFrame:
    """``docs`` with spans masked in ``text`` (null stays null) and ``n_chars``, if there, counted anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [None if t is None else clean(t, model) for t in batch.column("text").to_pylist()]
            made = {"text": pa.array(new, pa.string()), "n_chars": pa.array([None if t is None else len(t) for t in new], pa.int64())}
            yield pa.RecordBatch.from_arrays([made.get(n, batch.column(n)) for n in batch.schema.names], names=batch.schema.names)

    return map_arrow(docs, run, docs.schema)
