"""Incremental blob ledger for secret scans, in SQL functions.

Every version of every path is content-addressed by SHA-256.  The ledger records which (blob, rule
version) pairs have been scanned; a scan touches only pairs that are not there, and its findings are
joined back to every path that holds the blob.

Positions come without user code: a text split at a rule's matches gives the pieces between them, so
running sums of piece and match lengths are the matches' offsets in code points.

Defined results: a null content is the empty blob; an empty blob has no findings; repeated (path,
version) rows stay; an empty table gives empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import cut


@dataclass(frozen=True)
class Rule:
    """A rule version.  ``group``: the group whose length counts; ``least``: that length at least.

    ``hint``: plain strings of which a matching text holds at least one (a cheap first test).
    """

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    hint: tuple[str, ...] = ()
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: Base rules, in the order of their kinds.  A run shorter than a kind's least length cannot hold a match.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, (":", "=")),
    Rule("access", r"AKIA[A-Z0-9]{14,}", hint=("AKIA",)),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Rules beyond the base: provider tokens, signed web tokens, private key headers.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", hint=("gh",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint=("eyJ",)),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----", hint=("-----BEGIN",)),
)
RULES = BASE_RULES + MORE_RULES

SPAN = "struct<start: bigint, kind: int, end: bigint, version: int>"
NO_SPANS = f"cast(array() as array<{SPAN}>)"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _offsets(text: Column, rule: Rule, kind: int) -> Column:
    """Spans of a rule's matches in ``text``: array of (start, kind, end, version), leftmost non-overlapping.

    Running sums go over runs of about the square root of the matches' number, first over whole runs, then
    within each, so that what is copied stays small beside the scan of the text.
    """

    def zipped(match: Column) -> Column:
        counted = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)) if rule.group else match
        sizes = lambda texts: F.transform(texts, F.length)
        return F.arrays_zip(sizes(F.split(text, rule.regex, -1)).alias("gap"), sizes(match).alias("n"), sizes(counted).alias("counted"))

    def runs_of(rows: Column) -> Column:  # the last row is the text behind the last match
        run = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(rows)))).cast("int")
        return _let(run, lambda n: F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / n).cast("int")), lambda i: F.slice(rows, i * n + 1, n)))

    def passed(runs: Column) -> Column:
        total = lambda rows: F.aggregate(rows, F.lit(0).cast("long"), lambda n, x: n + x["gap"] + F.coalesce(x["n"], F.lit(0)))
        return F.aggregate(F.transform(runs, total), F.expr("array(0L)"), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["n"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), F.lit(rule.version).alias("version"))
        return F.struct(end.alias("at"), F.when(x["counted"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def of(runs: Column) -> Column:
        begin = lambda at: F.struct(at.alias("at"), F.expr(NO_SPANS).alias("out"))
        return F.flatten(F.zip_with(runs, F.slice(passed(runs), F.lit(1), F.size(runs)), lambda rows, at: F.aggregate(rows, begin(at), step, lambda acc: acc["out"])))

    return _let(F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0)), lambda match: _let(zipped(match), lambda rows: _let(runs_of(rows), of)))


def _scan(text: Column, rule: Rule, kind: int, wanted: Column | None = None) -> Column:
    can = F.lit(True)
    for i, s in enumerate(rule.hint):
        can = text.contains(s) if i == 0 else can | text.contains(s)
    can = can & text.rlike(rule.regex)
    if wanted is not None:
        can = wanted & can
    return F.when(can, _offsets(text, rule, kind)).otherwise(F.expr(NO_SPANS))


def address(versions: DataFrame, content: str = "content") -> DataFrame:
    """Adds ``blob``, the SHA-256 of the content (null: empty)."""
    return versions.withColumn("blob", F.sha2(F.coalesce(F.col(content), F.lit("")), 256))


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, content: str = "content") -> DataFrame:
    """New ledger rows (blob, rules, spans): blobs with rule versions that ``ledger`` lacks, scanned.

    ``ledger``: rows of earlier calls.  Copies of a blob are reduced to one before and after the
    shuffle, so a blob in a third of all versions is one row for each task.
    """
    blobs = address(versions, content).groupBy("blob").agg(F.first(F.coalesce(F.col(content), F.lit(""))).alias("text"))
    have = None
    if ledger is not None:
        seen = ledger.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        every = F.array(*[F.lit(r.key) for r in rules])
        blobs = blobs.join(seen, "blob", "left").withColumn("todo", F.array_except(every, F.coalesce("seen", F.expr("cast(array() as array<string>)"))))
        blobs = blobs.filter(F.size("todo") > 0)
        have = lambda r: F.array_contains("todo", r.key)
    parts = [_scan(F.col("text"), r, i, have(r) if have else None) for i, r in enumerate(rules)]
    todo = F.col("todo") if have else F.array(*[F.lit(r.key) for r in rules])
    return blobs.select("blob", todo.alias("rules"), F.array_sort(F.concat(*parts)).alias("spans"))


def findings_by_path(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, content: str = "content") -> DataFrame:
    """``versions`` without their content, with ``blob`` and the blob's ``spans`` from all ledger rows.

    Only spans found by the current version of each rule count.
    """
    current = F.array(*[F.lit(r.version) for r in rules])
    live = F.filter("spans", lambda s: current[s["kind"]] == s["version"])
    found = ledger.select("blob", live.alias("spans")).filter(F.size("spans") > 0)
    # Written, so that the join below is of its own shuffle and Spark can split a blob with very many paths.
    found = cut(found.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")), "findings")
    keyed = address(versions, content).drop(content)
    return keyed.join(found, "blob", "left").withColumn("spans", F.coalesce("spans", F.expr(NO_SPANS)))


def spans_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end, comma-joined in the spans' order."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_documents(docs: DataFrame) -> DataFrame:
    """Per document: counts of base spans, the digest of their list and the list of all spans."""
    versions = docs.select("doc_id", F.col("text").alias("content"))
    ledger = cut(scan_unseen(versions), "ledger")
    found = findings_by_path(versions, ledger)
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_RULES))
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )
