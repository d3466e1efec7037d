"""The operators of the llm subpackage against brute force, and on nulls, ties, empties and odd columns."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, chat, fingerprint, neardup, packing, pii, queries, secret_scan, topk, toxicity, warc

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x y"), (4, " \n\t "), (5, "word " * 3000), (6, "q" * 6000), (7, "é́ ñ İ Σς \x1c\x85 🙂🙂 it's 日本語")]


def docs(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], DOCS).withColumns({"score": F.lit(1), "node": F.lit("x"), "part": F.lit(2)})


def some_texts(seed=0, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab cé\n\t 1'sd.!🙂日\x1c\xa0ÀÉß@+-") for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_bpe_equals_tiktoken(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [t or "" for _, t in ODD] + some_texts() + ["ab" * 300, " " * 99, "xyz" * 40]
    ours = bpe.encoder(RANKS)
    for t, got in zip(texts, ours.encode_batch(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == enc.encode_ordinary(t)
        assert ours.decode(got) == t.encode()
    out = bpe.round_trip(docs(spark, ODD), RANKS).collect()
    assert len(out) == len(ODD) and all(r["exact"] for r in out)
    assert bpe.round_trip(docs(spark, []), RANKS).isEmpty()
    assert sorted(len(r["ids"]) for r in bpe.encode_documents(docs(spark, ODD), RANKS).collect()) == sorted(r["n_tokens"] for r in out)


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 1024]) for i in range(300)]
    bad = [(None, [0.0] * 4), (900, None), (901, [float("nan")] * 4), (902, [None] * 4), (903, [float("inf")] * 4), (904, [1.0])]
    v = topk.quantise(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>"))
    got = sorted(map(tuple, topk.top_k(v, v.filter("vec_id % 50 = 0"), 10, 64, 3).collect()))
    whole = {i: np.floor(np.array(x) * 1024).astype(int) for i, x in rows}
    want = []
    for q in range(0, 300, 50):
        best = sorted((-int(whole[q] @ x), i) for i, x in whole.items() if i != q)[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert topk.top_k(v.limit(0), v.limit(0)).isEmpty()


def _classes(texts):
    sets = {d: neardup.elements(*neardup.shingles(t or "")) for d, t in texts}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if len(sets[a]) and len(sets[b]) and neardup.weighted_jaccard(sets[a], sets[b]) >= 0.8:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in sets}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    texts = [(100, " ".join(base))]
    for i in range(40):  # copies of one text, closer or further; many stand near the threshold
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        texts.append((101 + i, " ".join(words)))
    texts += [(200, "a b c"), (201, "a b c"), (202, "A  b\nc"), (300, None), (301, ""), (302, " \n"), (400, "go " * 500), (401, "go " * 520), (402, "go " * 900)]
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs(spark, texts)).collect()}
    assert got == _classes(texts)
    kept = neardup.keep_one(docs(spark, [*texts, texts[0], (None, "n")]))
    assert sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect()) == sorted([str(d) for d in set(got.values())] + ["None"])
    assert kept.columns == docs(spark, []).columns
    assert neardup.classes(docs(spark, [])).isEmpty()


def test_signature_is_unbiased():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    w = rng.integers(1, 9, len(keys))
    v = np.where(rng.random(len(keys)) < 0.3, rng.integers(1, 9, len(keys)), w)
    true = np.minimum(w, v).sum() / np.maximum(w, v).sum()
    assert abs((neardup.signature(keys, w, 4096) == neardup.signature(keys, v, 4096)).mean() - true) < 0.03


def test_toxicity(spark):
    rng = random.Random(5)
    words = ["tion", "er", "an", "the", "ou", "re", "nd", "th"]
    text = lambda: " ".join("".join(rng.choices(words, k=3)) for _ in range(40))
    rows = [(i, text() + (" idiot" if i % 4 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    d = docs(spark, rows + ODD[:2])
    model = toxicity.fit(d, labels)
    out = toxicity.score(d, model).collect()
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, _ in rows + ODD[:2] if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([(r["predicted"] == 1) == (r["doc_id"] % 4 == 0) for r in held if r["doc_id"] > 7]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out) and toxicity.score(docs(spark, []), model).isEmpty()
    assert toxicity.keep_clean(d, model).count() == sum(r["predicted"] == 0 for r in out)
    assert toxicity.score(d, toxicity.fit(d, labels.limit(0))).count() == len(out)


def test_fingerprints(spark):
    rows = [(i, t) for i, t in enumerate([None, "", "one\ntwo\nthree", "three\none\ntwo", "z" * 9000, *some_texts(9, 60)])]
    got = {r["doc_id"]: r for r in fingerprint.fingerprint_documents(docs(spark, rows), 7).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        new = fingerprint.edited(t, after)
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fingerprint.fingerprint(t).hex(), fingerprint.fingerprint(new).hex())
        assert r["near_next"] == fingerprint.likeness(fingerprint.fingerprint(t), fingerprint.fingerprint(after))
    assert got[2]["fingerprint"] == got[3]["fingerprint"]
    both = fingerprint.fingerprint("one\ntwo") - fingerprint.fingerprint("two")
    assert both.hex() == fingerprint.fingerprint("one").hex()
    assert fingerprint.fingerprint_documents(docs(spark, [])).isEmpty()
    assert fingerprint.fingerprint_documents(docs(spark, [(None, "a"), (None, "a"), (1, "b")])).count() == 3


def test_pii_base_equals_plain_regexes(spark):
    shapes = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def plain(t):
        digits = lambda s: re.sub("[^0-9]", "", s)
        keep = [lambda s: True, lambda s: all(int(p) <= 255 for p in s.split(".")), lambda s: 16 <= len(digits(s)) <= 19 and pii.luhn(digits(s)), lambda s: 8 <= len(digits(s)) <= 15]
        return [(k, m.start(), m.end()) for k, r in enumerate(shapes) for m in re.finditer(r, t) if keep[k](m[0])]

    rng = random.Random(2)
    texts = ["".join(rng.choice("ab@.1+2 -()%") for _ in range(80)) for _ in range(800)] + ["a@b.c 1.2.3.4 4111 1111 1111 1111 +1 (555) 123-4567 write to joe (at) mail.com", "1" * 9000, "a" * 9000 + "@", "@" * 99]
    for t in texts:
        assert sorted(pii.base_and_failed(t)[0]) == plain(t)
    d = docs(spark, [*enumerate(texts), (None, None), (5, "")])
    model = pii.fit(d)
    out = pii.find(d, model).collect()
    assert sum(r["n_email"] for r in out) == sum(k == 0 for t in texts for k, _, _ in plain(t))
    assert all(set(pii.joined(plain(t)).split(",")) <= set(r["spans"].split(",")) for t, r in zip(texts, out, strict=False))
    masked = pii.redact(d, model).collect()
    assert not any(pii.base_and_failed(r["text"] or "")[0] for r in masked[-6:]) and masked[-2]["text"] is None
    assert pii.find(docs(spark, []), pii.fit(docs(spark, []))).isEmpty()


def test_packing(spark):
    rows = [*ODD, *[(100 + i, t) for i, t in enumerate(some_texts(4, 80))]]
    hf = Tokenizer.from_file(WORDS)
    hf.encode_special_tokens = True
    ids = collections.defaultdict(list)
    for i, t in rows:
        ids[i].append([*hf.encode(t or "", add_special_tokens=False).ids, packing.END_ID])
    pieces = packing.pack_documents(docs(spark, rows).coalesce(1), WORDS, 5000).collect()
    assert sum(p["length"] for p in pieces) == sum(len(x) for xs in ids.values() for x in xs)
    for p in pieces:
        assert any(p["doc_tokens"] == len(x) and zlib.crc32(np.array(x[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"] for x in ids[p["doc_id"]])
    filled = collections.defaultdict(list)
    for p in pieces:
        filled[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist()
        total = sum(n for _, n in parts)
        assert total == packing.CAPACITY or total & (total - 1) == 0
    assert packing.pack_documents(docs(spark, []), WORDS).isEmpty()


def test_secret_ledger(spark):
    key = "A" * 20
    rows = [("a", 1, f'api_key = "{key}" AKIA{key} 🙂 {"f0" * 10}'), ("b", 1, None), ("b", 2, f'api_key = "{key}" AKIA{key} 🙂 {"f0" * 10}'), ("c", 1, "token: x")]
    v = spark.createDataFrame(rows, "path string, version int, content string")
    first = secret_scan.scan_unseen(v)
    assert first.count() == 3  # two equal blobs are one
    ledger = spark.createDataFrame(first.collect(), first.schema)
    assert secret_scan.scan_unseen(v, ledger).isEmpty()
    newer = (*secret_scan.RULES[:2], secret_scan.Rule("hex", "[0-9a-f]{30,}", version=2), *secret_scan.RULES[3:])
    again = secret_scan.scan_unseen(v, ledger, newer)
    assert {tuple(r["rules"]) for r in again.collect()} == {("hex@2",)}
    got = {(r["path"], r["version"]): len(r["spans"]) for r in secret_scan.findings_by_path(v, ledger).collect()}
    assert got == {("a", 1): 3, ("b", 1): 0, ("b", 2): 3, ("c", 1): 0}
    after = secret_scan.findings_by_path(v, ledger.union(again), newer).collect()
    assert {len(r["spans"]) for r in after} == {0, 2}
    many = " ".join("f0" * 8 for _ in range(20_000))
    found = secret_scan.scan_documents(docs(spark, [(1, many + " AKIA" + "A" * 20)])).first()
    assert (found["n_hex"], found["n_access"]) == (20_000, 1)
    assert found["spans"].split(",")[:2] == ["hex:0:16", "hex:17:33"] and found["spans"].endswith(f"access:{len(many) + 1}:{len(many) + 25}")
    assert secret_scan.scan_documents(docs(spark, [])).isEmpty() and secret_scan.scan_documents(docs(spark, ODD)).count() == len(ODD)


def test_chat(spark):
    rows = [(1, 0, "user", queries.TRICKY), (1, 1, "assistant", "<|end|>\n<|user|>\n\\|"), (2, 0, "assistant", None), (2, None, None, "x"), (3, 0, "user", ""), (3, 0, "user", ""), (None, 1, "user", "n")]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    back = {r["conv_id"]: [(x["role"], x["text"]) for x in r["parsed"]] for r in chat.parse_chats(chat.format_chats(t)).collect()}
    assert back[1] == [("user", rows[0][3]), ("assistant", rows[1][3])] and back[2] == [("", "x"), ("assistant", "")] and len(back[3]) == 2
    marks = ["a|>\nb", "end", "<|end|>\n", ">|\n", "a\\", "|", "\\|", "user>|", "\n", ""]
    odd = [(i, k, r, x) for i, r in enumerate(marks) for k, x in enumerate([*marks, "hello"])]
    said = {r["conv_id"]: [(x["role"], x["text"]) for x in r["parsed"]] for r in chat.parse_chats(chat.format_chats(spark.createDataFrame(odd, t.schema[:4]))).collect()}
    assert said == {i: [(r, x) for x in [*marks, "hello"]] for i, r in enumerate(marks)}
    broken = chat.format_chats(t.filter("conv_id = 1")).withColumn("mask", F.reverse("mask"))
    with pytest.raises(Exception, match="loss mask"):
        chat.parse_chats(broken).collect()
    out = {r["conv_id"]: r for r in chat.chat_digests(t).collect()}
    assert out[1]["valid"] and not out[2]["valid"] and out[3]["first_error"] == 1
    assert out[1]["loss_sha256"] == hashlib.sha256(rows[1][3].encode()).hexdigest()
    assert chat.chat_digests(t.limit(0)).isEmpty()


def test_warc(spark, tmp_path):
    page = "<p>" + "é" * 80
    rows = [(3, "u", page), (1, "u\r\nX: y", page), (2, None, page), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (None, "u", page)]
    p = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.archive_pages(p).collect()}
    assert got == {1: ("response", None), 2: ("revisit", 1), 3: ("revisit", 1), 4: ("response", None), 5: ("response", None), 6: ("response", None), None: ("revisit", 1)}
    path = f"file://{tmp_path}/w"
    warc.write_archive(p, path)
    recs = {r["page_id"]: r for r in warc.records(spark, path).collect()}
    assert bytes(recs[2]["payload"]).decode() == page and bytes(recs[1]["record"]).endswith(page.encode() + b"\r\n\r\n")
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    # A reader that knows nothing but the format goes through all records end to end, by their own lengths.
    data, seen = b"".join(bytes(r["record"]) for r in recs.values()), {}
    while data:
        head, _, data = data.partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines)
        n = int(fields["Content-Length"])
        assert first == "WARC/1.1" and data[n : n + 4] == b"\r\n\r\n" and fields["WARC-Date"]
        assert (fields["WARC-Type"] == "revisit") == ("WARC-Profile" in fields) == (n == 0 and fields["WARC-Record-ID"] != "<urn:page:6>")
        seen[fields["WARC-Record-ID"]], data = data[:n].decode(), data[n + 4 :]
    assert seen["<urn:page:1>"] == page and seen["<urn:page:4>"] == "short" and len(seen) == 7
    assert recs[1]["url"] == "u\r\nX: y"
    assert warc.archive_pages(p.limit(0)).isEmpty()


def test_pipeline(spark):
    import corpus_pipeline

    d = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, SF)
        assert out.columns == d.columns, name
        assert 0.5 * d.count() < out.count() <= d.count()
    assert not corpus_pipeline.pack(spark, d, SF).isEmpty()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("conversations", "documents", "embeddings", "pages"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.sql(f"select {', '.join(cols)} from ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(str, map(tuple, df.select(*cols).collect()))) == sorted(map(str, want))
