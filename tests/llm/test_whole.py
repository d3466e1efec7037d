"""The operators do the whole job: no sampled windows, no texts lost by their length."""

import collections
import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest

from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_llm import _classes, docs
from tidemark.llm import fingerprint, neardup, packing, pii, topk, toxicity

SF = "/root/testdata/sf0.1"


def windows(text):
    found = collections.Counter()
    for p in text.split("\n"):
        if 0 < len(p) < fingerprint.WINDOW:
            found[p] += 1
        found.update(p[i : i + fingerprint.WINDOW] for i in range(len(p) - fingerprint.WINDOW + 1))
    return found


def overlap(a, b):
    a, b = windows(a), windows(b)
    return 2 * (a & b).total() / max(1, a.total() + b.total())


def test_near_edited_of_short_and_repetitive_texts(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 8)))
    kinds = {
        "one character": lambda: chr(rng.randint(0x4E00, 0x9000)) * rng.randint(500, 3000),
        "period": lambda: (word() + word()) * rng.randint(50, 200),
        "short": lambda: " ".join(word() for _ in range(9))[: rng.randint(40, 60)],
    }
    for name, make in kinds.items():
        texts = [make() for _ in range(100)]
        got = {r["doc_id"]: r["near_edited"] for r in fingerprint.fingerprint_documents(docs(spark, list(enumerate(texts)))).collect()}
        true = [overlap(t, fingerprint.edited(t, texts[i - 1])) for i, t in enumerate(texts)]
        wrong = np.abs([got[i] - x for i, x in enumerate(true)])
        # Inner products weigh repeated windows by the product of their counts: 2/3 where the overlap is 1/2.
        assert wrong.max() < 0.35 and wrong.mean() < (0.09 if name == "short" else 0.2), name


def test_long_clean_texts_stay(spark):
    d, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(d, labels)
    held = d.join(labels.select("doc_id", "toxic"), "doc_id").filter(toxicity.held_out()).select("doc_id", "lang", "text", "toxic").collect()
    by_lang = collections.defaultdict(list)
    for r in sorted(held, key=lambda r: r["doc_id"]):
        if r["toxic"] == 0:
            by_lang[r["lang"]].append(r["text"] or "")
    rng = random.Random(0)
    many = [x for x in by_lang.values() if len(x) >= 30]
    joined = ["\n".join(rng.sample(rng.choice(many), 30)) for _ in range(20)]
    long = [t for x in by_lang.values() for t in x if len(t) > 10_000]
    assert toxicity.keep_clean(docs(spark, list(enumerate(joined))), model).count() >= 19
    assert toxicity.keep_clean(docs(spark, list(enumerate(long))), model).count() >= len(long) - 1
    # A toxic text in the midst of six clean ones stays found (0.78 of them; an even mean over the length would lose most).
    found = [r["doc_id"] for r in toxicity.score(d, model).filter("predicted = 1").collect()]
    bad = [r["text"] for r in held if r["toxic"] == 1 and r["doc_id"] in set(found)]
    hidden = ["\n".join([*rng.sample(many[0], 3), t, *rng.sample(many[0], 3)]) for t in bad]
    assert toxicity.score(docs(spark, list(enumerate(hidden))), model).agg(F.avg("predicted")).first()[0] > 0.7


def test_sample_is_filled_after_the_length_bound(spark, monkeypatch):
    rows = [(i, "word " * (2 if i % 3 else 5000)) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    taken = {}
    monkeypatch.setattr(toxicity, "SAMPLE", 40)
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, share: taken.update(toxic=int(toxic.sum()), rows=len(texts)))
    toxicity.fit(docs(spark, rows), labels)
    assert taken == {"toxic": 40, "rows": 80}


@pytest.mark.parametrize("top", [0.6, 2.0**15, 2.0**18, 2.0**52])
def test_topk_of_large_components(spark, top):
    rng = np.random.default_rng(3)
    x = rng.uniform(-top, top, (60, 8))
    if top == 2.0**52:  # so large that a score fits only beside small queries
        x[0] = [1 / 1024, -1 / 1024, 0, 0, 0, 0, 0, 0]
        x[1] = [-top * 1.9, top * 0.05, 5, 5, 5, 5, 5, 5]
        x[1:, 0] = np.where(np.arange(1, 60) % 2, x[1:, 0], x[1:, 0] * 0.4)
    v = np.floor(x * 1024)
    rows = topk.quantise(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>"))
    asked = rows.filter("vec_id = 0" if top == 2.0**52 else "vec_id % 10 = 0")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(rows, asked, block_rows=25).collect()}
    whole = [[int(a) for a in r] for r in v]
    for q in {q for q, _ in got}:
        score = sorted((-sum(a * b for a, b in zip(whole[q], whole[i], strict=True)), i) for i in range(60) if i != q)
        assert [got[q, k] for k in range(1, 11)] == [(i, -s) for s, i in score[:10]]
    assert len(got) == 10 * (1 if top == 2.0**52 else 6)


def test_topk_raises_where_a_score_leaves_64_bits(spark):
    rows = topk.quantise(spark.createDataFrame([(i, [2.0**25] * 4) for i in range(3)], "vec_id long, embedding array<double>"))
    with pytest.raises(Exception, match="leaves 64 bits"):
        topk.top_k(rows, rows).collect()


def test_pipeline_run_equals_a_chain_in_plain_python(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(5)
    words = ["tion", "er", "an", "the", "ou", "re", "nd", "th"]
    text = lambda: " ".join("".join(rng.choices(words, k=3)) for _ in range(60))
    rows = [(1000 + i, text() + (" idiot" if i % 4 == 0 else "")) for i in range(300)]
    clean = [t for i, t in rows if i % 4][:40]
    rows += [(i, t + " idiot") for i, t in enumerate(clean[:10])]  # toxic near copies with lesser ids: their clean texts stay
    rows += [(2000 + i, t + " more") for i, t in enumerate(clean[10:20])]  # near copies with greater ids: these go
    rows += [(3000 + i, f"{t} mail{i}@example.com") for i, t in enumerate([text() for _ in range(20)])]
    rows += [(4000, None), (4001, ""), (4002, "<|endoftext|> is no end of this text")]
    rows += [(r["doc_id"] + 10_000, r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    labels = [(i, 1, int(" idiot" in (t or ""))) for i, t in rows if i < 1300]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    table = lambda x: spark.createDataFrame([(i, t, "l", "s", None if t is None else len(t)) for i, t in x], kind)
    root = f"file://{tmp_path}/sf"
    table(rows).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")

    flags = dict((i, x) for i, _, x in labels)
    learnt = sorted((i, t or "") for i, t in rows if i in flags and zlib.crc32(str(i).encode()) % 3 != 1)
    model = toxicity.train([t for _, t in learnt], np.array([flags[i] for i, _ in learnt], bool), sum(flags[i] for i, _ in learnt) / len(learnt))
    scores = toxicity._scores([t for _, t in rows], model, toxicity.Buckets())
    left = [r for r, x in zip(rows, scores, strict=True) if x < 0.7]
    of = _classes(left)
    left = [(i, t) for i, t in left if of[i] == i]
    found = pii.fit(table(left))
    masked = {i: None if t is None else pii.clean(t, found) for i, t in left}
    # What the stages do on the planted rows.
    ids = set(masked)
    assert not ids & set(range(10)) and len(ids & {i for i, t in rows if t in clean[:10]}) >= 9
    assert not ids & set(range(2000, 2010)) and {4000, 4001, 4002} <= ids
    assert not any("@example.com" in (masked[i] or "") for i in ids if 3000 <= i < 3020) and sum(3000 <= i < 3020 for i in ids) >= 18

    hf = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: [*hf.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for i, t in masked.items()}
    pieces = collections.defaultdict(list)
    for p in corpus_pipeline.run(spark, root).collect():
        pieces[p["doc_id"]].append(p)
    assert set(pieces) == set(want)
    for i, parts in pieces.items():
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(want[i]))
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(np.array(want[i][p["start"] : at], "<u4").tobytes())
        assert at == len(want[i])


def test_packed_ids_of_texts_with_added_tokens():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["end <|endoftext|> next", "a<|startoftext|>b", "<|ENDOFTEXT|> x", "plain text", "", "<|endoftext|><|endoftext|> é日本"]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.encoder(path).encode_batch(texts)] == want
    assert want[0] == [806, 49407, 1131]


def test_fingerprints_of_many_copies_of_one_row(spark):
    rows = [(None, "same\nlines")] * 40 + [(7, "x y z")] * 3 + [(i, f"text {i}") for i in range(9, 15)]
    got = [tuple(r) for r in fingerprint.fingerprint_documents(docs(spark, rows), 5).select("doc_id", "edited_sha256", "near_next").collect()]
    order = sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    want = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        want.append((i, hashlib.sha256(fingerprint.edited(t, after).encode()).hexdigest(), fingerprint.likeness(fingerprint.fingerprint(t), fingerprint.fingerprint(after))))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_toxicity_ratios_and_fit_equal_a_plain_computation(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcd ", weights=[4, 3, 2 + 2 * (i % 2), 1, 2], k=60)) for i in range(60)]
    toxic = np.array([i % 2 == 1 for i in range(60)])
    monkeypatch.setattr(toxicity, "KEPT", 40)
    model = toxicity.train(texts, toxic, 0.5)
    found = [set(toxicity.Buckets().of(t).tolist()) for t in texts]
    rows = collections.Counter(b for f in found for b in f)
    bad = collections.Counter(b for f, y in zip(found, toxic, strict=True) if y for b in f)
    p = {b: (bad[b] + 1) / 32 for b in rows}
    q = {b: (rows[b] - bad[b] + 1) / 32 for b in rows}
    share = {b: rows[b] / 60 for b in rows}
    chi = {b: (p[b] - q[b]) ** 2 / (share[b] * (1 - share[b]) * (2 / 30) + 1e-9) for b in rows if rows[b] >= toxicity.LEAST_ROWS}
    kept = sorted((b for b in chi if chi[b] > 0), key=lambda b: (-chi[b], b))[:40]
    assert set(np.flatnonzero(model.weights).tolist()) <= set(kept)
    ratio = np.array([np.log(p[b] / q[b]) for b in kept])
    x = np.array([[(b in f) * r * 2 * toxicity.USUAL_BUCKETS / (len(f) + toxicity.USUAL_BUCKETS) for b, r in zip(kept, ratio, strict=True)] for f in found])
    w, b = np.zeros(len(kept)), 0.0
    for _ in range(200):  # plain Newton steps on the penalised likelihood
        s = 1 / (1 + np.exp(-(x @ w + b)))
        wide = np.column_stack([x, np.ones(60)])
        curve = (wide * (s * (1 - s))[:, None]).T @ wide + np.diag([toxicity.DECAY] * len(kept) + [0.0])
        step = np.linalg.solve(curve, wide.T @ (s - toxic) + np.append(toxicity.DECAY * w, 0))
        w, b = w - step[:-1], b - step[-1]
    assert np.allclose(model.weights[kept], w * ratio, atol=1e-3) and abs(model.bias - b) < 1e-3


def test_em_finds_planted_reliabilities_and_adds_spans(spark):
    rng = np.random.default_rng(4)
    right = [0.95, 0.85, 0.7, 0.9, 0.6]
    truth = rng.random(40_000) < 0.4
    votes = np.where(rng.random((40_000, 5)) < right, truth[:, None], ~truth[:, None])
    seen = collections.Counter("3" + "".join("+" if v else "-" for v in row) + "000" for row in votes)
    good = collections.Counter("3" + "".join("+" if v else "-" for v in row) + "000" for row in votes[truth])
    names = sorted(seen)
    p, rates = pii.expectation_maximisation(names, np.array([seen[n] for n in names], float))
    for j, r in enumerate(right):
        assert abs(rates[1, j, 0] - r) < 0.03 and abs(rates[0, j, 1] - r) < 0.03
    wrong = sum(abs(x * seen[n] - good[n]) for n, x in zip(names, p, strict=True)) / 40_000
    assert wrong < 0.03
    # Written out addresses and local numbers are added where base shapes have taught what they look like.
    texts = [f"please write to joe{i}@mail.com or call +1 (555) 123-45{i % 90 + 10} today" for i in range(300)]
    more = [f"please write to ann{i} (at) mail (dot) com or call 555 123 45{i % 90 + 10} today" for i in range(40)]
    noise = [f"version {i}.2.3000.4 of order 12345678{i:05d} token" for i in range(60)]
    rows = list(enumerate([*texts, *more, *noise]))
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs(spark, rows), pii.fit(docs(spark, rows))).collect()}
    added = [i for i, t in rows if t in more and "email:16:" in found[i]]
    assert len(added) == 40 and not any(found[i] for i, t in rows if t in noise)


def test_candidates_of_very_many_spans_take_linear_time():
    text = " ".join(f"300.1.2.{i}; 555 123 4{i % 1000:03d}," for i in range(30_000))
    start = time.process_time()
    assert len(pii.candidates(text)) >= 30_000
    assert time.process_time() - start < 30


def test_near_duplicates_of_a_table_equal_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    sets = [neardup.elements(*neardup.shingles(t or "")) for _, t in rows]
    size, common = np.array([len(x) for x in sets], float), neardup._overlaps(sets)
    near = np.argwhere(np.triu(common >= 0.8 * (size[:, None] + size[None, :] - common), 1) & (size[:, None] > 0))
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs(spark, rows)).collect()}
    assert len(near) > 20 and sum(got[rows[a][0]] == got[rows[b][0]] for a, b in near) == len(near)
    assert got == _classes(rows)


def test_near_duplicates_of_repeated_and_missing_ids(spark):
    long = lambda word: " ".join(f"{word}{i}" for i in range(60))
    rows = [(1, long("a")), (5, long("a") + " x"), (5, long("b")), (5, long("c")), (5, long("c")), (9, long("b")), (None, long("c") + " y"), (None, long("d")), (None, long("d") + " z"), (None, " "), (7, ""), (7, "")]
    got = sorted(((r["doc_id"], r["class_id"]) for r in neardup.classes(docs(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 1), (5, 1), (5, 5), (5, 5), (5, 5), (9, 5), (None, 5), (None, None), (None, None), (None, None), (7, 7), (7, 7)], key=str)
    kept = sorted(((r["doc_id"], (r["text"] or "")[:2]) for r in neardup.keep_one(docs(spark, rows)).collect()), key=str)
    assert kept == sorted([(1, "a0"), (5, "b0"), (5, "c0"), (None, "d0"), (None, " "), (7, ""), (7, "")], key=str)
