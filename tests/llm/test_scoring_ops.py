"""Quality classifier, HMM scores and I-Match fingerprints."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelstride.llm import hmm_scoring, imatch, quality

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score double, word string, features string, f int, next long, part int"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
ODD = [(1, None), (2, ""), (3, "a"), (4, "a"), (4, "a"), (5, LONG), (None, "no id"), (8, " \n\t "),
       (9, "é ü 漢字 \U0001f600"), (11, "no id"), (12, "Some words. Some words!! SOME WORDS")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0.0, "w", "f", 1, 2, 3) for i, t in rows], SCHEMA)


# --- quality ------------------------------------------------------------------------


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        rank[s == v] = rank[s == v].mean()
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out]
    y, s = np.array([r.quality for r in held]), np.array([r.score for r in held])
    assert auc(y, s) > 0.95 and np.mean((s >= 0.5) == y) > 0.95
    clean = [r for r in rows if r.quality == 1]
    assert sum(r.predicted for r in clean) >= 0.98 * len(clean)


def test_quality_never_learns_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality.classify(docs, x).collect()} for x in (labels, turned))
    assert max(abs(a[i] - b[i]) for i in a) < 1e-6


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(3, 1), (5, 0), (9, None), (12, 0), (None, 1)], "doc_id long, quality int")
    got = quality.classify(frame(spark, ODD), labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.classify(frame(spark, ODD), labels.where("false")).collect()} == {0.5}
    assert quality.classify(frame(spark, ODD).where("false"), labels).count() == 0
    kept = quality.keep_good(frame(spark, ODD), labels.where("false"))
    assert kept.count() == len(ODD) and kept.columns == frame(spark, ODD).columns


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = quality.Network(5).fit(x, y, epochs=30)
    s = net.scores(x)
    for low, high in ((0.0, 0.2), (0.4, 0.6), (0.8, 1.0)):
        some = (s >= low) & (s < high)
        assert abs(s[some].mean() - y[some].mean()) < 0.06


# --- language model -----------------------------------------------------------------


def brute_base(rows):
    split = [(i, [*(t or "").encode().lower().split(), b""]) for i, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in split]
    c = Counter(w for (_, ws), h in zip(split, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    den = math.log10(n + 0.5 * (v + 1))
    return [(i, h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10(c[w] + 0.5) - den for w in ws))
            for (i, ws), h in zip(split, held, strict=True)]


@pytest.mark.parametrize("known", [200_000, 8, 0])
def test_base_score(spark, known):
    rnd = random.Random(0)
    words = [f"W{i}" for i in range(300)]
    rows = ODD + [(100 + i, " ".join(rnd.choice(words[:1 + i * 4]) for _ in range(rnd.randint(0, 80)))) for i in range(60)]
    got = hmm_scoring.score(frame(spark, rows), known_words=known, own_words=20, endings=16).collect()
    want = brute_base(rows)

    def key(x):
        return (x[0] if x[0] is not None else -1, x[2], x[5])

    mine = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for a, b in zip(mine, sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6)


def test_without_training_rows(spark):
    rows = [(i, "only held out words") for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1]
    got = hmm_scoring.score(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (5, 0, 0, True)
        assert r.base_score == pytest.approx(0) and math.isfinite(r.score)
    assert hmm_scoring.score(frame(spark, rows).where("false")).count() == 0


def brute_forward(model, tokens):
    p = [float(a) for a in model.start]
    total = 0.0
    for t, w in enumerate(tokens):
        if t:
            p = [sum(p[i] * float(model.move[i, j]) for i in range(len(p))) for j in range(len(p))]
        p = [x * float(model.emit[w, j]) for j, x in enumerate(p)]
        s = sum(p)
        total += math.log(s)
        p = [x / s for x in p]
    return total


def _random_model(rng, states=3, classes=7):
    emit = rng.random((classes, states))
    move = rng.random((states, states))
    start, share = rng.random(states), rng.random(states)
    return hmm_scoring._model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0), share / share.sum())


def test_forward_is_exact():
    rng = np.random.default_rng(1)
    model = _random_model(rng)
    seqs = [rng.integers(0, 7, n) for n in (1, 5, 300, 5, 41)]
    got = hmm_scoring.Packed(seqs).log_likelihoods(model)
    assert np.allclose(got, [brute_forward(model, s) for s in seqs], rtol=1e-4)


def test_expected_counts_against_paths():
    """Baum-Welch counts of short sequences from the sum over all state paths."""
    import itertools

    rng = np.random.default_rng(2)
    model = _random_model(rng, 2, 4)
    seqs, first = [rng.integers(0, 4, n) for n in (1, 4, 3)], np.array([True, False, True])
    begin, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    for s, f in zip(seqs, first, strict=True):
        paths = {}
        for path in itertools.product(range(2), repeat=len(s)):
            p = float((model.start if f else model.share)[path[0]])
            for t, (z, w) in enumerate(zip(path, s, strict=True)):
                p *= float(model.emit[w, z]) * (float(model.move[path[t - 1], z]) if t else 1)
            paths[path] = p
        z = sum(paths.values())
        for path, p in paths.items():
            begin[path[0]] += f * p / z
            for t, (k, w) in enumerate(zip(path, s, strict=True)):
                emit[w, k] += p / z
                if t:
                    move[path[t - 1], k] += p / z
    got = hmm_scoring.Packed(seqs).expected(model, first, 4)
    for a, b in zip(got, (begin, move, emit), strict=True):
        assert np.allclose(a, b, atol=1e-5)


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(3)
    seqs = [rng.integers(0, 3, 40) + 3 * (k % 2) for k in range(60)]  # two kinds of documents
    shares = np.full(6, 1 / 6)
    model = hmm_scoring.first_model(2, shares, 0)
    first = np.ones(len(seqs), bool)
    before = hmm_scoring.Packed(seqs).log_likelihoods(model).sum()
    for _ in range(20):
        model = hmm_scoring.maximised(*hmm_scoring.Packed(seqs).expected(model, first, 6), shares, prior=1.0)
    assert hmm_scoring.Packed(seqs).log_likelihoods(model).sum() > before + 500


def test_model_beats_unigrams_on_held_out(spark):
    got = [r for r in hmm_scoring.score(spark.read.parquet(f"{SF}/documents.parquet")).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in got)
    assert sum(r.score for r in got) / tokens > sum(r.base_score for r in got) / tokens + 0.1


def test_every_iteration_goes_over_all_rows(spark, monkeypatch):
    """Over 1,500 training rows: the counts of all parts, and no E-step on the driver."""
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 10, rng.integers(2, 12)) + 10 * (k % 3) for k in range(2000)]
    shares = np.full(30, 1 / 30)
    model, recent, found = hmm_scoring.first_model(4, shares, 0), None, [None] * 8
    for turn in range(2):
        for p in range(8):
            mine = docs[p::8]
            found[p] = hmm_scoring.Packed(mine).expected(model, np.ones(len(mine), bool), 30)
            recent = found[p] if recent is None else [0.5 * x + y for x, y in zip(recent, found[p], strict=True)]
            model = hmm_scoring.maximised(*(map(sum, zip(*found, strict=True)) if turn else recent), shares)

    def on_driver(*_):
        raise AssertionError("training on the driver")

    monkeypatch.setattr(hmm_scoring.Packed, "expected", on_driver)
    train = spark.createDataFrame([(k, k % 8, d.tolist()) for k, d in enumerate(docs)], "row long, part int, groups array<short>")
    got = hmm_scoring.baum_welch(train, 30, shares, states=4)
    for x, y in ((got.start, model.start), (got.move, model.move), (got.emit, model.emit)):
        assert np.allclose(x, y, atol=1e-3)


def test_rare_words_have_their_own_emissions(spark):
    """Words of one ending class and one count, met in one kind of document each."""
    rnd = random.Random(6)
    kinds = [[f"{c}{i}" for i in range(12)] for c in "ab"]
    rare = [[f"{c}{i}rare" for i in range(60)] for c in "xy"]
    rows = [(5 * i, " ".join(rnd.sample(rnd.choices(kinds[i % 2], k=30) + rnd.choices(rare[i % 2], k=6), 36)))
            for i in range(1200)]
    kept = {w for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in t.split()}
    assert kept >= {*rare[0], *rare[1]}
    tail = [i for i in range(10_000, 10_400) if zlib.crc32(str(i).encode()) % 5 == 1][:40]
    asked = [(i, " ".join([*kinds[k % 2][:10], *rare[(k % 2) ^ (k % 4 > 1)][:10]])) for k, i in enumerate(tail)]
    got = {r.doc_id: r.score - r.base_score for r in hmm_scoring.score(
        frame(spark, rows + asked), known_words=30, own_words=25, endings=4, states=2).collect()}
    match, other = ([got[i] for k, i in enumerate(tail) if (k % 4 > 1) == x] for x in (False, True))
    assert min(match) > max(other) + 3


# --- I-Match ------------------------------------------------------------------------


def test_edited_texts(spark):
    rows = [(3, "abcdefgh"), (10, "XY"), (700, "123456789"), (701, None), (5000, "uvw" * 5)]
    got = {r.doc_id: r for r in imatch.edit_likeness(frame(spark, rows), low=0.0, high=1.0).collect()}
    import hashlib

    rows = sorted(rows)
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(t) // 4
        assert got[i].edited_sha256 == hashlib.sha256((t[:len(t) - n] + after[:n]).encode()).hexdigest()
        assert got[i].n_chars == len(t)


def test_fingerprints_of_equal_and_odd_texts(spark):
    rows = ODD + [(20 + i, "the same text as others have it here too") for i in range(4)]
    got = imatch.edit_likeness(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and (r.near_next is None or 0 <= r.near_next <= 1)
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 4 * imatch.SUBSETS
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert len(set().union(*(prints[20 + i] for i in range(4)))) == 1
    assert prints[1] == prints[2] == prints[8] == {"." * 4 * imatch.SUBSETS}
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[20].near_next == 1.0 and by[1].near_next == 1.0
    assert next(r for r in got if r.doc_id is None).near_next is None
    assert imatch.edit_likeness(frame(spark, ODD).where("false")).count() == 0


def test_next_keys(spark):
    ids = random.Random(0).sample(range(1 << 40), 5000)
    got = {r.key: r.next for r in imatch.next_keys(spark.createDataFrame([(i,) for i in ids + ids[:9]], "k long"), "k").collect()}
    ids = sorted(ids)
    assert got == dict(zip(ids, ids[1:] + ids[:1], strict=True))


def test_runs_of_ids_do_not_change_results(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b = (sorted(map(tuple, imatch.edit_likeness(docs, group_ids=g).collect())) for g in (256, 3))
    assert a == b


def test_no_jump_at_any_number_of_terms(spark):
    """One band term more or less changes the entries it belongs to, however many there are."""
    rnd = random.Random(4)
    band = [f"band{k}" for k in range(300)]
    rows = []
    for n in range(1, 17):
        for k in range(12):
            some = rnd.sample(band, n)
            rare = [f"rare{rnd.randrange(10 ** 9)}" for _ in range(40)]
            rows.append((n, " ".join(some + rare), " ".join(some[1:] + rare)))
    df = spark.createDataFrame(rows, "n int, a string, b string")
    words, common = sorted(band), ["of", "the"]
    both = df.select("n", imatch.likeness(imatch.entries(F.col("a"), words, common), imatch.entries(F.col("b"), words, common)).alias("l"))
    mean = {r.n: r.m for r in both.groupBy("n").agg(F.avg("l").alias("m")).collect()}
    assert min(mean.values()) > 0.8 and abs(mean[8] - mean[7]) < 0.1, mean


def test_entries_by_brute_force(spark):
    import hashlib

    def md5(t):
        return hashlib.md5(t.encode()).hexdigest()

    def brute(text, words, common):
        terms = sorted({t for t in text.split() if t})
        out = []
        for i in range(63):
            inside = [t for t in terms if t in words and (md5(t)[i] == "0" if i < 32 else md5(t)[i - 32:i - 30] == "00")]
            dealt = [t for t in terms if t not in words and int(md5(t)[:2], 16) % 32 == i]
            if inside:
                out.append(md5(" ".join(inside))[:4])
            elif dealt:
                out.append(md5(min(dealt, key=lambda t: (t in common, md5(t))))[:4])
            else:
                out.append("....")
        return out

    rnd = random.Random(9)
    words, common = [f"w{k}" for k in range(400)], [f"c{k}" for k in range(30)]
    texts = ["", "c1", "w1", "r1"] + [" ".join(rnd.choice(words + common * 5 + [f"r{rnd.randrange(9999)}" for _ in range(400)])
                                               for _ in range(rnd.randrange(600))) for _ in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", imatch.entries(F.col("t"), words, common).alias("e")).collect():
        assert r.e == brute(r.t, words, common)


def test_edited_texts_are_nearer_than_the_next(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    nearer = imatch.edit_likeness(docs).agg(F.avg((F.col("near_edited") > F.col("near_next")).cast("double")),
                                            F.avg("near_edited"), F.avg("near_next"),
                                            F.avg((F.col("near_edited") < 0.1).cast("double"))).first()
    print("near_edited above near_next, means, near_edited under 0.1:", tuple(nearer))
    assert nearer[0] > 0.9
