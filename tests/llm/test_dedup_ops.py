"""Exact dedup, SimHash near-dedup and substring dedup against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from panelstride.llm import common, exact_dedup, simhash_dedup, substring_dedup

SCHEMA = "doc_id long, text string, kept int, recipe string, bits double, n long, start int, run long, source string"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 1, "r", 0.5, 7, 3, 9, "s") for i, t in rows], SCHEMA)


ODD = [(1, None), (2, ""), (3, "a"), (4, "a"), (4, "a"), (5, LONG), (6, LONG + " end"), (7, LONG),
       (None, "no id"), (None, "no id"), (8, " \n\t "), (9, "é ü 漢字 \U0001f600"), (10, "A"), (11, "no id")]


# --- exact duplicates ---------------------------------------------------------------


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    low = -(1 << 63)
    return sorted((i if i is not None else low, max((x for x in groups[t or ""] if x is not None), default=low),
                   len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize("options", [{}, {"bits": 3, "min_chars": 2, "max_chars": 5}, {"min_chars": 16, "max_chars": 64}])
def test_exact_duplicates(spark, options):
    got = exact_dedup.exact_duplicates(frame(spark, ODD), **options).collect()
    low = -(1 << 63)
    assert sorted((r.doc_id if r.doc_id is not None else low, r.keep_id if r.keep_id is not None else low,
                   r.group_size, r.text_sha256) for r in got) == brute_exact(ODD)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({t or "" for _, t in ODD})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_chunks_join_to_the_text(spark):
    texts = [t or "" for _, t in ODD]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", exact_dedup.chunks(F.col("t"), 16, 64).alias("c")).collect():
        assert "".join(r.c) == r.t and all(len(c) <= 64 for c in r.c)


def test_equal_passages_give_equal_chunks(spark):
    rnd = random.Random(1)
    shared = " ".join("".join(rnd.choice("aeinrst") for _ in range(5)) for _ in range(600))
    df = spark.createDataFrame([(shared,), ("something else before it. " + shared,)], "t string")
    a, b = (set(r.c) for r in df.select(exact_dedup.chunks(F.col("t"), 64, 512).alias("c")).collect())
    assert len(a & b) > len(a) / 2


def test_drop_exact_duplicates(spark):
    out = exact_dedup.drop_exact_duplicates(frame(spark, ODD))
    assert out.columns == frame(spark, ODD).columns
    got = Counter(r.text or "" for r in out.collect())
    assert set(got.values()) == {1} and set(got) == {t or "" for _, t in ODD}
    assert {r.doc_id for r in out.collect() if r.text == LONG} == {7}


# --- SimHash ------------------------------------------------------------------------


def brute_simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(3, len(words))
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_components(prints):
    """doc -> smallest doc reachable over links of 3 bits or fewer."""
    docs = sorted(prints)
    pairs = [(a, b) for i, a in enumerate(docs) for b in docs[i + 1:] if (prints[a] ^ prints[b]).bit_count() <= 3]
    return roots(docs, pairs)


@pytest.mark.parametrize("direct_limit", [256, 1, 0])
def test_near_duplicates(spark, direct_limit):
    rnd = random.Random(3)
    words = [f"word{i}" for i in range(400)]
    rows = [(100 + i, " ".join(rnd.choice(words) for _ in range(300))) for i in range(12)]
    for i in range(40):  # edited copies
        t = rnd.choice(rows[:12])[1].split()
        for _ in range(rnd.randint(1, 4)):
            t[rnd.randrange(len(t))] = rnd.choice(words)
        rows.append((i, " ".join(t)))
    rows += [(i, t) for i, t in ODD if i is not None and i > 40] + [(500, None), (501, ""), (502, "a"), (503, "A b")]
    got = {r.doc_id: r for r in simhash_dedup.near_duplicates(frame(spark, rows), direct_limit=direct_limit).collect()}
    prints = {i: brute_simhash(t) for i, t in rows}
    assert {i: got[i].fingerprint for i in prints} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: got[i].component_id for i in prints} == brute_components(prints)


def _signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


@pytest.mark.parametrize("direct_limit", [10_000, 4, 0])
def test_links_find_every_pair(spark, direct_limit):
    """Fingerprints planted at every distance from 0 to 6, in one dense cloud."""
    rnd = random.Random(5)
    prints = {rnd.getrandbits(64) for _ in range(30)}
    for p in list(prints):
        for _ in range(12):
            prints.add(p ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 6))))
    signed = sorted(_signed(p) for p in prints)
    nodes = spark.createDataFrame([(p,) for p in signed], "bits long")
    edges = {(r.a, r.b) for r in simhash_dedup.links(nodes, 3, direct_limit).collect()}
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3 and a < b for a, b in edges)
    every = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1:]
             if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}
    if direct_limit == 10_000:
        assert edges == every
    assert roots(signed, edges) == roots(signed, every)


def test_pigeonring_keys_cover_all_flips():
    """Any 3 flipped bits leave one of the 24 join keys as it was."""
    keys = [m & ((1 << 64) - 1) for _, m in simhash_dedup.join_keys(3)]
    assert len(keys) == 24 and all(k.bit_count() == 32 for k in keys)
    rnd = random.Random(0)
    for _ in range(20_000):
        flipped = sum(1 << b for b in rnd.sample(range(64), 3))
        assert any(not flipped & k for k in keys)


def test_drop_near_duplicates(spark):
    rows = [(5, "x y z"), (2, "x y z"), (2, "x y z"), (9, None), (8, ""), (None, "lonely words here")]
    out = simhash_dedup.drop_near_duplicates(frame(spark, rows))
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == [
        (0, "lonely words here"), (2, "x y z"), (2, "x y z"), (8, "")]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, j) for j in range(1001, 1200)] + [(7, 7), (3, 2)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in common.components(df).collect()}
    assert got == {**dict.fromkeys(range(101), 0), **dict.fromkeys(range(1000, 1200), 1000)}


# --- repeated passages --------------------------------------------------------------


def brute_repeats(rows, k):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[p:p + k]) for _, w in split for p in range(len(w) - k + 1))
    out = []
    for i, w in split:
        gone = {q for p in range(len(w) - k + 1) if seen[tuple(w[p:p + k])] > 1 for q in range(p, p + k)}
        kept = b" ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((i if i is not None else -1, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def repeats(spark, rows, k, group):
    got = substring_dedup.remove_repeats(frame(spark, rows), k=k, group=group).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed, r.kept_sha256) for r in got)


@pytest.mark.parametrize("seed,k,group,letters", [(1, 5, 2, 3), (2, 7, 3, 12), (3, 35, 8, 200), (4, 6, 1, 2)])
def test_remove_repeats(spark, seed, k, group, letters):
    rnd = random.Random(seed)
    words = [f"v{i}" for i in range(letters)]
    passages = [[rnd.choice(words) for _ in range(rnd.randint(k - 1, 3 * k))] for _ in range(4)]
    rows = []
    for i in range(40):
        t = [rnd.choice(words) for _ in range(rnd.randint(0, 3 * k))]
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randint(0, len(t))
            t[at:at] = rnd.choice(passages)
        rows.append((i, " ".join(t)))
    rows += [(100, "z " * 4 * k), (101, None), (102, ""), (103, rows[5][1]), (103, rows[5][1]), (None, rows[6][1])]
    assert repeats(spark, rows, k, group) == brute_repeats(rows, k)


def test_remove_repeats_of_long_and_odd_texts(spark):
    assert repeats(spark, ODD, 35, 8) == brute_repeats(ODD, 35)


def test_copies_with_different_neighbours(spark):
    """A passage that most copies continue alike, but not all: paths branch."""
    a, b, c = ([f"{x}{i}" for i in range(60)] for x in "abc")
    rows = [(1, " ".join(a + b)), (2, " ".join(a + b)), (3, " ".join(a + c)), (4, " ".join(c + b)),
            (5, " ".join(b[:36])), (6, " ".join(b[:34])), (7, " ".join(a[10:50] + c[5:45]))]
    assert repeats(spark, rows, 35, 8) == brute_repeats(rows, 35)


def test_empty_tables(spark):
    none = frame(spark, ODD).where("false")
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert exact_dedup.drop_exact_duplicates(none).count() == 0
    assert simhash_dedup.near_duplicates(none).count() == 0
    assert simhash_dedup.drop_near_duplicates(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
