"""The Merkle manifest against a plain tree."""

import zlib
from hashlib import sha256

import pytest

from panelstride.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos long, node string, width int, leaf string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(nodes, arity):
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([h(rows[-1][a:a + arity]) for a in range(0, len(rows[-1]), arity)])
    return rows


def siblings(rows, k, arity):
    out = []
    for row in rows[:-1]:
        a = k - k % arity
        out.append((row[a:k], row[k + 1:a + arity]))
        k //= arity
    return out


def brute(rows, arity):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r, leaf(r)))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {s: tree([x[1] for x in by[s]], arity) for s in names}
    top = tree([trees[s][-1][0] for s in names], arity)
    root, out = top[-1][0], []
    for j, s in enumerate(names):
        for k, (r, lf) in enumerate(by[s]):
            way = siblings(trees[s], k, arity) + siblings(top, j, arity)
            now = lf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                now = leaf((*r[:4], r[4] if r[4] is None else r[4].translate(LOW)))
            for left, right in way:
                now = h([*left, now, *right])
            out.append((str(r[0]), lf, trees[s][-1][0], root, h(x for a, b in way for x in a + b), now, now == root))
    return sorted(out)


def run(spark, rows, arity, levels):
    df = spark.createDataFrame([(*r, 1, "n", 2, "l") for r in rows], SCHEMA)
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
                  for r in merkle.manifest(df, arity=arity, levels=levels).collect())


ODD = [(None, None, None, None, None), (None, None, None, None, None), (1, None, "", 0, ""), (2, "", "en", 3, "Abc"),
       (2, "", "en", 3, "Abc"), (2, "", "en", 3, "aBC"), (5, "é", "fr", 1, "É"), (6, "z", None, None, "Ü" * 5000),
       (-7, "\U0001f600", "en", -1, "X"), (9, "￿", "en", 1, "Y Z"), (1 << 60, "z", "en", 2, "Q"), (None, "z", "en", 2, "Q")]


@pytest.mark.parametrize(("arity", "levels"), [(16, 2), (2, 1), (3, 2)])
def test_odd_rows(spark, arity, levels):
    assert run(spark, ODD, arity, levels) == brute(ODD, arity)


def test_a_hot_source_over_many_tiers(spark):
    rows = [(k * 7 % 1009, "hot", "en", k, f"Text {k}") for k in range(700)]
    rows += [(k, f"s{k % 37}", "en", k, f"Other {k}") for k in range(120)] + [(k, f"one{k}", "en", k, "A") for k in range(40)]
    want = brute(rows, 2)
    assert run(spark, rows, 2, 2) == want  # five tiers of blocks of four
    assert run(spark, rows, 16, 2) == brute(rows, 16)
    assert {r[6] for r in want} == {True, False}


@pytest.mark.parametrize("n", [1, 16, 17, 256, 257])
def test_widths_at_the_edges(spark, n):
    rows = [(k, "s", "en", k, f"T{k}") for k in range(n)]
    assert run(spark, rows, 16, 2) == brute(rows, 16)


def test_no_rows(spark):
    assert run(spark, [], 16, 2) == []


def test_tampering_is_found_and_only_there(spark):
    rows = [(k, f"s{k % 3}", "en", 1, "ABC" if k % 2 else "abc") for k in range(200)]
    for r in run(spark, rows, 16, 2):
        hit = zlib.crc32(r[0].encode()) % 5 == 0 and int(r[0]) % 2
        assert r[6] == (not hit)
