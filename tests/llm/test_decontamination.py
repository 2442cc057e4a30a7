"""Phrase and proximity matches against brute force."""

import hashlib
import random
import re

import pytest

from panelstride.llm import decontamination as dc

DOCS = "doc_id long, text string, pos int, term string, items string, window long, n int"
ITEMS = "item_id string, text string, term_id long, rank int, start int"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, "t", "i", 2, 3) for i, t in docs], DOCS),
            spark.createDataFrame([(i, t, 1, 2, 3) for i, t in items], ITEMS))


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def item_windows(items, size):
    out = set()
    for i, t in items:
        w = words(t)
        out |= {(i or "", tuple(w[k:k + size])) for k in range(max(1, len(w) - size + 1)) if w}
    return out


def brute(docs, items, size):
    asked, out = item_windows(items, size), []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, win in asked:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    ids.add(item)
        out.append((str(i), len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def run(spark, docs, items, size):
    got = dc.decontaminate(*frames(spark, docs, items), size=size).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got)


ITEM = "The quick Brown fox, jumps over the lazy dog and then it runs away"
ODD = [(1, None), (2, ""), (3, " .,;"), (4, ITEM), (4, ITEM), (5, "x " + ITEM.upper() + "! y " + ITEM), (None, "é ü " + ITEM),
       (None, None), (6, ".word."), (7, "a1b2"), (8, "the the the the"), (9, "漢字 İ K ß"), (10, "the quick brown fox jumps over the"),
       (11, " ".join(f"w{k % 50}" for k in range(20_000)) + " " + ITEM), (-(1 << 63), "word"), (12, "the lazy dog dog")]
ITEMS_ODD = [("a", ITEM), ("b", ITEM), ("a", "word"), (None, "the the"), ("c", None), ("d", ""), ("e", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"),
             ("f", "İ k"), ("g", "the lazy dog dog"), ("h", "nowhere to be found here or there")]


@pytest.mark.parametrize("size", [10, 3, 1])
def test_odd_rows(spark, size):
    assert run(spark, ODD, ITEMS_ODD, size) == brute(ODD, ITEMS_ODD, size)


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_random_texts_with_and_without_broadcasts(spark, monkeypatch, limit):
    monkeypatch.setattr(dc, "BROADCAST_BYTES", limit)
    rnd = random.Random(3)
    docs = [(k, " ".join(rnd.choice("abcde") for _ in range(rnd.randrange(40)))) for k in range(120)]
    items = [(f"i{k}", " ".join(rnd.choice("abcde") for _ in range(rnd.randrange(1, 9)))) for k in range(40)]
    assert run(spark, docs, items, 4) == brute(docs, items, 4)


def test_empty_tables(spark):
    assert run(spark, [], ITEMS_ODD, 10) == []
    assert run(spark, ODD, [], 10) == brute(ODD, [], 10)


@pytest.mark.parametrize("slop", [0, 1, 2])
def test_proximity_matches(spark, slop):
    rnd = random.Random(slop)
    docs = [(k, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(30)))) for k in range(60)]
    items = [("x", "a b c d"), ("y", "b a"), ("z", "h g f")]
    often = {c: sum(words(t).count(c) for _, t in docs) for c in "abcdefgh"}
    want = set()
    for item, win in item_windows(items, 4):
        # rarest first; ties by place
        order = sorted(range(len(win)), key=lambda k: (often[win[k]], k))
        for i, t in docs:
            w = words(t)
            for p in range(len(w)):
                s = p - order[0]
                if w[p] == win[order[0]] and all(
                        any(0 <= q < len(w) and w[q] == win[k] for q in range(s + k - slop, s + k + slop + 1)) for k in order[1:]):
                    want.add((item, i, s, len(win)))
    got = dc.matches(*frames(spark, docs, items), size=4, slop=slop).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    if slop == 0:
        assert all(tuple(words(dict(docs)[i])[s:s + n]) in {w for x, w in item_windows(items, 4) if x == item} for item, i, s, n in want)


def test_the_whole_index(spark):
    docs, _ = frames(spark, [(1, "B a, b"), (2, None)], [])
    assert sorted(tuple(r) for r in dc.postings(docs).select("doc_id", "pos", "term").collect()) == [
        (1, 0, "b"), (1, 1, "a"), (1, 2, "b"), (1, 3, dc.END), (2, 0, dc.END)]
