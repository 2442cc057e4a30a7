"""Alignment of whole texts, counted by brute force."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelstride.llm import token_alignment as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, row long, radix int, n_a int, records binary, pair long, n long"
LONG = " ".join(f"word{k % 311}'s," for k in range(2_000))
ODD = [(1, None), (2, ""), (3, " "), (4, "a  b\n c"), (4, "a  b\n c"), (5, LONG), (None, "no id"), (None, None),
       (6, "<|endoftext|> <s> </s> <unk>"), (7, "▁not▁spelt"), (8, "é ü 漢字 \U0001f600 ﬁ é"), (9, "x" * 5000), (10, "\x00\x1c \x85 　 z"),
       (11, "tabs\t\tand \n\n lines \r\n  end  "), (12, "the the the"), (13, "The cat's 123456 dogs!!  ... (yes)"), (14, "<0x41> A")]

a_model = Tokenizer.from_file(A)
a_model.encode_special_tokens = True
b_model = sentencepiece.SentencePieceProcessor(model_file=B)
alphabet = ta.byte_alphabet()


def brute_links(text):
    """(a ids, b ids, groups as text, links) of a whole text, or None."""
    if not text:
        return None
    a, b = a_model.encode(" " + text, add_special_tokens=False), b_model.encode(text)
    xs = [bytes(alphabet[c] for c in t) for t in a.tokens]
    ys = []
    for i in b:
        p = b_model.id_to_piece(i)
        ys.append(bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode())
    want = (" " + text).encode()
    if b"".join(xs) != want or b"".join(ys) != want:
        return None
    ends_a = dict(zip(np.cumsum([len(x) for x in xs]).tolist(), range(len(xs)), strict=True))
    ends_b = dict(zip(np.cumsum([len(y) for y in ys]).tolist(), range(len(ys)), strict=True))
    groups, links, la, lb = [], [], 0, 0
    for e in sorted(ends_a.keys() & ends_b.keys()):
        i, j = ends_a[e], ends_b[e]
        groups.append(",".join(map(str, a.ids[la:i + 1])) + "|" + ",".join(map(str, b[lb:j + 1])))
        links.append((b[j], a.ids[i]))
        la, lb = i + 1, j + 1
    return a.ids, b, ";".join(groups), links


def brute(docs):
    each = [(i, brute_links(t)) for i, t in docs]
    count = Counter(link for _, x in each if x for link in x[3])
    most = Counter()
    for (b, _), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for i, x in each:
        if x is None:
            out.append((str(i), 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((str(i), len(x[0]), len(x[1]), x[2].count(";") + 1, len(x[3]), sum(count[k] == most[k[0]] for k in x[3]),
                        sum(count[k] for k in x[3]), sha256(x[2].encode()).hexdigest()))
    return sorted(out)


def run(spark, docs, **options):
    df = spark.createDataFrame([(i, t, 1, 2, 3, b"r", 4, 5) for i, t in docs], SCHEMA)
    got = ta.align(df, A, B, **options).collect()
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got)


def test_odd_texts(spark):
    assert run(spark, ODD) == brute(ODD)


@pytest.mark.parametrize("spill", [1, 300])
def test_many_runs_and_merges(spark, monkeypatch, spill):
    monkeypatch.setattr(ta, "FAN_IN", 2)
    rnd = random.Random(5)
    vocabulary = ["the", "of", "ing", "token's", "mañana", "123", "...", "\n", "", "xylophone", "été"]
    docs = [(k, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(60)))) for k in range(150)]
    assert run(spark, docs, spill_links=spill) == brute(docs)


def test_no_rows(spark):
    assert run(spark, []) == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é\n\t '.1▁ 　\x1c\x85漢\U0001f600<|>s"), max_size=40))
def test_segments_give_the_ids_of_whole_texts(text):
    both = ta.aligner(A, B)
    if not text:
        return
    assert " ".join(both.segments(text)) == text
    parts = both.look_up([both.segments(text)])[0]
    want = brute_links(text)
    if want is None:
        assert None in parts
    else:
        n_a, n_b, groups, n, links = zip(*parts, strict=True)
        assert (sum(n_a), sum(n_b), ";".join(groups), sum(n)) == (len(want[0]), len(want[1]), want[2], len(want[3]))
        found = np.frombuffer(b"".join(links), np.int64)
        assert [(int(x) >> both.shift, int(x) & ((1 << both.shift) - 1)) for x in found] == want[3]


def test_runs_round_trip():
    rnd = random.Random(1)
    links = [np.array([rnd.randrange(1 << 30) % 97 << 16 | rnd.randrange(5) for _ in range(rnd.randrange(50))], np.int64) for _ in range(40)]
    rows = sorted(rnd.sample(range(1 << 40), 40))
    want = Counter((rows[d], int(p)) for d, x in enumerate(links) for p in x)
    got, pairs = Counter(), Counter()
    slices = list(ta.spill([x.tobytes() for x in links], rows, lambda p: p >> 16))
    for r, pairs_blob, records, ids in slices:
        keys, counts, sizes = ta.directory(pairs_blob)
        assert all(k >> 16 & 7 == r for k in keys) and (np.diff(keys) > 0).all()
        names = np.cumsum(ta.unpacked(ids)[0])
        step, times = ta.unpacked(records)
        at = 0
        for k, c, n in zip(keys, counts, sizes, strict=True):
            docs = np.cumsum(step[at:at + n])
            for d, t in zip(docs, times[at:at + n], strict=True):
                got[int(names[d]), int(k)] += int(t)
            pairs[int(k)] += int(c)
            at += n
    assert got == want
    every = [s[1] for s in slices]
    assert dict(ta.merged(every)) == dict(pairs) and [k for k, _ in ta.merged(every)] == sorted(pairs)
