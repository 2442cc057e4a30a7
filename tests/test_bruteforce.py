"""Randomised checks of column functions against plain-Python reference rules."""

import math
import random
import re
import sys
import unicodedata

import pandas as pd
from pyspark.sql import functions as F

from panelstride.functions import clean_numeric, normalise_header
from panelstride.functions.text import accent_fold, fold_text


def reference_number(text):
    """The script chain's rule: decimal comma to point, drop blanks and NBSP,
    'nan'/'None'/'' missing, then coerce; non-finite is missing here."""
    if text is None:
        return None
    t = text.replace(",", ".").replace(" ", "").replace("\xa0", "")
    if t in ("nan", "None", ""):
        return None
    v = pd.to_numeric(pd.Series([t]), errors="coerce").iloc[0]
    return None if pd.isna(v) or math.isinf(v) else float(v)


def test_number_text_matches_reference(spark):
    rnd = random.Random(7)
    alphabet = "0123456789,. \xa0-e"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))) for _ in range(3000)]
    texts += ["nan", "None", "", " 1 234,5 ", "1e3", "-0,5", ".5", "5.", "1,2,3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(clean_numeric("t")).collect()]
    want = [reference_number(t) for t in texts]

    def same(g, w):
        # pandas' text parser is not correctly rounded for large exponents
        # ('.14e71' -> 1.4000000000000003e+70); Spark, like float(), is.
        return g == w or (g is not None and w is not None and math.isclose(g, w, rel_tol=1e-15))

    bad = [(t, g, w) for t, g, w in zip(texts, got, want) if not same(g, w)]
    assert not bad, bad[:10]


def reference_header(text):
    s = text.strip().replace("ı", "i").replace("İ", "i")
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    return re.sub(r"[^a-z0-9]+", "_", s.lower()).strip("_")


def test_header_rule_matches_nfkd(spark):
    rnd = random.Random(11)
    pool = [chr(c) for lo, hi in ((0xA0, 0x24F), (0x1E00, 0x1EFF), (0x2100, 0x2BFF), (0xFB00, 0xFB4F), (0xFF01, 0xFF5E),
                                  (0x1D400, 0x1D7FF), (0x300, 0x36F)) for c in range(lo, hi + 1)]
    pool += list("abcXYZ019 ()/-_.ıİ")
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(1, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(normalise_header(F.col("t"))).collect()]
    want = [reference_header(t) for t in texts]
    bad = [(t, g, w) for t, g, w in zip(texts, got, want) if g != w]
    assert not bad, bad[:10]


def test_fold_equals_the_unicode_database(spark):
    """Every assigned code point, alone and between letters."""
    points = [chr(c) for c in range(0x20, sys.maxunicode + 1) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    texts = points + ["".join(points[k:k + 40]) for k in range(0, len(points), 40)]
    want = ["".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]
    assert [fold_text(t) for t in texts] == want
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(8)
    got = dict(df.select("i", accent_fold(F.col("t"))).collect())
    bad = [(t, got[i], w) for i, (t, w) in enumerate(zip(texts, want, strict=True)) if got[i] != w]
    assert not bad, bad[:5]
