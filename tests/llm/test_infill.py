import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from tests.oracle import connect, difference
from tidelane.llm import infill
from tidelane.llm.queries import ORACLES, QUERIES


def brute(doc_id, text, fim=100, spm=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(lines)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= fim:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("sf", [SF_DIR, "/root/testdata/sf0.01"])
def test_query_against_sql(spark, sf):
    assert difference(QUERIES["op12_fill_in_middle"](spark, sf), connect(sf), ORACLES["op12_fill_in_middle"]) is None


def check(docs, made):
    back = infill.restored(made.select("doc_id", "made.*"), "output", "form", "text")
    have = sorted((str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.text) for r in back.collect())
    want = sorted((str(r.doc_id), *brute(r.doc_id, r.text), r.text or "") for r in docs.collect())
    assert [tuple(map(str, r)) for r in have] == [tuple(map(str, r)) for r in want]


def test_odd_rows(spark, odd, nothing):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(["\n", "\n\n\n", "a", "a\n", "\r\nb c\n", "has <P> in it\nx\n", "<S", "S>\n<\nM>", "é\n\U0001f600\n<\n"])], "doc_id long, text string")
    docs = odd.select("doc_id", "text").union(more)
    check(docs, infill.fill_in_middle(docs, "made"))
    clash = odd.withColumn("made", F.lit(1)).withColumn("draw", F.lit(2)).withColumn("output", F.lit(3))
    out = infill.fill_in_middle(clash, "made")
    assert sorted(out.columns) == sorted(clash.columns) and out.count() == clash.count()
    assert infill.fill_in_middle(nothing, "made").count() == 0


def test_rates(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "'a\nb\nc\n' AS text")
    forms = {r["form"]: r["count"] for r in infill.fill_in_middle(docs, "made", fim_percent=40, spm_percent=25).groupBy("made.form").count().collect()}
    assert abs(forms["plain"] - 1200) < 100 and abs(forms["spm"] - 200) < 60 and sum(forms.values()) == 2000


def test_rotations():
    rng = random.Random(3)
    for step in (1, 7, infill.STEP):
        infill.STEP, before = step, infill.STEP
        try:
            for _ in range(200):
                text = bytes(rng.randrange(256) for _ in range(rng.randrange(40)))
                a, b, c = sorted(rng.randrange(len(text) + 1) for _ in range(3))
                data = bytearray(text)
                infill.rotate(np.frombuffer(data, np.uint8), a, b, c)
                assert bytes(data) == text[:a] + text[b:c] + text[a:b] + text[c:]
        finally:
            infill.STEP = before


def test_round_trip_of_any_cuts_even_where_texts_look_like_parts_of_sentinels():
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice("<PSM>ab\né") for _ in range(rng.randrange(24))).encode()
        if any(m in text for m in (infill.PREFIX, infill.SUFFIX, infill.MIDDLE)):
            continue
        a, b = sorted(rng.randrange(len(text) + 1) for _ in range(2))
        p, m, s = text[:a], text[a:b], text[b:]
        for form, want in (("psm", b"<P>" + p + b"<S>" + s + b"<M>" + m), ("spm", b"<S>" + s + b"<P>" + p + b"<M>" + m), ("plain", text)):
            made = infill.rearrange(text, a, b, form)
            assert made == want and infill.restore(made, form) == text
    with pytest.raises(ValueError):
        infill.rearrange(b"a", 0, 0, "mps")
    with pytest.raises(ValueError):
        infill.restore(b"a", "mps")


def test_a_long_text_restores():
    text = ("line é\n" * 1_500_000).encode()
    made = infill.rearrange(text, 7 * 100, 8 * 900_000, "psm")
    assert infill.restore(made, "psm") == text
