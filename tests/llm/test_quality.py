import math
import re

import pytest

from tests.llm.conftest import SF_DIR
from tidelane.llm import quality
from tidelane.llm.queries import QUERIES


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), n < 50 or 100 * len(repeated) > 50 * n


@pytest.mark.parametrize("sf", [SF_DIR, "/root/testdata/sf0.01"])
def test_query(spark, sf):
    found = QUERIES["op8_quality_rules"](spark, sf).collect()
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(rows[r.doc_id])
        assert r.kept == (not r.base_failed and r.failed_rules == "")


def test_exact_binomial_bound():
    assert math.isclose(quality.at_most(0, 10, 0.1), 0.9**10) and math.isclose(quality.at_most(10, 10, 0.1), 1)
    assert math.isclose(quality.at_most(2, 30, 0.2), sum(math.comb(30, k) * 0.2**k * 0.8 ** (30 - k) for k in range(3)))


def test_cutoffs_need_evidence():
    cutoffs = (3.0, 2.0, 1.0)
    assert quality.choose([1000, 0, 0, 0], [10, 0, 5, 5], cutoffs, 0.01, 0.05) == 2.0
    assert quality.choose([100, 0, 0, 0], [10, 0, 5, 5], cutoffs, 0.01, 0.05) == math.inf  # too few good ones to be sure
    assert quality.choose([1000, 0, 0, 20], [10, 0, 5, 5], cutoffs, 0.01, 0.05) == math.inf
    assert quality.choose([0, 0, 0, 0], [10, 0, 5, 5], cutoffs, 0.01, 0.05) == math.inf
    assert quality.choose([1000, 0, 0, 0], [0, 0, 0, 0], cutoffs, 0.01, 0.05) == math.inf  # nothing to gain
    assert quality.choose([1000, 0, 20, 0], [0, 0, 5, 5], cutoffs, 0.01, 0.05) == 3.0


def test_false_rejections_stay_below_the_limit():
    """Over many draws, the chosen cutoff's true share of rejected good documents exceeds the limit in at most 5 percent."""
    import numpy as np

    rng, bad = np.random.default_rng(5), 0
    shares = np.array([0.0, 0.02, 0.045, 0.06, 0.2])  # of good documents above 0, 1 .. cutoffs, from the mildest
    for _ in range(400):
        above = (rng.random(500)[:, None] < shares).sum(1)
        good = np.bincount(above, minlength=6).tolist()
        cut = quality.choose(good, [0, 500, 0, 0, 0, 0], (5.0, 4.0, 3.0, 2.0, 1.0), 0.05, 0.05)
        if cut < math.inf:
            bad += shares[[5.0, 4.0, 3.0, 2.0, 1.0].index(cut)] > 0.05
    assert bad <= 400 * 0.08  # the least cutoff catches all bad ones, so the last that passes is taken


def labelled(spark, n):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, good if i % 4 else good.replace("word", "w# "), "en" if i % 2 else "de") for i in range(n)] + [(n, good, "rare"), (n + 1, good.replace("word", "w# "), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(n)] + [(1, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_junk_goes_and_clean_documents_stay(spark):
    docs, labels = labelled(spark, 4000)
    kept = {r.doc_id for r in quality.keep_good(docs, labels).collect()}
    assert all((i in kept) == (i % 4 > 0 or i % 2 == 0) for i in range(1, 4000, 2))
    slim = quality.measure(docs, "m")
    cutoffs = quality.calibrate(slim, labels, "m", least_share=0.01)
    assert sorted(cutoffs) == ["", "de", "en"] and all(c == math.inf for c in cutoffs[""])
    assert quality.keep_good(docs, labels.limit(0)).count() == docs.count()


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    found = quality.measure(odd, "found")
    assert found.columns == odd.columns
    have = sorted((str(r.doc_id), *list(r.found)[:5]) for r in found.collect())
    assert have == sorted((str(r.doc_id), *brute(r.text)[:5]) for r in odd.collect())
    assert quality.keep_good(odd, labels).columns == odd.columns and quality.keep_good(nothing, labels).count() == 0
