import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import SF_DIR
from tidelane.llm import neardup
from tidelane.llm.components import components
from tidelane.llm.queries import QUERIES

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
NONE = (np.zeros(0, np.uint64), np.zeros(0))


def shingles(text):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").translate(LOWER))
    out = {}
    for i in range(max(1, len(words) - 4) if words else 0):
        out[tuple(words[i : i + 5])] = out.get(tuple(words[i : i + 5]), 0) + 1
    return out


def brute(rows, similar=0.8, common=0.1):
    """Class of each row by all pairs, with document frequencies over all rows."""
    own = [shingles(t) for _, t in rows]
    df = {}
    for s in own:
        for k in s:
            df[k] = df.get(k, 0) + 1
    n = len(rows)
    factor = {k: max(0.0, min(1.0, np.log(n / d) / -np.log(common))) if d > common * n else 1.0 for k, d in df.items()}
    weight = [{k: c * factor[k] for k, c in s.items() if factor[k] > 0} for s in own]
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = {}
    for i in range(n):
        for j in sorted({j for k in weight[i] for j in holders.get(k, ())}):  # all texts that share a shingle
            both = sum(min(w, weight[j].get(k, 0)) for k, w in weight[i].items())
            total = sum(weight[i].values()) + sum(weight[j].values()) - both
            if both / total >= similar - 1e-9:
                up[top(i)] = top(j)
        for k in weight[i]:
            holders.setdefault(k, []).append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)] = min([x for x in (least.get(top(i)), doc_id) if x is not None], default=None)
    return [(doc_id, least[top(i)]) for i, (doc_id, _) in enumerate(rows)]


@pytest.mark.parametrize("sf", [SF_DIR, "/root/testdata/sf0.01"])
def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = sorted(brute(rows))
    assert any(a != b for a, b in want)
    assert sorted(map(tuple, QUERIES["op10_near_duplicates"](spark, sf).collect())) == want


def test_families_of_copies(spark):
    """Independent edits of one text: copies are similar to it, not always to each other, and the least id is a copy."""
    random.seed(6)
    rows, n = [], 1000
    for family in range(25):
        base = [f"f{family}w{i}" for i in range(120)]
        for _ in range(random.choice([1, 2, 5, 12])):
            copy = list(base)
            for _ in range(random.choice([0, 1, 2, 3, 5])):
                copy[random.randrange(120)] = f"e{random.random()}"
            rows.append((n, " ".join(copy)))
            n += 1
        rows.append((n, " ".join(base)))
        n += 1
    random.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(brute(rows, common=0.5))
    for block_rows in (1024, 3):
        have = sorted((r.doc_id, r.class_id) for r in neardup.near_duplicates(docs, common=0.5, block_rows=block_rows).collect())
        assert have == want


def test_samples_agree_as_often_as_weights_overlap():
    words = [f"w{i}" for i in range(400)]
    left = " ".join(words[:300] + words[:60])
    right = " ".join(words[60:])
    texts = pa.array([left.encode(), right.encode()], pa.binary())
    _, found = neardup.samples(texts, 5, NONE, 2000)
    want = neardup.similarity(texts[:1], texts[1:], 5, NONE)[0]
    assert abs((found[0] == found[1]).mean() - want) < 0.04
    a, b = shingles(left), shingles(right)
    both = sum(min(c, b.get(k, 0)) for k, c in a.items())
    assert abs(want - both / (sum(a.values()) + sum(b.values()) - both)) < 1e-12


def test_weights_change_the_samples_in_proportion():
    weighted = [(np.zeros(200, np.int64), np.arange(1, 201, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.r_[np.full(100, w), np.full(100, 1.0)]) for w in (1.0, 3.0)]
    original = neardup._weighted
    found = []
    for w in weighted:
        neardup._weighted = lambda *a, w=w: w
        try:
            found.append(neardup.samples(pa.array([b"x"], pa.binary()), 5, NONE, 3000)[1][0])
        finally:
            neardup._weighted = original
    assert abs((found[0] == found[1]).mean() - 200 / 400) < 0.04


def test_common_shingles_are_exact(spark):
    rows = [(f"a b c d e {'f g' if i % 2 else 'x'} {i}",) for i in range(40)]
    known, weight = neardup.common_shingles(spark.createDataFrame(rows, "text string"), 5, 0.3)
    counts = {}
    for (t,) in rows:
        for k in shingles(t):
            counts[k] = counts.get(k, 0) + 1
    assert sorted(np.round(weight, 9).tolist()) == sorted(round(max(0.0, np.log(40 / c) / -np.log(0.3)), 9) for c in counts.values() if c > 12)


def test_components_of_random_links(spark):
    random.seed(7)
    links = [(f"{random.randrange(300):03}", f"{random.randrange(300):03}") for _ in range(170)] + [(f"x{i:03}", f"x{i + 1:03}") for i in range(60)]
    up = {x: x for pair in links for x in pair}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        up[high] = low
    have = {r.node: r.component for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert have == {x: top(x) for x in up if top(x) != x}


def test_odd_rows(spark, odd, nothing):
    have = sorted((str(r.doc_id), str(r.class_id)) for r in neardup.near_duplicates(odd).collect())
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert have == sorted((str(a), str(b)) for a, b in brute(rows))
    kept = sorted(str(r.doc_id) for r in neardup.keep_one(odd).collect())
    assert kept == sorted(["1", "2", "3", "4", "7", "8", "None", "9", "11", "12"])
    assert neardup.near_duplicates(nothing).count() == 0 and neardup.keep_one(nothing).columns == odd.columns


def test_one_row_of_each_class_stays(spark):
    """Null ids, an id on two texts, one row, all rows copies: every class keeps one row, texts without words all of them."""
    text = lambda a: " ".join(f"{a}{i}" for i in range(40))
    plain = [(i, text(f"p{i}w")) for i in range(100, 130)]
    tables = [
        ([*plain, (None, text("a")), (None, text("b")), (None, text("b") + " tail")], {(None, text("a"))}, 32),
        ([*plain, (1, text("c")), (1, text("d")), (2, text("d"))], {(1, text("c")), (1, text("d"))}, 32),
        ([*plain, (4, text("e")), (3, text("e") + " tail"), (5, text("e")), (None, text("e"))], {(3, text("e") + " tail")}, 31),
        ([(1, text("f"))], {(1, text("f"))}, 1),
        ([(None, "one")], {(None, "one")}, 1),
        ([(i, text("g")) for i in range(9, 3, -1)], {(4, text("g"))}, 1),
        ([(2, text("h")), (1, text("h")), (3, "!!"), (3, "!!"), (None, None), (4, "é")], {(1, text("h")), (3, "!!"), (None, None), (4, "é")}, 5),
    ]
    for rows, some, n in tables:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        have = [tuple(r) for r in neardup.keep_one(docs).collect()]
        assert some <= set(have) and len(have) == n, rows[-1]
        found = neardup.near_duplicates(docs).collect()
        assert len(found) == len(rows) and len({r.component for r in found if r.node}) + sum(r.node is None for r in found) == n
