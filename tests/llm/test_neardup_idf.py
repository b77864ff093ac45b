"""Weights by the number of families that hold a shingle, for every shingle."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import SF_DIR
from tests.llm.test_neardup import shingles
from tidelane.llm import neardup


def joined(own, weights, similar=0.8):
    """The least index of each text's class, by all pairs; equal texts are one class."""
    up = list(range(len(own)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    holders, first = {}, {}
    for i, w in enumerate(weights):
        for j in sorted({j for k in w for j in holders.get(k, ())}):
            both = sum(min(x, weights[j].get(k, 0)) for k, x in w.items())
            if both / (sum(w.values()) + sum(weights[j].values()) - both) >= similar - 1e-9:
                low, high = sorted((top(i), top(j)))
                up[high] = low
        if w:
            low, high = sorted((top(i), top(first.setdefault(own[i], i))))
            up[high] = low
        for k in w:
            holders.setdefault(k, []).append(i)
    return [top(i) for i in range(len(own))]


def brute(rows):
    """Class of each row: families by plain weights, then links by ln((F + 1) / df) over the text of least digest of each family."""
    own = [shingles(t) for _, t in rows]
    digest = [hashlib.md5((t or "").encode()).hexdigest() for _, t in rows]
    family = joined([t for _, t in rows], own)
    least = {}
    for i, s in enumerate(own):
        if s:
            least[family[i]] = min(least.get(family[i], "g"), digest[i])
    counted = {digest[i]: s for i, s in enumerate(own) if s and digest[i] == least[family[i]]}
    df = Counter(k for s in counted.values() for k in s)
    weights = [{k: c * np.log((len(counted) + 1) / max(1, df[k])) for k, c in s.items()} for s in own]
    found = joined([t for _, t in rows], weights)
    names = {}
    for i, top in enumerate(found):
        names[top] = min(names.get(top, rows[i][0]), rows[i][0])
    return [(doc_id, names[found[i]]) for i, (doc_id, _) in enumerate(rows)]


def classes(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((r.doc_id, r.class_id) for r in neardup.near_duplicates(docs, **more).collect())


def words(name, n):
    return " ".join(f"{name}x{i}" for i in range(n))


def test_a_passage_of_a_twentieth_of_all_texts_does_not_join_those_that_mostly_consist_of_it(spark):
    passage = words("licence", 104)
    rows = [(i, words(f"plain{i}", 150)) for i in range(200)]
    rows += [(300 + i, words(f"long{i}", 400) + " " + passage) for i in range(10)]
    rows += [(400 + i, passage + " " + words(f"short{i}", 10)) for i in range(3)]
    assert all(a == b for a, b in classes(spark, rows)) and classes(spark, rows) == brute(rows)
    # Counted as plain words, the passage joins them.
    assert len({b for _, b in classes(spark, rows, common=0.1)}) == len(rows) - 2


def test_copies_do_not_lose_weight_on_what_they_share(spark):
    random.seed(11)
    rows, n = [(i, words(f"plain{i}", 150)) for i in range(60)], 100
    for family in range(3):
        for _ in range(25):
            copy = words(f"f{family}", 150).split()
            copy[random.randrange(150)] = f"e{random.random()}"
            rows.append((n, " ".join(copy)))
            n += 1
    want = sorted(brute(rows))
    assert len({b for _, b in want}) == 63
    for more in ({}, {"block_rows": 4}, {"block_bytes": 3000}):
        assert classes(spark, rows, **more) == want


def test_near_copies_in_a_large_group_of_copies_are_found(spark):
    """Most of the group is edited too much to be a near copy; that does not take weight from what the near copies share."""
    random.seed(13)
    base, rows = words("base", 200).split(), [(i, words(f"plain{i}", 150)) for i in range(200)]
    for i in range(90):
        copy = list(base)
        for at in random.sample(range(200), 12 if i < 60 else 1):
            copy[at] = f"e{random.random()}"
        rows.append((1000 + i, " ".join(copy)))
    own = [shingles(t) for _, t in rows]
    near = joined([t for _, t in rows], own)
    assert len({near[200 + i] for i in range(60)}) > 55 and len({near[260 + i] for i in range(30)}) == 1
    for more in ({}, {"block_rows": 16}):
        found = dict(classes(spark, rows, **more))
        assert all(found[i] == i for i in range(200)) and len({found[1060 + i] for i in range(30)}) == 1


def test_least_hashes_agree_as_often_as_counts_overlap():
    left, right = (" ".join(x) for x in ([f"w{i}" for i in [*range(300), *range(60), *range(60)]], [f"w{i}" for i in [*range(60, 400), *range(100)]]))
    texts = pa.array([left.encode(), right.encode()], pa.binary())
    _, found = neardup._counted_samples(texts, 5, 4000)
    assert abs((found[0] == found[1]).mean() - neardup.similarity(texts[:1], texts[1:], 5, neardup.PLAIN)[0]) < 0.03


@pytest.mark.parametrize("sf", [SF_DIR, "/root/testdata/sf0.01"])
def test_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert classes(spark, rows, block_bytes=100_000) == sorted(brute(rows))


def test_frequencies_are_exact(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PART_SHINGLES", 40)
    random.seed(12)
    texts = [" ".join(f"w{random.randrange(3)}" for _ in range(random.choice([1, 4, 30, 80]))) for _ in range(150)]
    rows = [(hashlib.md5(t.encode()).hexdigest(), t) for t in texts]
    dealt = neardup._Dealt(spark.createDataFrame([*rows, rows[0], (None, "!")], "node string, text string"), 20000, 1000)
    placed = {r.node: r.deal for r in dealt.read().collect()}
    assert dealt.read().count() == len(set(texts)) == len(placed) and len(set(placed.values())) > 3
    away = set(sorted(placed)[:40])
    left_out = spark.createDataFrame([(placed[x], x) for x in away], "deal int, node string")
    found = {}
    for r in neardup.frequencies(dealt, left_out, 5).collect():
        found.setdefault(r.deal, {}).update(zip(neardup._unpack_sorted(bytes(r.shingles)).tolist(), neardup._unpacked(bytes(r.n), np.uint32).tolist(), strict=True))
    own = {x: set(neardup._shingles(pa.array([t.encode()], pa.binary()), 5)[1].tolist()) for x, t in rows}
    df = Counter(k for x, s in own.items() if x not in away for k in s)
    held = {}
    for x, s in own.items():
        held.setdefault(placed[x], {}).update({k: df[k] for k in s if df[k] > 1})
    assert max(df.values()) > 5 and found == {deal: x for deal, x in held.items() if x}
    dealt.drop()
