import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from tidelane.llm import classlm
from tidelane.llm.queries import QUERIES

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
END = object()


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), END]


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute(rows):
    counts = Counter(t for i, text in rows if i is None or not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    for i, text in rows:
        own = tokens(text)
        yield i, i is not None and held(i), len(own), sum(counts[t] > 0 for t in own), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)


def test_base_columns(spark, documents):
    found = {r.doc_id: r for r in QUERIES["op1_class_scores"](spark, SF_DIR).collect()}
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    for i, out, n, known, total, base in brute(rows):
        r = found.pop(i)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert abs(r.base_score - base) < 1e-6 * max(1, -base)
        assert abs(r.perplexity - 10 ** (-r.score / n)) < 1e-6 * r.perplexity
    assert not found


def test_classes_beat_word_frequencies(spark):
    rows = [r for r in QUERIES["op1_class_scores"](spark, "/root/testdata/sf0.01").where("held_out").collect()]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_odd_rows(spark, odd, nothing):
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    found = classlm.score(odd, F.coalesce(training, F.lit(True)), ["doc_id"], core=20, classes=4, block_bytes=1000).collect()
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    key = lambda r: (str(r[0]), r[2])
    for have, want in zip(sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=key), sorted(brute(rows), key=key), strict=True):
        assert have[:5] == want[:5] and abs(have[5] - want[5]) < 1e-6 * max(1, -want[5])
    assert all(math.isfinite(r.score) and r.score <= 0 for r in found)
    assert classlm.score(nothing, F.lit(True), ["doc_id"]).count() == 0
    assert classlm.score(odd, F.lit(False), ["doc_id"]).where("n_known > 0 OR base_score != 0").count() == 0


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([("a b a c b",), ("b a d",), ("a a e c",)], "text string")
    model = classlm.train(docs, core=2, classes=2)
    words = model.words.collect()
    assert Counter({r.n: 0 for r in words}) is not None and sum(r.n for r in words) == 15 and model.types == 6
    transitions = 10 ** model.logs(np.zeros((4, 4)))
    assert np.allclose(transitions.sum(1), 1)
    for kind in range(3):
        own = [r.n for r in words if r.kind == kind]
        assert not own or abs(sum(n / model.class_n[kind] for n in own) - 1) < 1e-12


def test_exchange_finds_the_classes():
    rng = np.random.default_rng(1)
    kinds = np.array([i % 3 for i in range(12)])
    pairs = np.zeros((14, 14))
    for _ in range(20000):
        a = rng.integers(12)
        b = rng.choice(np.flatnonzero(kinds == (kinds[a] + 1) % 3))
        pairs[a, b] += 1
    shuffled = rng.permutation(12)
    order = np.r_[shuffled, 12, 13]
    found = classlm.exchange(pairs[np.ix_(order, order)], 3)[:12]
    assert len({(a, b) for a, b in zip(found.tolist(), kinds[shuffled].tolist(), strict=True)}) == 3


def likelihood(pairs, kind, width):
    one = np.eye(width)[kind]
    table = one.T @ pairs @ one
    f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    return f(table) - f(table.sum(0)) - f(table.sum(1))


def test_no_move_raises_the_likelihood():
    pairs = np.random.default_rng(2).integers(0, 30, (12, 12)).astype(float)
    kind = classlm.exchange(pairs, 3)
    best = likelihood(pairs, kind, 5)
    for w in range(10):
        for c in range(3):
            other = kind.copy()
            other[w] = c
            assert likelihood(pairs, other, 5) <= best + 1e-6
