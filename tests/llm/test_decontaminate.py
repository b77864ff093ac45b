import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from tidelane.llm import decontaminate
from tidelane.llm.queries import QUERIES

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, window=13):
    windows = {}
    for name, text in items:
        own = words(text)
        for i in range(max(1, len(own) - window + 1)) if own else ():
            windows.setdefault(tuple(own[i : i + window]), set()).update(() if name is None else [str(name)])
    sizes = {len(w) for w in windows}
    for doc_id, text in docs:
        own, hit, names = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if (found := windows.get(tuple(own[i : i + size]))) is not None:
                    names |= found
                    hit |= set(range(i, i + size))
        sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        yield doc_id, len(own), len(hit), len(names), sha, len(hit) > 0 and 20 * len(hit) >= len(own)


def test_query(spark, documents):
    for sf in (SF_DIR, "/root/testdata/sf0.01"):
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
        items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
        want = sorted(brute(docs, items))
        assert sorted(map(tuple, QUERIES["op3_contamination"](spark, sf).collect())) == want
        assert any(w[5] for w in want)


def test_random_texts_in_one_and_many_automata(spark):
    random.seed(3)
    make = lambda n: " ".join(random.choice("abc") for _ in range(n))
    items = [(i, make(random.choice([1, 2, 3, 4, 5, 9]))) for i in range(14) if i] + [(20, None), (21, ""), (22, "!!"), (None, "b b a"), (None, "c c c a b a b c"), (23, "c a b"), (23, "b b c a")]
    docs = [(i, make(random.choice([0, 1, 3, 30, 60]))) for i in range(40)] + [(50, None)]
    docs += [(51, "A,b;C " * 20)]
    item_rows, doc_rows = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    for window in (3, 4, 6):
        # One automaton, several, and blocks that documents are dealt to.
        for size, most, group in ((1000, 1000, 1), (5, 1000, 1), (5, 0, 1 << 20), (1000, 0, 50)):
            found = decontaminate.find_items(doc_rows, item_rows, "found", window, size, most, group).select("doc_id", "found.*").collect()
            have = sorted((r.doc_id, r.n_words, sum(s["end"] - s["start"] for s in r.spans), len(r["items"])) for r in found)
            assert have == sorted(b[:4] for b in brute(docs, items, window))


def test_an_item_without_id_is_hit_and_not_named(spark):
    docs, items = spark.createDataFrame([("a b c d",)], "text string"), spark.createDataFrame([(None, "a b c")], "item_id long, text string")
    for most in (1000, 0):
        found = decontaminate.find_items(docs, items, "found", 3, broadcast_words=most).first().found
        assert [(s.start, s.end) for s in found.spans] == [(0, 3)] and found["items"] == []


def test_blocks_give_the_rows_of_broadcast_automata(spark, documents):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    wide = documents.withColumn("row_number", F.lit("clash")).union(documents.limit(3).withColumn("row_number", F.lit("again")))
    rows = [sorted(map(str, decontaminate.find_items(wide, items, "found", broadcast_words=n, words_per_automaton=300).collect())) for n in (200_000, 0)]
    assert rows[0] == rows[1] and len(rows[0]) == documents.count() + 3


def test_long_items_are_cut_without_losing_windows(spark):
    random.seed(5)
    text = " ".join(random.choice("abcdefgh") for _ in range(400))
    own = text.split()
    docs = [(i, " ".join(own[i : i + 6])) for i in range(395)]
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    for most in (1000, 0):
        found = decontaminate.find_items(spark.createDataFrame(docs, "doc_id long, text string"), items, "found", 6, 12, most)
        assert found.where("size(found.spans) = 1 AND found.spans[0].end = 6").count() == 395


def test_spans_are_bytes_of_the_text(spark):
    docs = spark.createDataFrame([("é, one Two THREE four! end",)], "text string")
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    (span,) = decontaminate.find_items(docs, items, "found", 3).first().found.spans
    assert "é, one Two THREE four! end".encode()[span.byte_start : span.byte_end] == b"one Two THREE" and (span.start, span.end) == (1, 4)


def test_cutting_and_dropping(spark):
    filler = " ".join(f"x{i}" for i in range(200))
    rows = [(1, f"{filler} a b c d {filler}"), (2, "a b c d y"), (3, filler), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert {tuple(r) for r in decontaminate.decontaminate(docs, items, 4).collect()} == {rows[0], rows[2], rows[3]}
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items, 4, longest=3).collect()}
    assert cut == {1: f"{filler}  {filler}", 3: filler, 4: None}


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "word3 word4 word5"), (2, "one")], "item_id long, text string")
    out = decontaminate.find_items(odd, items, "found")
    assert out.columns == odd.columns and out.count() == odd.count()
    have = sorted((str(r.doc_id), r.found.n_words, len(r.found["items"])) for r in out.select("doc_id", "found").collect())
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert have == sorted((str(b[0]), b[1], b[3]) for b in brute(rows, [(1, "word3 word4 word5"), (2, "one")]))
    assert decontaminate.decontaminate(nothing, items).columns == odd.columns
    assert decontaminate.decontaminate(odd, items.limit(0)).count() == odd.count()


def test_spans_are_cut_by_the_tasks_that_find_them(spark):
    """A second function would need a second Python worker for each core, which stays in memory for the stages that follow."""
    docs = spark.createDataFrame([(1, "p q a b c d e r s"), (2, "éあ a b c d x"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([("i", "a b c d e")], "item_id string, text string")
    out = decontaminate.decontaminate(docs, items, 4, share=1, longest=4)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    want = [(1, "p q  r s"), (2, "éあ a b c d x"), (3, None)]
    assert sorted(map(tuple, out.collect())) == want
    for most in (200_000, 0):
        found = decontaminate.find_items(docs, items, "found", 4, broadcast_words=most, longest=4).collect()
        assert sorted((r.doc_id, r.text) for r in found) == want
        assert sorted((s.start, s.end) for r in found for s in r.found.spans) == [(1, 5), (2, 7)]
