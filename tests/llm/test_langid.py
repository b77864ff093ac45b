import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from tidelane.llm import langid
from tidelane.llm.queries import QUERIES


@pytest.mark.parametrize("sf, least", [(SF_DIR, 0.95), ("/root/testdata/sf0.01", 0.98)])
def test_held_out_accuracy(spark, sf, least):
    found = {r.doc_id: r for r in QUERIES["op13_language"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert set(found) == {d.doc_id for d in docs}
    langs = {d.lang for d in docs}
    tried = []
    for d in docs:
        own = found[d.doc_id]
        assert own.held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) and 0 <= own.score <= 1
        if not any(c.isalpha() for c in d.text or ""):
            assert own.lang_pred == "und" and own.score == 0 and not own.accepted
            continue
        assert own.lang_pred in langs
        if own.held_out and d.lang is not None:
            tried.append((own.lang_pred == d.lang, own.accepted))
    assert sum(right for right, _ in tried) >= least * len(tried)
    sure = [right for right, accepted in tried if accepted]
    assert sum(sure) >= 0.99 * len(sure) and len(sure) > 0.8 * len(tried)  # a wide margin is a safe one


def brute(text, known, level=6, fine=12, chunk=1024):
    """Sizes by separate encoders, made anew for every chunk."""
    own = "".join(c if c.isalpha() else " " for c in text or "").lower()
    own = " ".join(own.split()).encode()
    if not own:
        return "und"
    for step in (level, fine):
        sizes = []
        for content in known.contents:
            size = 0
            for at in range(0, len(own), chunk):
                size += len(langid.Encoders([content], step, chunk).encoders[0].compress(own[at : at + chunk]))
            sizes.append(size)
        if sizes.count(min(sizes)) == 1:
            break
    return known.languages[sizes.index(min(sizes))]


def test_whole_texts_decide(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    known = langid.learn(docs, F.lit(True))
    rows = docs.limit(60).collect()
    have = {r.doc_id: r.found.lang for r in langid.identify(spark.createDataFrame(rows, docs.schema), known, "found").collect()}
    assert have == {r.doc_id: brute(r.text, known) for r in rows}
    texts = {lang: " ".join(r.text for r in docs.where(F.col("lang") == lang).limit(40).collect()) for lang in ("en", "de")}
    mixed = spark.createDataFrame([(1, texts["en"][:3000] + texts["de"][:20000]), (2, texts["de"][:3000] + texts["en"][:20000])], "doc_id long, text string")
    assert [r.found.lang for r in langid.identify(mixed, known, "found").orderBy("doc_id").collect()] == ["de", "en"]


def test_odd_rows(spark, odd, nothing):
    learned = langid.learn(spark.read.parquet(f"{SF_DIR}/documents.parquet"), F.lit(True))
    wide = odd.withColumn("text_letters", F.lit("clash"))
    out = langid.identify(wide, learned, "found")
    assert sorted(out.columns) == sorted(wide.columns) and out.count() == wide.count()
    by = {r.doc_id: r.found for r in out.collect()}
    assert {i for i, f in by.items() if f.lang == "und"} == {1, 2, 3, 11} and all(by[i].score == 0 and not by[i].accepted for i in (1, 2, 3, 11))
    assert langid.identify(nothing, learned, "found").count() == 0
    # Nothing to learn from: no rows, no labels, no letters.
    for docs in (nothing, odd.withColumn("lang", F.lit(None).cast("string")), odd.where("doc_id IN (1, 2, 3, 11)")):
        none = langid.learn(docs, F.lit(True))
        assert none == langid.Dictionaries([], [])
        assert {r.found.lang for r in langid.identify(odd, none, "found").collect()} == {"und"}


def test_one_language_and_ties(spark):
    docs = spark.createDataFrame([(1, "only these few words", "xx"), (2, "only these few words", "xx"), (3, "only these few words", "yy"), (4, "only these few words", None)], "doc_id long, text string, lang string")
    known = langid.learn(docs, F.lit(True))
    assert known.languages == ["xx", "yy"] and known.contents[0] == known.contents[1]  # copies count once
    (found,) = {tuple(r.found) for r in langid.identify(docs, known, "found").collect()}
    assert found == ("xx", 0.5, 0.0, False)  # equal sizes: the language of more texts, not accepted
    alone = langid.learn(docs, F.col("lang") == "yy")
    assert {tuple(r.found) for r in langid.identify(docs, alone, "found").collect()} == {("yy", 1.0, 1.0, True)}


def test_learning_does_not_depend_on_order_and_has_bounds(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = langid.learn(docs, F.lit(True))
    assert langid.learn(docs.repartition(7).union(docs), F.lit(True)) == known
    assert all(0 < len(c) <= 32768 for c in known.contents)
    with pytest.raises(ValueError, match="languages"):
        langid.learn(docs, F.lit(True), most_languages=3)
