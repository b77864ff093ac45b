"""The pipeline against a brute-force version of its stages."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm import test_decontaminate, test_neardup, test_quality
from tidelane.llm.frames import find_package
from tidelane.llm.queries import PIECE_MODEL
from tidelane.llm import pieces

SF_DIR = "/root/testdata/sf0.001"


def brute_lines(rows):
    """Rows of doc_id, text, source without boilerplate lines; a text with copies in its source keeps them if it would lose all."""
    copies = Counter((text, source) for _, text, source in rows)
    pages, total = Counter(), Counter(source for _, _, source in rows)
    for _, text, source in rows:
        pages.update((source, line) for line in set((text or "").split("\n")) if line.strip(" "))
    bad = {k for k, n in pages.items() if n >= 5 and n > 0.1 * total[k[0]]}
    for doc_id, text, source in rows:
        stay = [line for line in (text or "").split("\n") if (source, line) not in bad]
        whole = text is None or (copies[text, source] > 1 and not any(x.strip(" ") for x in stay))
        yield doc_id, text if whole else "\n".join(stay), source


def brute_cut(text, items, window=13, longest=corpus_pipeline.LONGEST_SPAN):
    """A text without runs of more than ``longest`` words that are in windows of items."""
    found = list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(test_decontaminate.LOWER)))
    own, hit = [m.group() for m in found], set()
    for words in (test_decontaminate.words(t) for _, t in items):
        size = min(window, len(words))
        runs = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else ()
        for i in range(len(own) - size + 1) if runs else ():
            if tuple(own[i : i + size]) in runs:
                hit |= set(range(i, i + size))
    parts, last = [], 0
    for start in sorted(i for i in hit if i - 1 not in hit):
        end = start
        while end in hit:
            end += 1
        if end - start > longest:
            parts.append(text[last : found[start].start()])
            last = found[end - 1].end()
    return text if not parts else "".join([*parts, text[last:]])


@pytest.mark.parametrize("sf", [SF_DIR, "/root/testdata/sf0.01"])
def test_rows(spark, sf):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    # So few labels certify no cutoff: only the base rules reject.
    rows = list(brute_lines([d for d in docs if not test_quality.brute(d[1])[5]]))
    classes = dict(test_neardup.brute([(i, t) for i, t, _ in rows]))
    rows = [r for r in rows if classes[r[0]] == r[0]]
    dirty = {b[0] for b in test_decontaminate.brute([(i, t) for i, t, _ in rows], items) if b[5]}
    want = {i: brute_cut(t, items) for i, t, _ in rows if i not in dirty}
    out = corpus_pipeline.run(spark, sf)
    found = {r.doc_id: r for r in pieces.decode(out, PIECE_MODEL, "ids", "text").collect()}
    assert {i: r.text for i, r in found.items()} == want
    assert all(r.lossless and len(r.ids) == r.n_tokens for r in found.values()) and len(want) < len(docs)


def test_stages_take_odd_rows(spark, odd, nothing):
    find_package(spark)
    for start in (odd, nothing):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert [(c, t) for c, t in out.dtypes] == [(c, t) for c, t in docs.dtypes]
            docs = out if out.count() else docs
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == docs.count()


def test_long_benchmark_passages_of_clean_documents_go(spark):
    find_package(spark)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    passage = max((t for _, t in items), key=lambda t: len(test_decontaminate.words(t)))
    filler = " ".join(f"wörd{i}," for i in range(1500))
    assert len(test_decontaminate.words(passage)) > corpus_pipeline.LONGEST_SPAN
    short = " ".join(passage.split()[:14])
    rows = [(1, f"{filler} {passage} {filler}", 0), (2, f"{filler} {short}", 0), (3, filler, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in corpus_pipeline.decontamination(spark, docs, SF_DIR).collect()}
    assert {i: r.text for i, r in out.items()} == {i: brute_cut(t, items) for i, t, _ in rows}
    assert len(out[1].text) < len(rows[0][1]) and out[2].text == rows[1][1] and all(r.n_chars == len(r.text) for r in out.values())
