"""Benchmark decontamination with a generalised suffix automaton of the items' words.

The automaton holds every run of words of any item. A document's words are streamed through it; after each word it knows
the longest run ending there that some item contains. Where that length reaches the window, the run's words are hit and
the items of its last window are noted. Items of fewer words than the window count as one window each.

Items are cut into pieces of at most ``words_per_automaton`` words, which overlap so that no window is lost. Where all of them have
no more than ``broadcast_words`` words, their automata are broadcast and documents stream through them without a shuffle.
Beyond that, pieces are dealt to blocks, and a document meets only the blocks that share a mark with it: of the short
word runs in each window, the one of least hash is its mark, so equal windows have equal marks. Each block's automaton is built by the
task that streams its documents. Neither items nor automata then pass the driver.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelane.llm.frames import unused, written
from tidelane.llm.words import LETTERS, Words, giving_back, mix, slices, words_of

SPAN = "array<struct<start:int,end:int,byte_start:int,byte_end:int>>"


class Automaton:
    """All runs of words of some items; a word is its hash."""

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.vocabulary = np.unique(np.array([w for _, words in items for w in words], np.uint64))
        self.least = min([window, *(len(words) for _, words in items if words)])
        #: Items by the state of a window; items shorter than the window by state and length.
        self.windows: dict[int, set[str]] = defaultdict(set)
        self.short: dict[int, list[tuple[int, str | None]]] = defaultdict(list)
        for name, words in items:
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i + 1 >= window:
                    self.windows[self.window_state(state)] |= {name} - {None}
            if 0 < len(words) < window:
                while self.length[self.link[state]] >= len(words):
                    state = self.link[state]
                self.short[state].append((len(words), name))
        #: The nearest state, following links, at which a short item ends.
        self.nearest = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.nearest[state] = state if state in self.short else self.nearest[self.link[state]]

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._split(last, word, known)
        new = self._state({}, -1, self.length[last] + 1)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last < 0:
            self.link[new] = 0
        else:
            target = self.next[last][word]
            self.link[new] = target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        return new

    def _state(self, following: dict[int, int], link: int, length: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, last: int, word: int, target: int) -> int:
        """A copy of ``target`` for its runs of at most one word more than those of ``last``."""
        copy = self._state(dict(self.next[target]), self.link[target], self.length[last] + 1)
        self.link[target] = copy
        while last >= 0 and self.next[last].get(word) == target:
            self.next[last][word] = copy
            last = self.link[last]
        return copy

    def window_state(self, state: int) -> int:
        """The state of the last ``window`` words of a run that ends in ``state``."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def match(self, words: list[int], spans: list[tuple[int, int]], items: set[str], at: int) -> None:
        """Add the hit spans and items of some words, the first of which is number ``at``."""
        state = length = 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word not in self.next[state]:
                continue
            state = self.next[state][word]
            length += 1
            if length >= self.window:
                items |= self.windows[self.window_state(state)]
                spans.append((at + i + 1 - length, at + i + 1))
            short = self.nearest[state]
            while short > 0:
                for size, name in self.short[short]:
                    if size <= length:
                        items |= {name} - {None}
                        spans.append((at + i + 1 - size, at + i + 1))
                short = self.nearest[self.link[short]]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _matched(automaton: Automaton, words: Words, hashes: np.ndarray) -> tuple[dict[int, list[tuple[int, int]]], dict[int, set[str]]]:
    """Hit spans (word numbers within the slice) and items of each text of a slice."""
    spans, items = defaultdict(list), defaultdict(set)
    if not len(automaton.vocabulary):
        return spans, items
    near = np.minimum(np.searchsorted(automaton.vocabulary, hashes), len(automaton.vocabulary) - 1)
    known = automaton.vocabulary[near] == hashes
    # Runs of words that items use at all, within one text; shorter ones than any window cannot hit.
    first = np.zeros(len(known) + 1, bool)
    first[words.first] = True
    begins, ends = known.copy(), known.copy()
    begins[1:] &= ~known[:-1] | first[1:-1]
    ends[:-1] &= ~known[1:] | first[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = end - start >= automaton.least
    start, end = start[long], end[long]
    for doc, a, b in zip(np.searchsorted(words.first, start, "right") - 1, start.tolist(), end.tolist(), strict=True):
        automaton.match(hashes[a:b].tolist(), spans[doc], items[doc], a)
    return spans, items


def _told(words: Words, spans: dict[int, list[tuple[int, int]]], items: dict[int, set[str]]) -> list[dict]:
    """What was found in each text of a slice, spans relative to the text."""
    made = []
    for doc, (n, f, b) in enumerate(zip(np.diff(words.first).tolist(), words.first.tolist(), words.base.tolist(), strict=False)):
        joined = _joined([(s - f, e - f) for s, e in spans.get(doc, ())])
        told = [{"start": s, "end": e, "byte_start": int(words.start[f + s]) - b, "byte_end": int(words.end[f + e - 1]) - b} for s, e in joined]
        made.append({"n_words": n, "spans": told, "items": sorted(items.get(doc, ()))})
    return made


def _with_found(rows: pa.RecordBatch, text: str, found: str, told: list[dict], longest: int | None) -> pa.RecordBatch:
    """The rows with what was found in them; spans of more than ``longest`` hit words are cut out of their texts."""
    at = rows.schema.get_field_index(found)
    rows = rows.set_column(at, rows.schema.field(found), pa.array(told, rows.schema.field(found).type))
    if longest is None:
        return rows
    made = []
    for value, found_in in zip(rows[text].to_pylist(), told, strict=True):
        spans = [s for s in found_in["spans"] if s["end"] - s["start"] > longest]
        if spans:
            raw, last, parts = value.encode(), 0, []
            for s in spans:
                parts.append(raw[last : s["byte_start"]])
                last = s["byte_end"]
            value = b"".join([*parts, raw[last:]]).decode()
        made.append(value)
    at = rows.schema.get_field_index(text)
    return rows.set_column(at, rows.schema.field(text), pa.array(made, rows.schema.field(text).type))


def _stream(shared, text: str, found: str, longest: int | None):
    """Stream texts through a few automata that every task holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, text):
                words = words_of(texts, LETTERS)
                hashes = words.hashes()
                spans, items = defaultdict(list), defaultdict(set)
                for automaton in shared.value:
                    more = _matched(automaton, words, hashes)
                    for doc, own in more[0].items():
                        spans[doc] += own
                    for doc, own in more[1].items():
                        items[doc] |= own
                yield _with_found(rows, text, found, _told(words, spans, items), longest)

    return run


def _pieces(window: int, limit: int):
    """Items as hashes of their words, in pieces that overlap by a window less one word."""
    step = max(1, limit - window + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                words = words_of(texts, LETTERS)
                hashes, made = words.hashes().view(np.int64), []
                for name, a, b in zip(rows["item_id"].to_pylist(), words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                    for start in range(a, max(a + 1, b - window + 1), step) if b > a else ():
                        made.append((name, hashes[start : min(b, start + step + window - 1)]))
                yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in made], pa.string()), pa.array([w for _, w in made], pa.list_(pa.int64()))], ["item_id", "words"])

    return run


def marks(hashes: np.ndarray, window: int, short: list[int]) -> np.ndarray:
    """Marks of a text's windows, and of all its runs as long as one of the ``short`` items; equal windows have equal marks."""

    def runs(size: int) -> np.ndarray:
        out = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
        for i in range(size):
            out = mix(out * np.uint64(3) + hashes[i : len(hashes) - size + 1 + i] + np.uint64(size))
        return out

    found = [runs(size) for size in short]
    size = min(4, window)
    if len(hashes) >= window:
        found.append(sliding_window_view(runs(size), window - size + 1).min(1))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _document_marks(row: str, text: str, window: int, short: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, text):
                words = words_of(texts, LETTERS)
                hashes = words.hashes()
                own = [marks(hashes[a:b], window, short) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
                numbers = np.repeat(rows[row].to_numpy(), [len(x) for x in own])
                found = np.concatenate(own) if own else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(found.view(np.int64)), pa.array(np.repeat(pc.binary_length(texts).to_numpy(), [len(x) for x in own]).astype(np.int64))], ["row", "mark", "size"])

    return run


def _item_marks(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for block, words in zip(batch["block"].to_pylist(), batch["words"].to_pylist(), strict=True):
                hashes = np.array(words, np.int64).view(np.uint64)
                found = marks(hashes, window, [len(hashes)] if len(hashes) < window else [])
                made.append((np.full(len(found), block, np.int32), found.view(np.int64)))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[i] for x in made])) for i in (0, 1)], ["block", "mark"])

    return run


def _meet(window: int):
    """One block's documents through its automaton."""

    def run(docs: pa.Table, pieces: pa.Table) -> pa.Table:
        rows, spans_out, items_out = [], [], []
        if docs.num_rows and pieces.num_rows:
            hashed = [np.array(w, np.int64).view(np.uint64).tolist() for w in pieces["words"].to_pylist()]
            automaton = Automaton(list(zip(pieces["item_id"].to_pylist(), hashed, strict=True)), window)
            for part, texts in slices(docs, "text"):
                words = words_of(texts, LETTERS)
                spans, items = _matched(automaton, words, words.hashes())
                for doc, number in enumerate(part["row"].to_pylist()):
                    if spans.get(doc):
                        first = int(words.first[doc])
                        rows.append(number)
                        spans_out.append([{"start": a - first, "end": b - first} for a, b in _joined(spans[doc])])
                        items_out.append(sorted(items[doc]))
        kinds = (pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.string()))
        return pa.table([pa.array(x, k) for x, k in zip((rows, spans_out, items_out), kinds, strict=True)], ["row", "spans", "items"])

    return run


def _finish(text: str, found: str, spans_in: str, items_in: str, longest: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, text):
                words = words_of(texts, LETTERS)
                first = words.first.tolist()
                spans = {i: [(s["start"] + first[i], s["end"] + first[i]) for s in x] for i, x in enumerate(rows[spans_in].to_pylist()) if x}
                items = {i: set(x) for i, x in enumerate(rows[items_in].to_pylist()) if x}
                rows = rows.drop_columns([spans_in, items_in])
                yield _with_found(rows, text, found, _told(words, spans, items), longest)

    return run


def _by_blocks(out: DataFrame, into: str, pieces: DataFrame, total: int, window: int, limit: int, group_bytes: int, longest: int | None) -> DataFrame:
    """The same as streaming every document through every automaton, for items of any number of words."""
    kind = out.schema
    blocks = -(-total // limit) + 1
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)).cast("int"))
    lengths = dealt.select(F.size("words").alias("n")).where(F.col("n") < window).distinct().collect()  # fewer than a window's words
    row, spans, items = unused(out, "row_number"), unused(out, "found_spans"), unused(out, "found_items")
    kept = written(out.withColumn(row, F.monotonically_increasing_id()), "documents")
    numbered = kept.select(row, "text").mapInArrow(_document_marks(row, "text", window, sorted(r.n for r in lengths)), "row long, mark long, size long")
    known = dealt.mapInArrow(_item_marks(window), "block int, mark long").distinct()
    pairs = written(numbered.join(known, "mark").groupBy("row", "block").agg(F.first("size").alias("size")), "pairs")
    # A block that very many documents meet is dealt to several tasks, each with an automaton of its own.
    parts = pairs.groupBy("block").agg(F.ceil(F.sum("size") / group_bytes).cast("int").alias("parts")).withColumn("parts", F.greatest("parts", F.lit(1)))
    texts = kept.select(F.col(row).alias("row"), "text").join(pairs.join(parts, "block"), "row")
    texts = texts.select("row", F.col("text").cast("binary").alias("text"), "block", F.pmod(F.xxhash64("row"), "parts").cast("int").alias("part"))
    needed = dealt.join(parts, "block").select("item_id", "words", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    met = texts.groupBy("block", "part").cogroup(needed.groupBy("block", "part")).applyInArrow(
        _meet(window), "row long, spans array<struct<start:int,end:int>>, items array<string>"
    )
    merged = met.groupBy(F.col("row").alias("of_row")).agg(F.flatten(F.collect_list("spans")).alias(spans), F.array_distinct(F.flatten(F.collect_list("items"))).alias(items))
    joined = kept.join(merged, F.col(row) == F.col("of_row"), "left").drop(row, "of_row")
    return joined.mapInArrow(_finish("text", into, spans, items, longest), kind)


def find_items(
    docs: DataFrame,
    items: DataFrame,
    into: str,
    window: int = 13,
    words_per_automaton: int = 50_000,
    broadcast_words: int = 200_000,
    group_bytes: int = 1 << 24,
    longest: int | None = None,
) -> DataFrame:
    """``docs`` with a struct column ``into``: ``n_words``, ``spans`` of hit words and ``items`` whose windows occur.

    Needs ``docs.text``, ``items.item_id`` and ``items.text``. Spans are merged, in words and in bytes of the UTF-8 text,
    ends exclusive. Null texts have no words; items without words are left out; words in a window of an item with a null id are hit, but
    no item is named. Items that share an id count as one. Other columns pass through; an earlier column ``into`` is replaced. Rows repeat
    as given. With ``longest``, spans of more hit words than that are cut out of the texts by the same tasks; the spans told are those before.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    limit = max(words_per_automaton, 2 * window)
    out = docs.withColumn(into, F.lit(None).cast(f"struct<n_words:long,spans:{SPAN},items:array<string>>"))
    named = items.where("text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    pieces = written(named.mapInArrow(_pieces(window, limit), "item_id string, words array<long>"), "items")
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    if total > broadcast_words:
        return _by_blocks(out, into, pieces, total, window, limit, group_bytes, longest)
    blocks, size = [[]], 0
    for row in pieces.orderBy("item_id", "words").toLocalIterator():  # no more than ``broadcast_words`` words
        if size + len(row.words) > limit:
            blocks.append([])
            size = 0
        blocks[-1].append((row.item_id, np.array(row.words, np.int64).view(np.uint64).tolist()))
        size += len(row.words)
    shared = docs.sparkSession.sparkContext.broadcast([Automaton(block, window) for block in blocks])
    return out.mapInArrow(giving_back(_stream(shared, "text", into, longest)), out.schema)


def n_hit(found: str):
    """The number of hit words, from the column that ``find_items`` adds."""
    return F.aggregate(f"{found}.spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))


def contaminated(found: str, share: int = 20):
    """Whether at least one word in ``share`` is hit."""
    return (n_hit(found) > 0) & (n_hit(found) * share >= F.col(f"{found}.n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 13, share: int = 20, longest: int | None = None) -> DataFrame:
    """``docs`` without contaminated documents; the rest keeps its columns and rows.

    A document goes when at least one of ``share`` words is hit. With ``longest``, spans of more hit words than that are
    cut out of the documents that stay; by default their texts are left as they are. Nulls as in ``find_items``.
    """
    found = unused(docs, "found")
    return find_items(docs, items, found, window, longest=longest).where(~contaminated(found, share)).drop(found)
