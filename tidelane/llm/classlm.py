"""Language-model scores from a Brown class bigram model.

``p(word | previous) = p(class of word | class of previous) * p(word | its class)``. Each word has one class. Classes come
from exchange clustering in two steps. The ``core`` most frequent words are exchanged one by one until no move raises the
likelihood; their bigram counts have a fixed bound, so the driver does this. Every other word of the corpus is then
moved, in parallel and by the same gain, to the class that suits all its neighbours best.

Smoothing: class transitions are pulled to class frequencies; words never seen in training form one class whose mass is
that of words seen once, after every class alike, spread over as many unseen words as there are known ones, plus one.

Words are known by a 64-bit hash. For scoring, texts are dealt into blocks of about ``block_bytes``; each block gets
the model's rows for its own distinct words, so no task needs the whole vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelane.llm.frames import field, unused, written
from tidelane.llm.words import SPACED, slices, words_of

#: The hash that stands for the end of a text.
END = np.uint64(0x5851F42D4C957F2D)

#: Entries that a task gathers before it emits them.
GATHER = 1 << 20


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, with END after each text; the place after each text's END."""
    words = words_of(texts, SPACED)
    after = words.first[1:] + np.arange(1, len(texts) + 1)
    out = np.empty(len(words.start) + len(texts), np.uint64)
    own = np.ones(len(out), bool)
    own[after - 1] = False
    out[own] = words.hashes()
    out[~own] = END
    return out, after


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept, size = [], 0

    def merged():
        word = np.concatenate([k for k, _ in kept])
        order = np.argsort(word, kind="stable")
        word, n = word[order], np.concatenate([n for _, n in kept])[order]
        at = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        return word[at], np.add.reduceat(n, at)

    for batch in batches:
        for _, texts in slices(batch, "text"):
            kept.append(np.unique(_tokens(texts)[0], return_counts=True))
            size += len(kept[-1][0])
            if size > 2 * GATHER:
                kept = [merged()]
                size = len(kept[0][0])
                if size > GATHER:
                    yield pa.RecordBatch.from_arrays([_long(kept[0][0]), _long(kept[0][1])], ["word", "n"])
                    kept, size = [], 0
    if kept:
        word, n = merged()
        yield pa.RecordBatch.from_arrays([_long(word), _long(n)], ["word", "n"])


class _Core:
    """Places of the core words: their rank, then END, then all others."""

    def __init__(self, words: list[int]):
        found = np.array(words, np.int64).view(np.uint64)
        self.order = np.argsort(found)
        self.sorted = found[self.order]
        self.size = len(words)

    def places(self, tokens: np.ndarray) -> np.ndarray:
        out = np.full(len(tokens), self.size + 1)
        if self.size:
            at = np.minimum(np.searchsorted(self.sorted, tokens), self.size - 1)
            known = self.sorted[at] == tokens
            out[known] = self.order[at[known]]
        out[tokens == END] = self.size
        return out


def _count_pairs(core: _Core):
    width = core.size + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for batch in batches:
            for _, texts in slices(batch, "text"):
                now = core.places(_tokens(texts)[0])
                before = np.r_[core.size, now[:-1]]
                total += np.bincount(before * width + now, minlength=width * width)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([_long(at), _long(total[at])], ["pair", "n"])

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int, sweeps: int = 20) -> np.ndarray:
    """Classes of the words whose bigram counts are given; the last two words keep classes of their own.

    A word moves to the class that raises the likelihood of the class bigram model most, until a whole sweep moves none.
    """
    size, width = len(pairs) - 2, classes + 2
    kind = np.r_[np.arange(size) % classes, classes, classes + 1]
    one = np.zeros((size + 2, width))
    one[np.arange(size + 2), kind] = 1
    table = one.T @ pairs @ one
    left, right = table.sum(1), table.sum(0)
    eye = np.arange(width)
    for _ in range(sweeps):
        moved = 0
        for w in range(size):
            a, itself = kind[w], pairs[w, w]
            after = np.bincount(kind, pairs[w], width)
            before = np.bincount(kind, pairs[:, w], width)
            after[a] -= itself
            before[a] -= itself
            n_left, n_right = after.sum() + itself, before.sum() + itself
            table[a] -= after
            table[:, a] -= before
            table[a, a] -= itself
            left[a] -= n_left
            right[a] -= n_right
            gain = (_xlogx(table + after) - _xlogx(table)).sum(1) + (_xlogx(table + before[:, None]) - _xlogx(table)).sum(0)
            same = table[eye, eye]
            gain += _xlogx(same + after + before + itself) + _xlogx(same) - _xlogx(same + after) - _xlogx(same + before)
            gain -= _xlogx(left + n_left) - _xlogx(left) + _xlogx(right + n_right) - _xlogx(right)
            b = int(np.argmax(gain[:classes]))
            if gain[b] <= gain[a] + 1e-6:
                b = a
            kind[w] = b
            table[b] += after
            table[:, b] += before
            table[b, b] += itself
            left[b] += n_left
            right[b] += n_right
            moved += a != b
        if not moved:
            break
    return kind


def _gather_contexts(core: _Core, kind: np.ndarray, width: int):
    """For every word outside the core: how often each class stands before and after it."""

    def packed(word, context, n):
        order = np.lexsort((context, word))
        word, context, n = word[order], context[order], n[order]
        at = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (context[1:] != context[:-1])])
        return word[at], context[at], np.add.reduceat(n, at)

    def batch_of(word, context, n):
        at = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        bounds = pa.array(np.r_[at, len(word)].astype(np.int32))
        return pa.RecordBatch.from_arrays([_long(word[at]), pa.ListArray.from_arrays(bounds, _long(context + n.astype(np.int64) * 512))], ["word", "seen"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            for _, texts in slices(batch, "text"):
                tokens, _ = _tokens(texts)
                places = core.places(tokens)
                kinds = kind[places]
                others = np.flatnonzero(places == core.size + 1)
                if not len(others):
                    continue
                before = np.r_[kind[core.size], kinds[:-1]][others]
                after = np.r_[kinds[1:], 0][others] + width  # a word is never last: END follows it
                word = tokens[others]
                kept.append(packed(np.r_[word, word], np.r_[before, after].astype(np.int16), np.ones(2 * len(word), np.int32)))
                size += len(kept[-1][0])
                if size > 2 * GATHER:
                    kept = [packed(*map(np.concatenate, zip(*kept, strict=True)))]
                    size = len(kept[0][0])
                    if size > GATHER:
                        yield batch_of(*kept[0])
                        kept, size = [], 0
        if kept:
            yield batch_of(*packed(*map(np.concatenate, zip(*kept, strict=True))))

    return run


def _assign(weights: np.ndarray, width: int):
    """The best class of each word, from rows that arrive sorted by word."""

    def best(word, lists, n):
        sizes = np.diff(lists)
        group = np.cumsum(np.r_[True, word[1:] != word[:-1]]) - 1
        cell = np.repeat(group, sizes) * (2 * width) + n[0]
        seen = np.bincount(cell, n[1], (group[-1] + 1) * 2 * width).reshape(-1, 2 * width)
        return pa.RecordBatch.from_arrays(
            [_long(word[np.flatnonzero(np.r_[True, np.diff(group) > 0])]), _long(seen[:, :width].sum(1)), pa.array(np.argmax(seen @ weights, 1).astype(np.int16))],
            ["word", "n", "kind"],
        )

    def columns(table):
        table = table.combine_chunks()
        lists = table["seen"].combine_chunks()
        bounds, seen = lists.offsets.to_numpy(), lists.flatten().to_numpy()
        return table["word"].to_numpy(), bounds - bounds[0], (seen % 512, seen // 512)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            word = table["word"].to_numpy()
            cut = int(np.searchsorted(word, word[-1])) if len(word) else 0  # the last word may go on
            rest = table.slice(cut)
            yield from _in_parts(table.slice(0, cut), word[:cut], columns, best)
        if rest is not None and len(rest):
            yield best(*columns(rest))

    return run


def _in_parts(table, word, columns, best, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Whole words, some ``rows`` rows at a time."""
    at = 0
    while at < len(word):
        to = min(at + rows, len(word))
        if to < len(word):
            to = int(np.searchsorted(word, word[to - 1], side="right"))
        yield best(*columns(table.slice(at, to - at)))
        at = to


class Model:
    """A trained model: a table of words, their counts and classes; totals and class transitions."""

    def __init__(self, words: DataFrame, classes: int):
        self.words, self.classes = words, classes
        self.end, self.unseen = classes, classes + 1
        totals = words.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.sum((F.col("n") == 1).cast("long")).alias("once")).collect()
        self.class_n = np.zeros(classes + 2, np.int64)
        for row in totals:
            self.class_n[row.kind] = row.n
        self.tokens = int(self.class_n.sum())
        self.types = sum(r.v for r in totals)
        self.once = sum(r.once for r in totals)
        self.transitions: np.ndarray | None = None

    def logs(self, pairs: np.ndarray) -> np.ndarray:
        """log10 of the smoothed class transitions, from their counts.

        The unseen class has the same share after every class: that of words seen once.
        """
        width = self.classes + 2
        unseen = (self.once + 1) / (self.tokens + self.once + 2)
        base = (self.class_n + 1.0) / (self.tokens + width - 1)
        out = (1 - unseen) * (pairs + width * base) / (pairs.sum(1, keepdims=True) + width)
        out[:, self.unseen] = unseen
        return np.log10(out)


def train(texts: DataFrame, core: int = 1000, classes: int = 64) -> Model:
    """Count words and cluster them, from the column ``text`` of all rows; null counts as empty.

    The driver holds ``(core + 2) ** 2`` pair counts at most. Words of equal counts are ordered by their hash.
    """
    texts = texts.select("text")
    counts = written(texts.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    end = int(END.astype(np.int64))
    top = counts.where(F.col("word") != end).orderBy(F.desc("n"), "word").limit(core).collect()
    places = _Core([r.word for r in top])
    width = places.size + 2
    pairs = np.zeros(width * width)
    for row in texts.mapInArrow(_count_pairs(places), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        pairs[row.pair] = row.n
    pairs = pairs.reshape(width, width)
    kind = exchange(pairs, classes)
    one = np.zeros((width, classes + 2))
    one[np.arange(width), kind] = 1
    table = one.T @ pairs @ one + 0.5
    # Rounded to whole numbers so that sums do not depend on their order.
    follow = np.round((np.log(table) - np.log(table.sum(1, keepdims=True))) * 2**20)[:classes].T
    precede = np.round((np.log(table) - np.log(table.sum(0, keepdims=True))) * 2**20)[:, :classes]
    contexts = texts.mapInArrow(_gather_contexts(places, kind, classes + 2), "word long, seen array<long>")
    others = contexts.repartition("word").sortWithinPartitions("word").mapInArrow(_assign(np.r_[precede, follow], classes + 2), "word long, n long, kind smallint")
    fixed = [(r.word, r.n, int(kind[i])) for i, r in enumerate(top)] + [(r.word, r.n, classes) for r in counts.where(F.col("word") == end).collect()]
    words = others.union(texts.sparkSession.createDataFrame(fixed, "word long, n long, kind smallint"))
    return Model(written(words, "class-words"), classes)


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each block; rows arrive sorted by block."""
    now, kept = None, []

    def flushed():
        word = np.unique(np.concatenate(kept))
        return pa.RecordBatch.from_arrays([_long(np.full(len(word), now)), _long(word)], ["block", "word"])

    for batch in batches:
        for rows, texts in slices(batch, "text"):
            block = rows["block"].to_numpy()
            cuts = [*np.flatnonzero(np.r_[True, block[1:] != block[:-1]]), len(block)]
            for at, to in zip(cuts, cuts[1:], strict=False):
                if kept and block[at] != now:
                    yield flushed()
                    kept = []
                now = block[at]
                kept.append(np.unique(_tokens(texts.slice(at, to - at))[0]))
                if len(kept) > 32:
                    kept = [np.unique(np.concatenate(kept))]
    if kept:
        yield flushed()


def _read_classes(model: Model, keep: list[str]):
    end, unseen, tokens_n, types = model.end, model.unseen, model.tokens, model.types
    class_n = np.maximum(model.class_n, 1)
    denominator = np.log10(tokens_n + types + 1)

    def run(_, texts: pa.Table, vocabulary: pa.Table) -> pa.Table:
        word = vocabulary["word"].to_numpy().view(np.uint64)
        order = np.argsort(word)
        word, n, kind = word[order], vocabulary["n"].to_numpy()[order], vocabulary["kind"].to_numpy()[order]
        emission = np.log10(n / class_n[kind]) if len(n) else np.zeros(0)
        parts = []
        for rows, own in slices(texts, "text"):
            tokens, after = _tokens(own)
            at = np.minimum(np.searchsorted(word, tokens), max(len(word) - 1, 0))
            known = word[at] == tokens if len(word) else np.zeros(len(tokens), bool)
            kinds = np.full(len(tokens), unseen, np.uint8)
            kinds[tokens == END] = end
            count, emit = np.zeros(len(tokens), np.int64), np.full(len(tokens), -np.log10(types + 1))
            emit[tokens == END] = 0
            count[known], kinds[known], emit[known] = n[at[known]], kind[at[known]], emission[at[known]]
            first = np.r_[0, after[:-1]]
            base = np.add.reduceat(np.log10(count + 1) - denominator, first)
            lists = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(np.r_[0, after].astype(np.int32)), pa.py_buffer(kinds)])
            parts.append(pa.table([
                *(rows[c] for c in keep), _long(np.diff(np.r_[0, after])), _long(np.add.reduceat(known.astype(np.int64), first)),
                pa.array(base), pa.array(np.add.reduceat(emit, first)), lists,
            ], [*keep, "n_tokens", "n_known", "base_score", "emission", "kinds"]))
        return pa.concat_tables(parts) if parts else None

    return run


def _pairs_of(column: pa.Array, end: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.binary())
    base = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    now = np.frombuffer(column.buffers()[2], np.uint8)[base[0] : base[-1]].astype(np.int64)
    return np.r_[end, now[:-1]] * width + now, base[:-1] - base[0]


def _count_transitions(end: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for batch in batches:
            if len(batch):
                total += np.bincount(_pairs_of(batch["kinds"], end, width)[0], minlength=width * width)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([_long(at), _long(total[at])], ["pair", "n"])

    return run


def _add_transitions(logs: np.ndarray, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                pairs, first = _pairs_of(batch["kinds"], end, len(logs))
                total = np.add.reduceat(logs.ravel()[pairs], first) + batch["emission"].to_numpy()
                rest = [i for i, c in enumerate(batch.schema.names) if c not in ("kinds", "emission")]
                perplexity = 10 ** np.minimum(-total / batch["n_tokens"].to_numpy(), 300)
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), pa.array(total), pa.array(perplexity)], [*(batch.schema.names[i] for i in rest), "score", "perplexity"])

    return run


def score(docs: DataFrame, training: Column, keep: list[str], core: int = 1000, classes: int = 64, block_bytes: int = 16 << 20) -> DataFrame:
    """Train on the rows where ``training`` holds (null: it doesn't) and score the column ``text`` of all rows.

    A row for each row: the columns named in ``keep``, ``held_out``, ``n_tokens`` and ``n_known`` (the end of a text is a
    token), ``train_tokens``, ``base_score`` (log10 probability by add-one word frequencies), ``score`` (by the class
    model) and ``perplexity``. Null text is empty and still has its end. Without training rows every word is unseen.
    At most 250 classes. Other columns are ignored; repeated rows are scored each.
    """
    if not 1 <= classes <= 250:
        raise ValueError("classes must be 1 to 250")
    texts = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = unused(docs, "held_out")
    docs = docs.select(*keep, texts.alias("text"), (~F.coalesce(training, F.lit(False))).alias(held))
    model = train(docs.where(~F.col(held)), core, classes)
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = max(1, -(-size // block_bytes))
    place = F.pmod(F.xxhash64(*keep, "text"), F.lit(blocks))
    dealt = docs.withColumn("block", place).repartition("block").sortWithinPartitions("block")
    vocabulary = dealt.mapInArrow(_block_words, "block long, word long").join(model.words, "word")
    kept = [*keep, held]
    schema = ", ".join([*(field(dealt, c) for c in kept), "n_tokens long, n_known long, base_score double, emission double, kinds binary"])
    read = written(dealt.groupBy("block").cogroup(vocabulary.groupBy("block")).applyInArrow(_read_classes(model, kept), schema), "class-texts")
    width = classes + 2
    pairs = np.zeros(width * width)
    for row in read.where(~F.col(held)).select("kinds").mapInArrow(_count_transitions(model.end, width), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        pairs[row.pair] = row.n
    logs = model.logs(pairs.reshape(width, width))
    schema = ", ".join([*(field(read, c) for c in kept), "n_tokens long, n_known long, base_score double, score double, perplexity double"])
    return (
        read.mapInArrow(_add_transitions(logs, model.end), schema)
        .withColumn("train_tokens", F.lit(model.tokens).cast("long"))
        .withColumnRenamed(held, "held_out")
    )
