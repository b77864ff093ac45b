"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A shingle is five words (a shorter text is one shingle), weighted by its count in the text times its inverse document
frequency ln((F + 1) / df), for every shingle. Copies of a text would lose weight on what they share, so one text of each of the
F families is counted: a family is connected by links of plain counts, found in a first round like that of the result, whose samples are least
hashes of the shingles, each as often as it is counted. Half the similarity is enough for these links: in a group of copies many are edited too
much to be near copies, and if each of them were counted, what the group shares would weigh less the larger the group is. Texts
are dealt in blocks; a block's distinct shingles go to the tasks that count them, and those that two families or more hold come
back to the block with their number. A shingle that does not come back is in one family at most. ``common`` asks for a
shorter way instead: 1 for shingles in up to that share of all texts, above it falling as the logarithm of N / df.

Equal texts are one node. Each gets ``bands * samples_each`` consistent weighted samples, each of which two texts share with a
probability equal to their weighted Jaccard similarity. Texts that share all samples of a band meet in a bucket, with
their whole texts; a bucket of the same texts as one of an earlier band has no pair that is new, and is left out. There all
pairs are compared whose samples agree in 55 percent or more (at a similarity of 0.8 one
pair in 5,000 does not) and that no found link joins yet, each in the first band that it shares; only links that join
something new leave the task, so their number is below that of the rows. Buckets of more than ``block_rows`` texts are compared
in blocks dealt differently in each band; if such a bucket still holds several components, its pairs of blocks follow.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelane.llm.components import components
from tidelane.llm.frames import unused, written
from tidelane.llm.words import LETTERS, give_back, giving_back, mix, slices, words_of
from tidelane.session import new_folder

_FOLD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
#: -ln of a uniform number in 65,536 steps; a sum of two is Gamma(2, 1).
_EXPONENTIAL = -np.log((np.arange(65536) + 0.5) / 65536).astype(np.float32)
#: Counters of the first look for common shingles.
COUNTERS = 1 << 16
#: Tasks that the copies of one text are dealt to where they meet their class.
SALTS = 16
#: Bands of the first round, which only tells families, and samples of each: at a similarity of 0.4 two texts share a band with probability 0.877.
FAMILY_BANDS = 12
FAMILY_SAMPLES = 2
#: Share of the similarity from which on texts are of one family.
KIN = 0.5
#: Distinct shingles of blocks that one task counts, about; there is one for every six bytes of text.
PART_SHINGLES = 1 << 20
#: Text for each file of a scratch table, about, so that many shuffle partitions do not make many small files.
FILE_BYTES = 16 << 20
#: A word character; texts without any are no nodes.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
#: Weights that leave every shingle its count.
PLAIN = (np.zeros(0, np.uint64), np.zeros(0))


def _shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The text's number and the hash of each shingle, in order of the texts."""
    words = words_of(texts, LETTERS)
    h, n = words.hashes(), np.diff(words.first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), count)
    first = words.first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    last = words.first[1:][text]
    total = np.zeros(len(first), np.uint64)
    for k in range(size):
        at = first + k
        inside = at < last
        total += np.where(inside, h[np.minimum(at, len(h) - 1)], np.uint64(0)) * _FOLD[k % len(_FOLD)] * np.uint64(2 * (k // len(_FOLD)) + 1) if len(h) else 0
    return text, mix(total)


def _weighted(text: np.ndarray, shingle: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their weights; those of weight 0 are left out."""
    order = np.argsort(shingle)
    number = text[order]
    order = order[np.argsort(number.astype(np.uint16) if len(text) and number.max() < 1 << 16 else number, kind="stable")]
    text, shingle = text[order], shingle[order]
    at = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])]) if len(text) else np.zeros(0, np.int64)
    weight = np.diff(np.r_[at, len(text)]).astype(np.float64)
    text, shingle = text[at], shingle[at]
    known, factor = common
    if len(known):
        near = np.minimum(np.searchsorted(known, shingle), len(known) - 1)
        hit = known[near] == shingle
        weight[hit] *= factor[near[hit]]
        keep = weight > 0
        text, shingle, weight = text[keep], shingle[keep], weight[keep]
    return text, shingle, weight


def _count_all(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, texts in slices(batch, "text"):
                total += np.bincount((_shingles(texts, size)[1] >> np.uint64(48)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["counter", "n"])

    return run


def _count_some(size: int, counters: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch, "text"):
                text, shingle = _shingles(texts, size)
                keep = counters[(shingle >> np.uint64(48)).astype(np.int64)]
                shingle = _weighted(text[keep], shingle[keep], (np.zeros(0), np.zeros(0)))[1]
                found, n = np.unique(shingle, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["shingle", "n"])

    return run


def common_shingles(texts: DataFrame, size: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in more than ``share`` of all texts, sorted, and their weights. Exact.

    Occurrences are counted in fixed counters first; only shingles of counters that exceed the limit are then counted
    one by one.
    """
    total = texts.count()
    limit = share * total
    rows = texts.mapInArrow(_count_all(size), "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).where(F.col("n") > limit).collect()
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0)
    counters = np.zeros(COUNTERS, bool)
    counters[[r.counter for r in rows]] = True
    counted = texts.mapInArrow(_count_some(size, counters), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") > limit).collect()
    known = np.array([r.shingle for r in rows], np.int64).view(np.uint64)
    order = np.argsort(known)
    weight = np.log(total / np.array([r.n for r in rows], float)) / -np.log(share) if rows else np.zeros(0)
    return known[order], np.maximum(weight, 0)[order]


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, the low bytes of all first, so that those which are mostly 0 compress."""
    return numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _pack_sorted(shingles: np.ndarray) -> bytes:
    return _packed(np.diff(shingles, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64), dtype=np.uint64)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each node in the partition."""
    seen = set()
    for batch in batches:
        keep = [i for i, node in enumerate(batch["node"].to_pylist()) if not (node in seen or seen.add(node))]
        for at in range(0, len(keep), 512):  # the JVM holds a whole batch outside its heap
            yield batch.take(pa.array(keep[at : at + 512], pa.int64()))


class _Dealt:
    """One row of each text that is a node, in blocks of about ``block_bytes``, in buckets of whole blocks until the table is dropped."""

    def __init__(self, texts: DataFrame, total: int, block_bytes: int):
        self.spark, self.name, self.bytes = texts.sparkSession, f"tidelane_{uuid.uuid4().hex}", total
        texts = texts.where(F.col("node").isNotNull()).select("node", "text")
        blocks = max(1, -(-total // block_bytes))
        self.files = max(self.spark.sparkContext.defaultParallelism, -(-total // FILE_BYTES))
        once = texts.mapInArrow(giving_back(_once), "node string, text string").withColumn("deal", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int"))
        # Some blocks share a file and a task, but no core is left without.
        buckets = max(-(-blocks // 8), min(blocks, self.spark.sparkContext.defaultParallelism))
        once = once.repartition(buckets, "deal").mapInArrow(giving_back(_once), "node string, text string, deal int")
        once.write.bucketBy(buckets, "deal").option("path", new_folder(self.spark, "texts")).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def meet(self, other: DataFrame, function, schema: str) -> DataFrame:
        """What ``function`` makes of each block's texts and the rows of ``other`` that are dealt to it."""

        def run(texts: pa.Table, rows: pa.Table) -> pa.Table:
            out = function(texts, rows)
            give_back()
            return out

        return self.read().groupBy("deal").cogroup(other.groupBy("deal")).applyInArrow(run, schema)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _block_shingles(size: int, parts: int):
    """A block's distinct shingles, sorted, and how many of its texts hold each, less those that are not counted."""

    def run(texts: pa.Table, left_out: pa.Table) -> pa.Table:
        deal = (texts if len(texts) else left_out)["deal"][0].as_py()
        counted = pc.invert(pc.is_in(texts["node"], value_set=left_out["node"].combine_chunks()))
        found, n = [], []
        for part, own in slices(texts.append_column("counted", counted), "text"):
            text, shingle = _shingles(own, size)
            order = np.argsort(shingle, kind="stable")
            text, shingle = text[order], shingle[order]
            fresh = np.r_[True, shingle[1:] != shingle[:-1]] if len(shingle) else np.zeros(0, bool)
            new = fresh.copy()
            new[1:] |= text[1:] != text[:-1]
            at = np.flatnonzero(fresh)
            found.append(shingle[at])
            n.append(np.add.reduceat((part["counted"].to_numpy()[text] & new).astype(np.uint32), at) if len(at) else np.zeros(0, np.uint32))
        shingle, n = _summed(np.concatenate(found), np.concatenate(n)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.uint32))
        # Parts are equal ranges of the hash's upper half.
        bounds = np.searchsorted(shingle, np.array([-(-(p << 32) // parts) << 32 for p in range(parts)], np.uint64))
        runs = [(p, a, b) for p, (a, b) in enumerate(zip(bounds, [*bounds[1:], len(shingle)], strict=True)) if a < b]
        return pa.table({
            "part": pa.array([p for p, _, _ in runs], pa.int32()), "deal": pa.array([deal] * len(runs), pa.int32()),
            "shingles": pa.array([_pack_sorted(shingle[a:b]) for _, a, b in runs], pa.binary()), "n": pa.array([_packed(n[a:b]) for _, a, b in runs], pa.binary()),
        })

    return run


def _summed(shingle: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted, with their sums of ``n``."""
    order = np.argsort(shingle, kind="stable")
    shingle = shingle[order]
    at = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]]) if len(shingle) else np.zeros(0, np.int64)
    return shingle[at], np.add.reduceat(n[order], at).astype(np.uint32) if len(at) else n


def _count_part(rows: pa.Table) -> pa.Table:
    """For each block the shingles of this part that two counted texts or more hold, with their number."""
    own = [_unpack_sorted(x.as_buffer()) for x in rows["shingles"]]
    known, n = _summed(np.concatenate(own), np.concatenate([_unpacked(x.as_buffer(), np.uint32) for x in rows["n"]]))
    known, n = known[n > 1], n[n > 1]
    shingles, counts = [], []
    for x in own:
        at = np.searchsorted(known, x)
        hit = known[np.minimum(at, len(known) - 1)] == x if len(known) else np.zeros(len(x), bool)
        shingles.append(_pack_sorted(x[hit]))
        counts.append(_packed(n[at[hit]]))
    return pa.table({"deal": rows["deal"], "shingles": pa.array(shingles, pa.binary()), "n": pa.array(counts, pa.binary())})


def frequencies(dealt: _Dealt, left_out: DataFrame, size: int) -> DataFrame:
    """``deal, shingles, n``: of each block's shingles all that are in two texts or more, ``left_out`` (``deal, node``) not counted."""
    parts = max(1, -(-dealt.bytes // (6 * PART_SHINGLES)))
    runs = dealt.meet(left_out, _block_shingles(size, parts), "part int, deal int, shingles binary, n binary")
    return runs.repartition(parts, "part").groupBy("part").applyInArrow(_count_part, "deal int, shingles binary, n binary").where(F.length("shingles") > 0)


def _idf(n: np.ndarray, families: int) -> np.ndarray:
    """Inverse document frequencies, as shares of that of a shingle in one family; never 0."""
    return np.log((families + 1) / n) / np.log(families + 1)


def samples(texts: pa.Array, size: int, common, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """Which texts have shingles, and their consistent weighted samples, a row for each such text."""
    return _sampled(*_weighted(*_shingles(texts, size), common), hashes)


def _sampled(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]]) if len(text) else np.zeros(0, np.int64)
    out = np.empty((len(first), hashes), np.int32)
    if len(first):
        log_weight = np.log(weight).astype(np.float32)
        other = np.flatnonzero(log_weight)
        log_weight = log_weight[other]
        for j in range(hashes):
            x = (shingle ^ mix(np.array([j + 1], np.uint64))) * _FOLD[1]
            x ^= x >> np.uint64(32)
            x *= _FOLD[3]
            x ^= x >> np.uint64(32)
            part = x.view(np.uint16).reshape(-1, 4)
            r = _EXPONENTIAL[part[:, 0]] + _EXPONENTIAL[part[:, 1]]
            c = np.log(_EXPONENTIAL[part[:, 2]] + _EXPONENTIAL[part[:, 3]])
            beta = ((x * _FOLD[4]) >> np.uint64(40)).astype(np.float32) * np.float32(2**-24)
            # t is 0 for a weight of 1. The least of ln c - r (t - beta) - r tells the shingle and its t.
            step = 1 - beta
            step[other] += np.floor(log_weight / r[other] + beta[other])
            out[:, j] = np.minimum.reduceat(c - r * step, first).astype(np.float32).view(np.int32)
    return text[first], out


def _counted_samples(texts: pa.Array, size: int, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """Like ``samples`` with plain counts: the least hashes of each text's shingles, the k-th of one being an element of its own."""
    text, shingle, weight = _weighted(*_shingles(texts, size), PLAIN)
    n = weight.astype(np.int64)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    text, element = np.repeat(text, n), mix(np.repeat(shingle, n) + nth.astype(np.uint64) * _FOLD[0])
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]]) if len(text) else np.zeros(0, np.int64)
    out = np.empty((len(first), hashes), np.int32)
    for j in range(hashes) if len(first) else ():
        x = (element ^ mix(np.array([j + 1], np.uint64))) * _FOLD[1]
        x ^= x >> np.uint64(29)
        x *= _FOLD[3]
        out[:, j] = np.minimum.reduceat((x >> np.uint64(32)).astype(np.uint32), first).view(np.int32)
    return text[first], out


#: One row for each text: its block, node, bucket of each band, samples, and how many families hold each of its shingles, sorted.
SIGNED = "deal int, node string, bands array<long>, samples array<int>, held array<int>"


def _signature(rows, found: np.ndarray, bands: int, each: int, held: pa.Array) -> list[pa.Array]:
    """Columns of ``SIGNED`` but the counts, which are given; all texts have samples, or those that have none come last."""
    keys = np.zeros((len(found), bands), np.uint64)
    for k in range(each):
        keys = mix(keys * _FOLD[0] + found[:, k::each].view(np.uint32).astype(np.uint64) + np.uint64(k + 1))
    have = np.minimum(np.arange(len(rows) + 1, dtype=np.int32), np.int32(len(found)))
    lists = [pa.ListArray.from_arrays(pa.array(have * np.int32(w)), pa.array(x.ravel())) for x, w in ((keys.view(np.int64), bands), (found, bands * each))]
    return [rows["deal"], rows["node"], *lists, held]


_SIGNED_NAMES = [x.split()[0] for x in SIGNED.split(", ")]


def _sign(size: int, shared, bands: int, each: int):
    """Signatures with the same weights for all blocks; plain counts if ``shared`` is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                which, found = samples(texts, size, shared.value, bands * each) if shared else _counted_samples(texts, size, bands * each)
                # Texts with words that all weigh 0 are nodes too, with empty lists: no bucket, so only equal ones are a class.
                rows = part.take(pa.array(np.r_[which, np.setdiff1d(np.arange(len(texts)), which)]))
                held = pa.ListArray.from_arrays(pa.array(np.zeros(len(rows) + 1, np.int32)), pa.array([], pa.int32()))
                yield pa.RecordBatch.from_arrays(_signature(rows, found, bands, each, held), _SIGNED_NAMES)

    return run


def _sign_block(size: int, families: int, bands: int, each: int):
    """Signatures of a block's texts by the counts of its shingles."""

    def run(texts: pa.Table, counts: pa.Table) -> pa.Table:
        known = np.concatenate([np.zeros(0, np.uint64), *(_unpack_sorted(x.as_buffer()) for x in counts["shingles"])])
        n = np.concatenate([np.zeros(0, np.uint32), *(_unpacked(x.as_buffer(), np.uint32) for x in counts["n"])])
        order = np.argsort(known)
        known, n = known[order], n[order]
        out = []
        for part, own in slices(texts, "text"):
            text, shingle, weight = _weighted(*_shingles(own, size), PLAIN)
            held = np.ones(len(shingle), np.int32)
            if len(known):
                near = np.minimum(np.searchsorted(known, shingle), len(known) - 1)
                hit = known[near] == shingle
                held[hit] = n[near[hit]]
            _, found = _sampled(text, shingle, weight * _idf(held, families), bands * each)
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(own) + 1)).astype(np.int32)), pa.array(held))
            rows = part.combine_chunks()
            out.append(pa.Table.from_arrays(_signature(rows, found, bands, each, lists), _SIGNED_NAMES))
        kinds = [pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
        schema = pa.schema(list(zip(_SIGNED_NAMES, kinds, strict=True)))
        return pa.concat_tables([x.cast(schema) for x in out]) if out else schema.empty_table()

    return run


def _with_texts(texts: pa.Table, signed: pa.Table) -> pa.Table:
    """Signatures with their texts."""
    at = pc.index_in(signed["node"], value_set=texts["node"].combine_chunks())
    return signed.drop_columns(["deal"]).append_column("text", texts["text"].take(at))


def similarity(left: pa.Array, right: pa.Array, size: int, common) -> np.ndarray:
    """Weighted Jaccard similarity of texts, one by one with those of the other array."""
    pair, shingle, weight = (np.concatenate(x) for x in zip(*(_weighted(*_shingles(t, size), common) for t in (left, right)), strict=True))
    order = np.lexsort((shingle, pair))
    pair, shingle, weight = pair[order], shingle[order], weight[order]
    both = np.flatnonzero((pair[1:] == pair[:-1]) & (shingle[1:] == shingle[:-1])) if len(pair) else np.zeros(0, np.int64)
    shared = np.bincount(pair[both], np.minimum(weight[both], weight[both + 1]), len(left))
    total = np.bincount(pair, weight, len(left)) - shared
    return np.divide(shared, total, out=np.zeros(len(left)), where=total > 0)


def _top(up: dict[str, str], name: str) -> str:
    """The component that ``name`` is of, as far as the links in ``up`` tell."""
    while name in up:
        if up[name] in up:
            up[name] = up[up[name]]
        name = up[name]
    return name


def _links(band: int, rows: list[tuple], similar: float, likely: int, up: dict[str, str]) -> Iterator[tuple[str, str]]:
    """Links that join what is not yet joined among some texts of a bucket, neither here nor, by ``up``, earlier in this task.

    Looks at pairs of different components whose first common band is this one, whose blocks are the two of this task,
    and whose samples agree ``likely`` times at least. Each text that has such pairs is compared with all others at once.
    """
    nodes, names, blocks, bands, found, shingles, weights = zip(*rows, strict=True)
    names = [_top(up, x) for x in names]
    root = np.unique(names, return_inverse=True)[1]
    if root.max() == 0:
        return
    bands, found, blocks = np.array(bands), np.array(found), np.array(blocks)
    across = blocks.min() != blocks.max()
    place = data = first = total = dense = None
    for i in range(len(rows) - 1):
        near = np.flatnonzero((root[i + 1 :] != root[i]) & (not across or blocks[i + 1 :] != blocks[i])) + i + 1
        near = near[np.argmax(bands[near] == bands[i], axis=1) == band] if len(near) else near
        near = near[(found[near] == found[i]).sum(1) >= likely] if len(near) else near
        if not len(near):
            continue
        if place is None:
            sizes = np.array([len(x) for x in shingles])
            first, data = np.cumsum(sizes) - sizes, np.concatenate(weights)
            place = np.unique(np.concatenate(shingles), return_inverse=True)[1]
            total = np.add.reduceat(data, first)
            dense = np.zeros(place.max() + 1)
        own = slice(first[i], first[i] + sizes[i])
        dense[place[own]] = data[own]
        if len(near) * 8 < len(rows):
            shared = np.array([np.minimum(data[first[j] : first[j] + sizes[j]], dense[place[first[j] : first[j] + sizes[j]]]).sum() for j in near])
        else:
            shared = np.add.reduceat(np.minimum(data, dense[place]), first)[near]
        dense[place[own]] = 0
        for j in near[shared >= (similar - 1e-9) * (total[i] + total[near] - shared)]:
            if root[j] != root[i]:
                yield nodes[i], nodes[j]
                root[root == root[j]] = root[i]
                up[_top(up, names[j])] = _top(up, names[i])


def _compare(size: int, shared, families: int | None, similar: float, likely: int):
    """Links within each bucket's blocks; the rows of a band, key and two blocks arrive together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, up = None, [], {}

        def flushed():
            links = list(_links(now[0], rows, similar, likely, up)) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.string()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for part, texts in slices(batch, "text"):
                text, shingle, weight = _weighted(*_shingles(texts, size), shared.value if shared else PLAIN)
                if families:
                    weight *= _idf(part["held"].flatten().to_numpy(), families)
                at = np.searchsorted(text, np.arange(len(texts) + 1))
                lists = [part[c].flatten().to_numpy().reshape(len(part), -1) for c in ("bands", "samples")]
                places = zip(*(part[c].to_pylist() for c in ("band", "key", "low", "high")), strict=True)
                for k, (where, node, name, block) in enumerate(zip(places, *(part[c].to_pylist() for c in ("node", "component", "block")), strict=True)):
                    if rows and where != now:
                        yield flushed()
                        rows = []
                    now = where
                    rows.append((node, name, block, lists[0][k], lists[1][k], shingle[at[k] : at[k + 1]], weight[at[k] : at[k + 1]]))
        if rows:
            yield flushed()

    return run


def _classes(dealt: _Dealt, signed: DataFrame, size: int, shared, families: int | None, similar: float, likely: int, block_rows: int) -> DataFrame:
    """``node, component`` of the nodes that are not their component's least, by links of at least ``similar``."""
    placed = signed.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = placed.groupBy("band", "key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("members")).where("n > 1")
    # A bucket of the same texts as one of an earlier band has no pair for which this is the first common band.
    first = buckets.where(F.col("n") <= block_rows).groupBy("n", "members").agg(F.min(F.struct("band", "key")).alias("first"))
    buckets = buckets.where(F.col("n") > block_rows).select("band", "key", "n").union(first.select("first.band", "first.key", "n"))
    blocks = F.ceil(F.col("n") / block_rows)
    placed = placed.join(buckets, ["band", "key"]).withColumn("block", F.pmod(F.xxhash64("node", "band"), blocks))
    placed = written(placed, "buckets", dealt.files)
    involved = signed.join(placed.select("node").distinct(), "node", "left_semi")
    whole = dealt.meet(involved, _with_texts, "node string, bands array<long>, samples array<int>, held array<int>, text string")

    def linked(rows: DataFrame) -> DataFrame:
        place = ["band", "key", "low", "high"]
        # One task for each file, so that the bands' links to the same texts meet in few tasks, which pass on those that join something new.
        rows = rows.join(whole, "node").repartition(*place).sortWithinPartitions(*place, "node").coalesce(dealt.files)
        links = rows.mapInArrow(giving_back(_compare(size, shared, families, similar, likely)), "a string, b string")
        return written(links, "links", dealt.files)

    links = linked(placed.withColumns({"component": F.col("node"), "low": F.col("block"), "high": F.col("block")}))
    joined = components(links, dealt.files)
    large = placed.where(F.col("n") > block_rows)
    if not large.isEmpty():
        known = large.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = known.groupBy("band", "key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least != most").select("band", "key")
        other = known.join(mixed, ["band", "key"]).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).where("other != block")
        more = linked(other.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other"))
        joined = components(links.union(more), dealt.files)
    return joined


def near_duplicates(
    docs: DataFrame, similar: float = 0.8, size: int = 5, common: float | None = None, bands: int = 12, samples_each: int = 3, block_rows: int = 1024, block_bytes: int = 4 << 20
) -> DataFrame:
    """``doc_id``, ``node``, ``component`` and ``class_id`` for each row: the text's digest, its class's, its class's least ``doc_id``.

    A class holds all texts connected by links of at least ``similar``; equal texts are one class even if all their shingles
    weigh 0. Texts without words (or null) are classes of their own, also if they are equal: their node and component are
    null and their class their ``doc_id``. A null ``doc_id`` never is a class's least; a class of such rows only has a null
    id. So ``class_id`` does not tell classes apart when ids are null or repeated; ``component`` does. Repeated rows are of
    one class. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").alias("id"), F.when(text.rlike(WORD), F.md5(text.cast("binary"))).alias("node"), text.alias("text"))
    rows = written(texts.select(F.col("id").alias("doc_id"), "node", F.octet_length("text").alias("bytes")), "rows")
    dealt = _Dealt(texts, rows.where(F.col("node").isNotNull()).agg(F.sum("bytes").alias("n")).first().n or 0, block_bytes)
    if common is None:
        shared = None
        alike = written(dealt.read().mapInArrow(giving_back(_sign(size, shared, FAMILY_BANDS, FAMILY_SAMPLES)), SIGNED), "samples", dealt.files)
        copies = _classes(dealt, alike, size, shared, None, KIN * similar, math.ceil(0.55 * KIN * FAMILY_BANDS * FAMILY_SAMPLES), block_rows)
        families = max(1, alike.count() - copies.count())
        left_out = alike.select("deal", "node").join(copies, "node", "left_semi")
        signed = dealt.meet(frequencies(dealt, left_out, size), _sign_block(size, families, bands, samples_each), SIGNED)
    else:
        shared, families = spark.sparkContext.broadcast(common_shingles(texts.select("text"), size, common)), None
        signed = dealt.read().mapInArrow(giving_back(_sign(size, shared, bands, samples_each)), SIGNED)
    joined = _classes(dealt, written(signed, "samples", dealt.files), size, shared, families, similar, math.ceil(0.55 * bands * samples_each), block_rows)
    dealt.drop()
    # Exact copies share a node, and may be a third of all rows: they are dealt to ``SALTS`` tasks.
    salted = rows.where(F.col("node").isNotNull()).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    spread = joined.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    member = salted.join(spread, ["node", "salt"], "left").select("doc_id", "node", F.coalesce("component", "node").alias("component"))
    classes = member.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    wordless = rows.where(F.col("node").isNull()).select("doc_id", "node", F.lit(None).cast("string").alias("component"), F.col("doc_id").alias("class_id"))
    return member.join(classes, "component").select("doc_id", "node", "component", "class_id").union(wordless)


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: that of the least ``doc_id``, then the least digest; null ids come last.

    Rows repeated within a class go; texts without words stay as they are.
    """
    found = near_duplicates(docs)
    number, node = unused(docs, "number"), unused(docs, "node")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("least")
    kept = found.where(F.col("node").isNotNull()).groupBy("component").agg(least)
    own = docs.withColumn(node, F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    kept = kept.select(F.col("least.doc_id").alias(number), F.col("least.node").alias("least_node"))
    copies = own.join(kept, own["doc_id"].eqNullSafe(kept[number]) & (own[node] == kept["least_node"]), "left_semi").dropDuplicates(["doc_id", node])
    # Exactly the texts whose node is null.
    wordless = docs.where(~F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(WORD))
    return copies.drop(node).unionByName(wordless)
