"""SentencePiece merge encoding with seeded merge dropout, and lossless decoding.

A text gets one space in front; spaces become U+2581. The agenda holds every adjacent pair of symbols that forms a piece;
the best score goes first, the leftmost on a tie. Each candidate merge is skipped when a hash keyed by the seed falls
below the dropout rate. The hash depends on the candidate alone (its document's key, the ordinal of its stretch, the
stretch's text and its place there), so every occurrence of a word draws its own drops, the same seed gives the same
pieces on any cluster, and a candidate can be judged when it is made rather than when it is taken.

No piece has a space after another character, so texts are encoded stretch by stretch, each from a space to the next.
Stretches of equal length are merged together as the rows of one array, one merge each per round; long ones by a heap.
Equal stretches of a slice share a row for as long as their drops are the same; where they differ, the row is split.
Characters without a piece, and U+2581 itself, become byte pieces.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelane.llm.frames import unused
from tidelane.llm.words import giving_back, mix, slices

SPACE = 0x2581
#: Stands for a U+2581 of the text, which is no space.
_LITERAL = 0x110000
#: Longest stretch that is merged as a row of an array.
ROW_CHARACTERS = 48
_NONE = np.int32(2**31 - 1)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class Pieces:
    """A merge-type model with byte pieces: its pieces, scores and merges as arrays."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        text = [model.id_to_piece(i) for i in range(size)]
        usual = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        ids = {text[i]: i for i in usual}
        if any(chr(SPACE) in t.lstrip(chr(SPACE)) for t in ids):
            raise ValueError("pieces with a space after other characters are not supported")
        self.size = size
        self.rank = np.unique([-model.get_score(i) for i in range(size)], return_inverse=True)[1].astype(np.int32)
        self.byte = np.full(256, -1, np.int32)
        for i in range(size):
            if model.is_byte(i):
                self.byte[int(text[i][3:-1], 16)] = i
        if (self.byte < 0).any():
            raise ValueError("the model has no byte pieces")
        self.single = np.full(_LITERAL + 1, -1, np.int32)
        pairs = {}
        for piece, i in ids.items():
            if len(piece) == 1:
                self.single[ord(piece)] = i
            for k in range(1, len(piece)):
                if piece[:k] in ids and piece[k:] in ids:
                    pairs[ids[piece[:k]] * size + ids[piece[k:]]] = i
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.slot = np.full(1 << 22, -1, np.int32)
        self.slot[self._place(self.keys)] = np.arange(len(self.keys))
        shown = [bytes([int(t[3:-1], 16)]) if model.is_byte(i) else t.replace(chr(SPACE), " ").encode() if t in ids else b"" for i, t in enumerate(text)]
        self.width = np.array([len(x) for x in shown])
        self.at = np.r_[0, np.cumsum(self.width)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)

    @staticmethod
    def _place(keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _ODD[0]) >> np.uint64(42)).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols form, or -1."""
        out = np.full(left.shape, -1, np.int32)
        both = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left.ravel()[both].astype(np.int64) * self.size + right.ravel()[both]
        at = self.slot[self._place(keys)]
        there = np.flatnonzero(at >= 0)
        both, keys, at = both[there], keys[there], at[there]
        sure = self.keys[at] == keys
        out.ravel()[both[sure]] = self.merged[at[sure]]
        rest = np.flatnonzero(~sure)  # another pair has the slot
        if len(rest):
            at = np.minimum(np.searchsorted(self.keys, keys[rest]), len(self.keys) - 1)
            found = self.keys[at] == keys[rest]
            out.ravel()[both[rest[found]]] = self.merged[at[found]]
        return out


@functools.lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def _dropped(key, start, middle, end, rate: float):
    """Whether candidates are skipped, by a hash keyed with ``key``, which holds the seed."""
    if not rate:
        return np.zeros(np.broadcast_shapes(np.shape(key), np.shape(start)), bool)
    places = [np.asarray(x).astype(np.uint64) * odd for x, odd in zip((start, middle, end), _ODD, strict=True)]
    return (mix(key + places[0] + places[1] + places[2]) >> np.uint64(32)).astype(np.float64) < rate * 2.0**32


def _split(made: np.ndarray, places: tuple[np.ndarray, np.ndarray, np.ndarray], key: np.ndarray, group: np.ndarray, rate: float):
    """Draw the drops of new candidates (a row's pieces or -1, at most 64, with their places) for every stretch of each row.

    Gives the earlier row of each row and its drops as bits, and the row of each stretch; rows that no stretch is left
    with go. Without any drop the first two are None.
    """
    bits = np.zeros(len(group), np.uint64)
    for c in range(made.shape[1]) if rate else ():
        own = np.flatnonzero(made[group, c] >= 0)
        at = group[own]
        bits[own[_dropped(key[own], *(x[at, c] for x in places), rate)]] |= np.uint64(1 << c)
    hit = np.flatnonzero(bits)
    if not len(hit):
        return None, None, group
    hit = hit[np.lexsort((bits[hit], group[hit]))]
    row, drops = group[hit], bits[hit]
    new = np.r_[True, (row[1:] != row[:-1]) | (drops[1:] != drops[:-1])]
    group = group.copy()
    group[hit] = len(made) + np.cumsum(new) - 1
    parent, drops = np.r_[np.arange(len(made)), row[new]], np.r_[np.zeros(len(made), np.uint64), drops[new]]
    stay = np.bincount(group, minlength=len(parent)) > 0
    return parent[stay], drops[stay], (np.cumsum(stay) - 1)[group]


def _merge_rows(pieces: Pieces, symbols: np.ndarray, key: np.ndarray, rate: float, group: np.ndarray | None = None) -> Iterator[tuple[tuple[np.ndarray, np.ndarray], np.ndarray]]:
    """Merge the rows of an array for all stretches: ``key`` and ``group`` give the key of each and its row.

    Yields stretches' numbers, with the place of each among the rows of final symbols that follow, as they come to an end.
    """
    stretch, width = np.arange(len(key)), symbols.shape[1]
    group = stretch if group is None else group
    symbols = symbols.astype(np.int32)
    start = np.broadcast_to(np.arange(width, dtype=np.uint8), symbols.shape).copy()
    end = start + np.uint8(1)
    made = pieces.pair(symbols[:, :-1], symbols[:, 1:])
    parent, drops, group = _split(made, (start[:, :-1], end[:, :-1], end[:, 1:]), key, group, rate)
    if parent is not None:
        symbols, start, end, made = (x[parent] for x in (symbols, start, end, made))
        made[(drops[:, None] >> np.arange(width - 1, dtype=np.uint64)) & np.uint64(1) > 0] = -1
    rank = np.where(made >= 0, pieces.rank[made], _NONE)
    while width > 1:
        best = np.argmin(rank, axis=1)
        each = np.arange(len(symbols))
        more = rank[each, best] < _NONE
        if not more.all():
            on = more[group]
            yield (stretch[~on], (np.cumsum(~more) - 1)[group[~on]]), symbols[~more]
            if not more.any():
                return
            symbols, start, end, made, rank, best = (x[more] for x in (symbols, start, end, made, rank, best))
            stretch, key, group = stretch[on], key[on], (np.cumsum(more) - 1)[group[on]]
            each = np.arange(len(symbols))
        symbols[each, best] = made[each, best]
        end[each, best] = end[each, best + 1]
        width -= 1
        stay = np.ones(symbols.shape, bool)
        stay[each, best + 1] = False
        symbols, start, end = (x[stay].reshape(len(symbols), width) for x in (symbols, start, end))
        stay = np.ones(made.shape, bool)
        stay[each, best] = False
        made, rank = (x[stay].reshape(len(symbols), width - 1) for x in (made, rank))
        new, places = np.full((len(symbols), 2), -1, np.int32), np.zeros((3, len(symbols), 2), np.uint8)
        for c, at in enumerate((best - 1, best)):
            ok = np.flatnonzero((at >= 0) & (at + 1 < width))
            at = at[ok]
            new[ok, c] = pieces.pair(symbols[ok, at], symbols[ok, at + 1])
            places[:, ok, c] = start[ok, at], end[ok, at], end[ok, at + 1]
        parent, drops, group = _split(new, tuple(places), key, group, rate)
        if parent is not None:
            symbols, start, end, made, rank, best, new = (x[parent] for x in (symbols, start, end, made, rank, best, new))
            new[(drops[:, None] >> np.arange(2, dtype=np.uint64)) & np.uint64(1) > 0] = -1
        for c, at in enumerate((best - 1, best)):
            ok = np.flatnonzero((at >= 0) & (at + 1 < width))
            made[ok, at[ok]] = new[ok, c]
            rank[ok, at[ok]] = np.where(new[ok, c] >= 0, pieces.rank[new[ok, c]], _NONE)
    yield (stretch, group), symbols


def _merge_long(pieces: Pieces, symbols: np.ndarray, key: np.ndarray, rate: float) -> np.ndarray:
    """The same for one stretch, by a heap."""
    n = len(symbols)
    own, left, right, end = symbols.tolist(), list(range(-1, n - 1)), [*range(1, n), -1], list(range(1, n + 1))
    agenda: list[tuple[int, int, int, int, int]] = []

    def offer(places: list[int]) -> None:
        places = [p for p in places if p >= 0 and right[p] >= 0]
        if places:
            a, b = np.array(places), np.array([right[p] for p in places])
            made = pieces.pair(np.array([own[p] for p in a]), np.array([own[p] for p in b]))
            skip = _dropped(np.full(len(a), key), a, b, np.array([end[p] for p in b]), rate)
            for p, q, piece, no in zip(places, b.tolist(), made.tolist(), skip.tolist(), strict=True):
                if piece >= 0 and not no:
                    heapq.heappush(agenda, (int(pieces.rank[piece]), p, end[p], end[q], piece))

    offer(list(range(n)))
    while agenda:
        _, p, middle, stop, piece = heapq.heappop(agenda)
        q = right[p] if own[p] is not None else -1
        if q < 0 or end[p] != middle or end[q] != stop:
            continue
        own[p], end[p], right[p], own[q] = piece, stop, right[q], None
        if right[p] >= 0:
            left[right[p]] = p
        offer([left[p], p])
    return np.array([x for x in own if x is not None], np.int64)


def _bytes_of(pieces: Pieces, tokens: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace negative symbols, which hold a character, by its byte pieces."""
    lost = tokens < 0
    if not lost.any():
        return tokens, owner
    code = np.where(lost, -tokens - 1, 0)
    code[code == _LITERAL] = SPACE
    n = np.where(lost, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)
    at = np.repeat(np.arange(len(tokens)), n)
    k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    c, size, out = code[at], n[at], tokens[at]
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[size]
    shift = 6 * (size - 1 - k)
    value = np.where(k == 0, lead | (c >> shift), 0x80 | ((c >> shift) & 0x3F))
    swap = lost[at]
    out[swap] = pieces.byte[value[swap]]
    return out, owner[at]


def encode_slice(pieces: Pieces, texts: list[str], keys: np.ndarray, rate: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of some texts, one after another, and how many each text has. ``keys``: a number for each text.

    Every stretch draws its own drops, also where it stands more than once.
    """
    parts = [" " + t if t else "" for t in texts]
    code = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).astype(np.int64)
    first = np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int64)
    if not len(code):
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    code[code == SPACE] = _LITERAL
    space = code == 0x20
    code[space] = SPACE
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[first[:-1][first[:-1] < len(code)]] = True
    start = np.flatnonzero(begins)
    length = np.diff(np.r_[start, len(code)])
    text = np.searchsorted(first, start, "right") - 1
    ordinal = np.arange(len(start)) - np.searchsorted(start, first)[text]
    # A hash of each stretch, and one of it, its place in its document and the seed.
    sums = np.zeros(len(code) + 1, np.uint64)
    place = np.arange(len(code)) - np.repeat(start, length)
    np.cumsum(mix(code.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(21))), out=sums[1:])
    content = sums[start + length] - sums[start]
    stream = mix(keys[text].astype(np.uint64) + ordinal.astype(np.uint64) * _ODD[1] + np.uint64(seed))
    key = mix(content + mix(stream + np.uint64(seed) * _ODD[2])) if rate else content
    symbols = pieces.single[code].astype(np.int64)
    symbols[symbols < 0] = -code[symbols < 0] - 1
    tokens, owners, made = [], [], 0
    same = np.empty(len(start), np.int64)  # the number of each stretch's tokens
    by_size = np.argsort(length, kind="stable")
    for own in np.split(by_size, np.flatnonzero(np.diff(length[by_size])) + 1):
        size = length[own[0]]
        long = size > ROW_CHARACTERS
        _, one, group = np.unique((key if long else content)[own], return_index=True, return_inverse=True)
        one = own[one]
        if long:
            same[own] = made + group
            for u in one:
                tokens.append(_merge_long(pieces, symbols[start[u] : start[u] + size], key[u], rate))
                owners.append(np.full(len(tokens[-1]), made))
                made += 1
        else:
            for (at, place), found in _merge_rows(pieces, symbols[start[one][:, None] + np.arange(size)], key[own], rate, group):
                same[own[at]] = made + place
                tokens.append(found.ravel())
                owners.append(np.repeat(np.arange(made, made + len(found)), found.shape[1]))
                made += len(found)
    token, owner = _bytes_of(pieces, np.concatenate(tokens), np.concatenate(owners))
    n = np.bincount(owner, minlength=made)
    begin = np.cumsum(n) - n
    each = n[same]
    where = np.repeat(begin[same] - (np.cumsum(each) - each), each) + np.arange(each.sum())
    return token[where], np.bincount(text, each, len(texts)).astype(np.int64)


def decode_slice(pieces: Pieces, tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of some texts, one after another, and the bytes of each."""
    size = pieces.width[tokens]
    where = np.repeat(pieces.at[tokens] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    data = pieces.shown[where]
    total = np.r_[0, np.cumsum(size)][np.cumsum(counts)] if len(counts) else np.zeros(0, np.int64)
    total = np.diff(np.r_[0, total])
    keep = np.ones(len(data), bool)
    keep[(np.cumsum(total) - total)[total > 0]] = False  # the space in front
    return data[keep], total - (total > 0)


def _run(path: str, text: str, key: str, into: str, rate: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            for rows, raw in slices(batch, text):
                texts = raw.cast(pa.string() if pa.types.is_binary(raw.type) else pa.large_string()).to_pylist()
                tokens, counts = encode_slice(pieces, texts, rows[key].to_numpy(), rate, seed)
                back, sizes = decode_slice(pieces, tokens, counts)
                want = [t.encode() for t in texts]
                at = np.r_[0, np.cumsum(sizes)].tolist()
                whole = back.tobytes()
                same = [whole[a:b] == w for a, b, w in zip(at, at[1:], want, strict=False)]
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(tokens.astype(np.int32)))
                made = pa.StructArray.from_arrays([ids, pa.array(counts), pa.array(same, pa.bool_())], ["ids", "n_tokens", "lossless"])
                rest = [i for i, c in enumerate(rows.schema.names) if c not in (key, into)]
                yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in rest), made], [*(rows.schema.names[i] for i in rest), into])

    return run


def encode(docs: DataFrame, model: str, into: str, key: str = "doc_id", rate: float = 0.1, seed: int = 1) -> DataFrame:
    """``docs`` with a struct column ``into``: ``ids``, ``n_tokens`` and ``lossless`` (decoding gives the text back).

    ``model`` is the path of the model's file on every executor. ``rate`` is the share of candidate merges that are
    skipped, drawn for each occurrence of a word; 0 gives the model's usual encoding. Null and empty texts have no ids. The dropout of a text depends on
    ``key``, the text and the seed only; rows without a key share one. Repeated rows are encoded alike. Other columns
    pass through; an earlier column ``into`` is replaced.
    """
    if not 0 <= rate < 1:
        raise ValueError("rate must be at least 0 and below 1")
    hashed = unused(docs, "dropout_key")
    docs = docs.drop(into).withColumn(hashed, F.xxhash64(key))
    schema = docs.drop(hashed).withColumn(into, F.lit(None).cast("struct<ids:array<int>,n_tokens:long,lossless:boolean>")).schema
    return docs.mapInArrow(giving_back(_run(model, "text", hashed, into, rate, seed)), schema)


def _decode(path: str, ids: str, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            lists = batch[ids]
            counts = np.array([0 if n is None else n for n in pa.compute.list_value_length(lists).to_pylist()], np.int64)
            data, sizes = decode_slice(pieces, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
            at = np.r_[0, np.cumsum(sizes)].tolist()
            whole = data.tobytes()
            made = pa.array([whole[a:b].decode(errors="replace") for a, b in zip(at, at[1:], strict=False)], pa.string())
            rest = [i for i, c in enumerate(batch.schema.names) if c != into]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), made], [*(batch.schema.names[i] for i in rest), into])

    return run


def decode(encoded: DataFrame, model: str, ids: str, into: str) -> DataFrame:
    """``encoded`` with the text of its list column ``ids`` in the column ``into``; null ids give an empty text."""
    encoded = encoded.drop(into)
    schema = encoded.withColumn(into, F.lit("")).schema
    return encoded.mapInArrow(_decode(model, ids, into), schema)
