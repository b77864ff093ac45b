"""Quality rules whose cutoffs carry a guarantee on labelled documents.

Each rule measures something bad about a text and rejects above a cutoff. Cutoffs come from a fixed list, the mildest
first. For each stratum and rule they are tested in that order: the exact binomial probability of so few rejected good
documents, were the true share of good documents rejected at its limit, must not exceed ``error`` divided by all strata
and rules (Bonferroni); the first cutoff that fails ends the sequence. So with probability 1 - ``error`` no chosen
cutoff rejects more good documents of its stratum than the limit, and all rules together no more than ``limit``. Among
the cutoffs that pass, the one whose rejected share of bad documents exceeds that of good ones most is taken.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelane.llm.frames import unused, written
from tidelane.llm.words import SPACED, giving_back, mix, slices, words_of

#: The rules' cutoffs, mildest first.
CUTOFFS = {
    "symbols": (3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1),
    "capitals": (0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "exclamations": (3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1),
    "repeated_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2),
    "repeated_words": (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURE = ",".join([*(f"{c}:long" for c in COUNTS), *(f"{r}:double" for r in CUTOFFS)])


def _marks(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


_SYMBOLS, _CAPITALS, _EXCLAMATION = _marks("#*$%&|<>"), _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _marks("!")
_CHARACTER = (np.arange(256) & 0xC0) != 0x80  # not a later byte of a character


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts and rule values of some texts (binary, no nulls)."""
    words = words_of(texts, SPACED)
    n = np.diff(words.first)

    def counted(marks: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(marks)][words.base])

    h, of = words.hashes(exact=True), words.of()
    last = len(h) - 2
    repeated = np.zeros(len(h), bool)
    if last > 0:
        window = np.flatnonzero(of[:last] == of[2:])
        key = mix(h[window] * np.uint64(0x9E3779B97F4A7C15) + h[window + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[window + 2] + mix(of[window].astype(np.uint64)))
        order = np.argsort(key)
        equal = key[order][1:] == key[order][:-1]
        twice = window[order[np.r_[equal, False] | np.r_[False, equal]]] if len(order) else order
        for k in range(3):
            repeated[twice + k] = True
    lines, copies = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts.to_pylist()):
        own = [x for x in text.split(b"\n") if x.strip()]
        lines[i], copies[i] = len(own), len(own) - len(set(own))
    character = _CHARACTER[words.data]
    out = {
        "n_words": n, "word_chars": counted(character & SPACED[words.data]), "n_symbols": counted(_SYMBOLS[words.data]),
        "n_dup_lines": copies, "n_repeat_words": np.diff(np.r_[0, np.cumsum(repeated)][words.first]),
    }
    some = np.maximum(n, 1)
    return out | {
        "symbols": out["n_symbols"] / some,
        "capitals": counted(_CAPITALS[words.data]) / np.maximum(out["word_chars"], 1),
        "exclamations": counted(_EXCLAMATION[words.data]) / some,
        "repeated_lines": copies / np.maximum(lines, 1),
        "repeated_words": out["n_repeat_words"] / some,
    }


def _run(into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                found = measures(texts)
                made = pa.StructArray.from_arrays([pa.array(x) for x in found.values()], list(found))
                at = rows.schema.get_field_index(into)
                yield pa.RecordBatch.from_arrays([made if i == at else c for i, c in enumerate(rows.columns)], rows.schema.names)

    return run


def measure(docs: DataFrame, into: str) -> DataFrame:
    """``docs`` with a struct column ``into`` of counts and rule values; null text counts as empty."""
    out = docs.withColumn(into, F.lit(None).cast(f"struct<{MEASURE}>"))
    return out.mapInArrow(giving_back(_run(into)), out.schema)


def at_most(k: int, n: int, p: float) -> float:
    """The exact probability of ``k`` or fewer of ``n`` when each has probability ``p``."""
    i = np.arange(k + 1)
    logs = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) for j in i.tolist()]
    return float(min(1.0, np.exp(np.array(logs) + i * math.log(p) + (n - i) * math.log1p(-p)).sum()))


def choose(good: list[int], bad: list[int], cutoffs: tuple[float, ...], limit: float, level: float) -> float:
    """The best cutoff that passes, or infinity. ``good[i]``: good documents above exactly ``i`` of the cutoffs.

    The mildest cutoff is the highest, so what exceeds it exceeds all.
    """
    n, m, best, found = sum(good), sum(bad), 0.0, math.inf
    for i, cutoff in enumerate(cutoffs):
        k = sum(good[len(cutoffs) - i :])
        if not n or k >= n * limit or at_most(k, n, limit) > level:
            break
        gain = (sum(bad[len(cutoffs) - i :]) / m if m else 0) - k / n
        if gain > best + 1e-12:
            best, found = gain, cutoff
    return found


def calibrate(measured: DataFrame, labels: DataFrame, into: str, stratum: str = "lang", limit: float = 0.03, error: float = 0.05, least_share: float = 0.001) -> dict[str, list[float]]:
    """Cutoffs of all rules for each stratum; '' is for strata that hold less than ``least_share`` of the labelled documents.

    ``labels`` has ``doc_id`` and ``quality`` (1: good, 0: bad). All labelled documents count, except those that the base
    rules reject. A document with several labels is good if all say so; null labels are ignored. There are
    1 / ``least_share`` strata at most, and the driver holds a few counts for each.
    """
    judged = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    values = F.array(*[F.array(F.lit(float(i)), F.col(f"{into}.{r}")) for i, r in enumerate(CUTOFFS)])
    kept = measured.where(~base_failed(into)).select("doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), values.alias("values"))
    known = kept.join(judged, "doc_id")
    total = known.count()
    strata = sorted(r.stratum for r in known.groupBy("stratum").count().where(F.col("count") >= least_share * total).collect()) if total else []
    place = F.when(F.col("stratum").isin(strata), F.col("stratum")).otherwise("")
    lists = F.array(*[F.array(*map(F.lit, c)) for c in CUTOFFS.values()])
    cut = F.element_at(lists, F.col("value")[0].cast("int") + 1)
    above = F.size(F.filter(cut, lambda c: F.col("value")[1] > c))
    rows = known.withColumn("value", F.explode("values")).groupBy(place.alias("place"), F.col("value")[0].cast("int").alias("rule"), above.alias("above"), "good").count().collect()
    counts = defaultdict(lambda: [0] * (max(map(len, CUTOFFS.values())) + 1))
    for r in rows:
        counts[r.place, r.rule, r.good][r.above] += r["count"]
    places = sorted({*strata, ""})
    level = error / (len(places) * len(CUTOFFS))
    return {p: [choose(counts[p, i, True], counts[p, i, False], c, limit / len(CUTOFFS), level) for i, c in enumerate(CUTOFFS.values())] for p in places}


def base_failed(into: str) -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows of three."""
    n = F.col(f"{into}.n_words")
    return (n < 50) | (F.col(f"{into}.n_repeat_words") * 100 > n * 50)


def failed_rules(cutoffs: dict[str, list[float]], into: str, stratum: str = "lang") -> Column:
    """The names of the rules that reject a document, from its measures and stratum."""
    own = F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    by_place = F.create_map(*[x for p, c in cutoffs.items() for x in (F.lit(p), F.array(*map(F.lit, c)))])
    cut = F.coalesce(F.try_element_at(by_place, own), F.array(*map(F.lit, cutoffs[""])))
    return F.filter(F.array(*[F.when(F.col(f"{into}.{r}") > cut[i], F.lit(r)) for i, r in enumerate(CUTOFFS)]), lambda x: x.isNotNull())


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without documents that the base rules or a calibrated rule rejects; columns and texts as they were.

    Empty and null texts fail the base rules. Without labels only the base rules reject.
    """
    into = unused(docs, "measured")
    # Written once, since calibration reads the measures several times; texts are measured again only to be filtered.
    slim = written(measure(docs.select("doc_id", "lang", "text"), "measured").drop("text"), "measures")
    cutoffs = calibrate(slim, labels, "measured")
    return measure(docs, into).where(~base_failed(into) & (F.size(failed_rules(cutoffs, into)) == 0)).drop(into)
