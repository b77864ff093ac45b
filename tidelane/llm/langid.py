"""Language identification by compression: the language whose dictionary makes a text smallest.

Each language has a Zstandard raw-content dictionary, made of pieces of its labelled texts. A text's letters, in lower case, are cut
into chunks, and each chunk is encoded with every language's dictionary; the sizes of all chunks add up, so the whole text counts
and not just its beginning. The smallest sum wins. A text whose second smallest sum is within ``least_margin`` of it is not accepted.

Only what the dictionaries hold is a sample; its bounds are the parameters of ``learn``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelane.llm.frames import unused
from tidelane.llm.words import slices

UNKNOWN = "und"
FOUND = "struct<lang:string,score:double,margin:double,accepted:boolean>"


@dataclass(frozen=True)
class Dictionaries:
    """The learned languages, those of most texts first, and the content of each one's dictionary."""

    languages: list[str]
    contents: list[bytes]


def letters(text: Column) -> Column:
    """A text's letters in lower case; a space stands for each stretch of anything else. Null gives ''."""
    return F.lower(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"\P{L}++", " "))


def learn(docs: DataFrame, where: Column, lang: str = "lang", buckets: int = 256, piece: int = 512, size: int = 32768, most_languages: int = 1000) -> Dictionaries:
    """Dictionaries from the rows of ``docs`` (``text`` and ``lang``) for which ``where`` holds.

    Texts are dealt to ``buckets`` by a hash of their content, and in each language the text with the smallest hash of each bucket gives
    ``piece`` of its letters, from a place its hash chooses, up to ``size`` bytes a language. So equal texts count once, and the choice does not depend
    on the order or the partitions of the rows. Rows with a null language, and texts without letters, teach nothing; no
    rows give no languages. More than ``most_languages`` labels are an error, since every task holds all dictionaries.
    """
    clean = docs.where(where).select(F.col(lang).cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    clean = clean.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    hashed = clean.withColumn("hash", F.xxhash64("text")).withColumn("bucket", F.pmod("hash", F.lit(buckets)).cast("int"))
    chosen = hashed.groupBy("lang", "bucket").agg(F.min("hash").alias("hash"), F.count("*").alias("n"))
    counted = chosen.limit(most_languages * buckets + 1).collect()
    totals: dict[str, int] = {}
    for row in counted:
        totals[row.lang] = totals.get(row.lang, 0) + row.n
    if len(totals) > most_languages:
        raise ValueError(f"more than {most_languages} languages are labelled")
    languages = sorted(totals, key=lambda name: (-totals[name], name))
    # As many rows as languages and buckets at most, so the broadcast has a bound.
    wanted = F.broadcast(docs.sparkSession.createDataFrame([(r.lang, r.bucket, r.hash) for r in counted], "lang string, bucket int, hash long"))
    own = F.trim(letters(F.col("text")))
    start = F.pmod("hash", F.greatest(F.length("own") - piece + 1, F.lit(1))).cast("int") + 1
    cut = hashed.join(wanted, ["lang", "bucket", "hash"]).withColumn("own", own).select("lang", "bucket", F.substr("own", start, F.lit(piece)).alias("piece"))
    pieces = cut.groupBy("lang", "bucket").agg(F.min("piece").alias("piece")).collect()
    contents = []
    for name in languages:
        mine = sorted((r.bucket, r.piece) for r in pieces if r.lang == name)
        contents.append(b" ".join(p.encode() for _, p in mine)[:size])
    return Dictionaries(languages, contents)


class Encoders:
    """One encoder for each dictionary, at one level."""

    def __init__(self, contents: list[bytes], level: int, chunk: int):
        self.chunk = chunk
        self.encoders = []
        for content in contents:
            # A dictionary of less than eight bytes counts as none.
            shared = zstandard.ZstdCompressionDict(content.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(level, source_size=chunk, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False)
            shared.precompute_compress(compression_params=how)
            self.encoders.append(zstandard.ZstdCompressor(compression_params=how, dict_data=shared))

    def sizes(self, text: bytes) -> np.ndarray:
        total = np.zeros(len(self.encoders), np.int64)
        for at in range(0, len(text), self.chunk):
            part = text[at : at + self.chunk]
            total += [len(e.compress(part)) for e in self.encoders]
        return total


def choose(text: bytes, known: Dictionaries, plain: Encoders, fine: Encoders, least_margin: float) -> dict:
    """The verdict on a text's letters. Where the smallest sizes are equal, a finer level decides; if they still are, the language of more texts."""
    if not text or not known.languages:
        return {"lang": UNKNOWN, "score": 0.0, "margin": 0.0, "accepted": False}
    sizes = plain.sizes(text)
    if (sizes == sizes.min()).sum() > 1:
        sizes = fine.sizes(text)
    best = int(sizes.argmin())
    more = np.delete(sizes, best) - sizes[best]
    margin = float(more.min() / sizes[best]) if len(more) else 1.0
    # A byte less is eight bits less: so much likelier is the text under that language's encoder.
    score = float(1 / (1 + np.exp2(-8.0 * np.minimum(more, 100)).sum()))
    return {"lang": known.languages[best], "score": score, "margin": margin, "accepted": margin >= least_margin}


def _identify(text: str, into: str, known: Dictionaries, level: int, fine_level: int, chunk: int, least_margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, fine = (Encoders(known.contents, each, chunk) for each in (level, fine_level))
        for batch in batches:
            for rows, texts in slices(batch, text):
                made = [choose(t.strip(b" "), known, plain, fine, least_margin) for t in texts.to_pylist()]
                at = rows.schema.get_field_index(into)
                yield rows.set_column(at, rows.schema.field(into), pa.array(made, rows.schema.field(into).type)).drop_columns([text])

    return run


def identify(docs: DataFrame, known: Dictionaries, into: str, level: int = 6, fine_level: int = 12, chunk: int = 1024, least_margin: float = 0.02) -> DataFrame:
    """``docs`` with a struct column ``into``: ``lang``, ``score``, ``margin`` and ``accepted``.

    ``lang`` is the language of the smallest size whether accepted or not; ``margin`` is by what share the next one is larger,
    ``score`` the chosen language's share of all languages' likelihoods. Texts that are null or hold no letter are ``und``,
    as are all texts when nothing was learned; their score is 0. Only ``docs.text`` is looked at. Other columns pass through;
    an earlier column ``into`` is replaced; rows repeat as given.
    """
    own = unused(docs, "text_letters")
    out = docs.withColumn(into, F.lit(None).cast(FOUND))
    return out.withColumn(own, letters(F.col("text"))).mapInArrow(_identify(own, into, known, level, fine_level, chunk, least_margin), out.schema)
