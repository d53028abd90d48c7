"""Language identification by compression with per-language dictionaries.

A language's dictionary is raw text of that language. A text is cut into frames
of a few kilobytes, each frame is compressed with every dictionary, and the
language with the smallest sum wins. Frames keep the dictionary's say in a long
text, where the text itself would otherwise soon be the better context. Case,
digits and marks say little of a language and are levelled first.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkscore.llm.batches import slices

DICTIONARY_BYTES = 96 << 10  # raw content of each language's dictionary
EXCERPT_CHARS = 2_000  # of one training text that a dictionary may hold, more where texts are few
PIECES = 4  # that an excerpt takes from all over a text
SAMPLE_ROWS = 120  # training texts wanted per language
FRAME_BYTES = 4 << 10
LEVEL = 6
MIN_MARGIN = 0.01  # narrower margins are rejected
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")


def plain(text: str) -> str:
    """Lower-cased letters; what lies between them is one blank."""
    return _OTHER.sub(" ", text.lower())


def id_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % buckets


def excerpt(text: Column, size: Column) -> Column:
    """The text, or ``PIECES`` of it from the beginning to the end with ``size`` characters in all."""
    length, piece = F.length(text), F.ceil(size / PIECES).cast("int")
    parts = [F.substr(text, (F.lit(1) + F.floor((length - piece) * i / (PIECES - 1))).cast("int"), piece) for i in range(PIECES)]
    return F.when(length <= size, text).otherwise(F.concat_ws("\n", *parts))


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, excerpt_chars: int = EXCERPT_CHARS, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionaries by language from rows with text and ``lang``.

    About ``sample_rows`` different texts per language are drawn by a hash of the
    text, so a rare language gives all it has, and copies count once. Each adds at
    most ``excerpt_chars``, or its share of the dictionary where that is more. What
    reaches the driver is bounded by languages x (sample x excerpt + dictionary).
    """
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL AND length(text) > 0")
    texts = rows.select("lang", F.xxhash64("text").alias("at")).distinct()
    counts = {r[0]: r[1] for r in texts.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return {}

    def by_language(value: Callable[[int], float]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, value(n))]), F.col("lang"))

    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    size = by_language(lambda n: max(excerpt_chars, -(-dictionary_bytes // n)))
    drawn = (
        rows.where(draw < by_language(lambda n: min(1.0, sample_rows / n)))
        .select("lang", F.xxhash64("text").alias("at"), excerpt(F.col("text"), size).alias("text"))
        .distinct()
        .collect()
    )
    found: dict[str, bytes] = {}
    for lang in sorted(counts):
        own = sorted((r["at"], r["text"]) for r in drawn if r["lang"] == lang)
        raw = "\n".join(plain(x[1]) for x in own).encode()
        if raw:
            found[lang] = raw[:dictionary_bytes]
    return found


class Compressors:
    """One compressor per language, in code point order."""

    def __init__(self, dictionaries: Mapping[str, bytes]):
        self.langs = sorted(dictionaries)
        self.packers = []
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.packers.append(zstandard.ZstdCompressor(dict_data=content, write_content_size=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        raw = plain(text).encode()
        frames = [raw[i : i + FRAME_BYTES] for i in range(0, len(raw), FRAME_BYTES)]
        return [sum(len(p.compress(x)) for x in frames) for p in self.packers]


def judge(sizes: list[int], langs: list[str], min_margin: float) -> tuple[str, float, bool]:
    """Language, score and whether the margin is too narrow. Ties go to the first code."""
    best = int(np.argmin(sizes))
    if len(sizes) == 1:
        return langs[0], 1.0, False
    second = min(s for i, s in enumerate(sizes) if i != best)
    margin = (second - sizes[best]) / second
    return langs[best], margin, margin < min_margin


def identify(docs: DataFrame, dictionaries: Mapping[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred, score, rejected`` (replacing columns of these names).

    ``score`` is the relative lead over the second smallest size, 0 to 1.
    ``lang_pred`` is ``und`` with score 0, rejected, if the text is null or has no
    letter, or if there is nothing to compare with. Only ``text`` is read, whole
    whatever its length, in frames. Rows are independent, repeated ones get equal
    answers; no rows give no rows.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    dictionaries = dict(dictionaries)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Compressors(dictionaries)
        for batch in batches:
            for table in slices(batch):
                found = []
                for text in table["text"].to_pylist():
                    if not text or not known.langs or not any(map(str.isalpha, text)):
                        found.append((UNKNOWN, 0.0, True))
                    else:
                        found.append(judge(known.sizes(text), known.langs, min_margin))
                langs, scores, rejected = zip(*found)
                table = table.append_column("lang_pred", pa.array(langs, pa.string()))
                table = table.append_column("score", pa.array(scores, pa.float64()))
                table = table.append_column("rejected", pa.array(rejected, pa.bool_()))
                yield from table.to_batches()

    schema = T.StructType([*docs.schema.fields]).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.mapInArrow(work, schema)
