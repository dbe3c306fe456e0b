"""Language identification by compression.

For each language, text of sampled labelled documents is a raw-content zstandard dictionary. A text is encoded against every
dictionary in pieces of `PIECE` bytes, and the smallest total wins: pieces are short, so that what is already known to the
dictionary counts more than what the text says twice. A narrow margin, or a text without letters, is a rejection.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The sample that a dictionary is made of: so many documents of each language, so many characters of each.
SAMPLE_DOCUMENTS = 48
SAMPLE_CHARS = 1000
LEVEL = 6
PIECE = 1024
MARGIN = 0.003
UNKNOWN = "und"


def learn_dictionaries(
    documents: DataFrame, learn: Column, *, documents_per_language: int = SAMPLE_DOCUMENTS, chars: int = SAMPLE_CHARS
) -> list[tuple[str, bytes]]:
    """(language, dictionary) of the rows where ``learn`` holds, the language with most rows first.

    A bounded sample: the rows with the smallest hash of doc_id and text in each language. Rows with NULL or empty
    text or NULL language teach nothing. The driver gets the samples, at most documents x chars for each language.
    """
    rows = documents.where(learn & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    order = Window.partitionBy("lang").orderBy("h", "sample")
    sample = (
        rows.select("lang", F.xxhash64("doc_id", "text").alias("h"), F.lower(F.substring("text", 1, chars)).alias("sample"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= documents_per_language)
        .orderBy("lang", "rank")
        .collect()
    )
    texts: dict[str, list[str]] = {}
    for row in sample:
        texts.setdefault(row["lang"], []).append(row["sample"])
    order_of = sorted(texts, key=lambda lang: (-counts[lang], lang))
    return [(lang, "\n".join(texts[lang]).encode()) for lang in order_of]


def _compressors(dictionaries: list[tuple[str, bytes]]) -> list[zstandard.ZstdCompressor]:
    made = []
    for _, raw in dictionaries:
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(
            level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False
        ))
    return made


def _judged(text: str | None, langs: list[str], compressors: list[zstandard.ZstdCompressor], margin: float) -> tuple[str, float, bool]:
    """lang_pred, score, rejected of one text."""
    if not langs or text is None or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    raw = text.lower().encode()
    pieces = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
    sizes = np.array([sum(len(c.compress(p)) for p in pieces) for c in compressors])
    best = int(sizes.argmin())
    if len(sizes) == 1:
        return langs[0], 1.0, False
    second = int(np.delete(sizes, best).min())
    score = (second - int(sizes[best])) / second
    return langs[best], score, score < margin


def identify(documents: DataFrame, dictionaries: list[tuple[str, bytes]], *, margin: float = MARGIN) -> DataFrame:
    """All columns of ``documents`` and a struct ``language``: lang_pred, score, rejected.

    score is how much larger the second-best encoding is, as a share of it, 0 to 1; ties go to the language that was
    learned from more rows. NULL text, text without a letter and, when nothing was learned, every text are ``und``, score 0,
    rejected. Whole texts are encoded. Repeated rows stay, an empty table stays empty.
    """
    langs = [lang for lang, _ in dictionaries]
    result = "struct<lang_pred:string,score:double,rejected:boolean>"
    arrow = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(dictionaries)
        for batch in batches:
            found = [_judged(t.as_py(), langs, compressors, margin) for t in batch["text"]]
            column = pa.array([dict(zip(("lang_pred", "score", "rejected"), x, strict=True)) for x in found], arrow)
            kept = [n for n in batch.schema.names if n != "language"]
            yield pa.RecordBatch.from_arrays([batch[n] for n in kept] + [column], names=[*kept, "language"])

    own = documents.drop("language")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    return own.mapInArrow(run, f"{fields}, language {result}")


def accepted(documents: DataFrame, dictionaries: list[tuple[str, bytes]], *, margin: float = MARGIN) -> DataFrame:
    """The documents that are not rejected, with their columns. When nothing was learned, those with a letter all stay."""
    if not dictionaries:
        return documents.where(F.col("text").rlike(r"\p{L}"))
    langs = [lang for lang, _ in dictionaries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(dictionaries)
        for batch in batches:
            yield batch.filter(pa.array([not _judged(t.as_py(), langs, compressors, margin)[2] for t in batch["text"]], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
