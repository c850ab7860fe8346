"""Language identification by compression.

A model holds one raw-content dictionary per language: up to `dict_bytes` of letters from a sample of
at most `sample_docs` learnable documents of that language, those with letters and the least hash of
their ids. Of the letters of a whole document at most 4 * `dict_bytes` / `sample_docs` are taken (4,096
with the values below), in `PIECES` pieces spread over all of it; if a language's pieces are more than
`dict_bytes`, the last ones make the dictionary. A text is encoded with zstandard once per dictionary; the language whose dictionary gives the fewest
bytes wins. The score is the share of bytes saved against the second best, 0 to 1; a prediction is
accepted only where it reaches `min_margin`, narrower ones are rejected (`accepted` false).

Texts are reduced to lower-case words of letters and encoded whole, in blocks of `block_bytes`, so
that a long text keeps being compared with the dictionaries and not with itself.

Defined results: a text that is null or has no letter is `und` with score 0 and not accepted, as is
every text where no language was learned; with one language only, every other text gets that one with
score 1. Ties go to the language that sorts first. Repeated rows each have their result, and other
columns than id, text and, for learning, lang are not read. Rows without id, letters or lang are not
learned from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodica.llm.common import learnable, table

SAMPLE_DOCS = 96
DICT_BYTES = 96 << 10
BLOCK_BYTES = 4096
MIN_MARGIN = 0.01
PIECES = 8
LEVEL, MIN_MATCH = 7, 4
UNKNOWN = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean"

NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Words of letters in lower case, one blank between them."""
    return NOT_LETTERS.sub(" ", text.lower()).strip()


def spread(words: str, most: int) -> str:
    """At most `most` characters of `words`, in pieces from its beginning to its end."""
    width = (most - PIECES + 1) // PIECES
    if len(words) <= most or width < 1:
        return words[:most]
    room = len(words) - width
    starts = (i * room // (PIECES - 1) for i in range(PIECES))
    return " ".join(words[a : a + width] for a in starts)


def learn(
    docs: DataFrame, sample_docs: int = SAMPLE_DOCS, dict_bytes: int = DICT_BYTES
) -> dict[str, bytes]:
    """Dictionaries from learnable rows of `docs` (doc_id, text, lang): a bounded sample of each language."""
    rows = docs.filter(
        F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull()
    ).filter(learnable(F.col("doc_id")))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # ids only; the texts of the few that are chosen are read by a second scan
    ids = rows.select("doc_id", "lang").withColumn("nth", F.row_number().over(by_hash))
    ids = ids.filter(F.col("nth") <= sample_docs).select("doc_id", "lang", "nth")
    share = 4 * dict_bytes // sample_docs
    sample = rows.join(F.broadcast(ids), ["doc_id", "lang"]).select("lang", "nth", "text")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(text=[spread(letters(t), share) for t in batch["text"]])

    # bounded: languages times sample_docs times share
    sample = sample.mapInPandas(pieces, "lang string, nth int, text string")
    words: dict[str, list[str]] = {}
    for row in sorted(sample.collect(), key=lambda r: (r.lang, r.nth, r.text)):
        words.setdefault(row.lang, []).append(row.text)
    return {lang: " ".join(x).encode()[-dict_bytes:] for lang, x in words.items()}


class Encoders:
    """One compressor per language; made inside the tasks, as compressors can't travel."""

    def __init__(self, dictionaries: dict[str, bytes], block_bytes: int) -> None:
        self.block = block_bytes
        self.by_lang = {}
        for lang, content in sorted(dictionaries.items()):
            form = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(
                LEVEL,
                dict_size=len(content),
                source_size=block_bytes,
                min_match=MIN_MATCH,
                write_content_size=False,
                write_dict_id=False,
            )
            self.by_lang[lang] = zstandard.ZstdCompressor(dict_data=form, compression_params=how)

    def best(self, text: str | None) -> tuple[str, float]:
        data = letters(text).encode("utf-8", "replace") if text else b""
        if not data or not self.by_lang:
            return UNKNOWN, 0.0
        blocks = [data[i : i + self.block] for i in range(0, len(data), self.block)]
        sizes = {
            lang: sum(len(encoder.compress(x)) for x in blocks)
            for lang, encoder in self.by_lang.items()
        }
        first, *others = sorted(sizes, key=lambda x: (sizes[x], x))
        return first, 1 - sizes[first] / sizes[others[0]] if others else 1.0


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    min_margin: float = MIN_MARGIN,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of `docs` (doc_id, text) the columns of SCHEMA; one map over the whole texts."""
    # bounded: languages times dict_bytes
    model = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoders = Encoders(model.value, block_bytes)
        for batch in batches:
            found = [encoders.best(t) for t in batch["text"]]
            lang, score = [x[0] for x in found], [x[1] for x in found]
            sure = [a != UNKNOWN and s >= min_margin for a, s in found]
            yield batch[["doc_id", "held_out"]].assign(lang_pred=lang, score=score, accepted=sure)

    held_out = ~F.coalesce(learnable(F.col("doc_id")), F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text")
    return rows.mapInPandas(predict, SCHEMA)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, learn(docs))


QUERIES = {"op9_langid": op9_langid}
ORACLE: dict[str, str] = {}
