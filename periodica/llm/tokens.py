"""SentencePiece encoding with seeded merge-dropout, and decoding, over a table of texts.

Each document has a key, a hash of the seed and its id; `pieces.Segmenter` takes every decision on a
merge from the key and the candidate's place, so that a run can be repeated, another seed gives other
segmentations of the same texts, and the parts of a corpus can be encoded anywhere. Dropout 0 is the
plain segmentation. The vocabulary file is read on the driver and sent to the tasks (some 0.5 MB).

Defined results: a null or empty text has no pieces and decodes to the empty text. Code points that
are no piece, the sign that stands for a blank among them, become the pieces of their bytes, so that
every text decodes to itself. Rows with equal ids and texts have equal pieces; a null id is a key
like any other. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import sliced, table, texts
from periodica.llm.pieces import Segmenter, Vocabulary, decode

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 7


@lru_cache(2)
def vocabulary(model: bytes) -> Vocabulary:
    """Made once per Python worker."""
    return Vocabulary(model)


def encoded(
    docs: DataFrame, model_file: str = MODEL, dropout: float = DROPOUT, seed: int = SEED
) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_chars, n_pieces, pieces, lossless (whether the
    pieces decode to the text)."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(model_file).read_bytes())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(shared.value)
        segmenter = Segmenter(words, dropout)
        for whole in batches:
            for batch in sliced(whole):
                found = batch.column("text").to_pylist()
                keys = batch.column("key").to_numpy().view(np.uint64)
                pieces = segmenter.encode(found, keys)
                sizes = [len(x) for x in pieces]
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                own = [decode(words, p.tolist()) == t for p, t in zip(pieces, found, strict=True)]
                columns = {
                    "doc_id": batch.column("doc_id"),
                    "n_chars": pa.array([len(t) for t in found], pa.int64()),
                    "n_pieces": pa.array(sizes, pa.int64()),
                    "pieces": pa.ListArray.from_arrays(ends, pa.array(np.concatenate(pieces))),
                    "lossless": pa.array(own, pa.bool_()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    keyed = texts(docs).select("doc_id", "text", F.xxhash64(F.lit(seed), "doc_id").alias("key"))
    schema = "doc_id long, n_chars long, n_pieces long, pieces array<int>, lossless boolean"
    return keyed.mapInArrow(rows, schema)


def decoded(rows: DataFrame, model_file: str = MODEL) -> DataFrame:
    """(doc_id, text) from (doc_id, pieces); null pieces give a null text."""
    shared = rows.sparkSession.sparkContext.broadcast(Path(model_file).read_bytes())

    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(shared.value)
        for whole in batches:
            for batch in sliced(whole):
                found = [
                    None if x is None else decode(words, x) for x in batch.column("pieces").to_pylist()
                ]
                columns = {"doc_id": batch.column("doc_id"), "text": pa.array(found, pa.string())}
                yield pa.RecordBatch.from_pydict(columns)

    return rows.select(F.col("doc_id").cast("long"), "pieces").mapInArrow(
        texts_of, "doc_id long, text string"
    )


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


QUERIES = {"op7_pieces": op7_pieces}
ORACLE: dict[str, str] = {}
