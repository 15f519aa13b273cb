"""Problem 8: token ids of the whole corpus by a public tokenizer."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergetide.llm.bpe import Encoder, read_ranks
from mergetide.sources import read_table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
_ENCODERS: dict[int, Encoder] = {}


def _encoder(raw: bytes) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    if (k := hash(raw)) not in _ENCODERS:
        _ENCODERS[k] = Encoder(read_ranks(raw))
    return _ENCODERS[k]


def token_ids(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """array<int>: the ids of each text; an empty list for an empty or null one. The driver reads the vocabulary (under 1 MB) and sends it along."""
    raw = Path(tokenizer).read_bytes()

    @F.arrow_udf("array<int>")
    def ids(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        e = _encoder(raw)
        for t in texts:
            yield pa.array([e.encode(x) for x in t.to_pylist()], pa.list_(pa.int32()))

    return ids(text)


def token_count(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """int: the number of ids of each text; 0 for an empty or null one."""
    raw = Path(tokenizer).read_bytes()

    @F.arrow_udf("int")
    def count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        e = _encoder(raw)
        for t in texts:
            yield pa.array([len(e.encode(x)) for x in t.to_pylist()], pa.int32())

    return count(text)


def encode_corpus(documents: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(key, ids) of every row, repeated keys included. No shuffle: each partition of the scan is encoded where it is read."""
    return documents.select(documents[key], token_ids(documents[text], tokenizer).alias("ids"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(read_table(spark, folder, "documents", "doc_id", "text"))


QUERIES = {"p8_ids": p8_ids}
ORACLES: dict[str, str] = {}
