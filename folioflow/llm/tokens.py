"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

#: Where the vocabulary lies; ranks in the form of tiktoken.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: how that vocabulary's tokenizer cuts text before merging bytes.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoding(path: str = VOCABULARY):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _counter(path: str, at: int, names: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        for b in batches:
            sizes = [len(encode(t)) if t else 0 for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(b.columns) if i != at), pa.array(sizes, pa.int64())], names=names)

    return count


def token_counts(documents: DataFrame, keep: list[str], text: str = "text", path: str = VOCABULARY, out: str = "tokens") -> DataFrame:
    """``keep`` and the number of tokens of each text; null and empty texts have none.

    The vocabulary is read from ``path`` on every executor, once a Python worker.
    """
    df = documents.select(*keep, text)
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + f", {out} long"
    return df.mapInArrow(_counter(path, len(keep), [*keep, out]), schema)
