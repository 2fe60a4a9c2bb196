"""Sizes of texts in tokens of a public tokenizer, whose files stay where they are."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=2)
def _encoding(vocabulary: str):  # noqa: ANN202
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(vocabulary).read_bytes().splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(df: DataFrame, columns: list[str], text: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """The given columns, `text_key` (SHA-256 of the text) and `tokens`; texts themselves go no further.

    Null and empty texts have 0 tokens, and the key null.
    """
    keyed = df.select(*columns, F.col(text).alias("_text"), F.when(F.length(text) > 0, F.sha2(F.col(text), 256)).alias("text_key"))
    schema = T.StructType([*keyed.select(*columns, "text_key").schema.fields, T.StructField("tokens", T.LongType())])

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoding(vocabulary)
        for part in parts:
            sizes = [len(x) for x in enc.encode_ordinary_batch([t or "" for t in part["_text"]], num_threads=1)]
            yield part.drop(columns="_text").assign(tokens=sizes)

    return keyed.mapInPandas(count, schema)
