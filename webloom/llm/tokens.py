"""Sizes of texts in tokens of a public tokenizer, whose files stay outside the repository."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.arrow import map_rows

#: Folder of the vocabulary files; every executor must see it.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary splits text before merging bytes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(4)
def encoding(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    import tiktoken

    with open(os.path.join(folder, vocabulary), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def token_sizes(df: DataFrame, key: str, text: str, *carried: str, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, carried..., tokens long): whole texts; null counts 0, as empty does."""
    kinds = dict(df.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in (key, *carried)] + ["tokens long"])

    def make():
        encode = encoding(folder, vocabulary).encode_ordinary

        def expand(*values):
            body = values[-1]
            return [(*values[:-1], len(encode(body)) if body else 0)]

        return expand

    return map_rows(df.select(key, *carried, F.col(text).cast("string")), schema, make)
