"""Token counts under a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The rank file, one base64 piece and its rank a line; see the folder's README for the pattern that goes with it.
VOCABULARY = os.path.join(os.environ.get("STRATA_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_50k.tiktoken")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries of a worker's table of counted words; a full table is emptied, which costs time and changes nothing else.
TABLE = 400_000

_split = re.compile(r" (?=\S)").split


class Counter(dict):
    """Tokens of a piece of text that starts after a blank; counted once and kept.

    The pattern never joins a blank before a visible character to what precedes it, so a text's tokens are those of its
    pieces cut at such blanks, each but the first with its blank.
    """

    def __init__(self, vocabulary: str) -> None:
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(" " + piece))
        if len(piece) < 40:
            if len(self) >= TABLE:
                self.clear()
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        first, *rest = _split(text)
        return len(self.encode(first)) + sum(map(self.__getitem__, rest))


_counters: dict[str, Counter] = {}


def count_tokens(df: DataFrame, text: str = "text", out: str = "n_tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds the number of tokens of `text`; null and empty texts have 0. `vocabulary` must be readable on every executor."""

    @F.pandas_udf("int")
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counters.get(vocabulary) or _counters.setdefault(vocabulary, Counter(vocabulary))
        for batch in texts:
            yield pd.Series([counter.count(t) if t else 0 for t in batch], dtype="int32")

    return df.withColumn(out, counted(F.col(text)))
