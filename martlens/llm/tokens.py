"""Token ids of whole texts under a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.llm.common import columns, ready


def vocabulary_path() -> str:
    """The 50k byte-level vocabulary as ranks, the same as .json beside it; each machine has the
    public files in its Python."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


#: Runs of letters or blanks from this length on go to the slower library: the fast one takes time
#: in the square of such a run.
LONG_RUN = 1000
_BLANKS = re.compile(r"\s{%d}" % LONG_RUN)


class Encoder:
    """Ids of the vocabulary's ``tokenizers`` file, in which the string of an added token is that
    token, and no token is put around a text; read by ``tiktoken``, three times as fast, but for texts with very long runs."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.steady = None
        self.steady_path = path.removesuffix(".tiktoken") + ".json"
        with open(self.steady_path, encoding="utf-8") as f:
            added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self.known = {*ranks.values(), *added.values()}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def encode(self, text: str) -> list[int]:
        if len(text) < LONG_RUN or max(map(len, text.split()), default=0) < LONG_RUN and not _BLANKS.search(text):
            return self.fast.encode(text, allowed_special="all")
        return self._steady().encode(text, add_special_tokens=False).ids

    def encode_plain(self, text: str) -> list[int]:
        """As ``encode``, but the string of an added token in a text is plain text."""
        if len(text) < LONG_RUN or max(map(len, text.split()), default=0) < LONG_RUN and not _BLANKS.search(text):
            return self.fast.encode_ordinary(text)
        steady = self._steady()
        steady.encode_special_tokens = True
        try:
            return steady.encode(text, add_special_tokens=False).ids
        finally:
            steady.encode_special_tokens = False

    def _steady(self):
        if self.steady is None:
            from tokenizers import Tokenizer
            self.steady = Tokenizer.from_file(self.steady_path)
        return self.steady


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def with_token_counts(docs: DataFrame, text: str = "text", name: str = "n_tokens", path: str | None = None) -> DataFrame:
    """``docs`` with the number of token ids of the whole text; 0 for null and empty texts."""
    ready(docs.sparkSession)

    @F.pandas_udf("long")
    def count(texts):
        import pandas as pd
        encode = encoder(path or vocabulary_path()).encode
        return pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return docs.select(*[c for c, n in zip(columns(docs), docs.columns) if n != name], count(F.col(text)).alias(name))


def cut_tokens(docs: DataFrame, key: Column, text: str, length: int, end_id: int, path: str | None = None) -> DataFrame:
    """(key, start, length, doc_tokens, ids): the ids of each text and the end id after them, cut
    every ``length``; ids are little-endian unsigned 32-bit."""
    ready(docs.sparkSession, 256)
    rows = docs.select(key.alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def cut(batches):
        import numpy as np
        encode = encoder(path or vocabulary_path()).encode
        for batch in batches:
            keys, out = batch.column("key"), ([], [], [], [], [])
            for row, value in enumerate(batch.column("text").to_pylist()):
                ids = np.array([*(encode(value) if value else ()), end_id], dtype="<u4")
                for at in range(0, len(ids), length):
                    part = ids[at:at + length]
                    for column, v in zip(out, (row, at, len(part), len(ids), part.tobytes())):
                        column.append(v)
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(out[0], pa.int64())), *(pa.array(c, pa.int64()) for c in out[1:4]),
                 pa.array(out[4], pa.binary())], names=["key", "start", "length", "doc_tokens", "ids"])

    return rows.mapInArrow(cut, f"key {kind}, start long, length long, doc_tokens long, ids binary")
