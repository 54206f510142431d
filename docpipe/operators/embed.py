"""Embedding behind a provider interface; the offline provider hashes words into a fixed number of dimensions."""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS, MAX_TEXTS = 64, 96
Provider = Callable[[list[str]], list[list[float]]]


def hashing_provider(texts: list[str], dims: int = DIMENSIONS) -> list[list[float]]:
    """Unit vectors of signed word counts; the same text always has the same vector."""
    out = np.zeros((len(texts), dims), np.float32)
    for i, t in enumerate(texts):
        for w in t.lower().split():
            h = zlib.crc32(w.encode())
            out[i, h % dims] += 1 if h & 1 << 31 else -1
    n = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(n == 0, 1, n)).tolist()


class Throttled(RuntimeError):
    """Raised by a provider that is asked too often; the request may be sent again."""


def embed_request(texts: list[str], provider: Provider, tries: int = 3, wait: Callable[[float], None] = time.sleep) -> list[list[float]]:
    """Vectors of at most MAX_TEXTS texts, in order.

    No text, an empty text, or too many of them is an error, as is another number of vectors than texts. Only Throttled
    is tried again, after 1, 2, 4... (at most 10) seconds; any other fault of the provider comes through at once.
    """
    if not texts or not all(texts):
        raise ValueError("there is nothing to embed")
    if len(texts) > MAX_TEXTS:
        raise ValueError(f"{len(texts)} texts in a request, {MAX_TEXTS} are allowed")
    for attempt in range(tries):
        try:
            got = provider(texts)
            break
        except Throttled:
            if attempt + 1 == tries:
                raise
            wait(min(10.0, 2.0**attempt))
    if len(got) != len(texts):
        raise ValueError(f"{len(texts)} texts sent, {len(got)} vectors received")
    return got


def embed_one(text: str, provider: Provider = hashing_provider) -> list[float]:
    return embed_request([text], provider)[0]


def embed(df: DataFrame, keys: list[str], text: str, provider: Provider = hashing_provider, tries: int = 3, size: int = MAX_TEXTS, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """keys, vector: texts sent in requests of `size` (at most 96), in order; null and empty texts are left out."""
    base = df.where(F.length(text) > 0).select(*keys, F.col(text).alias("__text"))
    schema = ", ".join(f"{k} {base.schema[k].dataType.simpleString()}" for k in keys) + ", vector array<float>"
    step = max(1, min(size, MAX_TEXTS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, vectors = pdf["__text"].tolist(), []
            for s in range(0, len(texts), step):
                vectors += embed_request(texts[s : s + step], provider, tries, wait)
            yield pdf[keys].assign(vector=vectors)

    return base.mapInPandas(run, schema)


def with_vectors(chunks: DataFrame, vectors: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Chunks and their vectors joined by position (key and ordinal); chunks without one are dropped, as by zip."""
    return chunks.join(vectors.select(*keys, F.col(vector).alias("vector")), keys)
