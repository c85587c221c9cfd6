"""Calls to engines outside Spark: embedding and recognition of page images.

A client is made once for each task by a factory and gets batches of bounded
size. Results are matched by row, so none can be lost or shifted unnoticed.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Client = Callable[[list[str]], list[list[float] | None]]


def hashing_client(dimension: int = 64) -> Client:
    """A client without a network: signed counts of hashed words, of unit length; null for a text without words."""

    def embed(texts: list[str]) -> list[list[float] | None]:
        out: list[list[float] | None] = []
        for text in texts:
            v = np.zeros(dimension)
            for word in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
                v[h % dimension] += 1 if h >> 63 else -1
            length = np.linalg.norm(v)
            out.append((v / length).tolist() if length else None)
        return out

    return embed


def with_retries(client: Client, tries: int = 5, pause: float = 0.5, most: float = 20.0) -> Client:
    """The client called again after errors, with rising pauses; the last error is raised."""

    def embed(texts: list[str]) -> list[list[float] | None]:
        for n in range(tries):
            try:
                return client(texts)
            except Exception:
                if n == tries - 1:
                    raise
                time.sleep(min(most, pause * 1.5**n))
        raise AssertionError

    return embed


def embed(text: Column, factory: Callable[[], Client], batch: int = 96) -> Column:
    """Vectors of texts as array<float>; null texts give null. A client that returns another number of vectors is an error."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        client = factory()
        for texts in parts:
            out: list = [None] * len(texts)
            rows = [k for k, t in enumerate(texts) if t is not None]
            for start in range(0, len(rows), batch):
                at = rows[start : start + batch]
                vectors = client([texts.iloc[k] for k in at])
                if len(vectors) != len(at):
                    raise ValueError(f"{len(at)} texts, but {len(vectors)} vectors")
                for k, v in zip(at, vectors):
                    out[k] = v
            yield pd.Series(out)

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "array<float>")(text)


def recognise(pages: DataFrame, engine: Callable[[], Callable[[bytes], str]], least: int = 50, policy: str = "fallback") -> DataFrame:
    """Page texts, where the text layer is too thin from the page's image.

    ``pages`` has text and image. Only the pages that need it go through the
    engine: they are divided off by a filter, since a CASE would run a Python
    function for all rows. Policies: 'fallback' recognises, 'skip' leaves the
    thin text as it is, 'error' raises for it.
    """
    from quirebase.functions.text import effective_length

    thin = effective_length(F.col("text")) < least
    if policy == "skip":
        return pages.drop("image")
    if policy == "error":
        return pages.withColumn("text", F.when(thin, F.raise_error(F.lit("a page has too little text"))).otherwise(F.col("text"))).drop("image")

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        read = engine()
        for images in parts:
            yield images.map(lambda i: read(i) if i is not None else "")

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    thick = pages.where(~thin).drop("image")
    return thick.unionByName(pages.where(thin).withColumn("text", F.pandas_udf(run, "string")("image")).drop("image"))
