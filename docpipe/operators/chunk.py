"""Chunk rows of a table of texts, in one pass over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docpipe.functions import chunking
from docpipe.session import spread_out

Cut = Callable[[str], list[str]]
SLICE = 256  # texts handled at a time
CHUNK_FIELDS = (("chunk_index", T.IntegerType()), ("chunk_total", T.IntegerType()), ("text", T.StringType()), ("token_count", T.IntegerType()), ("char_start", T.IntegerType()), ("char_end", T.IntegerType()))


def _pass(df: DataFrame, kept: list[str], text: str, fields: tuple, rows_of: Callable[[str], list[tuple]]) -> DataFrame:
    """kept and fields: for every text that isn't blank after normalisation, the rows that rows_of makes of it."""
    base = df.select(*kept, text)
    schema = T.StructType([*(base.schema[k] for k in kept), *(T.StructField(n, t) for n, t in fields)])
    kinds = {T.IntegerType(): pa.int32(), T.StringType(): pa.string()}
    types, names = [kinds[t] for _, t in fields], [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, SLICE):
                part = b.slice(s, SLICE)
                idx, rows = [], []
                for r, t in enumerate(part.column(len(kept)).to_pylist()):
                    if t and (whole := chunking.normalized(t)).strip():
                        new = rows_of(whole)
                        idx += [r] * len(new)
                        rows += new
                at = pa.array(idx, pa.int64())
                cols = zip(*rows, strict=True) if rows else [[] for _ in fields]
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(at) for i in range(len(kept))), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)

    return spread_out(base).mapInArrow(run, schema)


def chunk_texts(
    df: DataFrame, keys: list[str], text: str, target: int = chunking.TARGET, largest: int = chunking.LARGEST, overlap: int = chunking.OVERLAP, carry: list[str] | None = None
) -> DataFrame:
    """keys, carry, chunk_index, chunk_total, text, token_count, char_start, char_end: one row per chunk.

    carry names other columns that go along with every chunk of their row (they must not bear one of the names above);
    all others are dropped. char_start is the place of the chunk in the normalised text, -1 if it isn't there word for
    word (an overlapped chunk usually isn't); char_end is char_start plus the chunk's length. Null and blank texts give
    no row; repeated rows give repeated chunks.
    """
    own = [n for n, _ in CHUNK_FIELDS]
    if clash := {*keys, *(carry or [])} & set(own):
        raise ValueError(f"columns would be there twice: {sorted(clash)}")

    def rows_of(whole: str) -> list[tuple]:
        chunks = chunking.with_overlap(chunking.plain_chunks(whole, target, largest), overlap)
        at = chunking.places(whole, chunks, overlap)
        return [(i, len(chunks), c, chunking.tokens(c), a, a + len(c)) for i, (c, a) in enumerate(zip(chunks, at, strict=True))]

    source = "__text"
    return _pass(df.withColumn(source, df[text]), [*keys, *(carry or [])], source, CHUNK_FIELDS, rows_of)


def cut_texts(df: DataFrame, keys: list[str], text: str, cut: Cut) -> DataFrame:
    """keys, chunk_index, chunk: the chunks that `cut` makes of every normalised text that isn't blank."""
    return _pass(df, keys, text, (("chunk_index", T.IntegerType()), ("chunk", T.StringType())), lambda whole: list(enumerate(cut(whole))))


def chunk_counts(df: DataFrame, keys: list[str], text: str, **sizes: int) -> DataFrame:
    """keys, chunks: the number of chunks of every text that isn't blank."""
    return _pass(df, keys, text, (("chunks", T.IntegerType()),), lambda whole: [(len(chunking.plain_chunks(whole, **sizes)),)])
