"""Oversized texts into pieces under a limit, cut where the text pauses, with a set overlap.

Per text: prefix sums of estimated tokens over character offsets (the estimate is linear, so they are the scaled
offsets), a sorted array of pause positions by strength, and a binary search for the last pause under the limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.session import once_per_key, spread_out

TOKENS_PER_CHAR = 0.6
LIMIT = 1000
OVERLAP = 50
# a weaker pause wins only if no stronger one lies in the last part of the window
WINDOW_SHARE = 0.5

# Pauses from the strongest to the weakest; each match ends where a piece may end.
PAUSES = tuple(re.compile(p) for p in (r"\n\s*\n\s*", r"\n\s*", r"[.!?…]+[\"»”')\]]*\s+", r"[;:]\s+", r",\s+", r"\s+"))
RUN = re.compile(r"\S+")


def tokens(chars: int) -> int:
    """Estimated tokens of so many characters."""
    return int(chars * 6 // 10)


def chars_within(limit: int) -> int:
    """The most characters whose estimate is at most limit."""
    return (10 * limit + 9) // 6


def chars_reaching(wanted: int) -> int:
    """The fewest characters whose estimate is at least wanted."""
    return -(-10 * wanted // 6)


def longest_run(text: str) -> int:
    """Characters of the longest unbroken run of non-blank characters."""
    return max((m.end() - m.start() for m in RUN.finditer(text)), default=0)


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, str]]:
    """(start, end, cut) of the pieces of text. cut tells how the piece ends: end, boundary or forced.

    A piece never estimates above limit. Each but the first starts `overlap` estimated tokens before the end of the
    one before; where that would force a cut through a run of characters that fits by itself, the overlap shrinks
    just enough to keep the run whole. Only a run above the limit is cut by force.
    """
    most, back = chars_within(limit), chars_reaching(overlap) if overlap else 0
    if back >= most:
        raise ValueError("the overlap must be below the limit")
    if len(text) <= most:
        return [(0, len(text), "end")]
    ends = [np.array([m.end() for m in p.finditer(text)], np.int64) for p in PAUSES]
    # at a mere blank a piece may end before or after it
    weakest = ends[-1] = np.unique(np.concatenate([ends[-1], [m.start() for m in PAUSES[-1].finditer(text)]]).astype(np.int64))
    out, start, floor = [], 0, 0  # floor: where the piece before ended
    while len(text) - start > most:
        reach = start + most
        cut = 0
        for e in ends:
            k = int(np.searchsorted(e, reach, "right")) - 1
            if k >= 0 and e[k] > max(floor, start + int(most * WINDOW_SHARE)):
                cut = int(e[k])
                break
        if not cut:
            k = int(np.searchsorted(weakest, reach, "right")) - 1
            if k >= 0 and weakest[k] > floor:
                cut = int(weakest[k])
        kind = "boundary"
        if not cut:
            if start < floor:
                # only the overlap keeps the run from fitting: give it up as far as needed
                nxt = int(np.searchsorted(weakest, floor, "right"))
                run_end = int(weakest[nxt]) if nxt < len(weakest) else len(text)
                needed = max(start, min(floor, run_end - most))
                if run_end - floor <= most:
                    start = needed
                    continue
            cut, kind = reach, "forced"
        out.append((start, cut, kind))
        floor = cut
        start = max(cut - back, start + 1)
    out.append((start, len(text), "end"))
    return out


def split_texts(df: DataFrame, keys: list[str], text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """One row per piece: keys, piece, start, end, overlap_chars, cut, est_tokens, text_kind, piece_text.

    Texts within the limit come out as one piece with cut = end. text_kind is `whole`, `forced` if some piece had to be
    cut by force (which is so exactly if some unbroken run of non-blank characters is itself above the limit), else
    `boundary`. Null keys and texts give no row, the empty text one empty piece; repeated rows of a key count once (the
    smallest text, if they differ). Rows within the limit never reach Python, and only texts of repeated keys are moved.
    """
    most = chars_within(limit)
    base = df.where(F.col(text).isNotNull()).select(*keys, F.col(text).alias("__text"))
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    schema = T.StructType(
        [*(base.schema[k] for k in keys), *(T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.IntegerType()), ("end", T.IntegerType()), ("overlap_chars", T.IntegerType()), ("cut", T.StringType()), ("est_tokens", T.IntegerType()), ("text_kind", T.StringType()), ("piece_text", T.StringType())))]
    )
    names = [f.name for f in schema.fields]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                rows, cols = [], [[] for _ in range(8)]
                for r, t in enumerate(part.column(part.num_columns - 1).to_pylist()):
                    cuts = pieces(t, limit, overlap)
                    kind = "forced" if any(how == "forced" for _, _, how in cuts) else "boundary"
                    before = 0
                    for i, (a, e, how) in enumerate(cuts):
                        rows.append(r)
                        for c, v in zip(cols, (i, a, e, before - a if i else 0, how, tokens(e - a), kind, t[a:e]), strict=True):
                            c.append(v)
                        before = e
                types = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string()]
                idx = pa.array(rows, pa.int64())
                arrays = [part.column(i).take(idx) for i in range(len(keys))] + [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    one = once_per_key(base, keys, "__text")
    long, short = spread_out(one.where(F.length("__text") > most)), one.where(F.length("__text") <= most)
    whole = short.select(
        *keys, F.lit(0).alias("piece"), F.lit(0).alias("start"), F.length("__text").alias("end"), F.lit(0).alias("overlap_chars"), F.lit("end").alias("cut"),
        F.floor(F.length("__text") * F.lit(TOKENS_PER_CHAR)).cast("int").alias("est_tokens"), F.lit("whole").alias("text_kind"), F.col("__text").alias("piece_text"),
    )
    return long.mapInArrow(cut, schema).unionByName(whole)
