"""Token ids of a whole corpus by a public byte-level BPE vocabulary.

Texts up to `leaf` characters are encoded as they are. Longer ones are cut into leaves that are encoded in
parallel, wherever they lie: between words where the vocabulary's own word pattern allows it (then the ids of the
leaves are simply concatenated), and in halves inside an unsplit run that is itself too long. Such halves are
joined as a tree: around each join a growing window is encoded again until its first and last id are what they
were, which proves the join exact, as a byte-pair sequence is right if and only if every two neighbours are.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.session import once_per_key, spread_out

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LEAF = 1 << 12
# Fixed value: the word pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_CUT = re.compile(r"(?<=[^\W_])[ \n]")


@lru_cache(maxsize=4)
def vocabulary(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _pattern() -> regex.Pattern:
    return regex.compile(PATTERN)


def _last_cut(text: str, start: int, end: int) -> int:
    """The last place in (start, end] between a letter or digit and a blank or line end, 0 if there is none.

    No word of the pattern goes on over such a place, and none before it looks further, so the words on either side are
    the same with and without the other side.
    """
    while True:
        at = max(text.rfind(" ", start + 1, end + 1), text.rfind("\n", start + 1, end + 1))
        if at < 0 or text[at - 1].isalnum():
            return max(at, 0)
        end = at - 1


def leaves(text: str, leaf: int, run: int | None = None) -> list[tuple[int, str]]:
    """(run, part) in order: run is -1 for parts of whole words, else the place of the word it is, or is cut from.

    run, if below leaf: the most characters of a word that is not cut, else leaf.
    """
    if run is not None and run < leaf:
        return _by_words(text, leaf, run)
    out: list[tuple[int, str]] = []
    start = 0
    while len(text) - start > leaf:
        cut = _last_cut(text, start, start + leaf)
        if cut:
            out.append((-1, text[start:cut]))
        else:  # no such place within a leaf: word by word up to the next one
            cut = next((m.start() for m in _CUT.finditer(text, start + leaf)), len(text))
            out += [(at + start if at >= 0 else at, part) for at, part in _by_words(text[start:cut], leaf, leaf)]
        start = cut
    if start < len(text):
        out.append((-1, text[start:]))
    return out


def _by_words(text: str, leaf: int, run: int) -> list[tuple[int, str]]:
    """leaves of a text by its words; a word above run characters is cut into halves.

    A part of whole words ends only behind a non-blank character, so the pattern sees the same words without what follows.
    """
    out: list[tuple[int, str]] = []
    start = end = 0
    blanks: list[tuple[int, str]] = []  # words of blanks at the end of the open part
    for m in _pattern().finditer(text):
        if m.end() - m.start() > run:
            solid = m.start() - sum(len(w) for _, w in blanks)
            if solid > start:
                out.append((-1, text[start:solid]))
            out += blanks  # each by itself: without the run behind them they would be split otherwise
            out += [(m.start(), part) for part in _halves(m.group(), run)]
            start, blanks = m.end(), []
        else:
            if end - start >= max(1, leaf // 2) and not blanks:
                out.append((-1, text[start:end]))
                start = end
            blanks = [*blanks, (m.start(), m.group())] if m.group().isspace() else []
        end = m.end()
    if start < len(text):
        out.append((-1, text[start:]))
    return out


def _halves(run: str, leaf: int) -> list[str]:
    if len(run) <= leaf:
        return [run]
    mid = len(run) // 2
    return _halves(run[:mid], leaf) + _halves(run[mid:], leaf)


def join_ids(left: list[int], right: list[int], enc: tiktoken.Encoding) -> list[int]:
    """Ids of an unsplit run from the ids of its two parts."""
    if not left or not right:
        return left + right
    w = 4
    while True:
        a, b = left[-w:], right[:w]
        new = enc._encode_single_piece(enc.decode_bytes(a + b))
        if (w >= len(left) or new[0] == a[0]) and (w >= len(right) or new[-1] == b[-1]):
            return left[: len(left) - len(a)] + new + right[len(b) :]
        w *= 2


def join_tree(parts: list[list[int]], enc: tiktoken.Encoding) -> list[int]:
    while len(parts) > 1:
        parts = [join_ids(parts[i], parts[i + 1], enc) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else []


def encode_leaf(run: int, part: str, enc: tiktoken.Encoding) -> list[int]:
    return enc.encode_ordinary(part) if run < 0 else enc._encode_single_piece(part.encode())


def join_leaves(parts: list[tuple[int, list[int]]], enc: tiktoken.Encoding) -> list[int]:
    """Ids of a text from (run, ids) of its leaves in order."""
    out: list[int] = []
    i = 0
    while i < len(parts):
        run, j = parts[i][0], i + 1
        while run >= 0 and j < len(parts) and parts[j][0] == run:
            j += 1
        out += join_tree([p for _, p in parts[i:j]], enc) if run >= 0 else parts[i][1]
        i = j
    return out


def _id_lists(lists: list[list[int]]) -> pa.Array:
    return pa.array(lists, pa.list_(pa.int32()))


def encode_documents(df: DataFrame, key: str, text: str, path: str = VOCABULARY, leaf: int = LEAF, run: int | None = None) -> DataFrame:
    """key, ids (array<int>): the ids of every text, without special tokens.

    The null and the empty text have the empty list; strings that look like special tokens are ordinary text. Rows
    without a key are left out; rows of one key count once (if their texts differ, the smallest). An empty table
    gives an empty result; extra columns are ignored. Only texts of repeated keys and leaves of long texts are moved.
    """
    base = once_per_key(spread_out(df.where(F.col(key).isNotNull()).select(F.col(key).alias("__k"), F.col(text).alias("__t"))), ["__k"], "__t")
    kind = base.schema["__k"].dataType
    ids = T.StructField("ids", T.ArrayType(T.IntegerType()))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocabulary(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _id_lists([enc.encode_ordinary(t) if t else [] for t in b.column(1).to_pylist()])], names=["__k", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, t in enumerate(b.column(1).to_pylist()):
                parts = leaves(t, leaf, run)
                one = b.column(0).take(pa.array([r] * len(parts)))
                yield pa.RecordBatch.from_arrays([one, pa.array(range(len(parts)), pa.int32()), pa.array([p[0] for p in parts], pa.int64()), pa.array([p[1] for p in parts], pa.string())], names=["__k", "n", "run", "part"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocabulary(path)
        for b in batches:
            lists = [encode_leaf(r, p, enc) for r, p in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), _id_lists(lists)], names=["__k", "n", "run", "ids"])

    def join(t: pa.Table) -> pa.Table:
        rows = sorted(zip(t.column("n").to_pylist(), t.column("run").to_pylist(), t.column("ids").to_pylist(), strict=True))
        return pa.table([t.column("__k").slice(0, 1), _id_lists([join_leaves([(r, i) for _, r, i in rows], vocabulary(path))])], names=["__k", "ids"])

    key_field = T.StructField("__k", kind)
    direct = base.where(F.coalesce(F.length("__t"), F.lit(0)) <= leaf).mapInArrow(short, T.StructType([key_field, ids]))
    parts = base.where(F.length("__t") > leaf).mapInArrow(cut, T.StructType([key_field, T.StructField("n", T.IntegerType()), T.StructField("run", T.LongType()), T.StructField("part", T.StringType())]))
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    encoded = parts.repartition(spread).mapInArrow(encode, T.StructType([key_field, T.StructField("n", T.IntegerType()), T.StructField("run", T.LongType()), ids]))
    # a group holds the leaves of one text, which is one value of the result
    joined = encoded.groupBy("__k").applyInArrow(join, T.StructType([key_field, ids]))
    return direct.unionByName(joined).withColumnRenamed("__k", key)
