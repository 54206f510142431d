"""Freely typed values to the entries of a reference list: token repair by edit distance, then soft TF-IDF.

Distinct values are cut into tokens; each distinct token is joined to the vocabulary of the list through shared
deletion variants (an equi-join that finds every word within two edits, transpositions included) and, for short
forms, through prefixes, first-and-last letters and initials. The repaired tokens are combined by soft TF-IDF
into a score for every entry that shares a token; values written without blanks are compared as one long token.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docpipe.session import cut_lineage

# Words that carry no meaning of their own in Spanish names.
STOPWORDS = frozenset("a al de del e el en la las lo los o para por u un una y".split())

MIN_COVERAGE = 0.6  # share of an entry's squared weight that the value must cover
MIN_SCORE = 0.5
UNKNOWN_WEIGHT = 0.4  # weight of a token that matches no word of the list, as a share of the largest weight
WHOLE_EDITS = 2

_BROKEN = re.compile(r"[ÂÃ][\u0080-¿]")
_INITIALS = re.compile(r"(?<![a-z0-9])(?:[a-z0-9]\.\s?){2,}(?![a-z0-9]{2})")
_TOKEN = re.compile(r"[a-z0-9]+\.?")


def fold(s: str) -> str:
    """Lower case without accents; UTF-8 read as Latin-1 is put right where its bytes survive."""
    s = _BROKEN.sub(lambda m: m[0].encode("latin-1").decode("utf-8", "replace"), s)
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
    return s.lower()


def tokens_of(s: str) -> list[tuple[str, bool]]:
    """(token, may be short for something) without stopwords; spelled-out initials are drawn together."""
    t = _INITIALS.sub(lambda m: re.sub(r"[^a-z0-9]", "", m[0]) + " ", fold(s))
    t = re.sub(r"[©ªº°]", "", t)
    found = [(w.rstrip("."), w.endswith(".")) for w in _TOKEN.findall(t)]
    return [(w, a) for i, (w, a) in enumerate(found) if (w not in STOPWORDS or (a and i and i == len(found) - 1)) and not w.isdigit()]


def whole_of(s: str) -> str:
    """All letters of the value in one piece."""
    return re.sub(r"[^a-z]", "", fold(s))


def deletions(w: str, n: int) -> set[str]:
    """w and what is left of it after up to n letters are taken out."""
    out = {w}
    for k in range(1, min(n, len(w) - 1) + 1):
        out.update("".join(c) for c in itertools.combinations(w, len(w) - k))
    return out


def edits(a: str, b: str) -> int:
    """Damerau-Levenshtein distance: a swap of neighbours counts once, also when letters between them are touched."""
    last_row: dict[str, int] = {}
    far = len(a) + len(b)
    d = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i, x in enumerate(a, 1):
        last_col = 0
        for j, y in enumerate(b, 1):
            r, c = last_row.get(y, 0), last_col
            if x == y:
                last_col = j
            d[i + 1][j + 1] = min(d[i][j] + (x != y), d[i + 1][j] + 1, d[i][j + 1] + 1, d[r][c] + (i - r - 1) + 1 + (j - c - 1))
        last_row[x] = i
    return d[-1][-1]


def allowed_edits(length: int) -> int:
    return 0 if length <= 3 else 1 if length <= 5 else 2


def _key(kind: str, s: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}:{s}") - (1 << 63)


def _is_subsequence(short: str, word: str) -> bool:
    it = iter(word)
    return all(c in it for c in short)


def number_forms(tok: str) -> list[str]:
    """The token as typed and, where it may be a Spanish plural, without its ending."""
    return [tok, *(tok[: -len(e)] for e in ("s", "es") if tok.endswith(e) and len(tok) - len(e) >= 4)]


def _edits_by_number(tok: str, word: str) -> int:
    return min(edits(t, word) for t in number_forms(tok))


def _prefix_edits(length: int) -> int:
    return 0 if length < 2 else 1 if length < 8 else 2


def token_keys(tok: str, kind: str, short: bool) -> set[int]:
    """Join keys of a typed token. kind: word, or whole for a value in one piece."""
    if kind == "whole":
        return {_key("whole", v) for t in number_forms(tok) for v in deletions(t, WHOLE_EDITS)}
    keys = {_key("word", v) for t in number_forms(tok) for v in deletions(t, allowed_edits(len(t)))}
    if short:
        keys |= {_key("prefix", v) for v in deletions(tok, _prefix_edits(len(tok)))}
    if len(tok) >= 2 and (short or len(tok) <= 4):
        keys.add(_key("ends", tok[0] + tok[-1]))
    if 2 <= len(tok) <= 3:
        keys.add(_key("initials", tok))
    return keys


def word_keys(word: str, kind: str, initials: list[str]) -> set[int]:
    """Join keys of a word of the list, meeting those of every token that may stand for it."""
    if kind == "whole":
        return {_key("whole", v) for v in deletions(word, WHOLE_EDITS)}
    keys = {_key("word", v) for v in deletions(word, 2)}
    if kind == "sigla":  # short names are taken as typed: a letter more or less makes another one
        return set()
    for n in range(1, len(word)):
        keys |= {_key("prefix", v) for v in deletions(word[:n], 1 if n < 7 else 2)}
    keys.add(_key("ends", word[0] + word[-1]))
    keys |= {_key("initials", i) for i in initials}
    return keys


def likeness(tok: str, short: bool, word: str, kind: str, initials: list[str]) -> float:
    """How well a typed token stands for a word of the list, 0 if not at all."""
    if tok == word:
        return 1.0
    if kind == "whole":
        d = _edits_by_number(tok, word)
        return 1 - d / max(len(tok), len(word)) if d <= WHOLE_EDITS and len(word) >= 6 else 0.0
    if kind == "sigla":
        return 0.0
    best = 0.0
    if (d := _edits_by_number(tok, word)) <= min(allowed_edits(len(tok)), allowed_edits(len(word)) + 1):
        best = 1 - d / max(len(tok), len(word))
    if short:
        if word.startswith(tok):
            best = max(best, 0.95 if len(tok) > 1 else 0.6)
        elif len(tok) >= 2 and min(edits(tok, word[:n]) for n in range(len(tok) - 1, len(tok) + 2)) <= _prefix_edits(len(tok)):
            best = max(best, 0.8 if len(tok) > 3 else 0.5)
    if len(tok) >= 2 and tok[0] == word[0] and (short or len(tok) <= 4) and len(tok) < len(word) and _is_subsequence(tok, word):
        best = max(best, 0.8 if tok[-1] == word[-1] else 0.0)
    if tok in initials:
        best = max(best, 0.8)
    return best


def reference_words(refs: DataFrame) -> DataFrame:
    """refs: field, ref_id, name, sigla (nullable). Returns field, ref_id, word, kind, weight, norm2, initials, keys.

    Weights are ln(1 + entries / entries with the word), by field; the list is small by nature and fixed in size.
    """
    schema = "field string, ref_id int, word string, kind string, initials array<string>"

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                if r.name is None:
                    continue
                toks = [w for w, _ in tokens_of(r.name)]
                for i, w in enumerate(dict.fromkeys(toks)):
                    first = "".join(x[0] for x in toks[:2])
                    rows.append((r.field, r.ref_id, w, "word", [first] if i < 2 and len(toks) > 2 else []))
                rows.append((r.field, r.ref_id, whole_of(r.name), "whole", []))
                if isinstance(r.sigla, str) and (s := re.sub(r"[^a-z0-9]", "", fold(r.sigla))):
                    rows.append((r.field, r.ref_id, s, "sigla", []))
            yield pd.DataFrame(rows, columns=["field", "ref_id", "word", "kind", "initials"])

    words = refs.select("field", "ref_id", "name", "sigla").mapInPandas(cut, schema).distinct()
    total = words.groupBy("field").agg(F.countDistinct("ref_id").alias("entries"))
    df = words.where("kind = 'word'").groupBy("field", "word").agg(F.countDistinct("ref_id").alias("df"))
    weighted = (
        words.join(total, "field").join(df, ["field", "word"], "left")
        .withColumn("weight", F.when(F.col("kind") == "word", F.log(1 + F.col("entries") / F.col("df"))).otherwise(F.log(1 + F.col("entries").cast("double"))))
        .drop("entries", "df")
    )
    norms = weighted.where("kind = 'word'").groupBy("field", "ref_id").agg(F.sum(F.col("weight") ** 2).alias("norm2"))
    return weighted.join(norms, ["field", "ref_id"], "left")


def match_values(values: DataFrame, refs: DataFrame) -> DataFrame:
    """values: field, value (any rows). Returns field, value, ref_id (0: none), score, one row per distinct value.

    Null values give no row; blank values, and values without any letter, match none. Ties of the score go to the
    larger covered share and then to the smaller ref_id. Entries without a name are ignored; an empty list matches
    nothing. Distinct values and then distinct tokens are formed before any join, so a value that a third of all
    rows repeat is handled once.
    """
    schema = "field string, value string, tok string, kind string, short boolean, pos int"

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for f, v in zip(pdf["field"], pdf["value"], strict=True):
                toks = tokens_of(v)
                rows += [(f, v, w, "word", a, i) for i, (w, a) in enumerate(toks)]
                if w := whole_of(v):
                    rows.append((f, v, w, "whole", False, -1))
            yield pd.DataFrame(rows, columns=["field", "value", "tok", "kind", "short", "pos"])

    distinct = values.where("value is not null").select("field", "value").distinct()
    # both are small against the table they come from and used by several joins below
    toks = cut_lineage(distinct.mapInPandas(cut, schema))
    words = cut_lineage(reference_words(refs))
    by_token = cut_lineage(_repair(toks.select("field", "tok", "kind", "short").distinct(), words))

    hits = toks.join(by_token, ["field", "tok", "kind", "short"]).join(
        words.select("field", "ref_id", "word", F.col("kind").alias("as_kind"), "weight", "norm2"), ["field", "word", "as_kind"]
    )
    best_word = hits.groupBy("field", "value", "ref_id", "as_kind", "word").agg(F.max("sim").alias("sim"), F.max("weight").alias("weight"), F.max("norm2").alias("norm2"))
    entry = best_word.groupBy("field", "value", "ref_id").agg(
        F.sum(F.when(F.col("as_kind") == "word", F.col("weight") ** 2 * F.col("sim"))).alias("shared"),
        F.max(F.when(F.col("as_kind") == "word", F.col("norm2"))).alias("norm2"),
        F.coalesce(F.max(F.when(F.col("as_kind") != "word", F.col("sim"))), F.lit(0.0)).alias("alias_sim"),
    )
    largest = words.groupBy("field").agg(F.max("weight").alias("largest"))
    known = hits.where("as_kind = 'word'").groupBy("field", "value", "pos").agg(F.max(F.col("weight") * F.col("sim")).alias("w"))
    query = (
        toks.where("kind = 'word'").select("field", "value", "pos").join(known, ["field", "value", "pos"], "left").join(largest, "field")
        .groupBy("field", "value").agg(F.sum(F.coalesce(F.col("w"), UNKNOWN_WEIGHT * F.col("largest")) ** 2).alias("qnorm2"))
    )
    scored = (
        entry.join(query, ["field", "value"], "left")
        .withColumn("coverage", F.coalesce(F.col("shared") / F.col("norm2"), F.lit(0.0)))
        .withColumn("score", F.greatest(F.coalesce(F.col("shared") / F.sqrt(F.col("norm2") * F.col("qnorm2")), F.lit(0.0)), "alias_sim"))
        .where(((F.col("coverage") >= MIN_COVERAGE) & (F.col("score") >= MIN_SCORE)) | (F.col("alias_sim") > 0))
    )
    w = Window.partitionBy("field", "value").orderBy(F.desc("score"), F.desc("coverage"), "ref_id")
    top = scored.withColumn("r", F.row_number().over(w)).where("r = 1").select("field", "value", "ref_id", "score")
    return distinct.join(top, ["field", "value"], "left").select("field", "value", F.coalesce("ref_id", F.lit(0)).alias("ref_id"), F.coalesce("score", F.lit(0.0)).alias("score"))


def _repair(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """field, tok, kind, short, word, as_kind, sim: every word of the list a token may stand for."""

    def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = b.to_pydict()
            rows = [(f, t, k, s, key) for f, t, k, s in zip(d["field"], d["tok"], d["kind"], d["short"], strict=True) for key in token_keys(t, k, s)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)] if rows else [pa.array([], t) for t in (pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64())], names=["field", "tok", "kind", "short", "key"])

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(r.field, r.word, r.kind, list(r.initials), key) for r in pdf.itertuples(index=False) for key in word_keys(r.word, r.kind, list(r.initials))]
            yield pd.DataFrame(rows, columns=["field", "word", "as_kind", "initials", "key"])

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["sim"] = [likeness(t, s, w, k, list(i)) for t, s, w, k, i in zip(pdf["tok"], pdf["short"], pdf["word"], pdf["as_kind"], pdf["initials"], strict=True)]
            yield pdf.loc[pdf["sim"] > 0, ["field", "tok", "kind", "short", "word", "as_kind", "sim"]]

    forms = words.groupBy("field", "word", "kind").agg(F.array_distinct(F.flatten(F.collect_list("initials"))).alias("initials"))
    # a token that is a word of the list needs no repair; one value in one piece is only compared as such
    exact = tokens.join(forms.withColumnRenamed("kind", "as_kind"), (tokens.field == forms.field) & (tokens.tok == forms.word)).where(
        "(kind = 'whole' and as_kind = 'whole') or (kind = 'word' and as_kind <> 'whole')"
    )
    exact = exact.select(tokens.field, "tok", "kind", "short", "word", "as_kind", F.lit(1.0).alias("sim"))
    open_ = tokens.join(exact.select("field", "tok", "kind").distinct(), ["field", "tok", "kind"], "left_anti")
    # a token longer than any word of its sort by more than the edits and a plural ending can't stand for one
    sort = F.when(F.col("kind") == "whole", "whole").otherwise("word").alias("kind")
    reach = words.groupBy("field", sort).agg((F.max(F.length("word")) + WHOLE_EDITS + 2).alias("reach"))
    open_ = open_.join(reach, ["field", "kind"]).where(F.length("tok") <= F.col("reach")).drop("reach")
    # few bytes but much work per token: spread evenly, which also keeps the tasks from being merged
    spread = int(open_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = open_.repartition(spread, "tok").mapInArrow(typed, "field string, tok string, kind string, short boolean, key long")
    right = forms.mapInPandas(listed, "field string, word string, as_kind string, initials array<string>, key long")
    pairs = left.join(right, ["field", "key"]).where("(kind = 'whole') = (as_kind = 'whole')")
    pairs = pairs.select("field", "tok", "kind", "short", "word", "as_kind", "initials").distinct().repartition(spread)
    out = "field string, tok string, kind string, short boolean, word string, as_kind string, sim double"
    return exact.unionByName(pairs.mapInPandas(check, out))
