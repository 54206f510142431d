"""One form for texts that look the same but are stored in different characters.

A batch of texts is exploded into one array of code points with the text and position of each, mapped by lookup in
the decomposition and look-alike tables, its combining marks ordered by class, recomposed, and rebuilt into strings.
The exploded form stays columnar inside the Arrow batch: as rows of a DataFrame it would take a hundred times the
input through a shuffle to be put together again.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.session import cut_lineage, once_per_key, spread_out

# Compatibility forms that look like what they decompose to. Raised, lowered, encircled, stacked and
# squared forms do not.
SAME_LOOK_TAGS = frozenset(("<wide>", "<narrow>", "<noBreak>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>"))
# Letters of other alphabets and the Latin ones they are drawn like, script by script, in parallel; then
# marks. Letters that only resemble a Latin one in another size, slant or with a part more are not listed.
SAME_SHAPES = (
    ("АВЕЅІЈКМНОРСТУХҮԌԚԜӀѴ", "ABESIJKMHOPCTYXYGQWIV"),  # Cyrillic capitals
    ("аеѕіјорсухһԁԛԝүӏѵ", "aesijopcyxhdqwylv"),  # Cyrillic small letters
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹ", "ABEZHIKMNOPTYXC"),  # Greek capitals
    ("αγικνορυϲϳ", "ayikvopucj"),  # Greek small letters
    ("ՍՏՕԼ", "USOL"),  # Armenian capitals
    ("օսոհցզյ", "ounhgqj"),  # Armenian small letters
    ("ɑɡɩʋ", "agiu"),  # phonetic letters
    ("ⲀⲂⲤⲎⲒⲔⲘⲚⲞⲢⲦⲨⲬ", "ABCHIKMNOPTYX"),  # Coptic capitals
    ("ⲟⲣⲥ", "opc"),  # Coptic small letters
    ("ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ", "ABCDEGHJKLMPRSTVWZ"),  # Cherokee
    ("ꓮꓐꓚꓓꓰꓝꓖꓧꓲꓙꓗꓡꓟꓠꓳꓑꓣꓢꓔꓴꓦꓪꓫꓬꓜ", "ABCDEFGHIJKLMNOPRSTUVWXYZ"),  # Lisu
    ("‐‑⁃−", "----"),
    ("ʹʼ’‘ʻ′", "''''''"),
    ("“”″", '"""'),
    ("ǃ", "!"),
)
LOOK_ALIKES = {x: y for others, latin in SAME_SHAPES for x, y in zip(others, latin, strict=True)}
DROPPED = -1


def _decomposed(c: str) -> str:
    """c taken apart, through compatibility forms of the same look."""
    d = unicodedata.decomposition(c)
    if not d:
        return c
    parts = d.split()
    if parts[0].startswith("<"):
        if parts[0] not in SAME_LOOK_TAGS:
            return c
        parts = parts[1:]
    s = "".join(chr(int(p, 16)) for p in parts)
    # spacing forms of accents decompose to a blank and a mark, which is not what they look like
    if len(s) > 1 and s[0] == " ":
        return c
    return "".join(_decomposed(x) for x in s)


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, dict[int, list[int]], np.ndarray, np.ndarray, np.ndarray]:
    """(one, many, classes, pair keys, pair values) by rule from the Unicode data.

    one[c] is what a code point becomes: itself, another, DROPPED, or -2 if it becomes several (then in many).
    """
    n = sys.maxunicode + 1
    one = np.arange(n, dtype=np.int32)
    classes = np.zeros(n, np.uint8)
    many: dict[int, list[int]] = {}
    pairs: dict[int, int] = {}
    for c in range(n):
        if 0xD800 <= c < 0xE000 or 0xAC00 <= c < 0xD7A4:
            continue
        ch = chr(c)
        cat = unicodedata.category(ch)
        if cat in ("Cn", "Co"):
            continue
        classes[c] = unicodedata.combining(ch)
        if cat == "Cf" or (cat == "Cc" and ch not in "\t\n\r\x0b\x0c\x85") or 0xFE00 <= c <= 0xFE0F or c in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0):
            one[c] = DROPPED
        elif cat == "Zs" or ch == "\t":
            one[c] = 32
        elif ch in "\r\x0b\x0c\x85" or cat in ("Zl", "Zp"):
            one[c] = 10
        else:
            s = "".join(LOOK_ALIKES.get(x, x) for x in _decomposed(LOOK_ALIKES.get(ch, ch)))
            if len(s) == 1:
                one[c] = ord(s)
            else:
                one[c] = -2
                many[c] = [ord(x) for x in s]
            d = unicodedata.decomposition(ch).split()
            if len(d) == 2 and not d[0].startswith("<") and unicodedata.normalize("NFC", ch) == ch:
                pairs[int(d[0], 16) << 21 | int(d[1], 16)] = c
    keys = np.array(sorted(pairs), np.int64)
    return one, many, classes, keys, np.array([pairs[int(k)] for k in keys], np.int64)


def canonical(texts: list[str]) -> list[str]:
    """The one form of each text; blanks at either end, which no reader sees, are taken off."""
    if not texts:
        return []
    one, many, classes, pair_keys, pair_values = tables()
    joined = "".join(t.replace("\r\n", "\n") for t in texts)
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    of = np.repeat(np.arange(len(texts)), [len(t) - t.count("\r\n") for t in texts])
    new = one[cps].astype(np.int64)
    several = np.flatnonzero(new == -2)
    if len(several):
        count = np.ones(len(cps), np.int64)
        codes, inverse = np.unique(cps[several], return_inverse=True)
        widths = np.array([len(many[int(c)]) for c in codes])
        count[several] = widths[inverse]
        at = np.concatenate([[0], np.cumsum(count)[:-1]])
        of, new = np.repeat(of, count), np.repeat(new, count)
        for k, c in enumerate(codes):
            for j, x in enumerate(many[int(c)]):
                new[at[several[inverse == k]] + j] = x
    kept = new != DROPPED
    new, of = new[kept], of[kept]
    if not len(new):
        return [""] * len(texts)
    # canonical order: marks sorted by class within their run, a run being what follows a starter of the same text
    cls = classes[new]
    if (cls > 0).any():
        starter = (cls == 0) | np.concatenate([[True], of[1:] != of[:-1]])
        run = np.cumsum(starter)
        moved = np.flatnonzero((cls[1:] > 0) & (cls[:-1] > cls[1:]) & (run[1:] == run[:-1]))
        if len(moved):
            order = np.lexsort([np.arange(len(new)), cls, run])
            new, cls = new[order], cls[order]
        new, of = _compose(new, of, cls, pair_keys, pair_values)
    sizes = np.bincount(of, minlength=len(texts))
    text = new.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
    ends = np.cumsum(sizes)
    return [text[e - n : e].strip() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _compose(new: np.ndarray, of: np.ndarray, cls: np.ndarray, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks put back onto their letters: in rounds, each taking the first open mark behind every starter."""
    new, alive = new.copy(), np.ones(len(new), bool)
    blocked = np.zeros(len(new), bool)
    while True:
        live = np.flatnonzero(alive)
        c, t = cls[live], of[live]
        index = np.arange(len(live))
        starter = np.maximum.accumulate(np.where(c == 0, index, -1))
        mark = (c > 0) & (starter >= 0) & ~blocked[live]
        mark &= t == t[np.maximum(starter, 0)]
        first = np.flatnonzero(mark)
        if not len(first):
            break
        first = first[np.unique(starter[first], return_index=True)[1]]
        base = starter[first]
        want = new[live[base]] << 21 | new[live[first]]
        hit = np.searchsorted(keys, want)
        ok = (hit < len(keys)) & (keys[np.minimum(hit, len(keys) - 1)] == want)
        new[live[base[ok]]] = values[hit[ok]]
        alive[live[first[ok]]] = False
        # a mark that can't join keeps later ones of its own class from joining
        stuck = live[first[~ok]]
        blocked[stuck] = True
        for step in range(1, 32):
            nxt = stuck + step
            nxt_ok = nxt < len(new)
            stuck, nxt = stuck[nxt_ok], nxt[nxt_ok]
            same = (cls[nxt] == cls[stuck]) & (of[nxt] == of[stuck])
            stuck, nxt = stuck[same], nxt[same]
            if not len(nxt):
                break
            blocked[nxt] = True
    return new[alive], of[alive]


def canonical_texts(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, canonical, changed: the one form of every text. Null texts stay null, in changed too.

    Null keys give no row; rows of one key count once (if their texts differ, the smallest). Only texts of repeated
    keys are moved.
    """
    base = df.select(*keys, F.col(text).alias("__text"))
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    base = once_per_key(base, keys, "__text")
    schema = T.StructType([*(base.schema[k] for k in keys), T.StructField("canonical", T.StringType()), T.StructField("changed", T.BooleanType())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 512):
                part = b.slice(s, 512)
                t = part.column(part.num_columns - 1).to_pylist()
                done = iter(canonical([x for x in t if x is not None]))
                new = [None if x is None else next(done) for x in t]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keys))), pa.array(new, pa.string()), pa.array([None if x is None else x != y for x, y in zip(t, new, strict=True)], pa.bool_())], names=[f.name for f in schema.fields])

    return base.mapInArrow(fold, schema)


def look_prints(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, look_1, look_2, raw_1, raw_2: 128-bit prints of the one form and of the stored text.

    Null keys and texts, and texts without any visible character, give no row; repeated rows of a key count once (if
    their texts differ, the one with the smallest prints).
    """
    base = spread_out(df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("__text")))
    schema = T.StructType([base.schema["k"], *(T.StructField(c, T.LongType()) for c in ("look_1", "look_2", "raw_1", "raw_2"))])

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 512):
                part = b.slice(s, 512)
                t = part.column(1).to_pylist()
                rows, cols = [], [[], [], [], []]
                for r, (raw, new) in enumerate(zip(t, canonical(t), strict=True)):
                    if new:
                        rows.append(r)
                        for i, v in ((0, new), (2, raw)):
                            h = xxhash.xxh3_128_intdigest(v.encode("utf-8", "surrogatepass"))
                            cols[i].append((h >> 64) - (1 << 63))
                            cols[i + 1].append((h & (1 << 64) - 1) - (1 << 63))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in cols)], names=[f.name for f in schema.fields])

    one = base.mapInArrow(prints, schema).groupBy("k").agg(F.min(F.struct("look_1", "look_2", "raw_1", "raw_2")).alias("p"))
    return one.select(F.col("k").alias(key), "p.*")


PART = 1000  # documents of a look that one task pairs with the rest


def alike_classes(prints: DataFrame, key: str) -> DataFrame:
    """key, class_id, form_id, class_size, forms, links: one row per document with visible text.

    class_id is the smallest key of the documents of one look, form_id that of those equal as stored, forms the number
    of stored forms of the look, and links the number of documents that look the same without being equal as stored.
    A look that a third of all documents share is grouped by its stored forms first.
    """
    looks, raws = ["look_1", "look_2"], ["raw_1", "raw_2"]
    prints = cut_lineage(prints)
    form = prints.groupBy(*looks, *raws).agg(F.min(key).alias("form_id"), F.count("*").alias("form_size"))
    look = form.groupBy(*looks).agg(F.min("form_id").alias("class_id"), F.sum("form_size").alias("class_size"), F.count("*").alias("forms"))
    known = form.join(look, looks).select(*looks, *raws, "class_id", "form_id", "class_size", "forms", (F.col("class_size") - F.col("form_size")).alias("links"))
    return prints.join(known, [*looks, *raws]).select(key, "class_id", "form_id", "class_size", "forms", "links")


def alike_pairs(prints: DataFrame, key: str) -> DataFrame:
    """<key>_a, <key>_b: texts of one look that aren't equal as stored, every such pair once.

    Only looks with several stored forms are joined, and a look of many documents in parts of about PART of them, each
    against all, so that no task holds all pairs of one. Where such a group makes the pairs too many by nature,
    alike_classes says the same in a row per document.
    """
    looks = ["look_1", "look_2"]
    prints = cut_lineage(prints)
    forms = prints.groupBy(*looks, "raw_1", "raw_2").agg(F.count("*").alias("n")).groupBy(*looks).agg(F.count("*").alias("forms"), F.sum("n").alias("size")).where("forms > 1")
    kept = prints.join(forms.select(*looks, F.ceil(F.col("size") / PART).cast("int").alias("parts")), looks)
    kept = kept.select(*looks, "parts", F.struct("raw_1", "raw_2").alias("raw"), F.col(key).alias("k"))
    a = kept.select(*looks, F.pmod(F.xxhash64("k"), F.col("parts")).cast("int").alias("part"), F.col("raw").alias("raw_a"), F.col("k").alias(f"{key}_a"))
    b = kept.select(*looks, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("raw").alias("raw_b"), F.col("k").alias(f"{key}_b"))
    return a.join(b, [*looks, "part"]).where((F.col(f"{key}_a") < F.col(f"{key}_b")) & (F.col("raw_a") != F.col("raw_b"))).select(f"{key}_a", f"{key}_b")
