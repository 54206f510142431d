"""Near-duplicate texts: MinHash banding, candidates by a shuffle on band hashes, verification on full n-gram sets.

Texts that are the same after normalisation form a class that is handled once. Per class the band hashes go
through one shuffle together with a 128-bit sketch; members of a bucket are paired in a sorted stream and pairs
whose sketches are too far apart are dropped on the spot (the bound lies about four standard deviations under
the threshold), so only likely pairs leave the task. Buckets above `bucket_cap` members are compared block
against block, exactly, with never more than two blocks in a task. What remains is verified on the full sets.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe.session import cut_lineage

SEED = 77003
SKETCH_BITS = 128
BUCKET_CAP = 8192
BLOCK = 8192
MAX_EXPAND = 1000
EASY_ROWS = 30_000_000  # texts up to which the rows per band of a field do
BACKGROUND = 10  # unrelated texts agree in one of so many hash functions at most
BROADCAST_IDS = 500_000
LARGEST_NUMBER = 1 << 21  # of a unit in an n-gram
WORDS = re.compile(r"[^\W_]+")
BLANKS = re.compile(r"\s+")


@dataclass(frozen=True)
class Shingles:
    """What two texts of a field are compared by. unit: words or chars; texts with fewer than `least` units take no part."""

    unit: str
    n: int
    least: int
    threshold: float
    rows: int
    recall: float = 0.998

    @property
    def bands(self) -> int:
        """Bands for the target recall of a pair that is just at the threshold."""
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold**self.rows))

    def for_rows(self, n: int) -> Shingles:
        """The banding for n texts: a row more for every BACKGROUND-fold beyond EASY_ROWS, with the bands for the same recall.

        Unrelated texts share a band of r rows with a chance of about BACKGROUND ** -r, so the unrelated pairs each text
        meets stay as few as among EASY_ROWS texts, however large the collection.
        """
        more = max(0, math.ceil(math.log(max(n, 1) / EASY_ROWS, BACKGROUND)))
        return replace(self, rows=self.rows + more)

    @property
    def least_agreeing_bits(self) -> int:
        p = (1 + self.threshold) / 2
        return math.floor(SKETCH_BITS * (p - 4 * math.sqrt(p * (1 - p) / SKETCH_BITS)))

    def units(self, text: str) -> list[str] | str | None:
        if self.unit == "words":
            u = WORDS.findall(text.lower())
        else:
            u = BLANKS.sub(" ", text).strip().lower()
        return u if len(u) >= max(self.least, self.n) else None

    def items(self, units: list[str] | str) -> set:
        if self.unit == "words":
            return {tuple(units[i : i + self.n]) for i in range(len(units) - self.n + 1)}
        return {units[i : i + self.n] for i in range(len(units) - self.n + 1)}

    def similarity(self, u: list[str] | str, v: list[str] | str) -> float:
        """Shared share of the distinct n-grams of two texts, exact."""
        p, q = self.items(u), self.items(v)
        shared = len(p & q)
        return shared / (len(p) + len(q) - shared)


class Verifier:
    """Exact similarity of texts of one field, with the n-gram sets of the latest texts kept.

    An n-gram of up to three units is one number: 21 bits hold a code point, or the number a word has here. Texts with
    too many different words for that, and longer n-grams, are compared as sets.
    """

    def __init__(self, spec: Shingles, room: int = 2_000_000):
        self.spec, self.room = spec, room
        self.number: dict[str, int] = {}
        self.kept: dict[int, np.ndarray] = {}
        self.size = 0

    def _clear_sets(self) -> None:
        self.kept.clear()
        self.size = 0

    def _clear(self) -> None:
        self.number.clear()
        self._clear_sets()

    def _grams(self, key: int, text: str) -> np.ndarray | None:
        """The distinct n-grams of a text, None if it has too many words to number."""
        known = self.kept.get(key)
        if known is not None:
            return known
        n, units = self.spec.n, self.spec.units(text)
        if self.spec.unit == "words":
            if len(units) >= LARGEST_NUMBER:
                return None
            if len(self.number) + len(units) >= LARGEST_NUMBER:
                self._clear()
            number = self.number
            w = np.fromiter((number.setdefault(x, len(number)) for x in units), np.int64, len(units))
        else:
            w = np.frombuffer(units.encode("utf-32-le"), np.uint32).astype(np.int64)
        x = np.zeros(len(w) - n + 1, np.int64)
        for i in range(n):
            x = x << 21 | w[i : len(w) - n + 1 + i]
        grams = np.unique(x)
        if self.size > self.room:
            self._clear_sets()
        self.kept[key] = grams
        self.size += len(grams)
        return grams

    def similarity(self, a: int, text_a: str, b: int, text_b: str) -> float:
        """a, b: what names the texts, here their class."""
        if self.spec.n <= 3:
            p, q = self._grams(a, text_a), self._grams(b, text_b)
            if q is not None and self.spec.unit == "words" and a not in self.kept:  # the numbers began anew in between
                p = self._grams(a, text_a)
                q = self.kept.get(b)
            if p is not None and q is not None:
                shared = len(np.intersect1d(p, q, assume_unique=True))
                return shared / (len(p) + len(q) - shared)
        return self.spec.similarity(self.spec.units(text_a), self.spec.units(text_b))


def class_of(field: str, spec: Shingles, units: list[str] | str) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(field + "\0" + ("\0".join(units) if spec.unit == "words" else units))
    return (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)


class Hasher:
    """MinHash of one field: multiply-add functions modulo 2^32 over mixed hashes of the n-grams."""

    def __init__(self, field: str, spec: Shingles):
        self.field, self.spec = field, spec
        r = np.random.RandomState(SEED + spec.rows)
        k = max(spec.bands * spec.rows, SKETCH_BITS)
        self.a = r.randint(0, 2**32, k, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
        self.b = r.randint(0, 2**32, k, dtype=np.uint64).astype(np.uint32)
        self.mul = r.randint(1, 2**62, spec.rows).astype(np.uint64) | np.uint64(1)
        self.salt = np.array([xxhash.xxh3_64_intdigest(f"{field}:{i}") for i in range(spec.bands)], np.uint64)
        self.known: dict[str, int] = {}

    def ngram_hashes(self, units: list[str] | str) -> np.ndarray:
        if self.spec.unit == "words":
            if len(self.known) > 200_000:
                self.known.clear()
            known = self.known
            ids = list(map(known.get, units))
            if None in ids:
                for w in units:
                    if w not in known:
                        known[w] = xxhash.xxh3_64_intdigest(w)
                ids = list(map(known.get, units))
            u = np.array(ids, np.uint64)
        else:
            u = np.frombuffer(units.encode("utf-32-le"), np.uint32).astype(np.uint64)
        n = self.spec.n
        with np.errstate(over="ignore"):
            x = np.zeros(len(u) - n + 1, np.uint64)
            for i in range(n):
                x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + u[i : len(u) - n + 1 + i]
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
        return x

    def bands(self, units: list[str] | str) -> tuple[np.ndarray, np.ndarray]:
        """Band keys and the sketch (two 64-bit words)."""
        x = self.ngram_hashes(units)
        with np.errstate(over="ignore"):
            x = (x >> np.uint64(32)).astype(np.uint32)
            m = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
            for s in range(0, len(x), 128):  # in pieces, so the matrix stays small; a row per n-gram, so that minima are taken side by side
                h = x[s : s + 128, None] * self.a[None]
                h += self.b[None]
                m = np.minimum(m, h.min(0))
            m = m.astype(np.uint64)
            used = m[: self.spec.bands * self.spec.rows].reshape(self.spec.bands, self.spec.rows)
            keys = ((used + np.uint64(1)) * self.mul).sum(1, dtype=np.uint64) ^ self.salt
            keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            keys ^= keys >> np.uint64(27)
            bit = (m[:SKETCH_BITS] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)
        return keys.view(np.int64), np.packbits(bit.astype(np.uint8)).view(np.int64)


def _texts(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), *(F.col(f).cast("string").alias(f"t{i}") for i, f in enumerate(fields)))


def classes(df: DataFrame, key: str, specs: dict[str, Shingles]) -> DataFrame:
    """field, id, h1, h2, mixed: the class of every text that takes part, one row per field and id.

    If rows of one id differ in text (mixed), the class with the smallest hash stands for the id.
    """
    fields = list(specs)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            for i, f in enumerate(fields):
                rows, h1, h2 = [], [], []
                for r, t in enumerate(b.column(i + 1).to_pylist()):
                    if t and (u := specs[f].units(t)) is not None:
                        h = class_of(f, specs[f], u)
                        rows.append(r)
                        h1.append(h[0])
                        h2.append(h[1])
                yield pa.RecordBatch.from_arrays([pa.array([f] * len(rows), pa.string()), ids.take(pa.array(rows, pa.int64())), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())], names=["field", "id", "h1", "h2"])

    t = _texts(df, key, fields)
    id_type = t.schema["id"].dataType.simpleString()
    raw = t.mapInArrow(emit, f"field string, id {id_type}, h1 long, h2 long")
    h = F.struct("h1", "h2")
    one = raw.groupBy("field", "id").agg(F.min(h).alias("h"), F.max(h).alias("most"))
    return one.select("field", "id", "h.h1", "h.h2", (F.col("h") != F.col("most")).alias("mixed"))


def _band_rows(df: DataFrame, key: str, specs: dict[str, Shingles]) -> DataFrame:
    """key, cls, s0, s1, bits: a row per band of every class; copies met by the same task are emitted once."""
    fields = list(specs)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = {f: Hasher(f, s) for f, s in specs.items()}
        seen: set[int] = set()
        for b in batches:
            for i, f in enumerate(fields):
                spec, keys, cls, sk = specs[f], [], [], []
                for t in b.column(i + 1).to_pylist():
                    if t and (u := spec.units(t)) is not None:
                        c = class_of(f, spec, u)[0]
                        if c in seen:
                            continue
                        seen.add(c)
                        k, s = hashers[f].bands(u)
                        keys.append(k)
                        cls.append(c)
                        sk.append(s)
                if keys:
                    s = np.repeat(np.stack(sk), spec.bands, axis=0)
                    n = len(keys) * spec.bands
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys)), pa.array(np.repeat(np.array(cls, np.int64), spec.bands)), pa.array(np.ascontiguousarray(s[:, 0])), pa.array(np.ascontiguousarray(s[:, 1])), pa.array(np.full(n, spec.least_agreeing_bits, np.int16))],
                        names=["key", "cls", "s0", "s1", "bits"],
                    )

    return _texts(df, key, fields).mapInArrow(emit, "key long, cls long, s0 long, s1 long, bits short")


def _agree(s: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return SKETCH_BITS - np.bitwise_count((s[i] ^ s[j]).view(np.uint64)).sum(1, dtype=np.int64)


def _meet(s: np.ndarray, left: np.ndarray, right: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (x in left, y in right) whose sketches agree in at least `least` bits."""
    xs, ys = [], []
    for p in range(0, len(left), 128):
        rows = left[p : p + 128]
        agree = SKETCH_BITS - np.bitwise_count((s[rows][:, None, :] ^ s[right][None, :, :]).view(np.uint64)).sum(2, dtype=np.int64)
        x, y = np.nonzero(agree >= least)
        xs.append(rows[x])
        ys.append(right[y])
    return (np.concatenate(xs), np.concatenate(ys)) if xs else (np.empty(0, np.int64), np.empty(0, np.int64))


def _pairs_in_runs(rows: DataFrame, cap: int) -> DataFrame:
    """a, b: likely pairs of the runs of equal keys. Members of runs above cap come out with b null and their row."""
    names = ["key", "cls", "s0", "s1", "bits"]
    wide = 32  # runs longer than this are compared as a matrix

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        hot_key = None

        def found(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            none = [pa.nulls(len(a), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int16())]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), *none], names=["a", "b", "key", "s0", "s1", "bits"])

        def crowded(c: list[np.ndarray]) -> pa.RecordBatch:
            key, cls, s0, s1, bits = c
            return pa.RecordBatch.from_arrays([pa.array(cls), pa.nulls(len(cls), pa.int64()), pa.array(key), pa.array(s0), pa.array(s1), pa.array(bits)], names=["a", "b", "key", "s0", "s1", "bits"])

        def work(c: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            keep = np.ones(len(c[0]), bool)
            keep[1:] = (c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1])
            key, cls, s0, s1, bits = c = [x[keep] for x in c]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(key)]]))
            size, s = np.repeat(sizes, sizes), np.stack([s0, s1], 1)
            if (hot := size > cap).any():
                yield crowded([x[hot] for x in c])
            for at, n in zip(starts[(sizes > wide) & (sizes <= cap)], sizes[(sizes > wide) & (sizes <= cap)], strict=True):
                x, y = _meet(s, np.arange(at, at + n), np.arange(at, at + n), int(bits[at]))
                if (ok := x < y).any():
                    yield found(cls[x[ok]], cls[y[ok]])
            use = np.flatnonzero((size > 1) & (size <= min(wide, cap)))
            for lag in range(1, wide):
                use = use[size[use] > lag]
                if not len(use):
                    break
                i = use[(use + lag < len(key))]
                i = i[key[i] == key[i + lag]]
                i = i[_agree(s, i, i + lag) >= bits[i]]
                if len(i):
                    yield found(cls[i], cls[i + lag])

        for b in batches:
            cur = [np.asarray(b.column(b.schema.get_field_index(n))) for n in names]
            if held is not None:
                cur = [np.concatenate([h, c]) for h, c in zip(held, cur, strict=True)]
                held = None
            if hot_key is not None:  # a crowded run goes on: pass its members through
                if (m := cur[0] == hot_key).any():
                    yield crowded([c[m] for c in cur])
                    cur = [c[~m] for c in cur]
                if len(cur[0]):
                    hot_key = None
            if not len(cur[0]):
                continue
            last = int(np.searchsorted(cur[0], cur[0][-1]))
            if last:
                yield from work([c[:last] for c in cur])
            held = [c[last:] for c in cur]
            first = np.concatenate([[True], held[1][1:] != held[1][:-1]])
            held = [h[first] for h in held]
            if len(held[0]) > cap:
                yield crowded(held)
                hot_key, held = held[0][0], None
        if held is not None and len(held[0]):
            yield from work(held)

    # one exchange on the key, sorted so that a run is met as it streams by
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = "a long, b long, key long, s0 long, s1 long, bits short"
    return rows.repartition(n, "key").sortWithinPartitions("key", "cls").mapInArrow(pairs, out)


def _pairs_in_blocks(crowded: DataFrame, block: int) -> DataFrame:
    """a, b: likely pairs of crowded buckets; every two members meet in the task of their two blocks."""
    sizes = crowded.groupBy("key").agg(F.count("*").alias("n"))
    placed = (
        crowded.join(sizes, "key")
        .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
        .withColumn("blk", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "cls", "s0", "s1", "bits")
    )

    def meet(t: pa.Table) -> pa.Table:
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        blk, cls = np.asarray(t.column("blk")), np.asarray(t.column("cls"))
        s = np.stack([np.asarray(t.column("s0")), np.asarray(t.column("s1"))], 1)
        x, y = _meet(s, np.flatnonzero(blk == i), np.flatnonzero(blk == j), t.column("bits")[0].as_py())
        a, b = cls[x], cls[y]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        ok = lo < hi
        return pa.table([pa.array(lo[ok]), pa.array(hi[ok])], names=["a", "b"])

    return placed.groupBy("key", "i", "j").applyInArrow(meet, "a long, b long")


def candidates(df: DataFrame, key: str, specs: dict[str, Shingles], bucket_cap: int = BUCKET_CAP, block: int = BLOCK) -> DataFrame:
    """a, b: pairs of class hashes that share a band and have close sketches, each once, written to the checkpoint folder."""
    met = cut_lineage(_pairs_in_runs(_band_rows(df, key, specs), bucket_cap))
    pairs, crowded = met.where("b is not null").select("a", "b"), met.where("b is null")
    if not crowded.isEmpty():
        crowded = crowded.select("key", F.col("a").alias("cls"), "s0", "s1", "bits").distinct()
        pairs = pairs.unionByName(_pairs_in_blocks(crowded, block))
    return pairs.distinct()


def links(df: DataFrame, key: str, specs: dict[str, Shingles], members: DataFrame, **caps: int) -> DataFrame:
    """field, rep_a, rep_b, similarity: verified links between classes, by their smallest ids."""
    pairs = candidates(df, key, specs, **caps)
    reps = members.groupBy("field", "h1", "h2").agg(F.min("id").alias("rep"))
    sides = pairs
    for s in ("a", "b"):
        side = reps.select(F.col("h1").alias(s), F.col("field").alias(f"field_{s}"), F.col("rep").alias(f"rep_{s}"))
        sides = sides.join(side, s)
    sides = cut_lineage(sides.where("field_a = field_b").select(F.col("field_a").alias("field"), "a", "b", "rep_a", "rep_b"))
    wanted = sides.select(F.col("rep_a").alias("id")).union(sides.select(F.col("rep_b").alias("id"))).distinct()
    fields = list(specs)
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    id_type = members.schema["id"].dataType.simpleString()

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The texts of an id with the class of each, so that the text compared is the one the class was taken from."""
        for b in batches:
            for i, f in enumerate(fields):
                rows, h, texts = [], [], []
                for r, t in enumerate(b.column(i + 1).to_pylist()):
                    if t and (u := specs[f].units(t)) is not None:
                        rows.append(r)
                        h.append(class_of(f, specs[f], u)[0])
                        texts.append(t)
                yield pa.RecordBatch.from_arrays([pa.array([f] * len(rows), pa.string()), b.column(0).take(pa.array(rows, pa.int64())), pa.array(h, pa.int64()), pa.array(texts, pa.string())], names=["field", "id", "cls", "text"])

    texts = _texts(df, key, fields).join(wanted, "id", "left_semi")
    if members.where("mixed").isEmpty():  # all rows of an id have texts of one class: no need to look
        texts = texts.groupBy("id").agg(*(F.min(f"t{i}").alias(f"t{i}") for i in range(len(fields))))
        texts = texts.select("id", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"t{i}").alias("text")) for i, f in enumerate(fields)))).alias("x")).select("id", "x.field", "x.text").where("text is not null")
        on = {"a": ["field", "rep_a"], "b": ["field", "rep_b"]}
    else:
        texts = texts.mapInArrow(classed, f"field string, id {id_type}, cls long, text string").groupBy("field", "id", "cls").agg(F.min("text").alias("text"))
        on = {"a": ["field", "rep_a", "a"], "b": ["field", "rep_b", "b"]}
    both = sides
    for s in "ab":
        both = both.join(texts.withColumnsRenamed({"id": f"rep_{s}", "cls": s, "text": f"text_{s}"}), on[s])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verifiers = {f: Verifier(s) for f, s in specs.items()}
        for batch in batches:
            sims, rows = [], []
            for r, (f, a, b, x, y) in enumerate(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("field", "a", "b", "text_a", "text_b")), strict=True)):
                spec = specs[f]
                s = verifiers[f].similarity(a, x, b, y)
                if s >= spec.threshold:
                    rows.append(r)
                    sims.append(s)
            f, x, y = (batch.column(batch.schema.get_field_index(c)).take(pa.array(rows, pa.int64())) for c in ("field", "rep_a", "rep_b"))
            swap = pc.greater(x, y)
            yield pa.RecordBatch.from_arrays([f, pc.if_else(swap, y, x), pc.if_else(swap, x, y), pa.array(sims, pa.float64())], names=["field", "rep_a", "rep_b", "similarity"])

    return both.select("field", "rep_a", "rep_b", "a", "b", "text_a", "text_b").mapInArrow(verify, f"field string, rep_a {id_type}, rep_b {id_type}, similarity double")


def class_members(cls: DataFrame) -> DataFrame:
    """field, id, rep, copies: the smallest id and the size of the class of every id."""
    reps = cls.groupBy("field", "h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    return cls.join(reps, ["field", "h1", "h2"]).select("field", "id", "rep", "copies")


def near_duplicates(df: DataFrame, key: str, specs: dict[str, Shingles], **caps: int) -> tuple[DataFrame, DataFrame]:
    """(members, links): field, id, rep, copies of every text that takes part, and the links between representatives.

    members names the class of copies (same units in the same order) of every id by its smallest id; links are the
    pairs of different classes at or above the threshold, once each. Null ids and texts, and texts below the
    field's least size, take no part; repeated rows of an id count once; an empty table gives two empty results.
    """
    cls = cut_lineage(classes(df, key, specs))
    sizes = {r["field"]: r["n"] for r in cls.groupBy("field").agg(F.count("*").alias("n")).collect()}  # a row per field
    specs = {f: s.for_rows(sizes.get(f, 0)) for f, s in specs.items()}
    return class_members(cls), links(df, key, specs, cls, **caps)


def all_pairs(members: DataFrame, found: DataFrame, max_expand: int | None = None) -> DataFrame:
    """field, a, b: links spelled out for the copies of their classes, and the pairs of copies.

    Large classes are spelled out in parts of about MAX_EXPAND members, so that no task holds all pairs of one.
    With max_expand, a class of more copies stands for itself by its representative (its copies are in `members`,
    and are paired with the representative).
    """
    cut = cut_lineage(found.select("field", "rep_a", "rep_b"))
    whole = F.lit(True) if max_expand is None else F.col("copies") <= max_expand
    parts = F.ceil(F.col("copies") / MAX_EXPAND).cast("int")
    shown = members.where(whole | (F.col("id") == F.col("rep"))).select("field", "id", "rep", parts.alias("parts"), F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"))
    between = cut
    for rep in ("rep_a", "rep_b"):
        size = shown.where("id = rep").select("field", F.col("rep").alias(rep), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias(f"part_{rep}"))
        between = between.join(size, ["field", rep])
    for rep, to in (("rep_a", "x"), ("rep_b", "y")):
        between = between.join(shown.select("field", F.col("rep").alias(rep), F.col("part").alias(f"part_{rep}"), F.col("id").alias(to)), ["field", rep, f"part_{rep}"])
    copies = members.where("copies > 1")
    small = copies.where(whole).select("field", "id", "rep", parts.alias("parts"), F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"))
    every = small.select("field", "rep", F.col("id").alias("y"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    within = small.select("field", "rep", "part", F.col("id").alias("x")).join(every, ["field", "rep", "part"]).where("x < y")
    out = between.select("field", "x", "y").unionByName(within.select("field", "x", "y"))
    if max_expand is not None:
        large = copies.where(~whole & (F.col("id") != F.col("rep")))
        out = out.unionByName(large.select("field", F.col("rep").alias("x"), F.col("id").alias("y")))
    return out.select("field", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def groups(members: DataFrame, found: DataFrame) -> DataFrame:
    """field, id, group_id, links: connected groups over the links, by smallest-label propagation with shortcuts.

    group_id is the smallest id of the group, links the number of other classes a text's class is linked to. All
    labels stay in tables; every round is written to the checkpoint folder.
    """
    edges = cut_lineage(found.select("field", F.col("rep_a").alias("u"), F.col("rep_b").alias("v")).unionByName(found.select("field", F.col("rep_b").alias("u"), F.col("rep_a").alias("v"))).distinct())
    labels = edges.select("field", "u").distinct().withColumn("label", F.col("u"))
    while True:
        near = edges.join(labels.withColumnRenamed("u", "v"), ["field", "v"]).groupBy("field", "u").agg(F.min("label").alias("near"))
        lower = labels.join(near, ["field", "u"]).select("field", "u", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = lower.select("field", F.col("u").alias("label"), F.col("label").alias("next"))
        new = cut_lineage(lower.join(jump, ["field", "label"], "left").select("field", "u", "old", F.coalesce("next", "label").alias("label")))
        labels = new.select("field", "u", "label")
        if new.where("label <> old").isEmpty():
            break
    degree = edges.groupBy("field", "u").agg(F.count("*").alias("links"))
    known = labels.join(degree, ["field", "u"]).withColumnRenamed("u", "rep")
    return members.join(known, ["field", "rep"], "left").select("field", "id", F.coalesce("label", "rep").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
