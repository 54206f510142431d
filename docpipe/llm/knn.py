"""Most similar vectors for every vector: multiprobe p-stable hashing with exact reranking.

Every distinct vector is put into its home slot and into the `probes` perturbed slots most likely to hold its
neighbours (ordered by the squared distance to the slot borders, as query-directed probing does) of each of
`tables` Gaussian (2-stable) hash tables; tables and probes grow with the projections, so that recall stays level.
Vectors that share a slot of a table are compared exactly inside the
slot, and the candidates of all slots are merged per vector. Only whole slots are shipped, so no candidate pair
is ever shuffled.

Slots above `slot_cap` rows are compared block against block: exact like the others, and never more than two
blocks in a task. Vectors that met fewer than k others are compared with all vectors.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.session import cut_lineage

WIDTH = 2.0  # slot width, in units of the (unit-length) vectors' projections
TABLES = 2
SLOT_CAP = 32768
BLOCK = 4096
SEED = 20240917


def projections_for(rows: int) -> int:
    """Projections per table: slots shrink as the collection grows, so work grows clearly slower than rows squared."""
    return int(min(16, max(1, round(8 + 0.75 * math.log2(max(rows, 1) / 180_000)))))


def tables_for(projections: int) -> int:
    return TABLES if projections <= 8 else TABLES + 1 if projections <= 13 else TABLES + 2


def probes_for(projections: int) -> int:
    """With tables_for, a recall of 0.977 to 0.996 of the 5 nearest for 5 to 16 projections on the chunk vectors of sf0.1."""
    return {8: 3, 14: 5, 15: 6, 16: 8}.get(projections, max(2, projections - 7))


def _gaussians(dim: int, m: int, tables: int, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Orthogonalised Gaussian directions, offsets and key multipliers, the same in every task."""
    r = np.random.RandomState((SEED + 7919 * salt + 104729 * dim) % 2**32)
    g = np.empty((tables, dim, m), np.float32)
    for t in range(tables):
        # columns of a random rotation scaled to the length of a Gaussian vector; blocks of dim columns at a time
        cols = []
        while sum(c.shape[1] for c in cols) < m:
            cols.append(np.linalg.qr(r.randn(dim, dim))[0] * math.sqrt(dim))
        g[t] = np.concatenate(cols, axis=1)[:, :m]
    return g, r.rand(tables, m), r.randint(1, 2**62, size=(tables, m + 1), dtype=np.int64) | 1


def slot_keys(x: np.ndarray, m: int, tables: int, probes: int, width: float, salt: int = 0) -> np.ndarray:
    """(rows, tables * (probes + 1)) slot keys of the rows of x, home slots first in each table."""
    dim = x.shape[1]
    g, off, mul = _gaussians(dim, m, tables, salt)
    near = min(4 if probes <= 6 else 6, 2 * m)
    sets = [c for k in (1, 2, 3) for c in itertools.combinations(range(near), k)]
    out = []
    with np.errstate(over="ignore"):
        for t in range(tables):
            p = (x @ g[t]).astype(np.float64) / width + off[t]
            h = np.floor(p)
            f = p - h
            cost = np.concatenate([f**2, (1 - f) ** 2], axis=1)  # one slot down, one slot up
            order = np.argsort(cost, axis=1)[:, :near]
            single = np.take_along_axis(cost, order, 1)
            dims = order % m
            score = np.stack([single[:, list(c)].sum(1) for c in sets], 1)
            for k, c in enumerate(sets):
                for a, b in itertools.combinations(c, 2):
                    score[dims[:, a] == dims[:, b], k] = np.inf
            base = (h.astype(np.int64) * mul[t, :m]).sum(1) + mul[t, m] * (t + 1)
            delta = np.where(order < m, -1, 1) * mul[t, :m][dims]
            change = np.stack([delta[:, list(c)].sum(1) for c in sets], 1)
            best = np.argsort(score, axis=1)[:, :probes]
            keys = base[:, None] + np.take_along_axis(change, best, 1)
            unusable = ~np.isfinite(np.take_along_axis(score, best, 1))
            keys[unusable] = np.broadcast_to(base[:, None], keys.shape)[unusable]
            out.append(np.concatenate([base[:, None], keys], axis=1))
    return np.concatenate(out, axis=1)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit mix of two key columns."""
    with np.errstate(over="ignore"):
        z = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (z ^ (z >> np.uint64(31))).view(np.int64)


def _matrix(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """float32 rows of a binary column whose values all have 4 * dim bytes."""
    parts = []
    for a in col.chunks if isinstance(col, pa.ChunkedArray) else [col]:
        if len(a):
            off = np.frombuffer(a.buffers()[1], np.int32, len(a) + 1, a.offset * 4)
            parts.append(np.frombuffer(a.buffers()[2], np.uint8)[off[0] : off[-1]].view(np.float32).reshape(-1, dim))
    return np.concatenate(parts) if parts else np.empty((0, dim), np.float32)


def _unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def pack_vectors(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """keys, v (the vector's float32 bytes), dim. Null, empty, non-finite and all-zero vectors are left out."""
    kept = df.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).select(*keys, F.col(vector).cast("array<float>").alias("v"))
    schema = T.StructType([*(kept.schema[k] for k in keys), T.StructField("v", T.BinaryType()), T.StructField("dim", T.IntegerType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(b.schema.get_field_index("v"))
            flat = v.flatten()
            lens = np.diff(np.asarray(v.offsets)).astype(np.int64)
            vals = np.asarray(flat.fill_null(float("nan")), np.float32)
            starts = np.concatenate([[0], np.cumsum(lens)[:-1]]) if len(lens) else np.empty(0, np.int64)
            with np.errstate(over="ignore", invalid="ignore"):
                norm = np.add.reduceat(vals.astype(np.float64) ** 2, starts) if len(vals) else np.zeros(len(lens))
            ok = np.isfinite(norm) & (norm > 0)
            data = vals.tobytes()
            off = np.concatenate([starts * 4, [len(data)]]).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(off), pa.py_buffer(data)])
            cols = [b.column(b.schema.get_field_index(k)) for k in keys] + [packed, pa.array(lens.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=[*keys, "v", "dim"]).filter(pa.array(ok))

    return kept.mapInArrow(pack, schema)


def _assign(packed: DataFrame, keys: list[str], m: int, tables: int, probes: int, width: float, with_vector: bool) -> DataFrame:
    """One row per slot a vector is put into: slot, and with_vector its key and bytes."""
    fields = [T.StructField("slot", T.LongType())]
    if with_vector:
        fields += [*(packed.schema[k] for k in keys), T.StructField("v", T.BinaryType()), T.StructField("dim", T.IntegerType())]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                b = whole.slice(start, 4096)
                dims = np.asarray(b.column(b.schema.get_field_index("dim")))
                for dim in np.unique(dims):
                    part = b if (dims == dim).all() else b.filter(pa.array(dims == dim))
                    k = slot_keys(_unit(_matrix(part.column(part.schema.get_field_index("v")), int(dim))), m, tables, probes, width)
                    k = _mix(k, np.full(k.shape, int(dim), np.int64))
                    if not with_vector:
                        yield pa.RecordBatch.from_arrays([pa.array(k.ravel())], names=["slot"])
                        continue
                    idx = pa.array(np.repeat(np.arange(part.num_rows), k.shape[1]))
                    cols = [part.column(part.schema.get_field_index(n)).take(idx) for n in [*keys, "v", "dim"]]
                    yield pa.RecordBatch.from_arrays([pa.array(k.ravel()), *cols], names=["slot", *keys, "v", "dim"])

    return packed.select("v", "dim", *(keys if with_vector else [])).mapInArrow(assign, T.StructType(fields))


def _nearest(x: np.ndarray, unit64: np.ndarray, others: np.ndarray, k: int, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions in `others` and exact cosines of the k nearest to each row of x; own: each row's own position or None."""
    n = others.shape[0]
    take = min(k + 2, n)
    pos = np.empty((x.shape[0], take), np.int64)
    for s in range(0, x.shape[0], 256):
        sim = x[s : s + 256] @ others.T
        if own is not None:
            sim[np.arange(sim.shape[0]), own[s : s + 256]] = -4
        pos[s : s + 256] = np.argpartition(-sim, take - 1, axis=1)[:, :take] if take < n else np.broadcast_to(np.arange(n), sim.shape)
    cos = np.einsum("rd,rkd->rk", x.astype(np.float64), unit64[pos])
    if own is not None:
        cos[pos == own[:, None]] = -4
    return pos, cos


def _rows_of(keys: list[str], tbl: pa.Table, pos: np.ndarray, cos: np.ndarray, whose: np.ndarray, others: pa.Table, k: int) -> pa.Table:
    """Per row of `whose`: its keys and the k best as parallel lists, by cosine and then by key."""
    rank_key = np.lexsort([np.asarray(others.column(c)) for c in reversed(keys)])
    rank = np.empty(len(rank_key), np.int64)
    rank[rank_key] = np.arange(len(rank_key))
    order = np.lexsort([rank[pos], -cos], axis=1)[:, :k]
    pos, cos = np.take_along_axis(pos, order, 1), np.take_along_axis(cos, order, 1)
    ok = cos > -3
    off = pa.array(np.concatenate([[0], np.cumsum(ok.sum(1))]).astype(np.int32))
    flat = pa.array(pos[ok])
    cols = [tbl.column(c).combine_chunks().take(pa.array(whose)) for c in keys]
    lists = [pa.ListArray.from_arrays(off, others.column(c).combine_chunks().take(flat)) for c in keys]
    lists.append(pa.ListArray.from_arrays(off, pa.array(cos[ok].astype(np.float32))))
    return pa.table([*cols, *lists], names=[*keys, *(f"n_{c}" for c in keys), "n_cos"])


def _distinct_rows(keys: list[str], t: pa.Table) -> pa.Table:
    cols = [np.asarray(t.column(c)) for c in keys]
    order = np.lexsort(cols[::-1])
    same = np.ones(max(0, len(order) - 1), bool)
    for c in cols:
        same &= c[order][1:] == c[order][:-1]
    return t if not same.any() else t.take(pa.array(np.sort(order[np.concatenate([[True], ~same])])))


def _compare_slots(assigned: DataFrame, keys: list[str], k: int, cand: T.StructType) -> DataFrame:
    def compare(t: pa.Table) -> pa.Table:
        t = _distinct_rows(keys, t)
        if t.num_rows < 2:
            return _rows_of(keys, t, np.zeros((t.num_rows, 1), int), np.full((t.num_rows, 1), -4.0), np.arange(t.num_rows), t, k)  # met no other
        x = _unit(_matrix(t.column("v"), t.column("dim")[0].as_py()))
        pos, cos = _nearest(x, x.astype(np.float64), x, k, np.arange(len(x)))
        return _rows_of(keys, t, pos, cos, np.arange(len(x)), t, k)

    return assigned.groupBy("slot").applyInArrow(compare, cand)


def _compare_blocks(left: DataFrame, keys: list[str], k: int, cand: T.StructType, block: int) -> DataFrame:
    """Exact comparison of crowded slots: numbered blocks of rows, one task per pair of blocks."""
    sizes = left.groupBy("slot").agg(F.count("*").alias("n"))
    numbered = left.join(sizes, "slot").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    numbered = numbered.withColumn("blk", F.pmod(F.xxhash64(*keys), F.col("blocks")).cast("int"))
    # each row goes to the pairs (blk, j) and (i, blk): `blocks` of them, so a task sees two blocks only
    spread = numbered.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select("slot", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", *keys, "v", "dim")

    def compare(t: pa.Table) -> pa.Table:
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        blk = np.asarray(t.column("blk"))
        parts = []
        dim = t.column("dim")[0].as_py()
        if i == j:
            a = _distinct_rows(keys, t)
            if a.num_rows > 1:
                x = _unit(_matrix(a.column("v"), dim))
                parts.append(_rows_of(keys, a, *_nearest(x, x.astype(np.float64), x, k, np.arange(len(x))), np.arange(len(x)), a, k))
        else:
            a, b = _distinct_rows(keys, t.filter(pa.array(blk == i))), _distinct_rows(keys, t.filter(pa.array(blk == j)))
            if a.num_rows and b.num_rows:
                x, y = _unit(_matrix(a.column("v"), dim)), _unit(_matrix(b.column("v"), dim))
                parts.append(_rows_of(keys, a, *_nearest(x, y.astype(np.float64), y, k, None), np.arange(len(x)), b, k))
                parts.append(_rows_of(keys, b, *_nearest(y, x.astype(np.float64), x, k, None), np.arange(len(y)), a, k))
        if not parts:
            return _rows_of(keys, t.slice(0, 0), np.empty((0, 1), int), np.empty((0, 1)), np.empty(0, int), t.slice(0, 0), k)
        return pa.concat_tables(parts)

    return spread.groupBy("slot", "i", "j").applyInArrow(compare, cand)


def _compare_with_all(few: DataFrame, every: DataFrame, keys: list[str], k: int, cand: T.StructType, block: int) -> DataFrame:
    """Exact nearest of the rows of `few` among `every`, one task per pair of blocks."""
    n_few, n_every = max(1, math.ceil(few.count() / block)), max(1, math.ceil(every.count() / block))

    def placed(df: DataFrame, own: str, n_own: int, other: str, n_other: int, asks: bool) -> DataFrame:
        df = df.withColumn(own, F.pmod(F.xxhash64(*keys), F.lit(n_own)).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))).select("dim", "i", "j", F.lit(asks).alias("asks"), *keys, "v")

    both = placed(few, "i", n_few, "j", n_every, True).unionByName(placed(every, "j", n_every, "i", n_few, False))

    def compare(t: pa.Table) -> pa.Table:
        asks = np.asarray(t.column("asks"))
        a, b = _distinct_rows(keys, t.filter(pa.array(asks))), _distinct_rows(keys, t.filter(pa.array(~asks)))
        if not a.num_rows or not b.num_rows:
            return _rows_of(keys, t.slice(0, 0), np.empty((0, 1), int), np.empty((0, 1)), np.empty(0, int), t.slice(0, 0), k)
        dim = t.column("dim")[0].as_py()
        y = _unit(_matrix(b.column("v"), dim))
        pos, cos = _nearest(_unit(_matrix(a.column("v"), dim)), y.astype(np.float64), y, k, None)
        itself = np.ones(pos.shape, bool)
        for c in keys:
            itself &= np.asarray(b.column(c))[pos] == np.asarray(a.column(c))[:, None]
        cos[itself] = -4
        return _rows_of(keys, a, pos, cos, np.arange(a.num_rows), b, k)

    return both.groupBy("dim", "i", "j").applyInArrow(compare, cand)


def distinct_vectors(packed: DataFrame, keys: list[str]) -> DataFrame:
    """Groups of exact copies collapse to the row with the smallest key (combined before the shuffle)."""
    rep = packed.groupBy("v", "dim").agg(F.min(F.struct(*keys)).alias("rep"))
    return rep.select(*(F.col(f"rep.{c}").alias(c) for c in keys), "v", "dim")


def nearest_vectors(
    df: DataFrame, keys: list[str], vector: str, k: int = 5, *, tables: int | None = None, width: float = WIDTH,
    slot_cap: int = SLOT_CAP, levels: int | None = None, block: int = BLOCK,
) -> DataFrame:
    """For every distinct vector the k most similar other ones by cosine, within the index's accuracy loss.

    Returns keys, rank (1..k), n_<key> of the neighbour, cosine (float). keys must be of numeric types without nulls.
    Null, empty, non-finite and all-zero vectors take no part; vectors of different lengths are never compared; exact
    copies of a vector count once, under their smallest key; ties of the cosine go to the smaller key; an empty
    table, and a vector without any other of its length, give no rows. Extra columns are ignored. levels has no effect.
    """
    packed = pack_vectors(df, keys, vector)
    m = projections_for(df.count())
    tables, probes = tables or tables_for(m), probes_for(m)
    cand = T.StructType(
        [*(T.StructField(c, packed.schema[c].dataType) for c in keys), *(T.StructField(f"n_{c}", T.ArrayType(packed.schema[c].dataType)) for c in keys), T.StructField("n_cos", T.ArrayType(T.FloatType()))]
    )
    crowded = _assign(packed, keys, m, tables, probes, width, False).groupBy("slot").count().where(F.col("count") > slot_cap).select("slot")
    assigned = _assign(distinct_vectors(packed, keys), keys, m, tables, probes, width, True)
    if crowded.isEmpty():
        found = _compare_slots(assigned, keys, k, cand)
    else:
        found = _compare_slots(assigned.join(crowded, "slot", "left_anti"), keys, k, cand)
        hot = assigned.join(crowded, "slot", "left_semi")
        found = found.unionByName(_compare_blocks(hot, keys, k, cand, block))
    pairs = F.arrays_zip(F.transform("n_cos", lambda c: -c).alias("neg"), *(F.col(f"n_{c}") for c in keys))

    def merge(found: DataFrame) -> DataFrame:
        merged = found.select(*keys, pairs.alias("c")).groupBy(*keys).agg(F.flatten(F.collect_list("c")).alias("c"))
        return merged.select(*keys, F.slice(F.array_sort(F.array_distinct("c")), 1, k).alias("c"))

    merged = cut_lineage(merge(found))
    short = merged.where(F.size("c") < k).select(*keys, F.size("c").alias("met"))
    if not short.isEmpty():
        every = distinct_vectors(packed, keys)
        others = every.groupBy("dim").agg((F.count("*") - 1).alias("others"))  # a row per length
        few = cut_lineage(every.join(short, keys).join(others, "dim").where("met < others").select(*keys, "v", "dim"))
        if not few.isEmpty():
            asked = merge(_compare_with_all(few, every, keys, k, cand, block))
            merged = merged.join(few.select(*keys), keys, "left_anti").unionByName(asked)
    best = merged.select(*keys, F.posexplode("c").alias("rank", "n"))
    return best.select(*keys, (F.col("rank") + 1).alias("rank"), *(F.col(f"n.n_{c}").alias(f"n_{c}") for c in keys), (-F.col("n.neg")).alias("cosine"))


def similar_pairs(neighbours: DataFrame, keys: list[str]) -> DataFrame:
    """The unordered pairs among `neighbours`: <key>_a, <key>_b, each once, the smaller key first."""
    a, b = F.struct(*keys), F.struct(*(F.col(f"n_{c}").alias(c) for c in keys))
    two = neighbours.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    return two.select(*(F.col(f"a.{c}").alias(f"{c}_a") for c in keys), *(F.col(f"b.{c}").alias(f"{c}_b") for c in keys))


def vector_copies(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Membership of the groups of exact copies: keys, rep_<key>; rows without a usable vector are left out."""
    packed = pack_vectors(df, keys, vector).dropDuplicates(keys)
    rep = packed.groupBy("v", "dim").agg(F.min(F.struct(*keys)).alias("rep"))
    return packed.join(rep, ["v", "dim"]).select(*keys, *(F.col(f"rep.{c}").alias(f"rep_{c}") for c in keys))
