"""Template residue, filler, error pages and script notices: a linear classifier over short windows of a text.

Every text is scored in overlapping windows of 32 characters by a regularised logistic regression on hashed n-grams
(of folded characters, and of the shape of the text), length and title features. It is fitted on windows of a bounded
sample, labelled weakly by phrases and by the outcome logged for the record, fitted again with the clean windows it
took for residue, and validated on hosts it has not seen. A text is taken if a window scores at or above the bound;
the phrases have no part in that.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe.session import cut_lineage, spread_out

BITS = 18
BLOCK = 16  # two neighbouring blocks make a window
SAMPLE_ROWS = 40_000  # rows, by hash order of the key, that are searched for the phrases of the weak labels
SAMPLE_CLEAN = 6_000  # of these, rows of which windows without residue are learned too
WINDOWS_PER_TEXT = 2  # most windows of a sort learned from a text, evenly spread over it
HARD_PER_TEXT = 2  # most clean windows of a text that the first fit took for residue and the second learns
HARD_SCORE = -1.0
BOUND = 1.0
TITLE_BOUND = 0.25  # a title is a window or two, so fewer of them come near the bound by chance
FIRST_STEPS, STEPS = 30, 60
RIDGE = 2e-4
LEAST_COUNT = 4  # n-grams met less often in training have no weight
FOLDS = 5
ORDERS = (4, 7)  # n-grams of characters
SHAPES = (3, 5)  # n-grams of shapes

# Fixed values, the weak labels: what templates, fillers, failing sites and script-less pages leave behind.
_FIELD = r"(?:n[uú]mero|fecha|nombre|t[ií]tulo|comuna|regi[oó]n|cargo|monto|materia|anexo|vigencia|inciso|firma|autoridad|plazo|organismo|ley|norma|domicilio|rut|art[ií]culo|texto|ministerio|variable|campo)"
MARKS = (
    r"\{\{[^{}\n]{1,60}\}\}", r"\{%[^%\n]{1,60}%\}", r"<%=?[^%\n]{1,60}%>", r"\$\{[^{}\n]{1,60}\}", r"\[\[[^\[\]\n]{1,60}\]\]",
    r"@@\w{2,40}@@", rf"#{_FIELD}(?:[_ ]\w+)*#", r"%[A-Z]{3,20}(?:_[A-Z]+)*%", r"__[A-Z]+(?:_[A-Z]+)*__", rf"<<\s*{_FIELD}(?:[_ ]\w+)*\s*>>",
    rf"«\s*{_FIELD}(?:[_ ]\w+)*\s*»", rf"\[{_FIELD}(?:[_ ](?!\d)\w+)*\]", r"\[(?:insertar|completar|indicar|escribir|ingresar|agregar)\b[^\]\n]{0,60}\]", r"(?<!\{)\{(?:\d{1,2}|[a-z_]{3,30})\}(?!\})",
)
GAPS = (
    r"(?<![_\w])_{4,24}(?![_\w])", r"_{2,}/_{2,}", r"\b\d{2}__", r"\.{7,}\s*\(\.{5,}\)", r"\(\.{5,}\)", r"\[\.{2,}\]", r"\bXX de X{3,}\b", r"\bX{3,}/\d{2}XX\b", r"\bdd/mm/a{2,4}\b", r"\bdon\(ña\)\s*[_.]{3,}",
)
_LATIN = "lorem ipsum dolor amet consectetur adipiscing elit tempor magna aliqua massa nunc viverra cursus turpis felis pulvinar rutrum blandit luctus congue ornare lacus egestas semper sapien tellus fugit mauris minim integer vestra arbor quaeris porta ultra nullam erat velit"
_LATIN_WORD = "(?:" + "|".join(_LATIN.split()) + ")"
_KEYS = r"(?:qwerty|asdf|zxcv|jkl|xxx|zzz|aaaa|test|prueba|\d{3,6})"
FILLER = (
    rf"\b{_LATIN_WORD}(?:[ ,.;]+{_LATIN_WORD}){{3,}}", r"\blorem ipsum\b", rf"\b(?:qwerty|asdf|zxcv|jkl|xxx|zzz|aaaa)\s+{_KEYS}\b", rf"\b{_KEYS}\s+(?:qwerty|asdf|zxcv|jkl|xxx|zzz|aaaa)\b",
    r"\baqu[ií] va el texto\b", r"\bcontenido de ejemplo\b", r"\(contenido por definir\)", r"\bborrador: completar\b", r"\btexto pendiente de redacci[oó]n\b", r"\bsample text,? do not publish\b",
    r"\breemplace este p[aá]rrafo\b", r"\bescriba aqu[ií] el cuerpo\b", r"^\s*t[ií]tulo pendiente\s*$", r"^\s*untitled(?: document)?(?: \(?\d+\)?)?\s*$", r"^\s*documento sin t[ií]tulo", r"^\s*nueva\s+plantilla\b", r"\bundefined\s+-\s+undefined\b", r"\bt[ií]tulo de la norma aqu[ií]\b",
)
ERRORS = (
    r"\bhttp status \d{3}\b", r"\btiempo de espera agotado al consultar\b", r"\b50\d (?:service|bad|gateway|internal)\b", r"\bservice temporarily unavailable\b", r"^\s*(?:error\s+)?[45]\d\d (?:not found|forbidden|error)\b", r"\bno fue posible conectar con la base de datos\b",
    r"\bsqlstate\b", r"\btraceback: \w+", r"\w+exception: \w+", r"\bdemasiadas solicitudes desde su red\b", r"\bsitio en mantenci[oó]n\b", r"\bno se encuentra disponible en el visor\b", r"\ba[cs]ceso denegado\. usted\b", r"\busted no tiene permisos para ver\b", r"^\s*acceso denegado\s*$",
    r"\bla p[aá]gina solicitada no existe\b", r"\blo sentimos, no encontramos\b", r"\bsu sesi[oó]n ha caducado\b", r"^\s*sesi[oó]n expirada\b", r"^\s*p[aá]gina no encontrada\s*$", r"^\s*servicio no disponible\s*$", r"^\s*cargando norma\b", r"\bcargando norma, por favor espere\b", r"^\s*error \d{3}\b", r"\bthe server could not complete your request\b",
)
NOTICES = (
    r"\bdebe habilitar javascript\b", r"\bhabilite javascript\b", r"\byou need to enable javascript\b", r"\bturn on scripts in your browser\b", r"\brequiere cookies y javascript\b", r"\bnavegador no (?:compatible|soporta)\b", r"\bque no es un robot\b", r"\binicie sesi[oó]n para continuar\b", r"^\s*javascript requerido\s*$",
)
KINDS = {"template": MARKS + GAPS, "filler": FILLER, "failed_page": ERRORS, "script_notice": NOTICES}
# Pieces of text, in lower case, of which the phrases above hold one or more (but for fillers of none but
# a few short words). Most uses are harmless; they only save searching the rest of a training text.
SIGN_WORDS = (
    "....", "(..", "[..", "xx/", "xx de xx", "dd/mm", "don(ña)", "lorem", "ipsum", "amet", "consectetur", "adipiscing", "minim", "lacus", "arbor", "velit", "nunc", "viverra", "felis", "pulvinar", "rutrum", "blandit", "luctus", "congue", "ornare", "egestas", "sapien", "tellus", "fugit", "mauris", "vestra", "quaeris", "nullam", "massa", "aliqua", "cursus", "turpis", "semper", "qwerty", "asdf", "zxcv", "jkl", "xxx", "zzz", "aaaa", "va el texto", "de ejemplo", "por definir", "borrador", "pendiente de redac",
    "tulo pendiente", "do not publish", "reemplace este", "escriba aqu", "untitled", "sin tít", "sin tit", "plantilla", "undefined", "de la norma aqu", "http status", "tiempo de espera", "service", "2 bad", "gateway", "internal", "not found",
    "forbidden", "error 4", "error 5", "base de datos", "sqlstate", "traceback", "exception", "solicitudes desde", "mantenci", "en el visor", "denegado", "no tiene permisos", "solicitada no existe", "no encontramos", "ha caducado", "expirada",
    "no encontrada", "no disponible", "cargando", "complete your request", "javascript", "scripts", "cookies", "navegador no", "un robot", "para continuar",
)
_SIGN_CHARS = re.compile(r"[{}@«]|<[<%]|__|\[(?!norma|v[eé]ase)|#(?=\w)|%(?=[a-z])|error\s+\d|sin\s+t[ií]t|p[aá]gina\s+no\s|no\s+disponible|not\s+found")
_PLAIN_SIGNS = tuple(w for w in SIGN_WORDS if " " not in w)
_SPACED_SIGNS = {w: re.compile(re.escape(w).replace("\\ ", r"\s+")) for w in SIGN_WORDS if " " in w}
AROUND = 200  # characters around a sign in which phrases are looked for


def sign_spans(text: str) -> list[tuple[int, int]]:
    """The parts of the text around signs, merged. Blanks of any sort and number count as one."""
    t = text.lower()
    if len(t) != len(text):
        return [(0, len(text))]
    at = [m.start() for m in _SIGN_CHARS.finditer(t)]
    for w in _PLAIN_SIGNS:
        k = t.find(w)
        while k >= 0:
            at.append(k)
            k = t.find(w, k + len(w))
    squeezed = " ".join(t.split())
    for w, p in _SPACED_SIGNS.items():
        if w in squeezed:
            at += [m.start() for m in p.finditer(t)]
    out: list[tuple[int, int]] = []
    for k in sorted(at):
        a, e = max(0, k - AROUND), min(len(text), k + AROUND)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], e)
        else:
            out.append((a, e))
    return out


def _any_blanks(pattern: str) -> str:
    """A blank of a phrase matches any blanks; those inside brackets stay."""
    return re.sub(r" (?![^\[\]]*\])", r"\\s+", pattern)


@lru_cache(maxsize=1)
def _phrases() -> list[tuple[str, re.Pattern]]:
    exact = re.compile("|".join((*MARKS[5:6], *MARKS[7:9], *GAPS)))
    return [("template", exact), ("template", re.compile("|".join((*MARKS[:5], *MARKS[6:7], *MARKS[9:])), re.I)), *((k, re.compile("|".join(map(_any_blanks, v)), re.I | re.M)) for k, v in KINDS.items() if k != "template")]


def phrase_spans(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), kind) for a, e in sign_spans(text) for kind, p in _phrases() for m in p.finditer(text, a, e)]


def phrase_kind(text: str) -> str | None:
    return next((kind for a, e in sign_spans(text) for kind, p in _phrases() if p.search(text, a, e)), None)


@lru_cache(maxsize=1)
def _codes() -> tuple[np.ndarray, np.ndarray]:
    """Small codes of the first 65536 code points: folded character, and shape."""
    fold, shape = np.full(1 << 16, 127, np.uint32), np.full(1 << 16, 127, np.uint32)
    for c in range(1 << 16):
        ch = chr(c)
        if 0xD800 <= c < 0xE000:
            continue
        if ch.isspace():
            fold[c], shape[c] = (31 if ch == "\n" else 30), 4
        elif ch.isdigit():
            fold[c], shape[c] = 29, 3
        elif ch.isalpha():
            base = unicodedata.normalize("NFD", ch)[0].lower()
            fold[c] = ord(base) - 96 if "a" <= base <= "z" else 28
            shape[c] = 2 if ch.isupper() else 1
        elif 32 < c < 127:
            fold[c] = shape[c] = c % 64 + 40 if c < 65 else c % 64 + 64
        elif ch in "«»°º“”":
            fold[c] = shape[c] = 112 + "«»°º“”".index(ch)
    return fold, shape


def _ngrams(c: np.ndarray, n: int, salt: int) -> np.ndarray:
    """Hashed n-gram at every position; the end is padded."""
    r = np.random.RandomState(1000 * salt + n)
    mul = r.randint(1, 2**31, n).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    p = np.concatenate([c, np.zeros(n - 1, np.uint32)])
    h = p[: len(c)] * mul[0]
    for k in range(1, n):
        h += p[k : len(c) + k] * mul[k]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x9E3779B1)
    return h >> np.uint32(32 - BITS)


@dataclass
class Windows:
    """Features of a batch of texts: streams of (block of each position, hashed n-gram), and the blocks' texts."""

    streams: list[tuple[np.ndarray, np.ndarray]]
    of: np.ndarray  # text of each block
    first: np.ndarray  # first block of each text
    blocks: np.ndarray  # number of blocks of each text
    dense: np.ndarray  # dense features of each text


def windows_of(texts: list[str], title: np.ndarray) -> Windows:
    fold, shape = _codes()
    lens = np.array([len(t) for t in texts], np.int64)
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    cps = np.where(cps < 1 << 16, cps, 0xFFFF)
    start = np.concatenate([[0], np.cumsum(lens)[:-1]]) if len(lens) else np.empty(0, np.int64)
    blocks = np.maximum(1, -(-lens // BLOCK))
    first = np.concatenate([[0], np.cumsum(blocks)[:-1]]) if len(lens) else np.empty(0, np.int64)
    pos = np.arange(len(cps)) - np.repeat(start, lens)
    block = np.repeat(first, lens) + pos // BLOCK
    streams = []
    a = fold[cps]
    for n in ORDERS:
        streams.append((block, _ngrams(a, n, 1)))
    s = shape[cps]
    if len(s):
        begins = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (pos[1:] == 0)]))
        run = np.diff(np.concatenate([begins, [len(s)]]))
        kept = s[begins]
        kept = kept + np.uint32(128) * np.minimum(run, np.where(kept <= 4, 2, 4)).astype(np.uint32)
        for n in SHAPES:
            streams.append((block[begins], _ngrams(kept, n, 2)))
    dense = np.stack([np.ones(len(texts)), title, np.minimum(np.log1p(lens), 9) / 9, (lens < 250).astype(float), title * (lens < 60)], 1) if len(texts) else np.empty((0, 5))
    return Windows(streams, np.repeat(np.arange(len(texts)), blocks), first, blocks, dense)


def window_scores(w: Windows, weights: np.ndarray, dense_weights: np.ndarray) -> np.ndarray:
    """The score of the window that starts at each block; -inf for the last block of a text with several."""
    n = len(w.of)
    total, count = np.zeros(n), np.zeros(n)
    for block, idx in w.streams:
        total += np.bincount(block, weights[idx], n)
        count += np.bincount(block, minlength=n)
    if not n:
        return np.empty(0)
    last = np.concatenate([w.of[1:] != w.of[:-1], [True]])
    nxt_t, nxt_c = np.concatenate([total[1:], [0]]), np.concatenate([count[1:], [0]])
    pair_t, pair_c = total + np.where(last, 0, nxt_t), count + np.where(last, 0, nxt_c)
    z = pair_t / np.sqrt(np.maximum(pair_c, 1)) + (w.dense @ dense_weights)[w.of]
    # the last block of a text with several is part of the window before
    z[last & (w.blocks[w.of] > 1)] = -np.inf
    return z


def scores(w: Windows, weights: np.ndarray, dense_weights: np.ndarray) -> np.ndarray:
    """The highest window score of each text."""
    z = window_scores(w, weights, dense_weights)
    return np.maximum.reduceat(z, w.first) if len(z) else np.empty(0)


@dataclass
class Model:
    weights: np.ndarray
    dense: np.ndarray


def fit(rows: np.ndarray, idx: np.ndarray, norm: np.ndarray, dense: np.ndarray, y: np.ndarray, steps: int = STEPS) -> Model:
    """Logistic regression with an L2 penalty by accelerated full-batch steps. rows/idx: the sparse entries."""
    d = 1 << BITS
    # an n-gram of few windows is a name or a number by chance, no sign
    common = np.bincount(idx, minlength=d)[idx] >= LEAST_COUNT
    rows, idx = rows[common], idx[common]
    value = (1 / norm)[rows]
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * len(y)
    w, v = np.zeros(d), np.zeros(dense.shape[1])
    m1, m2, n1, n2 = np.zeros(d), np.zeros(d), np.zeros_like(v), np.zeros_like(v)
    for step in range(1, steps + 1):
        z = np.bincount(rows, w[idx] * value, len(y)) + dense @ v
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - (y > 0)) / len(y)
        gw = np.bincount(idx, g[rows] * value, d) + RIDGE * w / 10
        gv = dense.T @ g + RIDGE * v
        for p, gr, a, b in ((w, gw, m1, m2), (v, gv, n1, n2)):
            a *= 0.9
            a += 0.1 * gr
            b *= 0.99
            b += 0.01 * gr**2
            p -= 0.25 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return Model(w.astype(np.float32), v)


_EXAMPLE = "y int, fold int, doc long, dense array<double>, idx array<int>"
_NO_EXAMPLES = pa.schema([("y", pa.int32()), ("fold", pa.int32()), ("doc", pa.int64()), ("dense", pa.list_(pa.float64())), ("idx", pa.list_(pa.int32()))])


def _weak_labels(spans: list[tuple[int, int, str]], count: int, failed: bool) -> np.ndarray:
    """Per window: 1 if a phrase lies in it, 0 if it is near one or can't be judged, -1 if clean."""
    label = np.full(count, 0 if failed and not spans else -1)  # a record whose fetch only failed is no witness for clean text
    lo = np.arange(count) * BLOCK
    hi = lo + 2 * BLOCK
    for a, e, _ in spans:
        inside = np.minimum(hi, e) - np.maximum(lo, a)
        near = (np.minimum(hi, e + 100) - np.maximum(lo, a - 100)) > 0
        label = np.where(inside >= min(e - a, BLOCK), 1, np.where((label == -1) & near, 0, label))
    return label


def _picked(text: str, label: np.ndarray, clean: bool) -> list[int]:
    """Windows of a text to learn from: those with a phrase, clean ones near a sign, and other clean ones, evenly spread."""
    picked = list(np.flatnonzero(label == 1)[:WINDOWS_PER_TEXT])
    if clean:
        neg = np.flatnonzero(label == -1)
        signs = np.array([(a + e) // 2 // BLOCK for a, e in sign_spans(text)])
        close = np.isin(neg, np.concatenate([signs - 1, signs, signs + 1])) if len(signs) else np.zeros(len(neg), bool)
        for group in (neg[close], neg[~close]):
            picked += list(group[:: max(1, len(group) // WINDOWS_PER_TEXT)][:WINDOWS_PER_TEXT])
    return picked


def _examples(rows: list[tuple], weights: np.ndarray | None, dense: np.ndarray | None) -> pa.RecordBatch:
    """Labelled windows of rows (text, is_title, failed, fold, doc, clean); with weights the clean windows they take for residue."""
    out: list[list] = [[], [], [], [], []]
    hard = weights is not None
    if hard:  # only clean windows are asked for
        rows = [(r, []) for r in rows if r[5]]
    else:
        rows = [(r, spans) for r in rows if (spans := phrase_spans(r[0])) or r[5]]
    w = windows_of([r[0] for r, _ in rows], np.array([float(r[1]) for r, _ in rows]))
    z = window_scores(w, weights, dense) if hard else None
    order = [np.argsort(block, kind="stable") for block, _ in w.streams]
    sorted_blocks = [block[o] for (block, _), o in zip(w.streams, order, strict=True)]
    for i, ((text, _, failed, fold, doc, clean), spans) in enumerate(rows):
        n, first = int(w.blocks[i]), int(w.first[i])
        count = max(1, n - 1)
        if hard:
            zs = z[first : first + count]
            if not (zs > HARD_SCORE).any():
                continue
            label = _weak_labels(phrase_spans(text), count, failed)
            neg = np.flatnonzero((label == -1) & (zs > HARD_SCORE))
            picked = list(neg[np.argsort(-zs[neg], kind="stable")][:HARD_PER_TEXT])
        else:
            label = _weak_labels(spans, count, failed)
            picked = _picked(text, label, clean)
        for k in picked:
            blk, idx = first + k, []
            for (_, h), o, sb in zip(w.streams, order, sorted_blocks, strict=True):
                lo, hi = np.searchsorted(sb, blk), np.searchsorted(sb, blk + (2 if n > 1 else 1))
                idx.append(h[o[lo:hi]])
            for c, v in zip(out, (int(label[k]), int(fold), int(doc), w.dense[i].tolist(), np.concatenate(idx).astype(np.int32)), strict=True):
                c.append(v)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _NO_EXAMPLES, strict=True)], schema=_NO_EXAMPLES)


def labelled_windows(texts: DataFrame, model: Model | None = None) -> DataFrame:
    """y, fold, doc, dense, idx: weakly labelled windows of the sample; with a model the clean windows it takes for residue.

    texts: text, is_title, failed, fold, doc, clean, as from training_texts.
    """
    shared = texts.sparkSession.sparkContext.broadcast((None, None) if model is None else (model.weights, model.dense))

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 128):
                yield _examples([r for r in zip(*(c.to_pylist() for c in b.slice(s, 128).columns), strict=True) if r[0]], *shared.value)

    return texts.mapInArrow(examples, _EXAMPLE)


def training_texts(df: DataFrame, key: str, fields: list[str], title_field: str, url: str, failed_ids: DataFrame | None) -> DataFrame:
    """text, is_title, failed, fold, doc, clean, held_out: the texts of a bounded sample of rows, written to the checkpoint folder.

    The sample is the first SAMPLE_ROWS rows by hash of the key; of SAMPLE_CLEAN of them windows without residue are
    learned too. fold is what validation holds out together: whole hosts of the url if at least two hosts have a
    hundredth of the sample each (held_out = host), else blocks of 50 neighbouring keys (held_out = key_block), which
    is weaker: it says nothing about hosts never seen.
    """
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z]+://([^/]+)", 1)
    base = df.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("doc"), F.col(key).alias("k"), F.lower(host).alias("host"), *fields)
    n = max(1, df.count())
    place = (F.shiftright("doc", 11) + F.lit(1 << 52)) / F.lit(float(1 << 53))  # of the key's hash among all, 0 to 1
    picked = base.where(place < min(1.0, SAMPLE_ROWS / n)).withColumn("clean", place < min(1.0, SAMPLE_CLEAN / n))
    failed = F.lit(False)
    if failed_ids is not None:
        picked = picked.join(failed_ids.select(F.col(key).alias("k"), F.lit(True).alias("failed")), "k", "left")
        failed = F.coalesce("failed", F.lit(False))
    picked = cut_lineage(picked.withColumn("failed", failed).repartition(df.sparkSession.sparkContext.defaultParallelism))
    # at most as many hosts as sampled rows
    sizes = picked.where("host <> ''").groupBy("host").agg(F.countDistinct("k").alias("n"))
    known = [r["host"] for r in sizes.where(F.col("n") >= min(n, SAMPLE_ROWS) / 100).orderBy(F.desc("n"), "host").collect()]
    if len(known) > 1:
        fold = F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int")
        for i, h in enumerate(known):
            fold = F.when(F.col("host") == h, i % FOLDS).otherwise(fold)
    else:
        fold = F.pmod(F.xxhash64(F.floor(F.col("k") / 50)), F.lit(FOLDS)).cast("int")
    texts = F.explode(F.array(*(F.struct(F.col(f).alias("text"), F.lit(f == title_field).alias("is_title")) for f in fields)))
    out = picked.select(texts.alias("t"), "failed", fold.alias("fold"), "doc", "clean", F.lit("host" if len(known) > 1 else "key_block").alias("held_out"))
    return out.select("t.text", "t.is_title", "failed", "fold", "doc", "clean", "held_out").where("text is not null")


def _arrays(t: pa.Table) -> tuple[np.ndarray, ...]:
    lists = t.column("idx").combine_chunks()
    lens = np.diff(np.asarray(lists.offsets))
    rows = np.repeat(np.arange(t.num_rows), lens)
    dense = np.asarray(t.column("dense").combine_chunks().flatten()).reshape(t.num_rows, -1) if t.num_rows else np.empty((0, 5))
    return rows, np.asarray(lists.flatten()), np.sqrt(np.maximum(lens, 1)), dense, np.asarray(t.column("y"))


def _learned(texts: DataFrame) -> tuple[Model, pa.Table]:
    """The model and what it was fitted on: first the labelled windows, then also the clean windows it took for residue."""
    sample = texts.select("text", "is_title", "failed", "fold", "doc", "clean")
    by_key = [("doc", "ascending"), ("y", "ascending")]
    t = labelled_windows(sample).toArrow().sort_by(by_key)
    model = fit(*_arrays(t), steps=FIRST_STEPS)
    t = pa.concat_tables([t, labelled_windows(sample, model).toArrow()]).sort_by(by_key)
    return fit(*_arrays(t)), t


def train(texts: DataFrame) -> Model:
    """The classifier, from the sample that training_texts gives. Without examples of both sorts it takes nothing."""
    return _learned(texts)[0]


def validate(texts: DataFrame, bound: float | None = None, title_bound: float | None = None) -> list[tuple]:
    """(held_out, fold, positives, found, taken, negatives) per fold that was kept out of the fit, by windows, at the bounds of detect."""
    bound, title_bound = BOUND if bound is None else bound, TITLE_BOUND if title_bound is None else title_bound
    first = texts.select("held_out").first()
    t = _learned(texts)[1]
    fold = np.asarray(t.column("fold"))
    out = []
    for f in np.unique(fold):
        m = fit(*_arrays(t.filter(pa.array(fold != f))))
        rows, idx, norm, dense, y = _arrays(t.filter(pa.array(fold == f)))
        z = np.bincount(rows, m.weights[idx] / norm[rows], len(y)) + dense @ m.dense
        taken = z >= np.where(dense[:, 1] > 0, title_bound, bound)
        out.append((first[0], int(f), int((y > 0).sum()), int((taken & (y > 0)).sum()), int(taken.sum()), int((y <= 0).sum())))
    return out


def detect(df: DataFrame, key: str, fields: list[str], title_field: str, model: Model, bound: float = BOUND, title_bound: float = TITLE_BOUND) -> DataFrame:
    """field, key, kind, score: every text of which a window scores at or above the bound, one row per field and key.

    The score alone decides; kind only names what was found: template, filler, failed_page or script_notice by the
    first known phrase, or `unnamed`. Null keys and texts give no row, nor do empty texts; of rows of one key the
    highest score counts. Whole texts are scored, whatever their length.
    """
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast((model.weights, model.dense))  # 2 ** BITS floats
    base = spread_out(df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), *fields))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, dense = shared.value
        for b in batches:
            for s in range(0, b.num_rows, 128):
                part = b.slice(s, 128)
                for i, f in enumerate(fields):
                    texts = part.column(i + 1).to_pylist()
                    rows = [r for r, t in enumerate(texts) if t]
                    kept = [texts[r] for r in rows]
                    z = scores(windows_of(kept, np.full(len(kept), float(f == title_field))), weights, dense)
                    hits = np.flatnonzero(z >= (title_bound if f == title_field else bound))
                    out_r, kinds = [rows[h] for h in hits], [phrase_kind(kept[h]) or "unnamed" for h in hits]
                    yield pa.RecordBatch.from_arrays([pa.array([f] * len(out_r), pa.string()), part.column(0).take(pa.array(out_r, pa.int64())), pa.array(kinds, pa.string()), pa.array(z[hits].astype(float), pa.float64())], names=["field", "k", "kind", "score"])

    kind = base.schema["k"].dataType.simpleString()
    hits = base.mapInArrow(score, f"field string, k {kind}, kind string, score double")
    best = hits.groupBy("field", "k").agg(F.max(F.struct("score", "kind")).alias("b"))
    return best.select("field", F.col("k").alias(key), "b.kind", "b.score")
