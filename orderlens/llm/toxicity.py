"""Operator 13: toxicity by a support vector machine over a subsequence string kernel with Nyström landmarks.

Two strings are alike as far as they share subsequences of ``LETTERS`` letters, each weighted by ``DECAY`` to the power of
the distance it spans, at most ``SPAN`` letters. Gapped and inserted characters only lower the weight, so variants of an
insult stay near it. The kernel is scaled by a function of the two lengths.

The unit of a sentence is a word's letters in lower case, without what stands between them, with a mark at either end;
single letters in a row are one word, and long words are read in overlapping windows. Labelled sentences teach as bags: a sentence marked as toxic
has at least one toxic unit. Units that stand in toxic documents much more often than in others begin as positive, units
of clean documents are negative; the machine is trained, the clean units that it takes for toxic are added, and it is
trained again. Landmarks are the most telling units that are unlike one another, and units of clean text. In the space
that they span (Nyström) the machine is linear, so it comes down to one weight per letter subsequence, and a unit's margin
is a sum over its subsequences: work linear in the text, whatever the number of landmarks.

A document's margin is the largest of its units', mapped to (0, 1) by a logistic curve fitted on labelled documents. Null
text, and text without a unit, has the margin of an empty string. Learning reads at most about ``SAMPLE_ROWS`` labelled
documents of either label, chosen by a hash of the id, with their whole texts; scores are given to every whole text. With
no labelled documents of both labels all scores are 0. Rows that repeat an id are scored each, null ids are not held out
and teach nothing, labels of an id that contradict one another count as toxic. Other columns are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, give_back, staged
from .units import Memo

LETTERS, SPAN, DECAY = 3, 8, 0.7
# Letters of a window of a long word, and by how much the next one is shifted.
WINDOW, STEP = 24, 12
# Labelled documents of either label that teach, about.
SAMPLE_ROWS = 5_000
LANDMARKS, CLEAN_LANDMARKS = 160, 96
# Most frequent letters of the landmarks that are told apart.
ALPHABET = 63
# Units that teach: at first, and of each label in each further round.
POSITIVE, NEGATIVE, MORE = 4_000, 8_000, 2_000
ROUNDS = 3
# A telling unit stands in so many toxic documents and has so large a likelihood ratio; a document names its best ones.
SUPPORT, LIKELIHOOD, WITNESSES = 3, 20.0, 3
# Weight of errors, and how much more a telling unit weighs than a variant of it. Both kinds weigh up to the square of it,
# by likelihood ratio or by the number of clean documents.
PENALTY, TELLING = 10.0, 10.0
THRESHOLD = 0.7
# Characters of text handled at once, and units remembered in each generation of a worker.
SLICE_CHARS, UNITS = 1 << 19, 200_000
PIECE_CHARS = 1 << 22
# Above every code point: what parts two units.
BREAKS = 1 << 21
# Marks that stand as letters before and behind a unit.
BEFORE, BEHIND = 1, 2


@functools.cache
def _table() -> np.ndarray:
    """What becomes of each code point: a letter its lower case, white space BREAKS, anything else 0."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low[0])
        elif x.isspace():
            out[c] = BREAKS
    return out


def units_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters of the units of some texts back to back, the offsets of the units in them, and each unit's text."""
    joined = "\n".join(texts)
    raw = _table()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")]
    starts = np.cumsum([0, *[len(t) + 1 for t in texts]])[1:-1].astype(np.int64)
    row = np.cumsum(np.bincount(starts, minlength=len(raw) + 1))[: len(raw)]
    word = np.cumsum(raw == BREAKS)
    letter = (raw != 0) & (raw != BREAKS)
    raw, word, row = raw[letter], word[letter], row[letter]
    if not len(raw):
        return raw, np.zeros(1, np.int64), np.zeros(0, np.int64)
    begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    size = np.diff(np.append(begin, len(raw)))
    of = row[begin]
    # Words of a single letter join the one before them if that is single too.
    single = size == 1
    joins = np.append(False, single[1:] & single[:-1] & (of[1:] == of[:-1]))
    begin, of = begin[~joins], of[~joins]
    size = np.diff(np.append(begin, len(raw)))
    # A mark before and behind each unit.
    marked = np.full(len(raw) + 2 * len(begin), BEHIND, np.uint32)
    marked[np.arange(len(raw)) + 2 * np.repeat(np.arange(len(begin)), size) + 1] = raw
    begin, size = begin + 2 * np.arange(len(begin)), size + 2
    marked[begin] = BEFORE
    # Long units are read in windows; the last one ends with the unit.
    count = np.where(size > WINDOW, -(-(size - WINDOW) // STEP) + 1, 1)
    if (count == 1).all():
        return marked, np.append(begin, len(marked)), of
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = np.repeat(begin, count) + np.minimum(number * STEP, np.repeat(np.maximum(size - WINDOW, 0), count))
    length = np.repeat(np.minimum(size, WINDOW), count)
    upto = np.cumsum(length)
    place = np.repeat(start - (upto - length), length) + np.arange(upto[-1])
    return marked[place], np.concatenate(([0], upto)), np.repeat(of, count)


def subsequences(size: int) -> list[tuple[int, int, float]]:
    """Second and third place of every subsequence of three from a first place, and its weight."""
    return [(i, j, DECAY ** (j + 1)) for j in range(2, size) for i in range(1, j)]


OFFSETS = subsequences(SPAN)


def scale(length: np.ndarray) -> np.ndarray:
    """Length of the feature vector of a string without repeated subsequences."""
    n = np.arange(WINDOW + 1)
    squares = sum(np.maximum(n - j, 0) * w * w for _, j, w in OFFSETS)
    return np.sqrt(np.maximum(squares, DECAY**6))[length]


def codes(letters: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Numbers of the letters from 1, zero for those outside the alphabet."""
    if not len(alphabet):
        return np.zeros(len(letters), np.int64)
    at = np.minimum(np.searchsorted(alphabet, letters), len(alphabet) - 1)
    return np.where(alphabet[at] == letters, at + 1, 0)


def features(letters: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray, rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each unit the scaled sum of the table's rows over its subsequences; ``rows`` leads from those to rows."""
    code, size = codes(letters, alphabet), len(alphabet) + 1
    length = np.diff(offsets)
    stop = np.repeat(offsets[1:], length)
    at = np.arange(len(letters))
    total = np.zeros((len(letters) + 1, *table.shape[1:]))
    for i, j, weight in OFFSETS:
        fits = np.flatnonzero(at + j < stop)
        total[fits + 1] += weight * table[rows[(code[fits] * size + code[fits + i]) * size + code[fits + j]]]
    sums = np.cumsum(total, axis=0)
    norm = scale(length)
    return (sums[offsets[1:]] - sums[offsets[:-1]]) / (norm if total.ndim == 1 else norm[:, None])


def packed(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer("".join(units).encode("utf-32-le"), "<u4"), np.cumsum([0, *map(len, units)])


def landmark_table(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The alphabet of the landmarks, the row of every subsequence (0 for none), and its weights in the landmarks."""
    letters, offsets = packed(units)
    found, count = np.unique(letters, return_counts=True)
    alphabet = np.sort(found[np.lexsort((found, -count))[:ALPHABET]])
    code, size = codes(letters, alphabet), len(alphabet) + 1
    norm = scale(np.diff(offsets))
    keys, marks, weights = [], [], []
    for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        x = code[a:b]
        for i, j, weight in OFFSETS:
            if len(x) > j:
                p, q, r = x[: len(x) - j], x[i : len(x) - j + i], x[j:]
                key = ((p * size + q) * size + r)[(p > 0) & (q > 0) & (r > 0)]
                keys.append(key)
                marks.append(np.full(len(key), k))
                weights.append(np.full(len(key), weight / norm[k]))
    rows = np.zeros(size**3, np.int64)
    if not keys:
        return alphabet, rows, np.zeros((1, len(units)))
    distinct, row = np.unique(np.concatenate(keys), return_inverse=True)
    rows[distinct] = np.arange(1, len(distinct) + 1)
    table = np.zeros((len(distinct) + 1, len(units)))
    np.add.at(table, (row + 1, np.concatenate(marks)), np.concatenate(weights))
    return alphabet, rows, table


def points_of(units: list[str], known: tuple[np.ndarray, np.ndarray, np.ndarray], root: np.ndarray | None = None) -> np.ndarray:
    """The kernel of the units with the landmarks, a thousand at a time, mapped by ``root`` if given."""
    parts = [features(*packed(units[a : a + 1000]), *known) for a in range(0, len(units), 1000)]
    return np.concatenate([p if root is None else p @ root for p in parts])


def trained(points: np.ndarray, sign: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by Newton's method: weights and bias."""
    x = np.hstack((points, np.ones((len(points), 1))))
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        return 0.5 * w @ ridge @ w + PENALTY * (weight * np.maximum(0, 1 - sign * (x @ w)) ** 2).sum()

    now = loss(w)
    for _ in range(50):
        active = sign * (x @ w) < 1
        xa, ya, ca = x[active], sign[active], 2 * PENALTY * weight[active]
        gradient = ridge @ w + xa.T @ (ca * (xa @ w - ya))
        step = np.linalg.solve(ridge + xa.T @ (ca[:, None] * xa), gradient)
        size, new = 1.0, loss(w - step)
        while new > now and size > 1e-6:
            size /= 2
            new = loss(w - size * step)
        if now - new < 1e-9 * max(1.0, now):
            break
        w, now = w - size * step, new
    return w[:-1], float(w[-1])


def pieces(text: str) -> Iterator[str]:
    """A very long text in pieces, cut behind a space where there is one, so that memory stays bounded."""
    at = 0
    while at < len(text):
        end = len(text) if len(text) - at <= PIECE_CHARS else text.rfind(" ", at, at + PIECE_CHARS) + 1
        end = end if end > at else at + PIECE_CHARS
        yield text[at:end]
        at = end


@dataclass(frozen=True)
class Machine:
    """Weight of every subsequence of the alphabet's letters, bias, and the logistic curve of documents."""

    alphabet: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, letters: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return features(letters, offsets, self.alphabet, np.arange(len(self.weights)), self.weights) + self.bias

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))

    def encoded(self, units: list[bytes]) -> list[float]:
        """The margins of units given as code points of 32 bits."""
        if not units:
            return []
        offsets = np.cumsum([0, *map(len, units)]) // 4
        return self.margins(np.frombuffer(b"".join(units), "<u4"), offsets).tolist()

    def documents(self, texts: list[str | None], memo: Memo) -> np.ndarray:
        """The largest margin of each text's units, or that of an empty string."""
        out = np.full(len(texts), self.bias)
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop] or "") <= SLICE_CHARS):
                size += len(texts[stop] or "")
                stop += 1
            for some in [[t or "" for t in texts[start:stop]]] if size <= PIECE_CHARS else ([p] for p in pieces(texts[start])):
                letters, offsets, row = units_of(some)
                if len(row):
                    raw = np.ascontiguousarray(letters, "<u4")
                    cut = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), len(row), [None, pa.py_buffer(offsets.astype(np.int64) * 4), pa.py_buffer(raw)]
                    ).dictionary_encode()
                    known = np.array(memo.values(cut.dictionary.to_pylist()))
                    np.maximum.at(out, row + start, known[cut.indices.to_numpy()])
            start = stop
        return out


def machine(landmarks: list[str], units: list[str], sign: np.ndarray, weight: np.ndarray) -> Machine:
    """Nyström features of the units, the linear machine on them, and back to one weight per subsequence."""
    known = landmark_table(landmarks)
    among = points_of(landmarks, known)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    weights, bias = trained(points_of(units, known, root), sign, weight)
    alphabet, rows, table = known
    return Machine(alphabet, (table @ (root @ weights))[rows], bias)


def variants(units: list[str]) -> list[str]:
    """Each unit of at least five letters with one letter put in, and with one left out, at inner places."""
    out = []
    for unit in units:
        n = len(unit)
        if 7 <= n < WINDOW:  # with the marks
            at, other = 3 + zlib.crc32(unit.encode()) % (n - 5), unit[1 + zlib.crc32(unit[::-1].encode()) % (n - 2)]
            out += [unit[:at] + "x" + unit[at:], unit[:at] + other + unit[at:], unit[:at] + unit[at + 1 :]]
    return out


def unlike(units: list[str], most: int, limit: float = 0.75) -> list[str]:
    """The first units, at most ``most``, of which none is more alike to an earlier one than ``limit``."""
    units = units[: 4 * most]
    if not units:
        return []
    among = points_of(units, landmark_table(units))
    out: list[int] = []
    for i in range(len(units)):
        if len(out) < most and (not out or among[i, out].max() < limit):
            out.append(i)
    return [units[i] for i in out]


def curve(margin: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, fitted to labels drawn a little towards the middle."""
    up, down = weight[toxic].sum(), weight[~toxic].sum()
    goal = np.where(toxic, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack((margin, np.ones(len(margin))), axis=1)
    w = np.zeros(2)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((weight * (np.logaddexp(0, z) - goal * z)).sum() + 1e-6 * w @ w)

    now = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (weight * (p - goal)) + 2e-6 * w
        step = np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + 2e-6 * np.eye(2), gradient)
        size, new = 1.0, loss(w - step)
        while new > now and size > 1e-6:
            size /= 2
            new = loss(w - size * step)
        if now - new < 1e-10 * max(1.0, now):
            break
        w, now = w - size * step, new
    return float(w[0]), float(w[1])


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: checksum of the id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _doc_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct units of each document that have two letters at least."""
    for batch in batches:
        for k in range(len(batch)):
            letters, offsets, _ = units_of([batch.column("text")[k].as_py()])
            raw = letters.astype("<u4").tobytes().decode("utf-32-le")
            found = sorted({raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) if b - a > LETTERS})
            same = [np.full(len(found), batch.column(c)[k].as_py()) for c in ("row", "toxic")]
            yield pa.RecordBatch.from_arrays([pa.array(same[0], pa.int64()), pa.array(same[1], pa.int32()), pa.array(found, pa.string())], names=["row", "toxic", "unit"])


def unit_margin(unit: Column, known: Machine) -> Column:
    def run(units: pa.Array) -> pa.Array:
        return pa.array(known.margins(*packed(units.to_pylist())) if len(units) else [], pa.float64())

    return F.arrow_udf(run, "double")(unit)


def margin(text: Column, known: Machine) -> Column:
    """The largest margin of a text's units."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = Memo(known.encoded, UNITS)
        for texts in batches:
            yield pa.array(known.documents(texts.to_pylist(), memo), pa.float64())
        memo.forget()
        give_back()

    return F.arrow_udf(run, "double")(text)


def learn(docs: DataFrame, labels: DataFrame, *, key: str, text: str, label_key: str, label: str) -> Machine | None:
    """The machine from labelled documents; None unless there are documents of both labels."""
    bounded_batches(docs.sparkSession)
    marked = labels.select(F.col(label_key).alias("id"), F.col(label).cast("int").alias("toxic"))
    marked = marked.where("id is not null and toxic in (0, 1)").where(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    marked = staged(marked, "labelled")
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    share = F.when(F.col("toxic") == 1, min(1.0, SAMPLE_ROWS / sizes[1])).otherwise(min(1.0, SAMPLE_ROWS / sizes[0]))
    chance = F.shiftrightunsigned(F.xxhash64("id", F.lit("teach")), 11) / F.lit(float(1 << 53))
    # At most about twice SAMPLE_ROWS ids, so their broadcast is bounded, and no text is shuffled to find them.
    chosen = marked.where(chance < share)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where("text is not null").join(F.broadcast(chosen), "id")
    sample = staged(rows.select(F.monotonically_increasing_id().alias("row"), "toxic", "text"), "sample")
    counts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    in_docs = staged(sample.mapInArrow(_doc_units, "row long, toxic int, unit string"), "doc_units")
    sums = in_docs.groupBy("unit").agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0"))
    toxic_share = counts[1] / (counts[0] + counts[1])
    both = F.col("n1") + F.col("n0")
    clean_part = F.when(F.col("n0") > 0, F.col("n0") * F.log(F.col("n0") / (both * (1 - toxic_share)))).otherwise(0.0)
    ratio = F.when(F.col("n1") > 0, 2 * (F.col("n1") * F.log(F.col("n1") / (both * toxic_share)) + clean_part)).otherwise(0.0)
    # A unit tells if most of the documents in which it stands are toxic, in all labelled ones.
    telling = F.col("n1") * (sizes[1] / counts[1]) * (1 - THRESHOLD) > F.col("n0") * (sizes[0] / counts[0]) * THRESHOLD
    units = staged(sums.withColumn("ratio", F.when(telling, ratio).otherwise(0.0)), "units")
    strong = units.where((F.col("ratio") > LIKELIHOOD) & (F.col("n1") >= SUPPORT)).select("unit", "ratio")
    named = in_docs.where("toxic = 1").join(strong, "unit").groupBy("row").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("ratio", "unit")), asc=False), 1, WITNESSES).alias("best")
    )
    named = staged(named.select("row", F.col("best")[0]["ratio"].alias("top"), F.explode("best").alias("b")), "named")
    best = named.where(F.col("b.ratio") >= F.col("top") / 2).select("b.unit", "b.ratio").distinct().orderBy(F.desc("ratio"), "unit").limit(POSITIVE).collect()
    positive = [r["unit"] for r in best]
    heavy = {r["unit"]: min(max(r["ratio"], TELLING), TELLING * TELLING) for r in best}
    if not best:  # too few documents for a test: the units that stand in most toxic documents and in no other
        positive = [r["unit"] for r in units.where("n1 > 0 and n0 = 0").orderBy(F.desc("n1"), "unit").limit(WITNESSES).collect()]
    clean = units.where("n0 > 0 and ratio = 0")
    negative = {r["unit"]: r["n0"] for r in clean.orderBy(F.xxhash64("unit", F.lit("clean")), "unit").limit(NEGATIVE).collect()}
    if not positive or not negative:
        return None
    landmarks = unlike(positive, LANDMARKS) + unlike([*negative], CLEAN_LANDMARKS)
    for i in range(ROUNDS):
        more = variants(positive)
        sign = np.array([1.0] * (len(positive) + len(more)) + [-1.0] * len(negative))
        weight = np.array([heavy.get(u, TELLING) for u in positive] + [1.0] * len(more) + [min(n, TELLING * TELLING) for n in negative.values()])
        made = machine(landmarks, [*positive, *more, *negative], sign, weight)
        if i < ROUNDS - 1:
            hard = clean.select("unit", "n0", unit_margin(F.col("unit"), made).alias("m")).orderBy(F.desc("m"), "unit").limit(MORE).collect()
            alike = units.where(f"n0 = 0 and ratio > {LIKELIHOOD / 2}").select("unit", unit_margin(F.col("unit"), made).alias("m"))
            alike = alike.where("m > 0.5").orderBy(F.desc("m"), "unit").limit(MORE).collect()
            positive = [*dict.fromkeys(positive + [r["unit"] for r in alike])]
            negative |= {r["unit"]: r["n0"] for r in hard}
    # A toxic document without a telling unit may be marked wrongly, so it says nothing about the curve.
    told = sample.join(named.select("row").distinct(), "row", "left_semi") if heavy else sample
    fit = sample.where("toxic = 0").unionByName(told.where("toxic = 1"))
    found = fit.select("toxic", margin(F.col("text"), made).alias("m")).collect()
    toxic = np.array([r["toxic"] == 1 for r in found])
    weight = np.where(toxic, sizes[1] / counts[1], sizes[0] / counts[0])
    slope, shift = curve(np.array([r["m"] for r in found]), toxic, weight * len(found) / weight.sum())
    return Machine(made.alphabet, made.weights, made.bias, slope, shift)


def scored(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label_key: str = "doc_id",
    label: str = "toxic",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``, learned from the labelled rows not held out."""
    known = learn(docs, labels, key=key, text=text, label_key=label_key, label=label)
    out = F.col(key).alias("doc_id"), held_out(F.col(key)).alias("held_out")
    if known is None:
        return docs.select(*out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    rows = docs.select(*out, margin(F.col(text), known).alias("m"))
    z = F.col("m") * F.lit(known.slope) + F.lit(known.shift)
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z))))
    rows = rows.select("doc_id", "held_out", score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
