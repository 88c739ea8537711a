"""Language identification by nearest centroid.

Texts become TF-IDF vectors of hashed byte n-grams; each language has several
centroids, found by spherical k-means; the language of the nearest centroid by
cosine is predicted, and a text too far from all of them is rejected.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import giving_back, small_batches
from .textgrams import mix, text_slices

#: Hashed n-grams: lengths in bytes, and dimensions of a vector.
LENGTHS, DIMENSIONS = (1, 2, 3, 4), 1 << 13
#: Training texts of a language, about: a bounded, documented sample of rows, each with its whole text.
SAMPLE = 300
#: Texts of the sample in all, with that many languages or more, and the languages that are learned, those with most texts.
SAMPLE_IN_ALL, LANGUAGES = 6000, 200
#: Bytes of text whose n-grams are counted at once.
STEP = 1 << 20
#: Texts whose vectors are made at once.
VECTORS = 128
CENTROIDS, ITERATIONS = 4, 12
#: Share of a language's training texts, those farthest from their mean, that no centroid is made of: a text of digits would be one by itself and accept all noise.
OUTLIERS = 0.02
#: Text lengths in bytes at which a language's least cosine is measured, and the share of its training texts below it.
CUTS, REJECT_QUANTILE = tuple(1 << i for i in range(2, 14)), 0.01
#: Training texts from which a language's own quantile counts; with fewer, that of all languages does.
ENOUGH = 100
UNDETERMINED = "und"

_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32
_fold[48:58] = 48
_fold[[9, 10, 11, 12, 13]] = 32
_U = np.uint64


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams, a row for each text; no n-gram crosses texts.

    Bytes are taken STEP at a time, so a long text needs no more memory.
    """
    rows = len(offsets) - 1
    out = np.zeros(rows * DIMENSIONS, dtype=np.float32)
    for start in range(0, len(data), STEP):
        x = _fold[data[start : start + STEP + max(LENGTHS) - 1]].astype(_U)
        here = np.clip(offsets, start, start + len(x))
        row = np.repeat(np.arange(rows), np.diff(here))
        for n in LENGTHS:
            size = min(STEP, len(x) - n + 1)
            if size <= 0:
                continue
            code = x[:size].copy()
            for j in range(1, n):
                code = code << _U(8) | x[j : j + size]
            inside = row[:size] == row[n - 1 : n - 1 + size]
            at = (mix(code + _U(n << 40)) & _U(DIMENSIONS - 1)).astype(np.int64) + row[:size] * DIMENSIONS
            out += np.bincount(at[inside], minlength=len(out)).astype(np.float32)
    return out.reshape(rows, DIMENSIONS)


def _sparse(counts: np.ndarray) -> bytes:
    """A row of counts as places and values."""
    at = np.flatnonzero(counts)
    return at.astype("<u2").tobytes() + counts[at].astype("<f4").tobytes()


def _dense(rows: list[bytes]) -> np.ndarray:
    out = np.zeros((len(rows), DIMENSIONS), np.float32)
    for i, raw in enumerate(rows):
        n = len(raw) // 6
        out[i, np.frombuffer(raw, "<u2", n)] = np.frombuffer(raw, "<f4", n, 2 * n)
    return out


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.sqrt(counts) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, norm, out=v, where=norm > 0)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Model:
    """Centroids (unit vectors), their languages, and the least cosines each language accepts, one for each length of CUTS."""

    def __init__(self, idf, centroids, langs, least):
        self.idf, self.centroids, self.langs, self.least = idf, centroids, langs, least

    @classmethod
    def fit(cls, counts: np.ndarray, langs: list[str], centroids: int = CENTROIDS) -> Model:
        """counts: a row of n-gram counts for each training text."""
        counts, langs = counts[counts.any(axis=1)], [x for x, some in zip(langs, counts.any(axis=1)) if some]
        if not langs:
            return cls(np.ones(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32), [], {})
        idf = (np.log((1 + len(langs)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
        v, found, names = _vectors(counts, idf), [], []
        for lang in sorted(set(langs)):
            mine = v[[x == lang for x in langs]]
            heart = mine.mean(axis=0)
            mine = mine[np.sort(np.argsort(mine @ heart, kind="stable")[int(OUTLIERS * len(mine)) :])]
            k = min(centroids, len(mine))
            own = [int(np.argmax(mine @ heart))]  # the most typical text, then those farthest from the ones chosen
            while len(own) < k:
                own.append(int(np.argmin((mine @ mine[own].T).max(axis=1))))
            c = mine[own]
            for _ in range(ITERATIONS):
                near = np.argmax(mine @ c.T, axis=1)
                c = np.stack([mine[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(k)])
                c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
            found.append(c)
            names += [lang] * k
        return cls(idf, np.concatenate(found).astype(np.float32), names, {})

    def cosines(self, data: np.ndarray, lang: str) -> list[float]:
        """The cosine of a text, cut to each of the CUTS that it reaches, with the nearest centroid of its language."""
        own = self.centroids[[x == lang for x in self.langs]]
        sizes = [n for n in CUTS if n <= len(data)]
        if not len(own) or not sizes:
            return []
        cut = np.concatenate([data[:n] for n in sizes])
        return (_vectors(grams(cut, np.concatenate(([0], np.cumsum(sizes)))), self.idf) @ own.T).max(axis=1).tolist()

    def accept(self, found: dict[str, list[list[float]]]) -> None:
        """Set the least cosines; found has, by language, the cosines of texts of that language at each length of CUTS."""
        shared, last = [], -1.0
        for i in range(len(CUTS)):
            every = [x for mine in found.values() for x in mine[i]]
            last = float(np.quantile(every, REJECT_QUANTILE)) if len(every) >= ENOUGH else last
            shared.append(last)
        for lang in sorted(set(self.langs)):
            mine = found.get(lang, [[]] * len(CUTS))
            self.least[lang] = [float(np.quantile(x, REJECT_QUANTILE)) if len(x) >= ENOUGH else shared[i] for i, x in enumerate(mine)]

    def least_at(self, lang: str, size: int) -> float:
        """The least cosine for a text of so many bytes; a model that was not calibrated accepts all."""
        return float(np.interp(math.log2(max(1, size)), np.log2(CUTS), self.least[lang])) if lang in self.least else -1.0

    def predict(self, column: pa.Array) -> tuple[list[str], list[float], list[bool]]:
        """Language, cosine and whether it is rejected, for each text."""
        langs, scores, rejected = [], [], []
        for first, data, offsets in text_slices(column):
            for start in range(0, len(offsets) - 1, VECTORS):
                o = offsets[start : start + VECTORS + 1]
                v = _vectors(grams(data[o[0] : o[-1]], o - o[0]), self.idf)
                cos = v @ self.centroids.T if len(self.langs) else np.zeros((len(v), 1), np.float32)
                for i, best in enumerate(np.argmax(cos, axis=1).tolist()):
                    part = data[o[i] : o[i + 1]]
                    low = part | 32
                    lettered = bool(((low >= 97) & (low <= 122)).any())
                    if not lettered and len(part) and part.max() > 127:
                        lettered = has_letter(column[first + start + i].as_py())
                    if not lettered or not self.langs:
                        langs.append(UNDETERMINED)
                        scores.append(0.0)
                        rejected.append(True)
                        continue
                    langs.append(self.langs[best])
                    scores.append(min(1.0, max(0.0, float(cos[i, best]))))
                    rejected.append(scores[-1] < self.least_at(langs[-1], len(part)))
        return langs, scores, rejected


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` whole texts of each language, all of a language that has fewer.

    The sample is drawn by a hash of the key, so it does not depend on order or
    partitions.  Texts are counted where they are; the driver gets the counts
    that are not 0 of each sampled text, of some SAMPLE_IN_ALL texts and
    LANGUAGES languages at most, however many labels the table has.  Rows
    without text or language are left out.

    The least cosines come from the same texts, cut to several lengths: each
    half of them is measured against centroids of the other half.  So a text is
    judged by what texts of its length reach that the centroids have not seen.
    """
    good = rows.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.shiftrightunsigned(F.xxhash64(F.col(key_col).cast("string"), F.lit(11)), 11).alias("k"), F.col(text_col).alias("text")
    )
    sizes = rows.where(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    sizes = {r["lang"]: r["count"] for r in sizes.collect()}
    if not sizes:
        return Model.fit(np.zeros((0, DIMENSIONS), np.float32), [])
    drawn = F.lit(False)
    for lang, n in sorted(sizes.items()):
        drawn = drawn | ((F.col("lang") == lang) & (F.col("k") < F.lit(int(2**53 * min(1.0, min(sample, SAMPLE_IN_ALL // len(sizes)) / n)))))

    mine = good.where(drawn).select("lang", "text", F.col("k").bitwiseAND(1).cast("int").alias("half"))

    def count(batches):
        for batch in batches:
            for start in range(0, len(batch), 256):
                some = batch.slice(start, 256)
                found = [_sparse(x) for _, d, o in text_slices(some.column(1)) for x in grams(d, o)]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(2), pa.array(found, pa.binary())], names=["lang", "half", "counts"])

    got = sorted((r["lang"], bytes(r["counts"]), r["half"]) for r in mine.mapInArrow(giving_back(count), "lang string, half int, counts binary").collect())

    def fitted(rows: list[tuple]) -> Model:
        return Model.fit(_dense([r[1] for r in rows]), [r[0] for r in rows])

    model, halves = fitted(got), [fitted([r for r in got if r[2] == h]) for h in (0, 1)]
    shared = rows.sparkSession.sparkContext.broadcast([(m.idf, m.centroids, m.langs, m.least) for m in halves])

    def measure(batches):
        others = [Model(*m) for m in reversed(shared.value)]
        for batch in batches:
            langs, cosines = batch.column(0).to_pylist(), []
            for first, data, offsets in text_slices(batch.column(1)):
                for i in range(len(offsets) - 1):
                    half = batch.column(2)[first + i].as_py()
                    cosines.append(others[half].cosines(data[offsets[i] : offsets[i + 1]], langs[first + i]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cosines, pa.list_(pa.float64()))], names=["lang", "cosines"])

    found: dict[str, list[list[float]]] = {}
    for r in mine.mapInArrow(giving_back(measure), "lang string, cosines array<double>").collect():  # a few numbers a sampled text
        at = found.setdefault(r["lang"], [[] for _ in CUTS])
        for i, x in enumerate(r["cosines"]):
            at[i].append(x)
    model.accept(found)
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id_col, lang_pred, score, rejected, and the columns in ``keep``.

    A null text, or one without a letter, is ``und`` with score 0 and rejected.
    The whole text counts.  rejected also marks texts whose cosine with the
    nearest centroid is below the least that the language accepts at the text's
    length.  Columns not
    in keep are not looked at; an empty table gives an empty result; an empty
    model calls every text ``und``.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    parts = (model.idf, model.centroids, model.langs, model.least)
    shared = spark.sparkContext.broadcast(parts)  # its size is fixed by DIMENSIONS, CENTROIDS and the number of languages
    kinds = dict(docs.dtypes)
    names = [id_col, *(c for c in keep if c != id_col)]
    extra = [c for c in names if c != text_col]
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in names] + ["lang_pred string", "score double", "rejected boolean"])

    def run(batches):
        m = Model(*shared.value)
        for batch in batches:
            for start in range(0, len(batch), 1024):
                some = batch.slice(start, 1024)
                text = some.column(0)
                langs, scores, rejected = m.predict(text)
                by_name = {c: some.column(i + 1) for i, c in enumerate(extra)} | {text_col: text}
                yield pa.RecordBatch.from_arrays(
                    [*(by_name[c] for c in names), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                    names=[*names, "lang_pred", "score", "rejected"],
                )

    return docs.select(text_col, *extra).mapInArrow(giving_back(run), schema)


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4; fold 2 is held out of training."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 4
