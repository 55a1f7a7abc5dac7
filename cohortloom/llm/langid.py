"""Language identification by the nearest of several centroids per language.

A text becomes a normalised TF-IDF vector over hashed byte n-grams of the whole text. For each
language spherical k-means over a bounded, documented sample (the SAMPLE distinct texts of least
hash, so every language with a text has some) finds CLUSTERS starting centroids; one pass over all
training texts then gives every text to its nearest start and averages there, so the centroids
used cover all of them. A text is compared by cosine with
all centroids. Rejection is by distance: a second pass counts the best cosines of all training
texts, by the language they are nearest to and the number of their n-grams, and a text is rejected
if its own lies below what the share REJECTED of the training texts of that language and length do
not reach. Where texts are too few to tell that share, the limit is the least cosine
seen or what a normal distribution with their mean and deviation gives, whichever is lower. Texts
shorter than nearly all training texts have no limit.

Nulls: a null text, or one without a letter, is ``und`` with score 0 and rejected; a null
language is not learned from. Without any training text everything is ``und``. Ties go to the
language that sorts first. Repeated rows are treated alike, empty tables give no rows. Input
columns that bear the names of output columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import tokens

BINS = 4096
CLUSTERS = 3
# Distinct texts of one language that the starting centroids are found in (those of least hash).
SAMPLE = 400
ROUNDS = 8
REJECTED = 0.001
# Below its mean a normal distribution has the share REJECTED beyond so many deviations.
DEVIATIONS = 3.09
# Fewer texts than this of a language and length give no limit of their own.
FEW = 8
# Length classes: so many for a factor of two, since short texts have lower cosines.
PER_OCTAVE = 4
LENGTHS = 32 * PER_OCTAVE
UNKNOWN = "und"
COSINE_STEPS = 1000
# Sums of vectors are whole multiples of this, so that their order does not matter.
UNIT = 1.0 / (1 << 20)
BLOCK_ROWS = 256


def _letters_only() -> np.ndarray:
    """Bytes in lower case; digits, punctuation and control characters become a space."""
    out = tokens.lower(np.arange(256, dtype=np.uint8))
    plain = np.arange(256) < 128
    out[plain & ~((out >= 97) & (out <= 122))] = 32
    return out


_MAP = _letters_only()


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed counts of the byte bigrams, trigrams and tetragrams of each row."""
    n = len(offsets) - 1
    out = np.zeros((n, BINS), np.int64)
    if not len(data):
        return out
    text = _MAP[data].astype(np.uint32)
    row = np.repeat(np.arange(n), np.diff(offsets))
    code = text
    for size in (2, 3, 4):
        code = code[:-1] * np.uint32(256) + text[size - 1 :]
        if not len(code):
            break
        inside = (row[: len(code)] == row[size - 1 :]) & (code & np.uint32(0xFFFF) != 0x2020)
        bins = (code[inside] * np.uint32(2654435761) + np.uint32(size * 40503)) >> np.uint32(20)
        out += np.bincount(row[: len(code)][inside] * BINS + bins, minlength=n * BINS).reshape(n, BINS)
    return out


def has_letter(texts: list) -> np.ndarray:
    return np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], bool)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(counts, dtype=np.float32) * idf.astype(np.float32)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1e-12)


def length_class(counts: np.ndarray) -> np.ndarray:
    size = np.log2(np.maximum(counts.sum(axis=1), 1))
    return np.minimum((size * PER_OCTAVE).astype(np.int64), LENGTHS - 1)


def _row_blocks(column: pa.Array):
    """Blocks of few rows and bounded bytes, since a row takes BINS numbers."""
    data, offsets = tokens.text_bytes(column)
    for a, b in tokens.blocks(offsets):
        for first in range(a, b, BLOCK_ROWS):
            last = min(first + BLOCK_ROWS, b)
            yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


@dataclass
class LanguageModel:
    """What prediction needs; its size depends on the number of languages only."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    of: np.ndarray
    least: np.ndarray

    def cosines(self, counts: np.ndarray) -> np.ndarray:
        """The best cosine of each row with the centroids of each language."""
        cosine = vectors(counts, self.idf) @ self.centroids.T
        best = np.empty((len(counts), len(self.languages)), np.float32)
        for i in range(len(self.languages)):
            best[:, i] = cosine[:, self.of == i].max(axis=1)
        return best

    def predict(self, counts: np.ndarray, letters: np.ndarray):
        """(language, score, rejected) for each row."""
        n = len(counts)
        if not self.languages:
            return np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool)
        best = self.cosines(counts)
        which = best.argmax(axis=1)
        score = np.clip(best[np.arange(n), which].astype(np.float64), 0, 1)
        rejected = ~letters | (score < self.least[which, length_class(counts)])
        language = np.array(self.languages, object)[which]
        language[~letters] = UNKNOWN
        return language, np.where(letters, score, 0.0), rejected


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(BINS, np.int64), 0
    for batch in batches:
        for _, _, data, offsets in _row_blocks(batch.column("text")):
            counts = gram_counts(data, offsets)
            total += (counts > 0).sum(axis=0)
            rows += len(counts)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(some, -1)), pa.array(np.append(total[some], rows))], ["bin", "n"]
    )


def k_means(points: np.ndarray, clusters: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means from the points that are farthest apart."""
    chosen = [points.mean(axis=0)]
    while len(chosen) < min(clusters, len(points)) + 1:
        chosen.append(points[(points @ np.array(chosen).T).max(axis=1).argmin()])
    centres = np.array(chosen[1:])
    for _ in range(rounds):
        nearest = (points @ centres.T).argmax(axis=1)
        for i in range(len(centres)):
            if (nearest == i).any():
                centres[i] = points[nearest == i].mean(axis=0)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres


def _starts(sample: DataFrame, idf: np.ndarray, clusters: int) -> list:
    def find(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key")
        parts = [
            vectors(gram_counts(data, offsets), idf)
            for _, _, data, offsets in _row_blocks(pa.array(frame["text"], pa.string()))
        ]
        centres = k_means(np.concatenate(parts), clusters)
        return pd.DataFrame(
            {"lang": frame["lang"].iloc[0], "cluster": np.arange(len(centres)), "centre": [c.tolist() for c in centres]}
        )

    return sample.groupBy("lang").applyInPandas(find, "lang string, cluster int, centre array<float>").collect()


def _least_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per language: its SAMPLE least distinct keys of the task."""
    least: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, keys = batch.column("lang").dictionary_encode(), batch.column("key").to_numpy()
        at = langs.indices.to_numpy()
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            least[lang] = np.unique(np.append(least.get(lang, keys[:0]), keys[at == i]))[:SAMPLE]
    columns = [pa.array(list(least), pa.string()), pa.array(list(least.values()), pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays(columns, ["lang", "keys"])


def _sample(known: DataFrame) -> DataFrame:
    """The SAMPLE texts of least hash of each language; equal texts have one hash and count once."""
    keyed = known.select("lang", "text", F.xxhash64("text").alias("key"))
    least = keyed.select("lang", "key").mapInArrow(_least_keys, "lang string, keys array<long>")
    merged = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("keys")))), 1, SAMPLE)
    last = F.lit(None).cast("long")
    for r in least.groupBy("lang").agg(F.array_max(merged).alias("last")).collect():
        last = F.when(F.col("lang") == r["lang"], F.lit(r["last"])).otherwise(last)
    return keyed.where(F.col("key") <= last).dropDuplicates(["lang", "key"])


def _sums(languages: list[str], idf: np.ndarray, starts: np.ndarray, of: np.ndarray):
    """Partial sums of vectors by centroid and bin."""
    index = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(starts), BINS), np.int64)
        for batch in batches:
            langs = np.array([index[x] for x in batch.column("lang").to_pylist()])
            for a, b, data, offsets in _row_blocks(batch.column("text")):
                points = vectors(gram_counts(data, offsets), idf)
                cosine = np.where(of[None, :] == langs[a:b, None], points @ starts.T, -1)
                nearest = cosine.argmax(axis=1)
                whole = np.rint(points / UNIT).astype(np.int64)
                for i in np.unique(nearest):
                    total[i] += whole[nearest == i].sum(axis=0)
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "n"])

    return run


def _seen_cosines(model: LanguageModel):
    """Counts of training texts by nearest language and length (i) and by their best cosine (j)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(model.languages) * LENGTHS, COSINE_STEPS + 1), np.int64)
        for batch in batches:
            for _, _, data, offsets in _row_blocks(batch.column("text")):
                counts = gram_counts(data, offsets)
                best = model.cosines(counts)
                step = np.clip(best.max(axis=1) * COSINE_STEPS, 0, COSINE_STEPS).astype(np.int64)
                np.add.at(seen, (best.argmax(axis=1) * LENGTHS + length_class(counts), step), 1)
        i, j = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(seen[i, j])], ["i", "j", "n"])

    return run


def _table(known: DataFrame, run, rows: int, columns: int) -> np.ndarray:
    """The sums over all tasks of what ``run`` counts by row and column."""
    summed = known.mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((rows, columns))
    out[summed["i"], summed["j"]] = summed["n"]
    return out


def train(docs: DataFrame, lang: str = "lang", text: str = "text", clusters: int = CLUSTERS) -> LanguageModel:
    """Learn from all rows with a text and a language."""
    known = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    known = known.where("lang IS NOT NULL AND text IS NOT NULL")
    counted = known.select("text").mapInArrow(_document_frequency, "bin long, n long")
    df, rows = np.zeros(BINS), 0
    for r in counted.groupBy("bin").agg(F.sum("n").alias("n")).collect():
        if r["bin"] < 0:
            rows = r["n"]
        else:
            df[r["bin"]] = r["n"]
    idf = np.log((1 + rows) / (1 + df)) + 0.1
    found = sorted(_starts(_sample(known), idf, clusters), key=lambda r: (r["lang"], r["cluster"]))
    languages = sorted({r["lang"] for r in found})
    if not languages:
        return LanguageModel([], idf, np.zeros((0, BINS), np.float32), np.zeros(0, int), np.zeros((0, LENGTHS)))
    starts = np.array([r["centre"] for r in found], np.float32)
    of = np.array([languages.index(r["lang"]) for r in found])
    known = known.where(F.col("lang").isin(languages))
    centres = _table(known, _sums(languages, idf, starts, of), len(starts), BINS)
    centres = np.where(centres.any(axis=1, keepdims=True), centres, starts)
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    model = LanguageModel(languages, idf, centres.astype(np.float32), of, np.zeros((len(languages), LENGTHS)))
    seen = _table(known, _seen_cosines(model), len(languages) * LENGTHS, COSINE_STEPS + 1)
    model.least = _least_cosines(seen.reshape(len(languages), LENGTHS, COSINE_STEPS + 1))
    return model


def _limit(row: np.ndarray) -> float:
    """The cosine that the share REJECTED of the counted texts does not reach; NaN for too few."""
    n = row.sum()
    if n < FEW:
        return np.nan
    lowest = np.searchsorted(np.cumsum(row), REJECTED * n, side="right") / COSINE_STEPS
    if REJECTED * n >= 1:
        return lowest
    at = (np.arange(len(row)) + 0.5) / COSINE_STEPS
    mean = row @ at / n
    deviation = np.sqrt(row @ (at - mean) ** 2 / (n - 1))
    # Student's t for a further text, by its expansion in 1 / (n - 1): few texts give a wider limit.
    z, v = DEVIATIONS, n - 1
    t = z + (z**3 + z) / (4 * v) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * v**2)
    return min(lowest, mean - t * deviation * np.sqrt(1 + 1 / n))


def _least_cosines(seen: np.ndarray) -> np.ndarray:
    """The cosine below which a text of each language and length is rejected."""
    pooled = [_limit(row) for row in seen.sum(axis=0)]
    out = np.zeros(seen.shape[:2])
    for language, rows in enumerate(seen):
        for i, row in enumerate(rows):
            found = _limit(row)
            if np.isnan(found):
                # Too few: the limit of all languages, else of the next shorter length; these few stay.
                found = pooled[i] if not np.isnan(pooled[i]) else out[language, i - 1] if i else 0.0
                found = min([found, *(np.flatnonzero(row)[:1] / COSINE_STEPS)])
            out[language, i] = found
    return out


PREDICTED = ("lang_pred", "score", "rejected")


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected."""
    kept = [c for c in docs.columns if c not in PREDICTED]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            parts = [
                model.predict(gram_counts(data, offsets), has_letter(column.slice(a, b - a).to_pylist()))
                for a, b, data, offsets in _row_blocks(column)
            ]
            if not parts:
                continue
            lang, score, rejected = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                [*batch.schema.names, *PREDICTED],
            )

    for name, kind in zip(PREDICTED, ("string", "double", "boolean")):
        schema = schema.add(name, kind)
    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)

