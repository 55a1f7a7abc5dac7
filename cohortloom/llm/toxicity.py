"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

The model is fitted on SAMPLE labelled rows at most, drawn by a hash of the id. They are dealt by
a hash of the text into three parts: one learns the lexicons, the next trains the trees, the last
calibrates, so that none judges itself. The lexicons hold the words and
word beginnings that toxic texts bear far more often than others; they are bounded (LEXICON
entries each) and counted over all labelled rows of their part. The features of a text are
densities of the lexicons, how near second persons stand to them, and the rates of capitals,
punctuation and obfuscation, all over the whole text.

Nulls: a null text is empty, an empty text has all features zero and a score like any other; a
null label is not learned from. With labels of one class only the score is that class's share.
Repeated rows score alike, empty tables give no rows. Ties in the lexicons go to the lesser hash.
Input columns that bear the names of output columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from cohortloom.llm import bitmaps, tokens
from cohortloom.llm.staging import stage

# Labelled rows the model is fitted on (about; all of them where there are fewer).
SAMPLE = 200_000
# Bits of the map that keeps texts without a drawn label out of the join.
MAP_BITS = 1 << 22
LEXICON = 2000
LEAST_TEXTS = 3
LEAST_LOG_ODDS = 2.0
# Bytes of the word beginnings that are looked up besides whole words.
BEGINNINGS = (4, 5, 6, 7)
NEAR_WORDS = 5
# Second persons of four languages.
SECOND_PERSONS = (
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
    "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "usted", "ustedes", "ti", "tus",
)
FEATURES = (
    "strong_density", "strong_count", "strong_entries", "beginning_density", "beginning_count", "highest_odds",
    "second_person_density", "second_person_near", "capital_rate", "capital_word_rate", "exclamation_rate",
    "question_rate", "punctuation_rate", "obfuscation_rate", "digit_in_word_rate", "repeat_rate", "log_words",
)
_SECOND = tokens.word_hashes(
    np.frombuffer(" ".join(SECOND_PERSONS).encode(), np.uint8), np.array([0, len(" ".join(SECOND_PERSONS).encode())])
)[3]
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MASK = np.zeros(256, bool)
_MASK[list(b"*#@$%_")] = True


def _trimmed(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words without what is not a letter at their ends (``word***`` is ``word``)."""
    letter = _LETTER[low]
    n = len(low)
    at = np.arange(n)
    next_letter = np.minimum.accumulate(np.where(letter, at, n)[::-1])[::-1]
    last_letter = np.maximum.accumulate(np.where(letter, at, -1))
    begin = np.minimum(np.append(next_letter, n)[starts], ends)
    return begin, np.maximum(last_letter[ends - 1] + 1, begin)


def word_terms(low: np.ndarray, offsets: np.ndarray):
    """Word spans and rows, hashes of trimmed words and of their beginnings (0: shorter)."""
    starts, ends, rows = tokens.words(low, offsets)
    if not len(starts):
        empty = np.empty(0, np.uint64)
        return starts, ends, rows, empty, [empty] * len(BEGINNINGS)
    begin, end = _trimmed(low, starts, ends)
    prefix = tokens.prefix_hash(low)
    whole = np.where(end > begin, tokens.span_hash(prefix, begin, end), np.uint64(0))
    parts = []
    for n in BEGINNINGS:
        stop = np.minimum(begin + n, end)
        made = tokens.span_hash(prefix, begin, stop) ^ np.uint64(0x5DEECE66D)
        parts.append(np.where(end - begin > n, made, np.uint64(0)))
    return starts, ends, rows, whole, parts


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, kind, toxic, texts) of each batch: a text counts once for a term."""
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False)
        found = []
        for a, _, data, offsets in tokens.text_blocks(batch.column("text")):
            _, _, rows, whole, parts = word_terms(tokens.lower(data), offsets)
            for kind, terms in ((0, whole), *((1, p) for p in parts)):
                some = terms != 0
                pair = np.empty(some.sum(), [("row", np.int64), ("term", np.uint64)])
                pair["row"], pair["term"] = rows[some] + a, terms[some]
                pair = np.unique(pair)
                found.append((pair["term"], np.full(len(pair), kind), label[pair["row"]]))
        if not found:
            continue
        term, kind, toxic = (np.concatenate(x) for x in zip(*found))
        key = np.empty(len(term), [("term", np.uint64), ("kind", np.int8), ("toxic", np.int8)])
        key["term"], key["kind"], key["toxic"] = term, kind, toxic
        key, n = np.unique(key, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key["term"].view(np.int64)), pa.array(key["kind"].astype(np.int32)),
             pa.array(key["toxic"].astype(np.int32)), pa.array(n)], ["term", "kind", "toxic", "n"],
        )


@dataclass
class Lexicon:
    """Sorted hashes of words and of beginnings with their log odds."""

    words: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    word_odds: np.ndarray = field(default_factory=lambda: np.empty(0))
    beginnings: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    beginning_odds: np.ndarray = field(default_factory=lambda: np.empty(0))


def learn_lexicon(labelled: DataFrame) -> Lexicon:
    """Terms that toxic texts of ``labelled`` (text, label) bear far more often than others."""
    sizes = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Lexicon()
    counted = labelled.select("text", "label").mapInArrow(_term_counts, "term long, kind int, toxic int, n long")
    totals = counted.groupBy("term", "kind").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"),
    )
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    # What is left after two standard errors, so that rare terms need to be clear.
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    scored = totals.where(F.col("bad") >= LEAST_TEXTS).withColumn("odds", odds).where(F.col("odds") >= LEAST_LOG_ODDS)
    scored = stage(scored, "terms")
    made = []
    for kind in (0, 1):
        best = scored.where(F.col("kind") == kind).withColumn("sure", F.col("odds") - 2 * error).where("sure > 0")
        rows = best.orderBy(F.desc("sure"), "term").limit(LEXICON).collect()
        terms = np.array([r["term"] for r in rows], np.int64).view(np.uint64)
        order = np.argsort(terms)
        made += [terms[order], np.array([r["odds"] for r in rows], float)[order]]
    return Lexicon(*made)


def _look_up(terms: np.ndarray, known: np.ndarray, odds: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(terms))
    at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
    return np.where(known[at] == terms, odds[at], 0.0)


def features(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """Dense features of each row."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    low = tokens.lower(data)
    starts, ends, rows, whole, parts = word_terms(low, offsets)
    words = np.maximum(np.bincount(rows, minlength=n), 1)
    byte_row = np.repeat(np.arange(n), np.diff(offsets))

    def of_words(value: np.ndarray) -> np.ndarray:
        return np.bincount(rows, value, n)

    def of_bytes(mark: np.ndarray) -> np.ndarray:
        return np.bincount(byte_row[mark], minlength=n) / size

    word_odds = _look_up(whole, lexicon.words, lexicon.word_odds)
    part_odds = np.zeros(len(whole))
    for p in parts:
        part_odds = np.maximum(part_odds, _look_up(p, lexicon.beginnings, lexicon.beginning_odds))
    strong, begun = word_odds > 0, (part_odds > 0) & (word_odds == 0)
    highest = np.zeros(n)
    if len(rows):
        np.maximum.at(highest, rows, np.maximum(word_odds, part_odds))
    second = np.isin(whole, _SECOND)
    # A second person with a lexicon word at most NEAR_WORDS words away in the same text.
    hits = np.flatnonzero(strong | begun)
    near = np.zeros(len(whole), bool)
    if len(hits) and len(whole):
        at = np.arange(len(whole))
        after = np.minimum(np.searchsorted(hits, at), len(hits) - 1)
        for other in (hits[after], hits[np.maximum(after - 1, 0)]):
            near |= second & (np.abs(other - at) <= NEAR_WORDS) & (rows[other] == rows)
    pair = np.empty(strong.sum(), [("row", np.int64), ("term", np.uint64)])
    pair["row"], pair["term"] = rows[strong], whole[strong]
    entries = np.bincount(np.unique(pair)["row"], minlength=n)
    upper, digit, masked, letter = _UPPER[data], _DIGIT[data], _MASK[data], _LETTER[low]
    if len(data):
        beside = np.zeros(len(data), bool)
        beside[1:] = letter[:-1] & (byte_row[1:] == byte_row[:-1])
        repeat = np.zeros(len(data), bool)
        repeat[2:] = (low[2:] == low[1:-1]) & (low[2:] == low[:-2]) & letter[2:] & (low[2:] < 128)
        repeat[2:] &= byte_row[2:] == byte_row[:-2]
    else:
        beside = repeat = np.zeros(0, bool)
    upto = np.append(0, np.cumsum(upper))
    shouting = (upto[ends] - upto[starts] == ends - starts) & (ends - starts > 1)
    punctuation = (data > 32) & (data < 128) & ~_DIGIT[data] & ~letter
    columns = [
        of_words(strong) / words, of_words(strong), entries, of_words(begun) / words, of_words(begun), highest,
        of_words(second) / words, of_words(near), of_bytes(upper), of_words(shouting) / words,
        of_bytes(data == 33), of_bytes(data == 63), of_bytes(punctuation), of_bytes(masked & beside),
        of_bytes(digit & beside), of_bytes(repeat), np.log1p(np.where(np.diff(offsets) > 0, words, 0)),
    ]
    return np.stack([np.asarray(c, float) for c in columns], axis=1).reshape(n, len(FEATURES))


def with_features(docs: DataFrame, lexicon: Lexicon, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns of ``docs`` and ``features``."""
    narrow = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("_text"))
    schema = narrow.drop("_text").schema.add("features", ArrayType(DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tokens.text_blocks(batch.column(len(keep))):
                made = features(data, offsets, lexicon)
                bounds = np.arange(len(made) + 1, dtype=np.int32) * len(FEATURES)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(len(keep))),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(made.ravel()))],
                    [*keep, "features"],
                )

    return narrow.mapInArrow(run, schema)


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    share: float
    trees: object = None
    calibration: object = None

    def raw(self, featured: DataFrame) -> DataFrame:
        vector = featured.withColumn("vector", array_to_vector("features"))
        made = self.trees.transform(vector)
        return made.withColumn("raw", vector_to_array("probability")[1]).drop(
            "vector", "rawPrediction", "probability", "prediction", "features"
        )

    def score(self, docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
        """The ``keep`` columns with score and predicted."""
        keep = [c for c in keep if c not in ("score", "predicted")]
        if self.trees is None:
            scored = docs.select(*keep, F.lit(self.share).cast("double").alias("score"))
        else:
            raw = self.raw(with_features(docs, self.lexicon, keep, text))
            if self.calibration is not None:
                raw = self.calibration.transform(raw.withColumn("raw_vector", F.col("raw")))
                raw = raw.withColumn("raw", F.col("calibrated"))
            scored = raw.select(*keep, F.least(F.greatest("raw", F.lit(0.0)), F.lit(1.0)).alias("score"))
        return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def labelled_texts(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
                   label: str = "label", sample: int = SAMPLE, seed: int = 7) -> DataFrame:
    """(text, label) of the drawn labels; only texts that may have one are moved for the join."""
    drawn = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label"))
    drawn = drawn.where("id IS NOT NULL AND label IN (0, 1)").distinct()
    share = min(1.0, sample / max(1, drawn.count()))
    place = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_003)) / 1_000_003
    drawn = stage(drawn.where(place < share).withColumn("key", F.xxhash64("id")), "labels")
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    rows = rows.where(bitmaps.passes(bitmaps.build(drawn, "key", MAP_BITS), F.xxhash64("id")))
    # One plan at every size: labels grow with the documents.
    return rows.join(drawn.select("id", "label").hint("merge"), "id").select("text", "label")


def train(labelled: DataFrame, text: str = "text", label: str = "label", seed: int = 7) -> ToxicityModel:
    """Learn from all rows with a label of 0 or 1."""
    rows = labelled.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    rows = rows.where("label IN (0, 1)").withColumn("text", F.coalesce("text", F.lit("")))
    part = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(10))
    rows = stage(rows.withColumn("part", part), "labelled")
    counts = rows.agg(F.avg("label").alias("share"), F.count("*").alias("n")).first()
    share = counts["share"] or 0.0
    if share in (0.0, 1.0):
        return ToxicityModel(Lexicon(), share)
    lexicon = learn_lexicon(rows.where("part < 5"))
    featured = stage(with_features(rows.where("part >= 5"), lexicon, ["label", "part"]), "features")
    vectors = featured.withColumn("vector", array_to_vector("features")).withColumn("label", F.col("label").cast("double"))
    classes = {r["fit"]: r["k"] for r in vectors.groupBy((F.col("part") < 8).alias("fit")).agg(
        F.count_distinct("label").alias("k")).collect()}
    if classes.get(True, 0) < 2:
        return ToxicityModel(lexicon, share)
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.2, minInstancesPerNode=2, seed=seed
    ).fit(vectors.where("part < 8").select("vector", "label"))
    model = ToxicityModel(lexicon, share, trees)
    if classes.get(False, 0) == 2:
        # Scores in steps of a thousandth, so that the regression gets a bounded number of points.
        points = model.raw(featured.where("part >= 8")).withColumn("raw", F.round("raw", 3))
        points = points.groupBy("raw").agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("weight"))
        model.calibration = IsotonicRegression(
            featuresCol="raw_vector", labelCol="label", weightCol="weight", predictionCol="calibrated"
        ).fit(points.withColumn("raw_vector", F.col("raw")))
    return model
