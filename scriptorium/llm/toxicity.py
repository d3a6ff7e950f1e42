"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features of a whole text: densities of a fixed and of a learned word list, listed words near a second-person word,
capitals, punctuation, symbols, and how often words are obfuscated. The learned list, the trees and the calibration
come from labelled rows; at most ``SAMPLE`` of them, those with the smallest hash of their id, are used. A quarter of
these calibrates, the rest teaches. Rows whose crc32(doc_id as text) mod 3 is 1 are held out from all of it.

Defined cases: null and empty texts have all features 0 and get the score of such texts. Labels that are null do not
count; of several labels of one document the largest holds. Rows that repeat a doc_id are scored one by one; a null doc_id
is not held out. Without labels of both kinds every score is 0 or 1 after the only kind there is, or 0 without any.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.store import sample_tasks, settle, small_batches
from scriptorium.llm.words import Words, slices, utf8, words_in, words_of
from scriptorium.llm.worker import lean

#: Labelled rows to learn from at most, and words of the learned list.
SAMPLE, LEARNED = 24_000, 200
THRESHOLD = 0.7
#: Rows that the trees' own chances count for in the calibration, and the places they are spread over.
PRIOR, PRIOR_STEPS = 20.0, 40
#: Words on either side that count as near.
NEAR = 3

# Insults and second-person words.
INSULTS = (
    "idiot idiots stupid moron morons dumb loser losers trash garbage pathetic worthless disgusting scum clown "
    "fool filth filthy ugly hate jerk creep pig vermin imbecile dimwit "
    "dumm dummkopf trottel abschaum versager widerlich "
    "imbécile crétin débile ordure minable "
    "idiota estúpido imbécil basura asqueroso patético"
).split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes".split()
# Signs that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

FEATURES = (
    "log_words insult_density insult_any learned_density learned_any learned_share hidden_density hidden_any "
    "near_second_person second_person capital_rate shouted_rate exclamation_rate question_rate comma_rate "
    "symbol_rate digit_rate obfuscated_rate"
).split()

_ALL = np.arange(256, dtype=np.uint8)
_UPPER = (_ALL >= 65) & (_ALL <= 90)
_LETTER = _UPPER | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)
_DIGIT = (_ALL >= 48) & (_ALL <= 57)
_SYMBOL = np.isin(_ALL, np.frombuffer(b"@$*#%&^~_+=|<>", np.uint8))
_DISGUISE = _DIGIT | _SYMBOL | np.isin(_ALL, np.frombuffer(b"!.-", np.uint8))
_SPACE = (_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13))
_PLAIN = _ALL.copy()
for _sign, _letter in LOOKALIKES.items():
    _PLAIN[ord(_sign)] = ord(_letter)


def _codes(listed: list[str]) -> np.ndarray:
    return np.sort(words_of(pa.array([" ".join(listed)]), lower=True).code)


def _listed(codes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(codes), bool)
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    return known[at] == codes


def _per_text(words: Words, flags: np.ndarray) -> np.ndarray:
    return np.bincount(words.text[flags], minlength=words.n_texts)


def letter_words(texts: pa.Array) -> Words:
    """Runs of letters, A-Z in lower case."""
    return words_in(*utf8(texts), inside=_LETTER, lower=True)


def features(texts: pa.Array, learned: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    data, offsets = utf8(texts)
    words = letter_words(texts)
    insults, seconds = _codes(INSULTS), _codes(SECOND_PERSON)
    n_words = np.diff(words.first)
    insult, known, you = (_listed(words.code, c) for c in (insults, learned, seconds))
    either = insult | known
    near = np.zeros(len(you), bool)
    for step in range(1, NEAR + 1):
        same = words.text[step:] == words.text[:-step] if step < len(you) else np.zeros(0, bool)
        near[step:][: len(same)] |= you[: len(same)] & same
        near[: len(same)] |= you[step:] & same if len(same) else False

    # words with look-alike signs read as letters and other signs left out
    keep = _LETTER[_PLAIN[data]] | _SPACE[data]
    kept = np.concatenate([[0], np.cumsum(keep)])
    plain = words_in(_PLAIN[data][keep], kept[offsets], inside=_LETTER, lower=True)
    unveiled = _per_text(plain, _listed(plain.code, insults) | _listed(plain.code, learned))

    raw = words_in(data, offsets, inside=~_SPACE)
    last = np.maximum(raw.end - 1, raw.start)

    def within(table, end=raw.end):
        upto = np.concatenate([[0], np.cumsum(table[data])])
        return upto[end] - upto[raw.start]

    letters = within(_LETTER)
    obfuscated = (letters > 1) & (within(_DISGUISE, last) > 0) & _LETTER[data[raw.start]] if len(raw.start) else np.zeros(0, bool)
    shouted = (letters > 2) & (within(_UPPER) == letters)

    def share(table, of=None):
        upto = np.concatenate([[0], np.cumsum(table[data])])
        count = upto[offsets[1:]] - upto[offsets[:-1]]
        return count / np.maximum(1, np.diff(offsets) if of is None else of)

    n_letters = share(_LETTER, np.ones(len(texts)))
    some = np.maximum(1, n_words)
    n_raw = np.maximum(1, np.diff(raw.first))
    n_insult, n_known, n_either = (_per_text(words, f) for f in (insult, known, either))
    hidden = np.maximum(0, unveiled - n_either)
    signs = [share(_ALL == ord(c)) for c in "!?,"]
    columns = [
        np.log1p(n_words),
        n_insult / some,
        np.minimum(n_insult, 5),
        n_known / some,
        np.minimum(n_known, 5),
        n_known / np.maximum(1, n_known + n_insult),
        hidden / some,
        np.minimum(hidden, 5),
        _per_text(words, either & near) / some,
        _per_text(words, you) / some,
        share(_UPPER, np.maximum(1, n_letters)),
        _per_text(raw, shouted) / n_raw,
        *signs,
        share(_SYMBOL),
        share(_DIGIT),
        _per_text(raw, obfuscated) / n_raw,
    ]
    return np.stack(columns, axis=1).astype(np.float64)


def _word_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, toxic): the distinct words of each text."""
    for batch in batches:
        for part in slices(batch, "text"):
            words = letter_words(part.column("text"))
            pairs = np.unique(np.stack([words.text.astype(np.uint64), words.code], axis=1), axis=0)
            toxic = part.column("toxic").to_numpy(zero_copy_only=False)[pairs[:, 0].astype(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 1].view(np.int64).copy()), pa.array(toxic, pa.int32())], ["code", "toxic"]
            )


def with_features(rows: DataFrame, learned: list[int]) -> DataFrame:
    """``row`` (a struct of all columns) and the features of ``text``."""
    known = np.sort(np.array(learned, np.int64).view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field("text")
            for part in slices(pa.RecordBatch.from_arrays([batch.column("row"), texts], ["row", "text"]), "text"):
                made = features(part.column("text"), known)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), *(pa.array(c) for c in made.T.copy())], ["row", *FEATURES]
                )

    packed = rows.select(F.struct(*rows.columns).alias("row"))
    kind = packed.schema["row"].dataType.simpleString()
    return packed.mapInArrow(lean(run), f"row {kind}, " + ", ".join(f"{c} double" for c in FEATURES))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document must not be learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


class Model:
    """Word list, trees and calibration learned from a bounded sample of labelled documents."""

    def __init__(self, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
        small_batches(docs.sparkSession)
        usable = labels.filter("toxic is not null and doc_id is not null").filter(~held_out())
        usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        # the smallest hashes: a top-k of each task, at most `sample` rows in all, so broadcasting is bounded
        chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        taught = docs.select("doc_id", "text").join(F.broadcast(settle(chosen, "chosen")), "doc_id")
        taught = settle(taught.dropDuplicates(["doc_id"]).coalesce(sample_tasks(sample)), "taught")
        counts = {r["toxic"]: r["n"] for r in taught.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        self.constant = float(max(counts, default=0)) if len(counts) < 2 else None
        if self.constant is not None:
            return
        one, zero = counts.get(1, 0), counts.get(0, 0)
        told = taught.mapInArrow(lean(_word_codes), "code long, toxic int").groupBy("code").agg(
            F.sum("toxic").alias("a"), F.count("*").alias("n")
        )
        odds = F.log(((F.col("a") + 0.5) / (one + 1)) / ((F.col("n") - F.col("a") + 0.5) / (zero + 1)))
        listed = told.filter(F.col("a") >= max(3, one // 200)).withColumn("odds", odds).filter("odds > 2")
        listed = listed.orderBy(F.desc(F.col("odds") * F.log1p("a")), "code").limit(LEARNED)
        self.learned = [r["code"] for r in listed.select("code").collect()]
        known = with_features(taught, self.learned).select("row.toxic", "row.doc_id", *FEATURES)
        known = known.withColumn("fits", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) != 0)
        known = settle(known.coalesce(4), "known")
        self.assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
        known = self.assembler.transform(known)
        trees = GBTClassifier(
            featuresCol="_features", labelCol="toxic", maxIter=20, maxDepth=4, stepSize=0.2, minInstancesPerNode=10, seed=11
        )
        self.trees = trees.fit(known.filter("fits"))
        rest = self._raw_score(known.filter(~F.col("fits"))).select(F.col("toxic").cast("double").alias("toxic"), "_score", F.lit(1.0).alias("_weight"))
        # the trees' own chances, spread evenly, which few rows do not outweigh
        even = docs.sparkSession.range(PRIOR_STEPS + 1).select((F.col("id") / PRIOR_STEPS).alias("_score"))
        prior = even.select(F.col("_score").alias("toxic"), "_score", F.lit(PRIOR / (PRIOR_STEPS + 1)).alias("_weight"))
        self.calibration = IsotonicRegression(
            featuresCol="_score", labelCol="toxic", weightCol="_weight", predictionCol="_calibrated"
        ).fit(rest.union(prior).coalesce(1))

    def _raw_score(self, rows: DataFrame) -> DataFrame:
        return self.trees.transform(rows).withColumn("_score", vector_to_array("probability")[1])

    def score(self, docs: DataFrame) -> DataFrame:
        """``row`` (a struct of all columns of docs) and ``score``."""
        if self.constant is not None:
            return docs.select(F.struct(*docs.columns).alias("row"), F.lit(self.constant).alias("score"))
        known = with_features(docs, self.learned)
        scored = self.calibration.transform(self._raw_score(self.assembler.transform(known)))
        return scored.select("row", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "_calibrated")).alias("score"))
