"""Quality: a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: its words, hashed into ``SLOTS`` places (the square roots of their counts, scaled to length
``WORDS``), statistics of its structure between 0 and 1, and what the table says about it (``n_chars``, where there is such a
column). The score is the logistic function of a bias, the weights of the features, and the products of the factors of
every two of them. The sum over all pairs is half of the square of the sum less the sum of the squares, for each factor,
so that scoring takes time in proportion to the words.

The machine is fitted by Spark on at most ``SAMPLE`` labelled rows, those with the smallest hash of their id. Rows whose
crc32(doc_id as text) mod 5 is 0 are held out from it. Language, source and id are not read.

Defined cases: null and empty texts have no words and statistics of 0, and get the score of such texts. Null labels do not
count; of several labels of one document the smallest holds; of several texts of one doc_id the smallest teaches. All rows
are scored, one by one; a null doc_id is not held out. Without labels of both kinds every score is 0 or 1 after the only kind
there is, or 1 without any.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.store import sample_tasks, settle, small_batches
from scriptorium.llm.words import slices, utf8, words_in

#: Labelled rows to learn from at most, and places that words are hashed to.
SAMPLE, SLOTS = 24_000, 4_096
#: Length of the part of a vector that words make; the statistics count for more.
WORDS = 0.3
FACTORS, ROUNDS, STEP, DECAY = 4, 60, 0.1, 0.02
THRESHOLD = 0.3

STATISTICS = (
    "log_words distinct_words repeated_words repeated_pairs mean_length long_words capitals shouted_words digits "
    "symbols signs_at_ends lone_signs commas full_stops line_words short_lines empty"
).split()
METADATA = "log_chars unstated_chars chars_differ".split()

_ALL = np.arange(256, dtype=np.uint8)
_SPACE = (_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13))
_UPPER = (_ALL >= 65) & (_ALL <= 90)
_LETTER = _UPPER | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)
_DIGIT = (_ALL >= 48) & (_ALL <= 57)
_SYMBOL = np.isin(_ALL, np.frombuffer(b"#$%&*+/<=>@\\^_`{|}~", np.uint8))
_SIGN = ~_SPACE & ~_LETTER & ~_DIGIT
_BEGINS = (_ALL & 0xC0) != 0x80  # first byte of a character


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document must not be learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def vectors(texts: pa.Array, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of all features that are not 0, by text; ``n_chars`` is what the table says, or nan."""
    data, offsets = utf8(texts)
    n = len(offsets) - 1
    words = words_in(data, offsets, inside=~_SPACE)
    letters = words_in(data, offsets, inside=_LETTER, lower=True)
    first = words.first
    n_words, n_letter_words = np.diff(first), np.diff(letters.first)
    some = np.maximum(1, n_words)

    # hashed words
    slot = (letters.code % np.uint64(SLOTS)).astype(np.int64)
    key, count = np.unique(letters.text * SLOTS + slot, return_counts=True)
    value = np.sqrt(count)
    norm = np.sqrt(np.bincount(key // SLOTS, weights=count, minlength=n))
    value = WORDS * value / norm[key // SLOTS]

    def sums(flags: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(flags)])
        return upto[offsets[1:]] - upto[offsets[:-1]]

    def per_word(table: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(table[data])])
        return upto[words.end] - upto[words.start]

    def counted(flags: np.ndarray) -> np.ndarray:
        return np.bincount(words.text[flags], minlength=n)

    same = np.zeros(len(words.code), bool)
    same[1:] = (words.code[1:] == words.code[:-1]) & (words.text[1:] == words.text[:-1])
    pairs = np.zeros(len(words.code), bool)
    pairs[2:] = (words.code[2:] == words.code[:-2]) & (words.text[2:] == words.text[:-2])
    order = np.lexsort((words.code, words.text))
    new = np.ones(len(order), bool)
    new[1:] = (words.code[order[1:]] != words.code[order[:-1]]) | (words.text[order[1:]] != words.text[order[:-1]])
    distinct = np.bincount(words.text[order[new]], minlength=n)
    n_letters, n_signs, n_capitals = per_word(_LETTER), per_word(_SIGN), per_word(_UPPER)
    characters = np.maximum(1, sums(_BEGINS[data]))
    all_letters = np.maximum(1, sums(_LETTER[data]))
    last = data[words.end - 1] if len(words.end) else data[:0]
    lines = np.maximum(1, sums(data == 10) + 1)
    statistics = [
        np.minimum(1, np.log1p(n_words) / 12),
        distinct / some,
        counted(same) / some,
        counted(pairs) / some,
        np.minimum(1, sums(~_SPACE[data]) / some / 20),
        counted(words.end - words.start > 20) / some,
        sums(_UPPER[data]) / all_letters,
        counted((n_letters > 1) & (n_capitals == n_letters)) / some,
        sums(_DIGIT[data]) / characters,
        np.minimum(1, 5 * sums(_SYMBOL[data]) / characters),
        counted((n_letters > 0) & (n_signs > 1) & _SIGN[last]) / some,
        counted((n_letters == 0) & (n_signs > 0)) / some,
        sums(data == ord(",")) / some,
        sums(data == ord(".")) / some,
        np.minimum(1, n_words / lines / 100),
        1 / (1 + n_words / lines),
        n_words == 0,
    ]
    stated = ~np.isnan(n_chars)
    chars = np.where(stated, np.maximum(0, n_chars), 0)
    metadata = [
        np.minimum(1, np.log1p(chars) / 16),
        ~stated,
        stated & (np.abs(chars - sums(_BEGINS[data])) > 0.01 * characters),
    ]
    dense = np.minimum(1, np.stack([*statistics, *metadata], axis=1).astype(np.float64))
    text, column = np.nonzero(dense)
    text = np.concatenate([key // SLOTS, text])
    feature = np.concatenate([key % SLOTS, SLOTS + column])
    value = np.concatenate([value, dense[dense != 0]])
    order = np.lexsort((feature, text))
    return text[order], feature[order], value[order]


def _stated(rows: DataFrame) -> Column:
    """The table's own count of characters, null where there is none."""
    return F.col("n_chars").cast("double") if "n_chars" in rows.columns else F.lit(None).cast("double")


def _chars(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.float64)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vector of each labelled row, as lists."""
    for batch in batches:
        for part in slices(batch, "text"):
            text, feature, value = vectors(part.column("text"), _chars(part.column("n_chars")))
            cuts = pa.array(np.searchsorted(text, np.arange(len(part) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("good").cast(pa.float64()),
                    pa.ListArray.from_arrays(cuts, pa.array(feature, pa.int32())),
                    pa.ListArray.from_arrays(cuts, pa.array(value)),
                ],
                ["good", "feature", "value"],
            )


@dataclass
class Machine:
    """Bias, weights and factors of all features."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, n: int, text: np.ndarray, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Chance of label 1 of n texts, from their features in order."""
        raw = self.bias + np.bincount(text, weights=self.weights[feature] * value, minlength=n)
        for factor in self.factors.T:
            part = factor[feature] * value
            both = np.bincount(text, weights=part, minlength=n) ** 2 - np.bincount(text, weights=part * part, minlength=n)
            raw += 0.5 * both
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """A machine learned from labelled rows that are not held out; ``labels`` has doc_id and quality."""
    small_batches(docs.sparkSession)
    size = SLOTS + len(STATISTICS) + len(METADATA)
    usable = labels.filter("quality is not null and doc_id is not null").filter(~held_out())
    usable = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("good"))
    # the smallest hashes: a top-k of each task, at most `sample` rows in all, so broadcasting is bounded
    chosen = settle(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "chosen")
    rows = docs.select("doc_id", F.struct(F.coalesce("text", F.lit("")).alias("text"), _stated(docs).alias("n_chars")).alias("d"))
    taught = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("d").alias("d"), F.min("good").alias("good"))
    few = taught.select("d.text", "d.n_chars", "good").coalesce(sample_tasks(sample))
    lists = few.mapInArrow(_sparse, "good double, feature array<int>, value array<double>")
    lists = settle(lists, "taught")
    kinds = [r.good for r in lists.select("good").distinct().collect()]
    if len(kinds) < 2:
        return Machine(50.0 if kinds != [0.0] else -50.0, np.zeros(size), np.zeros((size, 0)))
    vector = F.udf(lambda f, v: SparseVector(size, f, v), VectorUDT())
    known = lists.select("good", vector("feature", "value").alias("known"))
    known = settle(known.repartition(max(1, min(6, sample // 2_000))), "known")
    machine = FMClassifier(
        featuresCol="known", labelCol="good", factorSize=FACTORS, maxIter=ROUNDS, stepSize=STEP, regParam=DECAY, initStd=0.05, seed=5
    ).fit(known)
    return Machine(machine.intercept, machine.linear.toArray(), machine.factors.toArray())


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``row`` (a struct of all columns of docs) and ``score``, the chance of label 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ["row", "text", "n_chars"]
            whole = pa.RecordBatch.from_arrays([batch.column("row"), batch.column("row").field("text"), batch.column("n_chars")], names)
            for part in slices(whole, "text"):
                found = vectors(part.column("text"), _chars(part.column("n_chars")))
                made = [part.column("row"), pa.array(machine.score(len(part), *found))]
                yield pa.RecordBatch.from_arrays(made, ["row", "score"])

    small_batches(docs.sparkSession)
    packed = docs.select(F.struct(*docs.columns).alias("row"), _stated(docs).alias("n_chars"))
    return packed.mapInArrow(run, f"row {packed.schema['row'].dataType.simpleString()}, score double")
