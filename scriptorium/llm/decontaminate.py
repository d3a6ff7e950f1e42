"""Benchmark decontamination by winnowing, in DataFrame operations only.

Texts become words (A-Z lower-cased, ASCII other than letters and digits separates). A window of an item is
``window`` consecutive words, or all words of an item that has fewer. Steps:

1. **Fingerprints.** Of the ``GRAM``-word hashes in each run of ``window - GRAM + 1``, the smallest is a fingerprint,
   so any span of ``window`` words that a document and an item share gives both the same one. Items with fewer
   words add one fingerprint, and documents then also give all hashes of those (at most ``window - 1``) lengths.
2. **Join.** Distinct fingerprints of a document meet those of the items; documents that meet none are clean. The
   items' fingerprints are a written table, so Spark broadcasts them only if they are small.
3. **Extend.** The windows of the remaining documents are compared with the items' windows as word sequences, which
   gives every occurrence and no other. Equal items count as one until their ids are listed.

What a document holds depends on its text alone, so the text's digest stands for it in all steps and ids are only carried.

Defined cases: null, empty and wordless texts have no windows. Rows with the same text get the same result, whatever their
doc_id and whether they have one. Items without item_id are looked for like all others; only their id is not
listed. An empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.store import settle

WINDOW = 10
#: Words of a fingerprint's hash.
GRAM = 5

_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str | Column) -> Column:
    """Words of a text, A-Z in lower case; other letters keep theirs."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    # lower() is much faster, but right only if there is no upper-case letter besides A-Z
    other_capitals = text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]")
    lowered = F.when(other_capitals, F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(lowered.otherwise(F.lower(text)), _SEPARATOR), "")


def _runs(w: Column, length: int, make) -> Column:
    """make(index) for the first index of each run of ``length`` elements."""
    last = F.size(w) - length
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), make)).otherwise(F.array())


def _hashes(w: Column, length: int) -> Column:
    return _runs(w, length, lambda i: F.xxhash64(F.lit(length), *[F.get(w, i + j) for j in range(length)]))


def _fingerprints(rows: DataFrame, window: int, short: list[int]) -> DataFrame:
    """(…, print): fingerprints of the array column ``w``, those of short lengths included."""
    gram = min(GRAM, window)
    span = window - gram + 1
    hashed = rows.withColumn("h", _hashes(F.col("w"), gram))
    if span > 1:
        least = _runs(F.col("h"), span, lambda i: F.least(*[F.get(F.col("h"), i + j) for j in range(span)]))
    else:
        least = F.col("h")
    prints = F.concat(least, *[_hashes(F.col("w"), n) for n in short])
    return hashed.select(*[c for c in rows.columns if c != "w"], F.explode(F.array_distinct(prints)).alias("print"))


def searched(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """For every row ``row`` (a struct of the ``keep`` columns), ``n_words``, ``n_hit``, ``spans`` and ``items``.

    ``spans`` are (first word, number of words) of the occurrences, ``items`` the sorted ids of the items found.
    """
    items = benchmark.select("item_id", words("text").alias("w")).filter("size(w) > 0")
    bodies = items.select("item_id", "w", F.array_join("w", " ").alias("body"))
    classes = bodies.groupBy("body").agg(F.first("w").alias("w")).withColumn("item", F.monotonically_increasing_id())
    classes = settle(classes, "items")
    members = bodies.filter("item_id is not null").select("item_id", "body").distinct().join(classes.select("body", "item"), "body").drop("body")
    lengths = classes.select(F.size("w").alias("n")).filter(F.col("n") < window).distinct()
    short = sorted(r["n"] for r in lengths.collect())  # fewer than window values

    # a short code finds the suspects; the few texts that share one are told apart by their digest
    code, digest = F.xxhash64("text"), F.sha2("text", 256)
    known = docs.filter("text is not null").select("text")
    of_items = _fingerprints(classes.select("w"), window, short).distinct()
    found = (
        _fingerprints(known.select(code.alias("code"), words("text").alias("w")), window, short)
        .join(settle(of_items, "prints"), "print", "left_semi")
        .select("code")
        .distinct()
    )
    suspects = known.withColumn("code", code).join(settle(found, "suspects"), "code").select(digest.alias("digest"), words("text").alias("w"))

    def run_of(n: int):
        body = lambda i: F.array_join(F.slice("w", i + 1, n), " ")
        return lambda i: F.struct(i.alias("start"), F.lit(n).alias("n"), body(i).alias("body"))

    def spelled(rows: DataFrame, lengths: list[int]) -> DataFrame:
        """(…, start, n, body) of every run of the given lengths."""
        runs = F.concat(*[_runs(F.col("w"), n, run_of(n)) for n in lengths])
        return rows.withColumn("run", F.explode(runs)).select(*[c for c in rows.columns if c != "w"], "run.*")

    long_items = spelled(classes.filter(F.size("w") >= window).select("item", "w"), [window])
    windows = long_items.select("item", "body").union(classes.filter(F.size("w") < window).select("item", "body"))
    hits = spelled(suspects, [window, *short]).join(settle(windows.distinct(), "windows"), "body").select("digest", "start", "n", "item")
    hits = settle(hits.distinct(), "hits")
    spans = hits.groupBy("digest").agg(F.array_sort(F.collect_set(F.struct("start", "n"))).alias("spans"))
    listed = hits.select("digest", "item").distinct().join(members, "item", "left")
    listed = listed.groupBy("digest").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda done, s: F.struct(
            F.greatest(done["end"], s["start"] + s["n"]).alias("end"),
            (done["n"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(done["end"], s["start"]))).alias("n"),
        ),
        lambda done: done["n"],
    )
    per_text = spans.join(listed, "digest").select("digest", covered.alias("n_hit"), "spans", "items")
    per_text = settle(per_text, "found")
    told = docs.select(F.struct(*keep).alias("row"), F.size(words("text")).alias("n_words"), digest.alias("digest"))
    return told.join(per_text, "digest", "left").select(
        "row",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        "spans",
        "items",
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items) of every document, as :func:`searched` finds them."""
    return searched(docs, benchmark, window).select("row.doc_id", "n_words", "n_hit", "spans", "items")
