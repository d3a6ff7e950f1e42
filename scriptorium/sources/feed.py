"""Atom feed files to bronze rows.

The network fetch is not part of this package: feed responses are landed as files and read from there.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions.text import strip, strip_or_empty
from scriptorium.sources.atom import read_atom
from scriptorium.sources.positions import RANGE_ROWS, Ranked

# The record source and the categories of the feed.
SOURCE = "arxiv"
CATEGORIES = ("cs.AI", "cs.CL", "cs.LG")


@dataclass(frozen=True)
class Scale:
    page_size: int
    pages: int

    @property
    def rows(self) -> int:
        return self.page_size * self.pages


# Row budget of a run.
SCALES = {
    "smoke": Scale(page_size=5, pages=1),
    "test": Scale(page_size=20, pages=1),
    "full": Scale(page_size=100, pages=2),
}
DEFAULT_SCALE = "full"
SCALE_VARIABLE = "SCRIPTORIUM_SCALE"


def resolve_scale(
    conf: Mapping | None = None,
    params: Mapping | None = None,
    environ: Mapping[str, str] | None = None,
    variable: str = SCALE_VARIABLE,
) -> str:
    """Name of the scale: run settings first, then the environment, then defaults of the job.

    Names are stripped and lower-cased; one that is not known counts as the default.
    """
    environ = os.environ if environ is None else environ
    candidates = (
        conf.get("scale") if isinstance(conf, Mapping) else None,
        (environ.get(variable) or "").strip(),
        params.get("scale") if isinstance(params, Mapping) else None,
    )
    chosen = next((c for c in candidates if c), DEFAULT_SCALE)
    name = chosen.strip().lower() if isinstance(chosen, str) else None
    return name if name in SCALES else DEFAULT_SCALE


def resolved_scale(conf: Column, env: Column, params: Column) -> Column:
    """Scale names of a table of runs, by the rules of :func:`resolve_scale`."""
    first = F.coalesce(F.nullif(conf, F.lit("")), F.nullif(strip(env), F.lit("")), F.nullif(params, F.lit("")))
    name = F.lower(strip(first))
    return F.when(name.isin(list(SCALES)), name).otherwise(DEFAULT_SCALE)


def scale_rows(name: Column) -> Column:
    """Row budget of a known scale."""
    return F.coalesce(*[F.when(name == scale, F.lit(s.rows)) for scale, s in SCALES.items()])


def read_feed(
    spark: SparkSession, path: str | Sequence[str], categories: Sequence[str] | None = None
) -> DataFrame:
    """Entries of landed Atom files, one row each; a file that is not one whole document fails the read.

    With ``categories`` the entries filed under none of them are skipped while parsing.
    """
    return read_atom(spark, [path] if isinstance(path, str) else list(path), categories)


def newest_first() -> list[Column]:
    """Feed order. The id breaks ties, so that pages do not depend on the file layout."""
    return [F.col("published").desc_nulls_last(), F.col("id").asc_nulls_last()]


def in_categories(entries: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Entries filed under at least one of ``categories``."""
    terms = F.transform("category", lambda c: c["_term"])
    return entries.where(F.arrays_overlap(terms, F.array(*map(F.lit, categories))))


def feed_page(
    entries: DataFrame, page: int, page_size: int, categories: Sequence[str] = CATEGORIES
) -> DataFrame:
    """One page of the feed, counted from zero; empty past the end.

    All earlier rows pass through the task that merges; for pages far down take :func:`feed_index`.
    """
    return (
        in_categories(entries, categories)
        .orderBy(*newest_first())
        .offset(page * page_size)
        .limit(page_size)
    )


def feed_window(
    entries: DataFrame, scale: str = DEFAULT_SCALE, categories: Sequence[str] = CATEGORIES
) -> DataFrame:
    """All pages of a run. Pages are contiguous, so they are the first ``pages * page_size`` entries."""
    return in_categories(entries, categories).orderBy(*newest_first()).limit(SCALES[scale].rows)


def feed_index(
    entries: DataFrame,
    path: str,
    categories: Sequence[str] = CATEGORIES,
    range_rows: int = RANGE_ROWS,
) -> Ranked:
    """The feed stored by ranges of its order: ``stretch(page * page_size, page_size)`` reads any page from its range."""
    return Ranked(in_categories(entries, categories), newest_first(), path, range_rows)


def to_bronze(entries: DataFrame, process_date: str | Column, run_id: str = "manual") -> DataFrame:
    """Bronze records: stripped fields, an empty string for a missing element, authors in feed order."""
    day = F.lit(process_date) if isinstance(process_date, str) else process_date
    authors = F.transform("author", lambda a: strip_or_empty(a["name"]))
    return entries.select(
        F.lit(SOURCE).alias("source"),
        strip_or_empty(F.col("id")).alias("url"),
        strip_or_empty(F.col("title")).alias("title"),
        strip_or_empty(F.col("summary")).alias("content"),
        F.coalesce(authors, F.array().cast("array<string>")).alias("authors"),
        strip_or_empty(F.col("published")).alias("published_at"),
        strip_or_empty(F.col("updated")).alias("updated_at"),
        day.alias("process_date"),
        F.lit(run_id).alias("run_id"),
    )
