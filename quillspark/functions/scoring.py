"""Scores of the discovery ranking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.ids import plain_title


def keyword_score(text: Column, keywords: list[str]) -> Column:
    """Share of the keywords that the text holds; a half without keywords."""
    if not keywords:
        return F.lit(0.5)
    hay = plain_title(text)
    hits = [F.when(F.contains(hay, plain_title(F.lit(k))), 1).otherwise(0) for k in keywords]
    return sum(hits[1:], hits[0]) / F.lit(float(len(keywords)))


def citation_score(count: Column) -> Column:
    return F.when(count > 0, F.least(F.lit(1.0), F.log10(count + 1) / 4)).otherwise(0.0)


def recency_score(year: Column, start: int, end: int) -> Column:
    """Place of the year between the two bounds, in either order; a quarter if it is null."""
    low, high = min(start, end), max(start, end)
    return F.when(year.isNull(), 0.25).otherwise((F.greatest(F.lit(low), F.least(F.lit(high), year)) - low) / max(1, high - low))


def seed_score(distance: Column) -> Column:
    return F.when(distance.isNull(), 0.0).when(distance == 0, 1.0).when(distance == 1, 0.7).when(distance == 2, 0.4).otherwise(0.1)


def relevance(keyword: Column, seed: Column, recency: Column, citation: Column) -> Column:
    return F.round(0.3 * keyword + 0.3 * seed + 0.2 * recency + 0.2 * citation, 4)


def token_estimate(text: Column) -> Column:
    return F.floor(F.length(text) / 4)


def overlap_threshold(n: Column) -> Column:
    """How many tokens must be shared: half of them, two at least and four at most."""
    return F.greatest(F.lit(2), F.least(F.lit(4), F.floor(n / 2).cast("int")))
