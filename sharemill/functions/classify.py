"""Expressions that turn names into labels, codes and group membership. All rules come in as data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sharemill.rules import RollUp


def parent_override(name: Column, parent: Column, value: str) -> Column:
    """``parent`` where it equals ``value`` exactly, else ``name``."""
    return F.when(parent == value, parent).otherwise(name)


def classify(name: Column, labels: Iterable[tuple[str, str]]) -> Column:
    """Label of the first LIKE pattern that the upper-cased name matches, else the name itself."""
    upper = F.upper(name)
    chain = F
    for pattern, label in labels:
        chain = chain.when(upper.like(pattern), F.lit(label))
    return name if chain is F else chain.otherwise(name)


def rolled_up(name: Column, genre: Column, rule: RollUp) -> Column:
    """Inside the rule's genre, the label of the list naming this member or the rule's fallback."""
    upper = F.upper(name)
    chain = F
    for label, members in rule.labels:
        chain = chain.when(upper.isin(*members), F.lit(label))
    label = F.lit(rule.otherwise) if chain is F else chain.otherwise(F.lit(rule.otherwise))
    return F.when(F.upper(genre) == rule.genre, label).otherwise(name)


def bucket_code(name: Column, buckets: Mapping[int, Iterable[str]]) -> Column:
    """Code of the list that holds the upper-cased name, NULL if none does."""
    upper = F.upper(name)
    chain = F
    for code, members in buckets.items():
        chain = chain.when(upper.isin(*members), F.lit(code))
    return F.lit(None).cast("int") if chain is F else chain


def in_names(name: Column, names: Iterable[str]) -> Column:
    """Whether the upper-cased name is one of ``names``."""
    return F.upper(name).isin(*names)


def has_prefix(name: Column, prefixes: Iterable[str]) -> Column:
    """Whether the upper-cased name starts with one of ``prefixes``."""
    upper = F.upper(name)
    test = F.lit(False)
    for prefix in prefixes:
        test = test | upper.startswith(prefix)
    return test
