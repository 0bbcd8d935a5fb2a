"""The cleaning plan: raw records in, clean records out."""

from pyspark.sql import DataFrame

from kerbside import contract as C
from kerbside.operators import conform, impute
from kerbside.session import stage


def prepare(raw: DataFrame) -> DataFrame:
    """Typed, standardised and labelled, but with nothing filled or dropped."""
    return (
        raw.transform(conform.cast_contract)
        .transform(conform.standardise_categories)
        .transform(conform.add_time_features)
        .transform(conform.add_severity)
    )


def deduplicate(raw: DataFrame) -> DataFrame:
    """Typed rows, first per id, with the required fields present.

    Exact copies share their id, so keeping the first per id removes them
    too: one shuffle does both.
    """
    return (
        raw.transform(conform.cast_contract)
        .transform(conform.keep_first)
        .transform(conform.drop_required_nulls)
        .transform(conform.standardise_categories)
    )


def clean(raw: DataFrame, slab_spreads=None, cut=stage) -> DataFrame:
    """Deduplicate, fill, cap, flag, parse times, derive severity.

    The deduplicated rows are scanned twice for statistics and once in the
    final pass, so they are written once (``cut``).
    """
    rows = cut(deduplicate(raw))
    # The categories are standardised by now, which bounds the (zone, type) pairs.
    return (
        impute.impute(rows, slab_spreads, keep_quartiles=True, pairs=C.MAX_ZONE_TYPE_GROUPS)
        .transform(impute.cap_values)
        .transform(impute.flag_fine_outliers)
        .transform(conform.add_time_features)
        .transform(conform.add_severity)
    )
