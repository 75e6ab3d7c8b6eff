"""Scalar helpers: threshold labels and the date text of the documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.settings import DEFAULTS, Settings


def epoch_text(seconds: str | Column, settings: Settings = DEFAULTS) -> Column:
    """Epoch seconds -> ``MM/dd/yyyy HH:mm:ss`` in the session time zone."""
    c = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.date_format(F.timestamp_seconds(c), settings.date_format)


def stock_label(stock: str | Column, settings: Settings = DEFAULTS) -> Column:
    c = F.col(stock) if isinstance(stock, str) else stock
    return (F.when(c < F.lit(settings.stock_threshold), F.lit(settings.reorder_text))
             .otherwise(F.lit(settings.sufficient_text)))


def is_crowded(visitors: str | Column, threshold: int) -> Column:
    c = F.col(visitors) if isinstance(visitors, str) else visitors
    return c >= F.lit(threshold)


def jam_label(visitors: str | Column, threshold: int, settings: Settings = DEFAULTS) -> Column:
    return (F.when(is_crowded(visitors, threshold), F.lit(settings.offer_message))
             .otherwise(F.lit(settings.no_jam_text)))
