"""Quantity texts such as ``1``, ``2-10`` and ``Over 100``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import OPEN_RANGE_MAX

# The accepted forms.
QUANTITY_FORMS = r"\A(?:Over \d+|\d+-\d+|\d+)\z"
OPEN_PREFIX = "Over "


def parse_quantity(text: Column, open_range_max: int = OPEN_RANGE_MAX) -> tuple[Column, Column]:
    """(min, max) of a quantity text; both null when it is empty or malformed."""
    is_open = text.startswith(OPEN_PREFIX)
    well_formed = text.rlike(QUANTITY_FORMS)
    first = F.substring_index(F.replace(text, F.lit(OPEN_PREFIX), F.lit("")), "-", 1).try_cast("int")
    last = F.when(is_open, F.lit(open_range_max)).otherwise(F.substring_index(text, "-", -1).try_cast("int"))
    # a number too large for int makes the text malformed, too
    return F.when(well_formed & last.isNotNull(), first), F.when(well_formed & first.isNotNull(), last)


def mean_quantity(low: Column, high: Column) -> Column:
    """Integer mean of the bounds as bigint, rounded toward zero; widened first so that it cannot overflow."""
    return F.call_function("div", low.cast("bigint") + high.cast("bigint"), F.lit(2).cast("bigint"))
