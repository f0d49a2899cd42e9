"""A table as it stood at an earlier instant, rebuilt from kept row versions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadledger.functions.windows import instant
from loadledger.operators.latest import latest


def as_of(
    df: DataFrame, keys: Sequence[str], versioned_by: Sequence[str], moment: datetime
) -> DataFrame:
    """The newest version of each key written at or before ``moment``.

    The first column of ``versioned_by`` is the version's time; the rest break ties. Only versions
    still kept can be found: a row that was overwritten in place is lost to this read.
    """
    past = df.where(F.col(versioned_by[0]) <= instant(moment))
    return latest(past, keys, versioned_by)
