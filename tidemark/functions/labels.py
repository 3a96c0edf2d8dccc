"""Readable label composed from dimension texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators of the label "sector, measure (duration), class, seasonal".
LABEL_SEPARATOR = ", "
LABEL_TEXT_COLUMNS = ("sector_name", "measure_text", "class_text", "duration_text", "seasonal_text")


def compose_label(
    sector: str = "sector_name",
    measure: str = "measure_text",
    duration: str = "duration_text",
    class_: str = "class_text",
    seasonal: str = "seasonal_text",
) -> Column:
    """``sector, measure (duration), class, seasonal``.

    NULL parts are skipped; the ``measure (duration)`` part disappears when
    either of its two texts is NULL; all parts NULL gives ''.
    """
    measure_part = F.concat(F.col(measure), F.lit(" ("), F.col(duration), F.lit(")"))
    return F.concat_ws(LABEL_SEPARATOR, F.col(sector), measure_part, F.col(class_), F.col(seasonal))


LABEL_SQL = (
    "concat_ws(', ', sector_name, concat(measure_text, ' (', duration_text, ')'), class_text, seasonal_text)"
)
