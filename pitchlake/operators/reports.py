"""Report layouts: card lines, clubs side by side, formatted cells.

Operators return numbers; formatting happens here, in the last projection.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.numeric import card_text


def card_rows(
    card: DataFrame, layout: Sequence[tuple[str, str, bool]], by: Sequence[str] = ("clube",)
) -> DataFrame:
    """Wide card -> (ordem, informacao, dados) lines in the layout's order."""
    lines = [
        F.struct(
            F.lit(place).alias("ordem"),
            F.lit(label).alias("informacao"),
            card_text(F.col(column), F.lit(decimals)).alias("dados"),
        )
        for place, (label, column, decimals) in enumerate(layout, start=1)
    ]
    return card.select(*by, F.explode(F.array(*lines)).alias("_l")).select(*by, "_l.*")


def side_by_side(lines: DataFrame, clubs: Sequence[str], column: str = "clube") -> DataFrame:
    """Card lines of the named clubs, one column for each club."""
    return (
        lines.filter(F.col(column).isin(list(clubs)))
        .groupBy("ordem", "informacao")
        .pivot(column, list(clubs))
        .agg(F.first("dados"))
        .orderBy("ordem")
    )
