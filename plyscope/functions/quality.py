"""Move quality from a centipawn evaluation per ply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plyscope.functions.numbers import array_total, count_where

BLUNDER_CP = 200
MISTAKE_CP = 50
MEASURES = ("blunder_rate", "mistake_rate", "avg_centipawn_loss", "accuracy_percentage")


def centipawn_losses(evals: Column) -> Column:
    """Absolute change between neighbouring evaluations; NULL without evaluations."""
    n = F.size(evals)
    return F.when(
        n > 0,
        F.zip_with(
            F.slice(evals, F.lit(2), n - 1),
            F.slice(evals, F.lit(1), n - 1),
            lambda now, before: F.abs(now - before),
        ),
    )


def with_move_quality(
    df: DataFrame, evals: str = "evaluations", moves: str = "moves", colors=("white", "black")
) -> DataFrame:
    """Append the four measures for both colours; the game's value is shared by both."""
    df = df.withColumn("_loss", centipawn_losses(F.col(evals).cast("array<double>")))
    loss, plies = F.col("_loss"), F.size(F.coalesce(F.col(moves), F.array()))
    known = loss.isNotNull()

    def rate(predicate):
        return F.when(
            known, F.when(plies > 0, count_where(loss, predicate) / plies).otherwise(F.lit(0.0))
        )

    df = df.withColumns(
        {
            "_blunder_rate": rate(lambda x: x > BLUNDER_CP),
            "_mistake_rate": rate(lambda x: (x > MISTAKE_CP) & (x <= BLUNDER_CP)),
            "_avg_centipawn_loss": F.when(
                known,
                F.when(F.size(loss) > 0, array_total(loss) / F.size(loss)).otherwise(F.lit(0.0)),
            ),
            "_loss_count": F.size(loss),
        }
    )
    average = F.col("_avg_centipawn_loss")
    df = df.withColumn(
        "_accuracy_percentage",
        F.when(
            average.isNotNull(),
            F.when(F.col("_loss_count") > 0, F.greatest(F.lit(0.0), 100.0 - average / 2)).otherwise(
                F.lit(50.0)
            ),
        ),
    )
    df = df.withColumns({f"{c}_{m}": F.col(f"_{m}") for c in colors for m in MEASURES})
    return df.drop("_loss", "_loss_count", *[f"_{m}" for m in MEASURES])
