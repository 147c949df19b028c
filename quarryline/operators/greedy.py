"""Order-dependent passes, each within a bounded key."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame


def min_gap(rows: DataFrame, key: str, day: str, weight: str, tie: str, gap: int, most: int) -> DataFrame:
    """Per key the heaviest rows that lie over ``gap`` days from each heavier one
    that was taken, at most ``most`` of them; ties go to the smaller ``tie``.

    Rows of a key beyond what can matter are cut by a ranking first: every row
    taken rules out at most ``2 * gap + 1`` days.
    """

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([weight, tie], ascending=[False, True])
        days = pd.to_datetime(pdf[day]).dt.normalize()
        taken: list[int] = []
        for i, d in enumerate(days):
            if len(taken) == most:
                break
            if all(abs((d - days.iloc[j]).days) > gap for j in taken):
                taken.append(i)
        return pdf.iloc[taken]

    from quarryline.operators.ledger import top_per_key
    from pyspark.sql import functions as F

    daily = rows.withColumn("_day", F.to_date(day))
    best = top_per_key(daily, [key, "_day"], 1, F.desc(weight), F.asc(tie)).drop("_day")
    return best.groupBy(key).applyInPandas(pick, best.schema)
