"""Trailing states give the full run's rows of the new month."""

import datetime as dt
import random

from pyspark.sql import functions as F

from panelkit.operators import analytics as A
from panelkit.operators import trailing as T
from panelkit.operators.quality import range_outliers

KEY = ["level", "clave_delegacion"]


def months(n):
    return [dt.date(2000 + m // 12, m % 12 + 1, 1) for m in range(n)]


def panel(spark):
    """Gaps, NULL values, NULL codes, jumps, a series that ends early and one that begins in the last month."""
    rng = random.Random(4)
    rows = []
    for code in [*range(1, 12), None]:
        for i, day in enumerate(months(20)):
            if rng.random() < 0.85 or i == 19:
                rows.append(("L", code, day, None if rng.random() < 0.1 and i < 19 else rng.gauss(50, 2) + (40 if code == 3 and i == 19 else 0)))
    rows += [("early", 1, day, 1.0) for day in months(5)] + [("new", 1, months(20)[19], 4.0), ("one", 1, months(20)[18], 4.0), ("one", 1, months(20)[19], 9.0)]
    return spark.createDataFrame(rows, "level string, clave_delegacion int, date date, value double")


def rounded(df):
    return sorted(str(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.select(sorted(df.columns)).collect())


def test_states_advance_like_the_history(spark):
    p = panel(spark)
    days = months(20)
    state = T.trailing_state(p.where(F.col("date") < F.lit(days[10])), KEY)
    for day in days[10:]:
        state = T.advanced_state(state, p.where(F.col("date") == F.lit(day)), KEY)
    assert rounded(state) == rounded(T.trailing_state(p, KEY))


def test_new_month_equals_the_full_run(spark):
    p = panel(spark)
    last = F.col("date") == F.lit(months(20)[19])
    state, new = T.trailing_state(p.where(~last), KEY), p.where(last)
    found = T.month_outliers(state, new, KEY)
    assert rounded(found) == rounded(range_outliers(p, KEY).where(last)) and found.count() > 0
    full = A.changes(p.withColumn("series", F.lit("Asegurados")), KEY).where(last)
    got = T.month_changes(state, new, KEY)
    assert rounded(got.select(full.columns)) == rounded(full)
