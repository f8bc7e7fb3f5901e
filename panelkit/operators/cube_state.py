"""The count cube as a mergeable state.

A finished cube holds wage means, which cannot be added up.  Its state holds
what the measures are made of (workers, wages counted, wage sum, employers), so
the states of parts of a register merge into the state of the whole, in any
order and grouping.  Wage sums are decimals: exact, and the same whatever the
order of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from panelkit.functions.means import AMOUNT_SUM, amount, exact_mean
from panelkit.schema import CUBE_KEYS, MICRO

MEASURES = ["n_workers", "n_wages", "wage_sum", "employers"]
CUBE_STATE = StructType([MICRO[k] for k in CUBE_KEYS] + [StructField("n_workers", LongType()), StructField("n_wages", LongType()), StructField("wage_sum", AMOUNT_SUM), StructField("employers", LongType())])


def cube_state(micro: DataFrame) -> DataFrame:
    """The state of a register's records, by the cube's keys; only records with both insured flags set count."""
    insured = micro.where((F.col("aseg_cierre") == 1) & (F.col("aseg") == 1))
    return insured.groupBy(*CUBE_KEYS).agg(
        F.count("nss").alias("n_workers"),
        F.count("sal_cierre").alias("n_wages"),
        F.sum(amount("sal_cierre")).cast(AMOUNT_SUM).alias("wage_sum"),
        F.sum("empresas3").cast("bigint").alias("employers"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One row per cell from the rows of several states (NULL keys form cells; a sum of no value stays NULL)."""
    return states.groupBy(*CUBE_KEYS).agg(*[F.sum(m).cast(CUBE_STATE[m].dataType).alias(m) for m in MEASURES])


def finished_cube(state: DataFrame) -> DataFrame:
    """The count cube of a merged state: workers, mean wage, employers."""
    mean = exact_mean(F.col("wage_sum"), F.col("n_wages"))
    return state.select(*CUBE_KEYS, F.col("n_workers").alias("asegurados"), mean.alias("salario"), F.col("employers").alias("patrones"))
