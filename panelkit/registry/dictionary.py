"""Registered queries of the landed code dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.registry import oracle_base as O
from panelkit.session import scratch_path
from panelkit.sources.register import code_dictionary, read_code_dictionary, read_landed_dictionary, unparsable_codes
from panelkit.sources.store import write_table
from panelkit.sources.tables import read_table


def landed(spark: SparkSession, sf: str) -> str:
    """The dictionary as a CSV file with one more row per part: a third each of long floats, short codes and words."""
    number = F.col("p_partkey").cast("string")
    code = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("codigo "), number)).when(F.col("p_partkey") % 3 == 1, F.concat(number, F.lit(".100000000000001"))).otherwise(F.concat(F.lit("c"), F.col("p_partkey") % 1000))
    parts = read_table(spark, sf, "part", "p_partkey").select(
        F.lit("Asegurados").alias("series"), F.lit("Modalidad").alias("disaggregation"), code.alias("sheet_name_code"), F.concat(F.lit("Hoja "), number).alias("sheet_name"), F.lit("Libro").alias("book_name")
    )
    path = scratch_path(spark, "dictionary")
    write_table(code_dictionary(spark).unionByName(parts), path, "csv")
    return path


def q_landed_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return read_code_dictionary(spark, landed(spark, sf))


def q_unparsable_code_report(spark: SparkSession, sf: str) -> DataFrame:
    """The rows whose cells the panel would lose: long codes that are no number."""
    return unparsable_codes(read_landed_dictionary(spark, landed(spark, sf)))


QUERIES = {"landed_dictionary": q_landed_dictionary, "unparsable_code_report": q_unparsable_code_report}

_PARTS = "'Asegurados' AS series, 'Modalidad' AS disaggregation, {code} AS sheet_name_code, 'Hoja ' || p_partkey AS sheet_name, 'Libro' AS book_name FROM part WHERE p_partkey % 3"
ORACLE = {
    "landed_dictionary": f"""WITH {O.F_DICT} SELECT * FROM f_dict
        UNION ALL SELECT {_PARTS.format(code="p_partkey || '.1'")} = 1
        UNION ALL SELECT {_PARTS.format(code="'c' || (p_partkey % 1000)")} = 2""",
    "unparsable_code_report": f"""SELECT {_PARTS.format(code="'codigo ' || p_partkey")} = 0""",
}
