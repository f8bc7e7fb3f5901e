"""The monthly register and its dictionaries, derived from the driver tables.

The engine's natural input is one Parquet dataset of individual records per
month.  Here the register is derived from the TPC-H-like tables:
delegation = region, subdelegation = nation, month = order month,
modality = market segment + line status, sector = part size, employer size
= order priority, wage = extended price, employers = first line of an order.
NULLs, ``'NA'`` sizes, all-NULL employer groups, unknown modalities and
inactive registrations are planted on purpose so every trap is exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.codes import normalize_code, unparsable_code
from panelkit.schema import CODE_DICT, GEO_DICT, MICRO, NATIONAL_CODE
from panelkit.session import literal_table
from panelkit.sources.tables import read_table


REGISTER_PARTITION = "date"


def write_register(micro: DataFrame, root: str) -> None:
    """Land register rows partitioned by month (one folder per period).

    No shuffle: every task sorts its own rows by month and writes one file
    per month it holds, so a month with a third of all rows is still written
    by all tasks in parallel (hashing by month would give it to one task).
    """
    micro.sortWithinPartitions(REGISTER_PARTITION).write.mode("append").partitionBy(REGISTER_PARTITION).parquet(root)


def read_register(spark: SparkSession, root: str, month=None) -> DataFrame:
    """Scan the month-partitioned register; a month prunes to one folder.

    Only the columns the cube needs are declared, so the scan reads nothing
    else; the insured flags are pushed into the Parquet reader by Catalyst.
    """
    df = spark.read.schema(MICRO).parquet(root)
    if month is not None:
        df = df.where(F.col(REGISTER_PARTITION) == F.lit(month).cast("date"))
    return df


def micro_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per worker record (lineitem grain), 13 register columns."""
    li = read_table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
    )
    od = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    cu = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    na = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    pa = read_table(spark, sf_dir, "part", "p_partkey", "p_size")

    # Order-side attributes (customer segment, nation) are joined to orders
    # first: that join is order-sized, so at cluster scale the lineitem-sized
    # rows are shuffled only twice (on orderkey, then partkey) instead of
    # three times.  Each side is broadcast by Spark only when its size
    # statistics allow it (nation always; orders and part only when small).
    oc = od.join(cu, od.o_custkey == cu.c_custkey).join(na, F.col("c_nationkey") == na.n_nationkey)
    j = li.join(oc, li.l_orderkey == oc.o_orderkey).join(pa, F.col("l_partkey") == pa.p_partkey)
    size = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "S1")
        .when(F.col("o_orderpriority") == "2-HIGH", "S2")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "S3")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "S4")
        .otherwise("NA")
    )
    seg = F.col("c_mktsegment")
    mod = (
        F.when(seg == "BUILDING", "10")
        .when(seg == "FURNITURE", "13")
        .when(seg == "HOUSEHOLD", "14")
        .when(seg == "MACHINERY", "32")
        .otherwise("17")
    )
    return j.select(
        F.date_trunc("month", F.col("o_orderdate")).cast("date").alias("date"),
        F.when(F.col("l_orderkey") % 97 != 0, F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("nss"),
        F.when(F.col("l_returnflag") == "R", 2).otherwise(1).alias("ta"),
        F.when(F.col("p_size") % 10 != 0, F.col("p_size") % 10).alias("div_final"),
        size.alias("size_cierre"),
        (F.col("n_regionkey") + 1).alias("cve_del_final"),
        (F.col("n_nationkey") + 1).alias("cve_subdel_final"),
        mod.alias("mod"),
        F.when(F.col("l_linestatus") == "O", "1").otherwise("2").alias("tipotrc"),
        F.when(F.col("l_linenumber") < 7, 1).otherwise(0).alias("aseg_cierre"),
        F.when(F.col("o_orderstatus") != "P", 1).otherwise(0).alias("aseg"),
        F.when(F.col("l_quantity") < 49, F.col("l_extendedprice")).alias("sal_cierre"),
        F.when(F.col("l_linenumber") == 1, 1).alias("empresas3"),
    )


# The code dictionary of the register fixture
# (series, disaggregation, sheet_name_code, sheet_name, book_name).
CODE_DICTIONARY_ROWS = [
    ("Asegurados", "Modalidad", "10.1", "Modalidad 10.1", "Asegurados por modalidad"),
    ("Asegurados", "Modalidad", "10.2", "Modalidad 10.2", "Asegurados por modalidad"),
    ("Asegurados", "Modalidad", "13.1", "Modalidad 13.1", "Asegurados por modalidad"),
    ("Asegurados", "Modalidad", "14.1", "Modalidad 14", "Asegurados por modalidad"),
    ("Asegurados", "Modalidad", "32.1", "Modalidad 32", "Asegurados por modalidad"),
    ("Asegurados", "Sector económico", "1", "Sector 1", "Asegurados por sector"),
    ("Asegurados", "Sector económico", "2", "Sector 2", "Asegurados por sector"),
    ("Asegurados", "Sector económico", "3", "Sector 3", "Asegurados por sector"),
    ("Patrones", "Modalidad", "10.1", "Patrones modalidad 10", "Patrones por modalidad"),
    ("Patrones", "Modalidad", "13.1", "Patrones modalidad 13", "Patrones por modalidad"),
    ("Patrones", "Rango de trabajadores", "s1", "Un trabajador", "Patrones por rango"),
    ("Patrones", "Rango de trabajadores", "s2", "Entre 2 y 5", "Patrones por rango"),
    ("Patrones", "Rango de trabajadores", None, "Sin rango", "Patrones por rango"),
    ("Salario", "Modalidad", "10.1", "Salario 10.1", "Salario trabajadores"),
    ("Salario", "Modalidad", "10.2", "Salario 10.2", "Salario trabajadores"),
    ("Salario", "Modalidad", "32.1", "Salario 32", "Salario trabajadores"),
]


def read_code_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Code dictionary landed as CSV with a header.  Every column is read as
    text (no inference), then float-artefact codes are repaired."""
    return repaired_dictionary(read_landed_dictionary(spark, path))


def read_landed_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The code dictionary as landed, all text; :func:`unparsable_codes` reports on it."""
    return spark.read.schema(CODE_DICT).option("header", True).csv(path)


def repaired_dictionary(raw: DataFrame) -> DataFrame:
    """Codes repaired; rows of :func:`unparsable_codes` are left out, since a
    code that became NULL would label the cells *without* a code."""
    return raw.where(~unparsable_code("sheet_name_code")).withColumn("sheet_name_code", normalize_code("sheet_name_code"))


def unparsable_codes(raw: DataFrame) -> DataFrame:
    """The dictionary rows whose long code is not a number, as landed."""
    return raw.where(unparsable_code("sheet_name_code"))


def read_geo_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Geography dictionary landed as CSV with a header: the first four
    columns by position are delegation code and name, subdelegation code and
    name, whatever their headers; codes are read leniently as numbers."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    c = raw.columns
    if len(c) < 4:
        raise ValueError(f"geography dictionary needs four columns, found {c}")

    def num(name: str):
        return F.floor(F.col(f"`{name}`").try_cast("double")).try_cast("int")

    return raw.select(
        num(c[0]).alias("clave_delegacion"),
        F.col(f"`{c[1]}`").alias("delegacion"),
        num(c[2]).alias("clave_subdelegacion"),
        F.col(f"`{c[3]}`").alias("subdelegacion"),
    )


def code_dictionary(spark: SparkSession) -> DataFrame:
    """Code → (sheet_name, book_name) per series and disaggregation."""
    return literal_table(spark, CODE_DICTIONARY_ROWS, CODE_DICT)


def geo_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delegation / subdelegation names plus the two national rows."""
    na = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    rg = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    geo = na.join(rg, na.n_regionkey == rg.r_regionkey).select(
        (F.col("r_regionkey") + 1).cast("int").alias("clave_delegacion"),
        F.col("r_name").alias("delegacion"),
        (F.col("n_nationkey") + 1).cast("int").alias("clave_subdelegacion"),
        F.col("n_name").alias("subdelegacion"),
    )
    national = literal_table(
        spark, [(NATIONAL_CODE, "Nacional", None, None), (NATIONAL_CODE, "Nacional", NATIONAL_CODE, "Nacional")], GEO_DICT
    )
    return geo.unionByName(national)
