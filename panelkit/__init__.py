"""panelkit: a Spark-native engine for monthly register panels.

A monthly register of individual records is aggregated into a count cube,
turned into long-format count / employer / weighted-wage series at
subdelegation, delegation and national level, appended to a partitioned
Parquet store behind a continuity gate, and queried with slice, total,
wide-pivot, quality and comparison operators.  Every operator takes and
returns Spark DataFrames built from built-in column expressions.
"""

__version__ = "0.1.0"
