"""fareline: a Spark-native trip-records warehouse.

Raw monthly trip files -> bronze contract (QA flags, per-file dedup) ->
silver quality splits -> gold star schema -> daily/monthly marts ->
data-quality checks, catalog profile and executive questions.
Every operator is a lazy ``DataFrame -> DataFrame`` function built from
Spark's own expressions.
"""

__version__ = "0.1.0"
