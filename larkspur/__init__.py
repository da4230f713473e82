"""larkspur: Spark-native operators for real-time warehouse pipelines.

Clickstream logs and database change events are processed with DataFrame /
SQL expressions; keyed sequence operators run on a skew-safe segmented plan
(``larkspur.plans.segmented``); streaming forms live in ``larkspur.streaming``.
"""

__version__ = "0.1.0"
