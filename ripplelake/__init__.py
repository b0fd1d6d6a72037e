"""ripplelake: a Spark-native clickstream lakehouse.

Bronze -> Silver -> Gold with batch jobs and Structured Streaming, named
analytics queries, data-quality suites and monitoring, all as DataFrame /
Spark SQL plans.  Start with ``ripplelake.plans.jobs`` (batch),
``ripplelake.streaming.pipeline`` (streams) and ``ripplelake.plans.analytics``
(queries).
"""

__version__ = "0.1.0"
