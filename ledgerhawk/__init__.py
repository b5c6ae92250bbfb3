"""ledgerhawk: Spark-native transaction-monitoring analytics.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's own
expressions, windows, joins and Structured Streaming state. Thresholds live in
``ledgerhawk.config`` as frozen dataclasses with the reference defaults.
"""

__version__ = "0.1.0"
