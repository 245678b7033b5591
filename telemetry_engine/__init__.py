"""Spark-native device-telemetry engine.

Every operator is a function from DataFrames to a DataFrame built with the
public DataFrame API, so Catalyst plans it and Spark runs it distributed.
Actions happen only at the edges (sinks, streams, the benchmark).
"""

from telemetry_engine.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
