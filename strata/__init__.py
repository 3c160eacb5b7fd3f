"""strata: Spark-native operators for bitemporal ownership, fund metrics and data quality.

Every operator is a plain ``DataFrame(s) + parameters -> DataFrame`` function that
builds a logical plan; nothing collects to the driver except the iterative graph
loops (which only test for emptiness) and explicit sinks.
"""

from strata.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
