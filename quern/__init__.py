"""Corpus preparation and run-telemetry analytics as plain Spark DataFrame operators.

Every operator takes a DataFrame first and returns a DataFrame, so pipelines read as
``df.transform(op, ...)`` and stay one lazy plan until they are written.
"""

__version__ = "0.1.0"
