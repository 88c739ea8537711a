"""Spark-first analytics for fleet GPS telemetry.

Every transform is a plain ``DataFrame -> DataFrame`` function; see README.md.
"""
