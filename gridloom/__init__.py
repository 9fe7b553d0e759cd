"""gridloom — a Spark-native charging-energy warehouse and load-forecast engine.

Layers: ``sources`` (scans, adapters, snapshots), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame building blocks),
``plans`` (end-to-end jobs and the query catalog), ``streaming``.
"""
__version__ = "0.1.0"
