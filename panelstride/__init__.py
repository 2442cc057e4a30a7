"""panelstride: daily-panel analytics on Spark DataFrames.

Ingest per-entity files, clean and dedupe them, build look-back features and
forward labels with window functions, split by time, fit and evaluate
classifiers with ``pyspark.ml`` and produce report tables.
"""

__version__ = "0.1.0"
