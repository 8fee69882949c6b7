"""Spark-native analytics for multi-channel examination records.

Sub-packages:
  functions  - column expressions (Column -> Column) and fixed vocabularies
  sources    - corpus scans (zip/XML/JSON archives, CSV/parquet) and sinks
  operators  - DataFrame -> DataFrame operators (features, direct scoring,
               verdicts, metrics, feedback, ML)
  plans      - composite jobs and the fixture views used by tests/bench
  streaming  - Structured Streaming drivers over drop folders
"""

__version__ = "0.1.0"
