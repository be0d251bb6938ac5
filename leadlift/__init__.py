"""leadlift: propensity scoring over large customer tables, written as PySpark jobs.

Sub-packages
------------
functions   Column builders: reproducible keyed draws and small numeric helpers.
sources     Reading, writing and staging tables; the customer feature table; saved models.
operators   DataFrame-in, DataFrame-out steps: splits, ranks, metrics, leads, models.
plans       The baseline / train / full flows and the registered queries with their SQL checks.
"""
