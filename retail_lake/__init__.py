"""retail_lake: a Spark-native bronze/silver/gold retail medallion.

Entry points: ``lake.Lake`` (models over one input folder), ``plans.pipeline.run_pipeline``
(layer runner with quality gates), ``catalog`` (every query with its SQL oracle) and
``python -m retail_lake`` (one scheduled run).
"""
