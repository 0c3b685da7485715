"""Course-material preparation on Spark: DataFrame operators, sources, sinks and pipelines."""
