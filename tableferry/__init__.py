"""Copy tables with Spark, prove the copy right, and report on the work."""
