"""cafetal: a Spark-native medallion pipeline for gridded daily climate data.

bronze (typed daily grid samples) -> silver (SI units, humidity, keys)
-> gold (comfort ranking per point, regional seasonality, executive summary),
with quality checks and contracts at every layer.
"""
