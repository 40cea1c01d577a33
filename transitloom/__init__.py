"""Spark-native stop and route geodata engine, with a training-data toolkit in ``llm``."""
