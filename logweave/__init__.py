"""Spark-native operators for keyed event logs and the tables built from them.

Every operator is a plain function from DataFrame to DataFrame.  See README.md
for the map from operator to module.
"""
