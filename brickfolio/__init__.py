"""Spark-native analytics for governed daily fund prices.

Every operator is a lazy ``DataFrame -> DataFrame`` function; nothing here
collects data to the driver except one-row check results and fold boundaries.
"""

__version__ = "0.1.0"
