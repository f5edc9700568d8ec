"""lakeshift: a Spark-native toolkit for moving operational tables into a layered
analytics store (raw -> bronze -> silver -> gold) and reconciling source and target.

Every public operator takes and returns DataFrames; nothing is collected to the driver
except single scalar marks (e.g. an incremental high-water mark).
"""

__version__ = "0.1.0"
