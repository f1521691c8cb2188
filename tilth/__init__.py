"""tilth: preparing labelled datasets on Spark.

Every operator takes and returns DataFrames, so it can be chained with
``df.transform(...)``.  Only scalars of proven size (bounds, counts, pivots)
ever reach the driver.
"""
