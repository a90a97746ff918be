"""floe: gridded earth-observation analytics on Spark.

Sub-packages
------------
sources    readers, grid generators, input checks, fixture tables
functions  Column-expression helpers (grid maths, time, projection, physics)
operators  joins, mosaics, regridding, stencils, fill/fusion, statistics, audits
plans      whole compositions (flatten tables, long sparse table, products)
sinks      writers (layout, compression, metadata, partition overwrite)
streaming  incremental ingestion of newly arrived time steps
"""

__version__ = "0.1.0"
