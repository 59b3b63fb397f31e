"""keelson: lakehouse pipeline operators on PySpark DataFrames.

Subpackages: ``sources`` (readers, writers), ``functions`` (column expressions, the
UDF twins), ``operators`` (joins, keyed selection, ordering, versions, layout,
quality, skew), ``plans`` (trip domain, bronze/silver/gold, reports, layer runner,
query registry), ``streaming`` (incremental jobs).
"""

__version__ = "0.1.0"
