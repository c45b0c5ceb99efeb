"""alpina - geolocated observation analytics as Spark DataFrame operators.

Sub-packages:
  functions  column expressions (coercion, projections, labels, name tags)
  sources    readers (CSV, JSON dimension, text lists, raster catalog/grid)
  sinks      writers (CSV/Parquet, dimension upsert, worklists, GeoJSON, manifest)
  operators  DataFrame -> DataFrame operators (filters, joins, clustering, footprints)
  plans      composed plans over the test tables and the registered queries
  streaming  the row-local operators applied to a streaming source
"""

__version__ = "0.1.0"
