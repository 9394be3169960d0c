"""loamgrid: soil-survey analytics as Spark DataFrame transformations.

Layers
------
model       fixed dimensions: depth intervals, region grids, product registry
sources     table contracts, typed scans, release manifest, pixel table
functions   column expressions shared by the operators
operators   DataFrame -> DataFrame building blocks
plans       whole products: derived tables, gates, rasterisation, ledger
"""

__version__ = "0.1.0"
