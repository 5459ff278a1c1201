"""shelflens: Spark jobs for e-commerce product catalogues.

Landed payloads and CSV folders in, one clean product table out, and on top of
it the catalogue questions (GMV share, discounts, best sellers, rating bins),
feature screening and price prediction.  Every operator takes and returns
DataFrames or Columns.
"""
