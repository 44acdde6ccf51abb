"""Product-view analytics on Spark: ingest, normalise, star schema, checks, reports.

Every function takes and returns DataFrames or Columns. Nothing here starts a
session, picks a master or holds a credential.
"""
