"""Contact-change intake and review analytics on Spark.

Every job here is a DataFrame -> DataFrame transform over whole tables:
field rules compile to native Spark SQL expressions, lookups and queues are
joins, KPIs and reports are aggregates, and decisions are bulk projections
that append to tables.
"""

__version__ = "0.1.0"
