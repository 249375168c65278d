"""cartloom: commerce extract-and-conform on Spark.

Landed search-response documents (orders, customers) are scanned, flattened into
flat entity tables, conformed to fixed schemas, masked, merged per day with
explicit deduplication rules, converted to US Pacific time, sliced into time
windows and pages, reconciled against source totals and published per day.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
built-in expressions, so it composes with ``df.transform`` and stays inside
Catalyst / whole-stage codegen.
"""

__version__ = "0.1.0"
