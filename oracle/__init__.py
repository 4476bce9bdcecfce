"""Independent SQL for the registered queries, for an engine other than Spark.

The models are written the plain way: joins first, then groups, with real distinct counts. Agreement
therefore also checks the rewrites of the library. Fixed values come from the same lists.
"""
