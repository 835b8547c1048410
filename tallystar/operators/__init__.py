"""DataFrame-to-DataFrame steps, generic over column names.

Broadcast rule used throughout: ``F.broadcast`` is applied only to sides whose row
count is bounded by construction (Python literals, one row per calendar month, one
row per shuffle partition).  Every other join is left to Spark, which broadcasts
when the measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise sort-merges, with AQE splitting a skewed partition.
"""
