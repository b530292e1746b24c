"""viewtally — clickstream metrics (views, clicks, orders of a video site) on Spark.

Every metric is a pure DataFrame -> DataFrame function used by batch backfills
and by Structured Streaming queries alike.  Event time travels as epoch
milliseconds (the message key), bucket boundaries are computed with built-in
column expressions, and timestamps leave the library as UTC ``TIMESTAMP_NTZ``
so results never depend on the session time zone.
"""

__version__ = "0.1.0"
