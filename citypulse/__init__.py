"""citypulse: urban-mobility features as PySpark DataFrame operators.

Raw road-traffic, weather and departure records go through three stages:

* landing files or Kafka topics  -> ``sources``, ``streaming.bronze``
* flat, city-partitioned tables  -> ``operators``, ``streaming.silver``
* one wide row per city and time bucket, the reports over it and their
  publication                    -> ``plans``, ``streaming.gold``

Every operator is a function from DataFrames to a DataFrame. Jobs run only in
the writers and where an incremental run has to learn its time bounds.
"""
