"""garnetflow: a PySpark-native analytics engine for vulnerability knowledge.

Subpackages
-----------
functions  Column-returning scalar functions: tokenisers, cleaning, scoring rules.
operators  DataFrame operators: joins, aggregations, windows, classification, linking, retrieval.
sources    Scans of XML, JSON, STIX, feeds and keyed artifacts, and the sinks.
plans      Whole queries bound to tables, each with the SQL that checks it.
streaming  Incremental ingestion and resumable export.
"""
