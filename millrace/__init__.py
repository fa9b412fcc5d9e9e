"""millrace: files to star schema on Spark DataFrames.

Subpackages

* ``functions``  - scalar expressions (typed casts, text, dates, keys)
* ``sources``    - staged files, load specifications, loads with rejects and history
* ``operators``  - deduplication, lookups, surrogate keys, merges, change capture, checks
* ``plans``      - clean views, star schema, holiday model
* ``streaming``  - file auto-ingest and delta merges on Structured Streaming
* ``tables``     - immutable table versions, snapshots, logs
"""
