"""Sports statistics on Spark: plain DataFrame -> DataFrame functions.

``sources``    readers, writers and the HTML stat-table reader
``functions``  column expressions (points, ratios, dates, text)
``operators``  one module per family of relational operators
``plans``      multi-step jobs, the test-table mapping, the query registry
``streaming``  incremental weekly loads on Structured Streaming
"""
