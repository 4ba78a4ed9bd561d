"""Training-data operators: thirteen corpus operators built as Spark jobs.

Nothing outside this package imports it; ``registry`` collects its queries and
oracles, and the driver's entry module adds them when the package is present.
"""
