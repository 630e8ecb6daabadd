"""Usage and spend analytics as Spark jobs.

Raw nested activity, billing and licence records go in; a date-partitioned star schema, an
allocation of exact dollars to editors and features, reporting views, spend questions, measures,
data-quality checks and privacy operators come out.
"""
