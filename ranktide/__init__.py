"""Search-ranking analytics as Spark jobs.

``sources``    reading exports, staging and the star-schema store
``functions``  column expressions (text, rounding, scoring, checks)
``operators``  cleaning, loading, numbering, rules and quality over DataFrames
``plans``      views, analyses, the mart and the batch run built from them
"""

__version__ = "0.1.0"
