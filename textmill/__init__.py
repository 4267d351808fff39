"""textmill: Spark-native document cleaning, extraction, summarisation,
evaluation and corpus analytics. Every operator maps DataFrames to DataFrames.

Modules: ``operators.clean``, ``operators.search``, ``operators.entities``,
``operators.aggregate``, ``operators.inference``, ``operators.summarize``,
``operators.rouge``, ``operators.stats``, ``operators.sessions``,
``sources.tables``, ``streaming.append``; named driver queries live in
``plans.catalog``.
"""

__version__ = "0.1.0"
