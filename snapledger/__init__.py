"""snapledger: snapshot -> SCD2 history -> audit -> publish -> analyse, on Spark DataFrames.

Every operator is a function that takes and returns DataFrames (or returns a
``Column``), so Catalyst sees one declarative plan: filters reach the Parquet
scan, aggregates run partial+final, joins pick their strategy under AQE.
"""

__version__ = "0.1.0"
