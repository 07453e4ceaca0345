"""tessera: recommendation, text-similarity and transaction analytics as Spark plans.

Every public function takes DataFrames (or a SparkSession) from its caller and
returns a DataFrame built from column expressions, joins, aggregates, windows
and ``pyspark.ml`` stages.  Nothing sets a master, nothing loops over rows on
the driver; the only driver traffic is small scalars (a handful of RMSE values).

Sub-packages:

``sources``    readers, keyed table writes, the ranked (top-N) store, fixtures
               mapping the benchmark tables to the shapes the programs expect,
               and seeded data generation.
``functions``  column-expression helpers: time-based UUIDs, text cleaning and
               tokenizing, stop words, dense/sparse vector arithmetic.
``operators``  reusable relational building blocks: key-dedupe, top-k per
               group, distributed row numbering, positional (cycled) join,
               RMSE and best-candidate selection.
``plans``      end-to-end reports: balances, county statistics, suspicious
               transactions; TF-IDF and document similarity; ALS rank
               selection and top-N recommendation.
"""

__all__ = ["sources", "functions", "operators", "plans"]
