"""rarecast: snapshot -> outcome -> feature -> rare-event prediction on Spark.

Every operator is a function (or a ``pyspark.ml`` Estimator/Model pair) that
takes DataFrames and column names and returns a DataFrame; the work runs on
Spark executors.  Sub-packages:

* ``sources``   - batch readers, allow-lists, conform/append/route sinks
* ``functions`` - column-level scalar helpers (normalisation, text, hashing)
* ``operators`` - comment aggregation, delayed outcome, prep, profiling,
                  priors, encoders, text features, resampling, models, evaluation
* ``streaming`` - Structured Streaming forms of the ingest and outcome join
* ``plans``     - adapters from the test tables to the operators, and the
                  registered queries with their oracle SQL
"""

__version__ = "0.1.0"
