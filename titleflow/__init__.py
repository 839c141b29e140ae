"""titleflow: a PySpark-native pipeline for classifying items by short title
and cover image.

Sub-packages
------------
sources    readers and sinks (CSV feature/label tables, token vectors,
           vocabularies, images, submissions, metric logs)
functions  Column -> Column building blocks (tokenisers, array helpers,
           cross entropy); all JVM-side expressions
operators  DataFrame -> DataFrame operators (joins, text, sampling,
           metrics, images, models, tuning)
plans      the registered end-to-end queries and their DuckDB oracles
streaming  the stateless operators applied to streaming DataFrames
"""

__version__ = "0.1.0"
