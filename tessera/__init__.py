"""tessera: Spark-native operators for the data work around machine learning.

Every public operator takes and returns ``pyspark.sql.DataFrame`` (or a
``Column`` for the scalar helpers in :mod:`tessera.functions`) and keeps its
core inside Spark: DataFrame/SQL expressions first, Arrow-batched pandas
functions only where built-ins cannot express the semantics.
"""

__version__ = "0.1.0"
