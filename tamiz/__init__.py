"""tamiz: data-quality and dimensional-warehouse operators for PySpark.

Every public operator is a plain ``DataFrame -> DataFrame`` or
``Column -> Column`` function; the caller owns the ``SparkSession``.
"""
