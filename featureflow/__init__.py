"""Feature engineering, training and scoring of tabular models on Spark.

Every operator takes and returns DataFrames (or fitted MLlib models), so the
work stays in Spark plans: see the sub-packages ``sources``, ``sinks``,
``functions``, ``operators``, ``plans`` and ``streaming``.
"""
