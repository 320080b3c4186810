"""Min-max scaling (FEA6)."""

from pyspark.ml.feature import MinMaxScaler


def min_max(column: str = "features", name: str = "scaledFeatures") -> MinMaxScaler:
    """Scale every slot to [0, 1]; a constant slot becomes 0.5."""
    return MinMaxScaler(inputCol=column, outputCol=name)
