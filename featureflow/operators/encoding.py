"""Categories to numbers and back, and vector assembly (FEA1-FEA5, FEA8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    OneHotEncoderModel,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
    VectorIndexerModel,
)
from pyspark.ml.util import (
    DefaultParamsReader,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder, work_path
from ..sources.dimensions import dim_table
from .stacking import SLOT

# Suffixes of the columns that the steps add.
INDEXED, CODED = "_Indexed", "_Coded"
HOT_CATEGORIES = 10_000


def index_columns(columns: Sequence[str], handle_invalid: str = "error") -> StringIndexer:
    """Indexer of many columns: most frequent value first, ties alphabetically."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[name + INDEXED for name in columns],
        handleInvalid=handle_invalid,
    )


def index_label(column: str, name: str, handle_invalid: str = "error") -> StringIndexer:
    return StringIndexer(inputCol=column, outputCol=name, handleInvalid=handle_invalid)


def encode_columns(columns: Sequence[str], drop_last: bool = True) -> OneHotEncoder:
    """One-hot encoder of indexed columns; the last category is the zero vector."""
    return OneHotEncoder(
        inputCols=list(columns), outputCols=[name + CODED for name in columns], dropLast=drop_last
    )


def assemble(
    columns: Sequence[str], name: str = "features", handle_invalid: str = "error"
) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid=handle_invalid)


def index_vector(
    column: str = "features", name: str = "indexedFeatures", max_categories: int = 20
) -> VectorIndexer:
    """Index the vector slots with at most ``max_categories`` distinct values."""
    return VectorIndexer(inputCol=column, outputCol=name, maxCategories=max_categories)


def index_to_label(labels: Sequence[str], column: str = "prediction", name: str = "predictedLabel"):
    return IndexToString(inputCol=column, outputCol=name, labels=list(labels))


def labels_table(spark, model: StringIndexerModel) -> DataFrame:
    """Column, label and index of a fitted indexer."""
    names = model.getInputCols() if model.isSet("inputCols") else [model.getInputCol()]
    rows = [
        (name, label, float(i))
        for name, labels in zip(names, model.labelsArray, strict=True)
        for i, label in enumerate(labels)
    ]
    return dim_table(spark, rows, "column_name string, label string, index double")


def vector_categories(spark, model: VectorIndexerModel) -> DataFrame:
    """Slot, value and index of the categorical slots of a fitted vector indexer."""
    rows = [
        (int(slot), float(value), int(index))
        for slot, values in model.categoryMaps.items()
        for value, index in values.items()
    ]
    return dim_table(spark, rows, "slot int, value double, index int")


def category_index(df: DataFrame, column: str) -> DataFrame:
    """Value, count and index of a column with any number of categories.

    Same order as the indexers above, from a distributed sort of the distinct
    values. Positions are the start of the row's partition plus the place in
    it; the sorted table is checkpointed so that both come from one run of
    the sort.
    """
    shared_folder(df.sparkSession)
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    ordered = (
        counts.orderBy(F.desc("rows"), F.asc(F.col(column).cast("string")))
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_id", 33)
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).collect()
    starts, total = [], 0
    for row in sorted(sizes, key=lambda r: r["_part"]):
        starts.append((row["_part"], total))
        total += row["n"]
    # One entry per sort partition, so the table has a fixed bound.
    offsets = dim_table(df.sparkSession, starts or [(0, 0)], "_part bigint, _start bigint")
    return ordered.join(F.broadcast(offsets), part == F.col("_part")).select(
        column, "rows", (F.col("_start") + place).alias("index")
    )


def attach_index(
    df: DataFrame, index: DataFrame, column: str, name: str, hot: int = HOT_CATEGORIES
) -> DataFrame:
    """Add the category index to every row; null values get a null index.

    The ``hot`` most frequent categories are at the head of the index. They
    are broadcast, so no shuffle partition receives a hot value; only rows of
    the rarer ones, each a small share, are joined by shuffle.
    """
    lookup = index.select(F.col(column), F.col("index").alias(name))
    head = F.broadcast(lookup.filter(F.col(name) < hot))
    tail = lookup.filter(F.col(name) >= hot)
    matched = df.join(head, column, "left")
    is_open = F.col(name).isNull() & F.col(column).isNotNull()
    rare = matched.filter(is_open).drop(name).join(tail, column, "left")
    return matched.filter(~is_open).unionByName(rare)


class CategoryIndexer(Estimator):
    """Indexer of columns with any number of categories; same order as ``index_columns``.

    The fitted model holds one table per column, not a label list on the
    driver, and looks categories up by join. ``handle_invalid``: a null or a
    category that training did not see fails the job (``error``) or gets the
    index after the last one (``keep``). Values are compared as text. With
    ``weight``, the name of a column, a row counts as so many.
    """

    def __init__(self, columns: Sequence[str], handle_invalid: str = "error", weight: str | None = None):
        super().__init__()
        self.columns, self.handle_invalid, self.weight = list(columns), handle_invalid, weight

    def _fit(self, dataset: DataFrame) -> CategoryIndexModel:
        """All columns by one count, one sort and one written table."""
        spark, times = dataset.sparkSession, F.lit(1) if self.weight is None else F.col(self.weight)
        texts = F.array(*[F.col(c).cast("string") for c in self.columns])
        stacked = dataset.select(F.posexplode(texts).alias(SLOT, "value"), times.alias("times"))
        counts = stacked.filter("value is not null").groupBy(SLOT, "value").agg(F.sum("times").alias("rows"))
        path = work_path(spark, "categories")
        ordered = counts.orderBy(SLOT, F.desc("rows"), "value")
        ordered.select(SLOT, "value", F.monotonically_increasing_id().alias("id")).write.parquet(path)
        ordered = spark.read.schema(f"{SLOT} int, value string, id bigint").parquet(path)
        part, place = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
        parts = ordered.groupBy(part.alias("part"), SLOT).agg(F.count("*").alias("n"), F.min(place).alias("first")).collect()
        # Where a column's values begin in each part of the sort: one entry per part and column.
        sizes, starts = [0] * len(self.columns), [[] for _ in self.columns]
        for row in sorted(parts, key=lambda r: r["part"]):
            starts[row[SLOT]].append((row["part"], sizes[row[SLOT]] - row["first"]))
            sizes[row[SLOT]] += row["n"]
        tables = []
        for slot, own in enumerate(starts):
            offsets = dim_table(spark, own or [(0, 0)], "part bigint, start bigint")
            placed = ordered.filter(F.col(SLOT) == slot).join(F.broadcast(offsets), part == F.col("part"))
            tables.append(placed.select("value", (F.col("start") + place).alias("index")))
        return CategoryIndexModel(self.columns, self.handle_invalid, tables, sizes)


class CategoryIndexModel(Model, MLWritable, MLReadable):
    """Adds ``<column>_Indexed``; saved with its tables."""

    def __init__(self, columns: Sequence[str], handle_invalid: str, tables: list[DataFrame], sizes: list[int]):
        super().__init__()
        self.columns, self.handle_invalid = list(columns), handle_invalid
        self.tables, self.sizes = tables, sizes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for column, table, size in zip(self.columns, self.tables, self.sizes, strict=True):
            name = column + INDEXED
            lookup = table.select(F.col("value").cast("string").alias(f"_{name}"), F.col("index").cast("double").alias(name))
            # Spark broadcasts a small table; a large one is joined by shuffle, hot categories split.
            dataset = dataset.join(lookup, F.col(column).cast("string") == F.col(f"_{name}"), "left").drop(f"_{name}")
            if self.handle_invalid == "keep":
                missing = F.lit(float(size))
            else:
                text = F.coalesce(F.col(column).cast("string"), F.lit("null"))
                missing = F.raise_error(F.concat(F.lit(f"Unseen label of {column}: "), text)).cast("double")
            dataset = dataset.withColumn(name, F.coalesce(name, missing))
        return dataset

    def coder(self, drop_last: bool = True) -> OneHotEncoderModel:
        """One-hot stage of these columns, of the widths known from the tables: no scan, sparse at any width."""
        extra = 1 if self.handle_invalid == "keep" else 0
        context = SparkContext._active_spark_context
        sizes = context._gateway.new_array(context._jvm.int, len(self.sizes))
        for k, size in enumerate(self.sizes):
            sizes[k] = size + extra
        model = context._jvm.org.apache.spark.ml.feature.OneHotEncoderModel(f"OneHotEncoder_{self.uid}", sizes)
        indexed = [c + INDEXED for c in self.columns]
        coder = OneHotEncoderModel(model)
        coder._resetUid(model.uid())
        coder._set(inputCols=indexed, outputCols=[c + CODED for c in indexed], dropLast=drop_last, handleInvalid="error")
        return coder

    def write(self) -> CategoryIndexWriter:
        return CategoryIndexWriter(self)

    @classmethod
    def read(cls) -> CategoryIndexReader:
        return CategoryIndexReader()


class CategoryIndexWriter(MLWriter):
    def __init__(self, model: CategoryIndexModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        extra = {"columns": m.columns, "handleInvalid": m.handle_invalid, "sizes": m.sizes}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=extra)
        for k, table in enumerate(m.tables):
            table.write.parquet(f"{path}/tables/{k}")


class CategoryIndexReader(MLReader):
    def load(self, path: str) -> CategoryIndexModel:
        saved = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        tables = [self.sparkSession.read.parquet(f"{path}/tables/{k}") for k in range(len(saved["columns"]))]
        model = CategoryIndexModel(saved["columns"], saved["handleInvalid"], tables, saved["sizes"])
        model._resetUid(saved["uid"])
        return model
