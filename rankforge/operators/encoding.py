"""Category encodings whose dictionary stays a table (F9, P2): index by frequency, sparse one-hot, learned vectors.

The dictionary of a column is numbered by a cluster-wide sort and joined back
to the rows (broadcast if its size is within the bounds), so a column with
millions of values never gathers them on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.functions.joins import join_back
from rankforge.operators.ranking import positions
from rankforge.session import materialize

#: Slots of a one-hot vector that are named after their values; wider vectors carry no names.
NAMED = 1000


def frequency_index(train: DataFrame, col: str, out: str = "idx") -> DataFrame:
    """(col, out: long): the values of a column from 0 up, most frequent first, ties by value as text. NULL has no number."""
    counts = train.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("__k"))
    return positions(counts, [F.col("__k").desc(), F.col(col).cast("string").asc()], out).select(col, F.col(out).cast("bigint").alias(out))


def with_index(df: DataFrame, dictionary: DataFrame, size: int, col: str, out: str) -> DataFrame:
    """``df`` plus ``out`` (double): the value's number, ``size`` for NULL and values outside the dictionary."""
    own = dictionary.select(col, F.col(dictionary.columns[-1]).alias("__i"))
    x = join_back(df, own, [col], "left")
    return x.withColumn(out, F.coalesce(F.col("__i"), F.lit(size)).cast("double")).drop("__i")


def one_hot(df: DataFrame, idx: str, out: str, size: int, values: Sequence | None = None) -> DataFrame:
    """``df`` plus ``out``: a sparse vector of ``size + 1`` slots with a 1 at the number in ``idx`` (the last slot: unseen).

    ``values`` name the slots for models that report weights; without them the vector carries no names."""
    from pyspark.ml.feature import OneHotEncoder
    slots = df.sparkSession.range(size + 1).select(F.col("id").cast("double").alias(idx))
    x = OneHotEncoder(inputCols=[idx], outputCols=[out], dropLast=False, handleInvalid="error").fit(slots).transform(df)
    meta = {}
    if values is not None:
        names = [str(v) for v in values] + ["__unseen"]
        meta = {"ml_attr": {"attrs": {"binary": [{"idx": i, "name": n} for i, n in enumerate(names)]}, "num_attrs": len(names)}}
    return x.withMetadata(out, meta)


class FrequencyEncoder(Estimator, MLReadable):
    """Pipeline stage: ``<c>_idx`` and the sparse ``<c>_vec`` for each column, from dictionaries fitted on the train rows."""

    def __init__(self, cols: Sequence[str]):
        super().__init__()
        self.cols = list(cols)

    def _fit(self, dataset: DataFrame) -> FrequencyEncoderModel:
        dictionaries = {c: materialize(frequency_index(dataset, c), f"dictionary-{i}") for i, c in enumerate(self.cols)}
        return FrequencyEncoderModel(dictionaries, {c: d.count() for c, d in dictionaries.items()})


class FrequencyEncoderModel(Model, MLWritable, MLReadable):
    """Dictionaries (one table per column) and their sizes."""

    def __init__(self, dictionaries: dict[str, DataFrame], sizes: dict[str, int]):
        super().__init__()
        self.dictionaries, self.sizes = dictionaries, sizes

    def values(self, col: str) -> list | None:
        """The values in order, if there are ``NAMED`` at most."""
        if self.sizes[col] > NAMED:
            return None
        return [r[0] for r in self.dictionaries[col].orderBy(self.dictionaries[col].columns[-1]).collect()]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = dataset
        for c, d in self.dictionaries.items():
            x = with_index(x, d, self.sizes[c], c, f"{c}_idx")
            x = one_hot(x, f"{c}_idx", f"{c}_vec", self.sizes[c], self.values(c))
        return x

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: FrequencyEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        cols = list(self.model.dictionaries)
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"cols": cols, "sizes": [self.model.sizes[c] for c in cols]})
        for i, c in enumerate(cols):
            self.model.dictionaries[c].write.parquet(f"{path}/dictionary-{i}")


class _Reader(MLReader):
    def load(self, path: str) -> FrequencyEncoderModel:
        spark = SparkSession.getActiveSession()
        meta = DefaultParamsReader.loadMetadata(path, spark)
        found = {c: spark.read.parquet(f"{path}/dictionary-{i}") for i, c in enumerate(meta["cols"])}
        model = FrequencyEncoderModel(found, dict(zip(meta["cols"], meta["sizes"])))
        model._resetUid(meta["uid"])
        return model


def learned_vectors(train: DataFrame, row: str, col: str, value: str, rank: int = 4, steps: int = 10, reg: float = 0.02,
                    seed: int = 7) -> dict[str, DataFrame]:
    """Vectors of the values of two columns whose products give the log values of the train rows (alternating least squares).

    ``{row: (row, vec), col: (col, vec)}`` with ``vec`` array<double> of ``rank`` numbers, fitted on ``log1p(value)`` less
    its mean over the rows that have all three; values of the train rows only. Factors stay tables."""
    from pyspark.ml.recommendation import ALS
    t = train.select(row, col, F.log1p(F.col(value).cast("double")).alias("__v")).where(F.col("__v").isNotNull()).dropna(subset=[row, col])
    t = materialize(t.groupBy(row, col).agg(F.avg("__v").alias("__v")), "ratings")
    mean = t.agg(F.avg("__v")).first()[0] or 0.0
    ids = {c: materialize(frequency_index(t, c), "dictionary") for c in (row, col)}
    x = t
    for c, name in ((row, "__r"), (col, "__c")):
        x = join_back(x, ids[c].select(c, F.col("idx").cast("int").alias(name)), [c])
    x = x.select("__r", "__c", (F.col("__v") - mean).cast("float").alias("__v"))
    model = ALS(rank=rank, maxIter=steps, regParam=reg, seed=seed, userCol="__r", itemCol="__c", ratingCol="__v", coldStartStrategy="nan").fit(x)
    factors = {row: model.userFactors, col: model.itemFactors}
    return {c: materialize(ids[c].join(factors[c], F.col("idx") == F.col("id")).select(c, F.col("features").cast("array<double>").alias("vec")), "vectors")
            for c in (row, col)}


def with_vectors(df: DataFrame, vectors: DataFrame, col: str, out: str, rank: int) -> DataFrame:
    """``df`` plus ``<out>_0 .. <out>_<rank - 1>``: the value's vector, zeros for NULL and values that were not fitted."""
    x = join_back(df, vectors.select(col, F.col("vec").alias("__vec")), [col], "left")
    return x.select(*df.columns, *[F.coalesce(F.col("__vec")[i], F.lit(0.0)).alias(f"{out}_{i}") for i in range(rank)])


def reconstruction(train: DataFrame, df: DataFrame, vectors: dict[str, DataFrame], row: str, col: str, value: str) -> DataFrame:
    """``df`` plus ``expected``: the mean log value of ``train`` plus the product of the two vectors, back on the scale of ``value``.

    Rows with a value that has no vector get the mean alone."""
    mean = train.dropna(subset=[row, col]).groupBy(row, col).agg(F.avg(F.log1p(F.col(value).cast("double"))).alias("v")).agg(F.avg("v")).scalar()
    x = df
    for c, name in ((row, "__a"), (col, "__b")):
        x = join_back(x, vectors[c].select(c, F.col("vec").alias(name)), [c], "left")
    dot = F.aggregate(F.zip_with("__a", "__b", lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
    return x.withColumn("expected", F.expm1(mean + F.coalesce(dot, F.lit(0.0)))).drop("__a", "__b")

