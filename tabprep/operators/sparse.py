"""One-hot encoding of columns with any number of categories, as sparse vectors.

The vocabulary is a table and stays one: distinct values are numbered by a range shuffle, rows get
the numbers of theirs by a join for each column, and the indicators are one sparse vector, in which only those that are set take
room. Nothing that grows with the categories reaches the driver, but for the coefficients of a model that is fitted on them.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.scalar import class_weight, nan_to_null
from tabprep.materialize import materialize
from tabprep.operators.align import with_row_index
from tabprep.operators.encode import MISSING_RULES
from tabprep.operators.frame import quoted
from tabprep.operators.models import FEATURES, VectorClassifier, _present


@dataclass(frozen=True)
class SparseOneHot:
    """Categories of ``columns`` as a table ``column, value, slot``; slots count within each column, by the value's text.

    A missing value is the category NULL where the fit table had one and the rule is ``category``; it and values without a
    category give no indicator otherwise.
    """

    columns: tuple[str, ...]
    vocabulary: DataFrame
    sizes: tuple[int, ...]

    @property
    def starts(self) -> list[int]:
        """Where the slots of each column begin in the vector."""
        return [sum(self.sizes[:i]) for i in range(len(self.sizes))]

    def transform(self, df: DataFrame, name: str = "indicators") -> DataFrame:
        """Add a sparse vector of all indicators; a join for each column, broadcast where Spark finds its categories small enough."""
        plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
        slots, vectors = [], []
        for i, (column, size) in enumerate(zip(self.columns, self.sizes)):
            at = f"c{df.columns.index(column)}"
            own = self.vocabulary.where(F.col("column") == column).select(F.col("value").alias("v"), F.col("slot").cast("double").alias("s"))
            value = nan_to_null(F.col(at), df.schema[column].dataType).cast("string")
            joined = plain.join(own, value.eqNullSafe(F.col("v")), "left")
            slots.append(f"s{i}")
            vectors.append(f"v{i}")
            plain = joined.select(*[c for c in plain.columns], F.coalesce("s", F.lit(float(size))).alias(slots[-1]))
        # The encoder's last slot, for what has no category, is left out of its vectors.
        sizes = df.sparkSession.createDataFrame([tuple(float(max(s, 1) - 1) for s in self.sizes)], ", ".join(f"{s} double" for s in slots))
        encoder = OneHotEncoder(inputCols=slots, outputCols=vectors, handleInvalid="keep").fit(sizes)
        encoded = VectorAssembler(inputCols=vectors, outputCol="whole").transform(encoder.transform(plain))
        names = [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)]
        return encoded.select(*names, F.col("whole").alias(name))

    def counts(self, df: DataFrame) -> DataFrame:
        """``column, value, n``: in how many rows each indicator is set, summed as one vector."""
        sums = self.transform(df, "whole").agg(Summarizer.numNonZeros(F.col("whole")).alias("n"))
        places = sums.select(F.posexplode(vector_to_array("n")).alias("place", "n"))
        return self.named(places).select("column", "value", F.col("n").cast("bigint").alias("n"))

    def named(self, places: DataFrame) -> DataFrame:
        """``places`` (a column ``place`` in the vector) with the column and value of each."""
        begin = F.coalesce(*[F.when(F.col("column") == c, F.lit(s)) for c, s in zip(self.columns, self.starts)])
        table = self.vocabulary.select("column", "value", (F.col("slot") + begin).alias("place"))
        return places.join(table, "place")


def fit_sparse_one_hot(df: DataFrame, columns: Sequence[str], missing: str = "zeros") -> SparseOneHot:
    """Number the distinct values of each column, however many."""
    if missing not in MISSING_RULES:
        raise ValueError(f"missing is one of {MISSING_RULES}")
    names = tuple(columns)
    text = [nan_to_null(quoted(n), df.schema[n].dataType).cast("string").alias(f"c{i}") for i, n in enumerate(names)]
    pairs = df.select(*text).unpivot([], [f"c{i}" for i in range(len(names))], "at", "value").distinct()
    if missing == "zeros":
        pairs = pairs.where("value IS NOT NULL")
    # NULL is the last category of its column; as a key it must be a value.
    keyed = pairs.select("at", "value", F.col("value").isNull().alias("none"), F.coalesce("value", F.lit("")).alias("text"))
    numbered = materialize(with_row_index(keyed, ["at", "none", "text"], "number").select("at", "value", "number"))
    found = {r["at"]: (r["first"], r["n"]) for r in numbered.groupBy("at").agg(F.min("number").alias("first"), F.count("*").alias("n")).collect()}
    bounds = [found.get(f"c{i}", (0, 0)) for i in range(len(names))]
    first = F.coalesce(*[F.when(F.col("at") == f"c{i}", F.lit(b)) for i, (b, _) in enumerate(bounds)])
    column = F.coalesce(*[F.when(F.col("at") == f"c{i}", F.lit(n)) for i, n in enumerate(names)])
    vocabulary = numbered.select(column.alias("column"), "value", (F.col("number") - first).alias("slot"))
    return SparseOneHot(names, vocabulary, tuple(n for _, n in bounds))


@dataclass(frozen=True)
class SparseClassifier:
    """A model over numeric columns and sparse indicators."""

    encoder: SparseOneHot
    numeric: tuple[str, ...]
    inner: VectorClassifier

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` and ``prediction``."""
        return self.inner.transform(_vectors(self.encoder, df, self.numeric))

    def scores(self) -> DataFrame:
        """``column, value, score``: the coefficient of each category."""
        model = self.inner.model
        session = self.encoder.vocabulary.sparkSession
        first = len(self.numeric)
        rows = [(i, float(v)) for i, v in enumerate(model.coefficients.toArray()[first:])]
        return self.encoder.named(session.createDataFrame(rows, "place bigint, score double")).select("column", "value", "score")


def _vectors(encoder: SparseOneHot, df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """``df`` and the vector of its numeric columns and indicators."""
    mark = "i"
    while any(c.startswith(mark) for c in df.columns):
        mark = f"_{mark}"
    numbers = [f"{mark}{i}" for i in range(len(numeric))]
    checked = df.select(*[quoted(c) for c in df.columns], *[_present(quoted(n).cast("double")).alias(m) for n, m in zip(numeric, numbers)])
    encoded = encoder.transform(checked, mark)
    return VectorAssembler(inputCols=[*numbers, mark], outputCol=FEATURES).transform(encoded).drop(mark, *numbers)


def fit_sparse_logistic(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    C: float = 1.0,
    max_iter: int = 100,
    class_weights: dict | None = None,
    missing: str = "zeros",
) -> SparseClassifier:
    """L2-regularised logistic regression on numeric columns and the sparse indicators of the others."""
    encoder = fit_sparse_one_hot(df, categorical, missing)
    weight = class_weight(quoted(label), class_weights).alias("w")
    rows = _vectors(encoder, df, numeric).select(FEATURES, _present(quoted(label).cast("double")).alias("y"), weight).persist()
    try:
        total = rows.agg(F.sum("w")).first()[0]
        settings = {"featuresCol": FEATURES, "labelCol": "y", "weightCol": "w", "regParam": 1.0 / (C * total), "standardization": False, "maxIter": max_iter, "tol": 1e-10}
        model = LogisticRegression(**settings).fit(rows)
    finally:
        rows.unpersist()
    return SparseClassifier(encoder, tuple(numeric), _Ready((), model))


class _Ready(VectorClassifier):
    """A model whose feature vector is there already."""

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.model.transform(df)
        return scored.withColumn("probability", vector_to_array("probability")).drop(FEATURES, "rawPrediction")
