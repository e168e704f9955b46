"""Fitting and applying feature transforms; fitted ones are plain Spark ML pipeline models."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.operators.joins import spread_join
from cardwarden.operators.ordering import dense_codes, exact_quantiles
from cardwarden.schemas import assert_numeric
from cardwarden.session import work_path

FILLED, INDEX, CODE, SLOTS = "__filled", "__index", "__code", "__slots"
FILL_TEXT = "missing"
# Categories travel inside the fitted model to every task up to this number, beyond it in a stored table.
CATEGORY_LIMIT = 100_000


def medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Exact interpolated medians of the present values; None for an all-null column."""
    if not columns:
        return {}
    return {c: v[0] for c, v in exact_quantiles(df, columns, [0.5]).items()}


def _long_text(df: DataFrame, columns: list[str], fill: str | None = None) -> DataFrame:
    cols = [F.col(f"`{c}`").cast("string") for c in columns]
    if fill is not None:
        cols = [F.coalesce(c, F.lit(fill)) for c in cols]
    wide = df.select(*[c.alias(n) for c, n in zip(cols, columns)])
    if len(columns) == 1:
        long = wide.select(F.lit(columns[0]).alias("feature"), F.col(f"`{columns[0]}`").alias("value"))
    else:
        long = wide.unpivot([], [f"`{c}`" for c in columns], "feature", "value")
    return long.where(F.col("value").isNotNull())


def most_frequent(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """The most frequent category of each column, the smallest among equals.

    Counted by (column, value) first, so no buffer holds all categories of a column.
    """
    if not columns:
        return {}
    counts = _long_text(df, columns).groupBy("feature", "value").agg(F.count("*").alias("n"))
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("m"), "value")).alias("b"))
    found = {r.feature: r.value for r in best.select("feature", "b.value").collect()}
    return {c: found.get(c) for c in columns}


def impute(df: DataFrame, values: dict[str, float | str | None]) -> DataFrame:
    """Replace nulls by the fitted values."""
    return df.fillna({c: v for c, v in values.items() if v is not None})


def _filled_text(df: DataFrame, columns: list[str], fills: dict[str, str]) -> DataFrame:
    """(feature, value): every distinct category of every filled column."""
    filled = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(fills[c])).alias(c) for c in columns])
    return _long_text(filled, columns).distinct()


def category_counts(df: DataFrame, columns: list[str], fills: dict[str, str]) -> dict[str, int]:
    """How many categories each column has; one row per column reaches the driver."""
    if not columns:
        return {}
    found = {r.feature: r.n for r in _filled_text(df, columns, fills).groupBy("feature").agg(F.count("*").alias("n")).collect()}
    return {c: found.get(c, 0) for c in columns}


def categories(df: DataFrame, columns: list[str], fills: dict[str, str],
               limit: int = CATEGORY_LIMIT) -> dict[str, list[str]]:
    """The sorted categories of each filled column; an error beyond the limit, before any is fetched."""
    return _categories(df, columns, fills, category_counts(df, columns, fills), limit)


def _categories(df: DataFrame, columns: list[str], fills: dict[str, str], sizes: dict[str, int], limit: int) -> dict[str, list[str]]:
    wide = [c for c in columns if sizes[c] > limit]
    if wide:
        raise ValueError(f"too many categories for an in-model table: {wide}; "
                         "encode them with ordinal_codes and encode_by_join")
    if not columns:
        return {}
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in _filled_text(df, columns, fills).collect():
        found[r.feature].append(r.value)
    return {c: sorted(v, key=lambda s: s.encode()) for c, v in found.items()}


class CodeLookup(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A model stage for a column with any number of categories: codes from a stored table, by spread join.

    ``path`` is a Parquet table (value, code); unseen categories get ``unseen``.
    """

    path = Param(Params._dummy(), "path", "table of values and codes", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "number of categories", TypeConverters.toInt)
    unseen = Param(Params._dummy(), "unseen", "code of unseen categories", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, path=None, size=None, unseen=-1):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def codes(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("value string, code bigint").parquet(self.getOrDefault("path"))

    def _transform(self, df: DataFrame) -> DataFrame:
        column, output = self.getInputCol(), self.getOutputCol()
        table = self.codes(df.sparkSession).withColumnRenamed("value", column)
        return encode_by_join(df, column, table, output, self.getOrDefault("unseen")).withColumn(output, F.col(output).cast("double"))


def wide_codes(df: DataFrame, column: str, fill: str) -> tuple[str, int]:
    """A stored table (value, code) of one column's categories, codes by rank; its path and size."""
    filled = df.select(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(fill)).alias("value"))
    path = work_path(df.sparkSession, "codes")
    ordinal_codes(filled, "value").select("value", F.col("code").cast("bigint").alias("code")).write.parquet(path)
    return path, df.sparkSession.read.parquet(path).count()


def ordinal_codes(df: DataFrame, column: str) -> DataFrame:
    """(column, code) of any number of categories, ranked without collecting them."""
    values = df.select(F.col(column).cast("string").alias(column)).where(F.col(column).isNotNull()).distinct()
    return dense_codes(values, column)


def encode_by_join(df: DataFrame, column: str, codes: DataFrame, output: str, unseen: int = -1) -> DataFrame:
    """Codes looked up by join; unseen categories and nulls get -1.  Frequent categories are spread."""
    table = codes.withColumnRenamed("code", output)
    return spread_join(df, table, column).withColumn(output, F.coalesce(F.col(output), F.lit(unseen)))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit_features(df: DataFrame, numeric: list[str], categorical: list[str], indicators: bool = False,
                 categorical_fill: str = "constant", encoding: str = "ordinal",
                 output: str = "features", numeric_fill: bool = True, limit: int = CATEGORY_LIMIT) -> PipelineModel:
    """Imputation, encoding and assembly, with every statistic taken from ``df`` alone.

    Numbers: exact median, or NaN without ``numeric_fill``.  Categories: the text ``missing`` or the most frequent value, then codes
    by sorted category (unseen: -1) or one slot per category (unseen: all zero).  The vector holds
    the numeric block, the indicators, then the categorical block.  Columns without any value carry
    no information and are left out.  Columns with more than ``limit`` categories are encoded by a stored
    table, the same codes by another road.
    """
    mids = medians(df, numeric)
    numeric_in = [c for c in numeric if mids[c] is not None]
    assert_numeric(df, numeric_in)
    if categorical_fill == "most_frequent":
        fills = {c: v for c, v in most_frequent(df, categorical).items() if v is not None}
    else:
        fills = {c: FILL_TEXT for c in categorical}
    categorical_in = [c for c in categorical if c in fills]
    flagged = [*numeric_in, *categorical_in] if indicators else []

    exprs = [f"CAST(`{c}` IS NULL AS TINYINT) AS `{c}{fixed.MISSING_SUFFIX}`" for c in flagged]
    fill = {c: f"{mids[c]!r}D" if numeric_fill else "DOUBLE('NaN')" for c in numeric_in}
    exprs += [f"COALESCE(NANVL(CAST(`{c}` AS DOUBLE), NULL), {fill[c]}) AS `{c}{FILLED}`" for c in numeric_in]
    exprs += [f"COALESCE(CAST(`{c}` AS STRING), {_quoted(fills[c])}) AS `{c}{FILLED}`" for c in categorical_in]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")]
    inputs = [c + FILLED for c in numeric_in] + [c + fixed.MISSING_SUFFIX for c in flagged]

    if categorical_in:
        sizes = category_counts(df, categorical_in, fills)
        narrow = [c for c in categorical_in if sizes[c] <= limit]
        labels = _categories(df, narrow, fills, sizes, limit)
        # One model per column: a shared one pads shorter label lists with nulls.
        stages += [StringIndexerModel.from_labels(labels[c], c + FILLED, c + INDEX, handleInvalid="keep")
                   for c in narrow]
        for c in categorical_in:
            if c not in labels:
                path, sizes[c] = wide_codes(df, c, fills[c])
                stages.append(CodeLookup(inputCol=c + FILLED, outputCol=c + INDEX, path=path, size=sizes[c], unseen=sizes[c]))
        if encoding == "ordinal":
            codes = [f"CASE WHEN `{c}{INDEX}` >= {sizes[c]} THEN -1D ELSE `{c}{INDEX}` END AS `{c}{CODE}`"
                     for c in categorical_in]
            stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(codes)} FROM __THIS__"))
            inputs += [c + CODE for c in categorical_in]
        else:
            # The slot of unseen values is the last one and is the one dropped.  Sizes are known, so one row
            # with the last index of every column fits the encoder.
            encoder = OneHotEncoder(inputCols=[c + INDEX for c in categorical_in],
                                    outputCols=[c + SLOTS for c in categorical_in],
                                    dropLast=True, handleInvalid="error")
            last = df.sparkSession.createDataFrame(
                [tuple(float(sizes[c]) for c in categorical_in)], ", ".join(f"`{c}{INDEX}` double" for c in categorical_in))
            stages.append(encoder.fit(last))
            inputs += [c + SLOTS for c in categorical_in]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output,
                                  handleInvalid="error" if numeric_fill else "keep"))
    return PipelineModel(stages)


def feature_inputs(model: PipelineModel) -> list[str]:
    """The raw column behind every column the assembler takes."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    found = []
    for c in assembler.getInputCols():
        for suffix in (FILLED, CODE, SLOTS, fixed.MISSING_SUFFIX):
            if c.endswith(suffix):
                c = c.removesuffix(suffix)
                break
        found.append(c)
    return found


def feature_names(model: PipelineModel) -> list[str]:
    """Names in vector order: taken from the assembler, which decides that order."""
    labels: dict[str, list[str]] = {}
    assembler = None
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            labels[stage.getInputCol()] = list(stage.labels)
        elif isinstance(stage, CodeLookup):
            labels[stage.getInputCol()] = [f"#{i}" for i in range(stage.getOrDefault("size"))]  # by code: names stay stored
        elif isinstance(stage, VectorAssembler):
            assembler = stage
    names: list[str] = []
    for c in assembler.getInputCols():
        if c.endswith(SLOTS):
            base = c.removesuffix(SLOTS)
            names += [f"{base}={v}" for v in labels[base + FILLED]]
        else:
            names.append(c.removesuffix(FILLED).removesuffix(CODE))
    return names


def label_weight(weights, label: str, balanced: bool) -> Column:
    """Per-row weight: balanced class weights, or neg/pos on the positives only."""
    if balanced:
        return F.when(F.col(label) == 1, weights.weight_1).otherwise(weights.weight_0)
    return F.when(F.col(label) == 1, weights.scale_pos_weight).otherwise(1.0)
