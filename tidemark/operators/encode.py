"""Feature encoding with Spark ML: population scaling and one-hot categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    FeatureHasher, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .sides import CATEGORICAL, NUMERIC, feature_kinds

NULL_CATEGORY = "__null__"


def default_features(df: DataFrame, target: str = S.TARGET) -> tuple[list[str], list[str]]:
    """Numeric and categorical features by type, without the target columns."""
    kinds = feature_kinds(df, exclude=[target, S.TARGET_SOURCE])
    numeric = [c for c, k in kinds.items() if k == NUMERIC]
    return numeric, [c for c, k in kinds.items() if k == CATEGORICAL and c not in numeric]


def fit_encoder(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
    output: str = "features", hashed: int | None = None,
) -> PipelineModel:
    """Fit the preprocessing pipeline.

    Numbers are centred and divided by the population deviation (1 for a
    constant), which is written into a SQL transformer: fitting is one
    aggregation and applying it stays in generated code.  Categories are indexed
    in text order with NULL as its own category; unknown ones encode to zeros.

    Category lists travel through the driver.  For columns with very many values
    ``hashed`` gives the number of slots that all categories are hashed into
    instead, which needs no list.
    """
    numeric, categorical = list(numeric), list(categorical)
    row = df.agg(
        *[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(numeric)],
        *[F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s{i}") for i, c in enumerate(numeric)],
        F.count(F.lit(1)).alias("_rows"),
    ).first()

    parts = ["*"]
    for i, c in enumerate(numeric):
        mean, std = row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0
        parts.append(f"(CAST(`{c}` AS DOUBLE) - {mean!r}D) / {std!r}D AS `{c}__scaled`")
    for c in categorical:
        parts.append(f"coalesce(CAST(`{c}` AS STRING), '{NULL_CATEGORY}') AS `{c}__text`")
    prepare = SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")
    stages = [prepare]
    if categorical and hashed:
        stages.append(
            FeatureHasher(
                inputCols=[f"{c}__text" for c in categorical], outputCol="hashed__onehot",
                numFeatures=hashed,
            )
        )
    elif categorical:
        stages += [
            StringIndexer(
                inputCols=[f"{c}__text" for c in categorical],
                outputCols=[f"{c}__index" for c in categorical],
                handleInvalid="keep", stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(
                inputCols=[f"{c}__index" for c in categorical],
                outputCols=[f"{c}__onehot" for c in categorical],
                dropLast=True,  # the last index is the indexer's bucket for unknown values
            ),
        ]
    stages.append(
        VectorAssembler(
            inputCols=[f"{c}__scaled" for c in numeric]
            + (["hashed__onehot"] if hashed and categorical else [f"{c}__onehot" for c in categorical]),
            outputCol=output, handleInvalid="keep",
        )
    )
    return Pipeline(stages=stages).fit(df)


def encoded_names(model: PipelineModel) -> list[str]:
    """Output feature names in vector order: ``num__x``, ``cat__x_value``."""
    assembler = model.stages[-1]
    numeric = [c.removesuffix("__scaled") for c in assembler.getInputCols() if c.endswith("__scaled")]
    names = [f"num__{c}" for c in numeric]
    if len(model.stages) > 3:
        indexer = model.stages[1]
        for col_name, labels in zip(indexer.getInputCols(), indexer.labelsArray):
            names += [f"cat__{col_name.removesuffix('__text')}_{v}" for v in labels]
    return names


def encode(df: DataFrame, model: PipelineModel, output: str = "features") -> DataFrame:
    """Apply a fitted encoder, keeping the input columns and the feature vector."""
    return model.transform(df).select(*df.columns, output)


def save_encoder(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_encoder(path: str) -> PipelineModel:
    """Load a saved encoder; an absent path raises ``FileNotFoundError``."""
    try:
        return PipelineModel.load(path)
    except Exception as error:
        if "does not exist" in str(error) or "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no encoder at {path}") from error
        raise


def scaled_long(df: DataFrame, key: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Population-scaled values as ``(key..., feature, value)``; constants give 0."""
    stats = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"_m_{c}") for c in numeric],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"_s_{c}") for c in numeric],
    )
    ready = df.crossJoin(F.broadcast(stats))
    scaled = [
        (
            (F.col(c).cast("double") - F.col(f"_m_{c}"))
            / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(F.lit(1.0))
        ).alias(c)
        for c in numeric
    ]
    return ready.select(*key, *scaled).unpivot(list(key), list(numeric), "feature", "value")


def dummies(df: DataFrame, columns: Sequence[str], drop_first: bool = True) -> DataFrame:
    """0/1 columns ``col_value`` per category in text order, the first left out.

    The category lists become column names, so they are collected.
    """
    found: dict[str, list[str]] = {c: [] for c in columns}
    pairs = (
        df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns
        ])).alias("e"))
        .select("e.*").where("v IS NOT NULL").distinct()
    )
    for r in pairs.collect():
        found[r["c"]].append(r["v"])
    made = []
    for c in columns:
        values = sorted(found[c])[1 if drop_first else 0 :]
        made += [
            F.coalesce(F.col(c).cast("string") == v, F.lit(False)).cast("int").alias(f"{c}_{v}")
            for v in values
        ]
    return df.select(*[x for x in df.columns if x not in columns], *made)
