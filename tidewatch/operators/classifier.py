"""Text classifier as an MLlib pipeline."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as V
from tidewatch.sources.readers import path_exists


def build_pipeline(
    text: str = "model_input",
    label: str = "rule_violation",
    max_tokens: int = V.MAX_TOKENS,
    features: int = 1 << 15,
    max_iter: int = 10,
    reg: float = 0.01,
) -> Pipeline:
    """Tokens (cut to the model length), hashed counts, IDF, logistic regression."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_all_tokens", pattern=r"[^\p{L}\p{N}_]+"),
            SQLTransformer(
                statement=f"SELECT *, slice(_all_tokens, 1, {max_tokens}) AS _tokens FROM __THIS__"
            ),
            HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features),
            IDF(inputCol="_tf", outputCol="_features"),
            LogisticRegression(
                featuresCol="_features", labelCol=label, maxIter=max_iter, regParam=reg,
                rawPredictionCol="_raw", probabilityCol="_probability", predictionCol="_prediction",
            ),
        ]
    )


def fit_or_load(train: DataFrame, path: str, pipeline: Pipeline | None = None) -> PipelineModel:
    """The model saved at ``path``; trained and saved first if there is none."""
    if path_exists(train.sparkSession, path):
        return PipelineModel.load(path)
    model = (pipeline or build_pipeline()).fit(train)
    model.write().overwrite().save(path)
    return model


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add logits and prob_violation."""
    scored = model.transform(df)
    return scored.withColumns(
        {
            "logits": vector_to_array("_raw"),
            "prob_violation": F.element_at(vector_to_array("_probability"), 2),
        }
    ).drop("_all_tokens", "_tokens", "_tf", "_features", "_raw", "_probability", "_prediction")
