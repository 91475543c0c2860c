"""Batch scoring of new entities (R1-R4) and the model bundle.

Scoring is one plan over the whole request table: validate required fields (rows
with errors are kept with an ``error`` message), derive Day-0 features with the
fitted lookups, fill gaps with the training medians, scale, assemble, run the model and
band the probability.  The same function serves a stream
(``streaming.stream_scores``) because it is a stateless transformation.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.ml.classification import (GBTClassificationModel, LogisticRegressionModel,
                                       RandomForestClassificationModel)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import CascadeSpec, StepWindow
from .features import FeatureModel, ensure_parity, vector_column
from .metrics import risk_band
from .models import score_calibrated
from .prep import validate_required

REQUIRED = ("gender", "state", "district", "urban_rural", "anchor_ts")
MODEL_CLASSES = {c.__name__: c for c in (LogisticRegressionModel, RandomForestClassificationModel,
                                         GBTClassificationModel)}


@dataclass
class ScoringBundle:
    """A fitted feature model with one classifier, or with calibrated (classifier,
    isotonic map) pairs whose mean is the score (``model`` is then None)."""

    features: FeatureModel
    model: object
    names: list            # Day-0 feature names the model was trained on
    metadata: dict
    pairs: list = field(default_factory=list)

    def score(self, requests: DataFrame, key: str = "entity_id", required=REQUIRED,
              threshold: float = 0.5) -> DataFrame:
        """Score every request row; invalid rows carry ``error``."""
        v = validate_required(requests, [c for c in required])
        ok = v.where(F.col("error").isNull())
        bad = v.where(F.col("error").isNotNull()).select(key, "error")
        f = self.features.finish(ensure_parity(self.features._unscaled(ok), self.names), self.names)
        f = f.na.fill(0.0, subset=list(self.names))  # features fitted without medians
        if self.pairs:
            s, p = score_calibrated(self.pairs, f, self.names, key, out="__p"), F.col("__p")
        else:
            s, p = self.model.transform(vector_column(f, self.names)), vector_to_array(F.col("probability"))[1]
        good = s.select(key, (p >= F.lit(threshold)).cast("int").alias("prediction"),
                        F.when(p >= F.lit(threshold), F.lit("failure")).otherwise(F.lit("success"))
                        .alias("predicted_class"),
                        p.alias("probability"), risk_band(p).alias("risk_level"),
                        F.lit(None).cast("string").alias("error"))
        return good.unionByName(bad, allowMissingColumns=True)

    # ------------------------------------------------------------------ K7 / S7
    def save(self, path: str) -> None:
        """Model with MLlib's writer, lookups as parquet, metadata as one JSON line --
        all through Spark writers so the path may be on a shared file system."""
        spark = self.features.rates.sparkSession
        if self.model is not None:
            self.model.write().overwrite().save(os.path.join(path, "model"))
        for i, (base, iso) in enumerate(self.pairs):
            base.write().overwrite().save(os.path.join(path, f"pair{i}", "base"))
            iso.write().overwrite().save(os.path.join(path, f"pair{i}", "isotonic"))
        self.features.rates.write.mode("overwrite").parquet(os.path.join(path, "rates"))
        self.features.codes.write.mode("overwrite").parquet(os.path.join(path, "codes"))
        fm = self.features
        meta = dict(self.metadata, model_class=type(self.model).__name__ if self.model is not None else None,
                    pair_classes=[type(base).__name__ for base, _ in self.pairs], names=list(self.names),
                    feature_names=list(fm.feature_names), moments={k: list(v) for k, v in fm.moments.items()}, medians=fm.medians,
                    target=fm.target, rate_cols=list(fm.rate_cols), code_cols=list(fm.code_cols),
                    null_label=fm.null_label, enrol_col=fm.enrol_col,
                    spec=dict(mode=fm.spec.mode, policy=fm.spec.policy,
                              steps=[[s.name, s.value, s.lo, s.hi] for s in fm.spec.steps]))
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
            "overwrite").text(os.path.join(path, "meta"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ScoringBundle":
        """Load once per job (never per row)."""
        meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()["value"])
        model = MODEL_CLASSES[meta["model_class"]].load(os.path.join(path, "model")) if meta["model_class"] else None
        pairs = [(MODEL_CLASSES[c].load(os.path.join(path, f"pair{i}", "base")),
                  IsotonicRegressionModel.load(os.path.join(path, f"pair{i}", "isotonic")))
                 for i, c in enumerate(meta["pair_classes"])]
        spec = CascadeSpec(steps=tuple(StepWindow(*s) for s in meta["spec"]["steps"]),
                           mode=meta["spec"]["mode"], policy=meta["spec"]["policy"])
        fm = FeatureModel(spec, meta["target"], tuple(meta["rate_cols"]), tuple(meta["code_cols"]),
                          rates=spark.read.parquet(os.path.join(path, "rates")),
                          codes=spark.read.parquet(os.path.join(path, "codes")),
                          feature_names=meta["feature_names"],
                          moments={k: tuple(v) for k, v in meta["moments"].items()}, medians=meta["medians"],
                          null_label=meta["null_label"], enrol_col=meta["enrol_col"])
        return cls(fm, model, meta["names"], meta, pairs)

    def info(self, spark: SparkSession) -> DataFrame:
        """Model information as a one-row table."""
        kind = type(self.model).__name__ if self.model is not None else f"calibrated {type(self.pairs[0][0]).__name__}"
        return spark.createDataFrame([(kind, len(self.names), ",".join(self.names),
                                       json.dumps({k: v for k, v in self.metadata.items()}))],
                                     "model string, num_features int, features string, metadata string")


def scoring_summary(scored: DataFrame) -> DataFrame:
    """R2 counts: processed / failed / total in one aggregate."""
    return scored.agg(F.count(F.when(F.col("error").isNull(), 1)).alias("processed"),
                      F.count(F.when(F.col("error").isNotNull(), 1)).alias("failed"),
                      F.count(F.lit(1)).alias("total"))
