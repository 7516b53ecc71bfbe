"""Churn model: label, features, training with promotion of better models, scoring, tracking."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ranking import auc_exact
from tidemark.session import shared_root
from tidemark.sources.files import ntz
from tidemark.state import ReplacedTable, child_names, read_batches, write_batch

# Model inputs, churned statuses, training settings and outcome texts.
FEATURES = [
    "total_accounts",
    "open_accounts",
    "frozen_accounts",
    "closed_accounts",
    "total_balance",
    "avg_account_balance",
    "transaction_count_all_time",
    "transaction_amount_30d",
    "failed_payment_count",
    "support_case_count",
    "high_priority_case_count",
    "open_case_count",
    "account_age_days",
    "has_risk_flag",
]
CHURNED = ("DORMANT", "CLOSED")
MAX_DEPTH, ROUNDS, SEED = 6, 100, 42
THRESHOLD = 0.5
CAUGHT = "CORRECTLY FLAGGED"
MISSED = "MISSED (false negative)"
FALSE_ALARM = "FALSE ALARM (false positive)"
QUIET = "CORRECTLY NOT FLAGGED"

LOG_SCHEMA = (
    "trained_at timestamp_ntz, version_name string, accuracy double, auc double, promoted boolean, promotion_note string"
)
PREDICTION_SCHEMA = "customer_id string, churn_probability double, scored_at timestamp_ntz"


def churn_label(mart: DataFrame) -> DataFrame:
    """1 for customers who left, 0 for all others including an unknown status."""
    return mart.withColumn("churn_label", F.when(F.col("customer_status").isin(*CHURNED), 1).otherwise(0))


def churn_features(mart: DataFrame) -> DataFrame:
    """Id, features and label; customers with any of them missing are left out."""
    wanted = [*FEATURES, "churn_label"]
    return churn_label(mart).select("customer_id", *wanted).dropna(subset=wanted)


def churn_split(features: DataFrame, seed: int = SEED) -> DataFrame:
    """Marks four fifths for training by a hash of the id, the same at any partitioning.

    Eight hex digits below cccccccc are four fifths of all there are.
    """
    digits = F.substring(F.md5(F.concat("customer_id", F.lit(f":{seed}"))), 1, 8)
    return features.withColumn("is_train", digits < "cccccccc")


def _numbers(features: DataFrame) -> DataFrame:
    return features.withColumns({c: F.col(c).cast("double") for c in FEATURES})


def spread(train: DataFrame) -> DataFrame:
    """The rows dealt out over all cores: a file opens in few parts, and every round passes over them several times."""
    return train.repartition(max(train.sparkSession.sparkContext.defaultParallelism, train.rdd.getNumPartitions()), "customer_id")


def fit(train: DataFrame, rounds: int = ROUNDS) -> PipelineModel:
    trees = GBTClassifier(
        labelCol="churn_label", featuresCol="features", maxDepth=MAX_DEPTH, maxIter=rounds, seed=SEED, checkpointInterval=10
    )
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), trees]).fit(train)


def evaluate(model: PipelineModel, test: DataFrame) -> tuple[float, float | None]:
    """Accuracy and area under ROC, both computed by the cluster; no area where all rows are of one class."""
    scored = model.transform(test)
    accuracy = MulticlassClassificationEvaluator(labelCol="churn_label", metricName="accuracy").evaluate(scored)
    ranked = scored.select("churn_label", vector_to_array("probability")[1].alias("p"))
    auc = auc_exact(ranked, "churn_label", "p").first().auc
    return accuracy, auc


class Registry:
    """Saved models, a training log, and from it the version in production."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def log(self) -> DataFrame:
        return read_batches(self.spark, f"{self.path}/log", LOG_SCHEMA).drop("batch_id")

    def default(self) -> tuple[str, float | None] | None:
        """Name and AUC of the version promoted last."""
        row = self.log().where("promoted").orderBy(F.desc("trained_at"), F.desc("version_name")).first()
        return None if row is None else (row.version_name, row.auc)

    def load(self, version: str) -> PipelineModel:
        return PipelineModel.load(f"{self.path}/models/{version}")

    def versions(self) -> list[str]:
        return child_names(self.spark, f"{self.path}/models")


@dataclass
class Training:
    version: str
    accuracy: float
    auc: float | None
    promoted: bool
    note: str

    @property
    def message(self) -> str:
        return (
            f"Training complete. Accuracy={self.accuracy:.4f}, AUC={_shown(self.auc)}, "
            f"version={self.version}. {self.note}"
        )


def _shown(auc: float | None) -> str:
    return "undefined" if auc is None else f"{auc:.4f}"


def promotion(version: str, auc: float | None, default: tuple[str, float | None] | None) -> tuple[bool, str]:
    """A first model is promoted, a later one only when strictly better. An undefined AUC beats nothing and is beaten by any."""
    # The message texts.
    if default is None:
        return True, "No prior model existed -- promoted as the new default."
    name, best = default
    if auc is not None and (best is None or auc > best):
        return True, f"PROMOTED: new AUC {auc:.4f} beat current default's AUC {_shown(best)}."
    return False, (
        f"NOT PROMOTED: new AUC {_shown(auc)} did not beat current default's AUC {_shown(best)}. "
        f"Current default ({name}) remains in production; this run's model ({version}) was still "
        "saved to the registry for reference/comparison, just not deployed."
    )


def churn_train(mart: DataFrame, registry: Registry, run_ts: dt.datetime, rounds: int = ROUNDS) -> Training:
    """Fit, evaluate on the held-out fifth, save, and promote if better; a finished version is left as it is."""
    spark = registry.spark
    if spark.sparkContext.getCheckpointDir() is None:  # boosting cuts its lineage there
        spark.sparkContext.setCheckpointDir(f"{shared_root(spark)}/checkpoint")
    version = "v_" + run_ts.strftime("%Y%m%d_%H%M%S")
    done = registry.log().where(F.col("version_name") == version).first()
    if done is not None:  # a repeated run finds its result
        return Training(version, done.accuracy, done.auc, done.promoted, done.promotion_note)
    # the features are written once: a hundred rounds must not repeat the joins behind them
    folder = f"{registry.path}/features/{version}"
    _numbers(churn_split(churn_features(mart))).write.mode("overwrite").parquet(folder)
    data = spark.read.parquet(folder)
    model = fit(spread(data.where("is_train")), rounds)
    accuracy, auc = evaluate(model, data.where("NOT is_train"))
    model.write().overwrite().save(f"{registry.path}/models/{version}")
    promoted, note = promotion(version, auc, registry.default())
    row = spark.range(1).select(
        ntz(run_ts).alias("trained_at"),
        F.lit(version).alias("version_name"),
        F.lit(accuracy).alias("accuracy"),
        F.lit(auc).cast("double").alias("auc"),
        F.lit(promoted).alias("promoted"),
        F.lit(note).alias("promotion_note"),
    )
    write_batch(row, f"{registry.path}/log", version)
    return Training(version, accuracy, auc, promoted, note)


def predictions(registry: Registry) -> ReplacedTable:
    return ReplacedTable(registry.spark, f"{registry.path}/predictions", PREDICTION_SCHEMA)


def churn_score(mart: DataFrame, registry: Registry, run_ts: dt.datetime) -> DataFrame:
    """Score all customers with complete features by the production model, replacing the former scores."""
    default = registry.default()
    if default is None:
        raise LookupError("no model has been promoted yet")
    rows = _numbers(mart.select("customer_id", *FEATURES).dropna(subset=FEATURES))
    scored = registry.load(default[0]).transform(rows).select(
        "customer_id",
        vector_to_array("probability")[1].alias("churn_probability"),
        ntz(run_ts).alias("scored_at"),
    )
    table = predictions(registry)
    table.overwrite(scored, "s" + run_ts.strftime("%Y%m%dT%H%M%S%f"))
    return table.read()


def has_new_data(version: str | None, consumed: str | None) -> bool:
    """Whether a table's newest version is one its consumer has not seen."""
    return version is not None and version != consumed


def retrain_if_changed(
    marts: ReplacedTable, registry: Registry, run_ts: dt.datetime, rounds: int = ROUNDS
) -> Training | None:
    """Train and score only when the mart has a version not yet trained on."""
    done = read_batches(registry.spark, f"{registry.path}/consumed", "mart_version string, at timestamp_ntz")
    last = done.orderBy(F.desc("at")).first()
    version = marts.current_version()
    if not has_new_data(version, last.mart_version if last else None):
        return None
    mart = marts.read()
    result = churn_train(mart, registry, run_ts, rounds)
    churn_score(mart, registry, run_ts)
    mark = registry.spark.range(1).select(F.lit(version).alias("mart_version"), ntz(run_ts).alias("at"))
    write_batch(mark, f"{registry.path}/consumed", result.version)
    return result


def churn_tracking(mart: DataFrame, scores: DataFrame) -> DataFrame:
    """Every customer with what the model said and how that turned out."""
    churned = F.col("customer_status").isin(*CHURNED)
    flagged = F.col("churn_probability") >= THRESHOLD
    outcome = (
        F.when(churned & flagged, CAUGHT)
        .when(churned & (F.col("churn_probability") < THRESHOLD), MISSED)
        .when((F.col("customer_status") == "ACTIVE") & flagged, FALSE_ALARM)
        .otherwise(QUIET)
    )
    return mart.select("customer_id", "customer_status").join(scores, "customer_id", "left").select(
        "customer_id",
        "customer_status",
        churned.alias("actually_churned"),
        "churn_probability",
        "scored_at",
        outcome.alias("tracking_outcome"),
    )


def churned_count(tracking: DataFrame) -> DataFrame:
    return tracking.where("actually_churned").agg(F.count("*").alias("churned_customers"))


def churn_outcome_counts(tracking: DataFrame) -> DataFrame:
    return tracking.groupBy("tracking_outcome").agg(F.count("*").alias("customers"))


def churn_risk_list(tracking: DataFrame) -> DataFrame:
    """Active customers at risk, most likely first."""
    at_risk = (F.col("customer_status") == "ACTIVE") & (F.col("churn_probability") >= THRESHOLD)
    return tracking.where(at_risk).select("customer_id", "churn_probability").orderBy(
        F.desc("churn_probability"), "customer_id"
    )


def churn_top(scores: DataFrame, n: int = 20) -> DataFrame:
    return scores.orderBy(F.desc("churn_probability"), "customer_id").limit(n)


def training_log_latest(registry: Registry) -> DataFrame:
    return registry.log().orderBy(F.desc("trained_at"))
