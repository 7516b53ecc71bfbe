import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.plans import churn
from tidemark.state import ReplacedTable

DAY = dt.timedelta(days=1)


def mart(spark, n=120):
    i = F.col("id")
    gone = i % 3 == 0
    numbers = {c: (F.when(gone, 5).otherwise(1) + i % 4).cast("long") for c in churn.FEATURES[:-1]}
    return spark.range(n).select(
        F.concat(F.lit("c"), i).alias("customer_id"),
        F.when(gone, "DORMANT").otherwise("ACTIVE").alias("customer_status"),
        *[c.alias(name) for name, c in numbers.items()],
        F.when(i % 10 == 9, F.lit(None).cast("boolean")).otherwise(gone).alias("has_risk_flag"),
    )


def test_label_and_missing_features(spark):
    df = spark.createDataFrame([("a", "CLOSED"), ("b", None), ("c", "ACTIVE")], "customer_id string, customer_status string")
    assert [r.churn_label for r in churn.churn_label(df).collect()] == [1, 0, 0]
    assert churn.churn_features(mart(spark)).count() == 108


def test_split_does_not_depend_on_partitioning(spark):
    features = churn.churn_features(mart(spark))
    a = rows(churn.churn_split(features.coalesce(1)), "customer_id")
    assert a == rows(churn.churn_split(features.repartition(7)), "customer_id")
    share = sum(r["is_train"] for r in a) / len(a)
    assert 0.7 < share < 0.9


def test_promotion():
    assert churn.promotion("v2", 0.7, None)[0]
    assert not churn.promotion("v2", 0.7, ("v1", 0.7))[0]
    assert "remains in production" in churn.promotion("v2", 0.7, ("v1", 0.7))[1]
    promoted, note = churn.promotion("v2", 0.8, ("v1", 0.7))
    assert promoted and note == "PROMOTED: new AUC 0.8000 beat current default's AUC 0.7000."


def test_train_score_and_gate(spark, tmp_path, run_ts):
    registry = churn.Registry(spark, f"file://{tmp_path}/models")
    table = ReplacedTable(spark, f"file://{tmp_path}/mart", mart(spark).schema)
    with pytest.raises(LookupError):
        churn.churn_score(mart(spark), registry, run_ts)
    assert churn.retrain_if_changed(table, registry, run_ts, rounds=2) is None
    table.overwrite(mart(spark), "v1")
    first = churn.retrain_if_changed(table, registry, run_ts, rounds=2)
    assert first.promoted and first.version == "v_20240131_080000" and first.auc > 0.9
    assert first.message.startswith("Training complete. Accuracy=")
    assert churn.predictions(registry).read().count() == 108
    assert churn.retrain_if_changed(table, registry, run_ts + DAY, rounds=2) is None
    table.overwrite(mart(spark), "v2")
    second = churn.retrain_if_changed(table, registry, run_ts + 2 * DAY, rounds=2)
    assert not second.promoted and registry.default()[0] == first.version
    assert registry.versions() == [first.version, second.version]
    assert [r["version_name"] for r in churn.training_log_latest(registry).collect()] == [second.version, first.version]
    scored = churn.predictions(registry).read()
    assert scored.select("scored_at").distinct().first().scored_at == run_ts + 2 * DAY
    assert scored.where("churn_probability < 0 OR churn_probability > 1").isEmpty()


def test_tracking_outcomes(spark):
    customers = spark.createDataFrame(
        [("a", "CLOSED"), ("b", "DORMANT"), ("c", "ACTIVE"), ("d", "ACTIVE"), ("e", "CLOSED"), ("f", "CLOSED"), ("g", None)],
        "customer_id string, customer_status string",
    )
    scores = spark.createDataFrame(
        [("a", 0.5), ("b", 0.4), ("c", 0.9), ("d", 0.1), ("e", None), ("g", 0.9)],
        "customer_id string, churn_probability double",
    ).withColumn("scored_at", F.lit("2024-01-31").cast("timestamp_ntz"))
    tracking = churn.churn_tracking(customers, scores)
    assert {r["customer_id"]: r["tracking_outcome"] for r in rows(tracking)} == {
        "a": churn.CAUGHT,
        "b": churn.MISSED,
        "c": churn.FALSE_ALARM,
        "d": churn.QUIET,
        "e": churn.QUIET,
        "f": churn.QUIET,
        "g": churn.QUIET,
    }
    assert churn.churned_count(tracking).first().churned_customers == 4
    assert [r.customer_id for r in churn.churn_risk_list(tracking).collect()] == ["c"]
    assert [r.customer_id for r in churn.churn_top(scores, 2).collect()] == ["c", "g"]


def test_an_undefined_auc_is_said_and_beaten():
    from tidemark.plans.churn import promotion

    assert promotion("v1", None, None)[0]
    kept, note = promotion("v2", None, ("v1", 0.7))
    assert not kept and "new AUC undefined did not beat" in note
    assert promotion("v3", 0.4, ("v1", None)) == (True, "PROMOTED: new AUC 0.4000 beat current default's AUC undefined.")


def test_training_rows_are_spread_over_all_cores(spark, tmp_path, monkeypatch, run_ts):
    seen = []
    real = churn.fit
    monkeypatch.setattr(churn, "fit", lambda train, rounds: (seen.append(train.rdd.glom().map(len).collect()), real(train, rounds))[1])
    churn.churn_train(mart(spark), churn.Registry(spark, str(tmp_path / "models")), run_ts, rounds=1)
    sizes = seen[0]
    assert len(sizes) >= spark.sparkContext.defaultParallelism and max(sizes) < sum(sizes) / 2
