import threading

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from paneloom.operators import evaluate, matrix, metrics, models, saved, split
from paneloom.schema import PanelError

from helpers import day


@pytest.fixture(scope="module")
def tagged(spark):
    """2 stores x 2 products x 64 days with one lag missing on the first day."""
    rows = []
    for s in ("S1", "S2"):
        for p in ("P1", "P2"):
            for d in range(64):
                units = 20.0 + d + (3 if p == "P2" else 0)
                rows.append((day(d), s, p, units, 8 + 0.15 * (d % 7), 0.1 if d % 5 == 0 else 0.0, units - 1 if d else None, "text"))
    df = spark.createDataFrame(
        rows,
        "date date, store_id string, product_id string, units_sold double, price double, discount double, "
        "units_sold_lag_1 double, note string",
    )
    return split.chronological_split(df, validation_start="2024-02-20", test_start="2024-03-01")


def test_matrix_columns_and_reasons(tagged):
    odd = tagged.withColumns({"units_ahead": F.col("price"), "constant": F.lit(1.0), "empty": F.lit(None).cast("double")})
    made = matrix.model_matrix(odd)
    assert made.columns == ["price", "discount", "units_sold_lag_1", "store_id_encoded", "product_id_encoded"]
    assert {r["column"]: r["reason"] for r in made.excluded.collect()} == {
        "date": "explicit_exclusion", "store_id": "explicit_exclusion", "product_id": "explicit_exclusion", "units_sold": "explicit_exclusion",
        "note": "non_numeric", "units_ahead": "leakage_pattern", "constant": "zero_variance", "empty": "insufficient_non_null",
    }
    without_price = matrix.select_features(odd, include_price=False)[0]
    assert without_price == ["units_sold_lag_1"]


def test_medians_come_from_the_training_rows(tagged):
    train = sorted(r[0] for r in tagged.where("split = 'train' and units_sold_lag_1 is not null").select("units_sold_lag_1").collect())
    made = matrix.model_matrix(tagged)
    assert made.medians["units_sold_lag_1"] == pytest.approx(np.median(train))
    first = made.frame.where(F.col("date") == F.lit(day(0))).select(vector_to_array("features").alias("f")).first()["f"]
    assert first[made.columns.index("units_sold_lag_1")] == made.medians["units_sold_lag_1"]
    filled = matrix.impute_medians(tagged, ["units_sold_lag_1"])
    assert filled.where("units_sold_lag_1 is null").isEmpty() and filled.count() == tagged.count()
    bare = matrix.assemble(tagged.drop("discount"), made.columns[:3], made.medians)
    assert bare.select(vector_to_array("features")[1]).distinct().count() == 1


def test_unseen_ids_and_bad_targets(tagged):
    partial = tagged.where("split <> 'train' or store_id <> 'S1'")
    codes = {(r[0], r[1]) for r in matrix.encode_identifiers(partial).select("store_id", "store_id_encoded").distinct().collect()}
    assert codes == {("S1", -1.0), ("S2", 0.0)}
    with pytest.raises(PanelError, match="Target column"):
        matrix.model_matrix(tagged.withColumn("units_sold", F.when(F.col("price") > 8, F.col("units_sold"))))


def test_trees_beat_the_mean_and_the_latest_split_is_scored(tagged):
    made = models.matrix_of(tagged)
    fitted = models.train_gbt(made, {"rounds": 8, "rate": 0.3, "least": 1})
    scored = models.score(made, fitted, "gbt", "trees")
    assert scored.count() == tagged.where("split <> 'train'").count()
    error = metrics.forecast_metrics(scored).where("split = 'validation'").first()
    mean = tagged.where("split = 'train'").agg(F.avg("units_sold")).first()[0]
    naive = tagged.where("split = 'validation'").agg(F.avg(F.abs(F.col("units_sold") - mean))).first()[0]
    assert error["mae"] < naive
    latest = models.forecast_next(made, fitted, "gbt", "trees")
    assert {r["source_split"] for r in latest.collect()} == {"test"}
    no_test = matrix.Matrix(made.frame.where("split <> 'test'"), made.columns, made.medians, made.target, made.excluded)
    assert models.forecast_next(no_test, fitted, "gbt", "trees").first()["source_split"] == "validation"
    with pytest.raises(PanelError, match="non-negative"):
        models.train_gbt_deep(made, seed=-1)


def test_per_product_models_equal_least_squares(spark, tagged):
    few = spark.createDataFrame([(day(d), "S1", "P3", 5.0, 9.0, 0.0, 4.0, "text", "train") for d in range(3)], tagged.schema)
    df = tagged.unionByName(few)
    columns = ["price", "units_sold_lag_1"]
    fits = models.train_per_product(df, columns, ridge=0.0)
    medians = matrix.training_medians(df, columns)
    train = df.where("split = 'train'").fillna(medians).toPandas()
    found = {r["product_id"]: r for r in fits.collect()}
    assert set(found) == {"P1", "P2", None}
    for product, row in found.items():
        part = train if product is None else train[train["product_id"] == product]
        design = np.column_stack([np.ones(len(part)), part[columns]])
        weights = np.linalg.lstsq(design, part["units_sold"], rcond=None)[0]
        assert [row["intercept"], *row["coefficients"]] == pytest.approx(weights, abs=1e-6)
        assert row["n_rows"] == len(part)
    scored = models.score_per_product(df, fits, columns, medians)
    assert scored.count() == df.count() and scored.where("prediction is null").isEmpty()
    p3 = scored.where("product_id = 'P3'").first()
    overall = found[None]
    assert p3["prediction"] == pytest.approx(overall["intercept"] + overall["coefficients"][0] * 9 + overall["coefficients"][1] * 4)
    with pytest.raises(PanelError, match="enough rows"):
        models.train_per_product(df, columns, min_rows=10_000)


def test_tuning_marks_one_best_trial(tagged):
    made = matrix.model_matrix(tagged)
    small = {"rounds": (1, 2, False), "depth": (2, 3, False)}
    trials = models.tune_models(made, n_trials=2, families=["gbt"], ranges=small).collect()
    best = [t for t in trials if t["is_best"]]
    assert len(trials) == 2 and len(best) == 1
    assert best[0]["objective_value"] == min(t["objective_value"] for t in trials)
    assert models.sample_params("gbt", 3, 1) == models.sample_params("gbt", 3, 1)
    one_by_one = models.tune_models(made, n_trials=2, families=["gbt"], ranges=small, parallelism=1).collect()
    assert sorted(map(tuple, one_by_one)) == sorted(map(tuple, trials))
    params = models.best_params(models.tune_models(made, n_trials=2, families=["gbt"], ranges=small), "gbt")
    assert models.boosting_of("gbt", params).rounds == params["rounds"] and set(params) == set(models.FAMILIES["gbt"])
    assert len(models.train_gbt(made, params).fit.parts) >= 1
    for wrong in ({"depth": 40}, {"rounds": 0}, {"leaves": 3}):
        with pytest.raises(PanelError, match="arameter"):
            models.boosting_of("gbt", wrong)
    with pytest.raises(PanelError, match="n_trials"):
        models.tune_models(made, n_trials=0)


def test_a_failed_trial_does_not_end_the_search(tagged, monkeypatch):
    made = matrix.model_matrix(tagged)
    real = models._fit

    def sometimes(matrix_, family, params, seed):
        return real(matrix_, family, {"rounds": 1, "depth": 0 if family == "gbt_deep" else 3}, seed)

    monkeypatch.setattr(models, "_fit", sometimes)
    trials = {t["model_name"]: t for t in models.tune_models(made, n_trials=1).collect()}
    assert trials["gbt_deep"]["state"].startswith("FAIL: ") and not trials["gbt_deep"]["is_best"]
    assert trials["gbt"]["is_best"]

    def broken(*_):
        raise RuntimeError("lost the cluster")

    monkeypatch.setattr(models, "_fit", broken)
    with pytest.raises(RuntimeError, match="lost"):
        models.tune_models(made, n_trials=1)


def test_the_longest_trials_start_first(tagged, monkeypatch):
    seen = []

    def rejected(prepared, family, params, seed):
        seen.append(params["rounds"] * params["depth"])
        raise PanelError("rejected")

    monkeypatch.setattr(models, "_fit", rejected)
    with pytest.raises(PanelError, match="No trial"):
        models.tune_models(matrix.model_matrix(tagged), n_trials=6, parallelism=1)
    assert len(seen) == 12 and seen == sorted(seen, reverse=True)


def test_a_saved_model_scores_new_rows_like_the_fitted_one(spark, tagged, tmp_path):
    made = models.matrix_of(tagged)
    fitted = models.train_gbt(made, {"rounds": 3})
    run = saved.save_model(made, fitted, "gbt", "trees", str(tmp_path / "m"), "2024-05-01T00:00:00")
    again = saved.load_model(spark, str(tmp_path / "m"))
    assert again.columns == made.columns and again.medians == made.medians
    expected = models.forecast_next(made, fitted, "gbt", "trees")
    registry = spark.createDataFrame([("overall", "gbt"), ("per-product", "other")], "scope string, model_name string")
    found = saved.forecast_registered(tagged, registry, run)
    assert found.columns == expected.columns and found.count() == expected.count()
    assert found.exceptAll(expected).isEmpty()
    unseen = tagged.limit(1).withColumn("store_id", F.lit("S9")).drop("discount")
    assert again.predict(unseen).where("store_id_encoded = -1 and prediction is not null").count() == 1
    with pytest.raises(PanelError, match="other"):
        saved.forecast_registered(tagged, registry.withColumn("model_name", F.lit("other")), run)


def test_tune_query_searches_all_trials_and_ranges(monkeypatch):
    from checks import queries

    seen = []
    monkeypatch.setattr(queries, "model_frame", lambda spark, folder: "feature table")
    monkeypatch.setattr(models, "matrix_of", lambda df: ("matrix", df))

    def search(*given, **more):
        seen.append((given, more))
        raise InterruptedError

    monkeypatch.setattr(models, "tune_models", search)
    with pytest.raises(InterruptedError):
        queries.q_tune_models(None, "")
    assert seen == [((("matrix", "feature table"),), {})]


def test_all_candidates_are_evaluated_and_products_get_their_winner(spark, tagged):
    found = evaluate.evaluate_models(tagged, params={"gbt": {"rounds": 5}, "gbt_deep": {"rounds": 4}})
    held_out = tagged.where("split <> 'train'").count()
    counts = {r["model_name"]: r["count"] for r in found.predictions.groupBy("model_name").count().collect()}
    assert set(counts.values()) == {held_out} and len(counts) == 8
    assert found.predictions.where("prediction is null or isnan(prediction)").isEmpty()
    table = found.predictions.where("split = 'validation'").toPandas()
    table["size"] = table["prediction_abs_error"]
    best = {p: g.groupby("model_name")["size"].sum().idxmin() for p, g in table.groupby("product_id")}
    forecast = evaluate.forecast_by_segment(found.predictions, found.registry).collect()
    assert len(forecast) == tagged.where("split = 'test'").count()
    assert all(r["model_name"] == best[r["product_id"]] and r["source_split"] == "test" for r in forecast)
    other = found.registry.where("scope = 'overall' or segment_key like '%P1'").withColumn(
        "model_name", F.when(F.col("scope") == "overall", "naive_last").otherwise("gbt")
    )
    chosen = {(r["product_id"], r["model_name"]) for r in evaluate.forecast_by_segment(found.predictions.where("split = 'validation'"), other).collect()}
    assert chosen == {("P1", "gbt"), ("P2", "naive_last")}
    with pytest.raises(PanelError, match="overall"):
        evaluate.forecast_by_segment(found.predictions, other.where("scope <> 'overall'"))
    with pytest.raises(PanelError, match="Unsupported"):
        evaluate.evaluate_models(tagged, params={"forest": {}})


def test_candidates_are_fitted_together_on_medians_taken_once(tagged, monkeypatch):
    together, taken, medians = threading.Barrier(3, timeout=60), [], matrix.training_medians

    def meeting(fit):
        def run(*given, **more):
            together.wait()
            return fit(*given, **more)

        return run

    for name in ("train_gbt", "train_gbt_deep", "train_per_product"):
        monkeypatch.setattr(evaluate, name, meeting(getattr(evaluate, name)))
    for module in (matrix, models):
        monkeypatch.setattr(module, "training_medians", lambda *given: taken.append(1) or medians(*given))
    found = evaluate.evaluate_models(tagged, params={"gbt": {"rounds": 2}, "gbt_deep": {"rounds": 2}})
    assert len(taken) == 1 and set(found.trees) == {"gbt", "gbt_deep"}
    coded = matrix.encode_with(tagged, found.matrix.codes)
    alone = models.train_per_product(coded, found.matrix.columns).collect()
    assert {r["product_id"]: r["n_rows"] for r in alone} == {r["product_id"]: r["n_rows"] for r in found.per_product.collect()}
