"""Selection, versions and aliases (hand-computed goldens)."""

import pytest
from pyspark.sql import functions as F

from tablefit.operators import registry


@pytest.fixture()
def cands(spark):
    rows = [("r1", "linear_regression", 0, 10.0), ("r2", "gradient_boosting", 1, 9.0),
            ("r3", "ngboost", 2, 9.0), ("r4", "bayesian_ridge", 3, 11.0)]
    df = spark.createDataFrame(rows, "run_id string, model_type string, ord int, val_rmse double")
    return registry.with_distributional_flag(df)


def test_champion_challenger_stable_on_ties(cands):
    got = {r["alias"]: r["run_id"] for r in registry.champion_challenger(cands).collect()}
    assert got == {"champion": "r2", "challenger": "r3"}


def test_champion_needs_two(spark, cands):
    with pytest.raises(ValueError):
        registry.champion_challenger(cands.limit(1))


def test_best_calibrated_with_metric_join(spark, cands):
    metrics = spark.createDataFrame([("r3", 5.5), ("r4", 5.1)], "run_id string, best_val_nll double")
    with_nll = registry.attach_metric(cands, metrics)
    assert registry.best_calibrated(with_nll).first()["run_id"] == "r4"


def test_missing_metric_raises(spark, cands):
    metrics = spark.createDataFrame([("r3", 5.5)], "run_id string, best_val_nll double")
    with pytest.raises(ValueError, match="Missing metric"):
        registry.attach_metric(cands, metrics)


def test_no_distributional_raises(cands):
    with pytest.raises(ValueError, match="No distributional"):
        registry.best_calibrated(cands.filter(~F.col("is_distributional")).withColumn("val_nll", F.lit(1.0)))


def test_register_and_resolve(spark):
    req = spark.createDataFrame(
        [("m", "r1", "champion", 0), ("m", "r2", "challenger", 1), ("m", "r1", "best_calibrated", 2)],
        "model_name string, run_id string, alias string, seq long")
    v, a = registry.register(registry.empty_versions(spark), registry.empty_aliases(spark), req)
    assert sorted((r["version"], r["run_id"]) for r in v.collect()) == [(1, "r1"), (2, "r2"), (3, "r1")]
    v, a = v.cache(), a.cache()
    req2 = spark.createDataFrame([("m", "r9", "champion", 3)], "model_name string, run_id string, alias string, seq long")
    v2, a2 = registry.register(v, a, req2)
    versions, aliases = v.unionByName(v2), a.unionByName(a2)
    cur = {r["alias"]: (r["version"], r["run_id"]) for r in registry.resolve(versions, aliases).collect()}
    assert cur == {"champion": (4, "r9"), "challenger": (2, "r2"), "best_calibrated": (3, "r1")}


def test_store_roundtrip(spark, reg):
    from tablefit.operators import search
    from tablefit.plans.store import ModelStore
    from tablefit.session import scratch_path
    from tablefit.spec import LINEITEM_SPEC as SPEC

    store = ModelStore(spark, scratch_path(spark, "store-test"))
    res = search.run_search(reg, SPEC, "linear_regression", n_trials=2, seed=1)
    store.log_search([res])
    store.register("m", [("champion", res.run_id)])
    store.register("m", [("champion", res.run_id)])
    version, run_id, model = store.resolve("m", "champion")
    assert (version, run_id) == (2, res.run_id)
    assert model.to_json() == res.model.to_json()
    with pytest.raises(ValueError):
        store.resolve("m", "challenger")


def test_signature_check_raises_on_type_change(spark, reg):
    from tablefit.spec import LINEITEM_SPEC as SPEC
    from tablefit.spec import check_signature, signature

    sig = signature(reg, SPEC)
    check_signature(reg, sig)
    with pytest.raises(ValueError, match="Type mismatch"):
        check_signature(reg.withColumn("l_linenumber", F.col("l_linenumber").cast("double")), sig)
    with pytest.raises(ValueError, match="Missing columns"):
        check_signature(reg.drop("l_tax"), sig)


def test_union_candidates_tags_task_order(spark):
    a = spark.createDataFrame([("r1", "linear_regression", 3.0)], "run_id string, model_type string, val_rmse double")
    b = spark.createDataFrame([("r2", "ngboost", 2.0)], "run_id string, model_type string, val_rmse double")
    c = registry.with_distributional_flag(registry.union_candidates([a, b]))
    rows = {r["run_id"]: (r["ord"], r["is_distributional"]) for r in c.collect()}
    assert rows == {"r1": (0, False), "r2": (1, True)}


def test_a_retried_log_counts_once_and_two_tasks_do_not_meet(spark, reg):
    from concurrent.futures import ThreadPoolExecutor

    from tablefit.operators import search
    from tablefit.plans.flow import select_and_register
    from tablefit.plans.store import ModelStore
    from tablefit.session import scratch_path
    from tablefit.spec import LINEITEM_SPEC as SPEC

    store = ModelStore(spark, scratch_path(spark, "store-retry"))
    found = search.run_searches(reg, SPEC, ["linear_regression", "bayesian_ridge"], n_trials=2, seed=1)
    with ThreadPoolExecutor(4) as pool:
        for _ in range(2):  # the second time as a retry
            list(pool.map(lambda r: store.log_search([r]), found))
    assert store.runs().count() == 2 and store.trials().count() == 4
    select_and_register(store, "m", [r.run_id for r in found])
    assert {store.resolve("m", a)[1] for a in ("champion", "challenger")} == {r.run_id for r in found}


def test_a_table_that_cannot_be_read_is_an_error(spark):
    from tablefit.plans.store import ModelStore
    from tablefit.session import scratch_path

    root = scratch_path(spark, "store-broken")
    store = ModelStore(spark, root)
    assert store.versions().count() == 0
    spark.createDataFrame([("not", "parquet")], "a string, b string").write.csv(store.path("model_versions"))
    with pytest.raises(Exception):
        store.register("m", [("champion", "r1")])
    assert store.aliases().count() == 0
