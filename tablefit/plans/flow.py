"""The job graph as plain functions over DataFrames and the shared folder.

medallion -> split -> train (one search per model type) -> select and register
-> batch score (+ hold-out metrics) -> calibration. Every step reads what the
previous one wrote, so a failed step is rerun alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.operators import calibration, checks, linear, registry, scoring, search, split
from tablefit.functions.scaler import Scaler
from tablefit.operators.models import MODEL_TYPES
from tablefit.plans.store import ModelStore
from tablefit.sources import layers, tables
from tablefit.spec import FeatureSpec, LINEITEM_SPEC, check_signature

ALIASES = ("champion", "challenger", "best_calibrated")


def medallion(raw: DataFrame, spec: FeatureSpec, root: str) -> dict:
    """bronze -> silver -> gold, each written, the next read back from storage."""
    spark = raw.sparkSession
    paths = {k: f"{root}/{k}" for k in ("bronze", "silver", "gold")}
    layers.write_layer(layers.bronze(raw, spec), paths["bronze"])
    layers.write_layer(layers.silver(layers.read_layer(spark, paths["bronze"]), spec), paths["silver"])
    layers.write_layer(layers.gold(layers.read_layer(spark, paths["silver"]), spec), paths["gold"])
    return paths


def split_job(spark: SparkSession, gold_path: str, spec: FeatureSpec, root: str,
              train_fraction: float = 0.5, seed: int = 42) -> dict:
    """Write both sides first, then check the written tables (no re-evaluation of the split)."""
    gold = layers.read_layer(spark, gold_path)
    train, scoring_set = split.split_train_scoring(gold, spec.id_col, train_fraction, seed)
    paths = {"train_set": f"{root}/train_set", "scoring_set": f"{root}/scoring_set"}
    layers.write_layer(train, paths["train_set"])
    layers.write_layer(scoring_set, paths["scoring_set"])
    checks.validate_train_scoring(layers.read_layer(spark, paths["train_set"]), spec, "Train set")
    checks.validate_train_scoring(layers.read_layer(spark, paths["scoring_set"]), spec, "Scoring set")
    return paths


def train_job(spark: SparkSession, train_path: str, spec: FeatureSpec, model_type: str, store: ModelStore,
              n_trials: int = 15, seed: int = 42, overrides: dict | None = None) -> search.SearchResult:
    train = layers.read_layer(spark, train_path)
    checks.validate_train_scoring(train, spec, "Train set")
    res = search.run_search(train, spec, model_type, n_trials, seed, overrides=overrides, data_tag=train_path)
    store.log_search([res])
    return res


def select_and_register(store: ModelStore, model_name: str, run_ids: list[str]) -> DataFrame:
    """Champion / challenger on validation RMSE, best calibrated on NLL; three registrations."""
    runs = store.runs().filter(F.col("run_id").isin(run_ids))
    order = F.array_position(F.array(*[F.lit(r) for r in run_ids]), F.col("run_id")).cast("int") - 1
    cands = runs.select("run_id", "model_type", "is_distributional", "val_rmse", order.alias("ord"))
    top = registry.champion_challenger(cands)
    with_nll = registry.attach_metric(cands, runs, "best_val_nll", "val_nll")
    best = registry.best_calibrated(with_nll)
    picks = {r["alias"]: r["run_id"] for r in top.select("alias", "run_id").collect()}
    picks["best_calibrated"] = best.first()["run_id"]
    store.register(model_name, [(a, picks[a]) for a in ALIASES])
    return registry.resolve(store.versions(), store.aliases()).filter(F.col("model_name") == model_name)


def batch_score_job(spark: SparkSession, store: ModelStore, model_name: str, scoring_path: str,
                    out_path: str, spec: FeatureSpec) -> DataFrame:
    """Check, score by the three aliases in one projection, write, then metrics from the written table."""
    scoring_set = layers.read_layer(spark, scoring_path)
    checks.validate_train_scoring(scoring_set, spec, "Scoring set")
    resolved = {a: store.resolve(model_name, a) for a in ALIASES}
    for _, run_id, _ in resolved.values():
        check_signature(scoring_set, store.signature(run_id))  # M12: names and types before scoring
    models = {a: m for a, (_, _, m) in resolved.items()}
    layers.write_layer(scoring.score(scoring_set, models), out_path, snapshots=False)  # read by its bare path
    scored = layers.read_layer(spark, out_path)
    return scoring.holdout_metrics(scored, spec.target, list(ALIASES))


def calibration_job(spark: SparkSession, store: ModelStore, model_name: str, scoring_path: str,
                    spec: FeatureSpec) -> dict:
    scoring_set = layers.read_layer(spark, scoring_path)
    _, _, model = store.resolve(model_name, "best_calibrated")
    mu, sd = model.dist_cols()
    dist = scoring_set.select(spec.id_col, spec.target, mu.alias("mu"), sd.alias("sigma"))
    return {
        "histogram": calibration.density_histogram(dist, spec.target, 20),
        "mixture": calibration.mixture_density_for(dist, spec.target, "mu", "sigma", 500, 30.0),
        "curves": calibration.point_curves(dist, spec.id_col, spec.target, "mu", "sigma", 4, 200),
    }


def run_all(spark: SparkSession, raw: DataFrame, spec: FeatureSpec, root: str, model_name: str,
            n_trials: int = 15, seed: int = 42, overrides: dict | None = None, parallel: bool = True,
            model_types: tuple = MODEL_TYPES) -> dict:
    """The whole graph; ``overrides`` maps model type to pinned parameters."""
    store = ModelStore(spark, f"{root}/registry")
    paths = medallion(raw, spec, root)
    paths.update(split_job(spark, paths["gold"], spec, root, 0.5, seed))
    # The four candidate searches share one split and run side by side; the
    # run log is appended afterwards (one writer at a time per table).
    train = layers.read_layer(spark, paths["train_set"])
    checks.validate_train_scoring(train, spec, "Train set")
    results = search.run_searches(train, spec, list(model_types), n_trials, seed, overrides=overrides,
                                  data_tag=paths["train_set"], parallel=parallel)
    store.log_search(results)
    aliases = select_and_register(store, model_name, [r.run_id for r in results])
    metrics = batch_score_job(spark, store, model_name, paths["scoring_set"], f"{root}/scored_output", spec)
    return {"paths": paths, "results": results, "aliases": aliases, "metrics": metrics, "store": store}


def fit_and_score(spark: SparkSession, sf_dir: str, spec: FeatureSpec = LINEITEM_SPEC, seed: int = 42,
                  train_fraction: float = 0.5) -> DataFrame:
    """The minimum slice: lineitem -> bronze / silver / gold -> hash split ->
    checks -> scaler -> least squares -> hold-out ``(n, rmse, r2)``.

    Two passes over the data: one fused aggregate for the silver null check, the
    training-set check and the scaler, and one moments aggregate per split part,
    from which the fit and the hold-out metrics both follow.
    """
    raw = tables.lineitem_regression(spark, sf_dir)
    bronze = layers.bronze(raw, spec)
    silver = layers.silver_dropna(bronze)
    gold = layers.gold_select(silver, spec)
    in_train = split.hash_u32(spec.id_col, seed) < F.lit(split.hash_threshold(train_fraction))
    tagged = gold.withColumn("_tf_train", in_train)
    t = F.col("_tf_train")
    y = F.col(spec.target).cast("double")
    aggs = [F.sum(F.col(c).isNull().cast("int")).alias(f"null_{c}") for c in spec.layer_columns]
    aggs += [F.count_if(t).alias("n_rows"), F.count_if(t & y.isNull()).alias("n_null_target"),
             F.stddev_samp(F.when(t, y)).alias("target_stddev"), F.avg(F.when(t, y)).alias("ybar")]
    for f in spec.features:
        x = F.when(t, F.col(f).cast("double"))
        aggs += [F.avg(x).alias(f"mean_{f}"), F.stddev_pop(x).alias(f"std_{f}")]
    prof = tagged.agg(*aggs).first().asDict()
    with_nulls = [c for c in spec.layer_columns if prof[f"null_{c}"]]
    if with_nulls:
        raise ValueError(f"Silver: Nulls found, rows by column {({c: prof[f'null_{c}'] for c in with_nulls})}")
    checks.check_profile(prof, "Train set")
    scaler = Scaler(tuple(spec.features), tuple(float(prof[f"mean_{f}"]) for f in spec.features),
                    tuple(float(prof[f"std_{f}"] or 0.0) for f in spec.features))
    mom = linear.moments(tagged, scaler, spec.target, float(prof["ybar"]), part_col="_tf_train")
    b, w = linear.fit_least_squares(mom[True], True, False)
    hold = mom[False]
    rmse_, r2_ = hold.rmse_r2(b, w)
    return spark.createDataFrame([(int(hold.n), rmse_, r2_)], "n long, rmse double, r2 double")
