import numpy as np
import pytest
from pyspark.sql import functions as F

from tablefit.llm import quality
from tablefit.llm.common import table, text_key

from .conftest import by_row

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    lab = table(spark, SF, "labels")
    out = quality.scores(table(spark, SF, "documents"), lab)
    rows = out.join(lab.withColumnRenamed("doc_id", "id"), "id").filter("held_out").collect()
    good = [r.predicted for r in rows if r.quality == 1]
    bad = [r.predicted for r in rows if r.quality == 0]
    assert len(bad) > 5 and np.mean(good) >= 0.97 and np.mean(bad) <= 0.1


def test_messy(messy, labels, empty):
    out = quality.scores(messy, labels).collect()
    assert len(out) == messy.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    kept = quality.keep_good(messy, labels)
    assert kept.columns == messy.columns
    verdict = {(o.id, o.key): o.predicted for o in out}
    rows = messy.withColumn("k", text_key("text")).collect()
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(
        str((r.doc_id, r.text)) for r in rows if verdict[r.doc_id, r.k] == 1)
    assert quality.scores(empty, labels).count() == 0


def test_one_class_only(messy, spark):
    lab = spark.createDataFrame([(1, 1), (2, 1), (4, 1)], "doc_id long, quality int")
    assert len({r.score for r in quality.scores(messy, lab).collect()}) == 1


def test_density_matches_numpy(spark, messy, labels):
    stats = quality.statistics(messy)
    model = quality.fit(stats, labels)
    rows = stats.select("x", model.logit().alias("t")).collect()
    for r in rows:
        want = 0.0
        for k, sign in ((1, 1), (0, -1)):
            mean, inv, offset = model.classes[k]
            z = inv @ (np.array(r.x) - mean)
            want += sign * (offset - 0.5 * z @ z)
        assert r.t == pytest.approx(want, rel=1e-9, abs=1e-6)


def test_fit_matches_numpy(spark):
    """Means, shrunk covariances and priors from the labelled rows themselves, held-out ones left out."""
    docs, lab = table(spark, SF, "documents"), table(spark, SF, "labels")
    stats = quality.statistics(docs)
    rows = stats.join(lab.withColumnRenamed("doc_id", "id"), "id").filter(~quality.held_out(F.col("id"))).select("x", "quality").collect()
    x = {k: np.array([r.x for r in rows if r.quality == k]) for k in (0, 1)}
    n = len(x[0]) + len(x[1])
    cov = {k: np.cov(v, rowvar=False, bias=True) for k, v in x.items()}
    pooled = (cov[0] * len(x[0]) + cov[1] * len(x[1])) / n
    floor = np.diag(np.maximum(np.diag(pooled), quality.VARIANCE_FLOOR))
    model = quality.fit(stats, lab)
    for k in (0, 1):
        s = (1 - quality.TOWARDS_POOLED) * cov[k] + quality.TOWARDS_POOLED * pooled
        s = (1 - quality.TOWARDS_DIAGONAL) * s + quality.TOWARDS_DIAGONAL * floor
        mean, inv, offset = model.classes[k]
        assert mean == pytest.approx(x[k].mean(axis=0), rel=1e-9)
        assert inv.T @ inv == pytest.approx(np.linalg.inv(s), rel=1e-5, abs=1e-6 * np.abs(np.linalg.inv(s)).max())
        assert offset == pytest.approx(np.log(len(x[k]) / n) - np.linalg.slogdet(s)[1] / 2, rel=1e-8)


def test_labels_under_other_names(spark, messy, labels):
    want = by_row(quality.scores(messy, labels), "id", "score")
    other = labels.withColumnsRenamed({"doc_id": "ref", "quality": "good"})
    assert by_row(quality.scores(messy, other, label_id_col="ref", label_col="good"), "id", "score") == want
    moved = messy.withColumnRenamed("doc_id", "num")
    assert by_row(quality.scores(moved, labels.withColumnRenamed("doc_id", "num"), "num"), "id", "score") == want
    assert quality.keep_good(moved, other, "num", label_id_col="ref", label_col="good").columns == moved.columns
