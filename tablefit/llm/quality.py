"""Quality classifier: regularised quadratic discriminant analysis.

Each text is reduced to a few transformed statistics (log word count, square
roots of smoothed shares, log type ratio). Per class, mean and covariance come
from one aggregate of first and second moments over all labelled training rows;
the covariance is shrunk towards the pooled one (``TOWARDS_POOLED``) and that
towards its diagonal (``TOWARDS_DIAGONAL``). The score is the logistic of the
difference of the two log densities (Mahalanobis terms by the inverted Cholesky
factors, computed once per fit on the driver from d x d numbers) plus the log
prior odds.

Defined results: a null or empty text has all shares zero and is scored like any
other; a null ID is scored and never held out; labels with a null ID or null
quality are left out, repeated labels count each; when a class has fewer than
two training rows, every score is the smoothed share of label 1.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import drop_rows, keep_table, table, text_key, text_or_empty

FEATURES = ("words", "upper", "symbols", "repeats", "types", "pipes", "word_chars", "line_copies", "digits", "stops")
D = len(FEATURES)
TOWARDS_POOLED = 0.1
TOWARDS_DIAGONAL = 1e-2
VARIANCE_FLOOR = 1e-5
#: Pseudo-counts that keep the shares of very short texts near the usual ones.
SMOOTH = 12.0
THRESHOLD = 0.7
MAX_LOGIT = 60.0


def text_statistics(text: str) -> list[float]:
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    of = np.bincount(raw, minlength=256)
    words = text.split()
    n, size = len(words), len(raw)
    letters = of[65:91].sum() + of[97:123].sum()
    symbols = sum(int(of[ord(c)]) for c in "*#%&$!|^~<>{}[]=+_\\")
    repeats = sum(map(str.__eq__, words, words[1:]))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    return [
        float(np.log1p(n)),
        float(np.sqrt(of[65:91].sum() / (letters + 5 * SMOOTH))),
        float(np.sqrt(symbols / (size + 5 * SMOOTH))),
        float(np.sqrt(repeats / (n + SMOOTH))),
        float(np.log((len(set(words)) + SMOOTH) / (n + SMOOTH))),
        float(np.sqrt(words.count("|") / (n + SMOOTH))),
        float((size + 6 * SMOOTH) / (n + SMOOTH)),
        float(np.sqrt((len(lines) - len(set(lines))) / (len(lines) + SMOOTH))),
        float(np.sqrt(of[48:58].sum() / (size + 5 * SMOOTH))),
        float(np.sqrt((of[46] + of[44] + 0.15 * SMOOTH) / (n + SMOOTH))),
    ]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, key, x`` (array of D doubles), one row per input row."""
    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), text_key(text_col).alias("key"))
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            x = [text_statistics(t.as_py()) for t in b.column(1)]
            yield pa.record_batch([b.column(0), b.column(2), pa.array(x, pa.list_(pa.float64()))], ["id", "key", "x"])

    return src.mapInArrow(run, f"id {id_type}, key long, x array<double>")


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Discriminant:
    """Means, inverted Cholesky factors and log offsets of the two classes."""

    def __init__(self, classes: dict, share: float):
        self.classes, self.share = classes, share

    def logit(self) -> Column:
        """Log odds of label 1 from an array column ``x``."""
        if not self.classes:
            return F.lit(float(np.log(self.share / (1 - self.share))))

        def log_density(mean, inv, offset):
            dev = [F.col("x")[i] - F.lit(float(mean[i])) for i in range(D)]
            total = F.lit(float(offset))
            for i in range(D):
                z = sum((dev[j] * F.lit(float(inv[i, j])) for j in range(1, i + 1)), dev[0] * F.lit(float(inv[i, 0])))
                total = total - F.lit(0.5) * z * z
            return total

        return log_density(*self.classes[1]) - log_density(*self.classes[0])

    def score(self) -> Column:
        t = F.greatest(F.lit(-MAX_LOGIT), F.least(F.lit(MAX_LOGIT), self.logit()))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-t))


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Discriminant:
    """Fit on all labelled rows that are not held out."""
    lab = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
           .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id"))))
    rows = stats.join(lab, "id")
    pairs = [(i, j) for i in range(D) for j in range(i + 1)]
    sums = rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"),
                                 *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(D)],
                                 *[F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"q{i}_{j}") for i, j in pairs]).collect()
    n = {r["y"]: r["n"] for r in sums}
    share = (n.get(1, 0) + 1) / (sum(n.values()) + 2)
    if min(n.get(0, 0), n.get(1, 0)) < 2:
        return Discriminant({}, share)
    mean, cov = {}, {}
    for r in sums:
        m = np.array([r[f"s{i}"] for i in range(D)]) / r["n"]
        c = np.zeros((D, D))
        for i, j in pairs:
            c[i, j] = c[j, i] = r[f"q{i}_{j}"] / r["n"] - m[i] * m[j]
        mean[r["y"]], cov[r["y"]] = m, c
    total = sum(n.values())
    pooled = sum(cov[k] * n[k] for k in n) / total
    floor = np.diag(np.maximum(np.diag(pooled), VARIANCE_FLOOR))
    classes = {}
    for k in n:
        s = (1 - TOWARDS_POOLED) * cov[k] + TOWARDS_POOLED * pooled
        s = (1 - TOWARDS_DIAGONAL) * s + TOWARDS_DIAGONAL * floor
        low = np.linalg.cholesky(s)
        classes[k] = (mean[k], np.linalg.inv(low), np.log(n[k] / total) - np.log(np.diag(low)).sum())
    return Discriminant(classes, share)


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str | None = None,
           label_col: str = "quality") -> DataFrame:
    """``id, key, held_out, score, predicted``, one row per input row. The labels' ID is
    ``label_id_col`` (as in ``docs`` unless given)."""
    stats = keep_table(statistics(docs, id_col, text_col), "quality-stats")
    model = fit(stats, labels, label_id_col or id_col, label_col)
    return (stats.select("id", "key", held_out(F.col("id")).alias("held_out"), model.score().alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str | None = None,
              label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns kept."""
    bad = scores(docs, labels, id_col, text_col, label_id_col, label_col).filter("predicted = 0")
    return drop_rows(docs, bad, id_col, text_col)


def query(spark, sf_dir) -> DataFrame:
    return (scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
            .select(F.col("id").alias("doc_id"), "held_out", "score", "predicted"))
