"""Fitted models as data (M5, M6, B1).

Every model is a small JSON-able payload that turns into a Column. Linear models
are built-in expressions. Trees are flat arrays of nodes, evaluated per Arrow
batch by numpy: the same path for every size, since an expression of hundreds of
trees outgrows what generated code may hold.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tablefit.functions.scaler import Scaler

# Model types of the candidate catalogue and the subset that
# predicts a distribution.
MODEL_TYPES = ("linear_regression", "gradient_boosting", "ngboost", "bayesian_ridge")
DISTRIBUTIONAL_MODELS = frozenset({"ngboost", "bayesian_ridge"})


def _lit(x: float) -> Column:
    return F.lit(float(x))


def _dot(terms) -> Column:
    out = None
    for t in terms:
        out = t if out is None else out + t
    return out if out is not None else F.lit(0.0)


# --------------------------------------------------------------------------- trees
def tree_from_java(node) -> dict:
    """Spark ML tree node (py4j) to ``{"f", "t", "l", "r"}`` / ``{"v"}``."""
    if node.getClass().getSimpleName() == "InternalNode":
        split = node.split()
        return {"f": int(split.featureIndex()), "t": float(split.threshold()),
                "l": tree_from_java(node.leftChild()), "r": tree_from_java(node.rightChild())}
    return {"v": float(node.prediction())}


def tree_column(node: dict, zs: list[Column]) -> Column:
    """Nested CASE WHEN: a continuous split goes left when the value is <= threshold."""
    if "v" in node:
        return _lit(node["v"])
    return F.when(zs[node["f"]] <= _lit(node["t"]), tree_column(node["l"], zs)).otherwise(
        tree_column(node["r"], zs))


#: Entries of the leaf tables that go along with a model's trees; larger ones are walked.
TABLE = 1 << 18


class FlatTrees:
    """Trees as arrays over all their nodes; a leaf is its own child."""

    def __init__(self, trees: list):
        feature, threshold, left, right, value, roots, depth = [], [], [], [], [], [], 0
        for tree in trees:
            roots.append(len(feature))
            level, at = [tree], len(feature)
            while level:
                below, child = [], at + len(level)
                for node in level:
                    leaf = "v" in node
                    here = len(feature)
                    feature.append(0 if leaf else node["f"])
                    threshold.append(0.0 if leaf else node["t"])
                    value.append(node["v"] if leaf else 0.0)
                    left.append(here if leaf else child + len(below))
                    right.append(here if leaf else child + len(below) + 1)
                    if not leaf:
                        below += [node["l"], node["r"]]
                at, level = child, below
            depth = max(depth, _depth(tree))
        self.feature, self.left, self.right, self.roots = (np.array(a, np.int32) for a in (feature, left, right, roots))
        self.threshold, self.value, self.depth = np.array(threshold, float), np.array(value, float), depth
        self.tables = self._tables(trees)

    def arrays(self) -> tuple:
        return self.feature, self.threshold, self.left, self.right, self.value, self.roots, self.depth, self.tables

    def cuts(self) -> dict:
        """The sorted cut points of every feature that is split."""
        inner = self.left != np.arange(len(self.left))
        return {int(f): np.unique(self.threshold[inner & (self.feature == f)]) for f in np.unique(self.feature[inner])}

    def _tables(self, trees: list):
        """``(cuts, masks, leaves)``: the sorted cut points of every feature; per tree, feature and
        number of cut points below a value the leaves (bits) that the feature's splits leave open;
        the leaves' values. None for trees of more than 64 leaves or with too many cut points."""
        cuts = self.cuts()
        if len(trees) * sum(len(c) + 1 for c in cuts.values()) > TABLE or any(np.isnan(c).any() for c in cuts.values()):
            return None
        masks = {f: np.full((len(trees), len(c) + 1), (1 << 64) - 1, np.uint64) for f, c in cuts.items()}
        leaves = np.zeros((len(trees), 64))

        def open_(k, node, first):
            """The number of the node's leaves, which are bits from ``first`` on."""
            if "v" in node:
                if first < 64:
                    leaves[k, first] = node["v"]
                return 1
            a = open_(k, node["l"], first)
            b = open_(k, node["r"], first + a)
            if first + a + b <= 64:
                row, at = masks[node["f"]][k], int(np.searchsorted(cuts[node["f"]], node["t"])) + 1
                row[:at] &= np.uint64(~(((1 << b) - 1) << (first + a)) & ((1 << 64) - 1))
                row[at:] &= np.uint64(~(((1 << a) - 1) << first) & ((1 << 64) - 1))
            return a + b

        for k, tree in enumerate(trees):
            n = open_(k, tree, 0)
            if n > 64:
                return None
            if masks:  # bits of no leaf
                next(iter(masks.values()))[k] &= np.uint64((1 << n) - 1)
        return cuts, masks, leaves


def _depth(node: dict) -> int:
    return 0 if "v" in node else 1 + max(_depth(node["l"]), _depth(node["r"]))


def weighted_leaves(flat: tuple, Z, weights):
    """``sum_k weights[k] * tree_k(z)`` for each row of ``Z``; ``weights`` may
    have several columns. Trees are taken in blocks, so memory stays bounded.

    With leaf tables a row's cut points are looked up once; in each tree the one
    leaf that is left open by all features is the row's."""
    feature, threshold, left, right, value, roots, depth, tables = flat
    out = np.zeros((len(Z), weights.shape[1]))
    if tables is not None:
        cuts, masks, leaves = tables
        codes = {f: np.searchsorted(c, Z[:, f], "left") for f, c in cuts.items()}
        for k in range(0, len(roots), 64):
            found = np.empty((len(Z), len(roots[k:k + 64])))
            for j in range(found.shape[1]):
                still = None
                for f, code in codes.items():
                    mask = masks[f][k + j].take(code)
                    still = mask if still is None else np.bitwise_and(still, mask, out=still)
                # The exponent of a power of two as a double is the number of its bit.
                found[:, j] = leaves[k + j, 0] if still is None else leaves[k + j].take(
                    (still.astype(float).view(np.int64) >> 52) - 1023)
            out += found @ weights[k:k + 64]
        return out
    rows = np.arange(len(Z))[:, None]
    for k in range(0, len(roots), 64):
        at = np.repeat(roots[None, k:k + 64], len(Z), axis=0)
        for _ in range(depth):
            at = np.where(Z[rows, feature[at]] <= threshold[at], left[at], right[at])
        out += value[at] @ weights[k:k + 64]
    return out


def tree_udf(trees: list, weights: list, init: list):
    """``init + weights' tree values`` as an array column of scaled features."""
    flat, w, start = FlatTrees(trees).arrays(), np.asarray(weights, float).reshape(len(trees), len(init)), np.asarray(init, float)
    evaluate = weighted_leaves

    @F.pandas_udf("array<double>")
    def predict(*z: pd.Series) -> pd.Series:
        Z = np.column_stack([c.to_numpy(dtype=float) for c in z])
        return pd.Series(list(start + evaluate(flat, Z, w)))

    return predict


# --------------------------------------------------------------------------- models
class Model:
    kind = "base"
    distributional = False

    def __init__(self, scaler: Scaler):
        self.scaler = scaler

    @property
    def features(self):
        return self.scaler.features

    def z(self, sources: dict | None = None) -> list[Column]:
        sources = sources or {}
        return [self.scaler.column(i, sources.get(f)) for i, f in enumerate(self.scaler.features)]

    def predict_col(self, sources: dict | None = None) -> Column:
        raise NotImplementedError

    def predict_z(self, zs: list[Column]) -> Column:
        raise NotImplementedError

    def dist_z(self, zs: list[Column]) -> tuple[Column, Column]:
        raise ValueError(f"{self.kind} predicts no distribution")

    def dist_cols(self, sources: dict | None = None) -> tuple[Column, Column]:
        raise ValueError(f"{self.kind} predicts no distribution")

    def to_json(self) -> str:
        return json.dumps(self.to_dict(), sort_keys=True)

    def to_dict(self) -> dict:
        raise NotImplementedError


class LinearModel(Model):
    """Linear least squares / NNLS / Bayesian ridge on scaled features."""

    kind = "linear"

    def __init__(self, scaler: Scaler, intercept: float, coef, sigma=None, alpha: float | None = None):
        super().__init__(scaler)
        self.intercept = float(intercept)
        self.coef = [float(c) for c in coef]
        self.sigma = None if sigma is None else [[float(v) for v in r] for r in sigma]
        self.alpha = alpha
        self.distributional = sigma is not None and alpha is not None

    def predict_col(self, sources=None) -> Column:
        return self.predict_z(self.z(sources))

    def predict_z(self, zs: list[Column]) -> Column:
        # Zero weights (clamped NNLS terms, single-feature models) are left out:
        # Catalyst cannot fold ``0.0 * x`` away because of NaN semantics.
        return _lit(self.intercept) + _dot(_lit(w) * z for w, z in zip(self.coef, zs) if w != 0.0)

    def dist_cols(self, sources=None):
        if not self.distributional:
            return super().dist_cols(sources)
        return self.dist_z(self.z(sources))

    def dist_z(self, zs: list[Column]) -> tuple[Column, Column]:
        d = len(zs)
        quad = _dot(_lit(self.sigma[i][j] * (1 if i == j else 2)) * zs[i] * zs[j]
                    for i in range(d) for j in range(i, d) if self.sigma[i][j] != 0.0)
        return self.predict_z(zs), F.sqrt(quad + _lit(1.0 / self.alpha))

    def to_dict(self):
        return {"kind": self.kind, "scaler": self.scaler.to_dict(), "intercept": self.intercept,
                "coef": self.coef, "sigma": self.sigma, "alpha": self.alpha}


class TreeEnsembleModel(Model):
    """Gradient-boosted regression trees: ``init + sum(weight_k * tree_k(z))``."""

    kind = "trees"

    def __init__(self, scaler: Scaler, trees: list, weights: list, init: float = 0.0):
        super().__init__(scaler)
        self.trees, self.weights, self.init = trees, [float(w) for w in weights], float(init)
        self._udf = None

    def predict_col(self, sources=None) -> Column:
        return self.predict_z(self.z(sources))

    def predict_z(self, zs: list[Column]) -> Column:
        if self._udf is None:
            self._udf = tree_udf(self.trees, self.weights, [self.init])
        return self._udf(*zs)[0]

    def parts(self) -> tuple:
        """Trees, what each adds to the prediction, and the start."""
        return self.trees, [[w] for w in self.weights], [self.init]

    def to_dict(self):
        return {"kind": self.kind, "scaler": self.scaler.to_dict(), "trees": self.trees,
                "weights": self.weights, "init": self.init}


class NGBoostModel(Model):
    """Natural-gradient boosting with a Normal(mu, exp(s)) output.

    ``params = init - sum_r lr * scale_r * (tree_mu_r(z), tree_s_r(z))``.
    """

    kind = "ngboost"
    distributional = True

    def __init__(self, scaler: Scaler, init_mu: float, init_s: float, rounds: list, learning_rate: float):
        super().__init__(scaler)
        self.init_mu, self.init_s = float(init_mu), float(init_s)
        self.rounds = rounds  # [{"mu": tree, "s": tree, "scale": float}]
        self.learning_rate = float(learning_rate)
        self._udfs: dict = {}

    def param_cols(self, sources=None, upto: int | None = None) -> tuple[Column, Column]:
        return self.param_z(self.z(sources), upto)

    def weights(self, upto: int | None = None):
        """Trees of the rounds (mu, s, mu, s, ...) and what each adds to the two parameters."""
        rounds = self.rounds if upto is None else self.rounds[:upto]
        trees, w = [], []
        for r in rounds:
            trees += [r["mu"], r["s"]]
            w += [[-self.learning_rate * r["scale"], 0.0], [0.0, -self.learning_rate * r["scale"]]]
        return trees, w

    def parts(self) -> tuple:
        """Trees, what each adds to the two parameters, and their start."""
        return *self.weights(), [self.init_mu, self.init_s]

    def param_z(self, zs: list[Column], upto: int | None = None) -> tuple[Column, Column]:
        if upto not in self._udfs:
            trees, w = self.weights(upto)
            self._udfs[upto] = tree_udf(trees, w, [self.init_mu, self.init_s]) if trees else None
        if self._udfs[upto] is None:
            return _lit(self.init_mu), _lit(self.init_s)
        both = self._udfs[upto](*zs)
        return both[0], both[1]

    def predict_col(self, sources=None) -> Column:
        return self.param_cols(sources)[0]

    def dist_cols(self, sources=None):
        return self.dist_z(self.z(sources))

    def predict_z(self, zs):
        return self.param_z(zs)[0]

    def dist_z(self, zs):
        mu, s = self.param_z(zs)
        return mu, F.exp(s)

    def to_dict(self):
        return {"kind": self.kind, "scaler": self.scaler.to_dict(), "init_mu": self.init_mu,
                "init_s": self.init_s, "rounds": self.rounds, "learning_rate": self.learning_rate}


def model_from_dict(d: dict) -> Model:
    scaler = Scaler.from_dict(d["scaler"])
    if d["kind"] == "linear":
        return LinearModel(scaler, d["intercept"], d["coef"], d.get("sigma"), d.get("alpha"))
    if d["kind"] == "trees":
        return TreeEnsembleModel(scaler, d["trees"], d["weights"], d.get("init", 0.0))
    if d["kind"] == "ngboost":
        return NGBoostModel(scaler, d["init_mu"], d["init_s"], d["rounds"], d["learning_rate"])
    raise ValueError(f"unknown model kind {d['kind']!r}")


def model_from_json(s: str) -> Model:
    return model_from_dict(json.loads(s))


def predict_numpy(model: Model, X) -> np.ndarray:
    """The same prediction on a numpy block (used by the Arrow UDF form, B2)."""
    sc = model.scaler
    Z = (np.asarray(X, dtype=float) - np.asarray(sc.means)) / np.asarray(sc.scales)
    if isinstance(model, LinearModel):
        return model.intercept + Z @ np.asarray(model.coef)

    if isinstance(model, TreeEnsembleModel):
        return model.init + weighted_leaves(FlatTrees(model.trees).arrays(), Z, np.asarray(model.weights).reshape(-1, 1))[:, 0]
    if isinstance(model, NGBoostModel):
        trees, w = model.weights()
        return model.init_mu + weighted_leaves(FlatTrees(trees).arrays(), Z, np.asarray(w).reshape(-1, 2))[:, 0]
    raise ValueError(f"no numpy prediction for {model.kind}")


