"""SQL text shared by the oracle queries (ANSI SQL that DuckDB runs on the
driver's tables). Kept next to the Spark plans they check."""

from __future__ import annotations

from tablefit.sources.tables import LINEITEM_KEY, LINEITEM_ORDER
from tablefit.spec import LINEITEM_FEATURES

ORDER_LIST = ", ".join(LINEITEM_ORDER)
KEY = " || '-' || ".join([*LINEITEM_KEY, "CAST(l_quantity AS BIGINT)"])
FEATS = list(LINEITEM_FEATURES)


def h32(expr: str, seed: int = 42) -> str:
    """The split hash: first 8 hex digits of md5('<seed>:<id>') as an integer."""
    return f"CAST('0x' || substr(md5('{seed}:' || coalesce(CAST({expr} AS VARCHAR), 'null')), 1, 8) AS BIGINT)"


def reg_cte(name: str = "reg", null_tax: bool = False, null_target: bool = False,
            numbered: bool = False) -> str:
    tax = "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_tax END AS l_tax" if null_tax else "l_tax"
    rev = "l_extendedprice * (1 - l_discount)"
    if null_target:
        rev = f"CASE WHEN l_linenumber = 7 THEN NULL ELSE {rev} END"
    return (f"{name} AS (SELECT l_quantity, l_extendedprice, l_discount, {tax}, l_linenumber, "
            f"{rev} AS revenue, {f'row_number() OVER (ORDER BY {ORDER_LIST})' if numbered else KEY} AS row_id FROM lineitem)")


def split_ctes(src: str = "reg", seed: int = 42, fraction: float = 0.5, sfx: str = "") -> str:
    thr = int(fraction * (1 << 32))
    return (f"tr{sfx} AS (SELECT * FROM {src} WHERE {h32('row_id', seed)} < {thr}), "
            f"sc{sfx} AS (SELECT * FROM {src} WHERE {h32('row_id', seed)} >= {thr})")


def univariate_candidates_sql(seed: int = 42, sfx: str = "", with_reg: bool = True) -> str:
    """CTEs ``fits<sfx>`` and ``cands<sfx>``: per feature an OLS fit on the train
    part and its validation metrics on the scoring part; ``gauss_`` twins add a
    Normal with the training residual std and its validation NLL."""
    fits = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {k} AS k, regr_slope(revenue, {f}) AS b1, "
        f"regr_intercept(revenue, {f}) AS b0 FROM tr{sfx}" for k, f in enumerate(FEATS))

    def case_x(t):
        return "CASE f.feature " + " ".join(f"WHEN '{f}' THEN {t}.{f}" for f in FEATS) + " END"

    head = f"{reg_cte()}, " if with_reg else ""
    return (
        f"{head}{split_ctes('reg', seed, 0.5, sfx)}, fits0{sfx} AS ({fits}), "
        f"fits{sfx} AS (SELECT f.feature, f.k, f.b1, f.b0, "
        f"sqrt(avg(power(t.revenue - (f.b0 + f.b1 * {case_x('t')}), 2))) AS sigma "
        f"FROM fits0{sfx} f, tr{sfx} t GROUP BY f.feature, f.k, f.b1, f.b0), "
        f"ev{sfx} AS (SELECT f.feature, f.k, "
        f"sqrt(avg(power(s.revenue - (f.b0 + f.b1 * {case_x('s')}), 2))) AS val_rmse, "
        f"avg(0.5 * ln(2 * pi()) + ln(f.sigma) + power((s.revenue - (f.b0 + f.b1 * {case_x('s')})) / f.sigma, 2) / 2)"
        f" AS val_nll FROM fits{sfx} f, sc{sfx} s GROUP BY f.feature, f.k), "
        f"cands{sfx} AS (SELECT 'ols_' || feature AS model_type, 2 * k AS ord, false AS is_distributional, "
        f"val_rmse, CAST(NULL AS DOUBLE) AS val_nll, feature FROM ev{sfx} UNION ALL "
        f"SELECT 'gauss_' || feature, 2 * k + 1, true, val_rmse, val_nll, feature FROM ev{sfx})")


def moments_cte(src: str = "tr") -> str:
    """``e0``: means, stds and all correlations of the features and the target (one row)."""
    d = len(FEATS)
    cols = [f"avg({f}) AS m{i}, stddev_pop({f}) AS s{i}, corr({f}, revenue) AS b{i}, 1.0 AS a{i}{i}" for i, f in enumerate(FEATS)]
    cols += [f"corr({FEATS[i]}, {FEATS[j]}) AS a{min(i, j)}{max(i, j)}" for i in range(d) for j in range(i + 1, d)]
    sym = ", ".join(f"a{i}{j} AS a{j}{i}" for i in range(d) for j in range(i + 1, d))
    return (f"e00 AS (SELECT avg(revenue) AS my, stddev_pop(revenue) AS sy, {', '.join(cols)} FROM {src}), "
            f"e0 AS (SELECT *, {sym} FROM e00)")


def solve_ctes(kept: list[int], name: str) -> str:
    """``<name>`` from ``e0``: the weights ``w<i>`` of least squares on the features
    ``kept`` (0 for the others), the share ``gain`` of the target's variance that
    they explain, and whether none is negative. Elimination written out step by step."""
    out, last = [], "e0"
    for n, k in enumerate(kept[:-1]):  # the rows after k lose column k
        rest = kept[n + 1:]
        new = [f"a{i}{j} - a{i}{k} * a{k}{j} / a{k}{k} AS a{i}{j}" for i in rest for j in rest]
        new += [f"b{i} - a{i}{k} * b{k} / a{k}{k} AS b{i}" for i in rest]
        out.append(f"{name}_f{n} AS (SELECT * REPLACE ({', '.join(new)}) FROM {last})")
        last = f"{name}_f{n}"
    for n in reversed(range(len(kept))):
        k = kept[n]
        rest = "".join(f" - a{k}{j} * x{j}" for j in kept[n + 1:])
        out.append(f"{name}_x{n} AS (SELECT *, (b{k}{rest}) / a{k}{k} AS x{k} FROM {last})")
        last = f"{name}_x{n}"
    at = f"{last}." if kept else ""
    w = ", ".join(f"{at}m{i}, " + (f"x{i} * {at}sy / {at}s{i}" if i in kept else "0.0") + f" AS w{i}" for i in range(len(FEATS)))
    gain = " + ".join(f"x{i} * e0.b{i}" for i in kept) or "0.0"
    sound = " AND ".join(f"x{i} >= 0" for i in kept) or "true"
    out.append(f"{name} AS (SELECT {at}my, {w}, {gain} AS gain, {sound} AS sound FROM {last}{', e0' if kept else ''})")
    return ", ".join(out)


def least_squares_ctes(src: str = "tr") -> str:
    """CTEs ending in ``fit``: least squares on all features."""
    return f"{moments_cte(src)}, {solve_ctes(list(range(len(FEATS))), 'fit')}"


def nonnegative_ctes(src: str = "tr") -> str:
    """CTEs ending in ``fit``: of all sets of features whose least-squares weights
    are not negative, the one that explains most."""
    d = len(FEATS)
    sets = [[i for i in range(d) if m >> i & 1] for m in range(1 << d)]
    each = ", ".join(solve_ctes(kept, f"n{m}") for m, kept in enumerate(sets))
    union = " UNION ALL ".join(f"SELECT * FROM n{m}" for m in range(len(sets)))
    return f"{moments_cte(src)}, {each}, fit AS (SELECT * FROM ({union}) WHERE sound ORDER BY gain DESC LIMIT 1)"


def least_squares_prediction(alias: str = "s") -> str:
    return "my" + "".join(f" + w{i} * ({alias}.{f} - m{i})" for i, f in enumerate(FEATS))


def stumps_sql(features: list[str], rounds: int, rate: float) -> str:
    """CTEs ``s0`` (the mean) and ``s1`` to ``s<rounds>``: boosted trees of one split
    on the ``tr`` rows, the best split of each round found by trying every value."""
    out = ["s0 AS (SELECT avg(revenue) AS mean FROM tr)"]
    for r in range(1, rounds + 1):
        used = ", ".join(f"s{k}" for k in range(r))
        out.append(f"g{r} AS (SELECT {', '.join(features)}, revenue - ({stumps_prediction(features, r - 1, rate)}) AS g FROM tr AS s, {used})")
        values = " UNION ALL ".join(f"SELECT {i} AS f, CAST({f} AS DOUBLE) AS v, count(*) AS n, sum(g) AS s FROM g{r} GROUP BY 2"
                                    for i, f in enumerate(features))
        out.append(f"c{r} AS (SELECT f, v, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(n) OVER (PARTITION BY f) AS tn, "
                   f"sum(s) OVER (PARTITION BY f) AS ts FROM ({values}) WINDOW w AS (PARTITION BY f ORDER BY v))")
        out.append(f"s{r} AS (SELECT f AS f{r}, v AS v{r}, ls / ln AS l{r}, (ts - ls) / (tn - ln) AS r{r} FROM c{r} WHERE ln < tn "
                   "ORDER BY ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) DESC, f, v LIMIT 1)")
    return ", ".join(out)


def stumps_prediction(features: list[str], rounds: int, rate: float, alias: str = "s") -> str:
    pick = lambda r: f"CASE f{r} " + " ".join(f"WHEN {i} THEN {alias}.{f}" for i, f in enumerate(features)) + " END"
    return "mean" + "".join(f" + {rate} * CASE WHEN {pick(r)} <= v{r} THEN l{r} ELSE r{r} END" for r in range(1, rounds + 1))


def tree_ctes(name: str, src: str, d: int, depth: int) -> str:
    """CTEs ending in ``<name>`` (cell ``c`` and leaf ``value``): the regression tree
    of ``src(c, f0.., n, s)``, level by level; the best cut of every node is found by
    trying every value. Cells without rows (``n`` 0) only follow the cuts."""
    out = [f"{name}_0 AS (SELECT *, 1 AS node FROM {src})"]
    for level in range(depth):
        t = f"{name}_{level}"
        values = " UNION ALL ".join(f"SELECT node, {i} AS f, CAST(f{i} AS DOUBLE) AS v, n, s FROM {t}" for i in range(d))
        pick = "CASE b.f " + " ".join(f"WHEN {i} THEN f{i}" for i in range(d)) + " END"
        out.append(f"{t}h AS (SELECT node, f, v, sum(n) AS n, sum(s) AS s FROM ({values}) GROUP BY node, f, v HAVING sum(n) > 0)")
        out.append(f"{t}w AS (SELECT node, f, v, sum(n) OVER o AS ln, sum(s) OVER o AS ls, sum(n) OVER p AS tn, sum(s) OVER p AS ts FROM {t}h "
                   "WINDOW o AS (PARTITION BY node, f ORDER BY v), p AS (PARTITION BY node, f))")
        out.append(f"{t}g AS (SELECT *, ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) - ts * ts / tn AS gain FROM {t}w WHERE ln < tn)")
        out.append(f"{t}b AS (SELECT node, f, v FROM {t}g WHERE gain > 1e-12 * greatest(1.0, abs(ts * ts / tn)) "
                   "QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1)")
        out.append(f"{name}_{level + 1} AS MATERIALIZED (SELECT t.* EXCLUDE (node), CASE WHEN b.f IS NULL THEN t.node "
                   f"WHEN {pick} <= b.v THEN 2 * t.node ELSE 2 * t.node + 1 END AS node FROM {t} AS t LEFT JOIN {t}b AS b ON t.node = b.node)")
    out.append(f"{name} AS MATERIALIZED (SELECT c, sum(s) OVER w / sum(n) OVER w AS value FROM {name}_{depth} WINDOW w AS (PARTITION BY node))")
    return ", ".join(out)


def cells_ctes(features: list[str], sums: dict[str, str]) -> str:
    """CTE ``cells(c, f0.., n, <sums>)``: all combinations of values in ``tr`` or
    ``sc``, with sums over the ``tr`` rows (``n``: how many)."""
    cols = ", ".join(f"{f} AS f{i}" for i, f in enumerate(features))
    names = ", ".join(f"f{i}" for i in range(len(features)))
    own = "".join(f", coalesce(sum({expr}) FILTER (train), 0.0) AS {name}" for name, expr in sums.items())
    return (f"cells AS MATERIALIZED (SELECT row_number() OVER () AS c, * FROM (SELECT {names}, count(*) FILTER (train) AS n{own} FROM "
            f"(SELECT {cols}, revenue AS y, true AS train FROM tr UNION ALL SELECT {cols}, revenue, false FROM sc), start GROUP BY {names}))")


def cell_join(features: list[str], row: str = "s", cell: str = "cells") -> str:
    return " AND ".join(f"{row}.{f} = {cell}.f{i}" for i, f in enumerate(features))


def boosted_sql(features: list[str], rounds: int, depth: int, rate: float) -> str:
    """CTEs ending in ``p<rounds>(c, pred)``: squared-loss boosted trees on the cells."""
    d = len(features)
    out = ["start AS (SELECT avg(revenue) AS mean FROM tr)", cells_ctes(features, {"sy": "y"}), "p0 AS (SELECT c, mean AS pred FROM cells, start)"]
    names = ", ".join(f"f{i}" for i in range(d))
    for r in range(1, rounds + 1):
        out.append(f"g{r} AS (SELECT c, {names}, n, sy - n * pred AS s FROM cells JOIN p{r - 1} USING (c))")
        out.append(tree_ctes(f"t{r}", f"g{r}", d, depth))
        out.append(f"p{r} AS (SELECT c, pred + {rate} * value AS pred FROM p{r - 1} JOIN t{r} USING (c))")
    return ", ".join(out)


def natural_round_sql(features: list[str], depth: int, rate: float, tol: float = 1e-4) -> str:
    """CTEs ending in ``dist(c, mu, sigma)``: one round of natural-gradient boosting
    of Normal(mu, exp(s)): a tree for each parameter and the line search."""
    names = ", ".join(f"f{i}" for i in range(len(features)))
    z2 = "power((y - mu0) / sd0, 2)"
    loss = ("(sum(n) * (0.5 * ln(2 * pi()) + ln(sd0)) + sum(-k * ps * n + exp(2 * k * ps) * (a + 2 * k * pm * b + k * k * pm * pm * n / (sd0 * sd0)) / 2)) / sum(n)")
    return ", ".join([
        "start AS (SELECT avg(revenue) AS mu0, stddev_pop(revenue) AS sd0 FROM tr)",
        cells_ctes(features, {"gm": "mu0 - y", "gs": f"(1 - {z2}) / 2", "a": z2, "b": "(y - mu0) / (sd0 * sd0)"}),
        f"gm AS (SELECT c, {names}, n, gm AS s FROM cells)", tree_ctes("tm", "gm", len(features), depth),
        f"gs AS (SELECT c, {names}, n, gs AS s FROM cells)", tree_ctes("ts", "gs", len(features), depth),
        "steps AS (SELECT c, n, a, b, tm.value AS pm, ts.value AS ps FROM cells JOIN tm USING (c) JOIN ts USING (c))",
        f"losses AS (SELECT k, {loss} AS loss, k * sum(n * sqrt(pm * pm + ps * ps)) / sum(n) AS norm FROM steps, start, "
        "(SELECT power(2.0, unnest(range(-20, 10))) AS k UNION ALL SELECT 0.0) GROUP BY k, sd0)",
        "before AS (SELECT loss AS loss0 FROM losses WHERE k = 0)",
        "up AS (SELECT min(k) AS k1 FROM losses, before WHERE k >= 1 AND (loss > loss0 OR NOT isfinite(loss) OR k > 256))",
        f"scale AS (SELECT coalesce(max(k), power(2.0, -20)) AS k FROM losses, before, up WHERE k <= k1 AND k > power(2.0, -20) AND isfinite(loss) "
        f"AND (loss < loss0 OR norm < {tol}))",
        f"dist AS (SELECT c, mu0 - {rate} * k * pm AS mu, sd0 * exp(-{rate} * k * ps) AS sigma FROM steps, start, scale)"])


def _inverted(inner: str, d: int) -> str:
    """``inner`` with its columns ``g<i><j>`` replaced by the inverse matrix (Gauss-Jordan, one pivot a layer)."""
    for k in range(d):
        new = [f"1 / g{k}{k} AS g{k}{k}"]
        for i in range(d):
            if i != k:
                new += [f"g{k}{i} / g{k}{k} AS g{k}{i}", f"-g{i}{k} / g{k}{k} AS g{i}{k}"]
                new += [f"g{i}{j} - g{i}{k} * g{k}{j} / g{k}{k} AS g{i}{j}" for j in range(d) if j != k]
        inner = f"SELECT * REPLACE ({', '.join(new)}) FROM ({inner})"
    return inner


def evidence_ctes(alpha_1=1e-6, alpha_2=1e-6, lambda_1=1e-6, lambda_2=1e-6, max_iter: int = 300, tol: float = 1e-3) -> str:
    """CTEs ending in ``ridge`` (one row): weights ``w<i>``, noise precision ``alpha``
    and the posterior covariance ``v<i><j>`` of the Bayesian ridge on ``tr``, by
    evidence iterations in a recursive query, each inverting a small matrix."""
    d = len(FEATS)
    gram = ", ".join(f"n * a{i}{j}" + (" + lam / alpha" if i == j else "") + f" AS g{i}{j}" for i in range(d) for j in range(d))
    solved = _inverted(f"SELECT *, {gram} FROM steps, e0, en", d)
    weight = [" + ".join(f"g{i}{j} * n * b{j} * sy" for j in range(d)) for i in range(d)]
    weights = ", ".join(f"{w} AS c{i}" for i, w in enumerate(weight))
    rss = ("n * sy * sy - 2 * (" + " + ".join(f"c{i} * n * b{i} * sy" for i in range(d)) + ") + "
           + " + ".join(f"c{i} * c{j} * n * a{i}{j}" for i in range(d) for j in range(d)))
    trace = " + ".join(f"g{i}{i}" for i in range(d))
    square = " + ".join(f"c{i} * c{i}" for i in range(d))
    moved = " + ".join(f"abs(c{i} - w{i})" for i in range(d))
    inner = (f"SELECT *, {d} - lam / alpha * ({trace}) AS gamma, greatest({rss}, 0) AS rss FROM (SELECT *, {weights} FROM ({solved}) WHERE NOT over)")
    step = (f"SELECT it + 1, (n - gamma + 2 * {alpha_1}) / (rss + 2 * {alpha_2}), (gamma + 2 * {lambda_1}) / ({square} + 2 * {lambda_2}), "
            f"{', '.join(f'c{i}' for i in range(d))}, coalesce({moved} < {tol}, false) OR it + 1 >= {max_iter} FROM ({inner})")
    none = ", ".join(f"CAST(NULL AS DOUBLE) AS w{i}" for i in range(d))
    cov = ", ".join(f"g{i}{j} / alpha AS v{i}{j}" for i in range(d) for j in range(d))
    return (f"{moments_cte()}, en AS (SELECT count(*) AS n FROM tr), "
            f"steps AS (SELECT 0 AS it, 1 / (sy * sy + 2.220446049250313e-16) AS alpha, CAST(1.0 AS DOUBLE) AS lam, {none}, false AS over FROM e0 UNION ALL {step}), "
            f"final AS (SELECT * FROM steps WHERE over ORDER BY it DESC LIMIT 1), "
            f"ridge AS (SELECT my, alpha, {', '.join(f'm{i}, s{i}' for i in range(d))}, {cov}, {', '.join(f'{w} AS u{i}' for i, w in enumerate(weight))} "
            f"FROM ({_inverted(f'SELECT *, {gram} FROM final, e0, en', d)}))")


def ridge_columns(alias: str = "s") -> tuple[str, str]:
    """Predictive mean and standard deviation of a row by ``ridge``."""
    z = [f"({alias}.{f} - m{i}) / s{i}" for i, f in enumerate(FEATS)]
    mu = "my" + "".join(f" + u{i} * {t}" for i, t in enumerate(z))
    var = " + ".join(f"v{i}{j} * {z[i]} * {z[j]}" for i in range(len(z)) for j in range(len(z)))
    return mu, f"sqrt({var} + 1 / alpha)"


def newton_ctes(src: str, features: list[str], label: str, steps: int) -> str:
    """CTEs ending in ``beta<steps>(b0, ..)``: Newton steps of logistic regression on
    the scaled features of ``src``, each one aggregate and one small inverse."""
    d = len(features)
    z = ["1.0"] + [f"coalesce((CAST({f} AS DOUBLE) - m{i}) / nullif(s{i}, 0), 0.0)" for i, f in enumerate(features)]
    cols = ", ".join(f"avg({f}) AS m{i}, stddev_pop({f}) AS s{i}" for i, f in enumerate(features))
    out = [f"scale AS (SELECT {cols} FROM {src})",
           f"scaled AS (SELECT CAST({label} AS DOUBLE) AS y, {', '.join(f'{e} AS z{i}' for i, e in enumerate(z))} FROM {src}, scale)",
           "beta0 AS (SELECT " + ", ".join(f"CAST(0 AS DOUBLE) AS b{i}" for i in range(d + 1)) + ")"]
    margin = " + ".join(f"b{i} * z{i}" for i in range(d + 1))
    for k in range(1, steps + 1):
        sums = [f"sum(p * (1 - p) * z{i} * z{j}) AS g{i}{j}" for i in range(d + 1) for j in range(d + 1)]
        sums += [f"sum((y - p) * z{i}) AS r{i}" for i in range(d + 1)] + [f"any_value(b{i}) AS b{i}" for i in range(d + 1)]
        out.append(f"sums{k} AS (SELECT {', '.join(sums)} FROM (SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM scaled, beta{k - 1}))")
        new = ", ".join(f"b{i} + " + " + ".join(f"g{i}{j} * r{j}" for j in range(d + 1)) + f" AS b{i}" for i in range(d + 1))
        out.append(f"beta{k} AS (SELECT {new} FROM ({_inverted(f'SELECT * FROM sums{k}', d + 1)}))")
    return ", ".join(out)


def draws_sql(source: str, trial: str, spaces: dict, seed: int = 42) -> str:
    """``family, trial, param, value`` of every declared parameter for the trial numbers of a table."""
    out = []
    for family, space in spaces.items():
        for p in space:
            u = f"(CAST('0x' || substr(md5('{seed}:{family}:' || {trial} || ':{p.name}'), 1, 13) AS BIGINT) / {float(16 ** 13)!r})"
            if p.kind == "categorical":
                n = len(p.choices)
                value = f"CASE least(floor({u} * {n}), {n - 1}) " + " ".join(f"WHEN {i} THEN {float(c)!r}" for i, c in enumerate(p.choices)) + " END"
            elif p.kind == "int":
                value = f"least({int(p.low)} + floor({u} * {int(p.high) - int(p.low) + 1}), {int(p.high)})"
            elif p.log:
                value = f"exp(ln({p.low!r}) + {u} * (ln({p.high!r}) - ln({p.low!r})))"
            else:
                value = f"{p.low!r} + {u} * ({p.high!r} - {p.low!r})"
            out.append(f"SELECT '{family}' AS family, CAST({trial} AS INTEGER) AS trial, '{p.name}' AS param, round(CAST({value} AS DOUBLE), 12) AS value FROM {source}")
    return " UNION ALL ".join(out)


def linear_trials_sql(n_trials: int, seed: int = 42, fraction: float = 0.2) -> str:
    """The least-squares family's trial log on ``tr``: draws, the exact hold-out, the
    four fits that the draws can ask for, their validation metrics and the best trial."""
    d = len(FEATS)
    sets = [[i for i in range(d) if m >> i & 1] for m in range(1 << d)]
    each = ", ".join(solve_ctes(kept, f"n{m}") for m, kept in enumerate(sets))
    union = " UNION ALL ".join(f"SELECT * FROM n{m}" for m in range(len(sets)))
    order = ", ".join([h32("row_id", seed), "row_id", *FEATS, "revenue"])
    slope = " + ".join(f"w{i} * (v.{f} - m{i})" for i, f in enumerate(FEATS))
    u = lambda name: f"(CAST('0x' || substr(md5('{seed}:linear_regression:' || trial || ':{name}'), 1, 13) AS BIGINT) / {float(16 ** 13)!r})"
    return (
        f"numbered AS (SELECT *, row_number() OVER (ORDER BY {order}) AS rn, count(*) OVER () AS n FROM tr), "
        f"fitted AS (SELECT * FROM numbered WHERE rn > ceil({fraction} * n)), held AS (SELECT * FROM numbered WHERE rn <= ceil({fraction} * n)), "
        f"{moments_cte('fitted')}, {each}, fits AS (SELECT false AS positive, * FROM n{len(sets) - 1} UNION ALL "
        f"SELECT true, * FROM (SELECT * FROM ({union}) WHERE sound ORDER BY gain DESC LIMIT 1)), "
        f"scores AS (SELECT fit_intercept, positive, sqrt(avg(power(v.revenue - p, 2))) AS rmse, 1 - sum(power(v.revenue - p, 2)) / regr_syy(v.revenue, v.revenue) AS r2 "
        f"FROM (SELECT v.revenue, i.fit_intercept, f.positive, CASE WHEN i.fit_intercept THEN my ELSE 0 END + {slope} AS p FROM held AS v, fits AS f, "
        "(SELECT unnest([true, false]) AS fit_intercept) AS i) AS v GROUP BY fit_intercept, positive), "
        f"draws AS (SELECT trial, floor({u('fit_intercept')} * 2) = 0 AS fit_intercept, floor({u('positive')} * 2) = 0 AS positive "
        f"FROM (SELECT unnest(range({n_trials})) AS trial)) "
        "SELECT CAST(trial AS INTEGER) AS trial, fit_intercept, positive, round(rmse, 3) AS val_rmse, round(r2, 9) AS val_r2, "
        "row_number() OVER (ORDER BY round(rmse, 6), trial) = 1 AS best FROM draws JOIN scores USING (fit_intercept, positive)")
