import numpy as np
import pytest

from faresight.operators import linear as LN


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 6))
    y = 3 + x @ np.array([2.0, 0, -1.0, 0.5, 0, 0]) + rng.normal(size=600) * 0.3
    rows = [(*map(float, r), float(t), i % 5) for i, (r, t) in enumerate(zip(x, y))] + [(None, *[0.0] * 5, 1.0, 2)]
    cols = [f"x{j}" for j in range(6)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", y double, fold int").repartition(3), cols, x, y


def test_ridge_is_the_closed_form(data):
    df, cols, x, y = data
    m = LN.moments(df, cols, "y")[0]
    xc, yc = x - x.mean(0), y - y.mean()
    for a in (0.0, 10.0, 1e4):
        w = np.linalg.solve(xc.T @ xc + a * np.eye(6), xc.T @ yc)
        got = LN.ridge(m, a)
        assert np.allclose(got, [y.mean() - x.mean(0) @ w, *w])
        pred = got[0] + x @ got[1:]
        assert LN.r2_on(m, got) == pytest.approx(1 - ((y - pred) ** 2).sum() / (yc ** 2).sum())
    assert np.allclose(LN.absolute_errors(df, cols, "y", [got, LN.ridge(m, 0.0)])[0], np.abs(y - pred).mean())


def test_lasso_meets_its_optimality_conditions(data):
    df, cols, x, y = data
    m = LN.moments(df, cols, "y")[0]
    for a, w in zip((0.01, 0.2, 5.0), LN.path(m, (0.01, 0.2, 5.0), "lasso")):
        g = x.T @ (y - w[0] - x @ w[1:]) / len(y)
        assert np.all(np.abs(g) <= a + 1e-6) and np.allclose(g[w[1:] != 0], a * np.sign(w[1:][w[1:] != 0]), atol=1e-6)
    assert not LN.lasso(m, 5.0)[1:].any()


def test_cross_validated_lasso_matches_refits(data):
    df, cols, x, y = data
    folds = LN.moments(df, cols, "y", "fold")
    best, errors, coef = LN.lasso_cv(folds, (0.001, 0.1, 1.0))
    fold = np.arange(600) % 5
    for a in (0.1, 1.0):
        mse = []
        for f in range(5):
            tr = np.column_stack([np.ones((fold != f).sum()), x[fold != f], y[fold != f]])
            w = LN.lasso(tr.T @ tr, a)
            mse.append(((y - w[0] - x @ w[1:])[fold == f] ** 2).mean())
        assert errors[a] == pytest.approx(np.mean(mse), rel=1e-6)
    assert best == 0.001 and np.allclose(coef[1:], [2, 0, -1, 0.5, 0, 0], atol=0.06)


def test_linear_fit_agrees_with_mllib(data):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    df, cols, _, _ = data
    v = VectorAssembler(inputCols=cols, outputCol="features").transform(df.dropna())
    m = LinearRegression(labelCol="y").fit(v)
    assert np.allclose(LN.ridge(LN.moments(df, cols, "y")[0], 0.0), [m.intercept, *m.coefficients.toArray()], atol=1e-6)
