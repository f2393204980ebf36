"""Distance of fitted models from their optimum, and the network as expressions."""

import math

import pytest
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabquorum.operators.certificates import (hinge_interval, hinge_objective, last_layer_gradient, layer_weights, logistic_gradient,
                                              network_scored)


@pytest.fixture(scope="module")
def two(squares):
    return squares.withColumn("label", (F.col("label") > 0).cast("double")).cache()


@pytest.fixture(scope="module")
def points(two):
    return [(r.label, list(r.features)) for r in two.collect()]


@pytest.mark.parametrize("standardised", [True, False])
def test_gradient_against_differences_of_the_loss(two, points, standardised):
    weights, bias, reg = [0.3, -0.2], 0.1, 0.05
    n = len(points)
    scale = [1.0, 1.0]
    if standardised:
        means = [sum(x[j] for _, x in points) / n for j in range(2)]
        scale = [sum((x[j] - means[j]) ** 2 for _, x in points) / (n - 1) for j in range(2)]

    def loss(w, b):
        total = sum(math.log(1 + math.exp(-(2 * y - 1) * (b + w[0] * x[0] + w[1] * x[1]))) for y, x in points) / n
        return total + reg / 2 * sum(s * v * v for s, v in zip(scale, w, strict=True))

    got = {r.term: r.gradient for r in logistic_gradient(two, weights, bias, reg, standardised=standardised).collect()}
    h = 1e-5
    assert got[0] == pytest.approx((loss(weights, bias + h) - loss(weights, bias - h)) / (2 * h), abs=1e-6)
    for j in range(2):
        up, down = list(weights), list(weights)
        up[j], down[j] = up[j] + h, down[j] - h
        assert got[j + 1] == pytest.approx((loss(up, bias) - loss(down, bias)) / (2 * h), abs=1e-6)


@pytest.mark.parametrize("standardised", [True, False])
def test_gradient_vanishes_at_convergence_and_nowhere_else(two, standardised):
    fit = lambda steps: LogisticRegression(maxIter=steps, tol=1e-12, regParam=0.02, standardization=standardised).fit(two)
    largest = lambda m: max(abs(r.gradient) for r in logistic_gradient(
        two, m.coefficients, m.intercept, 0.02, standardised=standardised).collect())
    assert largest(fit(300)) < 1e-6 < 1e-3 < largest(fit(1))


def test_hinge_interval_and_objective(two, points):
    weights, bias, reg = [0.05, 0.1], -1.0, 0.1
    n = len(points)
    margins = [((2 * y - 1), (2 * y - 1) * (bias + weights[0] * x[0] + weights[1] * x[1]), x) for y, x in points]
    got = {r.term: (r.low, r.high) for r in hinge_interval(two, weights, bias, reg, slack=0.01, standardised=False).collect()}
    for term in range(3):
        value = lambda s, x, t=term: -s * (1.0 if t == 0 else x[t - 1])
        fixed = sum(value(s, x) for s, m, x in margins if m < 1 - 0.01) / n + (0 if term == 0 else reg * weights[term - 1])
        edge = [value(s, x) for s, m, x in margins if abs(m - 1) <= 0.01]
        assert got[term] == pytest.approx((fixed + sum(min(v, 0) for v in edge) / n, fixed + sum(max(v, 0) for v in edge) / n))
    want = sum(max(0.0, 1 - m) for _, m, _ in margins) / n + reg / 2 * sum(w * w for w in weights)
    found = hinge_objective(two, [(weights, bias), ([0.0, 0.0], 0.0)], reg, standardised=False).orderBy("point").collect()
    assert found[0].objective == pytest.approx(want) and found[1].objective == pytest.approx(1.0)


def test_network_layers(two):
    layers = [2, 4, 3, 2]
    model = MultilayerPerceptronClassifier(layers=layers, maxIter=40, seed=3).fit(two)
    scored = network_scored(model.transform(two), list(model.weights), layers)
    share = vector_to_array("probability")
    row = scored.agg(F.count_if(F.col("told") != F.col("prediction")), F.max(F.abs(share[1] - F.col("layer3")[1]))).first()
    assert row[0] == 0 and row[1] < 1e-9
    cut = layer_weights([float(w) for w in model.weights], layers)
    assert [(len(rows), len(rows[0]), len(biases)) for rows, biases in cut] == [(4, 2, 4), (3, 4, 3), (2, 3, 2)]
    with pytest.raises(ValueError):
        layer_weights([0.0] * 5, layers)


def test_slope_of_the_last_layer_against_differences(two):
    layers, h = [2, 3, 2], 1e-5
    weights = [((i * 37) % 11 - 5) / 7 for i in range(3 * 3 + 4 * 2)]

    def loss(w):
        scored = network_scored(two, w, layers)
        return scored.agg(F.avg(-F.log(F.get("layer2", F.col("label").cast("int"))))).first()[0]

    slopes = []
    for i in range(9, len(weights)):
        up, down = list(weights), list(weights)
        up[i], down[i] = up[i] + h, down[i] - h
        slopes.append(abs(loss(up) - loss(down)) / (2 * h))
    assert last_layer_gradient(network_scored(two, weights, layers), layers).first().largest == pytest.approx(max(slopes), abs=1e-5)
