"""How far fitted linear and layered models are from their optimum, as one aggregate over the rows.

A convex objective is minimal where its gradient is zero (logistic loss) or where zero lies in the
interval of its subgradients (hinge loss). The penalty is Spark's: half ``regParam`` times the
squared coefficients, each times its feature's deviation where the fit standardised.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def linear_score(x: Column, coefficients: Sequence[float], intercept: float) -> Column:
    """Weighted sum of an array column."""
    weights = F.array(*[F.lit(float(c)) for c in coefficients])
    return F.aggregate(F.zip_with(x, weights, lambda a, b: a * b), F.lit(float(intercept)), lambda a, v: a + v)


def _with_terms(df: DataFrame, features: str) -> DataFrame:
    """Features as an array with a one in front, for the intercept."""
    return df.withColumn("_x", F.concat(F.array(F.lit(1.0)), vector_to_array(features)))


def _scales(df: DataFrame, width: int, standardised: bool) -> list[float]:
    """Squared deviation of each feature, or ones."""
    if not standardised:
        return [1.0] * width
    row = df.agg(*[F.var_samp(F.get("_x", F.lit(j + 1))).alias(f"v{j}") for j in range(width)]).first()
    return [float(v or 0.0) for v in row]


def _rows(df: DataFrame, sums: list[Column], names: Sequence[str], terms: int) -> DataFrame:
    """One aggregate turned into a row per term (0 is the intercept)."""
    row = df.agg(*sums)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(j).alias("term"), *[F.col(f"{n}{j}").alias(n) for n in names]) for j in range(terms)])))


def logistic_gradient(df: DataFrame, coefficients: Sequence[float], intercept: float, reg: float, *,
                      label: str = "label", features: str = "features", standardised: bool = True) -> DataFrame:
    """(term, gradient) of the mean logistic loss of labels 0 and 1 plus penalty at the weights given."""
    rows = _with_terms(df, features)
    scale = _scales(rows, len(coefficients), standardised)
    off = 1.0 / (1.0 + F.exp(-linear_score(F.slice("_x", 2, len(coefficients)), coefficients, intercept))) - F.col(label)
    rows = rows.withColumn("_off", off)
    sums = [(F.avg(F.col("_off") * F.get("_x", F.lit(j)))
             + (0.0 if j == 0 else reg * scale[j - 1] * float(coefficients[j - 1]))).alias(f"gradient{j}")
            for j in range(len(coefficients) + 1)]
    return _rows(rows, sums, ["gradient"], len(coefficients) + 1)


def hinge_interval(df: DataFrame, coefficients: Sequence[float], intercept: float, reg: float, *, slack: float,
                   label: str = "label", features: str = "features", standardised: bool = True) -> DataFrame:
    """(term, low, high): subgradients of the mean hinge loss plus penalty. A row whose margin is within
    ``slack`` of one counts with any share of its term."""
    rows = _with_terms(df, features)
    scale = _scales(rows, len(coefficients), standardised)
    side = 2.0 * F.col(label) - 1.0
    margin = side * linear_score(F.slice("_x", 2, len(coefficients)), coefficients, intercept)
    rows = rows.withColumns({"_side": side, "_inside": margin < 1.0 - slack, "_edge": F.abs(margin - 1.0) <= slack})
    sums = []
    for j in range(len(coefficients) + 1):
        term = -F.col("_side") * F.get("_x", F.lit(j))
        fixed = F.avg(F.when(F.col("_inside"), term).otherwise(0.0)) + (0.0 if j == 0 else reg * scale[j - 1] * float(coefficients[j - 1]))
        sums += [(fixed + F.avg(F.when(F.col("_edge"), F.least(term, F.lit(0.0))).otherwise(0.0))).alias(f"low{j}"),
                 (fixed + F.avg(F.when(F.col("_edge"), F.greatest(term, F.lit(0.0))).otherwise(0.0))).alias(f"high{j}")]
    return _rows(rows, sums, ["low", "high"], len(coefficients) + 1)


def hinge_objective(df: DataFrame, points: Sequence[tuple[Sequence[float], float]], reg: float, *, label: str = "label",
                    features: str = "features", standardised: bool = True) -> DataFrame:
    """(point, objective): the mean hinge loss plus penalty at several weights, in one aggregate."""
    rows = _with_terms(df, features)
    width = len(points[0][0])
    scale = _scales(rows, width, standardised)
    side = 2.0 * F.col(label) - 1.0
    sums = [(F.avg(F.greatest(1.0 - side * linear_score(F.slice("_x", 2, width), c, b), F.lit(0.0)))
             + 0.5 * reg * sum(s * float(w) ** 2 for s, w in zip(scale, c, strict=True))).alias(f"objective{i}")
            for i, (c, b) in enumerate(points)]
    return _rows(rows, sums, ["objective"], len(points)).withColumnRenamed("term", "point")


# --- networks ------------------------------------------------------------------------------------

def layer_weights(weights: Sequence[float], layers: Sequence[int]) -> list[tuple[list[list[float]], list[float]]]:
    """Flat network weights cut into layers: rows of weights per output, and biases.

    A layer's weights are stored by input (all outputs of the first input first), then its biases.
    """
    if len(weights) != sum((i + 1) * o for i, o in zip(layers[:-1], layers[1:], strict=True)):
        raise ValueError(f"{len(weights)} weights for layers {list(layers)}")
    out, at = [], 0
    for inputs, outputs in zip(layers[:-1], layers[1:], strict=True):
        flat = [float(w) for w in weights[at: at + inputs * outputs]]
        at += inputs * outputs
        out.append(([[flat[i * outputs + o] for i in range(inputs)] for o in range(outputs)],
                    [float(b) for b in weights[at: at + outputs]]))
        at += outputs
    return out


def _layer(x: Column, rows: Sequence[Sequence[float]], biases: Sequence[float], inner: bool) -> Column:
    """Outputs of one layer as an array: logistic units inside, shares of the classes at the end."""
    units = F.array(*[F.struct(F.array(*map(F.lit, row)).alias("w"), F.lit(b).alias("b")) for row, b in zip(rows, biases, strict=True)])
    sums = F.transform(units, lambda u: F.aggregate(F.zip_with(x, u["w"], lambda a, w: a * w), u["b"], lambda a, v: a + v))
    if inner:
        return F.transform(sums, lambda s: 1.0 / (1.0 + F.exp(-s)))
    powers = F.transform(sums, lambda s: F.exp(s - F.array_max(sums)))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, v: a + v))


def network_scored(df: DataFrame, weights: Sequence[float], layers: Sequence[int], features: str = "features") -> DataFrame:
    """``df`` with the outputs of the network's layers as ``layer1``, ``layer2``, ... and the class with
    the largest share (the lowest on a tie) as ``told``. One projection a layer."""
    rows, source = df, vector_to_array(features)
    cut = layer_weights(weights, layers)
    for i, (table, biases) in enumerate(cut):
        rows = rows.withColumn(f"layer{i + 1}", _layer(source, table, biases, i + 1 < len(cut)))
        source = F.col(f"layer{i + 1}")
    return rows.withColumn("told", (F.array_position(source, F.array_max(source)) - 1).cast("double"))


def last_layer_gradient(scored: DataFrame, layers: Sequence[int], label: str = "label") -> DataFrame:
    """One row: the largest slope of the mean cross entropy in a weight or bias of the last layer."""
    depth = len(layers) - 1
    above = F.col(f"layer{depth}")
    below = F.concat(F.array(F.lit(1.0)), F.col(f"layer{depth - 1}"))
    slopes = [F.abs(F.avg((F.get(above, F.lit(o)) - F.when(F.col(label) == float(o), 1.0).otherwise(0.0)) * F.get(below, F.lit(i))))
              for o in range(layers[-1]) for i in range(layers[-2] + 1)]
    return scored.agg(F.greatest(*slopes).alias("largest"), F.count(F.lit(1)).alias("n"))
