"""Outlier removal against plain versions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.operators import ml, robust


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    x = rng.multivariate_normal([0, 0], [[1, 0.98], [0.98, 1]], 400)
    # Within each dimension's range, but off the diagonal.
    return np.vstack([x, [[1.5, -1.5], [-1.5, 1.5], [1.2, -1.4]]])


@pytest.fixture(scope="module")
def data(spark, points):
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "row int, v array<double>")
    return ml.features(df.repartition(3), ["v"])


def test_planted_outliers_do_not_hide_themselves(spark):
    """A tight group far out draws the plain covariance towards itself, but not the robust one."""
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.multivariate_normal([0, 0, 0], np.diag([1.0, 4.0, 0.25]), 1200), rng.normal(size=(300, 3)) * 0.1 + [6, 12, 3]])
    rows = spark.createDataFrame([(p.tolist(),) for p in rng.permutation(x)], "v array<double>").repartition(5)
    found = robust.minimum_covariance_determinant(rows)
    assert found.center == pytest.approx([0, 0, 0], abs=0.2) and np.diag(found.covariance) == pytest.approx([1, 4, 0.25], rel=0.25)
    plain = robust.Scatter.of_rows(x)
    assert plain.distances(x[1200:]).max() < np.quantile(plain.distances(x[:1200]), 0.99) and found.distances(x[1200:]).min() > 5 * np.quantile(found.distances(x[:1200]), 0.99)
    data = ml.features(spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "row int, v array<double>").repartition(4), ["v"])
    assert max(r.row for r in ml.without_outliers(data, "elliptic", 0.2).select("row").collect()) < 1200


def test_concentration_over_all_rows_never_widens(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 2)) * [1, 3]
    rows = spark.createDataFrame([(p.tolist(),) for p in x], "v array<double>").repartition(3)
    start = robust.Scatter.of_rows(x[:5])
    reach = float(np.sort(start.distances(x))[200])
    found = robust.Scatter.of_moments(robust.moments_within(rows, "v", start, reach))
    own = robust.Scatter.of_rows(x[start.distances(x) <= reach])
    assert found.center == pytest.approx(own.center) and found.covariance == pytest.approx(own.covariance)


def test_odd_tables(spark):
    assert robust.minimum_covariance_determinant(spark.createDataFrame([], "v array<double>")) is None
    same = spark.createDataFrame([([1.0, 2.0],)] * 5, "v array<double>")
    assert robust.minimum_covariance_determinant(same).center == pytest.approx([1, 2])
    for method in ("elliptic", "forest", "lof"):
        data = ml.features(spark.createDataFrame([(1, [1.0, 2.0])], "row int, v array<double>"), ["v"])
        assert ml.without_outliers(data.limit(0), method).count() == 0 and ml.without_outliers(data, method).count() in (0, 1)


@pytest.mark.parametrize("method", ["lof", "elliptic", "elliptic_envelope"])
def test_outliers_of_correlated_features_go(data, method):
    kept = {r.row for r in ml.without_outliers(data, method, 0.02).select("row").collect()}
    assert not kept & {400, 401, 402} and len(kept) >= 390


def test_names_of_the_reference(data):
    kept = [ml.without_outliers(data, m).agg(F.sort_array(F.collect_list("row"))).first()[0] for m in ("forest", "isolation_forest")]
    assert kept[0] == kept[1] and len(kept[0]) < 403
