"""Whitening against full eigenvalue decomposition, exact sums and edge cases."""

from decimal import Decimal

import numpy as np
import pytest

from tidewatch.llm.common import table
from tidewatch.llm.whitening import Spectrum, above, whiten

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def rows_of(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], schema)


def brute(vectors, k=32):
    x = np.array([[int(np.floor(64.0 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = ((n * x - s) ** 2).sum(axis=1)
    centred = ((n * x - s) / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    k = min(k, int((values > values[0] * 1e-9).sum()))
    return n, deviation, centred @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def check(done, vectors):
    n, deviation, whitened, explained = brute(vectors)
    got = done.toPandas().sort_values(["vec_id", "component"])
    k = len(explained)
    assert len(got) == n * k
    assert set(got["n"]) == {n} and got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] <= 1e-9
    assert got["deviation"].to_numpy().reshape(n, k)[:, 0].tolist() == deviation.tolist()
    assert np.allclose(got["explained"].to_numpy().reshape(n, k)[0], explained, rtol=1e-9)
    own = got["whitened"].to_numpy().reshape(n, k)
    sign = np.sign((own * whitened).sum(axis=0))
    assert np.allclose(own * sign, whitened, atol=1e-6)


def test_whole_table(spark):
    held = table(spark, SF, "embeddings")
    vectors = [r.embedding for r in held.orderBy("vec_id").collect()]
    check(whiten(held), vectors)


def test_partitions_do_not_matter(spark):
    held = table(spark, SF, "embeddings")
    keys = ["vec_id", "component"]
    one = whiten(held.repartition(7)).toPandas().sort_values(keys)
    two = whiten(held.coalesce(1)).toPandas().sort_values(keys)
    for name in ("vec_id", "component", "n", "deviation", "explained"):
        assert one[name].tolist() == two[name].tolist()
    assert np.allclose(one["whitened"], two["whitened"], rtol=1e-12, atol=1e-12)


def test_counts_against_all_eigenvalues():
    draw = np.random.default_rng(3)
    for d in (1, 2, 3, 17, 40):
        a = draw.standard_normal((d, d))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in [*((values[1:] + values[:-1]) / 2), values[0] - 1, values[-1] + 1, 0.0]:
            assert above(a, shift) == int((values > shift).sum())


@pytest.mark.parametrize("values", [[5, 5, 5, 2, 1], [3, 3 - 1e-9, 1, 1, 0], [1, 1, 1, 1, 1], [7, 0, 0, 0, 0], [1e6, 1, 1 - 1e-12, 0.5, 1e-3]])
def test_equal_and_close_eigenvalues(values):
    basis = np.linalg.qr(np.random.default_rng(5).standard_normal((5, 5)))[0]
    matrix = basis @ np.diag(values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    got, vectors = Spectrum(matrix).leading(5)
    wanted = np.array([v for v in values if v > 0], dtype=float)
    assert np.allclose(got, wanted, rtol=1e-9, atol=1e-9 * wanted[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(wanted)), atol=1e-9)
    assert np.allclose(vectors.T @ matrix @ vectors, np.diag(got), atol=1e-9 * wanted[0])


def test_rows_that_take_no_part(spark):
    draw = np.random.default_rng(1)
    sound = draw.standard_normal((30, 4)).astype("float32").tolist()
    odd = [None, [], [None, 1.0, 2.0, 3.0], [float("nan"), 0.0, 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0], [3e38, 0.0, 0.0, 0.0]]
    check(whiten(rows_of(spark, sound + odd)), sound)


def test_null_and_repeated_ids_and_clashing_columns(spark):
    draw = np.random.default_rng(2)
    rows = [(i % 7 or None, v, 1, "x") for i, v in enumerate(draw.standard_normal((21, 3)).tolist())]
    done = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n long, component string"))
    assert done.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert done.count() == 63 and done.where("vec_id IS NULL").count() == 9


def test_nothing_to_whiten(spark):
    assert whiten(rows_of(spark, [])).count() == 0
    assert whiten(rows_of(spark, [None, []])).count() == 0
    assert whiten(rows_of(spark, [[1.0, 2.0]])).count() == 0
    assert whiten(rows_of(spark, [[1.0, 2.0]] * 5)).count() == 0


def test_constant_dimension_and_few_rows(spark):
    check(whiten(rows_of(spark, [[1.0, float(i), float(i * i)] for i in range(9)])), [[1.0, float(i), float(i * i)] for i in range(9)])
    draw = np.random.default_rng(4).standard_normal((5, 12)).tolist()
    got = whiten(rows_of(spark, draw)).toPandas()
    assert got["component"].max() == 4 and got["identity_error"].iloc[0] < 1e-6


def test_large_entries_stay_exact(spark):
    wide = [[float(i * 2**40), float((-1) ** i * i)] for i in range(6)]
    got = whiten(rows_of(spark, wide, "vec_id long, embedding array<double>")).toPandas()
    x = [[int(Decimal(c) * 64) + 1_000_000 for c in v] for v in wide]
    sums = [sum(c) for c in zip(*x)]
    wanted = {i: sum((6 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}
    for row in got.itertuples():
        assert wanted[row.vec_id] >= 2**63 and np.isnan(row.deviation)
