import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldcohort.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def _vectors(count=300, size=24):
    rng = np.random.default_rng(2)
    base = rng.normal(0, 1, (count, size)) * np.linspace(3, 0.2, size)
    rows = [(i, [float(np.float32(v)) for v in x], i % 3) for i, x in enumerate(base)]
    rows += [(1000 + k, rows[0][1], 1) for k in range(200)] + [(7, rows[7][1], 1), (None, rows[5][1], None)]
    return rows + [(2000, None, 1), (2001, [None] * size, 1), (2002, [float("nan")] * size, 1), (2003, [float("inf")] + [0.0] * (size - 1), 1)]


def _fit_list(rows):
    fine = [(i, np.floor(64 * np.array(v, float)).astype(int) + 1_000_000) for i, v, _ in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    return fine, np.array(sorted({tuple(x) for _, x in fine}))


def test_whitened_rows_equal_a_dense_decomposition(spark):
    rows = _vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(5).selectExpr("*", "label id", "label x", "label component")
    found = whitening.whiten(df).collect()
    fine, fit = _fit_list(rows)
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    assert len(found) == 16 * len(fine) and {r.component for r in found} == set(range(1, 17))
    want = {}
    for i, x in fine:
        far = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
        want.setdefault(i, (far, np.abs((x - sums / n) @ vectors / np.sqrt(values))))
    for r in found:
        far, white = want[r.id]
        assert r.n == n and int(r.deviation) == far and r.identity_error < 1e-9
        assert abs(abs(r.whitened) - white[r.component - 1]) < 1e-7
        assert abs(r.explained / (values[r.component - 1] / np.trace(y.T @ y / n)) - 1) < 1e-9
    signs = {}
    for r in found:
        signs.setdefault((r.id, r.component), set()).add(r.whitened)
    assert all(len(s) == 1 for s in signs.values())


@pytest.mark.parametrize("kind", ["plain", "equal", "close", "rank", "diagonal", "one", "two"])
def test_eigen_is_exact_on_hard_spectra(kind):
    rng = np.random.default_rng(4)
    size = {"one": 1, "two": 2}.get(kind, 40)
    q, _ = np.linalg.qr(rng.standard_normal((size, size)))
    spectrum = {"plain": np.linspace(9, 1, 40), "equal": np.r_[[5.0] * 20, [1.0] * 20], "close": 3 + 1e-9 * np.arange(40)[::-1], "rank": np.r_[[4.0, 2.0], [0.0] * 38]}.get(kind, np.arange(size, 0, -1.0))
    matrix = np.diag(spectrum) if kind == "diagonal" else (q * spectrum) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.eigen(matrix, 16)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][: len(values)], rtol=0, atol=1e-13 * 40)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * 40


def test_sturm_counts():
    rng = np.random.default_rng(1)
    d, e = rng.standard_normal(30), rng.standard_normal(29)
    true = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-4, 4, 50)
    assert (whitening.sturm_count(d, e, at) == (true[None, :] < at[:, None]).sum(axis=1)).all()


def test_degenerate_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, VECTORS)
    assert whitening.whiten(make([])).count() == 0
    assert whitening.whiten(make([(1, None, 1), (2, [], 1)])).count() == 0
    assert whitening.whiten(make([(1, [1.0, 2.0], 1)] * 5)).count() == 0
    line = whitening.whiten(make([(i, [float(i), 2.0 * i, 0.0], 1) for i in range(10)])).collect()
    assert len(line) == 10 and {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-12 for r in line)
    ragged = whitening.whiten(make([(1, [1.0], 1), (2, [1.0, 2.0], 1), (3, [4.0, 2.0], 1), (4, [0.0, 0.0, 0.0], 1)])).collect()
    assert {r.id for r in ragged} == {2, 3} and {r.n for r in ragged} == {2}


def test_deviation_is_exact_beyond_64_bits(spark):
    df = spark.range(50).select(F.col("id").alias("vec_id"), F.array((F.col("id") * 1e12).cast("double"), (F.col("id") * -3e11).cast("double"), F.pmod("id", F.lit(3)).cast("double")).alias("embedding"))
    x = {i: (int(np.floor(64 * (i * 1e12))) + 1_000_000, int(np.floor(64 * (i * -3e11))) + 1_000_000, 64 * (i % 3) + 1_000_000) for i in range(50)}
    sums = [sum(v[k] for v in x.values()) for k in range(3)]
    for r in whitening.whiten(df).collect():
        assert int(r.deviation) == sum((50 * v - s) ** 2 for v, s in zip(x[r.id], sums))
