import numpy as np
import pytest

from nestmetrics.llm import embeddings


def slow(vectors, cosine):
    units = []
    for v in vectors:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        scaled = np.array(v, dtype=float) / max(map(abs, v)) if ok else None
        units.append(scaled / np.linalg.norm(scaled) if ok else None)
    near = lambda a, b: a is not None and b is not None and len(a) == len(b) and a @ b >= cosine
    links = [[j for j, b in enumerate(units) if j != i and near(a, b)] for i, a in enumerate(units)]
    label = list(range(len(units)))
    for _ in units:
        label = [min([label[i], *(label[j] for j in links[i])]) for i in range(len(units))]
    return [(i, len(links[i]), label[i], label[i] == i) for i in range(len(units))]


@pytest.mark.parametrize("cell_rows", [100_000, 1])
def test_links_against_all_pairs(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(embeddings, "CELL_ROWS", cell_rows)
    rng = np.random.default_rng(cell_rows)
    base = rng.standard_normal((25, 19))
    vectors = [(base[i % 25] + rng.standard_normal(19) * (0.03 + 0.02 * (i % 9))).tolist() for i in range(200)]
    vectors += [vectors[3]] * 4 + [[2 * x for x in vectors[3]], None, [], [0.0] * 19, [float("nan")] * 19, [None] * 19, [1e300] * 19, [1.0] * 19, [1.0, 2.0]]
    frame = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, unit string")
    got = sorted(tuple(r) for r in embeddings.near_vectors(frame).collect())
    assert got == slow(vectors, 0.95)


def test_empty_table_and_odd_ids(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_vectors(empty).count() == 0
    rows = embeddings.near_vectors(spark.createDataFrame([(None, [1.0, 0.0]), (4, [1.0, 0.0]), (4, [1.0, 0.01]), (None, None)], "vec_id long, embedding array<float>")).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in rows) == [("4", 2, "4"), ("4", 2, "4"), ("None", 0, "None"), ("None", 2, "4")]
