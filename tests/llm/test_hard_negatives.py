import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from nestmetrics.llm import hard_negatives


def slow(rows, first_positives=5, first_negatives=10):
    """Lists by all inner products, in plain Python integers."""
    sound = []
    for row, (id_, label, v) in enumerate(rows):
        if id_ is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * x) for x in v]
        if all(abs(x) < hard_negatives.LIMIT for x in whole):
            sound.append((id_, row, label, whole))
    out = []
    for id_, row, label, v in sound:
        if id_ % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i, r, other) for i, r, other, w in sound if r != row and len(w) == len(v))
        for p, positive, _, _ in [x for x in scored if x[3] == label][:first_positives]:
            fits = [(s, i) for s, i, _, other in scored if other != label and 30 * -p <= 100 * -s <= 90 * -p][:first_negatives]
            out.extend((id_, positive, k + 1, i, -p, -s) for k, (s, i) in enumerate(fits))
    return sorted(out)


def mined(spark, rows):
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, label int, embedding array<double>, row int, bits string")
    return sorted(tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 100 == 0, F.col("label")).collect())


@pytest.mark.parametrize("blocks", [(1024, 8192), (2, 40)])
def test_lists_against_all_products(spark, monkeypatch, blocks):
    monkeypatch.setattr(hard_negatives, "ANCHORS", blocks[0])
    monkeypatch.setattr(hard_negatives, "CANDIDATES", blocks[1])
    rng = np.random.default_rng(1)
    rows = [(i * 5, int(rng.integers(0, 3)), (rng.standard_normal(19) / 4).round(2).tolist()) for i in range(250)]
    rows += [(i * 100, 1, [0.25] * 19) for i in range(20, 24)] + [(7, 2, [0.2] * 19)] * 3  # ties and repeated rows
    rows += [(3000, 1, [50000.0] * 19), (3001, 0, [-60000.0] * 19), (3002, 2, [0.001] * 19)]  # many planes, and few
    rows += [(3100, 1, [1.0, 2.0]), (3101, 1, [1.0, 2.0]), (3102, 2, [1.0, 1.0]), (3200, 1, []), (3201, 1, []), (3202, 2, [])]
    bad = [0.5] * 18
    rows += [(4000, 1, None), (4100, None, bad + [0.1]), (None, 1, bad + [0.1]), (4200, 1, bad + [None]), (4300, 1, bad + [math.nan]), (4400, 1, bad + [math.inf]), (4500, 1, bad + [1e300])]
    assert mined(spark, rows) == slow(rows)


def test_no_anchors_and_empty_table(spark):
    assert mined(spark, [(1, 1, [1.0]), (2, 1, [1.0])]) == []
    assert mined(spark, [(100, 1, [1.0])]) == []
    assert mined(spark, []) == []


def test_scores_are_exact():
    rng = np.random.default_rng(2)
    for size, most in ((1, 3), (8, 200), (13, 2**24), (300, 2**20)):
        anchors, rows = (rng.integers(-most + 1, most, (n, size)) for n in (5, 70))
        planes = max(map(hard_negatives.plane_count, rows))
        packed = hard_negatives.planes_of(rows, planes)
        assert (hard_negatives.scores(hard_negatives.subset_sums(anchors), packed) == rows @ anchors.T).all()
    assert [hard_negatives.plane_count(np.array(v)) for v in ([], [0], [-1], [1], [-2], [127], [-128], [128])] == [1, 1, 1, 2, 2, 8, 8, 9]
