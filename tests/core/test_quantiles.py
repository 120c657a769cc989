import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators import reports as RP


@pytest.mark.parametrize("few", [20_000, 3])
def test_exact_values(spark, monkeypatch, few):
    """With many equal values, few values, one value, none; found by brackets alone (few = 3) too."""
    monkeypatch.setattr(RP, "FEW", few)
    r = np.random.default_rng(few)
    cases = [np.zeros(500), np.append(np.zeros(4000), r.gamma(2, 3, 8000)), r.normal(size=30_000).round(2), np.array([3.0]), np.array([1.0, 2.0]), np.append(r.normal(size=50), [1e300, -1e300])]
    for x in cases:
        df = spark.createDataFrame(list(enumerate(x.tolist())) + [(-1, None)], "i long, v double").repartition(3)
        got = RP.quantiles(df, "v", [0.0, 0.1, 0.5, 0.9, 1.0])
        assert list(got.values()) == pytest.approx(np.quantile(x, [0, 0.1, 0.5, 0.9, 1.0]).tolist())
    assert RP.quantiles(df.where("i = -1"), "v", [0.5]) == {0.5: None}


def test_sketches_merge(spark):
    """Parts of a run, merged by route and over all: counts and moments exact, quantiles within the rank error (times 2)."""
    r = np.random.default_rng(5)
    x = np.append(np.zeros(20_000), r.gamma(2, 4, 40_000))
    df = spark.createDataFrame([(int(i % 40), "ab"[i % 2], float(v)) for i, v in enumerate(r.permutation(x))] + [(99, "c", None)], "chunk_id int, route string, v double")
    parts = RP.score_sketches(df, ["chunk_id", "route"], "v", 10.0)
    assert parts.count() == 41
    whole = RP.sketch_summary(RP.merged_sketches(parts, [])).first()
    assert (whole.n, whole.dropped, whole.low, whole.high) == (60_000, int((x >= 10).sum()), 0.0, x.max()) and whole["mean"] == pytest.approx(x.mean()) and whole["std"] == pytest.approx(x.std(ddof=1))
    for p in (10, 50, 90):
        below, upto = (x < whole[f"p{p}"]).mean(), (x <= whole[f"p{p}"]).mean()
        assert below - 2 * RP.RANK_ERROR <= p / 100 <= upto + 2 * RP.RANK_ERROR
    routes = {z.route: z for z in RP.sketch_summary(RP.merged_sketches(parts, ["route"])).collect()}
    assert routes["a"].n == routes["b"].n == 30_000 and routes["c"].n == 0 and routes["c"].p50 is None and routes["c"]["mean"] is None
