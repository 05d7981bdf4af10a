from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from papyr.operators import learned, stats


def test_learned(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 300)
    x = rng.standard_normal((300, 4)) + np.outer(y, [2.0, 0, 0, 0])
    df = spark.createDataFrame([(i, [float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))] + [(999, None, 1)], "k int, v array<double>, y int").cache()
    scored = learned.cross_validated(df, "v", "y", "k")
    auc = stats.rank_auc(scored.withColumn("y", F.col("label").cast("int")), "score", "y", "k").collect()[0][0]
    assert scored.count() == 300 and auc > 0.85
    n, mean, cov = learned.moments(df, "v")
    assert n == 300 and np.allclose(mean, x.mean(0)) and np.allclose(cov, np.cov(x.T, bias=True))
    assert abs(learned.discriminant(df, "v", "y")[0]) > 0.95
    d = learned.one_class(df, "v", ["k"], 3)
    assert d.count() == 300 and d.agg(F.min("distance")).collect()[0][0] >= 0
    t = spark.createDataFrame([("The end of the day.",), (None,), ("How many the theme?",), ("",)], "t string").select(learned.style_features(F.col("t"), ["the", " of"])).collect()
    n = len(learned.STYLE_WORDS)
    assert len(t[0][0]) == n + 2 + 19 + 11 + 3 and t[1][0] is None
    assert t[0][0][learned.STYLE_WORDS.index("the")] == 2 / 5 and t[0][0][n] == 2 / 19 and t[0][0][n + 1] == 1 / 19 and t[0][0][-3:] == [5.0, 14 / 5, 19.0]
    assert t[2][0][n] == 2 / 19 and t[2][0][n + 2 + learned.OPENERS.index("how")] == 1.0 and t[2][0][n + 2 + 19 + learned.PAIR_OPENERS.index("how many")] == 1.0 and sum(t[3][0]) == 0.0
