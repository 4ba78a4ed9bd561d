import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from orderlens.plans import models as MD


def test_exact_split_counts_and_choice(spark):
    rng = np.random.default_rng(5)
    n = 5000
    pdf = pd.DataFrame({"id": [f"c{i}" for i in range(n)],
                        "label": (rng.random(n) < 0.1).astype(int)})   # unbalanced classes
    df = spark.createDataFrame(pdf).repartition(7)
    out = MD.exact_split(df, "id", 0.25, strata="label", bucket_bits=6)
    got = out.filter("is_test").groupBy("label").count().toPandas().set_index("label")["count"]
    for lbl, n_l in pdf.label.value_counts().items():
        assert got[lbl] == math.ceil(0.25 * n_l)
    # the chosen rows are the smallest hashes of each class (brute force)
    h = (df.select("id", "label", F.pmod(F.xxhash64("id", F.lit(MD.SEED)), F.lit(1 << 31)).alias("h"))
         .toPandas())
    want = set()
    for lbl, g in h.groupby("label"):
        want |= set(g.sort_values(["h", "id"]).id.head(math.ceil(0.25 * len(g))))
    assert set(out.filter("is_test").select("id").toPandas().id) == want


def test_exact_split_without_strata_and_deterministic(spark):
    df = spark.range(1001).select(F.col("id").cast("string").alias("k"))
    a = MD.exact_split(df, "k", 0.2)
    assert a.filter("is_test").count() == math.ceil(0.2 * 1001)
    b = MD.exact_split(df.repartition(3), "k", 0.2)
    assert sorted(r.k for r in a.filter("is_test").collect()) == sorted(r.k for r in b.filter("is_test").collect())
