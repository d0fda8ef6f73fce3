"""The flat form of proposals, against the reference's rule: upwards from 1 to the first gap, 99 at most."""

import json

from pyspark.sql import functions as F

from lexmill.operators import model_output


def test_flat_pairs_beyond_five(spark):
    flat = lambda numbers: json.dumps({f"{k}_{i}": f"{k}{i}" for i in numbers for k in ("genre", "audience")})
    outputs = {1: flat(range(1, 8)), 2: flat([1, 2, 4]), 3: flat(range(1, 121)), 4: flat([2]), 5: "[1]", 6: f"analysis assistantfinal{flat(range(1, 7))}", 7: '{"genre_1": "a"}', 8: None}
    df = spark.createDataFrame(list(outputs.items()), "k int, output string")
    got = {}
    for r in model_output.explode_proposals(df, "output").select("k", "genre", "audience").collect():
        got.setdefault(r.k, []).append((r.genre, r.audience))
    want = {1: 7, 2: 2, 3: 99, 6: 6}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted((f"genre{i}", f"audience{i}") for i in range(1, n + 1)) for k, n in want.items()}
