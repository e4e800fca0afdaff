from pyspark.sql import functions as F

from subledger.functions.sketches import distinct_sketches, error_bound, merged_estimates, rollup_estimates


def test_united_sketches_keep_their_bound(spark):
    """400,000 owners in overlapping cells: sums of cells overcount, unions do not, over months too."""
    ids = spark.range(400_000).select(F.concat(F.lit("o"), "id").alias("owner"), "id")
    rows = ids.select("owner", F.explode(F.array(*[F.struct(
        F.lit(m).alias("month"), ((F.col("id") + m) % 3).alias("product")) for m in range(3)])).alias("x")).select(
        "owner", "x.*")
    rows = rows.unionByName(rows.where("product = 0"))  # repeats count once
    leaf = distinct_sketches(rows, "owner", ("month", "product"))
    assert leaf.count() == 9
    for keys, want in ((("month",), 400_000), (("product",), 400_000), (("month", "product"), 400_000 / 3)):
        for r in merged_estimates(leaf, keys).collect():
            assert abs(r["estimate"] - want) <= error_bound() * want, (keys, r)
    levels = {}
    for r in rollup_estimates(leaf, ("month", "product")).collect():
        levels.setdefault(r["grouping_level"], []).append(r)
    assert {k: len(v) for k, v in levels.items()} == {0: 9, 1: 3}


def test_empty_and_null(spark):
    rows = spark.createDataFrame([("a", None), ("a", "x"), ("b", None)], "k string, owner string")
    got = {r["k"]: r["estimate"] for r in merged_estimates(distinct_sketches(rows, "owner", ("k",)), ("k",)).collect()}
    assert got == {"a": 1, "b": 0}
    assert merged_estimates(distinct_sketches(rows.limit(0), "owner", ("k",)), ("k",)).count() == 0
