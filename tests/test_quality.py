from lapstar.operators import quality


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_profile_counts_rows_and_nulls_per_group(spark):
    df = spark.createDataFrame([("f1", 1, None), ("f1", None, None), ("f2", 2, "x")], "f string, A int, B string")
    assert quality.profile(df, "f", ["A", "B"]).columns == ["f", "rows", "null_a", "null_b"]
    assert rows(quality.profile(df, "f", ["A", "B"])) == [("f1", 2, 1, 2), ("f2", 1, 0, 0)]
    assert rows(quality.null_counts(df, ["A", "B"])) == [("A", 1), ("B", 2)]
    assert rows(quality.row_count(df)) == [(3,)]
    assert rows(quality.describe_columns(df)) == [("A", "int"), ("B", "string"), ("f", "string")]


def test_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1), (2, None)], "a int, b int")
    assert rows(quality.duplicates(df, ["a", "b"])) == [(1, 1, 2), (2, None, 1), (None, 1, 2)]
    assert rows(quality.duplicates(df, ["a", "b"], allow_null=True)) == [(1, 1, 2)]


def test_lengths(spark):
    df = spark.createDataFrame([("abcd", "x"), ("abc", None), (None, "xy")], "a string, b string")
    assert rows(quality.too_long(df, {"a": 3, "b": 1})) == [("a", 1), ("b", 1)]


def test_foreign_keys(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(quality.orphans(fact, dim, "k")) == [(3, 2)]
