import pytest
from pyspark.sql import functions as F

from textcheck.functions.ranks import as_features, exact_quantiles, flag_by_quota, largest_remainders, ranked
from textcheck.operators import prepare
from textcheck.sources import tables

CLEAN_CASES = [
    (None, ""),
    ("", ""),
    ("  \t ", ""),
    ("See https://a.b/c?d=1 NOW", "see now"),
    ("a<b\rc>d", "a d"),
    ("a<b\u0085c>d", "a d"),
    ("a<b\nc>d", "a<b c>d"),
    ("can't won't don't we'll I'm it's", "can not will not do not we will i am it is"),
    ("a \u001cb", "a b"),
]


def test_clean_text(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CLEAN_CASES)],
                               "id int, text string")
    rows = prepare.clean_text(df, "text").orderBy("id").collect()
    assert [r["text"] for r in rows] == [want for _, want in CLEAN_CASES]


@pytest.mark.parametrize("flags, want", [
    ({"lowercase": False}, "It is <b>"), ({"decontract": False, "strip_html": False}, "it's <b>"),
    ({"strip_html": False, "remove_punct": True}, "it is b"),
])
def test_clean_flags(spark, flags, want):
    df = spark.createDataFrame([("It's <b>",)], "text string")
    expected = want if flags != {"lowercase": False} else "It is"
    assert prepare.clean_text(df, "text", **flags).first()["text"] == expected


def test_missing_column(spark):
    with pytest.raises(ValueError):
        prepare.clean_text(spark.range(1), "text")


@pytest.mark.parametrize("labels, want", [
    (["Positive", "negative", None], [1, 0, None]), (["POS", "neg"], [1, 0]),
    (["0", "12"], [0, 12]), (["positive", "2"], ["positive", "2"]), (["good", "bad"], ["good", "bad"]),
])
def test_normalize_labels(spark, labels, want):
    df = spark.createDataFrame(list(enumerate(labels)), "id int, label string")
    rows = prepare.normalize_labels(df, "label").orderBy("id").collect()
    assert [r["label"] for r in rows] == want


def test_coerce_labels(spark):
    df = spark.createDataFrame([(0, "Pos"), (1, "7"), (2, None), (3, "negative")], "id int, l string")
    assert [r["l"] for r in prepare.coerce_labels(df, "l").orderBy("id").collect()] == [1, 7, None, 0]
    with pytest.raises(Exception, match="cannot turn label"):
        prepare.coerce_labels(spark.createDataFrame([("good",)], "l string"), "l").collect()


def shares(spark, sizes, frac=0.8):
    kind = "string" if any(isinstance(k, str) for k in sizes) else "long"
    frame = spark.createDataFrame(list(sizes.items()), f"group {kind}, n long")
    return {r["group"]: r["take"] for r in largest_remainders(frame, frac).collect()}


def test_quotas_share_out_the_floor_of_the_total(spark):
    assert shares(spark, {0: 58, 1: 341}) == {0: 46, 1: 273}
    assert shares(spark, {"a": 1}) == {"a": 0} and shares(spark, {"a": 1, None: 1}, 0.5) == {None: 1, "a": 0}
    assert shares(spark, {0: 3, 1: 3, 2: 3}) == {0: 3, 1: 2, 2: 2}
    assert largest_remainders(spark.createDataFrame([], "group long, n long"), 0.8).count() == 0


def test_quotas_of_150_000_labels(spark):
    df = spark.range(450_000).select("id", F.concat(F.lit("l"), F.col("id") % 150_000).alias("y"))
    flagged = prepare.flag_train(df, "y", "id", 0.5)
    per_label = flagged.groupBy("y").agg(F.count_if("is_train").alias("n"))
    assert {tuple(r) for r in per_label.groupBy("n").count().collect()} == {(1, 75_000), (2, 75_000)}


def test_ranks_are_places_in_the_order(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5003).alias("v"))
    got = {r["v"]: r["rank"] for r in ranked(df, "v").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(got))}


def test_split_is_exact_disjoint_and_independent_of_layout(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 10 == 0, "x").otherwise("y").alias("y"))
    train, test = prepare.stratified_split(df, "y", "id")
    assert {r["y"]: r["count"] for r in train.groupBy("y").count().collect()} == {"x": 160, "y": 1440}
    assert train.join(test, "id").count() == 0 and train.count() + test.count() == 2000
    again, _ = prepare.stratified_split(df.repartition(7).orderBy(F.desc("id")), "y", "id")
    assert {r["id"] for r in again.collect()} == {r["id"] for r in train.collect()}


def test_quota_matches_a_plain_sort(spark):
    from textcheck.functions.seeded import seeded_hash
    df = spark.range(500).withColumn("g", F.when(F.col("id") < 400, 1))
    marked = flag_by_quota(df, "g", "id", 5, "m", lambda sizes: sizes.withColumn(
        "take", F.when(F.col("group") == 1, 123).otherwise(F.col("n"))))
    got = {r["id"] for r in marked.filter("m AND g = 1").collect()}
    want = {r["id"] for r in df.filter("g = 1").orderBy(seeded_hash(5, F.col("id")), "id").limit(123).collect()}
    assert got == want and marked.filter("m AND g IS NULL").count() == 100


def test_sample_and_head(spark):
    df = spark.range(100)
    assert prepare.sample_rows(df, 1000, "id").count() == 100
    one = prepare.sample_rows(df.repartition(5), 10, "id").collect()
    assert sorted(one) == sorted(prepare.sample_rows(df, 10, "id").collect())
    assert [r["id"] for r in prepare.head_rows(df.repartition(5), 3, "id").collect()] == [0, 1, 2]


def test_exact_quantiles_match_builtin(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 1009 / 3).alias("v"),
                                  F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.rand(1)).alias("hot"))
    df = df.persist()
    got = {r["feature"]: r["quantiles"] for r in exact_quantiles(
        as_features(df, {"v": F.col("v"), "hot": F.col("hot")}), [0.0, 0.05, 0.5, 0.95, 1.0]).collect()}
    for name in ("v", "hot"):
        want = df.agg(F.percentile(name, F.array(*map(F.lit, [0.0, 0.05, 0.5, 0.95, 1.0])))).first()[0]
        assert got[name] == pytest.approx(want)


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'say "hi"\nthere', 0), (2, "a,b", 1)]
    df = spark.createDataFrame(rows, "id int, text string, label int")
    tables.write_table(df, str(tmp_path / "t.csv"), "csv")
    back = tables.load_dataset(spark, str(tmp_path / "t.csv"))
    assert sorted(map(tuple, back.collect())) == rows
    assert tables.dataset_shape(back).first() == (2, 3)
    tables.write_table(df.where("id = 2"), str(tmp_path / "no.csv.files"))
    assert tables.load_dataset(spark, str(tmp_path / "no.csv.files")).count() == 1
    assert tables.load_dataset(spark, str(tmp_path / "t.csv"), multi_line=False).count() == 3
    tables.write_table(df, str(tmp_path / "t"), partition_by=["label"])
    assert tables.load_dataset(spark, str(tmp_path / "t")).count() == 2


def test_stateless_operators_take_streams(spark, tmp_path):
    df = spark.createDataFrame([(1, "It's HERE")], "id int, text string")
    tables.write_table(df, str(tmp_path / "in"))
    stream = prepare.clean_text(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "text")
    run = stream.writeStream.format("memory").queryName("cleaned").trigger(availableNow=True).start()
    run.awaitTermination(60)
    assert spark.table("cleaned").first()["text"] == "it is here"
