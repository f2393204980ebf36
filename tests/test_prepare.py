import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabquorum.functions.fixed_values import PASSENGER_FEATURES
from tabquorum.operators.encode import assembler, label_indexer
from tabquorum.operators.impute import fill_mean, fill_mean_lazy, fit_means, recode
from tabquorum.operators.splitting import hash_split, random_split, with_fold
from tabquorum.plans import PassengerPrep, player_frame, player_schema
from tabquorum.plans.passengers import passenger_schema
from tabquorum.sources import (materialize, new_shared_path, read_csv_typed, read_libsvm, release,
                               schema_of, shared_root)

LINES = [
    (1, 0, 3, "Braund, Mr. Owen", "male", 22.0, 1, 0, "A", 7.25, None, "S"),
    (2, 1, 1, "Cumings, Mrs. John", "female", 38.0, 1, 0, "B", 71.28, "C85", "C"),
    (3, 1, 3, "Heikkinen, Miss. Laina", "female", None, 0, 0, "C", 7.91, None, None),
    (4, 0, 2, "Byles, Rev. Thomas", "male", 64.0, 0, 0, "D", None, None, "S"),
    (5, 0, 3, "Moran, Mr. James", "male", 16.0, 0, 0, "E", 31.0, None, "Q"),
]


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(LINES, passenger_schema())


def test_prepared_passengers(train):
    model = PassengerPrep().fit(train)
    assert model.means["Age"] == pytest.approx(35.0)
    out = {r.PassengerId: r for r in model.transform(train).collect()}
    assert [out[i].Age for i in range(1, 6)] == [1, 2, 2, 3, 0]
    assert [out[i].Fare for i in range(1, 6)] == [0, 3, 0, 2, 2]
    assert [out[i].Alone for i in range(1, 6)] == [0, 0, 1, 1, 1]
    assert out[2]["Age*Class"] == 2 and out[3].Embarked_indexed == out[1].Embarked_indexed == 0.0
    assert model.labels["Title"] == ["Mr", "Miss", "Mrs", "Rare"]
    assert set(PASSENGER_FEATURES) <= set(model.transform(train).columns)
    assembler(PASSENGER_FEATURES).transform(model.transform(train)).count()


def test_title_unknown_to_the_training_rows(spark, train):
    other = [(9, 2, "Oliva, Dona. Fermina", "female", 39.0, 0, 0, "F", 108.9, None, "C")]
    test = spark.createDataFrame(other, passenger_schema(with_label=False))
    row = PassengerPrep().fit(train).transform(test).first()
    assert row.Title_indexed == 3.0  # Rare
    with pytest.raises(Exception, match="Unseen label"):
        PassengerPrep(foldUnknownTitles=False).fit(train).transform(test).collect()
    kept = PassengerPrep(foldUnknownTitles=False, handleInvalid="keep").fit(train).transform(test)
    assert kept.first().Title_indexed == 4.0


def test_mean_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([(None,), (None,)], "v double")
    assert fit_means(empty, ["v"]) == {"v": 0.0}
    assert [r.v for r in fill_mean(empty, ["v"]).collect()] == [0.0, 0.0]
    assert [r.v for r in fill_mean_lazy(empty, "v").collect()] == [0.0, 0.0]


def test_mean_into_int_column_truncates(spark):
    rows = spark.createDataFrame([(75,), (75,), (74,), (None,)], "v int")
    assert sorted(r.v for r in fill_mean(rows, ["v"]).collect()) == [74, 74, 75, 75]


def test_recode_keeps_unlisted(spark):
    rows = spark.createDataFrame([("Mlle",), ("Dona",), (None,)], "t string")
    assert [r.t for r in recode(rows, "t", {"Mlle": "Miss"}).collect()] == ["Miss", "Dona", None]


def test_csv_cells_names_and_types(spark):
    path = new_shared_path(spark, "csv")
    spark.createDataFrame([("id,name,age",), ('1,"Kelly, Mr. J",71+2',), ("2,,30",)], "t string") \
        .coalesce(1).write.text(path)
    rows = read_csv_typed(spark, path, schema_of(("Id", "int"), ("Name", "string"), ("Age*", "int")))
    out = sorted(tuple(r) for r in rows.collect())
    assert rows.columns == ["Id", "Name", "Age*"]
    assert out == [(1, "Kelly, Mr. J", None), (2, None, 30)]


def test_libsvm(spark):
    path = new_shared_path(spark, "svm")
    spark.createDataFrame([("2.0 1:5 3:1",), ("4.0 2:7",)], "t string").coalesce(1).write.text(path)
    out = sorted((r.label, r.features.toArray().tolist()) for r in read_libsvm(spark, path).collect())
    assert out == [(2.0, [5.0, 0.0, 1.0]), (4.0, [0.0, 7.0, 0.0])]
    indexed = label_indexer("label", "y").fit(read_libsvm(spark, path, 3))
    assert list(indexed.labels) == ["2.0", "4.0"]


def test_players(spark):
    schema = player_schema()
    assert len(schema) == 41
    ratings = [74, 75, 83, 84, None]
    rows = spark.createDataFrame(
        [("n", 20, "x", o, 80, "c", 5, *range(34)) for o in ratings], schema)
    out = player_frame(rows)
    assert [r.Overall for r in out.collect()] == [0, 1, 1, 2, 1]
    assert out.first().features.size == 37 and out.first().weight == 0.5


def test_splits(spark):
    rows = spark.range(5000)
    train, test = hash_split(rows, F.col("id"), 70)
    assert train.count() + test.count() == 5000 and train.join(test, "id").count() == 0
    assert train.count() == pytest.approx(3500, abs=150)
    a, b = random_split(rows, [0.8, 0.2], 7)
    assert a.count() + b.count() == 5000 and a.join(b, "id").count() == 0
    folds = with_fold(rows, F.col("id"), 5).groupBy("fold").count().collect()
    assert sorted(r.fold for r in folds) == [0, 1, 2, 3, 4]


def test_materialized_table_keeps_metadata(spark, squares):
    marked = squares.withMetadata("label", {"ml_attr": {"vals": ["x", "y", "z"]}})
    stored, path = materialize(marked, "test")
    assert path.startswith(shared_root(spark))
    assert stored.schema["label"].metadata == {"ml_attr": {"vals": ["x", "y", "z"]}}
    assert stored.schema["features"].metadata == marked.schema["features"].metadata
    assert stored.count() == squares.count()
    release(spark, path)
    with pytest.raises(ValueError):
        release(spark, "/somewhere/else")


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    # On a cluster the name is the session's; a machine-local folder is refused there.
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        conf = Conf({"spark.checkpoint.dir": "hdfs:///shared/", "spark.master": "yarn"})
    assert shared_root(Session()) == "hdfs:///shared"
    Session.conf = Conf({"spark.master": "yarn"})
    with pytest.raises(ValueError):
        shared_root(Session())


def test_prepared_stream(spark, train, tmp_path):
    """The fitted preparation is a projection, so it also accepts a stream of files."""
    folder = str(tmp_path / "in")
    train.write.parquet(folder)
    model = PassengerPrep().fit(train)
    stream = model.transform(spark.readStream.schema(train.schema).parquet(folder))
    run = stream.writeStream.format("memory").queryName("prepared").trigger(availableNow=True).start()
    run.awaitTermination(60)
    assert spark.table("prepared").count() == len(LINES)


def test_vectors_from_arrays(spark):
    rows = spark.createDataFrame([([1.0, 2.0],)], "a array<double>")
    assert rows.select(array_to_vector("a").alias("v")).first().v.size == 2
