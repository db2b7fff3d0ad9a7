import gzip

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import functions as F

from tremorlake.operators.kmeans import fit_kmeans
from tremorlake.operators.normalize import fit_scaler
from tremorlake.sources import csv, models
from tremorlake.sources.series import read_series, write_series

TEXT = "2018-07-09 12:00:00.25,1.5,-2.0,9.8\n2018-07-09 12:00:01,1.0,,9.7\n"


def test_headerless_and_gzip_files_with_device(spark, tmp_path, rows):
    (tmp_path / "EDS_1.csv").write_text(TEXT)
    with gzip.open(tmp_path / "EDS_12.csv.gz", "wt") as f:
        f.write(TEXT)
    df = csv.read_sensor_csv(spark, [str(tmp_path / "EDS_1.csv"), str(tmp_path / "EDS_12.csv.gz")], device_pattern=r"EDS_(\d+)")
    assert df.columns == ["timestamp", "X", "Y", "Z", "device_id"]
    assert rows(df.groupBy("device_id").count()) == [(1, 2), (12, 2)]
    assert df.filter("Y is null").count() == 2


def test_other_column_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text(TEXT)
    df = csv.read_sensor_csv(spark, str(tmp_path / "a.csv"), ("Timestamp", "AccelerationX", "AccelerationY", "AccelerationZ"))
    assert csv.normalise_columns(df).columns == ["timestamp", "X", "Y", "Z"]


def test_header_file_with_casts(spark, tmp_path, rows):
    (tmp_path / "h.csv").write_text("timestamp,Z,Zscale\nt1,1.5,0.25\nt2,bad,1\n")
    df = csv.read_header_csv(spark, str(tmp_path / "h.csv"), {"timestamp": "string", "Z": "double"})
    assert rows(df) == [("t1", 1.5), ("t2", None)]


def test_labelled_file(spark, tmp_path):
    (tmp_path / "l.csv").write_text("t1,1.5,0\nt2,2.5,1\n")
    df = csv.read_labelled_csv(spark, str(tmp_path / "l.csv"))
    assert dict(df.dtypes)["anomaly"] == "int" and df.agg(F.sum("anomaly")).first()[0] == 1


def test_sinks(spark, tmp_path):
    df = spark.range(100).select(F.col("id"), (-F.col("id")).alias("neg"))
    csv.write_sorted_csv(df, str(tmp_path / "one"), ["neg"], single_file=True)
    files = list((tmp_path / "one").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[0] == "99,-99"
    # Parts of several tasks, joined in order; written again, it replaces the file.
    for rows in (df.repartition(7), df.limit(0), df.repartition(3)):
        csv.write_sorted_csv(rows, str(tmp_path / "one"), ["id"], header=True, single_file=True)
        lines = [f for f in (tmp_path / "one").iterdir() if f.suffix == ".csv"][0].read_text().splitlines()
        assert lines == ["id,neg", *([f"{i},{-i}" for i in range(100)] if not rows.isEmpty() else [])]
    csv.write_sorted_csv(df, str(tmp_path / "many"), ["id"], header=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "many")).count() == 100
    csv.export_csv(df, str(tmp_path / "plain"))
    assert spark.read.option("header", True).csv(str(tmp_path / "plain")).columns == ["id", "neg"]


def test_one_file_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(csv, "join_files", lambda spark, folder, target, head: seen.append(len(list(__import__("pathlib").Path(folder).glob("part-*")))))
    csv.write_sorted_csv(spark.range(200_000).toDF("id"), str(tmp_path / "one"), ["id"], single_file=True)
    assert seen[0] > 1


def test_models_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(float(i % 3 * 10), float(i % 3)) for i in range(60)], "a double, b double")
    model = fit_kmeans(df, ["a", "b"], k=3)
    for _ in range(2):
        models.save_model(model, str(tmp_path / "km"))
    again = models.load_model(KMeansModel, str(tmp_path / "km"))
    assert [list(c) for c in again.clusterCenters()] == [list(c) for c in model.clusterCenters()]
    models.save_parameters(fit_scaler(df, "a"), str(tmp_path / "sc"))
    assert models.load_parameters(spark, str(tmp_path / "sc")).first()["mean"] == 10.0


def test_series_layout(spark, tmp_path, rows):
    df = spark.createDataFrame([(d, i * 3, float(i)) for d in (1, 2) for i in range(50)], "d int, i bigint, v double")
    write_series(df.repartition(4, "v"), str(tmp_path / "s"), ["d"], ["i"])
    got = read_series(spark, str(tmp_path / "s"))
    assert rows(got.select("d", "pos", "i")) == [(d, i, 3 * i) for d in (1, 2) for i in range(50)]
