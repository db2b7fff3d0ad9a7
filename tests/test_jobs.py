import json

import numpy as np
from pyspark.sql import functions as F
from test_streaming import write_in_order

from tremorlake import jobs
from tremorlake.operators.clean import default_axis_map
from tremorlake.operators.normalize import fit_scaler
from tremorlake.streaming.scoring import Scorer, flat_loss, read_scored, score_batch


def readings(n=600, spike=range(300, 312), seed=1):
    """Four readings a second; a burst of large values within a few seconds."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=n)
    v[list(spike)] = 60.0
    stamp = [f"2018-07-09 12:{i // 240:02d}:{i // 4 % 60:02d}.{i % 4 * 25:02d}" for i in range(n)]
    return list(zip(stamp, v))


def test_offline_clustering_from_files(spark, tmp_path):
    for device, column in ((1, 3), (12, 2)):
        lines = []
        for i, (t, v) in enumerate(readings(seed=device)):
            cells = [t, 0.5, 0.5, 0.5]
            cells[column] = -v if device == 12 else v
            lines.append(",".join(map(str, cells)))
        (tmp_path / f"EDS_{device}.csv").write_text("\n".join(lines) + "\n")
    signal = jobs.load_signal(
        spark, str(tmp_path / "EDS_*.csv"), r"EDS_(\d+)", "2018-07-09 12:00:00", "2018-08-09 12:00:00"
    )
    assert signal.count() == 1200 and signal.filter("value is null").count() == 0
    found = jobs.cluster_anomalies(signal, model_path=str(tmp_path / "model"))
    got = found.groupBy("device_id").agg(F.min("zscale").alias("low")).orderBy("device_id").collect()
    assert [r["device_id"] for r in got] == [1, 12] and all(r["low"] > 3 for r in got)


def test_sigma_evaluation(spark):
    rows = [(1, t, float(v), int(300 <= i < 312)) for i, (t, v) in enumerate(readings())]
    df = spark.createDataFrame(rows, "device_id int, timestamp string, value double, anomaly int")
    df = df.withColumn("ts", F.to_timestamp("timestamp"))
    out = jobs.evaluate_sigma(df, df.select("timestamp", "anomaly"), ["timestamp"], min_count=3).first()
    assert (out["tp"], out["fp"], out["fn"]) == (12, 0, 0) and out["f1"] == 1.0


def test_live_scores_equal_batch_scores(spark, tmp_path):
    rows = [(d, i, float(v)) for i, (_, v) in enumerate(readings(120, range(60, 66))) for d in (1, 4)]
    lines = [
        json.dumps({"timestamp": f"2018-07-09 12:{i // 60:02d}:{i % 60:02d}", "X": "0", "Y": "0", "Z": repr(v), "id": d, "index": i})
        for d, i, v in rows
    ]
    write_in_order(tmp_path / "in", [lines[:50] + ["junk"], lines[40:130], lines[130:]])
    signed = spark.createDataFrame([(d, i, -v if d == 4 else v) for d, i, v in rows], "device_id int, index bigint, value double")
    scorer = Scorer(fit_scaler(signed, "value", ["device_id"], 0), flat_loss(), threshold=0.5)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
    out = str(tmp_path / "live")
    jobs.live_scores(stream, scorer, out, default_axis_map(spark)).awaitTermination()

    def plain(df):
        return sorted((r["device_id"], r["index"], round(r["loss"], 6), r["label"]) for r in df.collect())

    assert plain(read_scored(spark, out)) == plain(score_batch(signed, scorer))


def test_one_sided_time_bounds(spark, tmp_path):
    (tmp_path / "EDS_1.csv").write_text("".join(f"2018-07-{d:02d} 12:00:00,1,2,3\n" for d in (9, 10, 11)))
    load = lambda **k: jobs.load_signal(spark, str(tmp_path / "EDS_1.csv"), r"EDS_(\d+)", **k).count()
    assert load() == 3
    assert load(start_time="2018-07-10 12:00:00") == 2 and load(end_time="2018-07-09 12:00:00") == 1
