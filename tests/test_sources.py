import datetime as dt
import json
import os

from pyspark.sql import functions as F

from ledgerlens.functions.scalar import landing_key
from ledgerlens.operators.prepare import prepare_transactions
from ledgerlens.schema import RAW_PAYLOAD_SCHEMA
from ledgerlens.sources import sinks
from ledgerlens.sources.raw_json import flatten_payloads, read_raw_payloads, split_payloads
from ledgerlens.sources.tables import read_partitioned, register_parquet_table
from helpers import T0, tx_rows


def write_files(d, payloads):
    for i, p in enumerate(payloads):
        sub = os.path.join(d, "2024", "01", f"{i + 1:02d}")
        os.makedirs(sub, exist_ok=True)
        with open(os.path.join(sub, f"eth_txlist_addr{i}_2024-01-01T00-00-00.json"), "w") as f:
            f.write(json.dumps(p))


def test_raw_payload_cases(spark, tmp_dir):
    write_files(
        tmp_dir,
        [
            {"status": "1", "message": "OK", "result": [{"hash": "0xabc", "value": "1000000000000000000", "timeStamp": "1704067200"}]},
            {"status": "1", "message": "OK", "result": []},
            {"status": "0", "message": "NOTOK", "result": "Max rate limit reached"},
        ],
    )
    payloads = read_raw_payloads(spark, tmp_dir)
    assert payloads.schema["result"].dataType == RAW_PAYLOAD_SCHEMA["result"].dataType
    valid, rejects = split_payloads(payloads)
    assert rejects.count() == 1 and rejects.first()["message"] == "NOTOK"
    rows = prepare_transactions(flatten_payloads(valid)).collect()
    assert len(rows) == 1 and rows[0]["hash"] == "0xabc" and rows[0]["value"] == 1e18


def test_flat_table_passes_through(spark):
    df = spark.createDataFrame([("a", "1")], "hash string, value string")
    assert flatten_payloads(df).columns == ["hash", "value"]


def test_landing_key(spark):
    df = spark.createDataFrame([("0xAb", dt.datetime(2024, 3, 5, 7, 8, 9))], "a string, t timestamp")
    assert df.select(landing_key("a", "t")).first()[0] == "raw/ethereum/txlist/2024/03/05/eth_txlist_0xAb_2024-03-05T07-08-09.json"


def test_partitioned_write_and_pruned_scan(spark, tmp_dir):
    tx = tx_rows(spark, [{"f": "a", "t": "b", "ts": T0 + i * 86400} for i in range(5)])
    path = os.path.join(tmp_dir, "features")
    sinks.write_partitioned(tx, path)
    assert sorted(p for p in os.listdir(path) if p.startswith("date=")) == [f"date=2024-01-0{i}" for i in range(1, 6)]
    df = read_partitioned(spark, path, "2024-01-02", "2024-01-03", columns=["hash", "date"])
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "ReadSchema: struct<hash:string>" in plan
    # dynamic overwrite replaces only the partitions present in the new frame
    sinks.write_partitioned(tx.filter(F.col("date") == F.lit("2024-01-01").cast("date")), path)
    assert spark.read.parquet(path).count() == 5


def test_catalog_table(spark, tmp_dir):
    tx = tx_rows(spark, [{"f": "a", "t": "b", "ts": T0 + i * 86400} for i in range(3)])
    path = os.path.join(tmp_dir, "t")
    sinks.write_partitioned(tx.select("hash", "value", "date"), path)
    t = register_parquet_table(spark, "ledgerlens_test_tx", path, ["date"])
    assert t.count() == 3 and spark.sql("SHOW PARTITIONS ledgerlens_test_tx").count() == 3


def test_csv_and_metadata_sinks(spark, tmp_dir):
    df = spark.createDataFrame([("a", -1), ("b", 1), ("c", -1)], "hash string, pred_label int")
    sinks.write_csv(df, os.path.join(tmp_dir, "all"))
    sinks.write_anomalies_csv(df, os.path.join(tmp_dir, "anom"))
    back = spark.read.option("header", True).csv(os.path.join(tmp_dir, "anom"))
    assert sorted(r["hash"] for r in back.collect()) == ["a", "c"]
    sinks.write_anomalies_csv(df.drop("pred_label"), os.path.join(tmp_dir, "none"))
    assert spark.read.option("header", True).csv(os.path.join(tmp_dir, "none")).count() == 0
    meta = sinks.run_metadata(spark, ["log_value", "log_gasPrice"], dt.datetime(2024, 1, 2, 3, 4, 5))
    sinks.write_run_metadata(meta, os.path.join(tmp_dir, "meta"))
    m = spark.read.json(os.path.join(tmp_dir, "meta")).first()
    assert m["num_features"] == 2 and m["timestamp"] == "2024-01-02T03-04-05" and m["threshold_percentile"] == 0.99


def test_landing_zone_roundtrip(spark, tmp_dir):
    from ledgerlens.sources.raw_json import payloads_from_tx
    from ledgerlens.sources.tables import tx_from_records

    raw = tx_from_records(spark, [{"hash": f"h{i}", "from": "a", "timeStamp": str(T0 + i)} for i in range(4)])
    p = payloads_from_tx(raw.withColumn("_t", F.timestamp_seconds(F.lit(T0))), ["from", "_t"])
    path = os.path.join(tmp_dir, "landing")
    sinks.write_landing(sinks.landing_frame(p, "from", "_t"), path)
    assert os.path.isdir(os.path.join(path, "year=2024", "month=01", "day=01"))
    valid, _ = split_payloads(read_raw_payloads(spark, path))
    flat = flatten_payloads(valid)
    assert flat.count() == 4 and {"from", "hash", "timeStamp"} <= set(flat.columns)


def test_payload_pages_are_bounded(spark):
    from ledgerlens.sources.raw_json import payloads_from_tx
    from ledgerlens.sources.tables import tx_from_records

    raw = tx_from_records(spark, [{"hash": f"h{i}", "from": "hot"} for i in range(1000)]).withColumn("_a", F.col("from"))
    sizes = [r[0] for r in payloads_from_tx(raw, ["_a"], max_rows=100).select(F.size("result")).collect()]
    assert sum(sizes) == 1000 and len(sizes) == 10 and max(sizes) < 200


def test_predictions_partitioned_only_with_date(spark, tmp_dir):
    df = spark.createDataFrame([("a", -1, dt.date(2024, 1, 1)), ("b", 1, dt.date(2024, 1, 2))], "hash string, pred_label int, date date")
    sinks.write_predictions(df, os.path.join(tmp_dir, "p1"))
    assert sorted(p for p in os.listdir(os.path.join(tmp_dir, "p1")) if p.startswith("date=")) == ["date=2024-01-01", "date=2024-01-02"]
    sinks.write_predictions(df.drop("date"), os.path.join(tmp_dir, "p2"))
    assert not any(p.startswith("date=") for p in os.listdir(os.path.join(tmp_dir, "p2")))
    assert spark.read.parquet(os.path.join(tmp_dir, "p2")).count() == 2


def test_parse_timestamp(spark):
    from ledgerlens.functions.scalar import parse_timestamp

    df = spark.createDataFrame([("2024-01-02 10:00:00",), ("2024-01-02",), ("not a time",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_timestamp("t")).collect()]
    assert got[0] == dt.datetime(2024, 1, 2, 10) and got[1] == dt.datetime(2024, 1, 2) and got[2] is None and got[3] is None


def test_payloads_keep_rows_with_null_keys(spark):
    from ledgerlens.sources.raw_json import flatten_payloads, payloads_from_tx

    rows = [("h1", "a", 1), ("h2", None, 1), ("h3", "a", None), (None, None, None), (None, None, None)]
    raw = spark.createDataFrame(rows, "hash string, addr string, _t int")
    p = payloads_from_tx(raw, ["addr", "_t"], max_rows=1)
    assert sorted(str(r["hash"]) for r in flatten_payloads(p).collect()) == ["None", "None", "h1", "h2", "h3"]


def test_corrupt_text_is_among_the_rejects(spark, tmp_dir):
    from ledgerlens.plans.jobs import daily_rejects
    from ledgerlens.sources.raw_json import read_raw_payloads, split_payloads

    for day, body in (("year=2024/month=01/day=02", "{not json"), ("2024/01/03", '{"status": "0", "message": "NOTOK"}')):
        os.makedirs(f"{tmp_dir}/{day}")
        with open(f"{tmp_dir}/{day}/p.json", "w") as f:
            f.write(body)
    valid, rejects = split_payloads(read_raw_payloads(spark, tmp_dir))
    assert valid.count() == 0
    assert sorted(map(str, [r["_corrupt_record"] for r in rejects.collect()])) == ["None", "{not json"]
    assert sorted((r["landing_day"], r["rejected"]) for r in daily_rejects(rejects).collect()) == [("2024/01/02", 1), ("2024/01/03", 1)]


def test_multi_line_payloads(spark, tmp_dir):
    from ledgerlens.sources.raw_json import flatten_payloads, read_raw_payloads

    with open(f"{tmp_dir}/p.json", "w") as f:
        f.write('{"status": "1",\n "message": "OK",\n "result": [{"hash": "h"}]}')
    assert flatten_payloads(read_raw_payloads(spark, tmp_dir, multi_line=True)).first()["hash"] == "h"


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import pytest

    from ledgerlens.session import scratch_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "spark://head:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")


def test_scratch_is_dropped(spark):
    from ledgerlens.operators.scoring import materialize
    from ledgerlens.session import drop_scratch, path_exists, scratch_dir

    t = materialize(spark.range(3), "gone")
    path = t.inputFiles()[0].rsplit("/", 1)[0]
    assert t.count() == 3 and path_exists(spark, path)
    drop_scratch(spark)
    assert not path_exists(spark, path) and "/ledgerlens/" in scratch_dir(spark, "x")
