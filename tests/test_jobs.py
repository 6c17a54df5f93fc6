import datetime as dt
import json
import os

from ledgerlens.plans.jobs import feature_job, scoring_job
from helpers import T0


def land(d, addr, txs, status="1"):
    os.makedirs(d, exist_ok=True)
    body = {"status": status, "message": "OK" if status == "1" else "NOTOK", "result": txs if status == "1" else "Max rate limit reached"}
    with open(os.path.join(d, f"eth_txlist_{addr}_2024-01-01T00-00-00.json"), "w") as f:
        f.write(json.dumps(body))


def test_feature_and_scoring_jobs(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing", "2024", "01", "01")
    txs = []
    for i in range(300):
        txs.append({"hash": f"0x{i:05x}", "from": f"a{i % 7}", "to": f"b{i % 5}", "timeStamp": str(T0 + i * 997),
                    "value": str(10 + (i % 13) + (5000 if i == 250 else 0)), "gasPrice": str(20 + i % 3),
                    "isError": "1" if i % 11 == 0 else "0", "contractAddress": "", "functionName": "transfer(address,uint256)",
                    "blockNumber": str(1000 + i), "transactionIndex": "0", "methodId": "0xa9059cbb"})
    land(landing, "a", txs[:150])
    land(landing, "b", txs[150:])
    land(landing, "c", [], status="0")
    feats = os.path.join(tmp_dir, "features")
    info = feature_job(spark, os.path.join(tmp_dir, "landing"), feats, rejects_path=os.path.join(tmp_dir, "rejects"))
    assert info["rejected_payloads"] == 1 and info["missing_fields"] == []  # explicit schema: all fields exist
    f = spark.read.parquet(feats)
    assert f.count() == 300 and "daily_avg_interval_to" in f.columns
    summary, thr = scoring_job(spark, feats, os.path.join(tmp_dir, "pred"), os.path.join(tmp_dir, "reports"), run_ts=dt.datetime(2024, 1, 2))
    counts = {r["pred_label"]: r["count"] for r in summary.collect()}
    assert counts[-1] >= 1 and counts[-1] + counts[1] == 300 and thr is not None
    reports = sorted(os.listdir(os.path.join(tmp_dir, "reports")))
    assert reports == ["anomalies_2024-01-02T00-00-00", "metadata_2024-01-02T00-00-00", "predictions_2024-01-02T00-00-00"]
    anomalies = spark.read.option("header", True).csv(os.path.join(tmp_dir, "reports", reports[0]))
    assert anomalies.count() == counts[-1]
