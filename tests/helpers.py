"""Builders for small transaction frames used by the tests."""

from __future__ import annotations

from ledgerlens.operators.prepare import prepare_transactions
from ledgerlens.operators.temporal import add_temporal_features
from ledgerlens.sources.tables import tx_from_records

T0 = 1704067200  # 2024-01-01 00:00:00 UTC, a Monday


def tx_rows(spark, rows):
    """rows: dicts with short keys (h, f, t, ts, v, g, err, ca, fn); values
    become API strings."""
    recs = []
    for i, r in enumerate(rows):
        recs.append(
            {
                "hash": r.get("h", f"h{i:05d}"),
                "from": r.get("f"),
                "to": r.get("t"),
                "timeStamp": r.get("ts"),
                "value": r.get("v", 1.0),
                "gasPrice": r.get("g", 2.0),
                "isError": r.get("err", 0),
                "contractAddress": r.get("ca", ""),
                "functionName": r.get("fn", "transfer(address,uint256)"),
                "methodId": r.get("m", "0xa9059cbb"),
                "blockNumber": r.get("b", i),
                "transactionIndex": r.get("ti", 0),
            }
        )
    return add_temporal_features(prepare_transactions(tx_from_records(spark, recs)))
