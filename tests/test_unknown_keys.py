"""Rows without a key stay through deduplication and reach quarantine; amounts that are no numbers are not valid."""

from __future__ import annotations

from tallybank.operators import dedup, quality
from tests.conftest import txn

ROWS = [{"transaction_id": None, "amount": float(k)} for k in range(5)] + [{"amount": 1.0}, {"amount": 2.0}]


def test_unknown_ids_are_not_copies(spark):
    rows = txn(spark, *ROWS)
    assert sorted(r.amount for r in dedup.dedup_latest(rows).collect() if r.transaction_id is None) == [0, 1, 2, 3, 4]
    assert dedup.dedup_latest(rows).count() == dedup.dedup_any(rows).count() == 6
    assert dedup.dedup_latest(rows).columns == rows.columns
    assert tuple(dedup.dedup_report(rows).first()) == (7, 6, 1)
    _, rejected = quality.split_quality(dedup.dedup_latest(rows))
    assert [r.rejection_reasons for r in rejected.collect()] == [["failed_txn_id"]] * 5


def test_amounts_that_are_not_finite(spark):
    rows = txn(spark, *[{"amount": float(x)} for x in ("nan", "inf", "-inf", "3")])
    valid, rejected = quality.split_quality(rows)
    assert [r.amount for r in valid.collect()] == [3.0]
    assert [r.rejection_reasons for r in rejected.collect()] == [["failed_amount"]] * 3
