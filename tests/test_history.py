"""The stored customer history: feeds, reruns, crashes and merged directories."""

from __future__ import annotations

import datetime as dt

import pytest

from tallybank.operators import scd2
from tallybank.plans import history
from tallybank.sinks import publish
from tests.conftest import rows, same_rows

HISTORY = "customer_id long, name string, risk_tier string, effective_start date, effective_end date, is_current boolean, version int"
CHANGES = "customer_id long, change_date date, risk_tier string"


def day(text):
    return dt.date.fromisoformat(text) if text else None


@pytest.fixture
def stored(spark, tmp_path):
    base = f"file://{tmp_path}/history"
    first = [
        (1, "a", "Low", day("2024-01-01"), day("2024-01-09"), False, 1),
        (1, "a", "High", day("2024-01-10"), None, True, 2),
        (2, "b", "Low", day("2024-01-01"), None, True, 1),
        (3, "c", "Low", day("2024-01-01"), None, True, 1),
    ]
    history.create_history(spark, base, spark.createDataFrame(first, HISTORY))
    return base


def feed(spark, *changes):
    return spark.createDataFrame([(c, day(d), t) for c, d, t in changes], CHANGES)


def apply(spark, base, name, changes):
    return history.apply_feed(spark, base, name, changes, "customer_id", ["risk_tier"])


def test_a_feed_is_applied_once_and_every_change_is_answered(spark, stored):
    before = history.read_history(spark, stored)
    changes = feed(
        spark,
        (1, "2024-01-05", "Low"),
        (2, "2024-02-01", "High"),
        (2, "2024-02-01", "Low"),
        (2, "2024-03-01", "Low"),
        (2, "2024-03-01", "Low"),
        (2, "2024-04-01", "High"),
        (None, "2024-01-01", "Low"),
        (3, None, "High"),
        (9, "2024-01-03", "Medium"),
    )
    wanted = scd2.scd2_upsert(before, changes, "customer_id", ["risk_tier"])
    expected = rows(wanted)
    assert apply(spark, stored, "f1", changes)
    assert rows(history.read_history(spark, stored).select(*wanted.columns)) == expected
    # Of two changes on one day the greater value counts; a feed is a set of changes, so copies are one.
    found = {(r.customer_id, str(r.change_date), r.risk_tier): (r.copies, r.outcome) for r in history.read_outcomes(spark, stored).collect()}
    assert found == {
        (1, "2024-01-05", "Low"): (1, "stale"),
        (2, "2024-02-01", "High"): (1, "superseded"),
        (2, "2024-02-01", "Low"): (1, "unchanged"),
        (2, "2024-03-01", "Low"): (2, "unchanged"),
        (2, "2024-04-01", "High"): (1, "applied"),
        (None, "2024-01-01", "Low"): (1, "unknown key"),
        (3, "None", "High"): (1, "unknown date"),
        (9, "2024-01-03", "Medium"): (1, "applied"),
    }
    state = publish.latest(spark, stored)
    assert not apply(spark, stored, "f1", changes)
    assert publish.latest(spark, stored) == state


def test_a_crash_before_the_switch_leaves_the_old_version(spark, stored, monkeypatch):
    old, state = rows(history.read_history(spark, stored)), publish.latest(spark, stored)
    changes = feed(spark, (2, "2024-02-01", "High"))

    def crash(*_):
        raise OSError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(history.publish, "publish", crash)
        with pytest.raises(OSError):
            apply(spark, stored, "f1", changes)
    assert rows(history.read_history(spark, stored)) == old
    assert publish.latest(spark, stored) == state
    assert apply(spark, stored, "f1", changes)
    assert len(rows(history.read_history(spark, stored))) == len(old) + 1


def test_two_jobs_cannot_publish_the_same_version(spark, stored):
    state = publish.latest(spark, stored)
    publish.publish(spark, stored, {**state, "version": 2})
    with pytest.raises(RuntimeError):
        publish.publish(spark, stored, {**state, "version": 2})
    with pytest.raises(RuntimeError):
        publish.publish(spark, stored, {**state, "version": 4})
    with pytest.raises(FileNotFoundError):
        history.read_history(spark, f"{stored}/none")


def test_many_feeds_keep_few_directories(spark, stored, monkeypatch):
    monkeypatch.setattr(history, "MERGE_AT", 4)
    whole = history.read_history(spark, stored)
    everything = feed(spark, *[(2, f"2024-02-{d:02}", ("High", "Low")[d % 2]) for d in range(1, 11)])
    expected = scd2.scd2_upsert(whole, everything, "customer_id", ["risk_tier"])
    wanted = rows(expected)
    for d in range(1, 11):
        assert apply(spark, stored, f"f{d}", everything.filter(f"change_date = date '2024-02-{d:02}'"))
        assert len(publish.latest(spark, stored)["closed"]) < 4
    assert rows(history.read_history(spark, stored).select(*expected.columns)) == wanted


def test_only_changed_keys_are_sorted(spark, stored):
    current = history.read_history(spark, stored)
    changes = feed(spark, (2, "2024-02-01", "High"))
    versions = scd2.changed_versions(current, changes, "customer_id", ["risk_tier"])
    assert {r.customer_id for r in versions.collect()} == {2}
    same_rows(
        scd2.scd2_upsert(current, changes, "customer_id", ["risk_tier"]).filter("customer_id <> 2"),
        current.filter("customer_id <> 2"),
    )
