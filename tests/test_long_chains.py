"""The duplicate rule where its chains run on: long windows, and blocks that only pass their carry on."""

import random

import numpy as np
import pytest
from helpers import frame, simulate, txn

from txnflow.config import DEFAULT_RULES, DUPLICATE
from txnflow.operators import anchors
from txnflow.operators.anchors import Passing
from txnflow.operators.rules import duplicate_alerts

COMBO = {"amount": 7, "merchant": "M"}


def chain(rng, prefix, account, start, seconds, most_gap, **other):
    rows, at = [], start
    while at < start + seconds:
        rows.append(txn(f"{prefix}{len(rows):05d}", round(at, 3), account=account, **COMBO, **other))
        at += rng.random() * most_gap
    return rows


def duplicates(rows, cfg):
    return {k for k, v in simulate(rows, cfg.with_options(rule_order=(DUPLICATE,))).items() if v}


@pytest.mark.parametrize("window", [30, 900, 5000])
@pytest.mark.parametrize("fan", [2, 64])
def test_windows_of_any_length(spark, monkeypatch, window, fan):
    """Blocks without a gap that would restart the chain, one after another; others in between; several combinations."""
    monkeypatch.setattr(anchors, "FAN", fan)
    cfg = DEFAULT_RULES.with_options(duplicate_window_seconds=window)
    rng = random.Random(window + fan)
    rows = chain(rng, "A", "dense", 3, 9 * max(600, window), 0.9 * window)
    rows += chain(rng, "B", "gaps", 0, 6 * max(600, window), 1.5 * window)
    rows += chain(rng, "C", "dense", 40 * max(600, window), 4 * max(600, window), 0.5 * window)
    rows += [txn(f"D{i}", 100.0, account="dense", **COMBO) for i in range(3)]
    got = {r["transaction_id"] for r in duplicate_alerts(frame(spark, rows), cfg).collect()}
    assert got == duplicates(rows, cfg)


def test_no_task_sees_more_than_a_group_of_blocks(spark, monkeypatch):
    """A combination that fills 200 blocks is worked on in groups of FAN."""
    seen, real = [], anchors._passings

    def passings(members):
        seen.append(len(members))
        return real(members)

    monkeypatch.setattr(anchors, "FAN", 8)
    rows = [txn(f"E{i:05d}", i * 25, account="all", **COMBO) for i in range(24 * 200)]
    tables, keep = {}, anchors.stored

    def stored(df, name):
        out = keep(df, name)
        tables.setdefault(name, []).append(out)
        return out

    monkeypatch.setattr(anchors, "stored", stored)
    got = {r["transaction_id"] for r in duplicate_alerts(frame(spark, rows)).collect()}
    assert got == duplicates(rows, DEFAULT_RULES)
    sizes = [[len(r["members"]) for r in t.select("members").collect()] for t in tables["block-groups"]]
    assert [max(s) for s in sizes] == [8, 8, 4] and len(sizes[0]) >= 24


def test_passings_compose():
    """A function of two neighbours does what they do one after the other, at every carry."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        window = int(rng.integers(1, 12))
        length = window + int(rng.integers(0, 9))
        blocks = [np.flatnonzero(rng.random(length) < rng.random()) + i * length for i in range(3)]
        blocks = [b if len(b) else np.array([i * length]) for i, b in enumerate(blocks)]
        own = [Passing.of_block(b, i * length + window, window) for i, b in enumerate(blocks)]
        if rng.random() < 0.3:
            own[1] = Passing.constant(int(blocks[1][-1]))
        for carry in range(-window - 3, 0):
            at = carry
            for f, b in zip(own, blocks):
                at, before = f(at), at
                if f.rest is None:
                    last = before
                    for t in b.tolist():
                        last = t if t > last + window else last
                    assert at == last
            assert own[0].then(own[1]).then(own[2])(carry) == own[0].then(own[1].then(own[2]))(carry) == at


def test_a_window_longer_than_a_block_of_nothing(spark):
    rows = [txn("a", 0, **COMBO), txn("b", 1000, **COMBO), txn("c", 4000, **COMBO), txn("d", 4000.001, **COMBO)]
    cfg = DEFAULT_RULES.with_options(duplicate_window_seconds=4000)
    assert {r["transaction_id"] for r in duplicate_alerts(frame(spark, rows), cfg).collect()} == {"b", "c"}
