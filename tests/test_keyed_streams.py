"""Settlement and cooldown from typed state: files out of order, too late and delivered twice lose nothing."""

import datetime as dt
import uuid

import numpy as np
import pytest

from tidemark.config import Config
from tidemark.session import shared_dir
from tidemark.streaming import jobs

CFG = Config()
D0 = dt.date(2001, 1, 1)
BARS = "ticker string, date date, open double, close double, limit double, signal boolean"
EVENTS = "ticker string, date date, di bigint"


def day(i: int) -> dt.date:
    return D0 + dt.timedelta(days=int(i))


def run(spark, files, schema, job, out_schema):
    """Files delivered one after the other; rows of the table and of its side partition."""
    r = f"{shared_dir(spark)}/test-{uuid.uuid4().hex[:12]}"
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{r}/in")
    t = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{r}/in")
    jobs.run_to_table(job(t), f"{r}/out", f"{r}/ck", ("late",)).awaitTermination()
    return [sorted(map(tuple, jobs.read_output(spark, f"{r}/out", out_schema, late).collect()), key=str) for late in (False, True)]


def bars(seed=4, n=60):
    rng = np.random.default_rng(seed)
    rows = []
    for t in ("AAA", "BBB"):
        c = 10 * np.exp(np.cumsum(rng.choice([-0.071, 0.0, 0.02, 0.069], n)))
        rows += [(t, day(i), float(c[i] * rng.choice([0.99, 1.0, 1.07])), float(c[i]), 0.07, bool(rng.random() < 0.7)) for i in range(n)]
    return rows


def settled(rows):
    """One prediction after the other over sorted bars."""
    out = []
    for t in sorted({r[0] for r in rows}):
        b = sorted(r for r in rows if r[0] == t)
        for i, p in enumerate(b):
            if not p[5] or i + 5 >= len(b):
                continue
            j = i + 5
            if b[j][3] / b[j - 1][3] - 1 <= -(b[j][4] - CFG.near):
                j += 1
            if j < len(b):
                g = b[j][3] / b[i + 1][2] - 1
                full = b[i + 1][2] / p[3] - 1 >= b[i + 1][4] - CFG.near
                out.append((t, p[1], g, (1 - CFG.fee) * (1 + g) * (1 - CFG.fee - CFG.tax) - 1, b[j][1], "unfilled_ceiling" if full else "settled"))
    return sorted(out, key=str)


def close_to(got, want):
    assert [(*g[:2], *g[4:]) for g in got] == [(*w[:2], *w[4:]) for w in want]
    np.testing.assert_allclose([g[2:4] for g in got], [w[2:4] for w in want], rtol=1e-12)


def test_settlement_of_shuffled_late_and_repeated_files(spark):
    rows = bars()
    rng = np.random.default_rng(1)
    late = [r for r in rows if r[1] == day(20)]                     # comes at the very end
    order = sorted((r for r in rows if r[1] != day(20)), key=lambda r: (r[1] - D0).days + rng.uniform(0, 9))
    files = [order[i:i + 17] for i in range(0, len(order), 17)]
    got, aside = run(spark, [*files, files[0], late], BARS, lambda t: jobs.settle_stream(t, CFG, 10), jobs.SETTLE_OUT)
    close_to(got, settled([r for r in rows if r[1] != day(20) and r[1] <= day(49)]))       # ten days stay in state
    assert [a[:2] for a in aside] == sorted(((r[0], r[1]) for r in [*files[0], *late]), key=str)
    assert {a[5] for a in aside} == {"late_bar"}


def test_settlement_in_order_takes_every_bar(spark):
    rows = sorted(bars(7, 40), key=lambda r: r[1])
    got, aside = run(spark, [rows[:31], rows[31:50], rows[50:]], BARS, lambda t: jobs.settle_stream(t, CFG), jobs.SETTLE_OUT)
    close_to(got, settled(rows))
    assert not aside


def test_settlement_of_nulls(spark):
    rows = [(None, day(i), 1.0, None if i == 3 else 1.0, 0.07, None if i == 0 else i == 1) for i in range(8)]
    got, aside = run(spark, [rows], BARS, lambda t: jobs.settle_stream(t, CFG), jobs.SETTLE_OUT)
    assert [(g[0], g[1], g[2]) for g in got] == [(None, day(1), 0.0)] and not aside


@pytest.mark.parametrize("late_sessions", [0, 8])
def test_cooldown_of_shuffled_files(spark, late_sessions):
    rng = np.random.default_rng(2)
    rows = [(t, day(d), int(d)) for t in ("AAA", "BBB") for d in sorted(rng.choice(90, 40, replace=False))]
    lag = 7 if late_sessions else 0
    order = sorted(rows, key=lambda r: r[2] + (rng.uniform(0, lag) if lag else 0))
    files = [order[i:i + 13] for i in range(0, len(order), 13)]
    got, aside = run(spark, [*files, files[1]], EVENTS, lambda t: jobs.cooldown_stream(t, CFG, late_sessions), jobs.COOL_OUT)
    want = []
    for t in ("AAA", "BBB"):
        di, last = [r[2] for r in rows if r[0] == t], None
        for d in (d for d in di if d <= max(di) - late_sessions):
            if last is None or d - last > CFG.horizon:
                last = d
                want.append((t, day(d), d))
    assert got == sorted(want, key=str)
    assert aside == sorted(files[1], key=str)
