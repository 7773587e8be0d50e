"""Rounds found by pointers against going through the messages one by one."""

import random

import pytest
from pyspark.sql import functions as F

from tidalfed.operators.roundscan import rounds_scan


def one_by_one(rows, minimum, timeout):
    out, opened, seen, number, members = [], None, set(), 0, []

    def close(reason):
        nonlocal opened, seen, number, members
        out.extend((m, number, reason) for m in members)
        opened, seen, number, members = None, set(), number + 1, []

    for at, region, n in sorted(rows):
        if opened is not None and at > opened + timeout:
            close("timeout")
        opened = at if opened is None else opened
        members.append(n)
        seen.add(region)
        if len(seen) >= minimum:
            close("regions")
    if members:
        close(None)
    return sorted(out)


@pytest.mark.parametrize("minimum, block", [(2, 5), (4, 64), (3, 100_000)])
def test_rounds_equal_one_by_one(spark, minimum, block):
    draw = random.Random(minimum)
    rows = {}
    for model in ("hot", "cold"):
        at, rows[model] = 0, []
        for n in range(400 if model == "hot" else 40):
            at += draw.choice([0, 0, 1, 5, 30, 90])
            rows[model].append((at, draw.choice("aaaabbc" if n < 200 else "abcdefg"), n))
    frame = spark.createDataFrame(
        [(m, r, a, n) for m, rs in rows.items() for a, r, n in rs],
        "model_id string, region string, s long, n long").withColumn(
        "event_time", F.timestamp_seconds("s"))
    got = rounds_scan(frame, minimum=minimum, timeout_seconds=60, block_rows=block,
                      group_rows=50).collect()
    for model, some in rows.items():
        mine = {r.n: (r["round"], r.reason) for r in got if r.model_id == model}
        assert len(mine) == len(some)
        want = {n: (number, reason) for n, number, reason in one_by_one(some, minimum, 60)}
        # Messages equal in time and region are interchangeable: compare by these.
        place = {n: (a, r) for a, r, n in some}
        assert sorted((place[n], v[0], str(v[1])) for n, v in mine.items()) == sorted(
            (place[n], v[0], str(v[1])) for n, v in want.items())
