import random

from folioflow.streaming import leases


def plain(rows, spacing=3_000, preprint_spacing=15_000):
    """{(lane, seq): (lease, skipped)} of rows (lane, seq, ms, host, preprint, wall): one request after the other."""
    out = {}
    for lane in {r[0] for r in rows}:
        walls = {}
        for _, _, at, host, _, wall in rows:
            if wall and _lane(rows, lane, host):
                walls[host] = min(at, walls.get(host, at))
        free = free_preprint = 0
        for _, seq, at, host, preprint, _ in sorted((r for r in rows if r[0] == lane and not r[5]), key=lambda r: (r[2], r[1])):
            start = max(at, free, free_preprint if preprint else 0)
            skipped = host in walls and walls[host] <= start
            if not skipped:
                free, free_preprint = start + spacing, start + preprint_spacing if preprint else free_preprint
            out[lane, seq] = start, skipped
    return out


def _lane(rows, lane, host):
    return any(r[0] == lane and r[3] == host and r[5] for r in rows)


def frame(spark, rows):
    from pyspark.sql import functions as F

    given = spark.createDataFrame([(lane, seq, at, f"https://{host}/{seq}", host, preprint, wall) for lane, seq, at, host, preprint, wall in rows], "lane string, seq long, ms long, url string, host string, preprint boolean, wall boolean")
    return given.select("lane", "seq", F.timestamp_millis("ms").alias("at"), "url", "host", "preprint", "wall")


def got(table):
    return {(r.lane, r.seq): (r.lease_ms, r.skipped) for r in table.collect()}


def test_leases_are_spaced_in_order_and_walls_are_skipped(spark):
    chance = random.Random(2)
    base = 1_700_000_000_000
    rows = [(f"lane{i % 3}", i, base + chance.randrange(60_000), f"h{chance.randrange(4)}", chance.random() < 0.3, False) for i in range(60)]
    rows += [(f"lane{k}", -k - 1, base + 20_000, "h1", False, True) for k in range(3)]
    want = plain(rows)
    assert any(s for _, s in want.values())
    assert got(leases.schedule([frame(spark, rows)], delay="2 minutes")) == want


def test_a_thousand_requests_of_one_lane_have_one_plan_and_few_batches(spark):
    base = 1_700_000_000_000
    rows = [("any", i, base, "one", False, False) for i in range(1000)]
    assert got(leases.schedule([frame(spark, rows)])) == {("any", i): (base + 3_000 * i, False) for i in range(1000)}


def test_the_state_goes_on_from_run_to_run(spark):
    base = 1_700_000_000_000
    first = [("any", i, base + i, "a" if i % 2 else "b", False, False) for i in range(20)]
    second = [("any", -1, base + 30_000, "b", False, True)] + [("any", 100 + i, base + 30_000 + i, "a" if i % 2 else "b", False, False) for i in range(10)]
    # leases that are due before the wall is known are made before it; those after it are skipped
    assert got(leases.schedule([frame(spark, first), frame(spark, second)], delay="1 second")) == plain(first + second)
    none = frame(spark, first).limit(0)
    assert got(leases.schedule([none, frame(spark, first), none])) == plain(first) and got(leases.schedule([none])) == {}
