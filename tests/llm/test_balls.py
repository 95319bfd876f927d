"""Balls of fingerprints: what is shuffled for them."""

import random

import pytest

simhash = pytest.importorskip("curveloom.llm.simhash")


def shuffled(spark, work):
    """What work() gives, and how many records it wrote to shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def total():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = total()
    return work(), total() - before


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_without_neighbours_emit_no_variants(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(3000)]
    near = [(f ^ (1 << a) ^ (1 << b), k) for k, f in enumerate(fps[:200]) for a, b in [rng.sample(range(64), 2)]]
    rows = [(signed(f), k) for k, f in enumerate(fps)] + [(signed(f), 10_000 + k) for f, k in near]
    df = spark.createDataFrame(rows, "fp bigint, node bigint")
    got, records = shuffled(spark, lambda: {(r.u, r.v) for r in simhash.ball_edges(df).collect()})
    assert got == {(10_000 + k, k) for _, k in near}
    assert records < 20 * len(rows) + 65 * 2.5 * len(near)  # all variants of all rows are 65 records a row


@pytest.mark.parametrize("radius", [2, 4])
def test_whoever_has_a_neighbour_has_company(spark, radius):
    rng = random.Random(radius)
    pairs = []
    for k in range(300):  # bits from every part of the fingerprint, also the sign, and from one part alone
        x, bits = rng.getrandbits(64), rng.sample(range(64), radius) if k % 2 else [(k + i) % 64 for i in range(radius)]
        pairs += [(x, 2 * k), (x ^ sum(1 << b for b in bits), 2 * k + 1)]
    df = spark.createDataFrame([(signed(x), k) for x, k in pairs], "fp bigint, node bigint")
    assert simhash._with_company(df, radius).count() == len(pairs)
