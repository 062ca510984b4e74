"""Kernels against plain versions that follow their definitions directly."""

import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerloom.llm import language, media, pack, quality, shard


def test_winning_shard(spark):
    weights = [1.0, 2.5, 0.5, 1.0]
    keys = [None, 0, -1, 2**62, *range(300)]

    def plain(key):
        costs = []
        for k, weight in enumerate(weights):
            digest = hashlib.md5(f"{'' if key is None else key}:{k}".encode()).hexdigest()[:13]
            costs.append((-math.log((int(digest, 16) + 0.5) / 2**52) / weight, k))
        return min(costs)[1]

    df = spark.createDataFrame([(k, key) for k, key in enumerate(keys)], "k long, key long")
    found = [r[0] for r in df.orderBy("k").select(shard.shard_of(F.col("key"), weights)).collect()]
    assert found == [plain(key) for key in keys]
    empty = shard.assign_shards(df.limit(0).withColumn("text", F.lit("x")), [1.0, 1.0], key_col="key")
    assert empty.count() == 0
    some = shard.assign_shards(df.withColumn("text", F.lit("x")), [1.0, 1.0], key_col="key").collect()
    assert len(some) == len(keys) and [r["size"] for r in some if r["key"] is None] == [2]


def plain_plan(lengths, capacities, cost, only):
    """Every open bin is looked at: the least room that holds the piece; of equal rooms, the one that came to it last."""
    room, used, since, bins, offsets = [], [], [], [], []
    for k, size in enumerate(lengths):
        fitting = [(room[b], -since[b], b) for b in range(len(room)) if room[b] >= size]
        if fitting:
            b = min(fitting)[2]
        else:
            able = [c for c in capacities if c >= size]
            best = min(able, key=lambda c: (cost(c) / min(c, sum(lengths[k:])), c)) if only is None else next((c for c in able if c >= only), able[0])
            b = len(room)
            room.append(best)
            used.append(0)
            since.append(k)
        bins.append(b)
        offsets.append(used[b])
        used[b] += size
        room[b] -= size
        since[b] = k
    return bins, offsets, used


@pytest.mark.parametrize("seed", range(12))
def test_packing_plans(seed):
    r = random.Random(seed)
    capacities = [8, 20, 64]
    lengths = sorted((r.choice([1, 2, 3, 5, 8, 13, 20, 21, 40, 64]) for _ in range(r.randrange(1, 120))), reverse=True)
    rest = [sum(lengths[k + 1 :]) for k in range(len(lengths))]
    cost = pack.sequence_cost
    totals = []
    for only in (None, *capacities):
        found = pack._plan(lengths, rest, capacities, cost, only)
        assert found == plain_plan(lengths, capacities, cost, only)
        totals.append(sum(cost(next(c for c in capacities if c >= u)) for u in found[2]))
    bins, _, final = pack.pack_group(np.array(lengths), capacities)
    assert sum(map(cost, dict(zip(bins.tolist(), final.tolist())).values())) == min(totals)


def test_packing_keeps_null_and_large_ids(spark):
    large = 2**60 + 1
    df = spark.createDataFrame([(large, "abc"), (None, "abc"), (None, None), (large, "abc"), (3, "x" * 90)], "doc_id long, text string")
    rows = pack.pack_sequences(df, capacities=(16, 64)).collect()
    assert sorted((r["doc_id"] or 0, r["piece"], r["length"]) for r in rows) == [(0, 0, 1), (0, 0, 4), (3, 0, 64), (3, 1, 27), (large, 0, 4), (large, 0, 4)]


@pytest.mark.parametrize("seed", range(6))
def test_mixture_is_the_likeliest(seed):
    random_ = np.random.default_rng(seed)
    odds = random_.dirichlet(np.full(30, 0.3), 3).T + 1e-4
    blend = odds @ random_.dirichlet(np.ones(3))
    counts = random_.multinomial(200, blend / blend.sum()).astype(float)
    share, level = language.mixture(counts, odds, rounds=5000, close=1e-9)
    assert share.sum() == pytest.approx(1) and (share >= 0).all()
    steps = np.arange(0, 1.001, 0.02)
    grid = [np.array([a, b, 1 - a - b]) for a in steps for b in steps if a + b <= 1 + 1e-9]
    assert level >= max(float(counts @ np.log(odds @ np.clip(g, 0, 1))) for g in grid) - 1e-6


@pytest.mark.parametrize("truth", [{0: 1.0}, {1: 0.6, 3: 0.4}, {0: 0.3, 2: 0.3, 3: 0.4}])
def test_language_set_of_all_sets(truth):
    random_ = np.random.default_rng(5)
    odds = random_.dirichlet(np.full(60, 0.1), 4).T + 1e-5
    share = np.array([truth.get(k, 0.0) for k in range(4)])
    counts = random_.multinomial(3000, odds @ share / (odds @ share).sum()).astype(float)
    penalty = 2.0
    sets = [c for n in range(1, 5) for c in itertools.combinations(range(4), n)]
    best = max(sets, key=lambda c: language.mixture(counts, odds[:, c], 5000, 1e-9)[1] - (len(c) - 1) * penalty * math.log(counts.sum() + 1))
    found = language.infer(counts, odds, penalty)
    assert set(found) == set(best) == set(truth)
    assert all(found[k] == pytest.approx(truth[k], abs=0.06) for k in truth)


def test_gradient_step():
    """One step moves every parameter against the slope of the log loss, measured by differences."""
    buckets, counts, label, rate = np.array([3, 70, 500]), np.array([2, 1, 1]), 1, 0.5
    random_ = np.random.default_rng(7)
    vectors, output, bias = random_.normal(0, 0.1, (quality.BUCKETS + 1, 4)), random_.normal(0, 0.1, (4, 2)), np.zeros(2)

    def loss(v, o, b):
        logits = np.average(v, axis=0, weights=counts) @ o + b
        return math.log(np.exp(logits).sum()) - logits[label]

    def slope(parts, which):
        out = np.zeros_like(parts[which])
        for at in np.ndindex(out.shape):
            ends = []
            for step in (1e-5, -1e-5):
                moved = [p.copy() for p in parts]
                moved[which][at] += step
                ends.append(loss(*moved))
            out[at] = (ends[0] - ends[1]) / 2e-5
        return out

    parts = [vectors[buckets], output, bias]
    after = quality.fit([(buckets, counts, label)], dimensions=4, epochs=1, rate=rate, seed=7)
    found = [after[0][buckets], after[1], after[2]]
    for k, pace in enumerate((rate, rate, 0.1 * rate)):
        assert np.allclose(found[k], parts[k] - pace * slope(parts, k), atol=1e-7)
    still = np.setdiff1d(np.arange(quality.BUCKETS + 1), buckets)
    assert np.array_equal(after[0][still], vectors[still])


def test_media_features():
    for payload in (b"\xff" * 576, random.Random(1).randbytes(1152), ("Ünï" * 400).encode()[:1152]):
        turns = sum((a >= 128) != (b >= 128) for a, b in itertools.pairwise(payload))
        found = media.features_of(media.header(len(payload)) + payload)
        assert found["feature"] == f"sum={sum(payload)};min={min(payload)};max={max(payload)};turns={turns}"
        assert (found["payload_bytes"], found["payload_sha256"], found["media_bytes"]) == (len(payload), hashlib.sha256(payload).hexdigest(), len(payload) + 44)
