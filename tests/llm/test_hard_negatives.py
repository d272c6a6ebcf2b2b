"""Hard negatives against plain integers."""

import math

import duckdb
import numpy as np
import pytest

from shotlake.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score string, seq string, block string, width string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)


def plain(rows, positives=5, negatives=5):
    used = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            used.append((i, [math.floor(256 * x) for x in v], int(math.fmod(label + 1, 10)) if i % 7 == 0 else label))
    out, long = [], lambda x: max(-(2**63), min(2**63 - 1, x))
    for a, (i, v, label) in enumerate(used):
        if i % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, b) for b, (j, w, _) in enumerate(used) if b != a and len(w) == len(v))
        for s, j, _ in [x for x in scored if used[x[2]][2] == label][:positives]:
            fits = [x for x in scored if used[x[2]][2] != label and -80 * s <= -100 * x[0] <= -100 * s][:negatives]
            out += [(i, j, k + 1, n, long(-s), long(-t)) for k, (t, n, _) in enumerate(fits)]
    return sorted(out)


def table(seed, n=400, width=6):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=width) * 0.2 + 0.3, 2)], int(rng.integers(0, 4))) for i in range(n)]
    rows += [(700, None, 1), (701, [0.1] * width, None), (702, [0.1, None] * (width // 2), 1), (703, [float("nan")] * width, 1), (704, [float("inf")] * width, 1), (None, [0.5] * width, 1)]
    rows += [(800, [0.25, 0.5], 1), (801, [0.5, 0.5], 1), (802, [0.5, 0.45], 2), (900, [], 1), (901, [], 1), (902, [], 2), (-100, [0.4] * width, -5)]
    return rows


@pytest.mark.parametrize(("candidates", "anchors"), [(8192, 16_384), (37, 2)])
def test_mining_against_plain_integers(spark, candidates, anchors):
    rows = table(candidates)
    got = hard_negatives.mine(vectors(spark, rows).repartition(3), candidates=candidates, anchors=anchors)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain(rows) and len(plain(rows)) > 40


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(3)
    for scale in (1e3, 1e7, 1e12):
        rows = [(i * 10, [float(x) for x in (rng.normal(size=4) + 2) * scale], int(rng.integers(0, 3))) for i in range(60)]
        assert sorted(map(tuple, hard_negatives.mine(vectors(spark, rows)).collect())) == plain(rows)


def test_repeated_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (3, [1.0, 0.5], 1), (5, [0.9, 0.1], 2), (5, [0.9, 0.1], 2)]
    got = hard_negatives.mine(vectors(spark, rows))
    assert sorted(map(tuple, got.collect())) == plain(rows)
    assert hard_negatives.mine(vectors(spark, rows).limit(0)).count() == 0
    assert hard_negatives.mine(vectors(spark, [(1, [1.0], 1)])).count() == 0


def test_packed_products_are_inner_products():
    rng = np.random.default_rng(0)
    for low, high, a_low, a_high, width in ((-256, 257, -256, 257, 64), (0, 2, 0, 2, 3), (-(2**29), 2**29, -(2**29), 2**29, 50), (5, 9, -9, -5, 7), (-9, -5, 5, 9, 7), (0, 1, 0, 1, 4)):
        rows, asked = rng.integers(low, high, (301, width)), rng.integers(a_low, a_high, (5, width))
        packed = hard_negatives.Packed(rows, int(asked.min()), int(asked.max()), packed=100)
        for a in asked.tolist():
            assert [int(s) for s in packed.scores(a)] == [sum(x * y for x, y in zip(a, r)) for r in rows.tolist()]
    huge = np.array([[10**40, -(10**41)], [3, 10**39]], object)
    assert [int(s) for s in hard_negatives.Packed(huge, -5, 10**30).scores([10**30, -5])] == [10**70 + 5 * 10**41, 3 * 10**30 - 5 * 10**39]


def test_hard_negative_query_against_sql(spark):
    from shotlake.llm.queries import ORACLE_SQL, op13_hard_negatives

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.execute(ORACLE_SQL["op13_hard_negatives"]).fetchall()
    got = op13_hard_negatives(spark, sf).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    assert sorted(map(tuple, got)) == sorted(tuple(r) for r in want) and len(want) > 50
