"""The divergence audit against plain counting, and its merge against set operations."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from shotlake.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, term string, value string, rank string, bucket int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 1, "x", "y", "z", 0) for i, (t, lang, s) in enumerate(rows)], SCHEMA)


def plain(rows, least, top):
    held, count = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        count[lang or "", source or ""].update(terms)
        held[lang or ""].update(set(terms))
    out = []
    for lang in held:
        kept = sorted(t for t, n in held[lang].items() if n >= least)
        price = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}  # noqa: B023, E731
        own = {s: price(c) for (g, s), c in count.items() if g == lang}
        whole = price(sum((c for (g, _), c in count.items() if g == lang), Counter()))
        for s, p in own.items():
            pairs = [(x, sum(abs(p[t] - q[t]) for t in kept)) for x, q in own.items() if x != s]
            terms = [(t, p[t] - whole[t]) for t in kept if count[lang, s][t] and p[t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, x, v, k + 1) for k, (x, v) in enumerate(found[:most])]
    return sorted(out)


def table(seed):
    rng = random.Random(seed)
    words = [f"W{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90)] + ["É", "日本", "naïve", "don't", "x1y"]
    rows = []
    for _ in range(500):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice([*"abcdefghijkl", None, "ß", "hot", "hot", "hot"])
        rows.append((" ".join(rng.choices(words, [1 / (1 + k % (5 + len(source or ""))) for k in range(len(words))], k=rng.randint(0, 25))), lang, source))
    return rows + [(None, "en", "empty"), ("", "xx", "alone"), ("\x00\x7f 12", "xx", None), ("rare words here", "yy", "one"), ("word " * 5000, "en", "a")] + rows[:7]


@pytest.mark.parametrize(("chunk", "block", "piece"), [(65_536, 8, 1 << 20), (7, 2, 100), (1, 1, 13)])
def test_audit_against_plain_counting(spark, monkeypatch, chunk, block, piece):
    monkeypatch.setattr(divergence, "PIECE", piece)
    monkeypatch.setattr(divergence, "HELD", 50 * chunk)
    rows = table(chunk)
    got = divergence.audit(docs(spark, rows).repartition(3), least_docs=12, top=9, chunk=chunk, block=block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(rows, 12, 9)


def test_odd_tables(spark):
    assert divergence.audit(docs(spark, [("a", "x", "s")]).limit(0)).count() == 0
    # nothing is kept: pairs are worth 0
    got = divergence.audit(docs(spark, [("a", "x", "s"), (None, "x", "t"), (None, None, None)]))
    assert sorted(map(tuple, got.collect())) == [("x", "s", "pair", "t", 0, 1), ("x", "t", "pair", "s", 0, 1)]


def test_galloping_merge_against_sets():
    rng = np.random.default_rng(1)
    for n, m in ((0, 0), (0, 5), (1, 1), (3, 4000), (500, 700), (2000, 2000)):
        a, b = (np.sort(rng.choice(9000, k, replace=False)).astype(np.int64) for k in (n, m))
        assert divergence.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()
        p, q = rng.integers(1, 10**9, n), rng.integers(1, 10**9, m)
        left, right = dict(zip(a.tolist(), p.tolist())), dict(zip(b.tolist(), q.tolist()))
        want = sum(abs(left.get(t, 7) - right.get(t, 11)) for t in left.keys() | right.keys())
        assert divergence.difference((a, p, 7), (b, q, 11)) == (want, len(left.keys() | right.keys()))
        assert divergence.difference((b, q, 11), (a, p, 7))[0] == want


def test_prices_are_exact():
    counts = np.array([0, 1, 7, 10**13, 3 * 10**14])
    for total, kept in ((10**3, 5), (3 * 10**14, 10**8), (9 * 10**15, 3)):
        assert divergence.price(counts[counts <= total], total, kept).tolist() == [1 + 10**9 * (int(c) + 5) // (total + 5 * kept) for c in counts if c <= total]


def test_divergence_query_against_sql(spark):
    from shotlake.llm.queries import ORACLE_SQL, op12_divergence

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = op12_divergence(spark, sf)
    want = con.execute(ORACLE_SQL["op12_divergence"]).fetchall()
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == sorted(want) and len(want) > 100
