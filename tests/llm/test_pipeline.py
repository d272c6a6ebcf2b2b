"""The stages of corpus_pipeline on planted documents."""

import random
from collections import Counter, defaultdict

import corpus_pipeline

KEY = "kJ8vQ2mZx7Lp0RtY5nWc3BdF6hGs9aEu"


def test_run_drops_and_masks_what_was_planted(spark, tmp_path):
    rng = random.Random(7)
    words = lambda: [rng.choice("river stone cloud garden window paper music winter bread letter".split()) + str(rng.randint(0, 99)) for _ in range(40)]
    clean = {i: " ".join(words()) for i in range(100, 180)}
    toxic = {i: " ".join([*words(), "you stupid worthless idiot"]) for i in range(200, 240)}
    copies = {i + 200: t if i % 2 else t + " end" for i, t in clean.items() if i < 120}
    secret = {i: f"{' '.join(words())} {KEY}" for i in range(500, 510)}
    rows = [(i, t, "en", "ab"[i % 2], len(t)) for i, t in (clean | toxic | copies | secret).items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in [*clean, *toxic]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {k: stage(spark, docs, str(tmp_path)) for k, stage in corpus_pipeline.STAGES[1:3]}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert ids(left["jaccard_join"]) == {*clean, *toxic, *secret}
    texts = {r.doc_id: r.text for r in left["secret_scan"].collect()}
    assert texts == clean | toxic | copies | {i: t.replace(KEY, "[SECRET]") for i, t in secret.items()}
    assert ids(corpus_pipeline.run(spark, str(tmp_path))) == {*clean, *secret}


ODD = [(1, None), (2, ""), (3, " \n "), (None, "no id but words enough to be a shingle"), (4, "one two three four five six seven"), (5, "one two three four five six seven"), (6, f"key {KEY} and more"), (6, f"key {KEY} and more"), (7, "x " * 20_000), (8, "日本語のテキスト é 😀")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, record string, shard int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "ab"[k % 2], None if t is None else len(t), "r", 1) for k, (i, t) in enumerate(rows)], SCHEMA)


def test_each_stage_on_odd_rows_and_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(4, 1, 0), (None, 1, 1), (99, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    docs, texts = documents(spark, ODD), Counter(ODD)
    rows = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    for name in ("toxicity", "jaccard_join", "secret_scan", "mixing"):
        assert stages[name](spark, documents(spark, []), sf).count() == 0 and stages[name](spark, docs, sf).columns == docs.columns
    assert rows(stages["toxicity"](spark, docs, sf)) == texts  # the one usable label names no toxic row
    kept = rows(stages["jaccard_join"](spark, docs, sf))
    assert kept == Counter({k: 1 for k in texts if k[0] != 5})  # 5 is a copy of 4, 6 was there twice
    assert rows(stages["secret_scan"](spark, docs, sf)) == Counter((i, t.replace(KEY, "[SECRET]") if t else t) for i, t in ODD)
    mixed = rows(stages["mixing"](spark, docs, sf))
    assert set(mixed) == set(texts) and all(mixed[k] >= n for k, n in texts.items())
    pieces = stages["packing"](spark, docs, sf).collect()
    length, room = defaultdict(int), defaultdict(int)
    for p in pieces:
        length[p.doc_id, p.doc_tokens] += p.length
        room[p.sequence_id] += p.length
    assert max(room.values()) <= 2048 and sum(length.values()) == sum(room.values())
    assert all(n % tokens == 0 for (_, tokens), n in length.items()) and {i for i, _ in length} == {i for i, _ in ODD}
    assert stages["packing"](spark, documents(spark, []), sf).count() == 0


def test_toxic_documents_go_and_clean_ones_stay(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, sf).select("doc_id").collect()}
    truth = [r for r in labels.collect() if r.toxic is not None]
    bad, good = [r.doc_id for r in truth if r.toxic == 1], [r.doc_id for r in truth if r.toxic == 0]
    assert sum(i in kept for i in bad) < 0.1 * len(bad) and sum(i not in kept for i in good) < 0.01 * len(good)
