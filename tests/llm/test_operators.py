"""The operators of shotlake.llm on small tables, against brute force where there is no SQL."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shotlake.llm import components, embedding_dedup, fingerprints, jaccard_join, mixing, packing, quality, secret_scan, sharding, tokens, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, spans string, record string, vec_id string"
SF = "/root/testdata/sf0.001"


def documents(spark, *rows):
    """rows: (doc_id, text) or (doc_id, text, source); further columns have names that operators use."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), 7, "x", "y", "z") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (None, "no id at all but words"), (5, "same text here twice or so"), (6, "same text here twice or so"), (7, "日本語のテキスト é ö 😀 x"), (7, "日本語のテキスト é ö 😀 x"), (8, "long " * 30_000)]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False)


# --- token counts

TEXTS = ["É'S don't <|endoftext|>x <|ENDOFTEXT|> J̌ ǰ ÉÀü!! ß… 12ab a_b {x}", "ǅ İstanbul ΑΣ Σ", "　a\xa0b\x85c\x1cd e", "", "   ", "ªº µ÷×", "áb̀ z", "fi'rest we'll 'tis '' ''s", "x" * 500]


def test_cached_words_equal_the_library(library):
    words = tokens.Words(remembered=3)
    for text in TEXTS * 2:
        want = library(text).ids
        assert np.frombuffer(words.ids(text.encode()), "<u4").tolist() == want and words.count(text.encode()) == len(want)


def test_letters_before_every_combining_mark(library):
    words = tokens.Words()
    texts = [f"{letter}{chr(mark)}x abc" for mark in range(0x300, 0x370) for letter in "ATtYzJWwHhXé"] + [f"A{chr(m)}{chr(n)}" for m in (0x308, 0x344, 0x327) for n in range(0x300, 0x370)]
    for text in texts:
        assert np.frombuffer(words.ids(text.encode()), "<u4").tolist() == library(text).ids, text.encode()


@pytest.mark.parametrize(("chunk", "overlap"), [(1, 1), (50, 4), (64, 16), (300, 40)])
def test_chunks_resynchronise(library, chunk, overlap):
    rng, words = random.Random(chunk), tokens.Words()

    def encode(piece):
        text = piece.decode()
        starts = [len(text[:a].encode()) for a, _ in library(text).offsets]
        return np.array(starts, np.int64), np.ones(len(starts), np.int64)

    for _ in range(12):
        text = "".join(rng.choice(["the ", "thing", "É", "  ", "\n", "<|endoftext|>", "x" * 90, "!?", "12", "'s "]) for _ in range(rng.randint(1, 150)))
        want = len(library(text))
        assert tokens.count_by_chunks(text.encode(), encode, chunk, overlap) == want
        assert tokens.count_by_chunks(text.encode(), words.encode, chunk, overlap) == want == words.count(text.encode(), chunk, overlap)


def test_other_vocabularies_go_to_their_library_whole():
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    text = "a hello world  é " * 50
    plain = tokens.Words("byte_bpe_50k.json")
    assert not plain.by_words and plain.count(text.encode(), 20, 4) == len(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids)
    assert tokens.Words("piece_bpe_32k.model").count(text.encode()) == len(SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")).encode(text))


def test_token_counts(spark, library):
    for chunk in (1000, 7):
        rows = tokens.token_counts(documents(spark, *ODD), chunk=chunk, overlap=5).collect()
        assert sorted(map(tuple, rows), key=str) == sorted(((i, len((t or "").encode()), len(library(t)), len(library(t)) > 2048) for i, t in ODD), key=str)
    assert tokens.token_counts(documents(spark)).count() == 0


def test_token_counts_query_against_the_library(spark, library):
    from shotlake.llm.queries import op3_token_counts

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert sum(len((r.text or "").encode()) > tokens.CHUNK for r in docs) > 5
    want = {(r.doc_id, len((r.text or "").encode()), n := len(library(r.text)), n > 2048) for r in docs}
    assert set(map(tuple, op3_token_counts(spark, SF).collect())) == want


# --- packing

def test_pieces_cover_documents_and_fill_sequences():
    rng = random.Random(1)
    lengths = [rng.choice([1, 5, 63, 64, 65, 200, 640]) for _ in range(300)]
    pieces = packing.assign(lengths, 64)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for d, a, n, s, o in pieces:
        by_doc[d].append((a, n))
        by_seq[s].append((o, n))
    for d, length in enumerate(lengths):
        at = 0
        for a, n in sorted(by_doc[d]):
            assert a == at and n > 0
            at += n
        assert at == length
    for spans in by_seq.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 64
    assert len(by_seq) == -(-sum(lengths) // 64)


def test_packing_takes_the_lowest_cost():
    # 6 and 5 open both sequences, 4 joins the cheaper 5, 3 the 6, then 2 is cut between what is left
    assert packing.assign([5, 3, 4, 2, 6], 10) == [(4, 0, 6, 0, 0), (0, 0, 5, 1, 0), (2, 0, 4, 1, 5), (1, 0, 3, 0, 6), (3, 0, 1, 1, 9), (3, 1, 1, 0, 9)]
    assert packing.assign([], 10) == []


def test_pack(spark, library):
    rows = packing.pack(documents(spark, *ODD), window=4).collect()
    want = Counter()
    for i, t in ODD:
        want[i, len(library(t)) + 1] += 1
    got = defaultdict(int)
    for r in rows:
        got[r.doc_id, r.doc_tokens] += r.length
    assert dict(got) == {k: k[1] * n for k, n in want.items()}
    ids = np.array(library("word").ids + [1], "<u4").tobytes()
    assert [r.ids_crc32 for r in rows if r.doc_id == 4] == [zlib.crc32(ids)]
    assert max(Counter(r.sequence_id for r in rows for _ in range(r.length)).values()) <= 2048


def test_packing_query_against_the_library(spark, library):
    from shotlake.llm.queries import op5_packing

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    ids = {i: np.array([*library(t).ids, 1], "<u4") for i, t in texts.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in op5_packing(spark, SF).collect():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
    for spans, whole in [*((by_doc[i], len(x)) for i, x in ids.items()), *((v, None) for v in by_seq.values())]:
        at = 0
        for a, n in sorted(spans):
            assert a == at and n > 0
            at += n
        assert at == whole if whole is not None else at <= 2048
    assert sum(map(len, ids.values())) > 0.95 * 2048 * len(by_seq)


# --- fingerprints

def units_of(text):
    return re.findall(r"[\x21-\x7E\u00A1-\u0DFF]{1,24}|[^\x20\x09-\x0D]", text)


def test_winnowing_against_brute_force(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("a b c dd e") for _ in range(n)) for n in (0, 1, 3, 4, 5, 8, 9, 40, 200)] + ["日本語のテキスト", "x" * 60]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    units = F.regexp_extract_all("text", F.lit(fingerprints.UNIT), F.lit(0))
    for k, w in ((fingerprints.K, fingerprints.W), (1, 3), (5, 4)):
        rows = df.select("text", units.alias("u"), F.transform(units, lambda u: F.xxhash64(u)).alias("h"), fingerprints.winnow(F.col("text"), k, w).alias("f")).collect()
        for r in rows:
            assert r.u == units_of(r.text)
            h = [x % fingerprints.PRIME for x in r.h]
            gram = lambda part: sum(x * pow(fingerprints.BASE, len(part) - 1 - j, fingerprints.PRIME) for j, x in enumerate(part)) % fingerprints.PRIME
            g = [gram(h[i : i + k]) for i in range(len(h) - k + 1)] if len(h) >= k else [gram(h)] if h else []
            n = max(1, len(g) - w + 1) if g else 0
            want = sorted({max(range(i, min(i + w, len(g))), key=lambda j: (-g[j], j)) for i in range(n)})
            assert [(f.position, f.hash) for f in r.f] == [(p, g[p]) for p in want]


def test_neighbours_and_edits(spark, monkeypatch):
    from shotlake.llm.queries import op1_fingerprints

    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 1 << 10)
    rows = {r.doc_id: r for r in op1_fingerprints(spark, SF).collect()}
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect(), reverse=True)
    for d, following in zip(docs, docs[1:] + docs[:1]):
        m = len(d.text) // 3
        edited = d.text[: len(d.text) - m] + following.text[:m]
        assert rows[d.doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[d.doc_id].n_chars == len(d.text)
    marks = lambda text: {x.split("@")[0] for x in text.split()}
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for d, following in zip(docs, docs[1:] + docs[:1]):
        r, own = rows[d.doc_id], marks(rows[d.doc_id].fingerprint)
        assert abs(r.near_edited - alike(own, marks(r.edited_fingerprint))) < 1e-12
        assert abs(r.near_next - alike(own, marks(rows[following.doc_id].fingerprint))) < 1e-12
    near = [r.near_edited > r.near_next for r in rows.values()]
    assert sum(near) / len(near) > 0.95


@pytest.mark.parametrize("ids", [[None] * 900, [7] * 900, [None, 7, 3] * 300, list(range(900)), [1] * 400 + [None] * 400 + [9] * 100])
def test_frequent_ids_are_several_ranges(spark, monkeypatch, ids):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 1 << 9)
    # repeated texts among them
    docs = documents(spark, *[(d, f"text {i % 850} " + "x" * 40) for i, d in enumerate(ids)]).repartition(5)
    got = fingerprints.with_next(docs)
    seen = [(r.doc_id, r.text, r.next_text) for r in got.collect()]
    assert Counter((d, t) for d, t, _ in seen) == Counter((d, f"text {i % 850} " + "x" * 40) for i, d in enumerate(ids))
    # one ring through all texts
    assert Counter(t for _, t, _ in seen) == Counter(t for *_, t in seen)
    follow = {}
    for d, t, n in seen:
        follow.setdefault((d, t), set()).add(n)
    assert sum(len(v - {k[1]}) for k, v in follow.items()) >= len(follow) - 1
    known = [d for d in dict.fromkeys(sorted((x for x in ids if x is not None), reverse=True))]
    groups = [*known, *([None] if None in ids else [])]
    for a, b in zip(groups, groups[1:] + groups[:1]):
        if a != b:  # of each group of one id, one row is followed by a text of the next group alone
            mine, theirs = [s for s in seen if s[0] == a], {t for d, t, _ in seen if d == b}
            assert sum((Counter(t for _, t, _ in mine) - Counter(n for *_, n in mine)).values()) <= 1 and any(n in theirs for *_, n in mine)


def test_next_rows_with_ties_and_nulls(spark):
    rows = fingerprints.with_next(documents(spark, (3, "c"), (None, "n"), (1, "a"), (2, None), (3, "c"))).collect()
    assert sorted(((r.doc_id, r.text, r.next_text) for r in rows), key=str) == sorted([(3, "c", "c"), (3, "c", ""), (2, "", "a"), (1, "a", "n"), (None, "n", "c")], key=str)
    assert fingerprints.with_next(documents(spark)).count() == 0
    assert [(r.text, r.next_text) for r in fingerprints.with_next(documents(spark, (1, "a"))).collect()] == [("a", "a")]
    both = fingerprints.compare_with_edits(documents(spark, *ODD)).select(fingerprints.likeness(F.col("fingerprints.own"), F.col("fingerprints.edited")).alias("n"))
    assert all(0 <= r.n <= 1 for r in both.collect())


# --- Jaccard join

def jaccard_components(rows, percent=80):
    word, lower = re.compile(r"[^\x20\x09-\x0D]+"), {c: c + 32 for c in range(65, 91)}
    sets = {}
    for i, t in rows:
        if i is not None:
            w = word.findall((t or "").translate(lower))
            sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(i, len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("part", [128, 3])
def test_jaccard_join_against_brute_force(spark, part, monkeypatch):
    rng = random.Random(part)
    rows, base = [], []
    for _ in range(12):
        base.append([f"w{rng.randint(0, 400)}" for _ in range(rng.randint(3, 120))])
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice(["A", "B", "w1", "é"])
        if rng.random() < 0.3:
            words += base[0][:20]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 20)
    monkeypatch.setattr(jaccard_join.class_links, "__defaults__", (80, part))
    got = {tuple(r) for r in jaccard_join.join_components(documents(spark, *rows)).collect()}
    assert got == jaccard_components(rows)
    assert len({c for _, _, c in got}) < len(got) - 40


def test_groups_of_several_parts(spark, monkeypatch):
    # near copies that form one component, others apart from them that hold the same passage, and some in between
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"v{rng.randint(0, 3)}"] * (i % 3))) for i in range(40)]
    rows += [(100 + i, " ".join(passage + [f"t{i % 7}x{k}" for k in range(18 + i % 2)])) for i in range(30)]
    rows += [(200 + i, " ".join(passage[: 52 + i % 8] + [f"q{i % 4}"] * (i % 5))) for i in range(20)]
    rng.shuffle(rows)
    monkeypatch.setattr(jaccard_join.class_links, "__defaults__", (80, 4))
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 9)
    got = {tuple(r) for r in jaccard_join.join_components(documents(spark, *rows)).collect()}
    want = jaccard_components(rows)
    assert got == want and 3 < len({c for _, _, c in want}) < 60


def test_groups_of_unlike_texts_lengthen_their_prefixes(spark, monkeypatch):
    # every two of six passages, three times with small changes: many hold each passage, few are alike
    rng = random.Random(5)
    passages = [[f"p{k}x{i}" for i in range(14)] for k in range(6)]
    rows = [(100 * a + 10 * b + c, " ".join(passages[a] + passages[b] + ["end", "word"][: c % 3])) for a in range(6) for b in range(6) if a != b for c in range(3)]
    rows += [(1000 + i, " ".join(passages[i % 6] + [f"q{i}", f"r{i}"])) for i in range(30)]
    rng.shuffle(rows)
    written = Counter()
    plain = jaccard_join.materialise
    monkeypatch.setattr(jaccard_join, "materialise", lambda df, name: written.update([name]) or plain(df, name))
    monkeypatch.setattr(jaccard_join.class_links, "__defaults__", (80, 4))
    got = {tuple(r) for r in jaccard_join.join_components(documents(spark, *rows)).collect()}
    assert got == jaccard_components(rows) and len({c for _, _, c in got}) > 20
    assert written["chosen"] == 1 and written["members"] == 2


def test_jaccard_query_against_sql(spark):
    import duckdb

    from shotlake.llm.queries import ORACLE_SQL, op2_jaccard_join

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = {tuple(r) for r in con.execute(f"SELECT doc_id, n_shingles, component_id FROM ({ORACLE_SQL['op2_jaccard_join']})").fetchall()}
    assert {tuple(r) for r in op2_jaccard_join(spark, SF).collect()} == want


@pytest.mark.parametrize("order", ["descending", "shuffled"])
def test_jaccard_join_of_copies_in_one_block(spark, order):
    words = [f"w{i}" for i in range(60)]
    a, near = " ".join(words), " ".join(words[:-2] + ["x", "y"])
    rows = [(30, a), (25, a), (20, near)]
    rng = random.Random(order)
    for i in range(100, 190):
        group = i % 12
        rows.append((i, " ".join([f"g{group}"] + [f"u{group}x{k}" for k in range(40)] + rng.choice([[], [], ["z"], ["y", "x"]]))))
    rows.sort(reverse=True)
    if order == "shuffled":
        rng.shuffle(rows)
    got = {tuple(r) for r in jaccard_join.join_components(documents(spark, *rows).coalesce(1)).collect()}
    assert got == jaccard_components(rows)


def test_jaccard_join_of_odd_rows(spark):
    got = jaccard_join.join_components(documents(spark, *ODD)).collect()
    plain = sorted({tuple(r) for r in got if r.doc_id is not None})
    assert plain == sorted(jaccard_components(ODD)) and len(got) == len(ODD)
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id is None] == [(2, None)]
    assert jaccard_join.join_components(documents(spark)).count() == 0


def test_pieces_of_long_texts_hash_alike(monkeypatch):
    s = jaccard_join.Shingles()
    text = (" ".join(f"w{i % 97}" for i in range(5000)) + " " + "y" * 9000 + " end").encode()
    whole = s.words_of(text)
    monkeypatch.setattr(jaccard_join.Shingles, "PIECE", 700)
    assert (jaccard_join.Shingles().words_of(text) == whole).all()
    assert (jaccard_join.Shingles().block([b"A b c d e f", text])[1] == s.of_words(whole)).all()


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 9), (3, 1), (7, 8), (8, 6), *((100, k) for k in range(101, 140)), (None, 1)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 9: 9, 6: 6, 7: 6, 8: 6, **{k: 100 for k in range(100, 140)}}
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r.component for r in components.components(chain).collect()} == {0}
    assert components.components(chain.limit(0)).count() == 0


# --- toxicity

def test_chain_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF.replace('0.001', '0.1')}/documents.parquet"), spark.read.parquet(f"{SF.replace('0.001', '0.1')}/labels.parquet")
    inside = labels.where("doc_id % 2 = 0")
    scored = toxicity.score(docs, toxicity.train(docs, inside)).select("record.doc_id", "toxic", "p_toxic")
    held = scored.join(labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "truth"), "doc_id").collect()
    hit = sum(r.toxic and r.truth == 1 for r in held) / sum(r.truth == 1 for r in held)
    wrong = sum(r.toxic and r.truth == 0 for r in held) / sum(r.truth == 0 for r in held)
    assert hit > 0.85 and wrong < 0.01 and all(0 <= r.p_toxic <= 1 for r in held)


def test_later_models_see_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    features = [np.unique(rng.integers(0, 50, 6)) for _ in range(300)]
    first = np.array([float(3 in f) for f in features])
    labels = np.stack([first, np.array([float(3 in f or 7 in f) for f in features])], 1)
    chain = toxicity.fit_chain(features, labels)
    rows = [np.array([chain.place[c] for c in f.tolist() if c in chain.place]) for f in features]
    assert ((chain.predict(rows) > 0.5) == (labels > 0.5)).mean() > 0.97
    assert len(chain.models[1]) == len(chain.models[0]) + 1


def test_models_do_not_depend_on_partitions(spark):
    docs, labels = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet"), spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet")
    found = []
    for n in (3, 5):
        chain = toxicity.train(docs.repartition(n), labels.repartition(n), rows=100)
        found.append([chain.place, *chain.models, quality.train(*quality.weak_labels(docs.repartition(n)), rows=100)])
    assert all(np.array_equal(a, b) if isinstance(a, np.ndarray) else a == b for a, b in zip(*found))


def test_toxicity_query_against_plain_scoring(spark):
    from shotlake.llm.queries import op4_toxicity

    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    chain, rows = toxicity.train(docs, labels), {r.doc_id: r for r in op4_toxicity(spark, sf).collect()}
    assert len(rows) == docs.count()
    for d in docs.select("doc_id", "text").collect():
        at = {chain.place[h] for w in toxicity.words_of(d.text or "") for h in toxicity.hashed(w) if h in chain.place}
        p = []
        for w in chain.models:
            z = w[-1] + sum(w[i] for i in at) + sum(x * y for x, y in zip(w[len(chain.place) :], p))
            p.append(1 / (1 + math.exp(-z)))
        r = rows[d.doc_id]
        assert max(abs(x - y) for x, y in zip(p, (r.p_kind_1, r.p_kind_2, r.p_toxic))) < 1e-9 and r.toxic == (r.p_toxic >= toxicity.THRESHOLD)
    truth = labels.collect()
    assert sum(rows[r.doc_id].toxic == (r.toxic == 1) for r in truth if r.doc_id in rows) > 0.93 * len(truth)


def test_quality_query_against_plain_scoring(spark):
    from shotlake.llm.queries import op7_quality

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    measured, posterior = quality.weak_labels(docs)
    weights, rows, features = quality.train(measured, posterior), {r.doc_id: r for r in op7_quality(spark, SF).collect()}, quality.Features()
    for d in docs.select("doc_id", "text").collect():
        values, words = quality.measures((d.text or "").encode())
        columns, shares = features.of(values, words)
        z = sum(weights[c] * x for c, x in zip(columns, shares)) + weights[-1]
        r = rows[d.doc_id]
        assert r.votes == quality.votes(values) and r.posterior == posterior[r.votes] and abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9 and r.keep == (r.score >= quality.KEEP)


def test_kinds_are_clusters_of_toxic_rows():
    rng = np.random.default_rng(3)
    features, toxic, truth = [], [], []
    for i in range(400):
        kind = i % 4  # 0 and 1 are toxic, each with columns of its own
        own = {0: [1000, 1001, 1002], 1: [2000, 2001, 2002]}.get(kind, [])
        features.append(np.unique([*rng.integers(0, 200, 20), *rng.choice(own, 2, replace=False)] if own else rng.integers(0, 200, 20)))
        toxic.append(float(kind < 2))
        truth.append(kind)
    found, truth = toxicity.kinds_of(features, np.array(toxic)), np.array(truth)
    assert found.sum(1).tolist() == toxic
    assert {tuple(found[truth == k].mean(0).round(2)) for k in (0, 1)} == {(1.0, 0.0), (0.0, 1.0)}
    assert not toxicity.kinds_of(features, np.zeros(400)).any()


def test_toxicity_of_odd_rows(spark):
    docs = documents(spark, *ODD)
    none = spark.createDataFrame([(None, 1), (99, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.train(docs, none) is None
    rows = toxicity.score(docs, None)
    assert rows.count() == len(ODD) and rows.where("toxic").count() == 0 and rows.columns == ["record", "p_kind_1", "p_kind_2", "p_toxic", "toxic"]
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 0)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, labels)).count() == len(ODD)
    assert toxicity.score(documents(spark), toxicity.train(docs, labels)).count() == 0


# --- embeddings

def test_near_duplicates_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    x = [base[i % 60] + rng.normal(size=16) * rng.choice([0, 0.02, 0.1]) for i in range(400)]
    x += [x[0] * 3, x[1]]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [1.0, None] * 8), (1004, [1.0]), (None, rows[0][1]), (1005, [float("inf")] * 16)]
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows + odd], "vec_id long, embedding array<float>, label int, list string, query string")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, part=100).collect()}
    u = np.array([v for _, v in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    found = sum(got[i].n_links for i in range(len(x)))
    assert 0.9 * near.sum() <= found <= near.sum() and near.sum() > 400
    for i in range(len(x)):
        assert got[i].n_links <= near[i].sum() and got[i].kept == (got[i].component_id == i)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(1000, 1006))
    assert got[None].component_id is None and got[None].n_links == 0
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("planted", [False, True])
def test_vector_query_against_brute_force(spark, tmp_path, planted):
    from shotlake.llm.queries import op6_embedding_dedup

    sf = SF.replace("0.001", "0.01")
    if planted:  # the given vectors hold no pair that is near enough: near copies of every third one
        given, rng = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas(), np.random.default_rng(5)
        more = given[::3].copy()
        more["vec_id"] += 1_000_000
        more["embedding"] = [np.float32(v + rng.normal(size=len(v)) * rng.choice([0.01, 0.03, 0.05])) for v in more["embedding"]]
        rows = [(i, np.asarray(v).tolist(), label) for frame in (given, more) for i, v, label in frame[["vec_id", "embedding", "label"]].itertuples(index=False, name=None)]
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
        sf = str(tmp_path)
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()}
    usable = [i for i, v in sorted(vectors.items()) if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    got = {r.vec_id: r for r in op6_embedding_dedup(spark, sf).collect()}
    assert set(got) == set(vectors) and len({len(vectors[i]) for i in usable}) == 1
    x = np.array([vectors[i] for i in usable], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    links = np.array([got[i].n_links for i in usable])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.99 * near.sum() and (near.sum() > 100) == planted
    assert all(r.kept == (r.component_id == i) and r.component_id <= i for i, r in got.items())


def test_vectors_of_other_lengths_link_among_themselves(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(1000 + i, [1.0, 0.0, 0.01 * i]) for i in range(40)] + [(2000, [2.0]), (2001, [3.0]), (2002, [-1.0])]
    rows += [(3000 + i, (np.eye(5)[i % 2] + 0.01 * rng.normal(size=5)).tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, part=60, asking=50).collect()}
    for low, high in ((1000, 2000), (2000, 3000), (3000, 4000)):
        ids = [i for i, _ in rows if low <= i < high]
        u = np.array([v for i, v in rows if low <= i < high])
        near = (u / np.linalg.norm(u, axis=1, keepdims=True)) @ (u / np.linalg.norm(u, axis=1, keepdims=True)).T >= 0.95
        np.fill_diagonal(near, False)
        assert [got[i].n_links for i in ids] == near.sum(1).tolist()
        reach = np.linalg.matrix_power(near.astype(float) + np.eye(len(ids)), len(ids)) > 0
        assert [got[i].component_id for i in ids] == [ids[np.flatnonzero(r)[0]] for r in reach]


@pytest.mark.parametrize(("size", "noise"), [(1500, 0.02), (6000, 0.02), (6000, 0.026)])
def test_recall_with_a_third_of_the_vectors_in_one_group(spark, size, noise):
    rng = np.random.default_rng(size)
    x = rng.normal(size=(size, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[: size // 3] = x[0] + rng.normal(size=(size // 3, 64)) * noise
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, part=700).collect()}
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    links = np.array([got[i].n_links for i in range(size)])
    assert near.sum() > size and links.sum() >= 0.999 * near.sum() and (links <= near.sum(1)).all()


def test_asymmetric_distances_are_those_to_the_coded_vectors():
    x = np.random.default_rng(1).normal(size=(200, 10))
    index = embedding_dedup.Index(x, 5, 4, 16)
    at = embedding_dedup.nearest(x, index.coarse, 1)[:, 0]
    codes, miss = index.encode(x, at)
    here = np.flatnonzero(at == at[0])
    d = np.sqrt(index.distances(x[:7], at[0], codes[here]))
    exact = np.linalg.norm(x[:7, None] - x[here][None], axis=2)
    assert (np.abs(d - exact) <= miss[here] + 1e-9).all()


# --- quality

def test_votes_find_junk_and_keep_clean_documents(spark):
    docs, labels = spark.read.parquet(f"{SF.replace('0.001', '0.1')}/documents.parquet"), spark.read.parquet(f"{SF.replace('0.001', '0.1')}/labels.parquet")
    held = quality.classify(docs).join(labels, "doc_id").collect()
    kept = sum(r.keep and r.quality == 1 for r in held) / sum(r.quality == 1 for r in held)
    caught = sum(not r.keep and r.quality == 0 for r in held) / sum(r.quality == 0 for r in held)
    assert kept > 0.98 and caught > 0.7


def test_em_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    right = [0.95, 0.9, 0.85, 0.7, 0.9, 0.8, 0.9, 0.9]
    cast = ["".join("a" if rng.random() < 0.2 else "g" if (rng.random() < p) == t else "b" for p in right) for t in truth[:6000]]
    count = Counter(cast)
    share, table, _ = quality.accuracies(sorted(count), np.array([count[c] for c in sorted(count)], float))
    assert abs(share - truth[:6000].mean()) < 0.05
    assert max(abs(table[j, 0, 0] - p) for j, p in enumerate(right)) < 0.08


def test_quality_of_odd_rows(spark):
    rows = quality.classify(documents(spark, *ODD)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert quality.classify(documents(spark)).count() == 0


# --- mixing

def mixed(spark, rows, **options):
    counted = mixing.counted(documents(spark, *rows))
    plan = mixing.weights(counted, **options)
    return plan.collect(), mixing.positions(counted, plan, block=4).collect()


def test_mixture_meets_limit_budget_and_order(spark):
    rows = [(i, "w " * (1 + i % 7), "hot" if i % 3 else f"s{i % 4}") for i in range(120)] + [(500, "a b", None), (501, None, "empty")]
    plan, uses = mixed(spark, rows)
    tokens_of = defaultdict(int)
    for _, t, s in rows:
        tokens_of[s] += len((t or "").split())
    p = {s: t / sum(tokens_of.values()) for s, t in tokens_of.items() if t}
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        ratio = [x**mid / x for x in p.values()]
        lo, hi = (lo, mid) if max(ratio) / min(ratio) <= mixing.MAX_REPETITION else (mid, hi)
    w = {s: x**hi for s, x in p.items()}
    assert {r.source: round(r.weight, 9) for r in plan} == {s: round(x / sum(w.values()), 9) for s, x in w.items()}
    assert {r.doc_id for r in uses} == {r[0] for r in rows}
    for r in plan:
        mine = sorted((u for u in uses if u.source == r.source), key=lambda u: u.start)
        at = 0
        for u in mine:
            assert u.start == at
            at += u.n_tokens
        assert r.budget <= at < r.budget + 8 and mine[-1].start < r.budget
        by_epoch = Counter((u.epoch, u.doc_id) for u in mine)
        assert max(by_epoch.values()) == 1


def test_entropy_target(spark):
    rows = [(i, "a b c", "x" if i < 80 else "y" if i < 95 else "z") for i in range(100)]
    plan, _ = mixed(spark, rows, target_entropy=0.9)
    w = [r.weight for r in plan]
    assert abs(-sum(x * math.log(x) for x in w) - 0.9) < 1e-9
    plan, uses = mixed(spark, rows, target_entropy=0.1, budget=60)
    assert {r.exponent for r in plan} == {1.0} and sum(r.budget for r in plan) == 60 and sum(u.n_tokens for u in uses) <= 66


def test_exponent_with_a_budget_and_many_sources(spark):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 200}") for i in range(900)]
    tokens_of = Counter()
    for _, t, s in rows:
        tokens_of[s] += len(t.split())
    total = sum(tokens_of.values())
    plan, _ = mixed(spark, rows, budget=total, max_repetition=1.2)
    weight = lambda a: {s: (t / total) ** a / sum((x / total) ** a for x in tokens_of.values()) for s, t in tokens_of.items()}
    most = lambda a: max(weight(a)[s] * total / t for s, t in tokens_of.items())
    (a,) = {r.exponent for r in plan}
    assert 0 < a < 1 and most(a) <= 1.2 + 1e-9 < most(a - 1e-6)
    assert all(abs(r.weight - weight(a)[r.source]) < 1e-12 for r in plan) and len(plan) == 200


def test_mixing_of_odd_rows(spark):
    from shotlake.llm.common import materialise

    rows = mixing.counted(documents(spark, *ODD))
    uses = materialise(mixing.positions(rows, mixing.weights(rows)), "uses").collect()
    assert Counter((r.doc_id, r.n_tokens) for r in uses) == Counter((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t in ODD)
    assert all(r.source == "s" and r.epoch == 0 for r in uses)
    none = mixing.counted(documents(spark))
    assert mixing.weights(none).count() == 0 and mixing.positions(none, mixing.weights(none)).count() == 0


def test_mix_repeats_rows_like_positions(spark):
    rows = [(i, "w " * (1 + i % 5), f"s{i % 3 if i < 30 else 0}") for i in range(60)] + [(None, "a b", None), (70, None, "none")]
    docs = documents(spark, *rows)
    _, uses = mixed(spark, rows)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter(u.doc_id for u in uses)
    assert mixing.mix(docs.limit(0)).count() == 0


# --- secrets

PATTERNS = [("assign", re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 1, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]
RANDOM = "kJ8vQ2mZx7Lp0RtY5nWc3BdF6hGs9aEu"


def test_base_spans_against_python(spark):
    texts = ["token = abcdef", "token:abc token=abcdefg", "api_key=token : abcdefgh", "PassWord\" : 'xx+/=.-_y'", "AKIA" + "A" * 16, "AKIA" + "B" * 15, "x" + "0123456789abcdef" * 2 + "AKIA" + "0" * 20, "😀é secret=😀 secret=abcdef😀", "apikey=a.b.c.d.e api__key=aaaaaaa", "", None, "tokentoken==========", "a" * 5000]
    rows = secret_scan.scan(documents(spark, *enumerate(texts))).select("record.doc_id", secret_scan.written(F.col("spans"), ["assign", "access", "hex"]).alias("s")).collect()
    for r in rows:
        t = texts[r.doc_id] or ""
        spans = sorted((m.start(), k, n, m.end()) for k, (n, p, g, least) in enumerate(PATTERNS) for m in p.finditer(t) if len(m.group(g)) >= least)
        assert r.s == ",".join(f"{n}:{a}:{b}" for a, _, n, b in spans), t


def test_entropy_against_brute_force(spark):
    rng = random.Random(4)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = [RANDOM, "a1" * 20, "x " + RANDOM + "a" * 30, "DEADBEEF0123456789ABCDEF01", "thelongestwordwithoutanydigit", RANDOM + "example"]
    texts += ["".join(rng.choice(alphabet[: rng.choice([6, 20, 64])]) for _ in range(rng.randint(20, 70))) for _ in range(25)]
    rows = secret_scan.scan(documents(spark, *enumerate(texts))).select("record.doc_id", F.filter("spans", lambda s: s["kind"].startswith("entropy")).alias("s"), F.filter("spans", lambda s: ~s["kind"].startswith("entropy")).alias("b")).collect()
    n = secret_scan.WINDOW
    for r in rows:
        want = []
        for kind, pattern, _, fold, bits in secret_scan.CLASSES:
            for m in re.finditer(pattern, texts[r.doc_id]):
                t = m.group()
                if any(re.search(a, t) for a in secret_scan.ALLOWED) or (not fold and re.fullmatch("[0-9A-Fa-f]*", t)):
                    continue
                t = t.lower() if fold else t
                high = [i for i in range(len(t) - n + 1) if -sum(c / n * math.log2(c / n) for c in Counter(t[i : i + n]).values()) >= bits - 1e-12]
                if high:
                    want.append((m.start() + high[0], kind, m.start() + high[-1] + n))
        want = [x for x in want if not any(b.start <= x[0] and x[2] <= b.end for b in r.b)]
        assert [(s.start, s.kind, s.end) for s in r.s] == sorted(want, key=lambda x: (x[0], secret_scan.KINDS.index(x[1])))


def test_placeholders_excuse_only_their_piece(spark):
    key = "kJ8vQ2mZx7Lp0RtY5nWc3BdF6hGs9aEu"
    texts = [f"/sample/{key}", f"example_key={key}", f"{key}/xxxx", f"{key}example", "/sample/" + "example" + key, "/sample9/ThisIsSomeLongNameWithoutAnyOfThem"]
    rows = secret_scan.scan(documents(spark, *enumerate(texts))).select("record.doc_id", "spans").collect()
    for r in rows:
        at = texts[r.doc_id].index(key) if r.doc_id < 5 else 0
        assert any(s.start <= at and at + len(key) <= s.end for s in r.spans) == (r.doc_id < 3), texts[r.doc_id]
        assert r.doc_id < 3 or not r.spans


def base_spans(text):
    return sorted((m.start(), k, n, m.end()) for k, (n, p, g, least) in enumerate(PATTERNS) for m in p.finditer(text) if len(m.group(g)) >= least)


def sql_rows(name, sf):
    import duckdb

    from shotlake.llm.queries import ORACLE_SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    return con.execute(ORACLE_SQL[name]).df()


def test_secrets_query_against_sql_and_python(spark):
    from shotlake.llm.queries import op9_secrets

    sf = SF.replace("0.001", "0.01")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = op9_secrets(spark, sf).collect()
    want = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in sql_rows("op9_secrets", sf).itertuples()}
    assert {r.doc_id: tuple(r)[1:] for r in rows} == want and set(want) == set(texts) and sum(r.n_assign + r.n_access + r.n_hex for r in rows) > 3
    for r in rows:
        base = base_spans(texts[r.doc_id])
        written = [f"{n}:{a}:{b}" for a, _, n, b in base]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(n == k for _, _, n, _ in base) for k in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()


def test_mixing_query_against_sql(spark):
    from shotlake.llm.queries import op8_mixing

    rows = op8_mixing(spark, SF).toPandas()
    want = sql_rows("op8_mixing", SF)
    columns = sorted(want.columns)
    assert sorted(rows.columns) == columns and len(rows) == len(want) > 100
    key = ["source", "start", "doc_id", "epoch"]
    assert (rows.sort_values(key)[columns].reset_index(drop=True) == want.sort_values(key)[columns].reset_index(drop=True)).all().all()


def test_secrets_of_long_texts_and_odd_rows(spark):
    rng = random.Random(6)
    texts = ["deed face cafe babble " * 15_000, "token=abcdefg " * 15_000, ("0123456789abcdef" * 2 + " ") * 6_000, " ".join("".join(rng.choice("ghijKLMNop0123456789+/QRS") for _ in range(32)) for _ in range(3_000))]
    rows = [(None, t + " AKIA" + "A" * 16) for t in texts] + ODD
    docs = documents(spark, *rows)
    got = secret_scan.scan(docs).select("record.text", F.filter("spans", lambda s: s["rank"] < 3).alias("s"), F.size("spans").alias("n")).collect()
    assert Counter(r.text for r in got) == Counter(t for _, t in rows)
    for r in got:
        assert [(s.start, s.rank, s.kind, s.end) for s in r.s] == base_spans(r.text or "")
    assert max(r.n for r in got) > 15_000 and sum(r.n for r in got if r.text and r.text.endswith("AAAA") and "+" in r.text) > 1_000
    for r in secret_scan.redact(docs).where("text like '%SECRET%'").collect():
        assert r.n_chars == len(r.text) and not base_spans(r.text)
    assert secret_scan.scan(documents(spark)).count() == 0


def test_redaction(spark):
    docs = documents(spark, (1, "😀 token=abcdefg then AKIA" + "A" * 20 + "!"), (2, "clean"), (3, None), (4, f"key {RANDOM} end"))
    rows = {r.doc_id: r for r in secret_scan.redact(docs).collect()}
    assert rows[1].text == "😀 [SECRET] then [SECRET]!" and rows[1].n_chars == len(rows[1].text)
    assert rows[2].text == "clean" and rows[3].text is None and rows[4].text == "key [SECRET] end" and rows[4].spans == "x"
    assert secret_scan.redact(docs).columns == docs.columns and secret_scan.redact(docs.limit(0)).count() == 0


# --- sharding

def test_shards_hold_all_rows_without_gaps(spark):
    rows = [(i, f"text {i}") for i in range(300)] + ODD
    docs = documents(spark, *rows)
    out = sharding.shuffle_shards(docs, shards=8, bucket_bytes=200).collect()
    assert Counter((r.record.doc_id, r.record.text) for r in out) == Counter(rows)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append((r.slot, r.record.doc_id))
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in slots.values()) and len(slots) == 8
    assert any([d for _, d in sorted(v)] != sorted(d for _, d in v if d is not None) for v in slots.values())
    again = sharding.shuffle_shards(docs.repartition(7), shards=8, bucket_bytes=200).collect()
    assert Counter((r.shard, r.slot, r.record.doc_id, r.record.text) for r in out) == Counter((r.shard, r.slot, r.record.doc_id, r.record.text) for r in again)
    assert sharding.shuffle_shards(docs.limit(0)).count() == 0


def test_fisher_yates_is_uniform_and_a_permutation(spark):
    df = spark.range(6000).select(sharding.fisher_yates(F.lit(3), F.lit(1), "id").alias("p"), sharding.fisher_yates(F.col("id").cast("int") % 40, F.lit(2), "id").alias("q"), "id")
    rows = df.collect()
    assert all(sorted(r.q) == list(range(r.id % 40)) for r in rows)
    assert all(850 < n < 1150 for n in Counter(tuple(r.p) for r in rows).values()) and len({tuple(r.p) for r in rows}) == 6


def test_rows_without_ids_spread_over_buckets(spark):
    docs = documents(spark, *[(None if i % 3 else 5, f"text {i}") for i in range(600)])
    parts = sharding.planned(docs, "doc_id", 4, 1, bucket_rows=10)
    assert parts == [20, 40, 1, 1]  # of the two shards that hold rows
    sizes = sharding.spread(docs, "doc_id", 4, 1, parts).groupBy("shard", "part").count().collect()
    assert max(r["count"] for r in sizes) < 30 and sum(r["count"] for r in sizes) == 600
    out = sharding.shuffle_shards(docs, shards=4, bucket_rows=10).collect()
    assert len({r.record.text for r in out}) == 600 and len({(r.shard, r.slot) for r in out}) == 600


def test_rows_equal_in_every_column_spread_over_buckets(spark):
    rows = spark.range(30_000).selectExpr("7L AS doc_id", "'the same text' AS text", "map('a', 1) AS m")
    rows = rows.unionByName(spark.range(500).selectExpr("id + 100 AS doc_id", "'other' AS text", "map('a', CAST(id AS INT)) AS m"))
    seen = []
    for n in (3, 5):
        began = time.time()
        got = sharding.shuffle_shards(rows.repartition(n), shards=4, bucket_rows=256).select("shard", "slot", "record.doc_id", F.col("record.m")["a"].alias("a"))
        seen.append(sorted(map(tuple, got.collect())))
        assert time.time() - began < 60
    assert seen[0] == seen[1] and len(seen[0]) == 30_500
    for shard in {r[0] for r in seen[0]}:
        assert [r[1] for r in seen[0] if r[0] == shard] == list(range(sum(r[0] == shard for r in seen[0])))
    # every bucket of the shard is near its size
    shards = sharding.planned(rows, "doc_id", 4, bucket_rows=256)
    dealt = sharding.spread(rows, "doc_id", 4, sharding.SEED, shards, 256)
    assert dealt.groupBy("shard", "part").count().agg(F.max("count")).first()[0] < 400


def test_sharding_query_against_python(spark):
    from shotlake.llm.queries import op10_sharding

    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = op10_sharding(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        assert (r["size"], r.text_crc32, r.law) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id]), "key")
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows))) for s in range(40))


def test_one_more_shard_takes_rows_only_into_itself(spark):
    df = spark.range(2000).select(sharding.shard_of(F.col("id"), 10).alias("a"), sharding.shard_of(F.col("id"), 11).alias("b"))
    moved = df.where("a <> b").collect()
    assert {r.b for r in moved} == {10} and 100 < len(moved) < 270


def test_written_shards(spark, tmp_path):
    docs = documents(spark, *[(i, f"x{i}") for i in range(300)])
    sharding.write_shards(docs, str(tmp_path / "out"), files=3, shards=4, bucket_rows=20)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 300 and {r[0] for r in back.select("shard").distinct().collect()} == set(range(4)) and "record_shard" in back.columns
    want = defaultdict(list)
    for r in sorted(sharding.shuffle_shards(docs, shards=4, bucket_rows=20).collect(), key=lambda r: (r.shard, r.slot)):
        want[r.shard].append(r.record.doc_id)
    import pyarrow.parquet as pq

    for k in range(4):
        files = sorted((tmp_path / "out" / f"shard={k}").glob("*.parquet"))
        assert len(files) > 1 and [i for f in files for i in pq.ParquetFile(f).read(["doc_id"])["doc_id"].to_pylist()] == want[k]


# --- fitted models against fits of another kind

def optimum(x, y, penalty=1e-4, rounds=60):
    """Weights and bias by Newton's method, where linear.fit takes gradient steps."""
    z = np.concatenate([x, np.ones((len(x), 1))], 1)
    ridge = np.full(z.shape[1], penalty)
    ridge[-1] = 1e-12
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        g = z.T @ (p - y) / len(y) + ridge * w * (ridge > 1e-9)
        h = (z * (p * (1 - p))[:, None]).T @ z / len(y) + np.diag(ridge)
        w = w - np.linalg.solve(h + 1e-9 * np.eye(len(w)), g)
    return w


def loss(x, y, w):
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -40, 40))), 1e-12, 1 - 1e-12)
    return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean() + 0.5e-4 * (w[:-1] ** 2).sum()


def test_linear_fit_against_newton():
    from shotlake.llm.linear import Sparse, fit

    rng = np.random.default_rng(4)
    x = (rng.random((800, 12)) < 0.3).astype(float)
    y = (rng.random(800) < 1 / (1 + np.exp(-(x @ rng.normal(size=12) * 2 - 0.5)))).astype(float)
    w = fit(Sparse([np.flatnonzero(r) for r in x], None, 12), np.zeros((800, 0)), y, rounds=150, rate=0.2)
    best = optimum(x, y)
    assert loss(x, y, best) - 1e-9 <= loss(x, y, w) <= loss(x, y, best) + 0.003
    assert np.abs(1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) - 1 / (1 + np.exp(-(x @ best[:-1] + best[-1])))).max() < 0.08


def test_chain_against_newton_on_the_given_labels(spark):
    """The query's chain, from given labels, against one whose models Newton's method fits on the same columns and folds."""
    sf = SF.replace("0.001", "0.01")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    truth = sorted((r.doc_id, float(r.toxic > 0)) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in texts and r.toxic is not None)
    chain = toxicity.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    features = [np.array(sorted({h for w in toxicity.words_of(texts[i]) for h in toxicity.hashed(w)})) for i, _ in truth]
    x = np.zeros((len(truth), len(chain.place)))
    for k, f in enumerate(features):
        x[k, [chain.place[h] for h in f.tolist() if h in chain.place]] = 1
    y = np.array([t for _, t in truth])
    kinds, fold, dense = toxicity.kinds_of(features, y), np.arange(len(y)) % toxicity.FOLDS, np.zeros((len(y), 0))
    assert np.array_equal(kinds.sum(1), y)
    for target in (*kinds.T, y):
        z, out = np.concatenate([x, dense], 1), np.zeros(len(y))
        for f in range(toxicity.FOLDS):
            w = optimum(z[fold != f], target[fold != f], penalty=1e-3, rounds=25)
            out[fold == f] = 1 / (1 + np.exp(-np.clip(z[fold == f] @ w[:-1] + w[-1], -40, 40)))
        dense = np.concatenate([dense, out[:, None]], 1)
    ours = chain.predict([np.flatnonzero(r) for r in x])[:, -1] >= toxicity.THRESHOLD
    assert ((dense[:, -1] >= 0.5) == ours).mean() > 0.95 and (ours == (y > 0)).mean() > 0.95


def test_em_against_plain_steps():
    """Expectation and maximisation row by row, in probabilities instead of logarithms and patterns."""
    rng = random.Random(3)
    cast = ["".join(rng.choices("gba", [6, 1, 3] if rng.random() < 0.8 else [2, 6, 2])[0] for _ in quality.LABELLERS) for _ in range(400)]
    count = Counter(cast)
    patterns = sorted(count)
    share, table, post = quality.accuracies(patterns, np.array([count[p] for p in patterns], float), rounds=7)
    belief = [0.1 if "b" in p else 0.9 if "g" in p else 0.5 for p in cast]
    for _ in range(7):
        good = (sum(belief) + 1) / (len(cast) + 2)
        rates = []
        for j in range(len(quality.LABELLERS)):
            rates.append([])
            for own in (lambda b: b, lambda b: 1 - b):
                hit = {v: 1 + sum(own(b) for b, p in zip(belief, cast) if p[j] == v) for v in "gb"}
                rates[-1].append({v: n / sum(hit.values()) for v, n in hit.items()} | {"a": 1.0})
        belief = []
        for p in cast:
            a, b = good * math.prod(r[0][v] for r, v in zip(rates, p)), (1 - good) * math.prod(r[1][v] for r, v in zip(rates, p))
            belief.append(a / (a + b))
    assert abs(share - good) < 1e-12
    assert max(abs(dict(zip(patterns, post))[p] - b) for p, b in zip(cast, belief)) < 1e-9
    assert max(abs(table[j, c, "gb".index(v)] - rates[j][c][v]) for j in range(len(rates)) for c in (0, 1) for v in "gb") < 1e-12
