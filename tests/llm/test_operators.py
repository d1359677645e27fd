"""Every operator against its plain version on the smallest given tables."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from episodica.llm import gru
from episodica.llm.anchors import anchors_of, sliding_minimum
from episodica.llm.components import components
from episodica.llm.decontaminate import FMIndex, Wavelet, suffix_array
from episodica.llm.near_duplicates import band_keys, estimate, registers
from episodica.llm.queries import QUERIES
from episodica.llm.words import byte_hashes

SF = "/root/testdata/sf0.001"


def result(spark, name):
    return QUERIES[name](spark, SF).toPandas()


def test_secrets(spark, texts):
    got = result(spark, "op1_secret_scan").set_index("doc_id")
    for i, text in texts.items():
        r = got.loc[i]
        assert ([r.n_assign, r.n_access, r.n_hex], r.base_sha256) == brute.secrets(text)


def test_novel_secrets(spark):
    from episodica.llm.secrets import scan_secrets

    plain = "the client sends bearer {} with each call to the server and the server answers the client"
    rows = [(k, plain.format("connection12connection12connection12")) for k in range(5)] + [(9, plain.format("qZ7xP0vL2mK9wR4tB8nY3c"))]
    got = {r.doc.k: r for r in scan_secrets(spark.createDataFrame(rows, "k long, text string"), ["k"]).collect()}
    start = plain.index("{}")
    assert got[9].spans == f"novel:{start}:{start + 22}" and got[9].n_novel == 1
    assert all(got[k].spans == "" for k in range(5))


def test_novel_secrets_near_each_other(spark):
    """Four new secrets in one block, and pairs of neighbours in copies and in different texts: none is known from the others."""
    from episodica.llm.secrets import scan_secrets

    rng = np.random.default_rng(8)
    make = lambda: "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"), 22)) + "A7"
    values = [make() for _ in range(8)]
    block = "\n".join(f"{name}: {value}" for name, value in zip(("db_login", "mail_auth", "session_key", "signature"), values, strict=False))
    pair = f"the login {values[4]} and the session {values[5]} are kept"
    again = f"bearer {values[6]} or access {values[7]}"
    rows = [(0, block)] + [(k, pair) for k in range(1, 5)] + [(k, f"{make()} text {again} number {make()}") for k in range(5, 9)]
    got = {r.doc.k: r for r in scan_secrets(spark.createDataFrame(rows, "k long, text string"), ["k"]).collect()}
    for k, text in rows:
        want = [(text.index(v), text.index(v) + 24) for v in values if v in text]
        assert [(f.start, f.stop) for f in got[k].found if f.kind == "novel"] == want and got[k].n_novel == len(want)


def test_words_around_secrets_count_by_stretch():
    from episodica.llm.secrets import sensitive_strings

    text = "name one key: abcdefghijk1 name two key: abcdefghijk2 " + "x " * 400 + "password=hunter2hunter2 key: abcdefghijk3 end"
    found, stretches = sensitive_strings(text, [(text.index("password"), 0, text.index(" key: abcdefghijk3"))])
    assert [text[s:e] for s, e, _ in found] == ["abcdefghijk1", "abcdefghijk2", "abcdefghijk3"]
    assert len(stretches) == 2 and stretches[0].startswith("name one key:   name two key:   x x") and stretches[1].endswith("x   key:   end")
    assert not any(w in near for _, _, near in found for w in (b"abcdefghijk", b"hunter2"))


def test_mixture(spark, documents):
    got = result(spark, "op2_mixture")
    assert (got.taken <= 2 * got["size"]).all() and (got.taken >= 0).all()
    by = got.groupby("source").agg(size=("size", "sum"), stated=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (by["size"] == by.stated).all() and (by.target <= 2 * by["size"] + 1e-6).all()
    assert abs(by.target.sum() - 1.5 * by["size"].sum()) < 1e-6 * by["size"].sum()
    assert (abs(by.taken - by.target) <= 0.5).all()
    again = QUERIES["op2_mixture"](spark, SF).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))


def test_near_duplicates(spark, texts):
    got = result(spark, "op3_near_duplicates").set_index("doc_id")
    for i, (size, group) in brute.near_duplicates(texts).items():
        r = got.loc[i]
        assert (r.n_shingles, r.component_id, r.kept) == (size, group, group == i)


def test_near_duplicate_chains(spark):
    """A group whose ends share less than the limit, and copies that share a band but no link."""
    rng = np.random.default_rng(3)
    text = [f"w{k}" for k in rng.integers(0, 10**6, 400)]
    texts = {}
    for i in range(60):
        texts[i] = " ".join(text)
        text = list(text)
        for k in rng.integers(0, 400, 4):
            text[k] = f"v{rng.integers(0, 10**6)}"
    for i in range(60, 100):
        other = list(text)
        for k in rng.choice(400, 16, replace=False):
            other[k] = f"u{rng.integers(0, 10**6)}"
        texts[i] = " ".join(other)
    from episodica.llm.near_duplicates import find_near_duplicates

    got = find_near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(texts)


def test_registers_estimate_similarity():
    rng = np.random.default_rng(1)
    for n, shared in ((30, 24), (1000, 800), (20000, 15000)):
        pool = rng.integers(0, 2**63, 2 * n - shared).astype(np.uint64)
        a, b = np.sort(pool[:n]), np.sort(pool[n - shared :])
        got = estimate(band_keys(a)[None], band_keys(b)[None], np.array([n]), np.array([n]))[0]
        assert abs(got - shared / (2 * n - shared)) < 0.2
    assert (registers(a) > 0).all()


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 200)]
    got = {r.id: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)}


def test_neighbours(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    vectors, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    got = result(spark, "op4_neighbours").sort_values(["query_id", "rank"])
    shares = []
    for q in np.flatnonzero(ids % 20 == 0):
        scores = (vectors * vectors[q]).sum(axis=1)
        scores[q] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        mine = got[got.query_id == ids[q]]
        assert mine["rank"].tolist() == list(range(1, 21)) and (np.diff(mine.score) <= 0).all()
        assert np.allclose(mine.score, scores[np.searchsorted(ids, mine.vec_id)])
        shares.append(len(set(best) & set(mine.vec_id)) / 20)
    assert np.mean(shares) >= 0.9


def test_neighbours_odd_vectors(spark):
    from episodica.llm.neighbours import nearest

    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [3.0, 0.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0]), (5, None), (40, [float("nan"), 1.0]), (6, [1.0, None]), (7, [1.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest(frame, F.col("vec_id") % 20 == 0, k=3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 2, 3.0), (0, 2, 1, 1.0), (0, 3, 3, 1.0), (20, 1, 1, 2.0), (20, 2, 3, 2.0), (20, 3, 0, 0.0)]
    assert nearest(frame.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(frame.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_quality(spark):
    small = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    got = QUERIES["op5_quality"](spark, "/root/testdata/sf0.01").toPandas().merge(small, on="doc_id")
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    held = got[got.held_out]
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.85 and (held.predicted == held.quality).mean() > 0.9


def test_contamination(spark, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = result(spark, "op6_decontamination").set_index("doc_id")
    for i, want in brute.contamination(texts, items).items():
        assert tuple(got.loc[i]) == want


def test_contamination_short_items_and_blocks(spark):
    from episodica.llm.decontaminate import find_contamination

    rng = np.random.default_rng(2)
    vocabulary = [f"w{k}" for k in range(12)]
    make = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(f"i{k}", make(int(n))) for k, n in enumerate(rng.integers(0, 20, 40))] + [("x", None), (None, make(3)), ("i1", make(4)), ("one", "w1")]
    texts = {k: make(int(n)) for k, n in enumerate(rng.integers(0, 300, 50))}
    texts[7] = texts[7] + " unknown " + (items[3][1] or "")
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    want = brute.contamination(texts, items)
    for size in (1 << 20, 200):
        got = find_contamination(docs, benchmark, ["doc_id"], block_bytes=size).collect()
        assert {r.doc.doc_id: tuple(r)[1:6] for r in got} == want


def test_fm_index():
    rng = np.random.default_rng(0)
    text = np.append(rng.integers(1, 5, 400), 0)
    assert [tuple(text[i:]) for i in suffix_array(text)] == sorted(tuple(text[i:]) for i in range(len(text)))
    wavelet = Wavelet(text, 5)
    assert (wavelet.access(np.arange(len(text))) == text).all()
    assert all(wavelet.rank(np.array([c]), np.array([k]))[0] == (text[:k] == c).sum() for c in range(5) for k in (0, 17, 401))
    patterns = rng.integers(1, 5, (30, 4))
    lengths = rng.integers(1, 5, 30)
    window, start = FMIndex(text, 5).search(patterns, lengths)
    found = sorted(zip(window.tolist(), start.tolist(), strict=True))
    assert found == sorted((w, k) for w in range(30) for k in range(400) if text[k : k + lengths[w]].tolist() == patterns[w, : lengths[w]].tolist())


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_repeated_strings(spark, documents, texts, batches):
    from episodica.llm.substrings import remove_repeated_strings

    got = remove_repeated_strings(documents.repartition(9), batches=batches).toPandas().set_index("doc_id")
    for i, want in brute.repeated_strings(texts).items():
        r = got.loc[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want


def test_repeated_strings_made_up(spark):
    """Repeats of 199, 200 and 201 bytes, periodic texts, repeats within a text and at its ends."""
    from episodica.llm.substrings import remove_repeated_strings

    rng = np.random.default_rng(4)
    make = lambda n: "".join(rng.choice(list("abcdefgh ijklé"), n))
    p = [make(n) for n in (150, 199, 200, 201, 260, 500)]
    ascii_only = [x.replace("é", "e") for x in p]
    texts = {k: make(100) + x + make(100) for k, x in enumerate(ascii_only)} | {10 + k: make(30) + x for k, x in enumerate(ascii_only)}
    texts |= {20: "ab" * 300, 21: "x" * 199, 22: "x" * 200, 23: "y" * 201, 24: p[4] + make(10) + p[4], 25: p[5][:300] + make(250) + p[5][200:], 26: None, 27: "", 28: p[2], 29: p[2]}
    got = remove_repeated_strings(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute.repeated_strings(texts)


def test_anchors():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 50, 300)
    assert (sliding_minimum(values, 37) == [values[k : k + 37].min() for k in range(264)]).all()
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    data[3000:3400] = data[100:500]
    at, heads, begins = anchors_of(byte_hashes(data), 0, len(data))
    of = np.repeat(np.arange(len(at)), np.diff(begins))
    assert len(of) == 4801 and all(0 <= at[of[k]] - k <= 136 for k in range(len(of)))
    assert all(at[of[100 + k]] - 100 == at[of[3000 + k]] - 3000 for k in range(201))


def test_personal_data(spark, texts):
    got = result(spark, "op8_personal_data").set_index("doc_id")
    for i, text in texts.items():
        r = got.loc[i]
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == brute.personal(text)


def test_personal_data_made_up(spark):
    from episodica.llm.pii import find_personal_data, sanitised

    texts = dict(enumerate([
        "é a@b.c_d@e.f 1.2.3.4.5.6.7.8 x@y 300.1.1.1", "4" * 5000 + " 4111 1111 1111 1111 4111-1111-1111-1111", "+1 (555) 123-4567. +49 30 1234",
        "a" * 100000 + "@b.c", "1 " * 30000, "001.002.003.004 1.2.3.999 x1.2.3.4", "1" * 100000 + ".1.1.1", "+" * 50 + "1 22333444555", None, "",
    ]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in find_personal_data(docs, ["doc_id"]).withColumn("clean", sanitised(F.col("doc.doc_id").cast("string"), F.array().cast("array<struct<start:int,kind:int,stop:int>>"))).collect():
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == brute.personal(texts[r.doc.doc_id])
    out = spark.createDataFrame([("x a@b.c mail",)], "t string").select(sanitised(F.col("t"), F.expr("array(named_struct('start', 2, 'kind', 0, 'stop', 7))")).alias("o"))
    assert out.first().o == "x [email] mail"


def test_terms_that_give_entities_away(spark):
    from episodica.llm.pii import find_personal_data

    rows = [(k, f"call number {k} from zanzibar harbour to boss@firm.example about paper") for k in range(6)]
    rows += [(100 + k, f"call number {k} to person{k}@other.example about paper") for k in range(1000)]
    rows += [(2000 + k, rows[0][1]) for k in range(5)]
    got = {r.doc.doc_id: r for r in find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    assert [s.split(":")[0] for s in got[0].spans.split(",")] == ["term", "term", "term", "email"] and got[0].n_term == 3
    text = rows[0][1]
    assert got[0].spans.startswith(f"term:{text.index('from')}:{text.index(' zanzibar')},term:{text.index('zanzibar')}:{text.index(' harbour')},term:")
    assert all(got[100 + k].n_term == 0 for k in range(1000))


def test_terms_in_copied_passages(spark):
    """Hundreds of copies of one passage, as texts and inside different texts, neither hide a term nor give away a common word."""
    from episodica.llm.pii import find_personal_data

    window = "call number {} from zanzibar harbour to boss@firm.example about paper"
    rows = [(k, window.format(k)) for k in range(3)]
    rows += [(100 + k, window.format(0)) for k in range(300)]
    rows += [(1000 + k, f"{k} is the first. " + "so it goes on, " * 12 + window.format(1) + " and so it ends" * 12 + f" with {k}") for k in range(300)]
    rows += [(2000 + k, f"call number {k} to person{k}@other.example about paper") for k in range(1000)]
    got = {r.doc.doc_id: r for r in find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    for k, text in rows[:603]:
        terms = [text[f.start : f.stop] for f in got[k].found if f.kind == 4]
        assert {"from", "zanzibar", "harbour"} <= set(terms) and not {"call", "number", "about", "paper"} & set(terms)
    assert all(got[2000 + k].n_term == 0 for k in range(1000))


def test_surroundings_of_terms(spark):
    from episodica.llm.pii import surroundings_of_terms

    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(list("ab é\n1"), 3000)) + " word " * n for n in (0, 90, 200)] + [None, ""]
    texts += texts[:1]
    words = {w for t in texts if t for w in re.findall("[^\\W\\d_]{4,}", t)}
    want = {(w, t[max(0, m.start() - 80) : m.end() + 80]) for t in texts if t for m in re.finditer("[^\\W\\d_]{4,}", t) for w in [m.group()] if w != "aaaa"}
    terms = spark.createDataFrame([(w,) for w in words - {"aaaa"}], "term string")
    found = surroundings_of_terms(spark.createDataFrame([(t,) for t in texts], "t string"), "t", terms, 80).distinct().groupBy("term").count().collect()
    assert {r.term: r["count"] for r in found} == dict(Counter(w for w, _ in want))


def test_language(spark):
    want = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "n_chars").toPandas()
    got = QUERIES["op9_language"](spark, "/root/testdata/sf0.01").toPandas().merge(want, on="doc_id")
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97 and got.rejected.mean() < 0.02 and got.score.between(0, 1).all()


def test_lm_scores(spark, texts):
    got = result(spark, "op10_lm_score").set_index("doc_id")
    check_base(got, texts)
    from episodica.llm.lm import score_texts

    rare = score_texts(spark.read.parquet(f"{SF}/documents.parquet"), table_words=700).toPandas().set_index("doc_id")
    check_base(rare, texts)


def check_base(got, texts):
    for i, (n, known, total, base) in brute.token_scores(texts).items():
        r = got.loc[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and abs(r.base_score - base) < 1e-6 * abs(base)
        assert r.score < 0


def test_lm_learns(spark):
    got = QUERIES["op10_lm_score"](spark, "/root/testdata/sf0.01").toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_gru_gradient_and_lanes():
    rng = np.random.default_rng(0)
    flat = (rng.standard_normal(gru.SIZE) * 0.3).astype(np.float32)
    x = rng.integers(0, gru.SYMBOLS, (6, 3))
    keep = np.ones((6, 3), np.float32)
    keep[3, 1] = 0
    h = rng.standard_normal((3, gru.HIDDEN)).astype(np.float32)
    _, gradient, _ = gru.window_gradient(gru.unpack(flat), x, keep, np.ones((6, 3), np.float32), h)

    def loss(weights):
        p = gru.unpack(weights)
        states, _ = gru.forward(p, x, keep, h)
        return -gru.log_probabilities(p, states.reshape(-1, gru.HIDDEN).astype(np.float64), x.reshape(-1)).sum()

    for i in rng.choice(np.flatnonzero(np.abs(gradient) > 0.01), 60):
        up, down = flat.astype(np.float64), flat.astype(np.float64)
        up[i] += 1e-2
        down[i] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - gradient[i]) < 1e-2 * (abs(gradient[i]) + 0.1)
    lengths = np.append(rng.integers(0, 90, 200), 3000)
    first = np.append(0, np.cumsum(lengths))
    symbols = rng.integers(0, gru.SYMBOLS, first[-1])
    got = gru.score(flat, symbols, first)
    for k in (0, 5, 200):
        states, _ = gru.forward(gru.unpack(flat), symbols[first[k] : first[k + 1], None], np.ones((lengths[k], 1), np.float32), np.zeros((1, gru.HIDDEN), np.float32))
        assert abs(got[k] - gru.log_probabilities(gru.unpack(flat), states[:, 0], symbols[first[k] : first[k + 1]]).sum()) < 1e-2
    counts = np.arange(gru.SYMBOLS) + 1.0
    p = gru.unpack(gru.untrained(counts))
    found = np.exp(gru.log_probabilities(p, np.zeros((gru.SYMBOLS, gru.HIDDEN), np.float32), np.arange(gru.SYMBOLS)))
    assert abs(found.sum() - 1) < 1e-3 and np.allclose(found, (counts + 0.1) / (counts + 0.1).sum(), rtol=1e-3)
