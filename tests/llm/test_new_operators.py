"""Source divergence, hard negatives and SimHash groups against plain versions, and their hard rows."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

import brute
from episodica.llm import simhash
from episodica.llm.divergence import audit_sources, joint_tables
from episodica.llm.hard_negatives import Packing, mine_negatives
from episodica.llm.queries import QUERIES
from episodica.llm.simhash import find_simhash_groups, near_prints

SF = "/root/testdata/sf0.001"
TERMS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def divergence(rows, least=30, top=50):
    """(lang, source, text) rows to the set of result rows."""
    held, counts, groups = collections.Counter(), collections.Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = TERMS.findall((text or "").translate(brute.LOWER))
        groups.add((lang, source))
        held.update((lang, t) for t in set(found))
        counts.update((lang, source, t) for t in found)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), n in held.items() if x == lang and n >= least)
        sources = sorted(s for x, s in groups if x == lang)

        def prices(ns):
            total = sum(ns) + 5 * len(kept)
            return [1 + 10**9 * (n + 5) // total for n in ns]

        own = {s: [counts[lang, s, t] for t in kept] for s in sources}
        price = {s: prices(own[s]) for s in sources}
        whole = prices([sum(own[s][i] for s in sources) for i in range(len(kept))])
        for s in sources:
            far = sorted((-sum(abs(x - y) for x, y in zip(price[s], price[o])), o.encode(), o) for o in sources if o != s)
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(far)]
            up = sorted((q - p, t.encode(), t) for t, n, p, q in zip(kept, own[s], price[s], whole) if n and p > q)
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(up[:top])]
    return sorted(out)


def test_divergence(documents):
    got = QUERIES["op11_source_divergence"](documents.sparkSession, SF).collect()
    want = divergence([(r.lang, r.source, r.text) for r in documents.select("lang", "source", "text").collect()])
    assert sorted(map(tuple, got)) == want and {r.part for r in got} == {"pair", "term"}


def test_divergence_with_one_term_a_block_and_hot_sources(spark):
    """Many small blocks, a source with two thirds of the rows, sources that share no term, and ties."""
    rng = np.random.default_rng(4)
    words = [f"t{chr(97 + k // 26)}{chr(97 + k % 26)}é" for k in range(90)]
    rows = []
    for k in range(300):
        source = "hot" if k % 3 else f"s{k % 7}"
        rows.append(("en" if k % 5 else "fr", source, " ".join(rng.choice(words[:60], 20)) + ", " + "Tail " * (k % 4)))
    rows += [("en", "apart", " ".join(words[60:]))] * 3 + [("xx", "one", "rare"), ("xx", "two", "words")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    for least, per_block in ((3, 1), (3, 64), (30, 1 << 14)):
        assert sorted(map(tuple, audit_sources(docs, least_docs=least, per_block=per_block).collect())) == divergence(rows, least)


def test_joint_tables_over_many_columns(spark):
    """More columns than a strip holds: every cell as counted one by one."""
    rng = np.random.default_rng(2)
    cells = {(int(s), int(t)): int(n) for s, t, n in zip(rng.integers(0, 9, 4000), rng.integers(0, 700, 4000), rng.zipf(1.3, 4000) % 500 + 1)}
    rows = [("en", t % 3, f"t{t}", f"s{s}", n, 10 * n, s) for (s, t), n in cells.items()]
    got = joint_tables(spark.createDataFrame(rows, "lang string, block long, term string, source string, n long, p long, zero long")).collect()
    want = collections.Counter()
    by_term = collections.defaultdict(list)
    for (s, t), n in cells.items():
        by_term[t].append((f"s{s}", n))
    for held in by_term.values():
        held.sort()
        want.update((a, m, b, n) for i, (a, m) in enumerate(held) for b, n in held[i:])
    assert {(r.a, r.m, r.b, r.n): r.terms for r in got} == want
    assert all((r.pa, r.pb, f"s{r.za}", f"s{r.zb}") == (10 * r.m, 10 * r.n, r.a, r.b) for r in got)


def test_divergence_hard_rows(hard, nothing):
    got = sorted(map(tuple, audit_sources(hard, least_docs=1).collect()))
    assert got == divergence([(r.lang, r.source, r.text) for r in hard.collect()], 1)
    bare = audit_sources(hard, least_docs=100).collect()
    assert {(r.part, r.value) for r in bare} == {("pair", 0)} and len(bare) == len([r for r in got if r[2] == "pair"])
    assert audit_sources(nothing).count() == 0


def negatives(rows, every=100, positives=5, few=10, scale=256):
    """(id, vector, label) rows to the list of result rows."""
    use = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        use.append((i, [int(np.floor(scale * x)) for x in v], label))
    lengths = collections.Counter(len(v) for _, v, _ in use)
    use = [r for r in use if len(r[1]) == min(lengths, key=lambda d: (-lengths[d], d))]
    out = []
    for a, v, label in use:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, w, other in use if i != a)
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            hard_ones = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:few]
            out += [(a, i, k + 1, j, -p, -n) for k, (n, j, _) in enumerate(hard_ones)]
    return sorted(out)


def mined(frame, every=100, **settings):
    return sorted(map(tuple, mine_negatives(frame, F.col("vec_id") % every == 0, F.col("label"), **settings).collect()))


SCHEMA = "vec_id long, embedding array<double>, label int"


def test_hard_negatives(spark):
    got = QUERIES["op12_hard_negatives"](spark, SF).collect()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    want = negatives([(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in rows])
    assert sorted(map(tuple, got)) == want and want


def test_hard_negatives_in_blocks_with_hot_labels_and_ties(spark):
    """Several blocks on both sides, a label and a vector with a third of the rows each, and repeated ids."""
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(size=6), 1)], int(rng.integers(0, 4)) if i % 3 else 0) for i in range(900)]
    rows = [(i, [0.5] * 6 if i % 3 == 1 else v, label) for i, v, label in rows] + [(10, [1.0] * 6, 2), (20, [0.5] * 6, 0)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = negatives(rows, 2)
    assert mined(frame, 2, block=1) == want and mined(frame, 2, cells=1) == want and want


def test_hard_negatives_of_wide_numbers(spark):
    """Products that need more than 53 bits are made of integers of any width."""
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) * 10**5 for x in rng.normal(size=5)], i % 3) for i in range(60)]
    assert not Packing(256 * 10**5, 5).plain
    assert mined(spark.createDataFrame(rows, SCHEMA), 10) == negatives(rows, 10)


@pytest.mark.parametrize(("peak", "dimension"), [(1, 1), (118, 64), (3, 500), (1 << 20, 64), (1 << 33, 7), (0, 4)])
def test_packed_products(peak, dimension):
    rng = np.random.default_rng(peak)
    a, c = (rng.integers(-peak, peak + 1, (n, dimension)).astype(np.float64) for n in (7, 45))
    packing = Packing(peak, dimension)
    want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in c] for p in a]
    assert packing.scores(a, packing.packed(c), c).tolist() == want


def test_hard_negatives_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (100, [0.0, 0.0], 1), (None, [1.0, 1.0], 1), (200, None, 1), (300, [1.0, None], 2), (400, [nan, 1.0], 1), (500, [inf, 1.0], 1),
        (600, [1.0, 1.0], None), (700, [1.0], 1), (800, [], 2), (7, [1.0, 0.5], 1), (8, [0.5, 0.2], 2), (9, [0.5, 0.2], 2), (9, [0.5, 0.2], 2), (0, [0.5, 0.5], 2),
        (11, [-1.0, -0.5], 1), (12, [0.0, 0.0], 3), (900, [1e306, 1.0], 1),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, rank string, row int")
    usable = [r for r in rows if r[0] != 900]
    assert mined(frame) == negatives(usable) and negatives(usable)
    for none in ("false", "vec_id = 8", "vec_id in (200, 300)", "vec_id = 800", "vec_id = 0 and label = 1"):
        assert mined(frame.where(none)) == []
    assert mined(spark.createDataFrame([(0, [], 1), (1, [], 1), (2, [], 2)], SCHEMA)) == [(0, 1, 1, 2, 0, 0)]


def fingerprint(text):
    words = brute.words(text)
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, bits=2):
    """(id, fingerprint) to the smallest id that links reach."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, p) in enumerate(prints):
        for j in range(i):
            if (p ^ prints[j][1]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(prints):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(prints))]


def test_simhash_groups(spark, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op13_simhash_groups"](spark, SF).collect()}
    prints = [(i, fingerprint(t)) for i, t in texts.items()]
    assert got == {i: (f"{p:016x}", c) for (i, p), c in zip(prints, groups(prints), strict=True)}


def test_long_texts_in_pieces():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 400):
        text = "  ".join(f"W{k}" for k in rng.integers(0, 50, n)) + " \n" * 40
        for piece in (1, 7, 64, 1 << 20):
            made = [w for words in simhash.word_stretches(text.encode(), piece) for w in zip(*[words[k:] for k in range(3)])] if n > 2 else None
            words = text.lower().encode().split()
            assert made is None or made == list(zip(*[words[k:] for k in range(3)]))
        assert simhash.simhash(text.encode()) == fingerprint(text)


def linked(prints, bits):
    return {(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= bits}


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_near_prints_in_short_and_crowded_lists(spark, bits):
    """Dense clouds around one value (crowded at both levels), loose ones, and the ends of the range."""
    rng = np.random.default_rng(11)
    dense = {0x0123456789ABCDEF ^ int(x) << 16 for x in rng.choice(1 << 16, 700, replace=False)}
    loose = {0x7FFFFFFFFFFFFFFF ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(400)}
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in dense | loose | {0, 1, 3, (1 << 64) - 1, 1 << 63})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    unsigned = {(min(a, b), max(a, b)) for a, b in linked([p % (1 << 64) for p in prints], bits)}
    for longest in (1, 50, 1 << 20):
        got = near_prints(frame, bits, longest, 1 << 10).collect()
        assert {tuple(sorted((r.a % (1 << 64), r.b % (1 << 64)))) for r in got} == unsigned and len(got) == len(unsigned)


def test_simhash_groups_of_very_many_copies(spark):
    """A text with a third of all rows under one id, and chains of small changes."""
    base = " ".join(f"word{k}" for k in range(300))
    rows = [(5, base)] * 400 + [(k, base + f" end{k}") for k in range(6, 500)] + [(k, None if k % 2 else " ") for k in range(500, 800)]
    got = find_simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = {t: fingerprint(t) for t in {t for _, t in rows}}
    distinct = [(min(i for i, t in rows if prints[t] == p), p) for p in sorted(set(prints.values()))]
    want = dict(zip((p for _, p in distinct), groups(distinct), strict=True))
    assert sorted((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got) == sorted((i, prints[t], want[prints[t]]) for i, t in rows)


def test_simhash_hard_rows(hard, nothing):
    rows = [(r.doc_id, fingerprint(r.text)) for r in hard.collect()]
    got = find_simhash_groups(hard).collect()
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got), key=str) == sorted(((i, p, c) for (i, p), c in zip(rows, groups(rows), strict=True)), key=str)
    assert find_simhash_groups(nothing).count() == 0 and find_simhash_groups(hard.where("doc_id is null")).first().component_id is None
    with pytest.raises(ValueError):
        near_prints(nothing, 3)


def test_segments_cover_every_token():
    from episodica.llm.lm import SEGMENT, segments_of

    lengths = [1, 64, 65, 3, 200]
    first = np.append(0, np.cumsum(lengths))
    tokens = np.arange(first[-1]).astype(np.int16)
    rows = segments_of(tokens, first)
    assert rows.shape == (sum(-(-n // SEGMENT) for n in lengths), SEGMENT) and sorted(rows[rows >= 0].tolist()) == tokens.tolist()
    assert [int((r >= 0).sum()) for r in rows] == [1, 64, 64, 1, 3, 64, 64, 64, 8]


def test_language_model_learns_from_all_parts_and_from_nothing(spark):
    """Two kinds of text in different partitions: both are learned, copies or not; without learners the score is defined."""
    from episodica.llm.lm import score_texts

    rows = [(k, ("one two three four " if k % 2 else "red green blue black ") * 40) for k in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = score_texts(frame).collect()
    assert len(got) == 200 and all(r.score > r.base_score + 20 for r in got)
    held = [k for k in range(300) if zlib.crc32(str(k).encode()) % 10 == 0][:3]
    only = score_texts(spark.createDataFrame([(k, "a b c") for k in held], "doc_id long, text string")).collect()
    assert [(r.n_known, r.train_tokens, r.held_out) for r in only] == [(0, 0, True)] * 3 and all(np.isfinite(r.score) and r.score < 0 for r in only)
