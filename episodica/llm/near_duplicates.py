"""Near-duplicate groups: HyperMinHash registers, bands of them, corrected estimates, then full sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.functions.joins import salted_join
from episodica.llm.arrow import annotate
from episodica.llm.components import components, renamed
from episodica.llm.words import SPACED, U, Words, mix, text_words, window_hashes
from episodica.sources.shared import store

WIDTH = 5
BUCKET_BITS, MANTISSA_BITS = 7, 10
BUCKETS = 1 << BUCKET_BITS
BOTTOM = 256
BANDS, PER_BAND = 32, 4  # four registers of 16 bits make one band key of 64
REST = U((1 << (64 - BUCKET_BITS)) - 1)
BUCKET_STARTS = (np.arange(BUCKETS, dtype=np.uint64) << U(64 - BUCKET_BITS))
# each bucket's own order in which it looks for a filled bucket when it is empty itself
PROBES = np.stack([np.argsort(mix(np.arange(BUCKETS, dtype=np.uint64) + U(1000 * (j + 1)))) for j in range(BUCKETS)])


def shingle_sets(words: Words):
    """(row, sorted distinct 64-bit shingles) of every row with words; fewer than five words make one shingle."""
    windows = window_hashes(words.hashes, WIDTH)
    for row in range(words.rows):
        low, high = words.first[row], words.first[row + 1]
        if high - low >= WIDTH:
            yield row, np.unique(windows[low : high - WIDTH + 1])
        elif high > low:
            yield row, window_hashes(words.hashes[low:high], int(high - low))


def fingerprint(members: np.ndarray) -> tuple[int, int]:
    """Two sums over the members: equal for equal sets, in 128 bits."""
    return int(mix(members ^ U(0xA5A5A5A5)).sum().astype(np.int64)), int(mix(members + U(0x5BD1E995)).sum().astype(np.int64))


def registers(members: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set: per bucket the smallest hash as leading zeros and mantissa bits.

    A float64 holds just that of a number: its exponent, then its mantissa.  An empty bucket takes the register
    of the first filled one in its own order (densification), which keeps the chance of agreement at the similarity.
    """
    at = np.searchsorted(members, BUCKET_STARTS)
    filled = np.diff(at, append=len(members)) > 0
    smallest = (members[np.minimum(at, len(members) - 1)] & REST).astype(np.float64)
    out = np.maximum((smallest.view(np.int64) >> (52 - MANTISSA_BITS)) - (1023 << MANTISSA_BITS) + 1, 1).astype(np.uint16)
    if not filled.all():
        empty = np.flatnonzero(~filled)
        out[empty] = out[PROBES[empty, np.argmax(filled[PROBES[empty]], axis=1)]]
    return out


def band_keys(members: np.ndarray) -> np.ndarray:
    return registers(members).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, corrected for registers that agree by chance.

    The least of x hashes in a bucket exceeds t with probability exp(-x t); two unrelated registers agree if they
    have the same number of leading zeros and the same mantissa.
    """
    equal = (a.view(np.uint16) == b.view(np.uint16)).mean(axis=1)
    edges = np.append(2.0 ** -np.arange(64 - BUCKET_BITS), 0.0)
    shares = []
    for size in (n, m):
        over = np.exp(-(size[:, None] / BUCKETS) * edges)
        shares.append(over[:, 1:] - over[:, :-1])
    chance = (shares[0] * shares[1]).sum(axis=1) / (1 << MANTISSA_BITS)
    return (equal - chance) / (1 - chance)


def sketch(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """Per row ``doc`` (the kept columns), the set's fingerprint ``f1``, ``f2``, ``n_shingles`` and ``bands`` (null without words)."""

    def start():
        def work(batch):
            n = batch.num_rows
            f1, f2, sizes, bands = [None] * n, [None] * n, [0] * n, [None] * n
            for at, words in text_words(batch.column("_text"), SPACED):
                for row, members in shingle_sets(words):
                    (f1[at + row], f2[at + row]), sizes[at + row] = fingerprint(members), len(members)
                    bands[at + row] = band_keys(members)
            return f1, f2, sizes, bands

        return work

    return annotate(docs, keep, {"_text": F.col(text)}, "f1 long, f2 long, n_shingles long, bands array<long>", start)


def set_table(docs: DataFrame, nodes: DataFrame, text: str) -> DataFrame:
    """``id`` and ``members`` (the full sorted set) of nodes, from a document that has the node's fingerprint.

    A node knows the key and the text's hash of one of its documents, so rows that share a key (or have none) meet the
    nodes of their own text only.
    """
    wanted = nodes.select("id", "f1", "f2", F.col("source.key").alias("_key"), F.col("source.hash").alias("_hash"))
    texts = docs.select(F.col("key").alias("_key"), F.col("hash").alias("_hash"), F.col(text).alias("_text"))
    same = texts["_key"].eqNullSafe(wanted["_key"]) & (texts["_hash"] == wanted["_hash"])
    texts = texts.join(wanted, same).select("id", "f1", "f2", "_text")

    def start():
        def work(batch):
            n = batch.num_rows
            f1, f2 = batch.column("f1").to_numpy(), batch.column("f2").to_numpy()
            out = [None] * n
            for at, words in text_words(batch.column("_text"), SPACED):
                for row, members in shingle_sets(words):
                    if fingerprint(members) == (f1[at + row], f2[at + row]):
                        out[at + row] = members.tobytes()
            return batch.column("id"), out

        return work

    inputs = {c: F.col(c) for c in ("id", "f1", "f2", "_text")}
    found = annotate(texts, ["f1"], inputs, "id long, members binary", start)
    # rows that repeat a key may bring the same set twice
    return found.where("members is not null").select("id", "members").dropDuplicates(["id"])


def likely(pairs: DataFrame, nodes: DataFrame, floor: float) -> DataFrame:
    """Pairs (a, b) whose estimated similarity reaches ``floor``."""
    side = nodes.select("id", "bands", "n_shingles")
    # a hub may have most of the pairs
    joined = salted_join(pairs, side.toDF("a", "bands_a", "n_a"), ["a"], "inner", "b").join(side.toDF("b", "bands_b", "n_b"), "b")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.ascontiguousarray(batch.column(c).flatten().to_numpy()).reshape(-1, BANDS) for c in ("bands_a", "bands_b"))
            n, m = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            yield batch.select(["a", "b"]).filter(pa.array(estimate(a, b, n, m) >= floor))

    return joined.select("a", "b", "bands_a", "bands_b", "n_a", "n_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, group: int = 64) -> DataFrame:
    """Pairs whose full sets share at least ``percent`` % of their union.

    A hub ``a`` with many partners gets a copy of its set for about every ``group`` of them, so neither a task
    nor the shuffle holds a large group as a whole.
    """
    degree = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("_n"))
    dealt = pairs.join(degree, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("_n") / group)))
    hubs = degree.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("_n") / group) - 1)))
    left = dealt.select("a", "b", "salt").join(sets.toDF("b", "members_b"), "b")
    right = hubs.select("a", "salt").join(sets.toDF("a", "members_a"), "a")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("members_a"), batch.column("members_b"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                shared = int((q[at] == p).sum())
                keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return left.join(right, ["a", "salt"]).select("a", "b", "members_a", "members_b").mapInArrow(run, "a long, b long")


def smallest_shared(p: np.ndarray, q: np.ndarray, percent: int, errors: float = 4.0) -> bool:
    """Whether two sorted sets, given by their BOTTOM smallest members, may share ``percent`` % of their union.

    Sets that are given whole are judged exactly; for others, the share among the smallest members of the union may
    fall short by ``errors`` standard errors.
    """
    both = np.sort(np.concatenate([p, q]))
    twice = np.flatnonzero(both[1:] == both[:-1])
    if len(p) < BOTTOM and len(q) < BOTTOM:
        return 100 * len(twice) >= percent * (len(both) - len(twice))
    union = len(both) - len(twice)
    if union > BOTTOM:
        # position in the union of what is in both
        twice = twice[twice - np.arange(len(twice)) < BOTTOM]
        union = BOTTOM
    return 100 * len(twice) >= union * (percent - 100 * errors * (0.25 * 0.75 / BOTTOM) ** 0.5)


def across_parts(groups: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, floor: float, block: int = 1024, per_task: int = 1 << 13) -> DataFrame:
    """Pairs of nodes around one hub that share a band, have different labels and may be similar enough.

    ``groups`` has ``hub``, ``id`` and ``label``.  A hub's nodes outside its smallest label are compared with all of
    its nodes, in blocks of about ``block`` on both sides: by the estimate from their registers, then by their 256
    smallest members (a small set as a whole).  Only pairs that pass both leave a task.
    """
    size = groups.groupBy("hub").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"))
    size = store(size.where("low != high").withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).drop("high"), "split")
    crowd = salted_join(groups, size, ["hub"], "inner", "id")
    own, others = F.pmod(F.hash("id"), F.col("blocks")), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asking = crowd.where("label != low").select("hub", "id", "label", F.lit(True).alias("asks"), own.alias("x"), others.alias("y"))
    asked = crowd.select("hub", "id", "label", F.lit(False).alias("asks"), others.alias("x"), own.alias("y"))
    rows = size.agg(F.coalesce(F.sum(F.col("size") * F.col("blocks") * 2), F.lit(0))).first()[0]
    known = nodes.select("id", "bands", "n_shingles").join(sets.select("id", F.expr(f"substring(members, 1, {8 * BOTTOM})").alias("bottom")), "id")
    dealt = asking.unionByName(asked).join(known, "id").withColumn("task", F.pmod(F.xxhash64("hub", "x", "y"), F.lit(rows // per_task + 1)))

    def run(table: pa.Table) -> pa.Table:
        columns = {c: table[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("hub", "x", "y", "id", "label", "asks", "n_shingles")}
        bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        bottom = [np.frombuffer(b.as_buffer(), np.uint64) for b in table["bottom"].combine_chunks()]
        sizes = columns["n_shingles"].astype(float)
        keys = [columns[c] for c in ("y", "x", "hub")]
        order = np.lexsort(keys)
        new = np.zeros(len(order), bool)
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        pairs = []
        for group in np.split(order, np.flatnonzero(new)):
            left, right = group[columns["asks"][group]], group[~columns["asks"][group]]
            for at in range(0, len(left), 64):
                some = left[at : at + 64]
                p, q = np.nonzero(columns["label"][some][:, None] > columns["label"][right])
                a, b = some[p], right[q]
                meet = (bands[a] == bands[b]).any(axis=1)
                a, b = a[meet], b[meet]
                if len(a):
                    good = estimate(bands[a], bands[b], sizes[a], sizes[b]) >= floor
                    pairs += [(columns["id"][i], columns["id"][j]) for i, j in zip(a[good], b[good], strict=True) if smallest_shared(bottom[i], bottom[j], percent)]
        made = np.sort(np.array(pairs, np.int64).reshape(-1, 2), axis=1)
        return pa.table({"a": made[:, 0], "b": made[:, 1]})

    return dealt.groupBy("task").applyInArrow(run, "a long, b long").distinct()


def find_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75, floor: float = 0.6) -> DataFrame:
    """Per row: the key, ``n_shingles``, ``component_id`` (smallest key of its group) and ``kept`` (the key is that one).

    Documents are linked if the sets of five-word shingles share ``percent`` % of their union; a group is what links
    connect.  Equal sets become one node first.  A node has 128 HyperMinHash registers of 16 bits (leading zeros and
    ten mantissa bits), in 32 bands of four; nodes that share a band are candidates (two sets at 0.75 miss each
    other in all bands with a chance of about 5 in a million).  Candidates below an estimate of ``floor`` (four
    standard errors under 0.75) go, the others are confirmed on full sets.

    Within a bucket not all pairs are made: every node is compared with the bucket's hub, the node that shares
    most bands with others.  A hub around which all nodes then have one label is finished.  Around the others,
    nodes that share a band and have different labels are compared too (``across_parts``), so no link is lost.

    Keys and buckets that hold many rows are spread over tasks by ``salted_join``.

    Texts without words (null, empty) have an empty set and are linked with nothing.  Rows with the same key are one
    document to ``kept``; they are told apart by their texts' hashes.  Null keys can be linked, but a group's id is null only if all its keys are.
    """
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    rows = store(sketch(docs, ["key", "hash"], "text").select("doc.key", "doc.hash", "f1", "f2", "n_shingles", "bands"), "sketches")
    nodes = store(
        rows.where("n_shingles > 0").groupBy("f1", "f2")
        .agg(
            F.min("key").alias("first_key"), F.first(F.struct("key", "hash")).alias("source"),
            F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
        )
        .withColumn("id", F.monotonically_increasing_id()), "nodes",
    )
    banded = nodes.select("id", F.posexplode("bands").alias("band", "value"))
    buckets = store(banded.groupBy("band", "value").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    bucket, sizes = ["band", "value"], buckets.withColumnRenamed("size", "_n")
    crowd = store(salted_join(banded, buckets, bucket, "inner", "id", sizes).select(*bucket, "id", "size"), "crowd")
    popular = store(crowd.groupBy("id").agg(F.sum("size").alias("weight")), "popular")
    sets = store(set_table(docs, nodes.join(popular, "id", "left_semi"), "text"), "sets")
    hubs = store(crowd.join(popular, "id").groupBy(*bucket).agg(F.max_by("id", "weight").alias("hub")), "hubs")
    pairs = salted_join(crowd, hubs, bucket, "inner", "id", sizes).where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    pairs = store(pairs, "pairs")
    links = store(confirmed(store(likely(pairs, nodes, floor), "likely"), sets, percent), "confirmed")
    labels = store(renamed(popular.select("id", F.col("id").alias("label")), components(links)), "labels")
    groups = store(pairs.select(F.col("a").alias("hub"), F.col("b").alias("id")).join(labels, "id"), "groups")
    links = store(confirmed(store(across_parts(groups, nodes, sets, percent, floor), "likely"), sets, percent), "confirmed")
    here, there = labels.toDF("a", "label_a"), labels.toDF("b", "label_b")
    between = links.join(here, "a").join(there, "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    labels = store(renamed(labels, components(between)), "labels")
    named = store(
        nodes.select("id", "f1", "f2", "first_key").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id")), "named"
    )
    least = store(named.groupBy("label").agg(F.min("first_key").alias("component")), "least")
    grouped = store(named.join(least, "label").select("f1", "f2", "component"), "groups")
    out = rows.select("key", "f1", "f2", "n_shingles").join(grouped, ["f1", "f2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("key"))
    return out.select(
        F.col("key").alias(key), "n_shingles", component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept")
    )
