"""SimHash groups: 64-bit fingerprints, an inverted index over their byte positions, count filtering, verification."""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from episodica.functions.joins import salted_join
from episodica.llm.arrow import annotate
from episodica.llm.components import components, renamed
from episodica.sources.shared import store

WIDTH = 3
SEED = 42
PIECE = 1 << 20
BLANK = re.compile(rb"[\x20\x09-\x0D]")
BYTES = 8
# most differing bits of a link: the byte groups below leave enough equal positions for two
MOST_BITS = 2


def signed(mask: int) -> int:
    """A mask of 64 bits as Spark's long."""
    return mask - (1 << 64) if mask >> 63 else mask


def positions(chosen) -> int:
    """Mask over the bytes at the chosen positions."""
    return sum(0xFF << (8 * p) for p in chosen)


# Two bits change at most two bytes.  Of the byte groups {0,1} {2,3} {4,5} {6,7} two stay equal: six lists of four positions.
FIRST = [positions((2 * i, 2 * i + 1, 2 * j, 2 * j + 1)) for i, j in combinations(range(4), 2)]
# Of all eight positions six stay equal: lists of six positions, which hold 2 ** 16 different fingerprints at most.
SIXES = [positions(six) for six in combinations(range(BYTES), 6)]


def word_stretches(text: bytes, piece: int = PIECE):
    """Lists of lower-cased words, each starting with the last two of the one before: no shingle is lost or told twice."""
    at, carried, told = 0, [], False
    while at < len(text):
        cut = BLANK.search(text, at + piece)
        stop = cut.start() if cut else len(text)
        words = carried + text[at:stop].lower().split()
        if len(words) >= WIDTH:
            yield words
            told = True
        carried, at = words[1 - WIDTH :], stop
    if carried and not told:
        yield carried


def simhash(text: bytes) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if more than half of the shingles' XXH64 values have it; 0 without words."""
    ones, total = np.zeros(64, np.int64), 0
    for words in word_stretches(text):
        n = max(len(words) - WIDTH + 1, 1)
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)[:n].tolist()
        ends = ends[len(words) - n :].tolist()
        hashes = np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends, strict=True)), np.uint64, n)
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(n, BYTES), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += n
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and ``fp`` (the fingerprint as a signed long) of every row."""

    def start():
        def work(batch):
            texts = batch.column("_text").cast(pa.large_binary())
            return [[signed(simhash(t.as_py() or b"")) for t in texts]]

        return work

    made = annotate(docs.select(key, text), [key], {"_text": F.col(text)}, "fp long", start)
    return made.select(F.col("doc")[key].alias("key"), "fp")


def postings(prints: DataFrame, masks) -> DataFrame:
    """Every fingerprint in the list of each mask: ``slot`` (which positions), ``bytes`` (their values), ``fp``."""
    cells = [F.struct(F.lit(i).alias("slot"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("bytes"), F.col("fp").alias("fp")) for i, m in enumerate(masks)]
    return prints.select(F.inline(F.array(*cells)))


def counted(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Whether pairs share the guaranteed minimum of positional bytes, and then differ in no more than ``bits`` bits."""
    differing = a ^ b
    shared = (differing.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    kept = shared >= BYTES - bits
    kept[kept] = np.bitwise_count(differing[kept]) <= bits
    return kept


def short_lists(begins: np.ndarray, prints: np.ndarray, bits: int):
    """Links within lists: every member against those that follow it in its list, one distance after the other.

    ``begins`` marks the first member of each list; ``prints`` are the members, list after list.
    """
    n = len(prints)
    last = np.append(np.flatnonzero(begins)[1:], n)[np.cumsum(begins) - 1]
    at = np.arange(n)
    for step in range(1, n):
        at = at[at + step < last[at]]
        if not len(at):
            return
        good = counted(prints[at], prints[at + step], bits)
        if good.any():
            yield prints[at[good]], prints[at[good] + step]


def long_list(members: np.ndarray, bits: int):
    """Links within one list of six positions: its members differ in two bytes only, so all values near one are looked up."""
    mask = np.bitwise_or.reduce(members ^ members[0])
    free = [p for p in range(BYTES) if int(mask) >> (8 * p) & 0xFF]
    value = np.zeros(len(members), np.int64)
    for i, p in enumerate(free):
        value |= ((members >> np.uint64(8 * p)) & np.uint64(0xFF)).astype(np.int64) << (8 * i)
    holder = np.full(1 << (8 * len(free)), -1, np.int64)
    holder[value] = np.arange(len(members))
    single = [1 << i for i in range(8 * len(free))]
    flips = single + [a | b for a, b in combinations(single, 2)] if bits == 2 else single if bits else []
    for flip in flips:
        other = holder[value ^ flip]
        own = np.flatnonzero((other >= 0) & (value < value ^ flip))
        if len(own):
            a, b = members[own], members[other[own]]
            good = counted(a, b, bits)
            yield a[good], b[good]


def links_in_lists(lists: DataFrame, rows: int, bits: int, per_task: int) -> DataFrame:
    """Linked pairs (a, b) of fingerprints that share a list.  Lists are dealt to tasks of about ``per_task`` postings."""
    dealt = lists.withColumn("task", F.pmod(F.xxhash64("slot", "bytes"), F.lit(rows // per_task + 1)))

    def run(table: pa.Table) -> pa.Table:
        slot, key, prints = (table[c].to_numpy() for c in ("slot", "bytes", "fp"))
        order = np.lexsort((prints, key, slot))
        slot, key, prints = slot[order], key[order], prints[order].view(np.uint64)
        begins = np.append(True, (slot[1:] != slot[:-1]) | (key[1:] != key[:-1]))
        starts = np.flatnonzero(begins)
        sizes = np.diff(np.append(starts, len(prints)))
        # lists of six positions that hold more members than there are values near one
        crowded = (sizes > 256) & (slot[starts] >= len(FIRST))
        short = ~np.repeat(crowded, sizes)
        found = list(short_lists(begins[short], prints[short], bits)) if short.any() else []
        for first, size in zip(starts[crowded], sizes[crowded], strict=True):
            found += long_list(prints[first : first + size], bits)
        a, b = (np.concatenate([p[i] for p in found] or [np.zeros(0, np.uint64)]).view(np.int64) for i in (0, 1))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return dealt.groupBy("task").applyInArrow(run, "a long, b long")


def near_prints(prints: DataFrame, bits: int = MOST_BITS, longest: int = 1024, per_task: int = 1 << 17) -> DataFrame:
    """All pairs (a, b) of different fingerprints ``fp`` that differ in at most ``bits`` bits.

    The inverted index posts a fingerprint under the values of its bytes at four positions, six times.  Lists with
    more than ``longest`` members are not compared: their members are posted again under six positions, where a list
    holds 65,536 different fingerprints at most whatever the data are.
    """
    if not 0 <= bits <= MOST_BITS:
        raise ValueError(f"the lists guarantee a shared one for 0 to {MOST_BITS} differing bits, not {bits}")
    index = postings(prints, FIRST)
    sizes = store(index.groupBy("slot", "bytes").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "lists")
    members = store(
        salted_join(index, sizes.withColumn("crowded", F.col("_n") > longest).drop("_n"), ["slot", "bytes"], "inner", "fp", sizes), "postings"
    )
    again = postings(members.where("crowded").select("fp").distinct(), SIXES).withColumn("slot", F.col("slot") + len(FIRST))
    # a list of six positions counts only if it lies within a crowded list of four, but more lists find no wrong pair
    lists = members.where("not crowded").drop("crowded").unionByName(again)
    rows = members.agg(F.count_if(~F.col("crowded")) + len(SIXES) * F.count_if("crowded")).first()[0]
    return links_in_lists(lists, rows, bits, per_task).distinct()


def find_simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = MOST_BITS) -> DataFrame:
    """Per row: the key, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest key that links reach.

    A fingerprint is made of XXH64 values (seed 42) of three-word shingles, repeats included.  Equal fingerprints are
    one node; nodes are linked at ``bits`` or fewer differing bits, and components follow from the links.  At most
    2,080 other fingerprints are that near to one, so links grow with the nodes even in a dense group.

    Null texts and texts without words have fingerprint zero and are linked like any other.  Rows with the same key
    are rows of their own with one id; null keys can be linked, but a group's id is null only if all its keys are.
    Further columns are not read, so their names can't clash.  An empty table gives an empty result.
    """
    rows = store(fingerprints(docs, key, text).withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    prints = store(rows.groupBy("fp").agg(F.min("key").alias("first_key"), F.count(F.lit(1)).alias("_n")), "prints")
    links = store(near_prints(prints.select("fp"), bits), "links")
    nodes = prints.select(F.col("fp").alias("id"), F.col("fp").alias("label"), "first_key")
    labels = store(renamed(nodes.select("id", "label"), components(links)), "labels").withColumnRenamed("id", "fp")
    named = prints.select("fp", "first_key").join(labels, "fp")
    least = named.groupBy("label").agg(F.min("first_key").alias("component"))
    component = store(named.select("fp", "label").join(least, "label").select("fp", "component"), "groups")
    out = salted_join(rows, component, ["fp"], "left", "row", prints.select("fp", "_n"))
    return out.select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
