"""A logarithmic family of sorted arrays: batches are merge-scanned against the levels before them, equal levels merge.

Entries are 64-bit fingerprints.  They travel packed: one row per chunk of rows and part of the fingerprint range,
its sorted distinct fingerprints as bytes.  A fingerprint that a third of all rows hold is thus one entry a chunk,
and a part holds an equal share of the range whatever the data are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.words import U
from episodica.sources.shared import store

PACKED = "part long, level int, chunk long, entries binary, marks binary"
MADE = "kind string, part long, chunk long, entries binary, marks binary"


def parts_for(spark, entries: int, per_part: int = 1 << 20) -> int:
    return max(-(-entries // per_part), int(spark.conf.get("spark.sql.shuffle.partitions")))


def part_of(entries: np.ndarray, parts: int) -> np.ndarray:
    return ((entries >> U(33)) % U(parts)).astype(np.int64)


def by_part(entries: np.ndarray, parts: int):
    """(part, places) of the parts that occur."""
    part = part_of(entries, parts)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for places in np.split(order, cuts) if len(order) else []:
        yield int(part[places[0]]), places


def packed_rows(chunk: int, entries: np.ndarray, marks: np.ndarray, parts: int) -> pa.RecordBatch:
    made = [(part, entries[at].tobytes(), marks[at].tobytes()) for part, at in by_part(entries, parts)]
    n = len(made)
    return pa.RecordBatch.from_arrays(
        [pa.array([m[0] for m in made], pa.int64()), pa.array([-1] * n, pa.int32()), pa.array([chunk] * n, pa.int64()),
         pa.array([m[1] for m in made], pa.binary()), pa.array([m[2] for m in made], pa.binary())],
        names=["part", "level", "chunk", "entries", "marks"],
    )


def counted(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct entries, and whether each occurs more than once."""
    values, n = np.unique(entries, return_counts=True)
    return values, n > 1


def per_chunk(kind: str, chunks: np.ndarray, entries: np.ndarray, marks: np.ndarray) -> list[tuple]:
    order = np.argsort(chunks, kind="stable")
    cuts = np.flatnonzero(np.diff(chunks[order])) + 1
    return [(kind, None, int(chunks[at[0]]), entries[at].tobytes(), marks[at].tobytes()) for at in (np.split(order, cuts) if len(order) else [])]


def made_table(rows: list[tuple]) -> pa.Table:
    types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["kind", "part", "chunk", "entries", "marks"])


def scan(table: pa.Table, merged: set[int], last: bool) -> pa.Table:
    """Merge one part of a batch with the same part of the levels.

    Gives, by chunk, the entries that occur more than once with one occurrence at least in the batch, and the new
    level: all distinct entries of the batch and the levels it merges with, each with the chunk it was first seen in.
    """
    part = table["part"][0].as_py()
    entries, chunks, repeated, level = [], [], [], []
    for row in table.to_pylist():
        own = np.frombuffer(row["entries"], np.uint64)
        entries.append(own)
        raw = row["level"] < 0
        chunks.append(np.full(len(own), row["chunk"]) if raw else np.frombuffer(row["marks"], np.int64))
        repeated.append(np.frombuffer(row["marks"], bool) if raw else np.zeros(len(own), bool))
        level.append(np.full(len(own), row["level"]))
    entries, chunks, repeated, level = map(np.concatenate, (entries, chunks, repeated, level))
    order = np.lexsort((chunks, entries))
    entries, chunks, repeated, level = entries[order], chunks[order], repeated[order], level[order]
    heads = np.flatnonzero(np.append(True, entries[1:] != entries[:-1])[: len(entries)])
    group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(entries))))
    size = np.bincount(group)
    shared = (size > 1) | (np.bincount(group, weights=repeated) > 0)
    shared &= np.bincount(group, weights=level < 0) > 0
    hit = shared[group]
    out = per_chunk("found", chunks[hit], entries[hit], np.ones(int(hit.sum()), bool))
    if not last:
        joins = np.isin(level, [-1, *merged])
        kept, firsts = entries[joins], chunks[joins]
        first = np.append(True, kept[1:] != kept[:-1])[: len(kept)]
        out.append(("level", part, None, kept[first].tobytes(), firsts[first].tobytes()))
    return made_table(out)


def scanner(merged: set[int], last: bool):
    def run(table: pa.Table) -> pa.Table:
        return scan(table, merged, last)

    return run


def repeated_entries(units: DataFrame, parts: int, batches: int) -> DataFrame:
    """``chunk`` and ``entries``: those of each chunk's entries that occur elsewhere too, in other chunks or in the same.

    ``units`` has rows of the form PACKED; its chunks are dealt to ``batches`` by hash and indexed one batch after
    the other.  Level k holds 2 ** k batches; a batch merges with all levels that it fills up.
    """
    levels: list[tuple[int, DataFrame]] = []
    found = None
    for turn in range(batches):
        pieces = units if batches == 1 else units.where(F.pmod(F.xxhash64("chunk"), F.lit(batches)) == turn)
        size, merged = 1, set()
        for k in range(len(levels) - 1, -1, -1):
            if levels[k][0] != size:
                break
            merged.add(k)
            size *= 2
        for k, (_, level) in enumerate(levels):
            pieces = pieces.unionByName(level.select("part", F.lit(k).alias("level"), "chunk", "entries", "marks"))
        last = turn == batches - 1

        made = store(pieces.groupBy("part").applyInArrow(scanner(merged, last), MADE), "levels")
        fresh = made.where("kind = 'found'").select("chunk", "entries")
        found = fresh if found is None else found.unionByName(fresh)
        levels = [level for k, level in enumerate(levels) if k not in merged] + [(size, made.where("kind = 'level'"))]
    return found
