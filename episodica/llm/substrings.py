"""Exact removal of repeated strings of 200 bytes: sampled suffixes in a logarithmic index family, then exact windows."""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from episodica.llm.anchors import LENGTH, anchors_of
from episodica.llm.levels import MADE, PACKED, counted, made_table, packed_rows, parts_for, per_chunk, repeated_entries
from episodica.llm.words import U, byte_hashes, mix, stretch_hashes, text_blocks
from episodica.sources.shared import shared_path

STEP = 16  # windows that one strip covers
CHUNK_BYTES = 8 << 20
ALL, WINDOWS, BOTH = 1, 2, 3  # what is known of a strip: all its windows repeat, look at windows, both


def bucketed(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder in buckets of ``chunk``: later joins on it move only their other side."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, "chunk").option("path", shared_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def binary(*arrays) -> list[pa.Array]:
    return [pa.array([a if isinstance(a, bytes) else a.tobytes()], pa.binary()) for a in arrays]


def read_chunks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per run of about 8 MB of texts: keys, offsets, compressed bytes, anchor heads and their offsets per text."""
    frame = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("keys", T.ArrayType(docs.schema[key].dataType)),
        *[T.StructField(c, T.BinaryType()) for c in ("offsets", "data", "heads", "first")],
    ])
    arrow = to_arrow_schema(schema)

    def run(batches):
        number = TaskContext.get().partitionId() << 24
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            blocks, size = [], 0
            for at, data, offsets in text_blocks(batch.column("text")):
                if blocks and size + len(data) > CHUNK_BYTES:
                    yield flush(batch, blocks, number, pack)
                    blocks, size, number = [], 0, number + 1
                running = byte_hashes(data)
                heads = [anchors_of(running, a, b)[1] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                blocks.append((at, data, offsets, heads))
                size += len(data)
            if blocks:
                yield flush(batch, blocks, number, pack)
                number += 1

    def flush(batch, blocks, number, pack):
        heads = [h for b in blocks for h in b[3]]
        sizes = np.concatenate([np.diff(b[2]) for b in blocks])
        keys = batch.column("key").slice(blocks[0][0], len(sizes))
        made = binary(
            np.append(0, np.cumsum(sizes)), pack.compress(np.concatenate([b[1] for b in blocks]).tobytes()),
            np.concatenate(heads), np.append(0, np.cumsum([len(h) for h in heads])),
        )
        columns = [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys), *made]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return frame.mapInArrow(run, schema)


def numbers(row, column: str, kind) -> np.ndarray:
    return np.frombuffer(row.column(column)[0].as_buffer(), kind)


def one_by_one(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1)


def gathered(row, column: str, kind) -> np.ndarray:
    """The arrays that a list of binaries holds, end to end."""
    parts = row.column(column)[0]
    return np.concatenate([np.frombuffer(p.as_buffer(), kind) for p in parts.values]) if parts.is_valid and len(parts) else np.zeros(0, kind)


def gather(found: DataFrame, *columns: str) -> DataFrame:
    """All entries of a chunk in one row; they are fewer than the chunk's own.

    Lists of several columns keep their order as they are collected as structs.
    """
    both = found.groupBy("chunk").agg(F.collect_list(F.struct(*columns)).alias("all"))
    return both.select("chunk", *[F.col("all")[c].alias(f"{c}_found") for c in columns])


def head_units(chunks: DataFrame, parts: int) -> DataFrame:
    def run(batches):
        for row in one_by_one(batches):
            yield packed_rows(row.column("chunk")[0].as_py(), *counted(numbers(row, "heads", np.uint64)), parts)

    return chunks.select("chunk", "heads").mapInArrow(run, PACKED)


RANGES = "chunk long, text_of binary, start binary, first binary, data binary"


def cut_ranges(chunks: DataFrame, found: DataFrame) -> DataFrame:
    """Per chunk the stretches whose 200-byte windows all have an anchor that occurs elsewhere too; no other window repeats."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for row in one_by_one(batches):
            known = np.unique(gathered(row, "entries_found", np.uint64))
            heads, first, offsets = numbers(row, "heads", np.uint64), numbers(row, "first", np.int64), numbers(row, "offsets", np.int64)
            data = np.frombuffer(unpack.decompress(row.column("data")[0].as_py()), np.uint8)
            repeated = np.isin(heads, known)
            shared = np.append(0, np.cumsum(repeated))
            text_of, starts, pieces = [], [], []
            for t in np.flatnonzero(shared[first[1:]] > shared[first[:-1]]).tolist():
                body = data[offsets[t] : offsets[t + 1]]
                _, _, begins = anchors_of(byte_hashes(body), 0, len(body))
                edges = np.diff(np.concatenate([[0], repeated[first[t] : first[t + 1]], [0]]).astype(np.int8))
                for a, b in zip(begins[np.flatnonzero(edges == 1)].tolist(), begins[np.flatnonzero(edges == -1)].tolist(), strict=True):
                    text_of.append(t)
                    starts.append(a)
                    pieces.append(body[a : b + LENGTH - 1])
            if pieces:
                firsts = np.append(0, np.cumsum([len(p) for p in pieces]))
                made = binary(np.array(text_of, np.int64), np.array(starts, np.int64), firsts, np.concatenate(pieces))
                yield pa.RecordBatch.from_arrays([row.column("chunk"), *made], names=["chunk", "text_of", "start", "first", "data"])

    joined = chunks.select("chunk", "offsets", "data", "heads", "first").join(gather(found, "entries"), "chunk")
    return joined.mapInArrow(run, RANGES)


def strips(row, limit: int = 1 << 20):
    """Strips of a chunk's ranges, block by block.

    A strip is 16 windows in a row at a fixed distance from their anchor.  Its core is what all of them hold, its
    whole what any of them holds; equal windows lie at equal places of strips with equal cores.  Gives
    (running hash, first range, range edges, range, start, first window, last window, core, whole, whole is there).
    """
    first, data = numbers(row, "first", np.int64), numbers(row, "data", np.uint8)
    chunk, n, at = row.column("chunk")[0].as_py(), len(first) - 1, 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(first, first[at] + limit, "right")) - 1)
        edges = first[at : stop + 1] - first[at]
        running = byte_hashes(data[first[at] : first[stop]])
        parts = []
        for k in range(stop - at):
            anchor, _, begins = anchors_of(running, int(edges[k]), int(edges[k + 1]))
            parts.append((anchor + edges[k], begins[:-1] + edges[k], begins[1:] - 1 + edges[k], np.full(len(anchor), k)))
        anchor, low, high, of = map(np.concatenate, zip(*parts, strict=True))
        near, far = (anchor - high) // STEP, (anchor - low) // STEP
        count = far - near + 1
        each = np.repeat(np.arange(len(anchor)), count)
        j = near[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
        start = anchor[each] - STEP * j - (STEP - 1)
        of = of[each]
        core = stretch_hashes(running, start + STEP - 1, start + LENGTH)
        there = (start >= edges[of]) & (start + LENGTH + STEP - 1 <= edges[of + 1])
        inside = np.where(there, start, edges[of])
        whole = stretch_hashes(running, inside, np.where(there, inside + LENGTH + STEP - 1, inside))
        # a strip that leaves its range has a whole of its own
        place = (start + first[at]).astype(np.uint64) * U(1 << 20) + of.astype(np.uint64)
        whole = np.where(there, whole, mix(mix(place + U(chunk & 0xFFFFFFFFFFFF)) + U(chunk >> 3)))
        yield running, at, edges, of, start, low[each], high[each], core, whole, there
        at = stop


def strip_units(ranges: DataFrame, parts: int) -> DataFrame:
    """Per chunk and part of the cores' range: distinct wholes, with core and whether the whole occurs more than once."""

    def run(batches):
        for row in one_by_one(batches):
            cores, wholes = [], []
            for _, _, _, of, start, _, _, core, whole, _ in strips(row):
                place = np.unique(of * (1 << 40) + start, return_index=True)[1]
                cores.append(core[place])
                wholes.append(whole[place])
            cores, wholes = np.concatenate(cores), np.concatenate(wholes)
            _, at, n = np.unique(wholes, return_index=True, return_counts=True)
            pairs = np.zeros(len(at), [("whole", np.uint64), ("twice", np.uint8)])
            pairs["whole"], pairs["twice"] = wholes[at], n > 1
            yield packed_rows(row.column("chunk")[0].as_py(), cores[at], pairs, parts)

    return ranges.mapInArrow(run, PACKED)


PAIR = np.dtype([("whole", np.uint64), ("twice", np.uint8)])


def judge_strips(table: pa.Table) -> pa.Table:
    """What is known of the strips of one part: those whose core occurs nowhere else hold no repeated window."""
    cores, wholes, twice, chunks = [], [], [], []
    for row in table.to_pylist():
        pairs = np.frombuffer(row["marks"], PAIR)
        cores.append(np.frombuffer(row["entries"], np.uint64))
        wholes.append(pairs["whole"])
        twice.append(pairs["twice"] > 0)
        chunks.append(np.full(len(pairs), row["chunk"]))
    cores, wholes, twice, chunks = map(np.concatenate, (cores, wholes, twice, chunks))
    order = np.lexsort((chunks, wholes, cores))
    cores, wholes, twice, chunks = cores[order], wholes[order], twice[order], chunks[order]
    new_core = np.append(True, cores[1:] != cores[:-1])[: len(cores)]
    new_whole = new_core | np.append(True, wholes[1:] != wholes[:-1])[: len(cores)]
    core, whole = np.cumsum(new_core) - 1, np.cumsum(new_whole) - 1
    repeats = (np.bincount(whole) > 1) | (np.bincount(whole, weights=twice) > 0)
    shared = (np.bincount(core) > 1) | (np.bincount(core, weights=twice) > 0)
    open_ones = np.bincount(core, weights=~repeats[whole]) > 0
    # one holder of each repeated whole shows its windows to the strips with the same core that are still open
    status = np.where(repeats[whole], np.where(open_ones[core] & new_whole, BOTH, ALL), WINDOWS).astype(np.uint8)
    hit = shared[core]
    return made_table(per_chunk("strip", chunks[hit], wholes[hit], status[hit]))


def statuses(row, whole: np.ndarray) -> np.ndarray:
    known, status = gathered(row, "entries_found", np.uint64), gathered(row, "marks_found", np.uint8)
    order = np.argsort(known)
    known, status = known[order], status[order]
    if not len(known):
        return np.zeros(len(whole), np.uint8)
    at = np.minimum(np.searchsorted(known, whole), len(known) - 1)
    return np.where(known[at] == whole, status[at], 0)


def open_windows(status, start, low, high) -> np.ndarray:
    """Starts of the windows that have to be looked at one by one."""
    look = np.flatnonzero(status >= WINDOWS)
    windows = start[look][:, None] + np.arange(STEP)
    return np.unique(windows[(windows >= low[look][:, None]) & (windows <= high[look][:, None])])


def window_units(judged: DataFrame, parts: int) -> DataFrame:
    def run(batches):
        for row in one_by_one(batches):
            hashes = []
            for running, _, _, _, start, low, high, _, whole, _ in strips(row):
                windows = open_windows(statuses(row, whole), start, low, high)
                hashes.append(stretch_hashes(running, windows, windows + LENGTH))
            yield packed_rows(row.column("chunk")[0].as_py(), *counted(np.concatenate(hashes)), parts)

    return judged.mapInArrow(run, PACKED)


def removed_spans(judged: DataFrame) -> DataFrame:
    """Per chunk the covered stretches: text number, start and stop."""

    def run(batches):
        for row in one_by_one(batches):
            known = np.unique(gathered(row, "windows_found", np.uint64))
            text_of, origin = numbers(row, "text_of", np.int64), numbers(row, "start", np.int64)
            out = []
            for running, at, edges, of, start, low, high, _, whole, there in strips(row):
                status = statuses(row, whole)
                cover = np.zeros(int(edges[-1]) + 1, np.int64)
                full = np.unique(start[there & ((status == ALL) | (status == BOTH))])
                cover[full] += 1
                np.add.at(cover, full + LENGTH + STEP - 1, -1)
                windows = open_windows(status, start, low, high)
                windows = windows[np.isin(stretch_hashes(running, windows, windows + LENGTH), known)]
                cover[windows] += 1
                np.add.at(cover, windows + LENGTH, -1)
                covered = np.cumsum(cover[:-1]) > 0
                edge = np.zeros(len(covered) + 1, bool)
                edge[edges] = True
                begins = np.flatnonzero(covered & (~np.append(False, covered[:-1]) | edge[:-1]))
                stops = np.flatnonzero(covered & (~np.append(covered[1:], False) | edge[1:])) + 1
                k = np.searchsorted(edges, begins, "right") - 1
                shift = origin[at + k] - edges[k]
                out.append(np.stack([text_of[at + k], begins + shift, stops + shift], axis=1))
            out = np.concatenate(out)
            if len(out):
                yield pa.RecordBatch.from_arrays([row.column("chunk"), *binary(out)], names=["chunk", "spans"])

    return judged.mapInArrow(run, "chunk long, spans binary")


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted(map(tuple, spans.tolist())):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def remove_repeated_strings(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = 4) -> DataFrame:
    """Per row: key, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``removed`` (maximal runs, in bytes).

    A byte goes if a string of 200 bytes that covers it starts anywhere else too, in any text or the same one.

    A suffix of a text is sampled at every anchor: in each string of 200 bytes, the place of the least of the
    hashes of its 64-byte pieces; equal strings have equal anchors.  Suffixes are ordered by the fingerprint of their
    first 64 bytes.  Chunks of texts come in ``batches``; each batch's array is merge-scanned against the levels
    of a logarithmic family for heads that occur twice, and equal levels merge.  Only windows of repeated heads can
    repeat.  They are compared exactly, strips of 16 first by what all and what any of their windows hold, then
    window by window, by 64-bit hashes over the whole string.

    Null texts count as empty.  Texts below 200 bytes lose nothing.  Repeated rows repeat each other's strings.  Texts
    are stored once, compressed, in buckets of chunks; all later steps move fingerprints only.
    """
    spark = docs.sparkSession
    chunks = bucketed(read_chunks(docs, key, text), "chunks")
    total = chunks.agg(F.coalesce(F.sum(F.octet_length("heads")), F.lit(0))).first()[0] // 8
    parts = parts_for(spark, total)
    ranges = bucketed(cut_ranges(chunks, repeated_entries(head_units(chunks, parts), parts, batches)), "ranges")
    found = strip_units(ranges, parts).groupBy("part").applyInArrow(judge_strips, MADE)
    judged = bucketed(ranges.join(gather(found.select("chunk", "entries", "marks"), "entries", "marks"), "chunk"), "judged")
    windows = gather(repeated_entries(window_units(judged, parts), parts, 1).withColumnRenamed("entries", "windows"), "windows")
    spans = removed_spans(judged.join(windows, "chunk", "left"))
    kept = T.StructType([
        T.StructField(key, docs.schema[key].dataType), *T._parse_datatype_string(
            "n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,stop:long>>"
        ).fields,
    ])
    arrow = to_arrow_schema(kept)

    def finish(batches):
        unpack = zstandard.ZstdDecompressor()
        for row in one_by_one(batches):
            offsets = numbers(row, "offsets", np.int64)
            data = unpack.decompress(row.column("data")[0].as_py())
            found = numbers(row, "spans", np.int64).reshape(-1, 3) if row.column("spans")[0].is_valid else np.zeros((0, 3), np.int64)
            found = found[np.argsort(found[:, 0], kind="stable")]
            cuts = np.searchsorted(found[:, 0], np.arange(len(offsets)))
            out = [[] for _ in range(5)]
            for t, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                gone = merged(found[cuts[t] : cuts[t + 1], 1:])
                digest, at = hashlib.sha256(), low
                for a, b in gone:
                    digest.update(data[at : low + a])
                    at = low + b
                digest.update(data[at:high])
                made = (high - low, sum(b - a for a, b in gone), len(gone), digest.hexdigest(), [{"start": a, "stop": b} for a, b in gone])
                for column, value in zip(out, made, strict=True):
                    column.append(value)
            keys = row.column("keys")[0].values
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) if isinstance(c, list) else c.cast(f.type) for c, f in zip([keys, *out], arrow, strict=True)], schema=arrow)

    return chunks.select("chunk", "keys", "offsets", "data").join(spans, "chunk", "left").drop("chunk").mapInArrow(finish, kept)
