"""Raw-content Zstandard dictionaries per label and the sizes that texts compress to with them."""

from __future__ import annotations

import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4096


def sample_dictionaries(docs: DataFrame, key: Column, text: Column, label: Column, size: int = 1 << 17, pieces: int = 512, total: int = 1 << 25) -> dict[str, bytes]:
    """Up to ``size`` bytes of text per label: a bounded sample of labelled rows for fitting.

    The keys of each label fall into ``pieces`` hash buckets, the smallest hash of each bucket is taken (one
    partial aggregation, no text read), and a slice of the chosen texts at a hash-chosen place is collected.
    Every label is learned.  ``total`` bounds the bytes of all dictionaries, which a task holds: with more than 256
    labels each gets an equal share, down to 1 KB.  All labels share 16,384 pieces, with four or more a label.
    """
    spread = F.xxhash64(key.cast("string"), F.lit("dictionary"))
    rows = docs.select(text.alias("text"), label.cast("string").alias("label"), spread.alias("spread"))
    rows = rows.where(F.col("label").isNotNull())
    labels = max(rows.select("label").distinct().count(), 1)
    pieces = max(4, min(pieces, 16384 // labels))
    size = max(1 << 10, min(size, total // labels))
    firsts = (
        rows.groupBy("label", F.pmod("spread", F.lit(pieces)).alias("bucket"))
        .agg(F.min("spread").alias("spread")).collect()
    )
    if not firsts:
        return {}
    length = max(size // pieces, 16)
    at = F.lit(1) + F.pmod(F.shiftright("spread", 16), F.greatest(F.length("text") - length, F.lit(1))).cast("int")
    chosen = (
        rows.where(F.col("text").isNotNull() & F.col("spread").isin([r.spread for r in firsts]))
        .select("label", "spread", F.substring(F.col("text"), at, F.lit(length)).alias("piece"))
        .groupBy("label", "spread").agg(F.min("piece").alias("piece")).collect()
    )
    out: dict[str, list[bytes]] = {}
    for row in sorted(chosen, key=lambda r: (r.label, r.spread)):
        out.setdefault(row.label, []).append(row.piece.encode())
    return {name: b"\n".join(parts)[:size] for name, parts in out.items()}


class Compressors:
    """One compressor per dictionary, built on first use in a task."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names, self.each = list(dictionaries), []
        # matches from three bytes on, as syllables are short; tables that hold a whole dictionary of 128 KB
        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_LAZY, min_match=3, hash_log=17, chain_log=17, search_log=3, window_log=18,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        for content in dictionaries.values():
            options = {"compression_params": settings}
            if len(content) >= 8:
                primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                primed.precompute_compress(compression_params=settings)
                options["dict_data"] = primed
            self.each.append(zstandard.ZstdCompressor(**options))

    def sizes(self, text: bytes, block: int = BLOCK) -> list[int]:
        """Bytes of the whole text under each dictionary; blocks start afresh, so that the dictionary counts throughout."""
        view = memoryview(text)
        parts = [view[i : i + block] for i in range(0, len(view), block)] or [view]
        return [sum(len(c.compress(p)) for p in parts) for c in self.each]
