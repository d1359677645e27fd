"""Secret scan: fixed patterns, and strings in sensitive places that compression finds new."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.arrow import annotate
from episodica.sources.shared import store

KINDS = ("assign", "access", "hex", "novel")
# fixed values: the base patterns with their least lengths
PATTERNS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]{24,}"), 0, 24),
)
# places where a credential may stand: a sensitive word, up to 24 other characters, a string without spaces
SENSITIVE = re.compile(
    r"""(credential|private|bearer|authorization|auth|access|key|pass|pwd|secret|token|login|session|signature)"""
    r"""[A-Za-z_-]{0,16}["']?[\x20\t]{0,3}[:=\x20][\x20\t"']{0,3}([A-Za-z0-9+/_.=~-]{12,})""", re.I | re.A,
)
IDENTIFIER = re.compile("[A-Za-z_][A-Za-z0-9_.-]{2,}")
# what no word in one case has: a digit, or a capital after a small letter
UNWORDLY = re.compile("[0-9]|[a-z][A-Z]")
REACH = 40  # a sensitive word, what may follow it and the gap before a string are shorter
AROUND = 256


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping per kind."""
    out = []
    for number, (_, pattern, group, least) in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), number, m.end()))
    return sorted(out)


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Disjoint stretches that cover the same places, in order."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def cut_out(text: str, low: int, high: int, cuts: list[list[int]]) -> str:
    """The text from ``low`` to ``high`` with a space in the place of each of the disjoint ``cuts``."""
    out, at = [], low
    for start, end in cuts[bisect_right(cuts, low, key=lambda c: c[1]) :]:
        if start >= high:
            break
        out += [text[at:start], " "]
        at = end
    return "".join([*out, text[at:high]])


def sensitive_strings(text: str, base: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, bytes]], list[str]]:
    """Strings after sensitive words that no base span touches, each with its surroundings, and the stretches of all surroundings.

    All such strings and all base spans are cut out of every surrounding.  Surroundings that overlap are one stretch.
    """
    found, at = [], 0
    fixed = merged([(s, e) for s, _, e in base])
    while m := SENSITIVE.search(text, at):
        start, end = m.span(2)
        first = bisect_right(fixed, start, key=lambda c: c[1])
        if UNWORDLY.search(text, start, end) and not (first < len(fixed) and fixed[first][0] < end):
            found.append((start, end))
            at = end
        else:
            # a refused string may hold the next sensitive word; if that is far from its end, what follows the word is refused too
            at = max(m.end(1), end - REACH)
    cuts = merged([*found, *((s, e) for s, _, e in base)])
    out = []
    for start, end in found:
        near = cut_out(text, max(0, start - AROUND), start, cuts) + cut_out(text, end, end + AROUND, cuts)
        out.append((start, end, near.encode("utf-8", "replace")))
    return out, [cut_out(text, s, e, cuts) for s, e in merged([(max(0, s - AROUND), e + AROUND) for s, e in found])]


def primed_compressor(dictionary: bytes, level: int = 3) -> zstandard.ZstdCompressor:
    primed = {}
    if len(dictionary) >= 8:
        primed["dict_data"] = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed["dict_data"].precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False, write_dict_id=False, **primed)


def marginal_bytes(value: bytes, near: bytes, compressor: zstandard.ZstdCompressor) -> int:
    """How many bytes a string adds to what its surroundings compress to, both primed with the dictionary."""
    return len(compressor.compress(near + value)) - len(compressor.compress(near))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan_secrets(
    docs: DataFrame, keep: list[str], text: str = "text", least_share: float = 0.7, dictionary_bytes: int = 1 << 16, least_rows: int = 3
) -> DataFrame:
    """Per row ``doc`` (struct of ``keep``), counts per base kind, ``n_novel``, ``base_sha256``, ``spans`` and ``found``.

    The fixed patterns give the base spans.  Beyond them, every string of 12 characters or more after a sensitive
    word is a candidate, unless it reads as a word (no digit, no capital after a small letter): it is reported as ``novel`` if its marginal compressed bytes, against
    its surroundings and a dictionary of identifiers, reach ``least_share`` of its length.  The dictionary holds the
    identifiers that occur in ``least_rows`` or more different stretches around candidates of the table, most frequent
    last (closest to the string), up to ``dictionary_bytes``: that bounds what is broadcast.  Base spans and all
    candidates are cut out of the surroundings first, so that no secret is known from its neighbours or copies;
    surroundings that overlap are one stretch, and equal ones count once.

    The text is read once; spans and candidates are stored in the shared folder.  ``found`` holds all spans as
    structs (start and end in code points, end exclusive).  Null and empty texts have no spans; repeated rows give
    repeated results; an empty table gives no rows.
    """

    def read():
        def work(batch):
            bases, candidates, stretches = [], [], []
            for value in batch.column("_text").to_pylist():
                base = base_spans(value or "")
                bases.append([{"start": s, "kind": k, "stop": e} for s, k, e in base])
                found, around = sensitive_strings(value or "", base)
                candidates.append([{"start": s, "stop": e, "value": value[s:e], "near": near} for s, e, near in found])
                stretches.append(around)
            return bases, candidates, stretches

        return work

    outputs = (
        "base array<struct<start:int,kind:int,stop:int>>, "
        "candidates array<struct<start:int,stop:int,value:string,near:binary>>, stretches array<string>"
    )
    rows = store(annotate(docs, keep, {"_text": F.col(text)}, outputs, read), "secrets")
    words = rows.select(F.explode("stretches").alias("stretch")).distinct().select(
        F.explode(F.array_distinct(F.regexp_extract_all("stretch", F.lit(IDENTIFIER.pattern), F.lit(0)))).alias("word")
    )
    common = words.groupBy("word").count().where(F.col("count") >= least_rows).orderBy(F.desc("count"), "word")
    dictionary = b""
    for row in common.limit(dictionary_bytes // 4).collect():
        if len(dictionary) + len(row.word) < dictionary_bytes:
            dictionary = row.word.encode() + b" " + dictionary

    def judge():
        compressor = primed_compressor(dictionary)

        def work(batch):
            out = [[] for _ in range(7)]
            for base, candidates in zip(batch.column("base").to_pylist(), batch.column("candidates").to_pylist(), strict=True):
                found = [(b["start"], b["kind"], b["stop"]) for b in base]
                counts = [sum(k == n for _, k, _ in found) for n in range(3)]
                fixed = joined(found)
                for c in candidates:
                    value = c["value"].encode()
                    if marginal_bytes(value, c["near"], compressor) >= least_share * len(value):
                        found.append((c["start"], 3, c["stop"]))
                made = [*counts, len(found) - sum(counts), hashlib.sha256(fixed.encode()).hexdigest(), joined(found),
                        [{"start": s, "stop": e, "kind": KINDS[k]} for s, k, e in sorted(found)]]
                for column, item in zip(out, made, strict=True):
                    column.append(item)
            return out

        return work

    outputs = (
        "n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string, "
        "found array<struct<start:int,stop:int,kind:string>>"
    )
    return annotate(rows, None, {"base": F.col("base"), "candidates": F.col("candidates")}, outputs, judge)
