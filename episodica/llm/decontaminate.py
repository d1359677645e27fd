"""Benchmark decontamination: FM-indexes of the training text, searched backwards for the benchmark's windows."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.arrow import annotate
from episodica.llm.words import LETTERED, text_words, window_hashes

END, GAP, FIRST = 0, 1, 2  # symbols: end of a shard, a gap between runs, then the benchmark's words


@dataclass
class Phrases:
    """A block of the benchmark: its vocabulary, its distinct windows and the items that hold them."""

    vocabulary: np.ndarray  # sorted word hashes; a word's symbol is its place + FIRST
    windows: np.ndarray  # symbols, one row per window, left-aligned
    lengths: np.ndarray
    items: list[str]
    owner_first: np.ndarray  # items of window w: owners[owner_first[w]:owner_first[w + 1]]
    owners: np.ndarray


def phrases_of(items: list[tuple[str | None, str | None]], width: int) -> Phrases | None:
    """Windows of ``width`` words; an item of fewer words is one window, one without words none."""
    names = sorted({name for name, _ in items if name is not None})
    place = {name: k for k, name in enumerate(names)}
    texts = pa.array([text for _, text in items], pa.string())
    hashes, keys, cuts, owners = [], [], [], []
    for at, words in text_words(texts, LETTERED):
        windows = window_hashes(words.hashes, width)
        for row in range(words.rows):
            low, high = int(words.first[row]), int(words.first[row + 1])
            if high == low:
                continue
            own = words.hashes[low:high]
            found = windows[low : high - width + 1] if high - low >= width else window_hashes(own, high - low)
            for k, key in enumerate(found.tolist()):
                keys.append(key)
                cuts.append(own[k : k + width])
                owners.append(place.get(items[at + row][0], -1))
            hashes.append(own)
    if not keys:
        return None
    vocabulary = np.unique(np.concatenate(hashes))
    _, firsts, which = np.unique(np.array(keys, np.uint64), return_index=True, return_inverse=True)
    table = np.zeros((len(firsts), width), np.int64)
    lengths = np.zeros(len(firsts), np.int64)
    for w, k in enumerate(firsts):
        lengths[w] = len(cuts[k])
        table[w, : len(cuts[k])] = np.searchsorted(vocabulary, cuts[k]) + FIRST
    pairs = np.unique(np.stack([which, np.array(owners)], axis=1), axis=0)
    pairs = pairs[pairs[:, 1] >= 0]
    return Phrases(vocabulary, table, lengths, names, np.searchsorted(pairs[:, 0], np.arange(len(firsts) + 1)), pairs[:, 1])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a symbol array that ends with a smallest symbol of its own, by prefix doubling."""
    n, step = len(text), 1
    rank = text.astype(np.int64)
    while True:
        key = rank * (int(rank.max()) + 2)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(0, np.diff(key[order]) != 0))
        step *= 2
        if step >= n or int(rank.max()) == n - 1:
            return order


class Wavelet:
    """Wavelet matrix: ranks of any symbol at any place in as many steps as symbols have bits."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.bits = range(max(int(symbols - 1).bit_length(), 1) - 1, -1, -1)
        self.ones, self.zeros = [], []
        for bit in self.bits:
            up = (text >> bit) & 1 == 1
            self.ones.append(np.append(0, np.cumsum(up)))
            self.zeros.append(int(len(text) - self.ones[-1][-1]))
            text = np.concatenate([text[~up], text[up]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        low = np.zeros_like(at)
        for bit, ones, zeros in zip(self.bits, self.ones, self.zeros, strict=True):
            up = (symbol >> bit) & 1 == 1
            at = np.where(up, zeros + ones[at], at - ones[at])
            low = np.where(up, zeros + ones[low], low - ones[low])
        return at - low

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for bit, ones, zeros in zip(self.bits, self.ones, self.zeros, strict=True):
            up = ones[at + 1] > ones[at]
            symbol |= up.astype(np.int64) << bit
            at = np.where(up, zeros + ones[at], at - ones[at])
        return symbol


class FMIndex:
    """Burrows-Wheeler transform of a shard in a wavelet matrix, and every sixteenth suffix position."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 16):
        suffixes = suffix_array(text)
        self.wavelet = Wavelet(text[suffixes - 1], symbols)
        self.before = np.append(0, np.cumsum(np.bincount(text, minlength=symbols)))
        sampled = suffixes % sample == 0
        self.sampled, self.place, self.positions = sampled, np.cumsum(sampled) - 1, suffixes[sampled]
        self.size = len(text)

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.wavelet.rank(symbol, at)

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every occurrence of every window."""
        alive = np.arange(len(windows))
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), self.size)
        for k in range(int(lengths.max())):
            todo = alive[lengths[alive] > k]
            symbol = windows[todo, lengths[todo] - 1 - k]
            low[todo], high[todo] = self.step(symbol, low[todo]), self.step(symbol, high[todo])
            alive = alive[high[alive] > low[alive]]
        counts = high[alive] - low[alive]
        rows = np.repeat(low[alive], counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(alive, counts), self.locate(rows)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, steps, todo = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), np.arange(len(rows))
        rows = rows.copy()
        while len(todo):
            done = self.sampled[rows[todo]]
            out[todo[done]] = self.positions[self.place[rows[todo[done]]]] + steps[todo[done]]
            todo = todo[~done]
            steps[todo] += 1
            rows[todo] = self.step(self.wavelet.access(rows[todo]), rows[todo])
        return out


def occurrences(words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(window, index of its first word) of all occurrences in a shard.

    The index holds the runs of benchmark words that are as long as the shortest window; nothing else can hold a
    window.  What lies between two runs, and every end of a row, becomes one gap symbol.
    """
    none = np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(phrases.vocabulary, words.hashes), len(phrases.vocabulary) - 1)
    known = phrases.vocabulary[at] == words.hashes
    fresh = known.copy()
    fresh[1:] &= ~known[:-1] | (words.row[1:] != words.row[:-1])
    begins = np.flatnonzero(fresh)
    if not len(begins):
        return none, none
    run = np.cumsum(fresh) - 1
    long_enough = np.bincount(run[known], minlength=len(begins)) >= phrases.lengths.min()
    taken = np.flatnonzero(known & long_enough[run])
    if not len(taken):
        return none, none
    shift = np.cumsum(fresh[taken])  # one gap before each run
    text = np.full(len(taken) + int(shift[-1]) + 1, GAP, np.int64)
    where = np.arange(len(taken)) + shift
    text[where] = at[taken] + FIRST
    text[-1] = END
    word = np.full(len(text), -1, np.int64)
    word[where] = taken
    window, start = FMIndex(text, len(phrases.vocabulary) + FIRST).search(phrases.windows, phrases.lengths)
    return window, word[start]


def benchmark_blocks(benchmark: DataFrame, item: str, text: str, width: int, block_bytes: int) -> list:
    """Broadcasts of the benchmark in blocks of about ``block_bytes``; only one is in the driver's memory at a time."""
    out, block, size = [], [], 0
    context = benchmark.sparkSession.sparkContext
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).orderBy("i", "t").toLocalIterator()
    for row in rows:
        block.append((row.i, row.t))
        size += len(row.t or "")
        if size >= block_bytes:
            out.append(phrases_of(block, width))
            block, size = [], 0
    out.append(phrases_of(block, width))
    return [context.broadcast(p) for p in out if p is not None]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item: str = "item_id", item_text: str = "text",
    width: int = 13, share: int = 20, block_bytes: int = 4 << 20,
) -> DataFrame:
    """Per row ``doc`` (struct of ``keep``), ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``spans``.

    The rows of a task form shards of about 2 MB; each shard gets an FM-index over words, in which the windows of
    the benchmark are searched backwards and located.  ``spans`` are the merged stretches to remove, as UTF-8 byte
    offsets; a row is ``contaminated`` if hit words make up 1 / ``share`` of its words or more.

    The benchmark is broadcast in blocks of ``block_bytes`` that tasks open one after the other, so memory
    does not grow with it.  A window that two blocks share counts for the items of both.

    A null or empty text has no words and is clean.  An item with a null id marks words but is not listed; items
    that repeat an id are one item.  Without benchmark windows every row is clean.
    """
    blocks = benchmark_blocks(benchmark, item, item_text, width, block_bytes)

    def start():
        def work(batch):
            n = batch.num_rows
            n_words, n_hit = np.zeros(n, np.int64), np.zeros(n, np.int64)
            items, spans = [[] for _ in range(n)], [[] for _ in range(n)]
            for first_row, words in text_words(batch.column("_text"), LETTERED, limit=2 << 20):
                n_words[first_row : first_row + words.rows] = np.diff(words.first)
                edges = np.zeros(len(words.starts) + 1, np.int64)
                for handle in blocks:
                    phrases = handle.value
                    window, word = occurrences(words, phrases)
                    if not len(window):
                        continue
                    np.add.at(edges, word, 1)
                    np.add.at(edges, word + phrases.lengths[window], -1)
                    for row, w in np.unique(np.stack([words.row[word], window], axis=1), axis=0).tolist():
                        owners = phrases.owners[phrases.owner_first[w] : phrases.owner_first[w + 1]]
                        items[first_row + row] += [phrases.items[k] for k in owners]
                hit = np.cumsum(edges)[:-1] > 0
                if hit.any():
                    n_hit[first_row : first_row + words.rows] = np.bincount(words.row[hit], minlength=words.rows)
                    ahead = np.append(False, hit[:-1] & (words.row[1:] == words.row[:-1]))[: len(hit)]
                    after = np.append(hit[1:] & (words.row[1:] == words.row[:-1]), False)[: len(hit)]
                    origin = words.row_starts
                    for a, b in zip(np.flatnonzero(hit & ~ahead), np.flatnonzero(hit & ~after), strict=True):
                        row = int(words.row[a])
                        spans[first_row + row].append({"start": int(words.starts[a] - origin[row]), "stop": int(words.ends[b] - origin[row])})
            listed = [sorted(set(x)) for x in items]
            digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in listed]
            return n_words, n_hit, [len(x) for x in listed], digest, (n_hit > 0) & (share * n_hit >= n_words), spans

        return work

    outputs = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start:long,stop:long>>"
    return annotate(docs, keep, {"_text": F.col(text)}, outputs, start)
