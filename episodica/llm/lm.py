"""Log probabilities of whole texts: smoothed unigram counts, and a gated recurrent model trained on all partitions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm import gru
from episodica.llm.arrow import annotate, fold
from episodica.llm.words import SPACED, U, text_words
from episodica.sources.shared import store

END = U(1)  # stands for the end of a text; no word is expected to hash to it
SEGMENT = 64


def with_ends(words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a block with an end after each row, and where each row starts."""
    first = words.first + np.arange(words.rows + 1)
    out = np.full(int(first[-1]), END, np.uint64)
    out[np.arange(len(words.hashes)) + words.row] = words.hashes
    return out, first


def token_counts(docs: DataFrame, text: str) -> DataFrame:
    """``hash`` and ``n`` of all tokens: counted per task first, then added up."""

    def run(batches):
        for batch in batches:
            held, size = [], 0

            def counted():
                values, n = np.unique(np.concatenate(held), return_counts=True)
                return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], names=["hash", "n"])

            for _, words in text_words(batch.column("_text"), SPACED):
                tokens, _ = with_ends(words)
                held.append(tokens)
                size += len(tokens)
                if size > 4_000_000:
                    yield counted()
                    held, size = [], 0
            if held:
                yield counted()

    found = docs.select(F.col(text).alias("_text")).mapInArrow(run, "hash long, n long")
    return found.groupBy("hash").agg(F.sum("n").alias("n"))


def segments_of(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Texts cut into runs of 64 tokens, one a row, -1 behind their end; ``first`` is where each text starts."""
    lengths = np.diff(first)
    runs = -(-lengths // SEGMENT)
    heads = np.repeat(first[:-1], runs) + SEGMENT * (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs))
    left = np.repeat(first[1:], runs) - heads
    at = heads[:, None] + np.arange(SEGMENT)
    return np.where(np.arange(SEGMENT) < left[:, None], tokens[np.minimum(at, len(tokens) - 1)], -1)


def most_frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes (sorted) and counts of words with the least count that keeps them to ``most`` or fewer; that count."""
    binned = counts.groupBy(F.floor(F.log2("n") * 8).alias("bin")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least"))
    total, least = 0, None
    for row in sorted(binned.collect(), key=lambda r: -r.bin):
        total += row.words
        if total > most:
            break
        least = row.least
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), 1 << 62
    table = counts.where(F.col("n") >= least).toPandas()
    hashes = table["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], table["n"].to_numpy(np.int64)[order], int(least)


def look_up(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash in a sorted table, -1 if it is not there."""
    if not len(table):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return np.where(table[at] == hashes, at, -1)


def vocabulary(hashes: np.ndarray, counts: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Per known word its symbol (by falling frequency, else OTHER), and the number of tokens of each symbol."""
    order = np.lexsort((hashes, -counts))[: gru.OTHER]
    symbols = np.full(len(hashes), gru.OTHER)
    symbols[order] = np.arange(len(order))
    sizes = np.zeros(gru.SYMBOLS)
    sizes[: len(order)] = counts[order]
    sizes[gru.OTHER] = total - counts[order].sum()
    return symbols, sizes


def segment_table(docs: DataFrame, text: str, known, symbols: np.ndarray, rounds: int) -> DataFrame:
    """``turn`` and ``segments`` (rows of 64 symbols of two bytes): the texts as the network reads them, each read once.

    Of a task's segments, every ``rounds``-th belongs to a round, so each segment of the table is learned from once.
    A table row holds the segments of one block of texts; texts stay in the task that reads them.
    """
    shared = docs.sparkSession.sparkContext.broadcast((known, symbols))

    def run(batches):
        (table, names), seen = shared.value, 0
        for batch in batches:
            for _, words in text_words(batch.column("_text"), SPACED):
                tokens, first = with_ends(words)
                place = look_up(table, tokens)
                rows = segments_of(np.where(place >= 0, names[place] if len(names) else 0, gru.OTHER).astype(np.int16), first)
                parts = [rows[(seen + np.arange(len(rows))) % rounds == turn].astype("<i2").tobytes() for turn in range(rounds)]
                seen += len(rows)
                yield pa.RecordBatch.from_arrays([pa.array(range(rounds), pa.int32()), pa.array(parts, pa.binary())], names=["turn", "segments"])

    return store(docs.select(F.col(text).alias("_text")).mapInArrow(run, "turn int, segments binary"), "segments")


def fit(segments: DataFrame, weights: np.ndarray, rounds: int, chunk: int, lanes: int, least_steps: int, rate: float) -> np.ndarray:
    """Rounds of training over all segments: every task trains a copy on its share, the copies are averaged.

    No segment is moved to its like: hot copies stay where their texts were read.  A task holds ``chunk`` segments and
    a table row more.  A copy has ``gru.SIZE`` numbers; they are averaged by a distributed aggregate, so the driver
    gets one model.
    """
    for turn in range(rounds):
        shared = segments.sparkSession.sparkContext.broadcast(weights)

        def run(batches, shared=shared, turn=turn):
            made, optimiser, held, size, learned = shared.value, gru.Adam(rate), [], 0, 0

            def trained():
                steps = least_steps if not learned else 1
                return gru.train(made, np.concatenate(held), 32, lanes, steps, rate, turn, optimiser=optimiser)

            for batch in batches:
                for part in batch.column("segments"):
                    held.append(np.frombuffer(part.as_buffer(), "<i2").reshape(-1, SEGMENT))
                    size += len(held[-1])
                    if size >= chunk:
                        made = trained()
                        learned, held, size = learned + size, [], 0
            if size:
                made = trained()
                learned += size
            if learned:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(gru.SIZE, dtype=np.int32)), pa.array(made.astype(np.float64) * learned), pa.array(np.full(gru.SIZE, learned, np.int64))],
                    names=["place", "weighted", "rows"],
                )

        copies = segments.where(F.col("turn") == turn).select("segments").mapInArrow(run, "place int, weighted double, rows long")
        mean = copies.groupBy("place").agg((F.sum("weighted") / F.sum("rows")).alias("mean")).toPandas()
        if len(mean):
            weights = mean.sort_values("place")["mean"].to_numpy().astype(np.float32)
        shared.destroy()
    return weights


def score_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10, held: int = 0,
    table_words: int = 1 << 19, rounds: int = 3, chunk: int = 8192, lanes: int = 512, least_steps: int = 48, rate: float = 0.01,
) -> DataFrame:
    """Per row: the key, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Tokens are the words of the lower-cased text and one end.  Token counts are taken over all texts outside the
    held-out fold.  ``base_score`` sums log10((c + 0.1) / (N + 0.1 (V + 1))) over the tokens.

    ``score`` is log10 of the probability that a gated recurrent network gives to the whole text, its state carried
    from the first token to the last.  It predicts 1,023 symbols, the most frequent words and the end, and one for
    all other words, which share its probability in proportion to their smoothed counts.  It is trained by
    truncated backpropagation on all training texts, in segments of 64 tokens; tasks train copies on their partitions'
    texts, which are averaged after each of ``rounds`` rounds.  Each segment is learned from in one round.

    Counts of up to ``table_words`` frequent words are broadcast (8 MB); the counts of all rarer ones are joined, so
    that no frequent word becomes a hot key.  Null texts count as empty (an end only).  A null key is neither held
    out nor learned from.  Repeated rows give repeated results.  With nothing to learn from all counts are 0, and
    ``score`` is that of the untrained network, which gives all symbols the same share.
    """
    spark = docs.sparkSession
    learned = docs.where(fold(docs[key], folds) != held)
    counts = store(token_counts(learned, text), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    known, sizes, least = most_frequent(counts, table_words)
    symbols, symbol_sizes = vocabulary(known, sizes, total)
    inside = symbols != gru.OTHER
    weights = gru.untrained(symbol_sizes)
    segments = segment_table(learned, text, known[inside], symbols[inside], rounds)
    weights = fit(segments, weights, rounds, chunk, lanes, least_steps, rate)
    size = total + 0.1 * (distinct + 1)
    other_mass = 1 - float((sizes[inside] + 0.1).sum()) / size
    tables = spark.sparkContext.broadcast((known, np.log10(sizes + 0.1), symbols, weights))

    def start():
        table, logs, names, model = tables.value

        def work(batch):
            n = batch.num_rows
            tokens_of, found, sums, other_logs, others = (np.zeros(n) for _ in range(5))
            streams, firsts, rare = [], [np.zeros(1, np.int64)], [[] for _ in range(n)]
            for at, words in text_words(batch.column("_text"), SPACED):
                tokens, first = with_ends(words)
                row = np.repeat(np.arange(words.rows), np.diff(first))
                here = slice(at, at + words.rows)
                place = look_up(table, tokens)
                seen = place >= 0
                log = np.where(seen, logs[place] if len(logs) else 0.0, 0.0)
                symbol = np.where(seen, names[place] if len(names) else 0, gru.OTHER)
                other = symbol == gru.OTHER
                tokens_of[here] = np.diff(first)
                found[here] = np.bincount(row, weights=seen, minlength=words.rows)
                sums[here] = np.bincount(row, weights=log, minlength=words.rows)
                other_logs[here] = np.bincount(row, weights=np.where(other, log, 0.0), minlength=words.rows)
                others[here] = np.bincount(row, weights=other, minlength=words.rows)
                unseen = np.flatnonzero(~seen)
                cuts = np.searchsorted(row[unseen], np.arange(words.rows + 1))
                hashes = tokens[unseen].view(np.int64)
                for k in np.flatnonzero(np.diff(cuts)).tolist():
                    rare[at + k] = hashes[cuts[k] : cuts[k + 1]]
                streams.append(symbol.astype(np.int16))
                firsts.append(first[1:] + firsts[-1][-1])
            model_log = gru.score(model, np.concatenate(streams), np.concatenate(firsts)) / np.log(10)
            return batch.column("held_out"), tokens_of.astype(np.int64), found.astype(np.int64), sums, other_logs, others, model_log, rare

        return work

    outputs = "held_out boolean, n_tokens long, n_found long, sums double, other_logs double, others double, model double, rare array<long>"
    inputs = {"_text": F.col(text), "held_out": F.coalesce(fold(F.col(key), folds) == held, F.lit(False))}
    scored = annotate(docs.select(key, text), [key], inputs, outputs, start)
    scored = store(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode("rare").alias("hash")).groupBy("row", "hash").agg(F.count(F.lit(1)).alias("times"))
    rest = counts.where(F.col("n") < least)
    joined = rare.join(rest, "hash", "left")
    per_row = joined.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("rare_logs"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
    )
    both = scored.drop("rare").join(per_row, "row", "left").na.fill(0, ["rare_logs", "rare_known"])
    denominator = float(np.log10(size))
    share = float(np.log10(max(other_mass, 1e-300))) if other_mass > 0 else 0.0
    other = F.col("other_logs") + F.col("rare_logs") - F.col("others") * (denominator + share)
    return both.select(
        F.col("doc")[key].alias(key), "held_out", "n_tokens", (F.col("n_found") + F.col("rare_known")).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("sums") + F.col("rare_logs") - F.col("n_tokens") * denominator).alias("base_score"),
        (F.col("model") + other).alias("score"),
    )
