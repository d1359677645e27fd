"""Language identification by compression: the dictionary that a text compresses best with names its language."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.arrow import annotate, fold
from episodica.llm.dictionaries import Compressors, sample_dictionaries

UNDETERMINED = "und"
LETTER = re.compile("[A-Za-z]")
SHORT = 128


def has_letter(text: str) -> bool:
    return bool(LETTER.search(text)) or any(map(str.isalpha, text))


def measured(text: str) -> list[bytes]:
    """What is compressed for a text: itself, and for a short one also its ends from each word on.

    A short text's sizes differ by a byte or two; summed over its ends they tell languages apart more finely.
    """
    data = text.lower().encode("utf-8", "replace")
    return [data] + ([data[m.end() :] for m in re.finditer(rb"\s+", data) if m.end() < len(data)] if len(data) < SHORT else [])


def coverage(text: str, vocabularies: list[set[bytes]]) -> list[int]:
    """Bytes of a text's words that stand as words in each dictionary."""
    found = text.lower().encode("utf-8", "replace").split()
    return [sum(len(w) for w in found if w in words) for words in vocabularies]


def identify_language(
    docs: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", label: str = "lang",
    folds: int = 4, held: int = 2, block: int = 2048, narrow: float = 0.002,
) -> DataFrame:
    """Per row ``doc`` (struct of ``keep``), ``held_out``, ``lang_pred``, ``score`` and ``rejected``.

    One raw-content dictionary of 128 KB per label is sampled from rows outside the held-out fold; every whole text
    is lower-cased and compressed block by block with each.  The smallest size wins, ties go to the name that
    sorts first.  ``score`` is the margin over the runner-up's size (1 with one label only).  A text below 128 bytes,
    too short to compress, goes by the share of its bytes whose words stand in a dictionary if sizes tie.
    ``rejected`` marks a margin below ``narrow`` and every undetermined text.

    A null text, a text without letters, or a table without labelled rows gives ``und`` with score 0.  A null key
    is not held out and not learned from.  Repeated rows give repeated results.
    """
    learned = sample_dictionaries(
        docs.where(fold(docs[key], folds) != held), F.col(key), F.lower(F.col(text)), F.col(label)
    )
    learned = dict(sorted(learned.items()))

    def start():
        models = Compressors(learned)
        vocabularies = [set(content.split()) for content in learned.values()]

        def work(batch):
            names, scores, refused = [], [], []
            for value in batch.column("_text").to_pylist():
                if value is None or not models.names or not has_letter(value):
                    name, score = UNDETERMINED, 0.0
                else:
                    totals = map(sum, zip(*[models.sizes(part, block) for part in measured(value)], strict=True))
                    sizes = sorted(zip(totals, models.names, strict=True))
                    name = sizes[0][1]
                    score = 1.0 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0
                    if score == 0 and len(value) < SHORT:
                        shares = sorted(zip((-n for n in coverage(value, vocabularies)), models.names, strict=True))
                        name, score = shares[0][1], (shares[1][0] - shares[0][0]) / len(value.encode())
                names.append(name)
                scores.append(score)
                refused.append(name == UNDETERMINED or score < narrow)
            return batch.column("held_out"), names, scores, refused

        return work

    inputs = {"_text": F.col(text), "held_out": F.coalesce(fold(F.col(key), folds) == held, F.lit(False))}
    return annotate(docs, keep, inputs, "held_out boolean, lang_pred string, score double, rejected boolean", start)
