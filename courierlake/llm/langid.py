"""Language identification by rank-order n-gram profiles.

A language's profile is the ranking of its most frequent character n-grams
over all training texts; a document's own ranking is compared to each profile
by the out-of-place distance and the nearest language wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PROFILE_GRAMS = 1000     # ranks of a language profile
DOCUMENT_GRAMS = 400     # ranks of a document
FLUSH_GRAMS = 500_000    # counts a task holds before it adds them up
CHUNK_CHARS = 1 << 20    # a longer text is counted in runs cut at a blank
UNKNOWN = "und"
BLANK = 1                # code of the blank that frames a word; no letter has it


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _chunks(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        cut = text.find(" ", at + CHUNK_CHARS)
        cut = len(text) if cut < 0 else cut
        yield text[at:cut]
        at = cut


def _add(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, their counts added up."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams (n = 1 to 3) of a whole text's lower-cased words, each word
    framed by blanks, as keys of 21 bits a character (a blank is 1), with their
    counts. A lone blank is no gram, and no gram spans two words."""
    parts = []
    for chunk in _chunks(text or ""):
        code = np.frombuffer(chunk.lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
        code = np.concatenate(([BLANK], np.where(_letters()[code], code, BLANK), [BLANK]))
        code = code[np.concatenate(([True], (code[1:] != BLANK) | (code[:-1] != BLANK)))]
        two = (code[:-1] << 21) | code[1:]
        three = (two[:-1] << 21 | code[2:])[code[1:-1] != BLANK]
        keys = np.sort(np.concatenate((code[code != BLANK], two[two != (BLANK << 21 | BLANK)], three)))
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else []
        parts.append((keys[first], np.diff(np.append(first, len(keys)))) if len(keys)
                     else (keys, keys))
    if len(parts) == 1:
        return parts[0]
    empty = np.zeros(0, np.int64)
    return _add(np.concatenate([empty, *(k for k, _ in parts)]),
                np.concatenate([empty, *(n for _, n in parts)]))


def gram_text(key: int) -> str:
    """The n-gram of a key, blanks for the word frame."""
    out = ""
    while key:
        out = (" " if key & 0x1FFFFF == BLANK else chr(key & 0x1FFFFF)) + out
        key >>= 21
    return out


def profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
             size: int = PROFILE_GRAMS) -> DataFrame:
    """(lang, gram, rank) of each language's ``size`` most frequent grams over
    all rows; ties by gram. Rows without a language or text are not used."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        n_held = 0

        def flush() -> pd.DataFrame:
            rows = [(lang, *row) for lang, own in held.items()
                    for row in zip(*[x.tolist() for x in _add(*map(np.concatenate, zip(*own)))])]
            held.clear()
            return pd.DataFrame(rows, columns=["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                own = gram_counts(text)
                held.setdefault(lang, []).append(own)
                n_held += len(own[0])
                if n_held > FLUSH_GRAMS:
                    yield flush()
                    n_held = 0
        yield flush()

    rows = (docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .where("lang IS NOT NULL AND text IS NOT NULL"))
    counts = (rows.mapInPandas(count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return (counts.withColumn("rank", rank).where(F.col("rank") <= size)
            .select("lang", "gram", "rank"))


class Ranker:
    """Profiles as one rank matrix; grams outside a profile rank at its size."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.langs = sorted({lang for lang, _, _ in rows})
        self.keys = np.array(sorted({g for _, g, _ in rows}), np.int64)
        self.size = size
        self.ranks = np.full((len(self.langs), len(self.keys)), -1, np.int32)
        row = {lang: i for i, lang in enumerate(self.langs)}
        for lang, gram, rank in rows:
            self.ranks[row[lang], np.searchsorted(self.keys, gram)] = rank - 1

    def predict(self, text: str | None, top: int = DOCUMENT_GRAMS) -> tuple[str, float]:
        keys, counts = gram_counts(text)
        if not len(keys) or not self.langs:
            return UNKNOWN, 0.0
        best = keys[np.lexsort((keys, -counts))[:top]]
        at = np.minimum(np.searchsorted(self.keys, best), len(self.keys) - 1)
        ranks = np.where(self.keys[at] == best, self.ranks[:, at], -1)
        # A document has fewer ranks than a profile: spread them over it.
        own = np.arange(len(best)) * (self.size / max(top, 1))
        apart = np.where(ranks < 0, self.size, np.minimum(np.abs(ranks - own), self.size))
        total = apart.sum(axis=1)
        k = int(np.argmin(total))
        return self.langs[k], float(1 - total[k] / (self.size * len(best)))


def identify(docs: DataFrame, profile: DataFrame, text_col: str = "text",
             out: str = "language", size: int = PROFILE_GRAMS) -> DataFrame:
    """``docs`` with a struct column ``out``: lang_pred, score (0 to 1, one
    minus the mean out-of-place distance over its largest value).

    One row out for each row in. Null text or text without a letter, or no
    profile at all: ``und`` with score 0. Ties go to the first language by
    name. The profiles (at most ``size`` rows for each language) are the only
    thing that the driver holds.
    """
    rows = [tuple(r) for r in profile.select("lang", "gram", "rank").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(Ranker(rows, size))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ranker = shared.value
        for batch in batches:
            yield pd.DataFrame([ranker.predict(t) for t in batch], columns=["lang_pred", "score"])

    # Nondeterministic to the planner, which would otherwise evaluate it a second
    # time, in workers of its own, below a filter on the prediction.
    return docs.withColumn(out, predict.asNondeterministic()(F.col(text_col)))


def held_out(id_col: str = "doc_id"):
    """Documents kept from training: crc32 of the id as text divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
