"""Bounded-space online packing of tokenised documents into sequences.

Each partition packs its documents as they come into a fixed number of open
windows: a piece goes to the window it fits best; when it fits none, the
fullest window takes as much of it as it holds and is emitted. What the
partitions leave open is merged level by level, a bounded number of
partitions in each task, so that one short sequence remains at the end.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import staged

WINDOW = 4096
OPEN_WINDOWS = 64
MERGE_FAN_IN = 16
EOD = 2
TOKENIZER = "word_bpe_49k.json"
# Words whose ids a worker remembers at a time, and the longest word kept.
CACHE_WORDS = 800_000
CACHE_BYTES = 64
_STOPS = b".,"
# A window with less room than this is emitted as it is.
SLACK = 16

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_ROWS = f"{PIECES}, slot long, ids binary"


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class WordIds(dict):
    """Ids of a word as little-endian bytes.

    The tokenizer drops white space and never merges across it, so the ids of
    a text are those of its words in order; each word is encoded once. A word
    of Latin letters is a single pre-token, so it goes to the merges directly;
    any other word takes the whole tokenizer.
    """

    def __init__(self, tok):
        super().__init__()
        self.tok, self.merge, self.letters = tok, tok.model.tokenize, _byte_letters()
        self.packed = [np.uint32(i).tobytes() for i in range(tok.get_vocab_size())]

    def _encode(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters: each byte stands for itself
            return b"".join([self.packed[t.id] for t in self.merge(word.lower().decode("ascii"))])
        text = word.decode("utf-8", "replace")
        if text.isalpha() and max(text) < "\u0250" and "\u0130" not in text:
            units = "".join([self.letters[b] for b in text.lower().encode()])
            return b"".join([self.packed[t.id] for t in self.merge(units)])
        return b"".join([self.packed[i] for i in self.tok.encode(text, add_special_tokens=False).ids])

    def __missing__(self, word: bytes) -> bytes:
        if word[-1] in _STOPS and word[-2:-1].isalpha():
            # A letter before a full stop or comma always ends its pre-token.
            out = self[word[:-1]] + self[word[-1:]]
        else:
            out = self._encode(word)
        if len(word) <= CACHE_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = out
        return out


# Per worker process, by tokenizer file: tasks that follow find the words known.
_KNOWN: dict[str, WordIds] = {}


def known_words(path: str) -> WordIds:
    if path not in _KNOWN:
        from tokenizers import Tokenizer

        _KNOWN[path] = WordIds(Tokenizer.from_file(path))
    return _KNOWN[path]


def tokenize(text: bytes, ids: WordIds) -> np.ndarray:
    """Ids of the whole text, then the end-of-document id."""
    end = np.array([EOD], "<u4").tobytes()
    return np.frombuffer(b"".join([*map(ids.__getitem__, text.split()), end]), "<u4")


class Packer:
    """Open windows of one task. A piece is (doc_id, start, doc_tokens, ids)."""

    def __init__(self, first_id: int, window: int, n_open: int):
        self.next_id, self.window, self.n_open = first_id, window, n_open
        self.open: list[list] = []  # [used, pieces]
        self.done: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, total, ids in pieces:
            self.done.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total,
                              self.next_id, at, -1, None))
            at += len(ids)
        self.next_id += 1

    def add(self, doc, start: int, total: int, ids: np.ndarray) -> None:
        while len(ids) >= self.window:
            self._emit([(doc, start, total, ids[:self.window])])
            start, ids = start + self.window, ids[self.window:]
        while len(ids):
            n = len(ids)
            fits = [w for w in self.open if w[0] + n <= self.window]
            if fits:
                best = max(fits, key=lambda w: w[0])
                best[0] += n
                best[1].append((doc, start, total, ids))
                if best[0] == self.window:
                    self.open.remove(best)
                    self._emit(best[1])
                return
            if len(self.open) < self.n_open:
                self.open.append([n, [(doc, start, total, ids)]])
                return
            full = max(self.open, key=lambda w: w[0])
            self.open.remove(full)
            room = self.window - full[0]
            if room >= SLACK:
                full[1].append((doc, start, total, ids[:room]))
                start, ids = start + room, ids[room:]
            self._emit(full[1])

    def left(self, slot: int) -> list[tuple]:
        """Pieces of the open windows, fullest first, with their ids."""
        return [(doc, start, len(ids), 0, total, -1, -1, slot, ids.tobytes())
                for _, pieces in sorted(self.open, key=lambda w: -w[0])
                for doc, start, total, ids in pieces]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in _ROWS.split(", ")])
    return out.astype({"doc_id": "Int64"})


def _number(x):
    return None if x is None or x is pd.NA or x != x else int(x)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         tokenizer_file: str | None = None, window: int = WINDOW,
         n_open: int = OPEN_WINDOWS, fan_in: int = MERGE_FAN_IN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    Null or empty text: the end-of-document id alone. A document longer than a
    window is cut into full windows and a rest. Rows that repeat a doc_id, or
    have none, are packed as documents of their own. An empty table gives no
    rows; other columns are ignored. All but one sequence are within SLACK
    tokens of ``window``. ``tokenizer_file`` must exist on every executor; the
    default is the public tokenizers' word BPE.
    """
    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        known = known_words(tokenizer_file or public_tokenizers.path(TOKENIZER))
        task = TaskContext.get().partitionId()
        packer = Packer(task << 32, window, n_open)
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = tokenize(text or b"", known)
                packer.add(_number(doc), 0, len(ids), ids)
            yield _frame(packer.done)
            packer.done = []
        yield _frame(packer.left(task))

    source = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    pieces = staged(source.mapInPandas(first, _ROWS), "packed")
    finished = [pieces.where("slot < 0")]
    rest = pieces.where("slot >= 0")
    slots = (rest.agg(F.max("slot")).first()[0] or 0) + 1
    level = 0
    while True:
        level, slots = level + 1, math.ceil(slots / fan_in)
        merged = staged(_merge(rest, level, slots == 1, window, fan_in), f"merged{level}")
        finished.append(merged.where("slot < 0"))
        rest = merged.where("slot >= 0")
        if slots == 1:
            break
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out.select(*[c.split()[0] for c in PIECES.split(", ")])


def _merge(rest: DataFrame, level: int, last: bool, window: int, fan_in: int) -> DataFrame:
    """Merge the open windows of ``fan_in`` tasks: at most fan_in * n_open windows."""
    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        bucket = int(key[0])
        packer = Packer((level << 56) + (bucket << 32), window, 1)
        frame = frame.sort_values(["slot", "doc_id", "start"], kind="stable")
        for r in frame.itertuples(index=False):
            packer.add(_number(r.doc_id), r.start, r.doc_tokens, np.frombuffer(r.ids, "<u4"))
        if last:
            for _, pieces in packer.open:
                packer._emit(pieces)
            return _frame(packer.done)
        return _frame(packer.done + packer.left(bucket))

    return rest.groupBy(F.floor(F.col("slot") / fan_in).alias("bucket")).applyInPandas(merge, _ROWS)
