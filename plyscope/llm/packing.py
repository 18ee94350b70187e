"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

``token_pieces`` encodes texts and cuts them at the window size. ``pack`` puts the pieces into windows: a piece as
long as a window is one by itself; the others are dealt into groups of about ``group_items`` pieces, each of
which is divided into near-equal windows by differencing: every piece starts as a partial partition, and the two
partial partitions with the largest imbalance are merged again and again, the fullest windows of the one with the
emptiest of the other. When the fullest window of a result exceeds the capacity, the number of windows rises.

NULL text counts as empty; an empty text is the end id alone. Repeated rows and repeated ids are separate
documents. Other columns of the pieces are carried along.
"""

from __future__ import annotations

import functools
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from plyscope.llm.common import stored, tasks_for

CAPACITY = 2048
END_ID = 1
GROUP_ITEMS = 256
#: Longest piece: short ones balance better. Windows still hold whole documents up to this size.
PIECE_TOKENS = 512
#: Words that a task keeps with their ids; others are encoded where they occur.
CACHED_WORDS = 400_000
#: Words with marks behind them are kept among the first so many.
MARKED_WORDS = 50_000
WINDOW_BITS = 20

#: Letters beyond ASCII of two bytes, small ones alone and all, between ASCII letters.
_PLAIN = re.compile(rb"[a-z]*(?:\xc3[\x9f-\xb6\xb8-\xbf][a-z]*)+")
_LETTERS = re.compile(rb"[a-z]*(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][a-z]*)+")
#: ASCII marks; behind letters they are tokens apart from them.
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


class _Known(dict):
    """Ids of words; a word that is not there is asked for."""

    def __init__(self, missing):
        super().__init__()
        self.missing = missing

    def __missing__(self, word: bytes) -> bytes:
        return self.missing(word)


class WordEncoder:
    """Ids of texts by a tokenizer that never looks across white space: looked up word by word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.stand_in = {b: self._stand_in(b) for b in range(256)}
        self.written = [n.to_bytes(4, "little") for n in range(self.tokenizer.get_vocab_size())]
        self.known = _Known(self._missing)

    @staticmethod
    @functools.cache
    def _stand_in(byte: int) -> str:
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        return chr(byte) if byte in shown else chr(256 + [b for b in range(256) if b not in shown].index(byte))

    def word(self, word: bytes) -> bytes:
        # letters that no rule changes or splits are merged right away
        if word.isalpha() and word.islower():
            spelled = word.decode("ascii")
        elif _PLAIN.fullmatch(word):
            spelled = "".join([self.stand_in[b] for b in word])
        else:
            ids = self.tokenizer.encode(word.decode("utf-8"), add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        written = self.written
        return b"".join([written[t.id] for t in self.model.tokenize(spelled)])

    def text(self, data: bytes) -> bytes:
        """Little-endian ids of a text in UTF-8."""
        # special tokens are written in small letters; changing case must not make one
        words = (data if b"<|" in data else data.lower()).split()
        return b"".join(map(self.known.__getitem__, words))

    def _missing(self, word: bytes) -> bytes:
        known = self.known
        bare = word.rstrip(_MARKS)
        if len(bare) < len(word) and ((bare.isalpha() and bare.islower()) or _LETTERS.fullmatch(bare)):
            # cheap to put together, so room is kept for words
            ids, limit = known[bare] + known[word[len(bare) :]], MARKED_WORDS
        else:
            ids, limit = self.word(word), CACHED_WORDS
        if len(known) < limit:
            known[word] = ids
        return ids


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def token_pieces(
    df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, piece: int = PIECE_TOKENS
) -> DataFrame:
    """Pieces of every document: key, start, length, ids (little-endian 32-bit), doc_tokens with the end id.

    Full windows are cut off first; what is left is cut into equal pieces of at most ``piece`` tokens.
    """
    rows = df.select(F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_text"))
    fields = [T.StructField("_key", rows.schema[0].dataType)] + [T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens")]
    out = T.StructType([*fields, T.StructField("ids", T.BinaryType())])
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches):
        encoder = word_encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                source, starts, lengths, totals, ids = [], [], [], [], []
                for r, data in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                    got = encoder.text(data) + end
                    n, begin = len(got) // 4, 0
                    rest = n % capacity
                    parts = -(-rest // piece)
                    sizes = [capacity] * (n // capacity) + [rest // parts + (i < rest % parts) for i in range(parts)]
                    for size in sizes:
                        source.append(r)
                        starts.append(begin)
                        lengths.append(size)
                        totals.append(n)
                        ids.append(got[4 * begin : 4 * (begin + size)])
                        begin += size
                keys = b.column(0).take(pa.array(source, type=pa.int32()))
                yield pa.RecordBatch.from_arrays([keys, *[pa.array(x, type=pa.int64()) for x in (starts, lengths, totals)], pa.array(ids, type=pa.binary())], names=out.names)

    return rows.mapInArrow(cut, out).withColumnRenamed("_key", key)


def balanced_windows(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of item numbers; none holds more than ``capacity``."""
    if not len(lengths):
        return []
    windows = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        found = multiway(lengths, windows)
        if max(int(lengths[w].sum()) for w in found if w) <= capacity:
            return [w for w in found if w]
        windows += 1


def multiway(lengths: np.ndarray, windows: int) -> list[list[int]]:
    """Karmarkar-Karp: partial partitions are kept with their sums in falling order."""
    if windows == 1:
        return [list(range(len(lengths)))]
    heap = [(-n, i, [n] + [0] * (windows - 1), {0: [i]}) for i, n in enumerate(lengths.tolist())]
    heapq.heapify(heap)
    order = len(heap)
    while len(heap) > 1:
        _, _, a, items_a = heapq.heappop(heap)
        _, _, b, items_b = heapq.heappop(heap)
        sums = [x + y for x, y in zip(a, reversed(b), strict=True)]
        held = dict(items_a)
        for slot, got in items_b.items():
            at = windows - 1 - slot
            held[at] = held[at] + got if at in held else got
        by = sorted(range(windows), key=sums.__getitem__, reverse=True)
        low = sums[by[-1]]
        place = {old: new for new, old in enumerate(by)}
        order += 1
        heapq.heappush(heap, (low - sums[by[0]], order, [sums[i] - low for i in by], {place[s]: g for s, g in held.items()}))
    return list(heap[0][3].values())


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length", group_items: int = GROUP_ITEMS) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; lengths must lie between 1 and the capacity."""
    carried = [f.name for f in pieces.schema.fields if f.name.lower() not in {"sequence_id", "offset"}]
    named = pieces.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)], F.col(f"`{length}`").cast("long").alias("_n"))
    # the number is written with the row, so it stays what it is when a task runs again
    kept = stored(named.withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    partial = kept.where(F.col("_n") < capacity)
    groups = tasks_for(partial.count(), group_items)
    full = kept.where(F.col("_n") == capacity).withColumns({"sequence_id": F.col("_uid") * 2 + 1, "offset": F.lit(0).cast("long")}).drop("_n", "_uid")
    schema = T.StructType([*kept.schema.fields[:-2], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    columns = len(carried)

    def place(group: pa.Table) -> pa.Table:
        group = group.sort_by("_uid")
        lengths = group.column("_n").to_numpy()
        number = group.column("_group")[0].as_py() << WINDOW_BITS
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for w, items in enumerate(balanced_windows(lengths, capacity)):
            items = sorted(items)
            sequence[items] = 2 * (number + w)
            offset[items] = np.concatenate([[0], np.cumsum(lengths[items])[:-1]])
        return pa.table([*group.columns[:columns], pa.array(sequence), pa.array(offset)], names=schema.names)

    dealt = partial.withColumn("_group", F.pmod(F.xxhash64("_uid"), F.lit(groups)))
    done = full.unionByName(dealt.groupBy("_group").applyInArrow(place, schema))
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], "sequence_id", "offset")
