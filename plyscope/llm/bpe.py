"""Byte-level BPE of whole texts, by tree concatenation of separately encoded pieces.

A text over ``leaf`` characters is cut into pieces that become rows of their own, so that they are encoded in
parallel. A cut at a place where the tokenizer always splits needs no more work. Text that the tokenizer does not
split (a very long run of letters, say) is cut anyway, and the pieces of such a run are joined as a balanced tree:
a growing window of tokens around each join is encoded again until its first and last tokens are those that both
sides had there. Neighbouring tokens of such an encoding are then all pairs that BPE leaves alone, which makes
the joined sequence the encoding of the whole run.

NULL text counts as empty and has no tokens. Repeated rows each keep their row. Other columns are carried along;
columns called ``ids``, ``n_tokens`` or ``decoded`` are replaced.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T

#: How the tokenizer splits text before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 32_768
ROWS_OUT = 512


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        byte_of = _byte_of()
        added = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        ranks = {
            bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in added
        }
        self.added = added
        self.pieces = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {i: b for b, i in ranks.items()} | {i: t.encode() for t, i in added.items()}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def encode(self, text: str) -> list[int]:
        if self.special is None or not self.special.search(text):
            return self.pieces.encode_ordinary(text)
        ids: list[int] = []
        for part in self.special.split(text):
            ids += [self.added[part]] if part in self.added else self.pieces.encode_ordinary(part)
        return ids

    def encode_run(self, data: bytes) -> list[int]:
        """Bytes that no rule splits."""
        return self.pieces._encode_single_piece(data) if data else []

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the text of ``left`` and ``right``, two encodings of parts of one unsplit run."""
        if not left or not right:
            return left + right
        size = 1
        while True:
            a, b = min(size, len(left)), min(size, len(right))
            window = left[len(left) - a :] + right[:b]
            again = self.encode_run(b"".join(self.bytes_of[i] for i in window))
            starts = a == len(left) or again[0] == left[len(left) - a]
            ends = b == len(right) or again[-1] == right[b - 1]
            if starts and ends and (len(again) > 1 or (a == len(left) and b == len(right))):
                return left[: len(left) - a] + again + right[b:]
            size *= 2

    def join_all(self, parts: list[list[int]]) -> list[int]:
        """Neighbours first, then neighbours of those: a balanced tree."""
        while len(parts) > 1:
            parts = [self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0] if parts else []


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def cut(text: str, leaf: int) -> Iterator[tuple[str, bool]]:
    """Pieces of a text, each with whether it goes on inside the same unsplit run as the one before."""
    pattern = regex.compile(PATTERN)
    at = 0
    while at < len(text):
        to = at + leaf
        if to >= len(text):
            yield text[at:], False
            return
        # a single space between two other characters always starts a new token
        space = to
        while space > at + leaf // 2 and not (text[space] == " " and not text[space - 1].isspace() and not text[space + 1 : space + 2].isspace()):
            space -= 1
        if space > at + leaf // 2 and space + 1 < len(text):
            yield text[at:space], False
            at = space
            continue
        # none there: match token by token
        # a piece must not end behind two tokens of white space, which are one token where nothing follows them
        reached = end = at
        space = False
        while reached < to and (found := pattern.match(text, reached)):
            if found.end() - at > leaf and reached > at:
                break
            reached = found.end()
            if not (space and text[found.start() : reached].isspace()):
                end = reached
            space = text[reached - 1].isspace()
        if end - at <= leaf:
            yield text[at:end], False
        else:
            for k in range(at, end, leaf):
                yield text[k : min(k + leaf, end)], k > at
        at = end


def _fields(df: DataFrame, drop: set[str]) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name.lower() not in drop]


def encode(
    df: DataFrame, vocabulary: str, text: str = "text", leaf: int = LEAF, decoded: bool = False, keep_text: bool = True
) -> DataFrame:
    """Rows with ``ids`` (array of int) and ``n_tokens``; with ``decoded`` also the text that the ids stand for."""
    new = {"ids", "n_tokens", "decoded"} | (set() if keep_text else {text.lower()})
    carried = [f.name for f in _fields(df, new)]
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_text"))
    kept = rows.schema.fields[:-1]
    out = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("_decoded", T.StringType())])

    def result(batch: pa.RecordBatch, encoded: list[list[int]]) -> pa.RecordBatch:
        coder = codec(vocabulary)
        ids = pa.array(encoded, type=pa.list_(pa.int32()))
        texts = pa.array([coder.decode(x) for x in encoded] if decoded else [None] * len(encoded), type=pa.string())
        return pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(kept))], ids, texts], names=[*[f.name for f in kept], "ids", "_decoded"])

    def whole(batches):
        coder = codec(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                yield result(part, [coder.encode(t) for t in part.column(len(kept)).to_pylist()])

    short = rows.where(F.length("_text") <= leaf).mapInArrow(whole, out)

    piece = T.StructType([T.StructField("_row", T.LongType()), T.StructField("_piece", T.IntegerType()), T.StructField("_kind", T.IntegerType()), T.StructField("_part", T.StringType()), T.StructField("_run", T.BooleanType()), *kept])

    def pieces(batches):
        coder = codec(vocabulary)
        for batch in batches:
            for r in range(batch.num_rows):
                whole_text, found = batch.column(len(kept))[r].as_py(), []
                for k, part in enumerate(coder.special.split(whole_text) if coder.special else [whole_text]):
                    if k % 2:
                        found.append((part, 2))
                    else:
                        found += [(p, int(glued)) for p, glued in cut(part, leaf)]
                one = batch.slice(r, 1)
                take = pa.array([0] * len(found), type=pa.int32())
                n = len(found)
                first = [pa.array([i == 0 for i in range(n)])]
                carry = [pa.compute.if_else(first[0], one.column(i).take(take), pa.nulls(n, one.column(i).type)) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays(
                    [
                        one.column(len(kept) + 1).take(take),
                        pa.array(range(n), type=pa.int32()),
                        pa.array([kind for _, kind in found], type=pa.int32()),
                        pa.array([p for p, _ in found], type=pa.string()),
                        # part of an unsplit run: it goes on from the piece before, or the next one goes on from it
                        pa.array([k == 1 or (i + 1 < n and found[i + 1][1] == 1) for i, (_, k) in enumerate(found)]),
                        *carry,
                    ],
                    names=piece.names,
                )

    leaves = T.StructType([piece[0], piece[1], piece[2], T.StructField("_ids", T.BinaryType()), *kept])

    def encode_leaves(batches):
        coder = codec(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                b = batch.slice(at, 32)
                ids = []
                for kind, part, run in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                    got = [coder.added[part]] if kind == 2 else coder.encode_run(part.encode()) if run else coder.encode(part)
                    ids.append(np.array(got, dtype="<i4").tobytes())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(ids, type=pa.binary()), *[b.column(5 + i) for i in range(len(kept))]], names=leaves.names)

    def assemble(group: pa.Table) -> pa.Table:
        coder = codec(vocabulary)
        group = group.sort_by("_piece").combine_chunks()
        ids: list[int] = []
        run: list[list[int]] = []
        for kind, data in zip(group.column("_kind").to_pylist(), group.column("_ids").to_pylist(), strict=True):
            part = np.frombuffer(data, dtype="<i4").tolist()
            if kind == 1:
                run.append(part)
            else:
                ids += coder.join_all(run)
                run = [part]
        ids += coder.join_all(run)
        return pa.Table.from_batches([result(group.slice(0, 1).select([f.name for f in kept]).to_batches()[0], [ids])])

    cut_up = rows.where(F.length("_text") > leaf).withColumn("_row", F.monotonically_increasing_id()).mapInArrow(pieces, piece)
    spread = cut_up.repartition("_row", "_piece").mapInArrow(encode_leaves, leaves)
    long = spread.groupBy("_row").applyInArrow(assemble, out)
    both = short.unionByName(long)
    extra = [F.col("_decoded").alias("decoded")] if decoded else []
    return both.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], "ids", F.size("ids").cast("long").alias("n_tokens"), *extra)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """Rows with ``decoded``, the text that the ids stand for; NULL ids give NULL."""
    carried = [f.name for f in _fields(df, {"decoded"})]
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)], F.col(f"`{ids}`").cast("array<int>").alias("_ids"))
    out = T.StructType([*rows.schema.fields[:-1], T.StructField("decoded", T.StringType())])

    def texts(batches):
        coder = codec(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                b = batch.slice(at, ROWS_OUT)
                found = [None if x is None else coder.decode(x) for x in b.column(b.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, type=pa.string())], names=out.names)

    done = rows.mapInArrow(texts, out)
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], "decoded")
