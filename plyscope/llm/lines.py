"""Line dedup by an exact set-similarity join: later lines that match an earlier one are removed.

A line is the set of its words (lower case, split at white space). Two lines match if the Jaccard similarity of their
sets is at least the threshold; lines with fewer than ``least`` distinct words never match and always stay. Lines
are ordered by document id (NULL first), document and place, and a line goes if any earlier line matches it.

Words are ordered by rarity, by counts over all lines in a table of fixed size (words that share a slot share a count,
which affects speed alone). Lines that match share a word among the rarest ones of each, so these prefixes meet in
groups by word; the length filter, the positional filter and a bit filter on the symmetric difference drop most
pairs, all without losing a match. Those that are left are verified, by sketches of the sets and then on the whole sets.
Where only the removals are asked for, a line that has an earlier match is not compared further. Equal sets count as one
line throughout.

Lines that match, directly or over others, form classes of lines. Two documents with different ids are linked if they
hold lines of one class (rows without an id count as one document here); linked documents form classes.

NULL text counts as empty. Rows with the same id and text are one document and get the same result. Extra columns are
carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plyscope.llm.common import components, mix, stored, tasks_for, text_blocks, word_hashes

THRESHOLD = 0.8
LEAST_WORDS = 1
SLOTS = 1 << 20
FLAGS = 1 << 22
SEGMENTS = 64
#: The tables of all tasks are merged in so many groups of tasks first.
TASK_GROUPS = 1024
BUCKET_ENTRIES = 300_000
LINES_AT_ONCE = 1 << 13
PAIRS_AT_ONCE = 1 << 18
_HASH_BITS = 43
_LINE_SHIFT = np.uint64(51)
ENTRY = [("token", "<i8"), ("sig", "<i8"), ("bits", "<u8"), ("more", "<u8"), ("doc", "<i8"), ("n", "<u4"), ("pos", "<u4"), ("line", "<u4")]
LOWEST = -(2**63)  # stands for a NULL id


# tables of fixed size that are summed over all tasks


def _segments(table: np.ndarray) -> pa.RecordBatch:
    parts = [p.tobytes() for p in np.split(table, SEGMENTS)]
    return pa.RecordBatch.from_arrays([pa.array(range(SEGMENTS), pa.int32()), pa.array(parts, pa.binary())], names=["segment", "part"])


def _gather(parts: DataFrame, kind: str, merge) -> np.ndarray:
    """The merged table; its size is fixed, so it may go to the driver and out to the tasks."""

    def one(group: pa.Table) -> pa.Table:
        total = None
        for b in group.column("part"):
            part = np.frombuffer(b.as_py(), kind)
            total = part.copy() if total is None else merge(total, part)
        return pa.table({"segment": pa.array([group.column("segment")[0].as_py()], pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})

    # first within groups of tasks, so that no task merges what all others hand on
    some = parts.withColumn("group", F.pmod(F.spark_partition_id(), F.lit(TASK_GROUPS)))
    some = some.groupBy("segment", "group").applyInArrow(one, "segment int, part binary")
    rows = some.groupBy("segment").applyInArrow(one, "segment int, part binary").collect()
    return np.concatenate([np.frombuffer(r["part"], kind) for r in sorted(rows, key=lambda r: r["segment"])]) if rows else np.zeros(0, kind)


def rarity(texts: DataFrame) -> np.ndarray:
    """For every slot, the logarithm of its word count in eighths of a power of two."""

    def count(batches):
        total = np.zeros(SLOTS, "<u4")
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                h = word_hashes(data, offsets)[0]
                total += np.bincount((h & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS).astype("<u4")
        yield _segments(total)

    total = _gather(texts.mapInArrow(count, "segment int, part binary"), "<u4", np.add)
    if not len(total):
        return np.zeros(SLOTS, np.uint8)
    return np.minimum(255, np.log2(np.maximum(total, 1)) * 8).astype(np.uint8)


def flags(df: DataFrame, columns: list[str]) -> np.ndarray:
    """A bit for the hash of every value in the columns."""

    def mark(batches):
        seen = np.zeros(FLAGS, np.uint8)
        for batch in batches:
            for c in batch.columns:
                v = c.to_numpy(zero_copy_only=False).view(np.uint64)
                seen[(mix(v) & np.uint64(FLAGS - 1)).astype(np.int64)] = 1
        yield _segments(np.packbits(seen))

    found = _gather(df.select(*columns).mapInArrow(mark, "segment int, part binary"), "u1", np.bitwise_or)
    return found if len(found) else np.zeros(FLAGS // 8, np.uint8)


def flagged(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = (mix(values.view(np.uint64)) & np.uint64(FLAGS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


# lines as sets of words


def sketch(words: np.ndarray) -> bytes:
    """Parity bits of a set: every word flips one of about two bits a word. Folding halves the width."""
    width = 1 << max(6, int(2 * len(words) - 1).bit_length())
    at = (mix(words ^ np.uint64(0xB175)) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=width) & 1, bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound for the number of words that are in one of two sets only, from their sketches."""
    a, b = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


class Lines:
    """The lines of a block that hold words: row, number in the row, words by rarity, size and signature."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rare: np.ndarray):
        h, rows, starts, _ = word_hashes(data, offsets)
        breaks = np.cumsum(data == 10)
        before = breaks[starts] if len(starts) else np.zeros(0, np.int64)
        row_base = np.concatenate([[0], breaks])[offsets[:-1]] if len(data) else np.zeros(len(offsets) - 1, np.int64)
        place = before + rows
        first = np.flatnonzero(np.diff(place, prepend=-1))
        self.row = rows[first]
        self.number = before[first] - row_base[self.row]
        line = np.cumsum(np.diff(place, prepend=place[0] if len(place) else 0) != 0)
        key = (rare[(h & np.uint64(SLOTS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(_HASH_BITS)) | (h >> np.uint64(64 - _HASH_BITS))
        tokens, of = [], []
        for at in range(0, len(first), LINES_AT_ONCE):
            a = first[at]
            b = first[at + LINES_AT_ONCE] if at + LINES_AT_ONCE < len(first) else len(h)
            both = np.sort(((line[a:b] - at).astype(np.uint64) << _LINE_SHIFT) | key[a:b])
            both = both[np.concatenate([[True], both[1:] != both[:-1]])]
            of.append((both >> _LINE_SHIFT).astype(np.int64) + at)
            tokens.append(both & np.uint64((1 << 51) - 1))
        self.tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        self.of = np.concatenate(of) if of else np.zeros(0, np.int64)
        self.n = np.bincount(self.of, minlength=len(first))
        self.start = np.concatenate([[0], np.cumsum(self.n)[:-1]]).astype(np.int64) if len(first) else np.zeros(0, np.int64)
        scrambled = mix(self.tokens)
        if len(first):
            self.sig = np.add.reduceat(scrambled, self.start).view(np.int64)
            bit, odd = np.uint64(1) << (scrambled >> np.uint64(58)), (scrambled & np.uint64(1)) == 1
            self.bits, self.more = (np.bitwise_xor.reduceat(np.where(odd == side, bit, np.uint64(0)), self.start) for side in (False, True))
        else:
            self.sig, self.bits, self.more = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)


def _blocks(docs: DataFrame, schema: str, rare, function):
    """Rows that ``function(lines, doc, rk)`` gives for each block of lines; docs: doc, rk, text."""
    shared = docs.sparkSession.sparkContext.broadcast(rare)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            doc, rk = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for a, b, data, offsets in text_blocks(batch.column(2)):
                columns = function(Lines(data, offsets, shared.value), doc[a:b], rk[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return docs.mapInArrow(run, schema)


def overlap(threshold: float, a, b):
    """Words that two sets of these sizes must share."""
    return np.ceil(threshold / (1 + threshold) * (a + b) - 1e-9)


def _prefixes(docs: DataFrame, rare: np.ndarray, threshold: float, least: int, buckets: int) -> DataFrame:
    """bucket, blob: the packed prefix entries of all lines."""

    def entries(lines: Lines, doc, rk):
        size = lines.n - np.ceil(threshold * lines.n - 1e-9).astype(np.int64) + 1
        pos = np.arange(len(lines.tokens)) - lines.start[lines.of]
        # very short sets match equal ones alone, and those need no pairs
        pairing = (lines.n >= least) & ((np.floor(lines.n / threshold + 1e-9) > lines.n) | (np.ceil(threshold * lines.n - 1e-9) < lines.n))
        keep = (pos < size[lines.of]) & pairing[lines.of]
        of = lines.of[keep]
        columns = [lines.tokens[keep].view(np.int64), lines.sig[of], lines.bits[of], lines.more[of], doc[lines.row[of]], lines.n[of], pos[keep], lines.number[of]]
        bucket = (mix(lines.tokens[keep]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        columns = [c[order].astype(kind) for c, (_, kind) in zip(columns, ENTRY, strict=True)]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else np.zeros(1, int)
        spans = list(zip(cuts, cuts[1:], strict=False))
        blobs = [b"".join(c[a:b].tobytes() for c in columns) for a, b in spans]
        return [pa.array([int(bucket[a]) for a, _ in spans], pa.int32()), pa.array(blobs, pa.binary())]

    return _blocks(docs, "bucket int, blob binary", rare, entries)


def _unpack(blobs: list[bytes]) -> dict[str, np.ndarray]:
    width = sum(np.dtype(k).itemsize for _, k in ENTRY)
    parts: dict[str, list] = {name: [] for name, _ in ENTRY}
    for b in blobs:
        n, at = len(b) // width, 0
        for name, kind in ENTRY:
            parts[name].append(np.frombuffer(b, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return {name: np.concatenate(p).astype(np.int64) if name not in ("bits", "more") else np.concatenate(p).astype(np.uint64) for name, p in parts.items()}


def _ordered(e: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The entries by word and size, each set once for a word (where it stands first)."""
    order = np.lexsort((e["line"], e["doc"], e["sig"], e["token"]))
    token, sig = e["token"][order], e["sig"][order]
    order = order[np.concatenate([[True], (token[1:] != token[:-1]) | (sig[1:] != sig[:-1])])]
    order = order[np.lexsort((e["n"][order], e["token"][order]))]
    return {k: v[order] for k, v in e.items()}


def _ages(e: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sets by age, for every entry the number of its set there, and the place of one entry of each."""
    sigs, first, of = np.unique(e["sig"], return_index=True, return_inverse=True)
    order = np.lexsort((sigs, e["line"][first], e["doc"][first]))
    age = np.empty(len(sigs), np.int64)
    age[order] = np.arange(len(sigs))
    return sigs[order], age[of], first[order]


def _meetings(e: dict[str, np.ndarray], age: np.ndarray, threshold: float):
    """Blocks of pairs of ordered entries, the earlier set first, that share a word and pass the filters."""
    group = np.cumsum(np.concatenate([[0], e["token"][1:] != e["token"][:-1]]))
    place = (group << 32) | e["n"]
    last = np.searchsorted(place, (group << 32) | np.floor(e["n"] / threshold + 1e-9).astype(np.int64), side="right")
    counts = last - np.arange(len(group)) - 1
    ends = np.cumsum(counts)
    total, at = int(ends[-1]) if len(ends) else 0, 0
    while at < total:
        # pairs at to at + PAIRS_AT_ONCE, in order of their first entry
        number = np.arange(at, min(total, at + PAIRS_AT_ONCE))
        at += len(number)
        i = np.searchsorted(ends, number, side="right")
        j = i + 1 + (number - (ends[i] - counts[i]))
        need = overlap(threshold, e["n"][i], e["n"][j])
        diff = sum(np.bitwise_count(e[k][i] ^ e[k][j]).astype(np.int64) for k in ("bits", "more"))
        ok = (np.minimum(e["n"][i] - e["pos"][i], e["n"][j] - e["pos"][j]) >= need) & (diff <= e["n"][i] + e["n"][j] - 2 * need)
        i, j = i[ok], j[ok]
        swap = age[i] > age[j]
        yield np.where(swap, j, i), np.where(swap, i, j)


def _repeated(e: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The ordered entries whose word stands in another one too."""
    order = np.argsort(e["token"])
    token = e["token"][order]
    again = token[1:] == token[:-1]
    return _ordered({k: v[order[np.concatenate([[False], again]) | np.concatenate([again, [False]])]] for k, v in e.items()})


def _first_tries(e: dict[str, np.ndarray], threshold: float) -> dict[str, np.ndarray]:
    """The entries that pass the filters with any other; ``near``: the earliest set that theirs meets, or itself."""
    e = _repeated(e)
    sigs, age, _ = _ages(e)
    near, met = np.arange(len(sigs)), np.zeros(len(age), bool)
    for earlier, later in _meetings(e, age, threshold):
        met[earlier] = met[later] = True
        np.minimum.at(near, age[later], age[earlier])
    return {k: v[met] for k, v in e.items()} | {"near": sigs[near[age[met]]]}


def _met_pairs(e: dict[str, np.ndarray], age: np.ndarray, threshold: float, unmatched: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Blocks of distinct pairs (earlier << 32 | later) of sets by age; a pair may stand in several blocks."""
    found, held = [], 0
    for earlier, later in _meetings(e, age, threshold):
        if unmatched is not None:
            earlier, later = earlier[unmatched[later]], later[unmatched[later]]
        found.append((age[earlier] << 32) | age[later])
        held += len(found[-1])
        if held > 16 * PAIRS_AT_ONCE:
            yield np.unique(np.concatenate(found))
            found, held = [], 0
    if held:
        yield np.unique(np.concatenate(found))


def _open_pairs(e: dict[str, np.ndarray], threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Earlier and later sets that pass the filters, where the later one has no match so far."""
    e = _ordered(e)
    sigs, age, _ = _ages(e)
    begin = np.flatnonzero(np.concatenate([[True], e["token"][1:] != e["token"][:-1]])) if len(age) else np.zeros(0, int)
    if len(begin):
        size = np.diff(np.append(begin, len(age)))
        oldest = np.repeat(np.minimum.reduceat(age, begin), size)
        keep = np.repeat(np.maximum.reduceat((e["matched"] == 0) & (age != oldest), begin), size)
        e, age = {k: v[keep] for k, v in e.items()}, age[keep]
    for both in _met_pairs(e, age, threshold, e["matched"] == 0):
        yield sigs[both >> 32], sigs[both & 0xFFFFFFFF]


def _all_pairs(prefixes: DataFrame, threshold: float) -> DataFrame:
    """a, b: all pairs of sets that pass the filters, the earlier one first."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _repeated(_unpack([x for batch in batches for x in batch.column("blob").to_pylist()]))
        sigs, age, _ = _ages(e)
        for both in _met_pairs(e, age, threshold):
            yield pa.RecordBatch.from_arrays([pa.array(sigs[both >> 32]), pa.array(sigs[both & 0xFFFFFFFF])], names=["a", "b"])

    return prefixes.groupBy("bucket").applyInArrow(run, "a long, b long").distinct()


def _tries(prefixes: DataFrame, threshold: float) -> DataFrame:
    """bucket, near and the prefix entries of all sets that pass the filters with another."""
    names = ["bucket", *[k for k, _ in ENTRY], "near"]

    def run(group: pa.Table) -> pa.Table:
        e = _first_tries(_unpack(group.column("blob").to_pylist()), threshold)
        bucket = np.full(len(e["sig"]), group.column("bucket")[0].as_py(), np.int64)
        return pa.table({k: (bucket if k == "bucket" else e[k].view(np.int64)) for k in names})

    return prefixes.groupBy("bucket").applyInArrow(run, ", ".join(f"{k} long" for k in names))


def _rest(tries: DataFrame, threshold: float) -> DataFrame:
    """a, b: the pairs that may still matter; tries with matched."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(batches)
        e = {k: group.column(k).to_numpy() for k in group.column_names if k not in ("bucket", "near")}
        e |= {k: e[k].view(np.uint64) for k in ("bits", "more")}
        for a, b in _open_pairs(e, threshold):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return tries.groupBy("bucket").applyInArrow(run, "a long, b long").distinct()


def _places(wanted: np.ndarray, docs: DataFrame, rare: np.ndarray, least: int) -> DataFrame:
    """sig, doc, rk, line of every line that takes part; the first of a block also has the words and the sketch of a flagged set."""
    wanted = docs.sparkSession.sparkContext.broadcast(wanted)

    def places(lines: Lines, doc, rk):
        keep = np.flatnonzero(lines.n >= least)
        some = np.flatnonzero(flagged(wanted.value, lines.sig[keep]))
        some = some[np.unique(lines.sig[keep][some], return_index=True)[1]]
        words = [lines.tokens[lines.start[i] : lines.start[i] + lines.n[i]].tobytes() for i in keep[some]]
        sketches = [sketch(np.frombuffer(w, "<u8")) for w in words]
        at = np.full(len(keep), -1)
        at[some] = np.arange(len(some))
        at = pa.array(at, mask=at < 0)
        held = [pa.array(c, pa.binary()).take(at) for c in (sketches, words)]
        return [lines.sig[keep], doc[lines.row[keep]], rk[lines.row[keep]], lines.number[keep], *held]

    return stored(_blocks(docs, "sig long, doc long, rk long, line long, sketch binary, words binary", rare, places), "lines")


def _sets(lines: DataFrame) -> DataFrame:
    """sig, n, sketch and words of the sets that were asked for."""
    one = lines.where(F.col("words").isNotNull()).groupBy("sig").agg(*[F.any_value(c).alias(c) for c in ("sketch", "words")])
    return stored(one.select("sig", (F.octet_length("words") / 8).cast("long").alias("n"), "sketch", "words"), "line-sets")


def _verified(pairs: DataFrame, held: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sets match."""

    def with_sides(pairs: DataFrame, *columns: str) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(held.select(F.col("sig").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
        return pairs

    def close(batches):
        for batch in batches:
            n, x, m, y = (c.to_pylist() for c in batch.columns[2:])
            good = [least_difference(p, q) <= k + l - 2 * overlap(threshold, k, l) for p, q, k, l in zip(x, y, n, m, strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    # the sketches are a small part of the sets, and most pairs of long lines end with them
    near = with_sides(pairs, "n", "sketch").select("a", "b", "n_a", "sketch_a", "n_b", "sketch_b")
    near = near.mapInArrow(close, "a long, b long")
    both = with_sides(near, "words").select("a", "b", "words_a", "words_b")

    def check(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(common >= threshold * (len(x) + len(y) - common) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(check, "a long, b long")


def _earlier_matches(prefixes: DataFrame, docs: DataFrame, rare: np.ndarray, threshold: float, least: int) -> tuple[DataFrame, DataFrame]:
    """Matches (a, b) that leave no set without one that has an earlier match, and the places of all lines.

    Each set is first compared with the one that most of its words propose; those without a match then with all others.
    """
    tries = stored(_tries(prefixes, threshold), "line-tries")
    every = _places(flags(tries, ["sig"]), docs, rare, least)
    held = _sets(every)
    asked = tries.where("near != sig").groupBy(F.col("sig").alias("b"), F.col("near").alias("a")).agg(F.count(F.lit(1)).alias("n"))
    first = stored(asked.groupBy("b").agg(F.max(F.struct("n", "a")).alias("best")).select("best.a", "b"), "line-first")
    found = stored(_verified(first, held, threshold), "line-links")
    matched = found.select(F.col("b").alias("sig")).distinct().withColumn("matched", F.lit(1).cast("long"))
    state = tries.join(matched, "sig", "left").withColumn("matched", F.coalesce("matched", F.lit(0).cast("long")))
    rest = stored(_rest(state, threshold).join(first, ["a", "b"], "left_anti"), "line-rest")
    return found.unionByName(stored(_verified(rest, held, threshold), "line-links")), every


def matching_lines(
    docs: DataFrame, threshold: float = THRESHOLD, least: int = LEAST_WORDS, linked: bool = True
) -> tuple[DataFrame, DataFrame]:
    """sig, doc, rk, line, later and root of the lines whose set stands twice or matches another; and the matches (a, b).

    docs: doc, rk, text. later: the set matches an earlier one, else NULL; root: its class of sets connected by matches,
    itself where it has none. The matches are all pairs of different sets that match, the earlier one first. With
    ``linked`` off there are no classes, sets that only later ones match are left out, and the matches are those that
    the removals need.
    """
    rare = rarity(docs.select("text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    prefixes = _prefixes(docs, rare, threshold, least, tasks_for(size // 30, BUCKET_ENTRIES))
    if linked:
        pairs = stored(_all_pairs(prefixes, threshold), "line-pairs")
        every = _places(flags(pairs, ["a", "b"]), docs, rare, least)
        found = stored(_verified(pairs, _sets(every), threshold), "line-links")
    else:
        found, every = _earlier_matches(prefixes, docs, rare, threshold, least)
    later = found.select(F.col("b").alias("sig")).distinct().withColumn("later", F.lit(True))
    sets = every.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).join(later, "sig", "left")
    if linked:
        sets = sets.join(components(found).withColumnRenamed("node", "sig"), "sig", "left")
    else:
        sets = sets.withColumn("root", F.lit(None).cast("long"))
    sets = sets.where("n > 1 or later or root is not null").select("sig", "later", F.coalesce("root", "sig").alias("root"))
    return stored(every.select("sig", "doc", "rk", "line").join(sets, "sig"), "line-places"), found


def removed_lines(places: DataFrame) -> DataFrame:
    """rk, line: the lines to remove."""
    here = F.struct("doc", "rk", "line")
    placed = places.join(places.groupBy("sig").agg(F.min(here).alias("first")), "sig")
    return placed.where(F.col("later").isNotNull() | (here != F.col("first"))).select("rk", "line").distinct()


def linked_documents(places: DataFrame, matches: DataFrame) -> DataFrame:
    """doc, links, direct_links, class_id of every document with a place; links and class_id where others share a class.

    Rows stand for a document in a class of lines or with a set of words, never for pairs of documents.
    """
    members = places.select("doc", "root").distinct()
    shared = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("first")).where("n > 1")
    within = stored(members.join(shared, "root").select("doc", "first", "n"), "line-shared")
    links = within.groupBy("doc").agg(F.sum(F.col("n") - 1).alias("links"))
    roots = components(within.select("first", "doc"), "first", "doc")
    named = roots.groupBy("root").agg(F.min(F.nullif("node", F.lit(LOWEST))).alias("class_id"))
    holders = places.select("sig", "doc").distinct()
    sets = holders.groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
    ends = matches.unionByName(matches.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = ends.join(sets.withColumnRenamed("sig", "b"), "b").groupBy(F.col("a").alias("sig")).agg(F.sum("n").alias("near"))
    around = sets.join(near, "sig", "left").select("sig", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("near"))
    direct = holders.join(around, "sig").groupBy("doc").agg(F.sum("near").alias("direct_links"))
    classed = roots.join(named, "root").select(F.col("node").alias("doc"), "class_id").join(links, "doc")
    return direct.join(classed, "doc", "left")


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, least: int = LEAST_WORDS, linked: bool = True) -> DataFrame:
    """The rows with the text that is left, n_lines and n_removed, and unless ``linked`` is off what the document is linked to.

    links: for each class of lines in the document, the number of documents with another id that hold a line of it, added
    up; direct_links: for each different line of the document, the number of other documents with an equal line and of
    documents with each line that matches it, added up (so two lines of
    its own that match count, too); class_id: smallest id of all documents that are linked directly or over others.
    """
    new = {"n_lines", "n_removed", "links", "class_id", "direct_links"}
    carried = [f.name for f in df.schema.fields if f.name.lower() not in new]
    # the caller's columns go by numbers, so that none clashes with those made here
    k, t = (F.col(f"c{carried.index(c)}") for c in (key, text))
    named = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)])
    rows = named.withColumn("_rk", F.xxhash64(k, F.coalesce(t, F.lit(""))))
    doc = F.coalesce(k.cast("long"), F.lit(LOWEST).cast("long"))
    docs = rows.select(doc.alias("doc"), F.col("_rk").alias("rk"), F.coalesce(t.cast("string"), F.lit("")).alias("text"))
    places, matches = matching_lines(docs, threshold, least, linked)
    gone = removed_lines(places).groupBy(F.col("rk").alias("_rk")).agg(F.collect_list(F.col("line").cast("int")).alias("_gone"))
    parts = F.split(F.coalesce(t, F.lit("")), "\n", -1)
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains("_gone", i)), "\n")
    found = []
    if linked:
        # small rows meet first, so that the texts move once
        links = linked_documents(places, matches).select("doc", *[F.col(c).alias(f"_{c}") for c in ("links", "direct_links", "class_id")])
        gone = docs.select(F.col("rk").alias("_rk"), "doc").distinct().join(links, "doc", "left").join(gone, "_rk", "left")
        gone = gone.where(F.col("_direct_links").isNotNull() | F.col("_gone").isNotNull()).withColumnRenamed("doc", "_doc")
        rows = rows.withColumn("_doc", doc)
        found = [
            F.coalesce("_links", F.lit(0)).cast("long").alias("links"),
            F.coalesce("_direct_links", F.lit(0)).cast("long").alias("direct_links"),
            F.coalesce("_class_id", k.cast("long")).alias("class_id"),
        ]
    joined = rows.join(gone, ["_rk", "_doc"] if linked else ["_rk"], "left")
    return joined.select(
        *[F.when(F.col("_gone").isNull(), F.col(f"c{i}")).otherwise(kept).alias(c) if c == text else F.col(f"c{i}").alias(c) for i, c in enumerate(carried)],
        F.size(parts).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
        *found,
    )
