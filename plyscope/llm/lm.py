"""Hierarchical Pitman-Yor language model with sampled seating.

Three levels share parents: the base gives every training word and one unknown word the same chance, the root
restaurant serves the words of all contexts, and each context has a restaurant of its own whose tables are customers
of the root. A context is the word before, by one of ``CLASSES`` hash classes, so that a frequent word hardly ever
shares its restaurant while rare words do; the start of a text is a context too. A customer of a word joins one of the
word's tables in proportion to their customers less the discounts, or opens a table in proportion to strength plus
discount times the tables of the restaurant, times what the parent expects of the word. A Gibbs step takes all
customers of one word out of one restaurant and seats them again, in batches that grow with those seated; a sweep does
so for every word, contexts first and then the root. Predictive probabilities are averaged over the sweeps behind the
burn-in.

Counts of all (word, context) pairs of the training rows are summed in each task and dealt into shares by the word.
The pairs of a word that makes up more than one in ``OFTEN`` tokens (so fewer than ``OFTEN`` words) are dealt by word
and context, so no word is the work of one share. Shares exchange only the totals of the restaurants and the tables of
those words, between rounds. Every token of a text goes to the share of its pair, and each share adds up a row's part.

NULL text counts as empty and has the end token alone. Repeated rows are separate rows. Rows without an id are
training rows. Without training rows every token has the base's chance, which is 1.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from plyscope.llm.common import mix, stored, tasks_for, text_blocks, word_hashes

DISCOUNTS, STRENGTHS = (0.8, 0.6), (2.0, 20.0)  # contexts, root
CLASSES = 1 << 16
CONTEXTS = CLASSES + 1  # the last one is the start of a text
ROUNDS, SWEEPS, BURN_IN = 2, 5, 2
SHARE_TOKENS = 4_000_000
#: Tokens whose counts a task sums up before it hands them on.
HELD_TOKENS = 4_000_000
OFTEN = 2048
END = np.uint64(0xE4D)
_BITS = np.uint64(CLASSES.bit_length())
PAIR = np.dtype([("w", "<u8"), ("c", "<u4"), ("n", "<u4")])
#: What one share, or the task that read the text, adds to a row.
OWN = np.dtype([("row", "<i8"), ("key", "<i8"), ("keyed", "<u1"), ("n", "<i8")])


def is_held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 7 == 2, F.lit(False))


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers below 2**32 and of floats, each byte position by itself, compressed."""
    parts = [np.array([len(columns)] + [len(c) for c in columns] + [c.dtype.num for c in columns], np.int64).tobytes()]
    parts += [c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    k = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, 2 * k, 8)
    at, out = 8 + 16 * k, []
    for n, kind in zip(sizes[:k].tolist(), sizes[k:].tolist(), strict=True):
        kind = next(t for t in (np.dtype(np.uint32), np.dtype(np.uint64), np.dtype(np.int64), np.dtype(np.float64), np.dtype(np.float32)) if t.num == kind)
        planes = np.frombuffer(data, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def by_word(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words and their run lengths, of words in order."""
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, np.int64)
    return words[first], np.diff(np.append(first, len(words))).astype(np.uint32)


def packed_pairs(pairs: np.ndarray) -> bytes:
    words, runs = by_word(pairs["w"])
    return packed(words, runs, np.ascontiguousarray(pairs["c"]), np.ascontiguousarray(pairs["n"]))


def unpacked_pairs(blob: bytes) -> np.ndarray:
    words, runs, c, n = unpacked(blob)
    out = np.zeros(len(c), PAIR)
    out["w"], out["c"], out["n"] = np.repeat(words, runs), c, n
    return out


def token_pairs(data: np.ndarray, offsets: np.ndarray):
    """Row, word and context of every token of a block; each row ends with the end token."""
    h, rows, _, _ = word_hashes(data, offsets)
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n) + 1
    at = np.arange(len(h)) + rows  # every row before puts one end token in between
    total = len(h) + n
    words, context, row = np.full(total, END), np.full(total, CLASSES, np.uint32), np.repeat(np.arange(n), counts)
    words[at] = h
    context[at + 1] = (mix(h ^ np.uint64(0xC1A55)) % np.uint64(CLASSES)).astype(np.uint32)
    return row, words, context


def share_of(words: np.ndarray, contexts: np.ndarray, often: np.ndarray, shares: int) -> np.ndarray:
    """The share of every pair: by the word, and by the context as well for words in ``often`` (in order)."""
    wide = words.copy()
    if len(often):
        spread = often[np.minimum(np.searchsorted(often, words), len(often) - 1)] == words
        wide[spread] ^= mix(contexts[spread].astype(np.uint64) + np.uint64(1))
    return (mix(wide ^ np.uint64(0x5A17)) % np.uint64(shares)).astype(np.int64)


def in_order(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Order by word, then context."""
    _, number = np.unique(words, return_inverse=True)
    return np.argsort((number.astype(np.uint64) << _BITS) | contexts.astype(np.uint64))


def summed(words: np.ndarray, contexts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Distinct (word, context) pairs in order, with their counts."""
    order = in_order(words, contexts)
    words, contexts, counts = words[order], contexts[order], counts[order]
    new = (words[1:] != words[:-1]) | (contexts[1:] != contexts[:-1])
    first = np.flatnonzero(np.concatenate([[True], new])) if len(words) else np.zeros(0, np.int64)
    out = np.zeros(len(first), PAIR)
    out["w"], out["c"] = words[first], contexts[first]
    out["n"] = np.add.reduceat(counts, first) if len(first) else 0
    return out


def seat(rng, customers: np.ndarray, expected: np.ndarray, discount: float) -> np.ndarray:
    """Tables of words after seating their customers; expected: strength and tables of the restaurant times the parent."""
    tables = np.minimum(customers, 1)
    at = np.flatnonzero(customers > 1)
    seated, own, want, left = np.ones(len(at)), np.ones(len(at)), expected[at], customers[at].astype(float)
    while len(at):
        batch = np.minimum(left - seated, np.maximum(1, seated // 8))
        new = rng.binomial(batch.astype(np.int64), want / (want + np.maximum(seated - discount * own, 1e-9)))
        seated, own = seated + batch, own + new
        done = seated >= left
        tables[at[done]] = own[done]
        keep = ~done
        at, seated, own, want, left = at[keep], seated[keep], own[keep], want[keep], left[keep]
    return tables


class Restaurants:
    """The words of a share, seated under given totals."""

    def __init__(self, pairs: np.ndarray, share: int, totals: dict):
        self.pairs, self.totals = pairs, totals
        self.words, self.number = np.unique(pairs["w"], return_inverse=True)
        self.counts = np.bincount(self.number, weights=pairs["n"], minlength=len(self.words))
        self.rng = np.random.default_rng([share, totals["round"]])
        self.base = 1.0 / (totals["distinct"] + 1.0)
        self.tables = np.ones(len(pairs), np.int64)
        # words of several shares: their counts and seats at the root are those of all shares
        often = totals["often"]
        self.spread = np.isin(self.words, often)
        self.place = np.searchsorted(often, self.words[self.spread])
        self.counts[self.spread] = totals["often_counts"][self.place]
        self.root_tables = np.ones(len(self.words), np.int64)
        self.take_root_customers()

    def take_root_customers(self) -> None:
        self.root_customers = np.bincount(self.number, weights=self.tables, minlength=len(self.words)).astype(np.int64)
        self.root_customers[self.spread] = self.totals["often_customers"][self.place]

    def root(self, customers, tables):
        t = self.totals
        return (customers - DISCOUNTS[1] * tables + (STRENGTHS[1] + DISCOUNTS[1] * t["root_tables"]) * self.base) / (STRENGTHS[1] + t["root_customers"])

    def sweep(self) -> None:
        room = STRENGTHS[0] + DISCOUNTS[0] * self.totals["tables"]
        expected = room[self.pairs["c"]] * self.root(self.root_customers, self.root_tables)[self.number]
        self.tables = seat(self.rng, self.pairs["n"].astype(np.int64), expected, DISCOUNTS[0])
        self.take_root_customers()
        self.root_tables = seat(self.rng, self.root_customers, np.full(len(self.words), root_room(self.totals)), DISCOUNTS[1])
        self.root_tables[self.spread] = self.totals["often_tables"][self.place]

    def average(self):
        """Per pair and per word: averaged numerator of the context's own part, and probability at the root."""
        own, root = np.zeros(len(self.pairs)), np.zeros(len(self.words))
        for s in range(SWEEPS):
            self.sweep()
            if s >= BURN_IN:
                own += self.pairs["n"] - DISCOUNTS[0] * self.tables
                root += self.root(self.root_customers, self.root_tables)
        n = SWEEPS - BURN_IN
        return own / n, root / n

    def lookup(self, words: np.ndarray, contexts: np.ndarray, averaged):
        """log10 probability, training count of each token."""
        own, root = averaged
        t = self.totals
        parent, counts, part = np.full(len(words), self.root(0.0, 0.0)), np.zeros(len(words)), np.zeros(len(words))
        if len(self.words):
            i = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            known = self.words[i] == words
            parent[known], counts[known] = root[i[known]], self.counts[i[known]]
            keys = (self.number.astype(np.uint64) << _BITS) | self.pairs["c"].astype(np.uint64)
            wanted = (i.astype(np.uint64) << _BITS) | contexts.astype(np.uint64)
            j = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            seen = known & (keys[j] == wanted)
            part[seen] = own[j[seen]]
        # a word of several shares may have none of its pairs in this one
        often = t["often"]
        if len(often):
            i = np.minimum(np.searchsorted(often, words), len(often) - 1)
            here = often[i] == words
            parent[here] = self.root(t["often_customers"], t["often_tables"])[i[here]]
            counts[here] = t["often_counts"][i[here]]
        room = STRENGTHS[0] + DISCOUNTS[0] * t["tables"]
        p = (part + room[contexts] * parent) / (STRENGTHS[0] + t["customers"])[contexts]
        return np.log10(p), counts


def root_room(totals: dict) -> float:
    """Weight of a new table of a word at the root."""
    return (STRENGTHS[1] + DISCOUNTS[1] * totals["root_tables"]) / (totals["distinct"] + 1.0)


def _runs(share: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by share that keeps what was in order, and share, begin and end of every run."""
    order = np.argsort(share, kind="stable")
    share = share[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(share)) + 1, [len(share)]]) if len(share) else np.zeros(1, int)
    return order, [(int(share[a]), int(a), int(b)) for a, b in zip(cuts, cuts[1:], strict=False)]


def row_bucket(rows: np.ndarray, shares: int) -> np.ndarray:
    """Where the parts of a row are added up."""
    return (mix(rows.astype(np.int64).view(np.uint64)) % np.uint64(shares)).astype(np.int64)


def words_of_many(texts: DataFrame) -> np.ndarray:
    """Hashes, in order, of words above one in ``OFTEN`` tokens.

    Each block hands on what is above half that share in it; the choice decides where pairs are kept, not the result.
    """

    def heavy(batches):
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                _, w, _ = token_pairs(data, offsets)
                words, n = np.unique(w, return_counts=True)
                keep = n > len(w) / (2 * OFTEN)
                found = np.append(words[keep].view(np.int64), 0), np.append(n[keep], 0), np.append(np.zeros(keep.sum(), np.int64), len(w))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["w", "n", "size"])

    found = texts.mapInArrow(heavy, "w long, n long, size long").groupBy("w").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    found = stored(found, "words-of-many")
    size = found.agg(F.sum("size")).first()[0] or 0
    rows = found.where(F.col("n") > size / OFTEN).select("w").collect()  # fewer than OFTEN
    return np.sort(np.array([r["w"] for r in rows], np.int64).view(np.uint64))


def gathered(texts: DataFrame, shares: int, often: np.ndarray) -> DataFrame:
    """share, pairs: the counts of every share's pairs over all rows of ``text``."""

    def count(batches):
        held, size = [], 0

        def hand_on():
            found = summed(*(np.concatenate([p[f] for p in held]) for f in ("w", "c", "n")))
            order, runs = _runs(share_of(found["w"], found["c"], often, shares))
            found = found[order]
            blobs = [packed_pairs(found[a:b]) for _, a, b in runs]
            return pa.RecordBatch.from_arrays([pa.array([s for s, _, _ in runs], pa.int32()), pa.array(blobs, pa.binary())], names=["share", "pairs"])

        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                _, w, c = token_pairs(data, offsets)
                held.append(summed(w, c, np.ones(len(w), np.int64)))
                size += len(held[-1])
                if size > HELD_TOKENS:
                    yield hand_on()
                    held, size = [], 0
        if held:
            yield hand_on()

    def merge(group: pa.Table) -> pa.Table:
        parts = [unpacked_pairs(b) for b in group.column("pairs").to_pylist()]
        found = summed(*(np.concatenate([p[f] for p in parts]) for f in ("w", "c", "n")))
        return pa.table({"share": pa.array([group.column("share")[0].as_py()], pa.int32()), "pairs": pa.array([packed_pairs(found)], pa.binary())})

    return texts.mapInArrow(count, "share int, pairs binary").groupBy("share").applyInArrow(merge, "share int, pairs binary")


def _over_shares(model: DataFrame, columns: str, function):
    """Rows that ``function(share, pairs)`` gives for each share."""
    names = [c.split()[0] for c in re.split(r",\s*", columns)]

    def run(batches):
        for batch in batches:
            for share, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in function(share, unpacked_pairs(blob))], names=names)

    return model.select("share", "pairs").mapInArrow(run, columns)


def fit(texts: DataFrame, shares: int) -> tuple[DataFrame, dict]:
    """Stored counts by share, and the totals after the rounds of seating."""
    often = words_of_many(texts)
    model = stored(gathered(texts, shares, often), "language-model")
    width = CONTEXTS + 1 + len(often)

    def total(amounts) -> tuple[np.ndarray, float, np.ndarray]:
        """Sums over the shares: of every restaurant, of words of one share, of each word of several."""

        def row(share, pairs):
            by_context, single, of_pairs = amounts(share, pairs)
            out = np.zeros(width)
            out[:CONTEXTS] = np.bincount(pairs["c"], weights=by_context, minlength=CONTEXTS)
            out[CONTEXTS] = single
            spread = np.isin(pairs["w"], often)
            out[CONTEXTS + 1 :] = np.bincount(np.searchsorted(often, pairs["w"][spread]), weights=of_pairs[spread], minlength=len(often))
            some = np.flatnonzero(out)
            return [some, out[some]]

        out = np.zeros(width)
        found = _over_shares(model, "which long, n double", row).groupBy("which").agg(F.sum("n").alias("n"))
        for r in found.collect():  # one row for each restaurant and word of several shares at most
            out[r["which"]] = r["n"]
        return out[:CONTEXTS], out[CONTEXTS], out[CONTEXTS + 1 :]

    customers, single, often_counts = total(lambda share, pairs: (pairs["n"], len(np.setdiff1d(pairs["w"], often)), pairs["n"]))
    totals = {"round": 0, "customers": customers, "tokens": customers.sum(), "often": often, "often_counts": often_counts}
    totals |= {"distinct": single + (often_counts > 0).sum(), "tables": customers * 0.5, "root_customers": customers.sum() * 0.5}
    totals |= {"root_tables": totals["distinct"], "often_customers": np.ceil(often_counts * 0.5).astype(np.int64), "often_tables": np.ones(len(often), np.int64)}
    for r in range(ROUNDS):
        now = dict(totals)

        def seated(share, pairs, now=now):
            shop = Restaurants(pairs, share, now)
            for _ in range(BURN_IN + 1):
                shop.sweep()
            return shop.tables, float(shop.root_tables[~shop.spread].sum()), shop.tables

        tables, single, often_customers = total(seated)
        often_customers = often_customers.astype(np.int64)
        often_tables = seat(np.random.default_rng([shares, r]), often_customers, np.full(len(often), root_room(totals)), DISCOUNTS[1])
        totals |= {"round": r + 1, "tables": tables, "root_customers": tables.sum(), "root_tables": single + often_tables.sum()}
        totals |= {"often_customers": often_customers, "often_tables": often_tables}
    return model, totals


def scored(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("held_out", is_held_out(F.col("key")))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    shares = tasks_for((size["n"] or 0) // 6 + size["rows"], SHARE_TOKENS)
    model, totals = fit(rows.where("not held_out").select("text"), shares)
    often = totals["often"]
    shared = docs.sparkSession.sparkContext.broadcast(totals)  # CONTEXTS numbers twice, fewer than OFTEN words
    below = totals["tokens"] + totals["distinct"] + 1.0

    def ask(batches):
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(1)):
                r, w, c = token_pairs(data, offsets)
                ids = batch.column(2).slice(a, b - a).to_numpy(zero_copy_only=False)
                order = in_order(w, c)
                r, w, c = r[order], w[order], c[order]
                order, runs = _runs(share_of(w, c, often, shares))
                r, w, c = r[order].astype(np.uint32), w[order], c[order]
                blobs = []
                for _, x, y in runs:
                    words, n = by_word(w[x:y])
                    blobs.append(packed(words, n, c[x:y], r[x:y], ids[:1]))
                own = np.zeros(b - a, OWN)
                keys = batch.column(0).slice(a, b - a)
                own["row"], own["n"] = ids, np.bincount(r, minlength=b - a)
                own["key"], own["keyed"] = keys.fill_null(0).to_numpy(zero_copy_only=False), keys.is_valid().to_numpy(zero_copy_only=False)
                order, owners = _runs(row_bucket(ids, shares))
                own = own[order]
                asked = blobs + [None] * len(owners)
                owned = [None] * len(blobs) + [own[x:y].tobytes() for _, x, y in owners]
                columns = [pa.array([s for s, _, _ in runs + owners], pa.int32()), pa.array(asked, pa.binary()), pa.array(owned, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["share", "asked", "own"])

    # row numbers run on within a partition, so a block needs only its first
    asked = rows.select("key", "text", F.monotonically_increasing_id().alias("row")).mapInArrow(ask, "share int, asked binary, own binary")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "parts": pa.array([], pa.binary()), "own": pa.array([], pa.binary())})
        share = left.column("share")[0].as_py()
        pairs = unpacked_pairs(right.column("pairs")[0].as_py()) if right.num_rows else np.zeros(0, PAIR)
        shop = Restaurants(pairs, share, shared.value)
        averaged = shop.average()
        found = []
        for blob in left.column("asked").drop_null():
            words, n, c, r, first = unpacked(blob.as_py())
            log_p, counts = shop.lookup(np.repeat(words, n), c, averaged)
            at = np.unique(r)
            where = np.searchsorted(at, r)
            add = [np.bincount(where, weights=x, minlength=len(at)) for x in (counts > 0, np.log10((counts + 1) / below), log_p)]
            found.append((at.astype(np.int64) + first[0], *add))
        numbers, blobs = [], []
        if found:
            row, known, base, score = (np.concatenate(x) for x in zip(*found, strict=True))
            order, runs = _runs(row_bucket(row, shares))
            row, known, base, score = row[order], known[order].astype(np.uint32), base[order], score[order].astype(np.float32)
            numbers = [s for s, _, _ in runs]
            blobs = [packed(row[x:y], known[x:y], base[x:y], score[x:y]) for _, x, y in runs]
        own = left.column("own").drop_null().to_pylist()
        columns = [numbers + [share] * len(own), blobs + [None] * len(own), [None] * len(blobs) + own]
        kinds = (pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "parts", "own"])

    def total(group: pa.Table) -> pa.Table:
        own = np.concatenate([np.frombuffer(b, OWN) for b in group.column("own").drop_null().to_pylist()])
        own = own[np.argsort(own["row"])]
        sums = np.zeros((3, len(own)))
        for blob in group.column("parts").drop_null():
            row, *add = unpacked(blob.as_py())
            where = np.searchsorted(own["row"], row)
            for s, x in zip(sums, add, strict=True):
                s += np.bincount(where, weights=x, minlength=len(own))
        columns = [pa.array(own["key"].copy(), mask=own["keyed"] == 0), pa.array(own["n"].copy()), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])]
        return pa.table(columns, names=["key", "n", "known", "base", "score"])

    answers = asked.groupBy("share").cogroup(model.groupBy("share")).applyInArrow(answer, "bucket int, parts binary, own binary")
    whole = answers.groupBy("bucket").applyInArrow(total, "key long, n long, known long, base double, score double")
    return whole.select(
        F.col("key").alias(key),
        is_held_out(F.col("key")).alias("held_out"),
        F.col("n").alias("n_tokens"),
        F.col("known").alias("n_known"),
        F.lit(int(totals["tokens"])).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
