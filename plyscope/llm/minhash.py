"""Near-duplicate documents by ProbMinHash signatures, banding and exact verification.

A document is its shingles of five words (lower case, split at white space), each weighted by how often it occurs; a
shorter document is one shingle of all its words. Every shingle has a stream of random arrivals that depends on
nothing but the shingle: exponential gaps divided by its weight, each arrival going to a random register. A register
keeps the shingle that arrives first, and a shingle is dropped as soon as it arrives later than the last of the
registers. Two documents agree in a register with the probability Jaccard similarity of their weights, which for
shingles that occur once is the Jaccard similarity of the sets.

Documents that agree in all registers of a band are candidates. Of each band's bucket only links to one member, the
one that shares most buckets with others, are tried first (linear in the bucket), then those links whose ends are still apart, and last the members that are
still in different classes, block by block. Every link is verified by the exact similarity. A class is a connected set of
verified links; its id is the smallest document id in it.

NULL text counts as empty. Texts without a word are near-duplicates only of equal texts. Equal texts always share a
class. NULL ids are carried along and never name a class unless all its documents have none. Repeated rows each get
their row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plyscope.llm.common import components, mix, settled, shingle_hashes, stored, text_blocks, uniform, word_hashes

WORDS = 5
THRESHOLD = 0.8
BANDS = 24
BAND_ROWS = 5
#: Up to so many members all pairs of a bucket are verified as rows; larger buckets are compared block by block.
FEW_MEMBERS = 16
BLOCK_MEMBERS = 256
_ROW_BITS = 14
_ID_BITS = 64 - _ROW_BITS


def weighted_shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS):
    """Row, shingle (50 bits) and count of the distinct shingles of a block, in order."""
    h, rows, _, _ = word_hashes(data, offsets)
    s, rows = shingle_hashes(h, rows, words)
    keys = np.sort((rows.astype(np.uint64) << np.uint64(_ID_BITS)) | (s >> np.uint64(_ROW_BITS)))
    if not len(keys):
        return rows, s, rows
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return (keys >> np.uint64(_ID_BITS)).astype(np.int64), keys & np.uint64((1 << _ID_BITS) - 1), counts


def signatures(rows: np.ndarray, shingles: np.ndarray, weights: np.ndarray, n: int, registers: int) -> np.ndarray:
    """The shingle in every register of rows 0 to n - 1; 0 throughout for rows without a shingle."""
    first_at = np.full(n * registers, np.inf)
    kept = np.zeros(n * registers, dtype=np.uint64)
    seed, at, time, weight, turn = mix(shingles), rows, np.zeros(len(rows)), weights.astype(float), 0
    ids = shingles
    while len(ids):
        turn += 1
        draw = mix(seed + np.uint64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        time = time - np.log(uniform(draw)) / weight
        place = at * registers + (mix(draw) % np.uint64(registers)).astype(np.int64)
        better = np.flatnonzero(time < first_at[place])
        order = better[np.argsort(-time[better], kind="stable")]  # the earliest is written last
        first_at[place[order]] = time[order]
        kept[place[order]] = ids[order]
        last = first_at.reshape(n, registers).max(axis=1)
        on = time < last[at]
        ids, seed, at, time, weight = ids[on], seed[on], at[on], time[on], weight[on]
    return kept.reshape(n, registers)


def band_keys(kept: np.ndarray, bands: int, size: int) -> np.ndarray:
    """One 64-bit key for each band and row."""
    out = np.zeros((len(kept), bands), dtype=np.uint64)
    for b in range(bands):
        h = np.full(len(kept), b + 1, dtype=np.uint64)
        for r in range(size):
            h = mix(h ^ kept[:, b * size + r]) + np.uint64(r)
        out[:, b] = h
    return out


def similarity(a: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_n: np.ndarray) -> float:
    """Probability Jaccard similarity of two weighted sets (sorted ids and counts)."""
    common, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if a_n.max() == 1 and b_n.max() == 1:
        return len(common) / (len(a) + len(b) - len(common))
    union = np.union1d(a, b)
    wa, wb = np.zeros(len(union)), np.zeros(len(union))
    wa[np.searchsorted(union, a)] = a_n
    wb[np.searchsorted(union, b)] = b_n
    with np.errstate(divide="ignore"):
        ratio = np.where(wb > 0, wa / np.where(wb > 0, wb, 1), np.inf)
    order = np.argsort(ratio)
    ratio, wa, wb = ratio[order], wa[order], wb[order]
    at = np.searchsorted(ratio, a_n[i] / b_n[j], side="left")
    below = np.concatenate([[0.0], np.cumsum(wb)])[at]
    above = wa.sum() - np.concatenate([[0.0], np.cumsum(wa)])[at]
    return float((1.0 / (above / a_n[i] + below / b_n[j])).sum())


def banded(df: DataFrame, key: str, text: str, words: int, bands: int, size: int) -> DataFrame:
    """key, t (digest of the text) and keys (one for each band, empty for texts without a word)."""
    rows = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("key", F.unhex(F.md5("text")).alias("t"), "text")

    def sign(batches):
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(2)):
                for at in range(a, b, 1 << 12):
                    to = min(b, at + (1 << 12))
                    part = offsets[at - a : to - a + 1]
                    r, s, n = weighted_shingles(data[part[0] : part[-1]], part - part[0], words)
                    keys = band_keys(signatures(r, s, n, to - at, bands * size), bands, size).view(np.int64)
                    some = np.zeros(to - at, dtype=bool)
                    some[r] = True
                    ends = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[some].reshape(-1)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), batch.column(1).slice(at, to - at), lists], names=["key", "t", "keys"])

    return rows.mapInArrow(sign, "key long, t binary, keys array<long>")


def verified(pairs: DataFrame, texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """Pairs (a, b) whose texts are at least as similar as the threshold; texts: t, text."""
    both = pairs.select("a", "b").join(texts.select(F.col("t").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("t").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")

    def check(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                n = b.num_rows
                names = pa.concat_arrays([b.column(0), b.column(1)]).to_pylist()
                texts_ = pa.concat_arrays([b.column(2).cast(pa.large_string()), b.column(3).cast(pa.large_string())])
                first: dict[bytes, int] = {}
                for i, t in enumerate(names):
                    first.setdefault(t, i)
                chosen = list(first.values())
                sets = []
                for _, _, data, offsets in text_blocks(texts_.take(pa.array(chosen))):
                    r, s, c = weighted_shingles(data, offsets, words)
                    cuts = np.searchsorted(r, np.arange(len(offsets)))
                    sets += [(s[x:y], c[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]
                number = {t: k for k, t in enumerate(first)}
                good = [similarity(*sets[number[names[i]]], *sets[number[names[n + i]]]) >= threshold - 1e-12 for i in range(n)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(good))

    return both.mapInArrow(check, "a binary, b binary")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one class."""
    ends = pairs
    for side in ("a", "b"):
        ends = ends.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root")), side, "left")
    return ends.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select(*pairs.columns)


def between_blocks(members: DataFrame, texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """Verified links (a, b) that join all classes which are linked inside a bucket, none twice in a comparison.

    members: h, t, root, n. A bucket is cut into blocks of about ``BLOCK_MEMBERS`` and every two blocks are compared
    in a task of their own, by products of the matrices of shingles that several of them have.
    """
    blocks = members.withColumn("of", F.ceil(F.col("n") / BLOCK_MEMBERS).cast("int"))
    blocks = blocks.withColumn("own", F.pmod(F.xxhash64("t"), "of").cast("int"))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    blocks = blocks.select("h", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "t", "root").join(texts, "t")

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("t").combine_chunks()
        names, roots, own = (group.column(c).to_pylist() for c in ("t", "root", "own"))
        sets = []
        for _, _, data, offsets in text_blocks(group.column("text").combine_chunks() if len(names) else pa.array([], pa.string())):
            r, s, c = weighted_shingles(data, offsets, words)
            cuts = np.searchsorted(r, np.arange(len(offsets)))
            sets += [(s[x:y], c[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]
        size = np.array([len(s) for s, _ in sets])
        plain = np.array([bool((c == 1).all()) for _, c in sets])
        every, inverse, n = np.unique(np.concatenate([s for s, _ in sets]), return_inverse=True, return_counts=True)
        shared = np.flatnonzero(n > 1)
        column = np.full(len(every), -1)
        column[shared] = np.arange(len(shared))
        row = np.repeat(np.arange(len(sets)), size)
        counts = np.concatenate([c for _, c in sets]).astype(np.float32)
        common, weight = (np.zeros((len(sets), len(sets)), np.float32) for _ in range(2))
        at = column[inverse]
        for begin in range(0, len(shared), 8192):
            here = (at >= begin) & (at < begin + 8192)
            m = np.zeros((len(sets), min(8192, len(shared) - begin)), np.float32)
            m[row[here], at[here] - begin] = 1
            common += m @ m.T
            heavy = m.copy()
            heavy[row[here], at[here] - begin] = counts[here]
            weight += heavy @ m.T
        label = np.unique(np.array([x.hex() for x in roots]), return_inverse=True)[1]
        side = np.array(own)
        apart = (label[:, None] < label[None, :]) & (common > 0)
        if group.column("low")[0].as_py() != group.column("high")[0].as_py():
            apart &= side[:, None] != side[None, :]
        i, j = np.nonzero(apart)
        both = plain[i] & plain[j]
        x, y = i[both], j[both]
        good = common[x, y] >= (threshold - 1e-9) * (size[x] + size[y] - common[x, y])
        sure = np.stack([x[good], y[good]], axis=1)
        # with repeated shingles the similarity is at most 1 / (A / A' + B / B' - 1), the primes being what is common
        x, y = i[~both], j[~both]
        whole = np.bincount(row, weights=counts, minlength=len(sets))
        bound = 1.0 / (whole[x] / weight[x, y] + whole[y] / weight[y, x] - 1.0)
        order = np.argsort(-bound, kind="stable")
        maybe = np.stack([x, y], axis=1)[order[bound[order] >= threshold - 1e-5]]
        of = list(range(label.max() + 1))

        def top(c):
            while of[c] != c:
                of[c] = c = of[of[c]]
            return c

        linked = []
        _, first = np.unique(label[sure], axis=0, return_index=True)
        for pairs, known in ((sure[first], True), (maybe, False)):
            for x, y in pairs.tolist():
                low, high = sorted((top(label[x]), top(label[y])))
                if low != high and (known or similarity(*sets[x], *sets[y]) >= threshold - 1e-12):
                    of[high] = low
                    linked.append((names[x], names[y]))
        return pa.table({"a": pa.array([a for a, _ in linked], pa.binary()), "b": pa.array([b for _, b in linked], pa.binary())})

    return blocks.groupBy("h", "low", "high").applyInArrow(compare, "a binary, b binary").distinct()


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD, bands: int = BANDS, band_rows: int = BAND_ROWS
) -> DataFrame:
    """Rows of key, t (digest of the text), class_id, links (verified links that formed the class), class_t (its document's t)."""
    docs = stored(banded(df, key, text, words, bands, band_rows), "signatures")
    texts = docs.groupBy("t").agg(F.min("key").alias("first"), F.any_value("keys").alias("keys"))
    members = texts.select("t", F.explode("keys").alias("h"))
    sizes = members.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = stored(members.join(sizes, "h"), "crowded")
    # the member that meets most others is likely the text that the others were made from
    met = crowded.groupBy("t").agg(F.sum("n").alias("met"))
    hubs = crowded.join(met, "t").groupBy("h").agg(F.max(F.struct("met", "t")).alias("hub"))
    hubs = hubs.select("h", F.col("hub.t").alias("hub"), F.col("hub.met").alias("met"))
    bucketed = stored(crowded.select("h", "t").join(hubs, "h"), "buckets")

    involved = bucketed.select("t").distinct().join(texts.select("t", "first"), "t")
    source = df.select(F.col(f"`{key}`").cast("long").alias("k"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    source = source.select("k", F.unhex(F.md5("text")).alias("t"), "text")
    match = (source["t"] == involved["t"]) & source["k"].eqNullSafe(involved["first"])
    held = stored(source.join(involved, match, "left_semi").groupBy("t").agg(F.any_value("text").alias("text")), "texts")

    def confirm(pairs: DataFrame) -> DataFrame:
        return settled(verified(pairs, held, words, threshold))

    star = bucketed.where("t != hub").groupBy(F.col("t").alias("a")).agg(F.max(F.struct("met", "hub")).alias("best"))
    star = star.select("a", F.col("best.hub").alias("b"))
    links = confirm(star)
    roots = components(links)
    rest = bucketed.where("t != hub").select(F.col("t").alias("a"), F.col("hub").alias("b")).distinct()
    tried = star.unionByName(rest)
    more = confirm(_apart(rest, roots).join(star, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        links = settled(links.unionByName(more))
        roots = components(links)
    # buckets whose members are still in different classes
    placed = bucketed.select("h", "t").join(roots.select(F.col("node").alias("t"), "root"), "t", "left")
    placed = placed.withColumn("root", F.coalesce("root", "t"))
    mixed = placed.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")).where("low != high")
    open_ = settled(placed.join(mixed.select("h", "n"), "h"))
    few = open_.where(F.col("n") <= FEW_MEMBERS)
    left = few.select("h", F.col("t").alias("a"), F.col("root").alias("ra"))
    right = few.select("h", F.col("t").alias("b"), F.col("root").alias("rb"))
    last = left.join(right, "h").where("a < b and ra != rb").select("a", "b").distinct()
    last = last.join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), ["a", "b"], "left_anti")
    more = confirm(last).unionByName(settled(between_blocks(open_.where(F.col("n") > FEW_MEMBERS), held, words, threshold)))
    if not more.isEmpty():
        links = settled(links.unionByName(more))
        roots = components(links)

    named = texts.select("t", "first").join(roots.select(F.col("node").alias("t"), "root"), "t", "left")
    named = named.withColumn("root", F.coalesce("root", "t"))
    smallest = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "t"))
    classes = named.groupBy("root").agg(smallest.alias("kept"))
    count = links.select(F.col("a").alias("t")).unionByName(links.select(F.col("b").alias("t"))).groupBy("t").agg(F.count(F.lit(1)).alias("links"))
    found = named.join(classes, "root").join(count, "t", "left")
    found = found.select("t", F.col("kept.first").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), F.col("kept.t").alias("class_t"))
    found = stored(found, "classes")
    return docs.select(F.col("key").alias(key), "t").join(found, "t").select(key, "t", "class_id", "links", "class_t")


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of every class: the document with the smallest id (NULL last), and of its repeated rows any one."""
    classes = near_duplicates(df, key, text, **options)
    chosen = classes.where((F.col("t") == F.col("class_t")) & F.col(key).eqNullSafe(F.col("class_id")))
    chosen = stored(chosen.groupBy("t", F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("rows")), "kept")
    # the caller's columns go by numbers, so that none clashes with those made here
    numbered = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    k, body = (F.col(f"c{df.columns.index(c)}") for c in (key, text))
    rows = numbered.withColumns({"_t": F.unhex(F.md5(F.coalesce(body.cast("string"), F.lit("")))), "_k": k.cast("long")})

    def of(which: DataFrame) -> DataFrame:
        return rows.join(which, (rows["_t"] == which["t"]) & rows["_k"].eqNullSafe(which["_key"]), "left_semi")

    repeated = of(chosen.where("rows > 1")).dropDuplicates(["_t"])
    left = of(chosen.where("rows = 1")).unionByName(repeated)
    return left.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])
