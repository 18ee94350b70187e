"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

A document is a set of terms weighted by their counts: its words in lower case (between white space; each ideograph,
kana or hangul syllable is a term of its own). For term x of weight w and sample k, numbers drawn from a hash of (x, k)
alone give r and c, each gamma distributed with shape 2, and b, uniform. With t = floor(ln w / r + b) the term bids
``ln c - r (t - b + 1)``, and the lowest bid of all terms is the sample. A bid depends on (x, t) only, so two documents
share a sample if their lowest bidders agree in term and t, which has a chance equal to their generalised Jaccard
similarity, the sum of the smaller weights over that of the larger ones. A fingerprint writes 16 bits of each sample in
hexadecimal; the likeness of two is the share of places where they agree.

Bids are columns of one hash aggregation, so a document of any length is summed up as it streams by. All
terms of a document come from its own row, which is moved once, with the beginnings of the texts that are wanted
elsewhere; terms are never moved.

``edited`` compares each document with an edited form of itself, its last quarter replaced by the beginning of the next
document. Documents are ordered by id (NULL first), those of one id by a hash of their text, the first follows the last,
and the neighbours are found by ranges of ids, never by one sort of the table. NULL text counts as empty. Rows equal in
id and text are one document here and all get its result. A text without words has the fingerprint of zeros, which is
like itself alone. Extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plyscope.llm.common import settled, stored

SAMPLES = 64
AT_ONCE = 8
LOWEST = -(2**63)  # stands for a NULL id
# scripts without spaces between words
IDEOGRAPH = r"[⺀-힯豈-﫿]"
BEHIND = r"(?<=[⺀-힯豈-﫿])"


def term_hashes(text: Column) -> Column:
    """A 64-bit hash of every occurrence of a term."""
    low = F.lower(text)
    words = F.when(low.rlike(IDEOGRAPH), F.split(low, rf"\s+|(?={IDEOGRAPH})|{BEHIND}")).otherwise(F.split(low, r"\s+"))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _uniform(bits: Column, shift: int, width: int) -> Column:
    """``width`` bits as a number strictly between 0 and 1."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
    return (part.cast("double") + 0.5) * 2.0**-width


def draws(term: Column, sample: Column) -> tuple[Column, Column, Column]:
    """r, ln c and b of a term for one sample."""
    first, second = F.xxhash64(term, sample), F.xxhash64(sample, term)
    r = -F.ln(_uniform(first, 0, 32) * _uniform(first, 32, 32))
    c = -F.ln(_uniform(second, 0, 22) * _uniform(second, 22, 21))
    return r, F.ln(c), _uniform(second, 43, 21)


def bid(drawn: tuple[Column, Column, Column], log_weight: Column) -> Column:
    """The bid of a term for one sample, the smaller, the better; NULL without a weight."""
    r, log_c, b = drawn
    # most words stand once in a text; their t is the whole part of b, zero
    t = F.when(log_weight == 0.0, F.lit(0).cast("long")).otherwise(F.floor(log_weight / r + b))
    return log_c - r * (t - b + 1.0)


def fingerprints(terms: DataFrame, keys: list[str], weights: dict[str, str], kept: list[Column] | None = None) -> DataFrame:
    """For every group of keys and each entry (name, weight column) of ``weights``, its samples ``name``, NULL if it has none.

    ``terms`` has ``term`` once for each group, and its weights; a NULL or zero weight does not take part, and rows
    without a term only keep their group. All weights share the draws of a term. Samples are dealt to some rows a
    term, as many as keep the unrolled columns in short compiled code. ``kept`` are further aggregates over a group.
    """
    turns = SAMPLES // AT_ONCE
    dealt = terms.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    dealt = dealt.withColumns({f"_l{i}": F.ln(F.col(c)) for i, c in enumerate(weights.values())})
    lowest = []
    for k in range(AT_ONCE):
        drawn = draws(F.col("term"), F.col("turn") * AT_ONCE + k)
        lowest += [F.min(bid(drawn, F.col(f"_l{i}"))).alias(f"_m{i}_{k}") for i in range(len(weights))]
    found = dealt.groupBy(*keys, "turn").agg(*lowest, *(kept or []))
    numbers = lambda i: F.array(*[F.xxhash64(f"_m{i}_{k}").bitwiseAND(F.lit(0xFFFF)).cast("int") for k in range(AT_ONCE)])
    names = [f"_n{i}" for i in range(len(weights))]
    parts = [F.when(F.col(f"_m{i}_0").isNotNull(), numbers(i)).alias(n) for i, n in enumerate(names)]
    rest = [c for c in found.columns if c not in (*keys, "turn") and not c.startswith("_m")]
    found = found.select(*keys, *rest, F.struct("turn", *parts).alias("_part"))
    whole = found.groupBy(*keys).agg(F.array_sort(F.collect_list("_part")).alias("_parts"), *[F.max(c).alias(c) for c in rest])
    made = [F.flatten(F.col(f"_parts.{n}")).alias(name) for n, name in zip(names, weights, strict=True)]
    return whole.select(*keys, *made, *rest)


def written(samples: Column) -> Column:
    """Samples as text, four hexadecimal digits each."""
    digits = F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x)), 4, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit("0000" * SAMPLES))


def likeness(a: Column, b: Column) -> Column:
    """Share of the samples that agree; 0 if one text has none, 1 if neither has any."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(F.size(same) / float(SAMPLES))


def _order(rows: DataFrame) -> DataFrame:
    """(kid, h, n, copies, pk, ph, pn): the documents, each with the key and length of the one before it in a circle.

    Ranges of keys are numbered by the partition they lie in; the ends of the ranges, a row each, close the gaps.
    """
    documents = rows.groupBy("kid", "h").agg(F.max(F.length("text")).alias("n"), F.count(F.lit(1)).alias("copies"))
    ranged = settled(documents.repartitionByRange("kid", "h").withColumn("range", F.spark_partition_id()))
    inside = Window.partitionBy("range").orderBy("kid", "h")
    me = F.struct("kid", "h", "n")
    placed = ranged.withColumn("before", F.lag(me).over(inside))
    ends = ranged.groupBy("range").agg(F.max(me).alias("last"))
    by_range = Window.partitionBy(F.lit(0)).orderBy("range")
    total = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gaps = ends.select("range", F.coalesce(F.lag("last").over(by_range), F.last("last").over(total)).alias("gap"))
    joined = placed.join(gaps, "range").withColumn("before", F.coalesce("before", "gap"))
    return settled(joined.select("kid", "h", "n", "copies", *[F.col(f"before.{c}").alias(p) for c, p in (("kid", "pk"), ("h", "ph"), ("n", "pn"))]))


def _term(part: int, x: Column, old: bool, new: bool) -> Column:
    return F.struct(F.lit(part).alias("part"), x.alias("x"), F.lit(old).alias("old"), F.lit(new).alias("new"))


def _digest_parts(text: Column) -> list[Column]:
    """SHA-256 as four longs, which aggregate in place."""
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10).cast("long") for i in range(4)]


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LOWEST)).alias("kid"), F.xxhash64(body).alias("h"), body.alias("text"))
    order = _order(rows)
    keys = ["kid", "h"]
    copies = Window.partitionBy(*keys).orderBy(F.lit(0))
    # the texts are moved once; both uses below read the same shuffle
    once = rows.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").drop("_copy").join(order, keys)
    quarter = lambda n: F.floor(F.col(n) / 4).cast("int")
    beginnings = once.select(F.col("pk").alias("kid"), F.col("ph").alias("h"), F.substring("text", F.lit(1), quarter("pn")).alias("new"))
    changed = F.concat(F.substring("text", F.lit(1), (F.col("n") - quarter("n")).cast("int")), F.col("new"))
    both = once.join(beginnings, keys).select(*keys, "n", "text", changed.alias("edited"))
    # the words up to the last white space before the cut are those of both texts
    shared = F.length(F.regexp_extract(F.substring("text", F.lit(1), (F.col("n") - quarter("n")).cast("int")), r"(?s)^(.*)\s", 1))
    both = both.withColumn("shared", shared)
    rest = lambda c: F.substring(c, F.col("shared") + 1, F.length(c))
    pieces = [(F.substring("text", F.lit(1), F.col("shared")), True, True), (rest("text"), True, False), (rest("edited"), False, True)]
    piece_term = lambda o, n: lambda x: _term(0, x, o, n)
    listed = [F.transform(term_hashes(t), piece_term(o, n)) for t, o, n in pieces]
    parts = F.array(*[_term(i + 1, p, False, True) for i, p in enumerate(_digest_parts(F.col("edited")))])
    listed = both.select(*keys, F.explode(F.concat(*listed, parts)).alias("e"))
    old, new = (F.count(F.when(c, 1)) for c in (F.col("e.old"), F.col("e.new")))
    counted = listed.groupBy(*keys, "e.part", "e.x").agg(old.alias("old"), new.alias("new"))
    terms = counted.withColumn("term", F.when(F.col("part") == 0, F.col("x")))
    digest = [F.max(F.when(F.col("part") == i + 1, F.col("x"))).alias(f"_d{i}") for i in range(4)]
    made = fingerprints(terms, keys, {"fingerprint": "old", "edited_fingerprint": "new"}, digest)
    sha = F.lower(F.concat(*[F.lpad(F.hex(f"_d{i}"), 16, "0") for i in range(4)]))
    made = stored(made.select(*keys, "fingerprint", "edited_fingerprint", sha.alias("edited_sha256")), "fingerprints")
    told = made.join(order, keys)
    following = told.select(F.col("pk").alias("kid"), F.col("ph").alias("h"), F.col("fingerprint").alias("next"))
    done = told.join(following, keys)
    return done.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        F.when(F.col("kid") != LOWEST, F.col("kid")).alias("doc_id"),
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        written(F.col("fingerprint")).alias("fingerprint"),
        written(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
    )
