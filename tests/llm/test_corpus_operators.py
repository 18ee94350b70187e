"""The corpus operators on small, awkward inputs, against brute force and round trips."""

from __future__ import annotations

import collections
import gzip
import hashlib
import io
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T
from tokenizers import Tokenizer

from plyscope.llm import bpe, chat, lines, lm, lsh, minhash, packing, topk, toxicity, vectors, warc
from plyscope.llm.common import word_hashes
from plyscope.llm.queries import vocabulary

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, sequence_id int"
BYTE, WORD = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")


def docs_of(spark, rows):
    """Documents with columns whose names clash with those that operators add."""
    full = [(i, t, None, "src0", len(t or ""), 9.0, "own", 5) for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def words(rng, n, vocabulary_size=400):
    return [f"w{int(x)}" for x in rng.integers(0, vocabulary_size, n)]


@pytest.fixture(scope="module")
def awkward():
    rng = np.random.default_rng(5)
    base = " ".join(words(rng, 120))
    near = base.split()
    near[60] = "changed"
    other = " ".join(words(rng, 90))
    return [
        (1, base),
        (2, base),
        (3, " ".join(near)),
        (4, None),
        (5, ""),
        (6, "  \n\t "),
        (7, "short one"),
        (8, other + "\n" + base),
        (None, other),
        (9, other),
        (9, other),
        (10, "é ünï <|endoftext|> ΟΔΟΣ. İ \x1c x y ퟿ 👩‍👩‍👧 é ... 'll"),
        (11, "x" * 5000),
        (12, " ".join(words(rng, 6000))),
    ]


def tokenizer(path):
    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    return t


# 1


@pytest.mark.parametrize("leaf", [64, 32_768])
def test_bpe_pieces_that_end_in_white_space(spark, leaf):
    t = tokenizer(BYTE)
    shift = ["", "x", "xy", "xyz "]
    parts = ["ab\n\n", "中文字\n\n", "ab\t\t", "é\n \n\n", "a\n\n\n中"]
    rows = [(100 * i + j, s + p * (3 * leaf // len(p))) for i, p in enumerate(parts) for j, s in enumerate(shift)]
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(docs_of(spark, rows), BYTE, leaf=leaf).collect()}
    for i, text in rows:
        assert got[i] == t.encode(text, add_special_tokens=False).ids


def test_callers_columns_keep_their_values(spark):
    """Names that the operators use inside."""
    names = ["_rk", "_doc", "_gone", "_t", "_key", "t", "_k", "c0", "c1", "_links", "_score"]
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(i, base if i < 2 else f"only here {i}", *[f"{n}{i}" for n in names]) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    done = {r["doc_id"]: r for r in lines.dedup_lines(df).collect()}
    assert all(done[i][n] == f"{n}{i}" for i in range(4) for n in names) and done[1]["n_removed"] == 1
    kept = {r["doc_id"]: r for r in minhash.one_of_each(df).collect()}
    assert sorted(kept) == [0, 2, 3] and all(kept[i][n] == f"{n}{i}" for i in kept for n in names)
    import corpus_pipeline

    labels = spark.createDataFrame([(i, 0) for i in range(4)], "doc_id long, toxic int")
    clean = corpus_pipeline.without_toxic(df.withColumn("score", F.lit("own")), labels).collect()
    assert len(clean) == 4 and all(r["score"] == "own" and r["_score"] == f"_score{r['doc_id']}" for r in clean)


def test_rows_without_an_id_are_not_held_out(spark):
    rows = spark.createDataFrame([(None,), (3,)], "doc_id long").select(toxicity.is_held_out(F.col("doc_id")).alias("h")).collect()
    assert rows[0]["h"] is False


@pytest.mark.parametrize("leaf", [64, 32_768])
def test_bpe_matches_the_tokenizer(spark, awkward, leaf):
    rows = awkward + [(20, "ab" * 700 + " " + "\n" * 300 + "!" * 301 + "é" * 200 + " 12345" * 60 + "<|endoftext|>" * 9)]
    t = tokenizer(BYTE)
    got = collections.Counter()
    for r in bpe.encode(docs_of(spark, rows), BYTE, leaf=leaf, decoded=True).collect():
        got[(r["doc_id"], tuple(r["ids"]), r["n_tokens"], r["decoded"], r["lang"], r["score"])] += 1
    want = collections.Counter()
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want[(i, tuple(ids), len(ids), t.decode(ids, skip_special_tokens=False), None, 9.0)] += 1
    assert got == want


def test_bpe_decode_and_join(spark):
    df = spark.createDataFrame([(1, [15496, 995]), (2, []), (3, None)], "k int, ids array<int>")
    assert {r["k"]: r["decoded"] for r in bpe.decode(df, BYTE).collect()} == {1: "Hello world", 2: "", 3: None}
    coder, rng = bpe.codec(BYTE), np.random.default_rng(1)
    for _ in range(200):
        run = "".join(rng.choice(list("aetnhorsi"), rng.integers(2, 80)))
        cut = int(rng.integers(0, len(run)))
        parts = [coder.encode_run(p.encode()) for p in (run[:cut], run[cut:])]
        assert coder.join(*parts) == coder.encode_run(run.encode())
    assert bpe.encode(docs_of(spark, []), BYTE).count() == 0


# 2


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], "page_id long, url string, html string, digest int, key string")


def test_warc_round_trip(spark):
    long = "<p>é</p>" * 40
    rows = [(3, "http://a", long), (1, "http://b", long), (2, None, "x"), (4, "u\r\nWARC/1.1", "x"), (5, "c", None), (6, "c", ""), (1, "d", long), (None, "e", long + "z"), (7, "f", "WARC/1.1\r\n\r\n" * 30)]
    for compress in (True, False):
        files = warc.write_archives(pages_of(spark, rows), compress=compress, archive_bytes=600)
        assert files.count() > 1
        read = warc.read_archives(files)
        assert read.where("kind = 'gap'").count() == 0
        got = sorted((str(r["record_key"]), r["record_type"], r["refers_to"], r["payload_length"], r["payload_digest"]) for r in read.collect())
        digest = lambda h: hashlib.sha256((h or "").encode()).hexdigest()
        want = sorted((str(i), "revisit" if i == 3 else "response", 1 if i == 3 else None, len((h or "").encode()), digest(h)) for i, _, h in rows)
        assert got == want
    assert warc.read_archives(warc.write_archives(pages_of(spark, []))).count() == 0


@pytest.mark.parametrize("compress", [True, False])
def test_warc_salvage(compress):
    records = [warc.record(i, f"u{i}", f"payload {i} ".encode() * 50, hashlib.sha256(f"payload {i} ".encode() * 50).hexdigest(), None, "d") for i in range(6)]
    parts = [gzip.compress(r) if compress else r for r in records]
    clean = b"".join(parts)
    offsets = [0, *itertools.accumulate(map(len, parts))]

    def keys(data):
        found = list(warc.salvage(io.BytesIO(data)))
        ends = 0
        for _, offset, length, *_ in found:  # in order, without overlap or hole
            assert offset == ends
            ends = offset + length
        assert ends == len(data)
        return [int(f[4]["x-key"]) for f in found if f[0] == "record"], [(f[1], f[2], f[3]) for f in found if f[0] == "gap"]

    assert keys(clean) == (list(range(6)), [])
    broken = bytearray(clean)
    at = offsets[2] + len(parts[2]) // 2
    broken[at : at + 4] = b"\0\1\2\3"
    got, gaps = keys(bytes(broken))
    assert got == [0, 1, 3, 4, 5] and [(g[0], g[1]) for g in gaps] == [(offsets[2], len(parts[2]))] and gaps[0][2]
    got, gaps = keys(clean[: offsets[5] + 20])
    assert got == [0, 1, 2, 3, 4] and gaps[0][:2] == (offsets[5], 20)
    got, gaps = keys(b"noise" + clean[:offsets[1]] + b"\x1f\x8b\x08junk WARC/" + clean[offsets[1] :])
    assert got == list(range(6)) and len(gaps) == 2
    assert keys(b"") == ([], [])


# 3


def test_language_model(spark, awkward):
    rng = np.random.default_rng(2)
    rows = awkward + [(i, " ".join(words(rng, 150, 60))) for i in range(100, 160)]
    got = sorted(lm.scored(docs_of(spark, rows)).collect(), key=lambda r: (str(r["doc_id"]), r["n_tokens"]))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    split = lambda t: [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), None]
    counts = collections.Counter(w for i, t in rows if not held(i) for w in split(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted(rows, key=lambda r: (str(r[0]), len(split(r[1]))))
    model = base = tokens = 0
    for r, (i, t) in zip(got, want, strict=True):
        own = split(t)
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["train_tokens"]) == (i, held(i), len(own), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
        assert math.isfinite(r["score"]) and r["score"] <= 0
        if held(i):
            model, base, tokens = model + r["score"], base + r["base_score"], tokens + len(own)
    assert tokens and model > base
    assert lm.scored(docs_of(spark, [])).count() == 0


def test_language_model_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    drawn = rng.integers(1, 30, 4000).astype(np.uint64) << np.uint64(40)
    pairs = lm.summed(drawn, rng.integers(lm.CONTEXTS - 9, lm.CONTEXTS, 4000).astype(np.uint32), np.ones(4000, np.int64))
    assert np.array_equal(lm.unpacked_pairs(lm.packed_pairs(pairs)), pairs)
    customers = np.bincount(pairs["c"], weights=pairs["n"], minlength=lm.CONTEXTS)
    none = np.zeros(0, np.int64)
    totals = {"round": 0, "customers": customers, "distinct": float(len(np.unique(pairs["w"]))), "tokens": customers.sum(), "tables": customers * 0.3}
    totals |= {"root_customers": customers.sum() * 0.3, "root_tables": totals["distinct"]}
    totals |= {"often": none.view(np.uint64), "often_counts": none, "often_customers": none, "often_tables": none}
    shop = lm.Restaurants(pairs, 0, totals)
    for _ in range(3):  # seats and totals come to agree
        shop.sweep()
        tables = np.bincount(pairs["c"], weights=shop.tables, minlength=lm.CONTEXTS)
        totals |= {"tables": tables, "root_customers": tables.sum(), "root_tables": float(shop.root_tables.sum())}
    seen = np.append(shop.words, np.uint64(31 << 50))  # and the unknown word
    for c in range(lm.CONTEXTS - 12, lm.CONTEXTS):  # some of them nobody has entered
        own = pairs["n"] - lm.DISCOUNTS[0] * shop.tables
        log_p, _ = shop.lookup(seen, np.full(len(seen), c), (own, shop.root(shop.root_customers, shop.root_tables)))
        assert (10.0**log_p).sum() == pytest.approx(1.0, abs=1e-6)


def test_language_model_knows_what_follows_a_word(spark):
    rng = np.random.default_rng(4)
    after = rng.permutation(50)
    rows = []
    for i in range(120):  # every word has one likely successor; alone, all words are as frequent
        at, text = int(rng.integers(0, 50)), []
        for _ in range(80):
            text.append(f"x{at}")
            at = int(after[at]) if rng.random() < 0.9 else int(rng.integers(0, 50))
        rows.append((i, " ".join(text)))
    held = [r for r in lm.scored(docs_of(spark, rows)).collect() if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in held)
    assert held and -sum(r["score"] for r in held) / tokens < 0.5 < 1.5 < -sum(r["base_score"] for r in held) / tokens


def test_language_model_of_several_shares(spark, awkward, monkeypatch):
    """Counts are those of one share, and scores differ by the seating alone; some words are in all shares."""
    rng = np.random.default_rng(6)
    rows = awkward + [(i, " ".join(words(rng, 150, 3000)) + " of the" * 40) for i in range(100, 160)]
    one = lm.scored(docs_of(spark, rows)).collect()
    monkeypatch.setattr(lm, "SHARE_TOKENS", 2000)
    monkeypatch.setattr(lm, "OFTEN", 64)
    many = lm.scored(docs_of(spark, rows)).collect()
    key = lambda r: (str(r["doc_id"]), r["n_tokens"], r["base_score"])
    for a, b in zip(sorted(one, key=key), sorted(many, key=key), strict=True):
        assert [a[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")] == [b[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")]
        assert a["base_score"] == pytest.approx(b["base_score"])
        assert a["score"] == pytest.approx(b["score"], rel=0.05, abs=0.1)


# 4 and 9


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    m = rng.normal(size=(400, 16)).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(m)]
    same = m[0].tolist()
    rows += [(1000 + i, same) for i in range(60)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [math.nan] + [0.0] * 15), (2003, [math.inf] + [1.0] * 15), (2004, [None] + [1.0] * 15), (None, same), (2020, [1.0, 2.0, 3.0]), (2021, [3.0, 2.0, 1.0])]
    return rows


def brute(rows, k, every, whole, nonzero):
    kept = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    kept = [(i, np.floor(v * 256) if whole else v) for i, v in kept if not nonzero or v.any()]
    out = {}
    for q, x in kept:
        if q % every == 0:
            scores = [(-float((x * v).sum()), i) for i, v in kept if i != q and len(v) == len(x)]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_exact_top_k(spark, points):
    rows = vectors.whole_vectors(vectors_of(spark, points), "vec_id", "embedding").withColumn("v", F.transform("v", lambda x: F.floor(x * 256).cast("double")))
    got = collections.defaultdict(list)
    for r in topk.exact_top_k(rows.where(vectors.is_query(F.col("id"), 20)), rows, 5, block_rows=64, query_rows=7, shares=3).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert got == {q: f for q, f in brute(points, 5, 20, True, False).items() if f}
    none = vectors.whole_vectors(vectors_of(spark, []), "vec_id", "embedding")
    assert topk.exact_top_k(none, none).count() == 0


def test_cross_polytope(spark, points):
    want = brute(points, 20, 20, False, True)
    got = collections.defaultdict(list)
    for r in lsh.nearest(vectors_of(spark, points), share_rows=50).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert set(got) == {q for q, f in want.items() if f}
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in f}) for q, f in want.items())
    assert hit >= 0.9 * sum(map(len, want.values()))
    known = {(q, i): s for q, f in brute(points, 10**6, 20, False, True).items() for i, s in f}
    assert all(s == pytest.approx(known[q, i], abs=1e-9) for q, f in got.items() for i, s in f)
    assert got[2020] == want[2020]  # fewer candidates than asked for: all of them
    assert all(f == sorted(f, key=lambda x: (-x[1], x[0])) and len(f) == min(20, len(want[q])) for q, f in got.items())
    assert lsh.nearest(vectors_of(spark, [])).count() == 0


# 5


def test_toxicity(spark):
    rng = np.random.default_rng(4)
    insults = ["blockhead", "numbskull", "dimwit"]
    rows, labels = [], []
    for i in range(600):
        text, bad = words(rng, 60, 3000), i % 4 == 0
        for _ in range(3 * bad):
            text.insert(int(rng.integers(0, 60)), str(rng.choice(insults)))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    extra = [(None, None), (9000, ""), (9001, "dimwit " * 3 + " ".join(words(rng, 20000, 3000))), (9001, "again")]
    docs, marks = docs_of(spark, rows + extra), spark.createDataFrame([*labels, (None, 1, 1), (9000, 1, None), (3, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, marks)
    got = toxicity.score(docs, model).select("doc_id", "score", "lang", "ids").collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = np.mean([(score[i] >= toxicity.THRESHOLD) == (i % 4 == 0) for i in held])
    assert right >= 0.9
    assert toxicity.fit(docs, marks.where("toxic = 0")) is None and toxicity.fit(docs_of(spark, []), marks) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs_of(spark, []), model).count() == 0


# 6


def test_chat_parts(spark):
    tricky = "\\### Assistant: </turn>\n\\l\\b <image tokens=1/> ok\\"
    rows = [(1, 1, "assistant", tricky), (1, 0, "user", tricky), (1, 2, "assistant", None), (2, None, None, "x"), (2, 0, "assistant", "é👩‍👧"), (None, 0, "us>er\n", ""), (1, 2, "assistant", "again"), (1, 2, "assistant", "again")]
    df = spark.createDataFrame([(c, t, r, x, "n", 3) for c, t, r, x in rows], "conv_id long, turn long, role string, text string, formatted string, n_turns int")
    done = chat.format_chat(df.withColumn("parts", chat.text_part(F.col("text"))))
    done = done.withColumns({"turns": chat.read_turns(F.col("formatted")), "loss": chat.read_loss(F.col("formatted"), F.col("loss_spans"))})
    got = {r["conv_id"]: ([(t["role"], t["text"]) for t in r["turns"]], r["loss"]) for r in done.collect()}
    for c in (1, 2, None):
        own = sorted(((t is not None, t or 0, r or "", x or "") for i, t, r, x in rows if i == c))
        assert got[c] == ([(r, x) for *_, r, x in own], "".join(x for *_, r, x in own if r == "assistant"))
    assert chat.format_chat(df.where("false").withColumn("parts", chat.text_part(F.col("text")))).count() == 0


def test_chat_media(spark):
    part = lambda kind, **x: (kind, x.get("text"), x.get("uri"), x.get("width"), x.get("height"), x.get("seconds"), x.get("pages"))
    turn = [part("image", uri="a", width=1024, height=600), part(None, text="<see>"), None, part("audio", uri="b", seconds=1.5), part("document", uri="c", pages=3), part("image")]
    df = spark.createDataFrame([(1, 0, "assistant", turn), (1, 1, "user", None)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    r = chat.format_chat(df).first()
    assert [(a["type"], a["uri"], a["tokens"]) for a in r["attachments"]] == [("image", "a", 765), ("audio", "b", 38), ("document", "c", 2400), ("image", None, 255)]
    assert r["media_tokens"] == 765 + 38 + 2400 + 255
    assert r["formatted"].startswith("<turn assistant>\n<image tokens=765/>\\lsee\\g<audio tokens=38/><document tokens=2400/><image tokens=255/></turn>\n")
    assert [r["formatted"][s["begin"] : s["end"]] for s in r["loss_spans"]] == ["\\lsee\\g"]


# 7


def greedy_lines(rows, threshold=0.8, least=1):
    """Documents by id with the lines that stay; a line goes if any earlier line matches."""
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    seen, out = [], {}
    for some, i, text in order:
        kept = []
        for line in text.split("\n"):
            own = frozenset(line.encode().lower().split())
            hit = len(own) >= least and any(len(own & s) >= threshold * len(own | s) - 1e-12 for s in seen)
            if len(own) >= least:
                seen.append(own)
            if not hit:
                kept.append(line)
        out[(i if some else None, text)] = "\n".join(kept)
    return out


def test_line_dedup(spark, awkward):
    rng = np.random.default_rng(6)
    pool = [" ".join(words(rng, int(n), 80)) for n in rng.integers(1, 30, 40)]

    def vary(line):
        w = line.split()
        for _ in range(int(rng.integers(0, 3))):
            w[int(rng.integers(0, len(w)))] = f"v{int(rng.integers(0, 9))}"
        return " ".join(w)

    family = " ".join(words(rng, 25, 10_000))
    rows = [(i, "\n".join(vary(str(rng.choice(pool))) for _ in range(int(rng.integers(0, 8))))) for i in range(40, 160)]
    rows += [(i, vary(family) + "\n\n" + vary(family)) for i in range(200, 240)] + [r for r in awkward if r[0] is not None] + [(500, "a b c d e\r\nA B C D E\n\na b c d e f\n")]
    want = greedy_lines(rows)
    got = lines.dedup_lines(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = collections.Counter(i for i, _ in rows)
    for r in got:
        options = {kept for (i, _), kept in want.items() if i == r["doc_id"]}
        assert (r["text"] or "") in options and (texts[r["doc_id"]] > 1 or len(options) == 1)
        assert r["score"] == 9.0 and r["n_lines"] - r["n_removed"] >= 0
    assert sum(r["n_removed"] for r in got) > 100
    assert lines.dedup_lines(docs_of(spark, [])).count() == 0


def links_by_force(rows, threshold=0.8, least=1):
    """id -> (documents with another id in its classes of lines, added up; smallest id of the class; earlier matching ids)."""
    sets = collections.defaultdict(set)
    for i, t in rows:
        sets[i] |= {s for line in (t or "").split("\n") if len(s := frozenset(line.encode().lower().split())) >= least}
    near = collections.defaultdict(set)
    for x, y in itertools.combinations(sets, 2):
        if any(len(a & b) >= threshold * len(a | b) - 1e-12 for a in sets[x] for b in sets[y]):
            near[x].add(y)
            near[y].add(x)
    every = set().union(*sets.values())
    alike = {a: {b for b in every if len(a & b) >= threshold * len(a | b) - 1e-12} for a in every}

    def reach(start, step):
        seen, open_ = {start}, [start]
        while open_:
            new = step[open_.pop()] - seen
            seen |= new
            open_ += new
        return frozenset(seen)

    classes = {a: reach(a, alike) for a in every}
    holders = collections.Counter(c for own in sets.values() for c in {classes[a] for a in own})
    out = {}
    for i in sets:
        earlier = {x for x in near[i] if x is None or (i is not None and x < i)}
        links = sum(holders[c] - 1 for c in {classes[a] for a in sets[i]})
        out[i] = (links, min((x for x in reach(i, near) if x is not None), default=None), earlier)
    return out


def test_line_links_and_classes(spark, awkward):
    chain = [f"c{i}" for i in range(40)]
    swap = lambda *at: " ".join(f"x{i}" if i in at else w for i, w in enumerate(chain))
    rows = [*awkward, (610, swap(0, 1, 2, 3)), (620, swap(0, 1)), (630, swap(4, 5)), (640, swap(0, 1) + "\nother"), (650, swap(20, 21, 4, 5)), (660, swap(20, 21, 22, 23, 24, 4))]
    rng = np.random.default_rng(11)
    pool = [words(rng, int(n), 80) for n in rng.integers(5, 30, 12)]
    for i in range(700, 760):
        text = []
        for _ in range(int(rng.integers(0, 4))):
            own = list(pool[int(rng.integers(0, len(pool)))])
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(0, len(own)))] = f"v{int(rng.integers(0, 30))}"
            text.append(" ".join(own))
        rows.append((i, "\n".join(text)))
    want = links_by_force(rows)
    assert len(want[640][2]) > 1
    got = lines.dedup_lines(docs_of(spark, rows)).collect()
    for r in got:
        links, smallest, earlier = want[r["doc_id"]]
        assert (r["links"], r["class_id"]) == (links, smallest), r["doc_id"]
        assert links >= len(earlier)
    # every link between two documents lies within a class
    place = {r["doc_id"]: r["class_id"] for r in got}
    assert all(place[x] == place[i] for i in want for x in want[i][2])


def test_short_lines_take_part(spark, tmp_path):
    from plyscope.llm.queries import QUERIES

    rows = [(1, "Yes\na b c d\n\n"), (2, "yes\na b c d e\nb c"), (3, "a b c\nno\n \n"), (4, "c b\nd c b A\nno no"), (5, "x\n\nq r s t u v")]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    kept, links = greedy_lines(rows, least=1), links_by_force(rows, least=1)
    got = QUERIES["op7_line_similarity_join"](spark, str(tmp_path)).collect()
    assert sum(r["n_removed"] for r in got) == 5
    for r, (i, t) in zip(sorted(got), rows, strict=True):
        assert r["text_sha256"] == hashlib.sha256(kept[(i, t)].encode()).hexdigest()
        assert (r["links"], r["class_id"]) == links[i][:2]


def test_lines_of_a_family_without_one_text_near_all(spark):
    """Every line matches its neighbours alone, so most of it is left to the further comparisons."""
    base = [f"z{i}" for i in range(400)]
    rows = [(i * 7 % 60 + 1000, " ".join(base[2 * i : 2 * i + 30]) + f"\nown{i} line of {i}") for i in range(60)]
    rows += [(2000 + i, " ".join(w if j % 30 != i else f"y{i}" for j, w in enumerate(base[:60]))) for i in range(30)]
    want, kept = links_by_force(rows), greedy_lines(rows)
    got = lines.dedup_lines(docs_of(spark, rows)).collect()
    assert {r["doc_id"]: (r["links"], r["class_id"]) for r in got} == {i: w[:2] for i, w in want.items()}
    bare = lines.dedup_lines(docs_of(spark, rows), linked=False).collect()
    for found in (got, bare):
        assert {r["doc_id"]: r["text"] for r in found} == {i: text for (i, _), text in kept.items()}


def test_every_matching_pair_of_lines_is_found(spark, monkeypatch):
    """Also pairs within one class whose later line has an earlier match: here all sets of a family, most of them alike."""
    rng = np.random.default_rng(21)
    rows, docs = [], collections.defaultdict(set)
    for i in range(90):
        family = [f"f{i % 3}w{j}" for j in range(24)]
        for _ in range(int(rng.integers(1, 5))):
            family[int(rng.integers(0, 24))] = f"v{int(rng.integers(0, 6))}"
        rows.append((i, " ".join(family) + "\n" + " ".join(family[:-1])))
    rows += [(90, rows[0][1]), (91, rows[1][1].split("\n")[0])]
    for i, t in rows:
        docs[i] |= {frozenset(line.encode().split()) for line in t.split("\n")}
    sets = sorted(set().union(*docs.values()), key=sorted)
    near = {a: [b for b in sets if a != b and len(a & b) >= 0.8 * len(a | b) - 1e-12] for a in sets}
    holders = collections.Counter(s for own in docs.values() for s in own)
    monkeypatch.setattr(lines, "PAIRS_AT_ONCE", 64)
    monkeypatch.setattr(lines, "BUCKET_ENTRIES", 100)
    got = {r["doc_id"]: r["direct_links"] for r in lines.dedup_lines(docs_of(spark, rows)).collect()}
    assert got == {i: sum(holders[s] - 1 + sum(holders[t] for t in near[s]) for s in own) for i, own in docs.items()}
    numbered = spark.createDataFrame([(i, i, t) for i, t in rows], "doc long, rk long, text string")
    _, matches = lines.matching_lines(numbered)
    assert matches.count() == matches.distinct().count() == sum(map(len, near.values())) // 2


# 8


def shingles(text):
    w = (text or "").encode().lower().split()
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def probability_jaccard(a, b):
    return sum(1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in a.keys() | b.keys()) for x in a.keys() & b.keys())


def classes_by_force(rows, threshold=0.8):
    root = {t or "": t or "" for _, t in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {t: shingles(t) for t in root}
    for x, y in itertools.combinations(sorted(root), 2):
        if sets[x].keys() & sets[y].keys() and probability_jaccard(sets[x], sets[y]) >= threshold - 1e-12:
            root[find(y)] = find(x)
    smallest = {}
    for i, t in rows:
        r = find(t or "")
        smallest[r] = min(filter(lambda v: v is not None, (smallest.get(r), i)), default=None)
    return sorted(((i, smallest[find(t or "")]) for i, t in rows), key=str)


def test_near_duplicates(spark, awkward):
    rng = np.random.default_rng(7)
    base = words(rng, 200, 10_000)
    rows = list(awkward)
    for i in range(300, 330):  # a family around one text, farther from each other than from it
        own = list(base)
        for _ in range(int(rng.integers(1, 4))):
            own[int(rng.integers(0, 200))] = f"v{i}"
        rows.append((i, " ".join(own)))
    rows += [(400, " ".join(base)), (401, " ".join(base[:40] * 3)), (402, " ".join(base[:40] * 4))]
    found = minhash.near_duplicates(docs_of(spark, rows))
    assert sorted(((r["doc_id"], r["class_id"]) for r in found.collect()), key=str) == classes_by_force(rows)
    kept = sorted((r["doc_id"] for r in minhash.one_of_each(docs_of(spark, rows)).collect()), key=str)
    classes = {c for _, c in classes_by_force(rows)}
    assert sorted(set(kept), key=str) == sorted(classes, key=str) and len(kept) == len(classes)
    assert minhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_near_duplicates_in_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "FEW_MEMBERS", 2)
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 8)
    rng = np.random.default_rng(8)
    base, rows = words(rng, 150, 10_000), []
    for i in range(60):
        own = list(base)
        for _ in range(int(rng.integers(2, 6))):
            own[int(rng.integers(0, 150))] = f"v{int(rng.integers(0, 400))}"
        rows.append((i, " ".join(own)))
    found = minhash.near_duplicates(docs_of(spark, rows))
    assert sorted(((r["doc_id"], r["class_id"]) for r in found.collect()), key=str) == classes_by_force(rows)


def test_near_duplicates_with_repeated_passages_in_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "FEW_MEMBERS", 2)
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 8)
    rng = np.random.default_rng(18)
    base, rows = words(rng, 90, 10_000), []
    for i in range(60):  # around the threshold, with shingles that occur several times on either side
        own = base[:60] + base[20:50] * int(rng.integers(1, 4)) + base[60:]
        for _ in range(int(rng.integers(1, 5))):
            own[int(rng.integers(0, len(own)))] = f"v{int(rng.integers(0, 400))}"
        rows.append((i, " ".join(own)))
    want = classes_by_force(rows)
    assert 1 < len({c for _, c in want}) < 50
    found = minhash.near_duplicates(docs_of(spark, rows))
    assert sorted(((r["doc_id"], r["class_id"]) for r in found.collect()), key=str) == want


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(9)
    ids = np.sort(rng.integers(1, 1 << 50, 300).astype(np.uint64))
    a, b = ids[:220], ids[60:]
    wa, wb = rng.integers(1, 4, len(a)), rng.integers(1, 4, len(b))
    kept = minhash.signatures(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), np.concatenate([wa, wb]), 2, 4000)
    exact = minhash.similarity(a, wa, b, wb)
    force = probability_jaccard(collections.Counter(dict(zip(a.tolist(), wa.tolist()))), collections.Counter(dict(zip(b.tolist(), wb.tolist()))))
    assert exact == pytest.approx(force)
    assert (kept[0] == kept[1]).mean() == pytest.approx(exact, abs=0.04)


# 10


def test_packing(spark, awkward):
    rows = awkward + [(i, "word " * (i * 37 % 900)) for i in range(100, 160)]
    done = packing.pack(packing.token_pieces(docs_of(spark, rows), WORD), group_items=32).collect()
    t = tokenizer(WORD)
    want = collections.Counter()
    for i, text in rows:
        want[(i, tuple([*t.encode(text or "", add_special_tokens=False).ids, packing.END_ID]))] += 1
    pieces = collections.defaultdict(lambda: collections.defaultdict(list))
    windows = collections.defaultdict(list)
    for r in done:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        pieces[(r["doc_id"], r["doc_tokens"])][r["start"]].append(ids)
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for (i, ids), n in want.items():
        at = 0
        while at < len(ids):
            here = pieces[(i, len(ids))][at]
            part = next(p for p in here if tuple(p) == ids[at : at + len(p)])
            assert sum(p == part for p in here) >= n
            at += len(part)
    assert sum(r["length"] for r in done) == sum(len(ids) * n for (_, ids), n in want.items())
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert packing.pack(packing.token_pieces(docs_of(spark, []), WORD)).count() == 0


def test_words_with_marks_leave_room_for_words(monkeypatch):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD)
    texts = ["one, two. three!! four; five", "été, über. ÀB! ÷x, a'll, it's! don't.", "six, seven! six; <|endoftext|>, (x) ..", "ß. 中文! ein, zwei,"]
    monkeypatch.setattr(packing, "MARKED_WORDS", 2)
    coder = packing.WordEncoder(WORD)
    for text in texts * 2:
        want = t.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.text(text.encode()), "<u4").tolist() == want
    assert {b"three", b"four", b"seven", b"zwei"} <= set(coder.known)
    assert not {b"three!!", b"four;", b"seven!", b"zwei,"} & set(coder.known)


def test_differencing_balances():
    rng = np.random.default_rng(10)
    for n in (1, 2, 7, 60, 200):
        lengths = rng.integers(1, 513, n)
        found = packing.balanced_windows(lengths, 2048)
        assert sorted(itertools.chain(*found)) == list(range(n))
        sums = [int(lengths[w].sum()) for w in found]
        assert max(sums) <= 2048 and len(found) <= -(-int(lengths.sum()) // 2048) + 2
        if n >= 60:
            assert max(sums) - min(sums) < 300


# helpers


def test_word_hashes_follow_rows():
    texts = ["a B  c", "", " b", "c\n", "é a"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    h, rows, starts, ends = word_hashes(data, offsets)
    got = [(int(r), bytes(data[s:e]).lower()) for r, s, e in zip(rows, starts, ends, strict=True)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in t.encode().lower().split()]
    assert len(set(h.tolist())) == len({w for _, w in got}) and h[1] == h[3] and h[0] == h[-1]


def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "packing"]
    step = dict(corpus_pipeline.STAGES)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    cleaned = step["line_dedup"](spark, docs, folder)
    assert cleaned.columns == docs.columns
    want = greedy_lines(list(texts.items()))
    assert {r["doc_id"]: r["text"] for r in cleaned.collect()} == {i: kept for (i, _), kept in want.items()}
    kept = step["near_dedup"](spark, docs, folder)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in classes_by_force(list(texts.items()))})
    clean = step["toxicity"](spark, docs, folder)
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    left = {r["doc_id"] for r in clean.collect()}
    assert clean.columns == docs.columns and np.mean([i in left for i in texts if marks.get(i) == 0]) > 0.9
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, folder)
        assert empty.count() == 0


def test_schema_is_stable(spark):
    assert isinstance(lm.scored(docs_of(spark, [(1, "a b")])).schema["score"].dataType, T.DoubleType)
