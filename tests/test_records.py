from __future__ import annotations

from plyscope.sources.records import ingest, parse_records, read_records

TEXT = """[Event "Rated Blitz game"]
[Site "g1"]
[White "ann"]
[Black "bob"]
[Result "1-0"]
[WhiteElo "1450"]
[BlackElo "?"]
[ECO "B20"]
[Opening "Sicilian Defense: Alapin"]
[TimeControl "180+2"]

1. e4 { [%eval 0.2] [%clk 0:03:00] } 1... c5 { [%clk 0:02:58.5] } 2. c3?! $6 { comment (x) [%clk 0:02:57] } (2. Nf3 d6) 2... d5 { [%clk 0:02:50] }
3. exd5 { [%clk 1:02:50] } 1-0

[Event "Casual game"]
[Site "g2"]
[White "cat"]
[Black "dan"]
[Result "*"]
[TimeControl "-"]

*

[Event "Rated Rapid game"]
[Site "g3"]
[White "eve"]
[Black "fay"]
[Result "0-1"]
[WhiteElo "2000"]
[BlackElo "1900"]
[TimeControl "600+0"]

1. d4 d5 2. c4 0-1
"""


def test_records_from_a_file(spark, tmp_path):
    path = tmp_path / "games.txt"
    path.write_text(TEXT)
    rows = {r["site"]: r for r in parse_records(read_records(spark, str(path)), ("Site",)).collect()}
    assert set(rows) == {"g1", "g2", "g3"}
    one = rows["g1"]
    assert [m["move_san"] for m in one["moves"]] == ["e4", "c5", "c3?!", "d5", "exd5"]
    assert one["clock_times_white"] == [180.0, 177.0, 3770.0]
    assert one["clock_times_black"] == [178.5, 170.0]
    assert (one["white_elo"], one["black_elo"], one["base_time"], one["num_moves"]) == (1450, None, 180, 5)
    assert one["time_control_category"] == "blitz" and one["opening_name"] == "Sicilian Defense: Alapin"
    two = rows["g2"]
    assert two["moves"] == [] and two["base_time"] is None and two["time_control_category"] is None
    assert two["opening_eco"] == "" and two["clock_times_white"] == []
    three = rows["g3"]
    assert [m["move_san"] for m in three["moves"]] == ["d4", "d5", "c4"]
    assert three["time_control_category"] == "rapid" and three["white_skill_tier"] == "Advanced"


def test_ingest_by_time_control(spark, tmp_path):
    path = tmp_path / "games.txt"
    path.write_text(TEXT)
    out = str(tmp_path / "out")
    ingest(spark, str(path), out)
    stored = spark.read.parquet(out)
    assert stored.where("time_control_category = 'blitz'").select("white_player").first()[0] == "ann"
    assert stored.count() == 3


def one(spark, tmp_path, data: bytes):
    path = tmp_path / "some.txt"
    path.write_bytes(data)
    return sorted(parse_records(read_records(spark, str(path)), ("Site", "Event")).collect(), key=lambda r: r["site"])


def same(rows, others):
    assert [r.asDict(True) for r in rows] == [r.asDict(True) for r in others]


def test_either_line_ending_and_a_byte_order_mark(spark, tmp_path):
    want = one(spark, tmp_path, TEXT.encode())
    assert [r["event"] for r in want] == ["Rated Blitz game", "Casual game", "Rated Rapid game"]
    same(one(spark, tmp_path, TEXT.replace("\n", "\r\n").encode()), want)
    same(one(spark, tmp_path, b"\xef\xbb\xbf" + TEXT.encode()), want)
    same(one(spark, tmp_path, TEXT.replace("\n\n[Event", "\n[Event").encode()), want)
    same(one(spark, tmp_path, ("\n\n" + TEXT.replace("\n\n[Event", "\n\n\n\n[Event") + "\n\n").encode()), want)
    assert one(spark, tmp_path, b"") == []


def moves_and_clocks(spark, tmp_path, text):
    (row,) = one(spark, tmp_path, ('[Event "e"]\n[Site "s"]\n\n' + text + "\n").encode())
    return [m["move_san"] for m in row["moves"]], row["clock_times_white"], row["clock_times_black"]


def test_clocks_stay_with_their_moves(spark, tmp_path):
    clk = lambda s: f"{{ [%clk 0:00:{s:02}] }}"
    nested = f"1. e4 {clk(50)} (1. d4 {clk(11)} d5 {clk(12)} (1... Nf6 {clk(13)} 2. c4) 2. c4) e5 {clk(40)} 2. Nf3 {clk(39)} *"
    assert moves_and_clocks(spark, tmp_path, nested) == (["e4", "e5", "Nf3"], [50.0, 39.0], [40.0])
    holes = f"1. e4 {clk(50)} e5 2. Nf3 Nc6 {clk(30)} 3. Bb5 {clk(29)} 1-0"
    assert moves_and_clocks(spark, tmp_path, holes) == (["e4", "e5", "Nf3", "Nc6", "Bb5"], [50.0, None, 29.0], [None, 30.0])
    assert moves_and_clocks(spark, tmp_path, "1. e4 e5 0-1") == (["e4", "e5"], [], [])
    odd = "{ opening (; [%clk 0:00:59] } 1.e4! ; a (comment { here\n%escaped (line\n" + clk(45) + " e5 $14 { a ) b } " + clk(44) + " 1/2-1/2"
    assert moves_and_clocks(spark, tmp_path, odd) == (["e4!", "e5"], [45.0], [44.0])
    unbalanced = f"1. e4 {clk(50)} ) e5 {clk(49)} (2. d4 {clk(48)}"
    assert moves_and_clocks(spark, tmp_path, unbalanced) == (["e4", "e5"], [50.0], [49.0])


def test_split_borders_lose_and_double_nothing(spark, tmp_path):
    parts = []
    for i in range(400):
        end = "\r\n" if i % 3 == 0 else "\n"
        lines = [f'[Event "e{i}"]', f'[Site "{i:04}"]', "", f"1. e4 {{ [%clk 0:01:{i % 60:02}] }} e5" + " { filler }" * (i % 17) + " *", "", ""]
        parts.append(end.join(lines))
    path = tmp_path / "big.txt"
    path.write_bytes("".join(parts).encode())
    size = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for step in (97, 173, 1009):
            spark.conf.set("spark.sql.files.maxPartitionBytes", step)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            rows = parse_records(read_records(spark, str(path)), ("Site",)).select("site", "clock_times_white", "num_moves").collect()
            assert sorted(r["site"] for r in rows) == [f"{i:04}" for i in range(400)]
            assert all(r["clock_times_white"] == [60.0 + int(r["site"]) % 60] and r["num_moves"] == 2 for r in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size[0])
        spark.conf.set("spark.sql.files.openCostInBytes", size[1])
