"""Game files as players' programs write them: wrapped, commented, nested, LF and CRLF."""

import pytest

from tabiya.sources import io

GAMES = r'''[Event "Rated \"blitz\" game"]
[Site "https://example.org/aaa"]
[White "Ann \\ \"A\""]
[Black "Bob"]
[Result "1-0"]
[Opening "Sicilian Defense: Najdorf"]

1. e4 c5 2. Nf3 { best (by test) 2. c3
is slower } d6 3. d4 cxd4
4.Nxd4 Nf6 $1 5. Nc3 a6! (5... e6 6. Be3 (6. g4!? h6 {Keres}) 6... Be7) 6. Be3
e5?! ; 6... Ng4 7. Bg5
7. Nb3 7... Be6 1-0

[Event "No moves"]
[Site "https://example.org/bbb"]
[Result "*"]

*

[Event "No site"]
[White "x"]

1. d4 d5 *

[Event "Castling, promotion, unclosed"]
[Site "ccc"]
[Opening ""]
[Result "1/2-1/2"]

% an escaped line 1. a4
1. e4 e5 2. O-O 0-0-0 3. exd8=Q+ Kxd8# 12 e.p. 4. -- Qh4 {[%clk 0:01:00] ( ) } 5. g3 (5. Nf3 )) h6 1/2-1/2 {never closed 6. h4'''
WANT = {
    "aaa": "e4 c5 Nf3 d6 d4 cxd4 Nxd4 Nf6 Nc3 a6 Be3 e5 Nb3 Be6",
    "bbb": "",
    "ccc": "e4 e5 O-O 0-0-0 exd8=Q+ Kxd8# -- Qh4 g3 h6",
}


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_whole_main_lines(spark, tmp_path, end):
    (tmp_path / "games.pgn").write_bytes(GAMES.replace("\n", end).encode())
    rows = {r.game_id: r for r in io.read_pgn(spark, str(tmp_path)).collect()}
    assert {k: " ".join(r.moves) for k, r in rows.items()} == WANT
    assert rows["aaa"].white == 'Ann \\ "A"' and rows["aaa"].opening == "Sicilian Defense: Najdorf" and rows["aaa"].result == "1-0"
    assert rows["ccc"].opening is None and rows["ccc"].result == "1/2-1/2"


def test_a_file_is_read_by_many_tasks(spark, tmp_path):
    n = 4000
    body = "\n\n".join(f'[Event "g"]\n[Site "s/{i}"]\n\n' + "\n".join(f"{k}. e4 {{c {k}}} e5" for k in range(1, 2 + i % 40)) + " *" for i in range(n))
    (tmp_path / "big.pgn").write_text(body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 17))
    try:
        d = io.read_pgn(spark, str(tmp_path))
        assert d.rdd.getNumPartitions() > 4
        assert sorted((int(r.game_id), len(r.moves)) for r in d.collect()) == [(i, 2 * (1 + i % 40)) for i in range(n)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_an_empty_folder_has_no_games(spark, tmp_path):
    (tmp_path / "none.pgn").write_text("")
    assert io.read_pgn(spark, str(tmp_path)).count() == 0
