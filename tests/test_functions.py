from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from matchlake.functions import display, scoring
from matchlake.functions.innings import innings_to_number
from matchlake.functions.odds import EVENT_TYPE, implied_probability, with_consensus
from matchlake.operators.bins import equal_width_bin
from matchlake.operators.reshape import split_prefix


def _one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize("outs", [0, 1, 2, 3, 13, 28, 51])
def test_innings_count_outs_in_thirds(spark, outs):
    text = f"{outs // 3}.{outs % 3}"
    assert _one(spark, text, "string", innings_to_number) == pytest.approx(outs / 3)


@pytest.mark.parametrize("text", ["", None])
def test_no_innings_are_unknown(spark, text):
    assert _one(spark, text, "string", innings_to_number) is None


def test_whole_innings_need_no_point(spark):
    assert _one(spark, "11", "string", innings_to_number) == 11.0


@pytest.mark.parametrize("price", [105.0, 240.0, 900.0])
def test_implied_probabilities_of_opposite_prices_are_complements(spark, price):
    longshot, favourite = (_one(spark, p, "double", implied_probability) for p in (price, -price))
    assert longshot < 0.5 < favourite and longshot + favourite == pytest.approx(1.0)
    assert price * longshot == pytest.approx(100.0 * favourite)  # the bet is fair at these odds


@pytest.mark.parametrize("p", [0.0, 0.25, 1.0])
@pytest.mark.parametrize("actual", [0, 1])
def test_log_loss_clips(spark, p, actual):
    clipped = min(max(p, 1e-15), 1 - 1e-15)
    expected = -(actual * math.log(clipped) + (1 - actual) * math.log(1 - clipped))
    assert _one(spark, p, "double", lambda x: scoring.log_loss(x, F.lit(actual))) == pytest.approx(expected)


def test_null_probability_stays_null(spark):
    assert _one(spark, None, "double", scoring.clip_probability) is None


def test_even_chance_goes_to_home(spark):
    assert _one(spark, 0.5, "double", lambda p: display.favoured_team(p, F.lit("H"), F.lit("A"))) == "H"


def test_display_texts(spark):
    assert _one(spark, 0.123, "double", display.percent) == "12.3%"
    assert _one(spark, None, "string", display.pitcher_name) == "(TBD)"
    assert _one(spark, "", "string", display.pitcher_name) == "(TBD)"
    assert _one(spark, True, "boolean", display.hit_mark) == "✓"
    line = lambda x: display.contribution_line(F.lit("f"), x)
    assert _one(spark, 0.1234, "double", line) == "↑ `f` +0.123"
    assert _one(spark, -0.1234, "double", line) == "↓ `f` +0.123"
    assert _one(spark, 0.0, "double", display.direction) == "▼ away"


def _bins(spark, values, n=10):
    df = spark.createDataFrame([(v,) for v in values], "p double")
    return [r["bin"] for r in equal_width_bin(df, "p", n).orderBy("p").collect()]


def test_bins_are_right_closed(spark):
    assert _bins(spark, [0.0, 0.1, 0.15, 0.5, 1.0]) == [0, 0, 1, 4, 9]


@pytest.mark.parametrize("value", [0.0, 0.37, 0.5])
def test_equal_values_share_the_middle_bin(spark, value):
    assert _bins(spark, [value, value]) == [4, 4]


@pytest.mark.parametrize(
    "name,expected",
    [
        ("train_accuracy", ("train", "accuracy")),
        ("val_log_loss", ("val", "log_loss")),
        ("promoted", ("other", "promoted")),
        ("trainer_x", ("other", "trainer_x")),
    ],
)
def test_split_prefix(spark, name, expected):
    got = _one(spark, name, "string", lambda n: F.struct(*split_prefix(n, ("train", "val", "test"))))
    assert tuple(got) == expected


def _consensus(spark, payload):
    df = spark.createDataFrame([(payload,)], "payload string").withColumn(
        "e", F.from_json("payload", EVENT_TYPE)
    )
    return with_consensus(df, F.col("e.bookmakers"), F.col("e.home_team"), F.col("e.away_team")).first()


def _book(*markets):
    return '{"markets": [' + ",".join(markets) + "]}"


def _event(*books, home="H", away="A"):
    return f'{{"home_team": "{home}", "away_team": "{away}", "bookmakers": [{",".join(books)}]}}'


H2H = '{"key":"h2h","outcomes":[{"name":"H","price":%s},{"name":"A","price":%s}]}'
TOTALS = '{"key":"totals","outcomes":[{"name":"Over"},{"name":"Under","point":%s}]}'


@pytest.mark.parametrize("margin", [0, 15, 60])
def test_consensus_removes_the_margin_of_a_book(spark, margin):
    row = _consensus(spark, _event(_book(H2H % (-200 - margin, 200 - margin))))
    assert row["market_home_win_prob"] + row["market_away_win_prob"] == pytest.approx(1.0)
    assert row["market_home_win_prob"] > row["market_away_win_prob"]
    assert (row["n_books_moneyline"], row["n_books_totals"]) == (1, 0)


def test_consensus_does_not_depend_on_the_order_of_books(spark):
    books = [_book(H2H % (-310, 255), TOTALS % 7.5), _book(H2H % (180, -215)), _book(TOTALS % 11.0), "{}"]
    rows = [_consensus(spark, _event(*order)) for order in (books, books[::-1])]
    for row in rows:
        assert row["market_home_win_prob"] == pytest.approx(rows[0]["market_home_win_prob"])
        assert (row["market_total_line"], row["n_books_moneyline"], row["n_books_totals"]) == ((7.5 + 11.0) / 2, 2, 2)


def test_consensus_lies_between_the_books(spark):
    first, second = (_consensus(spark, _event(_book(H2H % p)))["market_home_win_prob"] for p in ((-310, 255), (180, -215)))
    both = _consensus(spark, _event(_book(H2H % (-310, 255)), _book(H2H % (180, -215))))
    assert both["market_home_win_prob"] == pytest.approx((first + second) / 2)


def test_a_side_without_price_keeps_a_book_out(spark):
    one_sided = '{"key":"h2h","outcomes":[{"name":"A","price":-445}]}'
    alone, joined = (_consensus(spark, _event(_book(H2H % (140, -165)), *more)) for more in ([], [_book(one_sided)]))
    assert joined["market_home_win_prob"] == alone["market_home_win_prob"]
    assert joined["n_books_moneyline"] == 1


def test_consensus_takes_the_last_price_of_a_side(spark):
    twice = (
        '{"key":"h2h","outcomes":[{"name":"H","price":500},{"name":"A","price":100},'
        '{"name":"H","price":100},{"name":"X","price":1}]}'
    )
    assert _consensus(spark, _event(_book(twice)))["market_home_win_prob"] == pytest.approx(0.5)


@pytest.mark.parametrize("payload", [_event(), '{"home_team":"H","away_team":"A"}'])
def test_consensus_without_books(spark, payload):
    row = _consensus(spark, payload)
    assert row["market_home_win_prob"] is None and row["market_total_line"] is None
    assert (row["n_books_moneyline"], row["n_books_totals"]) == (0, 0)
