"""Column functions on the edge values of each trap."""

import random

import pytest
from pyspark.sql import functions as F

from loticote.functions import fixed_values as fixed
from loticote.functions import labels, numbers, text


def test_price_text(values):
    inputs = ["1 500 000 FCFA", "1.500.000", "", "Non", None, "-5", "12000000"]
    expected = [1500000.0, None, None, None, None, 5.0, 12000000.0]
    assert values("string", inputs, numbers.clean_price) == expected


def test_numeric_price_keeps_its_size(values):
    got = values("double", [1.2e7, -5.0, None, float("nan")], lambda c: numbers.clean_price(c, True))
    assert got == [12000000.0, 5.0, None, None]


def test_numbers_reject_everything_else(values):
    inputs = [" 12.5\t", "10d", "NaN", "inf", "", "1e3", "-3", "grand", None]
    expected = [12.5, None, None, None, None, 1000.0, -3.0, None, None]
    assert values("string", inputs, numbers.to_number) == expected


def test_rooms_in_type(values):
    inputs = ["2 chambres", "3chambre", "4 Chambres a coucher", "Chambre", "Villa", None, "0 chambre"]
    assert values("string", inputs, numbers.rooms_from_type) == [2, 3, 4, None, None, None, 0]


def test_rooms_value(values):
    inputs = ["3.0", "3.7", "Non spécifié", "-2", "1.2.3", None, "5", ".5", ".", "3."]
    expected = [3, 3, None, None, None, None, 5, 0, None, 3]
    assert values("string", inputs, numbers.parse_rooms) == expected


def test_malformed_rooms(values):
    inputs = ["1.2.3", "3.0", "...", "-2", None, "1..2"]
    expected = [True, False, False, False, False, True]
    assert values("string", inputs, numbers.malformed_rooms) == expected


def test_fill_rooms(spark):
    rows = [(None, "3 chambres", 3), ("2.0", "3 chambres", 2), ("Non spécifié", "4chambre", 4),
            (None, "0 chambre", None), (None, "villa", None), (None, None, None)]
    df = spark.createDataFrame(rows, "p string, t string, e int")
    got = df.select(numbers.fill_rooms(F.col("p"), F.col("t")).alias("g"), "e").collect()
    assert [r.g for r in got] == [r.e for r in got]


def test_types(values):
    inputs = [" Villas ", "studio meublé", "bureau/commerce", "loft", None, "l'ecole/bar", "\tTERRAIN\n"]
    expected = ["Villa", "Studio", "Commerce", "Loft", None, "L'ecole/bar", "Terrain"]
    assert values("string", inputs, text.standardize_type) == expected
    assert values("string", [None], lambda c: text.standardize_type(c, "Non specifie")) == ["Non specifie"]


def test_types_at_load_use_title_case(values):
    inputs = ["l'ecole/bar", "chambres", "Villa meublée", "grand loft", "3chambre x"]
    expected = ["L'Ecole/Bar", "Chambre", "Villa", "Grand Loft", "3Chambre X"]
    assert values("string", inputs, text.standardize_type_at_load) == expected
    assert expected[0] == inputs[0].title() and expected[4] == inputs[4].title()


def test_every_dictionary_entry(values):
    keys = list(fixed.PROPERTY_TYPES)
    assert values("string", keys, text.standardize_type) == list(fixed.PROPERTY_TYPES.values())
    keys = list(fixed.PROPERTY_TYPES_AT_LOAD)
    expected = list(fixed.PROPERTY_TYPES_AT_LOAD.values())
    assert values("string", keys, text.standardize_type_at_load) == expected


def test_source_names(values):
    inputs = [" immoask", "FACEBOOK", "coinafrique", "autre site", None]
    expected = ["ImmoAsk", "Facebook", "CoinAfrique", "Autre Site", None]
    assert values("string", inputs, text.standardize_source) == expected


def test_whitespace_of_every_kind_is_trimmed(values):
    inputs = ["\t Bè \n", "\xa0be ", "  ", None]
    assert values("string", inputs, text.normalize_text) == ["bè", "be", "", None]


def test_folded_texts_are_one_group(spark):
    spellings = ["Bè", "be ", "BE", "b\u00e9", "be\u0301", "bê"]
    df = spark.createDataFrame([(s,) for s in [*spellings, "bo"]], "x string")
    groups = df.groupBy(text.fold_text(F.col("x")).alias("k")).count()
    assert sorted(r["count"] for r in groups.collect()) == [1, len(spellings)]


def test_rooms_with_blanks_and_signs(values):
    assert values("string", [" 3 ", "\t4.0", "-2", "1.2.3", None], numbers.parse_rooms) == [3, 4, None, None, None]

    def filled(c):
        return numbers.fill_rooms(c, F.lit("2 chambres"))

    assert values("string", [" 3 ", "-2", "3.7", "1.2.3", "Non", None], filled) == [3, -2, 3, 2, 2, 2]


def test_words_are_literal(values):
    got = values("string", ["a.b", "axb", "c+"], lambda c: text.contains_any(c, ["a.b", "c+"]))
    assert got == [True, False, True]


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_round_exact_is_pythons_round(values, digits):
    rng = random.Random(7)
    inputs = [rng.randint(1, 10**7) / rng.randint(1, 999) for _ in range(3000)]
    inputs += [rng.randint(1, 10**8) / 1000 for _ in range(3000)]
    inputs += [rng.randint(-(10**6), 10**6) / 8 for _ in range(3000)]
    inputs += [2.675, 1.005, 0.125, 0.375, -2.675, 0.0, None]
    got = values("double", inputs, lambda c: numbers.round_exact(c, digits))
    assert got == [None if x is None else round(x, digits) for x in inputs]


def test_price_per_m2(spark):
    rows = [(1000.0, 3.0, 333.33), (0.0, 5.0, None), (5.0, 0.0, None), (5.0, -1.0, None),
            (None, 5.0, None), (5.0, None, None), (2675.0, 1000.0, 2.67)]
    df = spark.createDataFrame(rows, "p double, s double, e double")
    got = df.select(numbers.price_per_m2(F.col("p"), F.col("s")).alias("g"), "e").collect()
    assert [r.g for r in got] == [r.e for r in got]


def test_trend(values):
    inputs = [105.0, 105.0001, 95.0, 94.9999, None]
    assert values("double", inputs, labels.trend) == ["STABLE", "HAUSSE", "STABLE", "BAISSE", "STABLE"]
    assert values("double", [106.0, 94.0, 100.0], labels.market_position) == list(fixed.POSITION_LABELS)


def test_colour(values):
    got = values("double", [0.0, 1.0, 0.5], labels.green_to_red)
    assert got == ["#00ff33", "#ff0033", "#7f7f33"]


def test_division_by_zero_is_null(values):
    assert values("double", [0.0], lambda c: numbers.gap_percent(F.lit(5.0), c)) == [None]
    assert values("double", [0.0], lambda c: numbers.index_value(F.lit(5.0), c)) == [None]


def test_strip_takes_every_white_space_and_nothing_else(values):
    bare = ["", "a", "é", "~", "!", "é a", "a　é", "\x7f", "​"]
    inputs = [f"{left}{x}{right}" for x in bare for left in ["", " ", "　\t"] for right in ["", "\x85", "\x1c "]]
    expected = [x for x in bare for _ in range(9)]
    assert values("string", [*inputs, None], text.strip) == [*expected, None]
