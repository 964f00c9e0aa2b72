import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions import dates, numbers, text

D = Decimal


def test_money_forms(values):
    cases = {
        "R$ 1.850,00": "1850.00",
        "1850.00": "1850.00",
        "1.200": "1200.00",
        "654,81": "654.81",
        "769": "769.00",
        "1.234.567": "1234567.00",
        "1.85": "1.85",
        "12.345": "12345.00",
        "2.005": "2005.00",
        "1,850.00": "1.85",
        "-1.200": "-1.20",
        " 769 ": "769.00",
        "0,005": "0.01",
        "-": None,
        "": None,
        "R$ -": None,
        "  ": None,
        None: None,
    }
    wanted = [None if v is None else D(v) for v in cases.values()]
    assert values(numbers.parse_money_br, list(cases)) == wanted


def test_money_final_line_feed_is_no_thousands_group(values):
    # Grouping by threes must reach the very end of the text.
    assert values(lambda c: c.rlike(numbers.DOT_THOUSANDS), ["1.200", "1.200\n", "1.20", "12345.678"]) == [
        True,
        False,
        False,
        False,
    ]


def test_money_strict_raises_and_lenient_gives_null(values):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(numbers.parse_money_br, ["abc"])
    assert values(lambda c: numbers.parse_money_br(c, strict=False), ["abc", "7"]) == [None, D("7.00")]


def test_money_round_trip(values):
    source = random.Random(7)
    amounts = [D(source.randrange(1, 10**9)) / 100 for _ in range(300)]

    def brazilian(a):
        return f"{a:,.2f}".translate(str.maketrans(",.", ".,"))

    def grouped(a):
        return f"{int(a):,}".replace(",", ".")

    texts, wanted = [], []
    for a in amounts:
        texts += [brazilian(a), "R$ " + brazilian(a), f"{a:.2f}", f"{a:.2f}".replace(".", ","), grouped(a)]
        wanted += [a, a, a, a, D(int(a))]
    assert values(numbers.parse_money_br, texts) == wanted


def test_whole_numbers(values):
    assert values(numbers.parse_int, [" 5", "-", "", " - ", None, "-3"]) == [5, None, None, None, None, -3]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(numbers.parse_int, ["5.0"])
    assert values(numbers.parse_thousands_int, ["148.000", "74.000", "999"]) == [148000, 74000, 999]


def test_factor(values):
    assert values(numbers.parse_factor, ["0,85", "1,00", "0,33335"]) == [D("0.8500"), D("1.0000"), D("0.3334")]


# Sales areas of the 32 stores of the retail case, by their band.
AREAS = {
    "Grande": [620, 480, 760, 430, 690, 520, 450, 470],
    "Media": [310, 340, 165, 230, 245, 260, 400, 300, 210, 175, 390, 160, 220, 180, 170],
    "Pequena": [120, 110, 135, 115, 95, 105, 130, 125, 100],
}


def test_size_band(values):
    areas = [area for group in AREAS.values() for area in group]
    bands = [band for band, group in AREAS.items() for _ in group]
    assert len(areas) == 32
    assert values(numbers.size_band, areas, "int") == bands
    assert values(numbers.size_band, [149, 150, 400, 401, None], "int") == [
        "Pequena",
        "Media",
        "Media",
        "Grande",
        None,
    ]


def test_blank(values):
    assert values(text.is_blank, [None, "", "   ", " x "]) == [True, True, True, False]
    assert values(text.blank_to_null, [None, "", "   ", " x ", "\t"]) == [None, None, None, "x", "\t"]


def test_fold(values):
    assert values(text.fold, ["Ração", "ÁÉÎÕÜÇ", "ñ"]) == ["Racao", "AEIOUC", "ñ"]
    # Fewer letters are folded in categories than in names.
    assert values(text.category_key, ["Acessório", "Räção"]) == ["ACESSORIO", "RÄCAO"]


def test_category_first_keyword_wins(values):
    cases = {
        "Ração Medicamentosa": "Medicamento",
        "Petisco Ração": "Petisco",
        "RAÇÃO": "Racao",
        "hig.": "Higiene",
        "brinq": "Brinquedo",
        "ACESSÓRIO": "Acessorio",
        "serviço": "Servico",
        "xyz": "?",
        "": "?",
        None: "?",
    }
    found = values(lambda c: text.standard_category(text.category_key(c), "?"), list(cases))
    assert found == list(cases.values())


def test_category_group(values):
    found = values(
        lambda c: text.category_group(text.category_key(c), "?"),
        ["med", "petisco", "racao", "higiene", "brinquedo", "acessorio", "servico", "?"],
    )
    assert found == [
        "Saude e Higiene",
        "Alimentacao",
        "Alimentacao",
        "Saude e Higiene",
        "Bem-estar",
        "Bem-estar",
        "Bem-estar",
        "?",
    ]


def test_labels_are_their_own_category(values):
    labels = [name for _, name, _ in text.CATEGORY_RULES]
    assert values(lambda c: text.standard_category(text.category_key(c), "?"), labels) == labels


def test_channel(values):
    found = values(
        lambda c: text.classify(text.upper_trimmed(c), text.CHANNEL_RULES, "?"),
        ["WhatsApp", " app ", "web site", "Loja Física", "tel.", "", None],
    )
    assert found == ["WhatsApp", "App", "Site", "Loja Fisica", "Telefone", "?", "?"]


def test_discount_is_not_folded_unless_asked(values):
    spellings = ["s", " SIM ", "1", "x", "True", "v", "N", "nao", "0", "false", "F", "Não", "", None]
    labels = ["Sim"] * 6 + ["Nao"] * 5 + ["?"] * 3

    def plain(c):
        return text.map_values(text.upper_trimmed(c), text.DISCOUNT_VALUES, "?")

    def folded(c):
        return text.map_values(text.upper_trimmed(c, text.NAME_ACCENTS), text.DISCOUNT_VALUES, "?")

    assert values(plain, spellings) == labels
    assert values(folded, ["Não"]) == ["Nao"]


def test_store_name_key(values):
    cases = {
        "Loja São José/SC": "LOJA SAO JOSE",
        "  Loja  Centro ": "LOJA CENTRO",
        "loja x/sc": "LOJA X/SC",  # the suffix is dropped only as it is spelled
        "Loja   X": "LOJA  X",  # one pass over double blanks
        "": "",
        None: None,
    }
    assert values(text.name_key, list(cases)) == list(cases.values())


def test_timestamps(values):
    found = values(
        dates.parse_us_timestamp,
        ["09/01/2023 10:07 AM", "9/1/2023 9:05 pm", "09/01/2023 12:00 AM", "09/01/2023 12:30 PM", "", " ", None],
    )
    day = dt.datetime(2023, 9, 1)
    assert found == [
        day.replace(hour=10, minute=7),
        day.replace(hour=21, minute=5),
        day,
        day.replace(hour=12, minute=30),
        None,
        None,
        None,
    ]


def test_day_first_text_raises_or_is_told(values):
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|parse"):
        values(dates.parse_us_timestamp, ["25/12/2023 10:00 AM"])
    assert values(dates.is_us_timestamp, ["25/12/2023 10:00 AM", "12/25/2023 10:00 AM", ""]) == [
        False,
        True,
        False,
    ]


def test_date_keys(values):
    found = values(
        lambda c: dates.date_key(dates.parse_date(c)), ["2023-11-16", " 2024-01-02 10:00:00", "", None]
    )
    assert found == [20231116, 20240102, -1, -1]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "America/Sao_Paulo"])
def test_time_zone_does_not_matter(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # Hours that the clock skips in these zones.
        df = spark.createDataFrame([("03/10/2024 02:31 AM",), ("10/16/2016 12:15 AM",)], "t string")
        stamp = dates.parse_us_timestamp(F.col("t"))
        rows = df.select(stamp.cast("string").alias("s"), dates.date_key(F.to_date(stamp)).alias("k")).collect()
        assert [tuple(r) for r in rows] == [
            ("2024-03-10 02:31:00", 20240310),
            ("2016-10-16 00:15:00", 20161016),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("text", ["2024", "2024-03", "2024-03-01 garbage", "2024-03-01Tzz"])
def test_parts_of_dates_are_no_dates(values, text):
    assert values(lambda c: dates.parse_date(c, strict=False), [text]) == [None]
    with pytest.raises(Exception, match="no date"):
        values(dates.parse_date, [text])


def test_dates_with_a_time_are_dates(values):
    found = values(dates.parse_date, ["2024-03-01 10:07:00", "2024-3-1", " 2024-03-01 ", ""])
    assert [str(d) for d in found] == ["2024-03-01", "2024-03-01", "2024-03-01", "None"]
