import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

from starloom.functions.numbers import rounded_ratio


def exact(top, bottom, times=1):
    with localcontext() as context:
        context.prec = 200
        return (times * top / bottom).quantize(Decimal("0.01"), ROUND_HALF_UP)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t decimal(35,2), b bigint")
    out = df.select("i", rounded_ratio("t", "b", **options).alias("r")).orderBy("i").collect()
    return [r["r"] for r in out]


def test_ties_go_away_from_zero(spark):
    rows = [(Decimal("2.01"), 2), (Decimal("-2.01"), 2), (Decimal("2.01"), -2), (Decimal("0.01"), 2)]
    assert run(spark, rows) == [Decimal("1.01"), Decimal("-1.01"), Decimal("-1.01"), Decimal("0.01")]


def test_zero_and_missing(spark):
    rows = [(Decimal("1.00"), 0), (None, 3), (Decimal("1.00"), None), (Decimal("0.00"), 3)]
    assert run(spark, rows) == [None, None, None, Decimal("0.00")]


def test_random_against_exact_arithmetic(spark):
    source = random.Random(3)
    rows = [
        (Decimal(source.randrange(-(10**15), 10**15)) / 100, source.choice([1, 2, 3, 7, 8, 200, 10**6 + 3, 10**12]))
        for _ in range(400)
    ]
    assert run(spark, rows) == [exact(t, b) for t, b in rows]
    assert run(spark, rows, times=100) == [exact(t, b, 100) for t, b in rows]


def test_near_tie_is_not_rounded_twice(spark):
    # Just below the tie of 0.125 by less than any 15-digit quotient could tell.
    top = Decimal("124999999999999999999.99")
    rows = [(top, 10**18)]
    assert run(spark, rows) == [Decimal("125.00")]
    rows = [(Decimal("12499999999999999.99"), 10**17)]
    assert run(spark, rows) == [Decimal("0.12")]


def test_published_figures(spark):
    """Published results of the retail case that are ratios of published figures."""
    df = spark.range(1)
    cases = {
        "633746.09": ("cast(633746.09 as decimal(35,2))", "148000", 1, 2, 0, "4.28"),
        "46749.72": ("cast(46749.72 as decimal(35,2))", "74000", 1, 2, 0, "0.63"),
        "racao": ("cast(1076202.55 as decimal(35,2))", "cast(1793308.51 as decimal(35,2))", 100, 2, 2, "60.01"),
        "sem loja": ("3", "4044", 100, 0, 0, "0.07"),
        "sem entrega": ("1953", "4044", 100, 0, 0, "48.29"),
        "sem valor": ("121", "4044", 100, 0, 0, "2.99"),
    }
    columns = [
        rounded_ratio(top, bottom, times=times, scale=scale, bottom_scale=below).alias(name.replace(".", ""))
        for name, (top, bottom, times, scale, below, _) in cases.items()
    ]
    assert [str(v) for v in df.select(*columns).first()] == [case[-1] for case in cases.values()]
