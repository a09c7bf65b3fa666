import pytest
from pyspark.sql import functions as F

from tidewatch.functions.keys import in_countries, is_valid_e164, normalize_key

CASES = [  # one number per rule
    ("0377000111", "+84377000111"), ("0912222333", "+84912222333"),  # national
    ("84355444000", "+84355444000"), ("0084355444000", "+84355444000"), ("+84355444000", "+84355444000"),  # with the country code
    ("+4915112345", "+4915112345"), ("355444000", "+84355444000"),  # another country, no prefix at all
    ("\t0355 444-000", "+84355444000"), ("(0355).444.000", "+84355444000"), ("+84 355 44 40 00", "+84355444000"),  # separators
    (None, None), ("", None), (" \t", None), ("77", None), ("call me", None), ("+0355444000", None), ("00000355444", None),
]


def test_normalize(spark):
    rows = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(CASES)], "i int, raw string")
    got = {r.i: r.k for r in rows.select("i", normalize_key(F.col("raw")).alias("k")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


@pytest.mark.parametrize("code", ["856", "+856", " 856 "])
def test_other_country(spark, code):
    row = spark.sql("select '02012345678' p, '85620123456' q, 'x' r").withColumn("cc", F.lit(code))
    fixed, column = (row.select(*[normalize_key(F.col(c), cc) for c in "pqr"]).first() for cc in (code, F.col("cc")))
    assert tuple(fixed) == tuple(column) == ("+8562012345678", "+85620123456", None)


def test_blank_country_falls_back(spark):
    assert spark.range(1).select(normalize_key(F.lit("0981234567"), F.lit(" "))).first()[0] == "+84981234567"


def test_e164(spark):
    rows = [("+84981234567", True), ("+14155552671", True), ("0981234567", False), ("+0981234567", False), (None, False)]
    df = spark.createDataFrame(rows, "p string, want boolean")
    assert df.where(is_valid_e164(F.col("p")) != F.col("want")).count() == 0


def test_countries(spark):
    df = spark.sql("select '+84981234567' k")
    assert df.select(in_countries(F.col("k"), ["84"]), in_countries(F.col("k"), ["1"]), in_countries(F.col("k"), None)).first()[:] == (True, False, True)
