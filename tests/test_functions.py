"""Column functions on texts as found, and on texts nobody should write."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pitchlake.functions import dates, keys, match, money
from pitchlake.functions import text as tx


def test_tokens(column):
    hrefs = ["/a/b/c/5/x", "/a", "", None]
    assert column(lambda x: tx.token(x, 5), hrefs) == ["5", None, None, None]
    assert column(tx.href_id, hrefs) == [5, None, None, None]
    assert column(tx.last_token, ["/a/b/", "/a/b//", "b", None]) == ["b", "b", "b", None]


def test_numbers(column):
    assert column(tx.to_int, ["7", " 7 ", "1.5", "2.4", "x", "", None, "99999999999"]) == [
        7, 7, 2, 2, None, None, None, None]
    assert column(tx.empty_to_zero, ["", "3", None, "x"]) == [0, 3, None, None]
    assert column(tx.filled_int, ["", "3", None]) == [None, 3, None]
    assert column(tx.thousands, ["45.123", "7", "1.234.567", ""]) == [45123, 7, 1234567, None]
    shares = column(tx.percentage, ["55.6 %", "%", "", "null", None, "100%"])
    assert shares[0] == pytest.approx(55.6, abs=1e-4)
    assert shares[1:] == [None, None, None, None, 100.0]


def test_replace_first_only(column):
    assert column(lambda x: tx.drop_first(x, "[,.]"), ["1,8,5", "185", "a\n,b,c"]) == [
        "18,5", "185", "a\nb,c"]


def test_market_value(column):
    texts = ["€1.50m", "£900Th", "€900k", "€2.00M", "€0.35m", "€105.35m", "€1.20bn", "1.5m", "-",
             "", None, "€1.2.3m"]
    assert column(money.market_value, texts) == [
        1500000, 900000, 900000, 2000000, 350000, 105349998, None, None, None, None, None, None]
    factors = {**money.MARKET_VALUE_FACTORS, "bn": 1e9}
    assert column(lambda x: money.market_value(x, factors), ["€1.20bn"]) == [1200000048]


def test_transfer_fee(column):
    texts = ["€1.50m", "€350k", "€125", "free transfer", "loan transfer", "-", "?", "", None,
             "$5m", "€x"]
    expected = ["1500000.000", "350000.000", "125.000", "0.000", "0.000", None, None, None, None,
                "0.000", None]
    assert column(money.transfer_fee, texts) == [e and Decimal(e) for e in expected]


def test_game_date_follows_the_era(spark):
    rows = [("Sat, 05/08/23", 2023, False, date(2023, 5, 8)),
            ("Sat, 05/08/23", 2024, False, date(2023, 8, 5)),
            ("Sat, 05/08/23", 2022, True, date(2023, 8, 5)),
            ("Sat, 13/08/23", 2022, False, date(2023, 8, 13)),
            ("Sat, 08/13/23", 2024, False, date(2023, 8, 13)),
            ("sat, 5/8/23", 2024, None, date(2023, 8, 5)),
            ("Thu, 01/02/69", 2024, False, date(1969, 2, 1)),
            ("Thu, 01/02/68", 2024, False, date(2068, 2, 1)),
            ("Thu, 29/02/72", 2024, False, date(1972, 2, 29)),
            ("Sat, 13/25/23", 2024, False, None), ("null", 2024, False, None),
            ("Xyz, 05/08/23", 2024, False, None), (None, 2024, False, None),
            ("Sat, 05/08/2023", 2024, False, None)]
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)],
                               "i int, x string, season int, cup boolean")
    got = [r.d for r in df.select("i", dates.era_date(
        F.col("x"), F.col("season"), F.col("cup")).alias("d")).orderBy("i").collect()]
    assert got == [r[3] for r in rows]


def test_other_dates(column):
    assert column(dates.birth_date, [
        "Jan 01, 2000", "05/08/2002", "1999", "N/A", "null", "", None, "soon", "Feb 30, 2000"]) == [
        date(2000, 1, 1), date(2002, 8, 5), date(1999, 1, 1)] + [None] * 6
    assert column(dates.contract_date, [
        "30/06/2026", "Jun 30, 2026", "Jun 3, 2026", "Jun, 2026", "", "-", None, "31/02/2026"]) == [
        date(2026, 6, 30), date(2026, 6, 30), date(2026, 6, 3), date(2026, 6, 1)] + [None] * 4
    assert column(lambda x: dates.clamp(x.try_cast("date"), dates.run_date("2024-01-01")),
                  ["2023-01-01", "2099-01-01", None]) == [date(2023, 1, 1), date(2024, 1, 1), None]


def test_sheet_texts(column):
    assert column(lambda x: match.goals(x, 1), ["2:1", "-:-", " -:- ", "", None, "10:0"]) == [
        2, None, None, None, None, 10]
    assert column(lambda x: match.goals(x, 2), ["2:1", "2", "-:-"]) == [1, None, None]
    assert column(match.table_position, ["Position: 5", "Position:  12", "", "null", None, "x"]) == [
        5, 12, -1, -1, None, None]
    assert column(match.attendance, ["Attendance: 45.123", "Attendance: 7", "x", None]) == [
        45123, 7, None, None]
    assert column(match.height_cm, ["1,85 m", "1‚85 m", "1´85", "185", "null", "N/A", None]) == [
        185, 185, 185, 185, None, None, None]
    assert column(match.sub_position, ["Goalkeeper", "Attack - Left Winger", "Attack", None]) == [
        "Goalkeeper", "Left Winger", None, None]
    assert column(lambda x: match.bucket(x, match.POSITION_GROUPS, match.NO_POSITION),
                  ["Left-Back", "Second Striker", "Sweeper", None]) == [
        "Defender", "Attack", "Missing", "Missing"]


def test_surrogate_key_marks_nulls(spark):
    df = spark.sql("select * from values (1, 'a'), (null, 'a'), (1, null), (1, '') as t(n, s)")
    assert len({r[0] for r in df.select(keys.surrogate_key("n", "s")).collect()}) == 4
    import hashlib

    first = df.filter("n = 1 and s = 'a'").select(keys.surrogate_key("n", "s")).first()[0]
    assert first == hashlib.md5(b"1-a").hexdigest()
