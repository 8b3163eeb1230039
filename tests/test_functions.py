import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakefold.functions.columns import decode_numeric, is_deleted_flag, line_total
from lakefold.functions.scoring import (
    REACHABLE_LADDER,
    RfmRules,
    score_at_least,
    score_at_most,
    segment_of,
)


def encode(value: Decimal) -> bytes:
    unscaled = int(value.scaleb(2))
    length = max(1, (unscaled.bit_length() + 8) // 8)
    return unscaled.to_bytes(length, "big", signed=True)


@pytest.mark.parametrize("expression", [True, False])
def test_decode_numeric_known_bytes(spark, expression):
    cases = {
        b"\x00": "0.00", b"": None, b"\x7f": "1.27", b"\x00\x80": "1.28",
        b"\x00\x80\x00": "327.68", bytes.fromhex("fdf3"): "-5.25", b"\xff": "-0.01",
        bytes.fromhex("02540be3ff"): "99999999.99",
    }
    spark.conf.set("spark.sql.codegen.wholeStage", str(expression).lower())
    try:
        df = spark.createDataFrame([(bytearray(k),) for k in cases], "raw binary")
        got = [r[0] for r in df.select(decode_numeric(F.col("raw"))).collect()]
    finally:
        spark.conf.unset("spark.sql.codegen.wholeStage")
    assert got == [v and Decimal(v) for v in cases.values()]


def test_decode_numeric_rejects_what_does_not_fit(spark):
    raws = [None, b"\x01" * 9, b"\x7f" * 8, bytes.fromhex("02540be400")]
    df = spark.createDataFrame([(r and bytearray(r),) for r in raws], "raw binary")
    assert [r[0] for r in df.select(decode_numeric(F.col("raw"))).collect()] == [None] * 4


def test_decode_inverts_encode(spark):
    rng = random.Random(7)
    values = [Decimal(rng.randint(-(10**10) + 1, 10**10 - 1)).scaleb(-2) for _ in range(500)]
    df = spark.createDataFrame([(bytearray(encode(v)), v) for v in values], "raw binary, v decimal(10,2)")
    wrong = df.filter(~decode_numeric(F.col("raw")).eqNullSafe(F.col("v")))
    assert wrong.count() == 0


def test_deleted_flag_is_never_null(spark):
    df = spark.createDataFrame([("true",), ("false",), ("TRUE",), (None,)], "__deleted string")
    assert [r[0] for r in df.select(is_deleted_flag()).collect()] == [True, False, False, False]


def test_line_total_is_exact_and_cannot_overflow(spark):
    rows = [(3, Decimal("9.99"), Decimal("0.15")), (2**31 - 1, Decimal("99999999.99"), Decimal("-999.99"))]
    df = spark.createDataFrame(rows, "quantity int, unit_price decimal(10,2), discount decimal(5,2)")
    got = [r[0] for r in df.select(line_total()).collect()]
    assert got == [q * p * (1 - d) for q, p, d in rows]


def segments(spark, ladder):
    scores = [(100 * r + 10 * f + m,) for r in (1, 2, 3) for f in (1, 2, 3) for m in (1, 2, 3)]
    df = spark.createDataFrame(scores, "score int")
    named = df.select("score", segment_of(F.col("score"), RfmRules(ladder=ladder)).alias("s"))
    return dict(named.collect())


def test_default_ladder_over_all_scores(spark):
    got = segments(spark, RfmRules().ladder)
    assert got[321] == got[333] == "Champions"
    assert got[311] == got[313] == "Loyal Customers"
    assert got[131] == got[211] == got[233] == "Potential Loyalists"
    assert got[121] == got[123] == "New Customers"
    assert got[111] == got[113] == "Lost Customers"
    assert not {"At Risk Customers", "Can't Lose Them"} & set(got.values())


def test_reachable_ladder_uses_every_segment(spark):
    got = segments(spark, REACHABLE_LADDER)
    assert got[221] == "At Risk Customers" and got[213] == "Can't Lose Them"
    assert len(set(got.values())) == 7


def test_score_thresholds(spark):
    df = spark.createDataFrame([(30,), (31,), (90,), (91,)], "v int")
    assert [r[0] for r in df.select(score_at_most(F.col("v"), (30, 90))).collect()] == [3, 2, 2, 1]
    df = spark.createDataFrame([(500,), (499,), (100,), (99,)], "v int")
    assert [r[0] for r in df.select(score_at_least(F.col("v"), (500, 100))).collect()] == [3, 2, 2, 1]
