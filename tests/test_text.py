import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.functions import text as tx
from orderloom.operators import extraction as ex


def values(spark, rows, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("reference", [1898148, 1898148, 0, 15, 0, 0, 0, 1234568, 2, 1898]),
        ("locale", [1898148, 1898148, 1898148, 2, 0, 0, 0, 1234568, 2, 1898]),
    ],
)
def test_money(spark, mode, expected):
    texts = ["1.898.148", "1,898,148", "1,898,148.00", "1,5", "", None, "abc", "1.234.567,6", "2", "1.898"]
    assert values(spark, texts, lambda c: tx.to_int(c, mode)) == expected


def test_words_a_cast_would_take_are_not_numbers(spark):
    assert values(spark, ["NaN", "Infinity", "1d", "5f"], tx.to_int) == [0, 0, 0, 0]


def test_money_rounds_half_to_even(spark):
    assert values(spark, ["1.000,5", "1.001,5"], tx.to_int) == [1000, 1002]


def test_quantity(spark):
    texts = ["1", "1,5", "2.0", " 3 ", "1.000,5", None, "x"]
    assert values(spark, texts, tx.parse_qty) == [Decimal(v) for v in ("1", "1.5", "2", "3", "0", "0", "0")]


def test_strict_values(spark):
    assert values(spark, ["1.898.148", "1,898,148", None, "x"], tx.strict_int) == [1898148, 1898148, 0, 0]
    assert values(spark, ["1,5", "1.000,5", "2.5", ""], tx.strict_qty) == [1.5, 1000.5, 2.5, 0.0]
    assert values(spark, ["1.000", "a1", "", None], tx.strict_numeric_cell) == [True, False, False, False]


def test_nfc(spark):
    assert values(spark, ["Đại lý", "plain", None], tx.nfc) == ["Đại lý", "plain", None]


def test_order_number(spark):
    df = spark.createDataFrame(
        [("Đặt hàng bh26.0935 - x", "m1"), ("no number", "BH26_1 bh26.0001"), (None, "x")], "s string, f string"
    )
    got = [r[0] for r in df.select(tx.order_number(F.col("s"), F.col("f"))).collect()]
    assert got == ["BH26.0935", "BH26.0001", None]


def test_dealer_name(spark):
    bodies = [
        "Kính gửi\nĐẠI LÝ: Tên : CÔNG TY LONG PHÚ.;\nchào", "Khách hàng : abc", "khách hàng: Minh Tân\r\nhi", "", None,
        "Tên:" + "x" * 300,
    ]
    assert values(spark, bodies, tx.dealer_name) == ["CÔNG TY LONG PHÚ", None, "Minh Tân", None, None, "x" * 200]


def test_impossible_date(spark):
    texts = ["Ngày: 3/4/2026", "NGÀY 30.2.2026", "ngay 31-12-2025", "none"]
    got = values(spark, texts, tx.doc_date)
    assert [str(d) if d else None for d in got] == ["2026-04-03", None, "2025-12-31", None]


def test_broken_glyphs(spark):
    doc = "MST: 0100000001\n■■i lý: CTY  LONG\nPHÚ  MST: 0312345678\n■■a ch■: 12 Lê Lợi\nHà Nội\n STT Mã hàng"
    assert values(spark, [doc], tx.doc_buyer) == ["CTY LONG PHÚ"]
    assert values(spark, [doc], tx.doc_address) == ["12 Lê Lợi Hà Nội"]
    assert values(spark, [doc], lambda c: tx.buyer_tax(c, "0100000001")) == ["0312345678"]
    assert values(spark, ["T■ng giá tr■ ■■n hàng: 1.234.567"], tx.footer_total) == [1234567]


def test_product_codes(spark):
    codes = ["000219002001000", "TP0099.0000571", "156.01.12.0003", "123456789", "tp1.2", "AB1", "1234567890123456789"]
    assert values(spark, codes, tx.is_product_code) == [True, True, True, False, False, False, False]


def test_cells(spark):
    rows = [
        ["1", "000219002001000", "Xe dap", "CHIẾC", "mau do", "2", "1.000", "2.000"],
        ["x", "TP1.2", "ten", "1", "2"],
        [None, " 156.01.12.0003 ", "a", "1", "3", "4", "5"],
        ["no", "code"],
        [],
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, c array<string>")
    got = [r[0] for r in df.orderBy("i").select(ex.cells_to_line(F.col("c"))).collect()]
    assert (got[0].stt, got[0].unit, got[0].product_name, got[0].line_total) == ("1", "CHIẾC", "Xe dap mau do", 2000)
    assert got[1] is None and got[3] is None and got[4] is None
    assert (got[2].product_code, got[2].product_name, got[2].unit, int(got[2].quantity)) == ("156.01.12.0003", "a 1", "Chiếc", 3)


def test_normalize_name(spark):
    names = ["CÔNG TY CỔ PHẦN  Nam  Tiến", "công ty tnhh cty An", "Cty TNHH", None, "  Minh "]
    assert values(spark, names, tx.normalize_name) == ["nam tiến", "an", "", "", "minh"]


def test_labels_are_found_as_with_a_free_start_everywhere(spark):
    dice = random.Random(5)
    parts = ["achỉ:", "a chi: ", "địa chỉ: ", "ạch■:x", "i lý: ", "đại  lý: ", "ily:", "MST: 0123456789", "\n\n", "\nSTT", " ", "x", "ế", "\n", "😀"]
    texts = ["".join(dice.choices(parts, k=dice.randint(1, 9))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern in (tx.BUYER, tx.ADDRESS):
        free = pattern.replace(r"(?:\A.{0,5})?", ".{0,5}")
        both = rows.select(F.regexp_extract("t", pattern, 1).alias("a"), F.regexp_extract("t", free, 1).alias("b")).collect()
        assert free != pattern and all(r.a == r.b for r in both) and sum(r.a != "" for r in both) > 50
