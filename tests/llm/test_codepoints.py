"""Consistent form against the standard library, and what counts as disguised."""

import unicodedata

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from registra.llm.codepoints import consistent, consistent_names

PLAIN = ["Crème Brûlée", "Łódka Żurwin", "“Olde” Tarn’s Nook", "Quay–Side", "Φούρνος Λίψω", "Книги Явдин", "Пекарня Жидель", "金穗小厨", "달무리 분식", "مخبز الزهرين", "ਰੰਗਲਾ ਢਾਬਾ", "ACME  ltd. ", "Straßlinger Möbel", "", "   ", "No. 2 & Co."]
ODD = {
    "Acme Ltd": "Acme Ltd", "Ac​me": "Acme", "Ac­me": "Acme", "Ａｃｍｅ ＆ Ｃｏ．": "Acme & Co.", "Coﬀee": "Coffee", "Mofﬆow": "Mofstow", "Café": "Café", "Сafé": "Café", "4121625 В.С. Сο.": "4121625 B.C. Co.",
    "AᏟME Bᴀr": "ACME BAr", "ꓮꓚꓟꓰ": "ACME", "Dᗪelta": "DDelta", "Tаvжern": "Tavжern", "ⲞⲢen": "OPen",
    "L\U0001d42d\U0001d41d": "Ltd", "Marketinɡ": "Marketing", "e͏́": "é", "Ёlan vital": "Ëlan vital", "﻿X": "X", "A　 B": "A B",
}


def test_plain_values_stay():
    text, odd = consistent(pa.array(PLAIN))
    assert not any(odd.to_pylist())
    assert text.to_pylist() == [" ".join(unicodedata.normalize("NFC", p).split()) for p in PLAIN]


def test_disguised_values():
    text, odd = consistent(pa.array(list(ODD)))
    assert text.to_pylist() == list(ODD.values()) and all(odd.to_pylist())


def test_second_pass_finds_nothing():
    text, _ = consistent(pa.array(list(ODD)))
    again, odd = consistent(text)
    assert again.to_pylist() == text.to_pylist() and not any(odd.to_pylist())


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aeoAyÅéñ ̣̂́̈̕1 '가각각ਰੰ金"), max_size=12)), max_size=8))
def test_composition_equals_nfc(values):
    text, _ = consistent(pa.array(values, pa.string()))
    assert text.to_pylist() == [None if v is None else " ".join(unicodedata.normalize("NFC", v).split(" ")).strip(" ") if "  " not in v else " ".join(x for x in unicodedata.normalize("NFC", v).split(" ") if x) for v in values]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from("ÅéẤoaạǖ"), st.lists(st.sampled_from("\u0323\u0301\u030a\u0308\u031b\u0302\u0344"), max_size=4))
def test_marks_in_any_order_equal_nfc(base, marks):
    value = base + "".join(marks)
    assert consistent(pa.array([value]))[0].to_pylist() == [unicodedata.normalize("NFC", value)]


def test_own_marks_do_not_make_a_value_odd():
    """A composed letter before a mark that joins nothing stays as it is; one that takes the mark is odd."""
    text, odd = consistent(pa.array(["e\u0332\u0301x", "\u00e9\u0332", "\u00e9\u0323"]))
    assert text.to_pylist() == ["\u00e9\u0332x", "\u00e9\u0332", "\u1eb9\u0301"] and odd.to_pylist() == [True, False, True]


def test_sliced_null_and_long_arrays():
    column = pa.array(["zero", None, "ｏｎｅ", "x" * 200_000 + "​", None])
    text, odd = consistent(column.slice(1))
    assert text.to_pylist() == [None, "one", "x" * 200_000, None] and odd.to_pylist() == [False, True, True, False]
    assert consistent(pa.array([], pa.string()))[0].to_pylist() == []
    assert consistent(pa.array([None, None], pa.string()))[0].to_pylist() == [None, None]


def test_operator(spark, rows):
    df = spark.createDataFrame([(1, "Ａ", None, "k"), (1, "Ａ", None, "k"), (None, None, "b c", "k")], "id bigint, n string, t string, n__odd string")
    got = rows(consistent_names(df.drop("n__odd"), ["id"], ["n", "t"]))
    assert got == sorted([(1, "A", None, True, False), (1, "A", None, True, False), (None, None, "b c", False, True)], key=repr)
    assert rows(consistent_names(df.limit(0), ["id"], ["t"])) == []
