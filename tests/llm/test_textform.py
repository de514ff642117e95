import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from chatloom.llm.textform import LOOK_ALIKES, look_classes, mapping, normalised, one_form, readable, same_look_pairs, with_offsets
from tests.conftest import rows


def test_same_look():
    for a, b in (("ｆｕｌｌ　ｗｉｄｔｈ", "full width"), ("caf́e".replace("f́e", "fé"), "café"), ("a​b⁠c﻿­d", "abcd"), ("no break thin", "no break thin"), ("x\r\ny\rz", "x\ny\nz"), ("пос".replace("п", "p"), "poc"), ("ﬁne ﬂow", "fine flow"), ("a‐b‑c", "a-b-c"), ("end \n", "end")):
        assert one_form(a) == one_form(b), (a, b)


def test_visible_differences_stay():
    for a, b in (("12", "1²"), ("über", "uber"), ("The", "the"), ("a - b", "a – b"), ("👩‍💻", "👩💻"), ("15", "16"), ("a  b", "a b"), ("ok!", "ok?")):
        assert one_form(a) != one_form(b), (a, b)


def test_other_scripts_stay_readable(spark):
    for t in ("Привет мир", "сор и мусор", "Ελλάδα", "Բարև", "नमस्ते दुनिया", "漢字かな"):
        assert readable(t) == t, t
    # disguises inside Latin text go, also in words of look-alikes only
    assert readable("pаypаl, саn you рау") == "paypal, can you pay"
    assert readable("ᎪᏢᏢᏞᎬ рie") == readable("ᎪᏢᏢᏞᎬ pie") and one_form("ᎠᎬ") == "DE"
    assert one_form("сор") == one_form("cop")  # equal in print, whatever it is made of
    d = spark.createDataFrame([("Привет ｆｕｌｌ", 1), (None, 2), (" \u200b", 3)], "text string, text_form int")
    assert [r["text_form"] for r in normalised(d).collect()] == ["Привет full", None, ""]


def test_mapping_has_no_chains():
    m = mapping()
    assert all(x not in m for v in m.values() for x in v)
    assert all(len(v) == 1 for v in LOOK_ALIKES.values())


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=40))
def test_once_is_enough_and_offsets_point_home(t):
    f = one_form(t)
    assert one_form(f) == f
    form, at = with_offsets(t)
    assert len(at) == len(form) + 1 and at == sorted(at) and at[-1] == len(t)
    assert one_form(unicodedata.normalize("NFC", f)) == one_form(f)
    assert readable(readable(t)) == readable(t) and one_form(readable(t)) == f


def test_pairs_and_classes(spark):
    d = [(1, "same text"), (2, "same text"), (3, "same text"), (4, "other"), (5, None), (6, "  "), (7, "ｓａｍｅ text"), (8, "​"), (9, "x" * 100_000)]
    df = spark.createDataFrame(d, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id")
    assert rows(same_look_pairs(df)) == [(1, 2), (1, 7), (2, 3), (2, 7), (3, 7)]
    assert (1, 1, 4, 3) in rows(look_classes(df)) and len(rows(look_classes(df))) == 6
    assert rows(same_look_pairs(df.limit(0))) == []
