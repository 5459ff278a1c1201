"""Column expressions, one edge per row."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from shelflens.functions import names, packed, payload, text
from shelflens.schema import DETAIL, REVIEW


@pytest.mark.parametrize("value, expected", [
    ("", None), ("  ", None), (" N/A ", None), ("NULL", None), ("NaN", None), ("-", None), ("..", None),
    (" none　", None), ("na\n", None), (" x ", " x "), ("n/a b", "n/a b"), ("...", "..."), (None, None),
])
def test_null_tokens(value_of, value, expected):
    assert value_of(text.null_if_token, value) == expected


@pytest.mark.parametrize("value, expected", [
    ("12", 12.0), (" 12 ", 12.0), ("1e3", 1000.0), ("-.5", -0.5), ("5.", 5.0), ("1,000", None), ("abc", None),
    ("12d", None), ("0x1p3", None), ("NaN", None), ("", None), (None, None),
])
def test_numbers(value_of, value, expected):
    assert value_of(text.to_double, value) == expected


@pytest.mark.parametrize("value, expected", [
    ("9007199254740993", 9007199254740993), ("16.0", 16), ("1e5", 100000), ("x", None), ("99999999999999999999", None),
])
def test_integers(value_of, value, expected):
    assert value_of(text.to_integer, value) == expected


@pytest.mark.parametrize("value, expected", [("True", True), ("false", False), ("1", True), ("None", None), (None, None)])
def test_booleans(value_of, value, expected):
    assert value_of(text.to_boolean, value) is expected


def test_strip_cuts_every_kind_of_space(value_of):
    assert value_of(text.strip, " \t a b  \n") == "a b"


KV = "is_hero:True; is_top_brand:None; note:a:b ; is_hero : false;;junk; empty:"


@pytest.mark.parametrize("key, expected", [
    ("is_hero", "false"), ("note", "a:b"), ("empty", None), ("hero", None), ("absent", None),
])
def test_kv_value(value_of, key, expected):
    assert value_of(packed.kv_value, KV, key) == expected


@pytest.mark.parametrize("value, expected", [
    ("k:1", "1"), ("  k :  a : b ", "a : b"), ("x:1;k:2", "2"), ("x:1;  k:2;", "2"), ("x:1;\tk\u00a0:\u30002", "2"),
    ("k:1; k:2", "2"), ("xk:1", None), ("x:k:1", None), ("k", None), ("x:1 ;k:a b ; y:2", "a b"), ("k:;", None),
])
def test_kv_value_whatever_the_spacing(value_of, value, expected):
    assert value_of(packed.kv_value, value, "k") == expected


def test_kv_flag(value_of):
    assert value_of(packed.kv_flag, KV, "is_hero") is False
    assert value_of(packed.kv_flag, KV, "is_top_brand") is None
    assert value_of(packed.kv_flag, None, "is_hero") is None


def test_kv_entries_keep_the_last_of_a_key(value_of):
    found = {e.k: e.v for e in value_of(packed.kv_entries, KV)}
    assert found == {"is_top_brand": "None", "note": "a:b", "is_hero": "false", "empty": ""}


@pytest.mark.parametrize("value, expected", [
    ("qty:1,000", 1000.0), ("qty:-2.5", -2.5), ("qty:None", None), ("qty:1e3", None), ("max_qty:5", None), (None, None),
])
def test_kv_number(value_of, value, expected):
    assert value_of(packed.kv_number, value, "qty") == expected


@pytest.mark.parametrize("value, number, name", [
    ("id:31627; name:Acme Home", 31627, "Acme Home"),
    ("id:1,2; name:Alpha, Beta", 1, "Alpha, Beta"),
    ("id:None; name:None", None, "None"),
    ("grid:5; name: A; B ", None, "A; B"),
    ("name:", None, None),
    (None, None, None),
])
def test_brand(value_of, value, number, name):
    assert value_of(packed.brand_id, value) == number
    assert value_of(packed.brand_name, value) == name


STARS = "1:count_2,percent_9;2:count_0,percent_None; 5 : count_7 , percent_31;5:count_19,percent_91"


@pytest.mark.parametrize("level, part, expected", [
    (1, "count", 2), (1, "percent", 9), (2, "count", None), (3, "count", None), (5, "count", 19), (5, "percent", 91),
])
def test_stars(value_of, level, part, expected):
    assert value_of(packed.star_part, STARS, level, part) == expected


def test_star_entry_with_none_does_not_hide_an_earlier_one(value_of):
    assert value_of(packed.star_part, "5:count_1,percent_2;5:count_3,percent_None", 5, "count") == 1


@pytest.mark.parametrize("value, expected", [
    ("[{'code': 'video_icon'}]", True), ("video_icon_2", False), ("xvideo_icon", False), (None, False), ("", False),
])
def test_badges(value_of, value, expected):
    assert value_of(packed.badge_flag, value, "has_video_badge") is expected


@pytest.mark.parametrize("value, storage, ram, inch", [
    ("Phone RAM 8GB 128 GB", 8.0, 8.0, None),
    ("Disk 1,5TB 512GB", 1536.0, None, None),
    ("TV 55 inch", None, None, 55.0),
    ('Panel 6.5"', None, None, 6.5),
    (None, None, None, None),
])
def test_name_sizes(value_of, value, storage, ram, inch):
    assert value_of(names.storage_gb, value) == storage
    assert value_of(names.ram_gb, value) == ram
    assert value_of(names.inches, value) == inch


def test_name_keywords_match_inside_words(value_of):
    assert value_of(names.has_keyword, "New PRODUCT", "pro") == 1
    assert value_of(names.has_keyword, "x", "pro") == 0
    assert value_of(names.has_keyword, None, "pro") == 0


def flat(spark, schema, obj, function):
    df = spark.createDataFrame([(json.dumps(obj),)], "j string").select(F.from_json("j", schema).alias("p"))
    return df.select(function(F.col("p")).alias("v")).first().v


@pytest.mark.parametrize("detail, expected", [
    ({"authors": [{"id": 1, "name": "Ann"}, {"id": None, "name": ""}, {"id": 2, "name": "Bo"}], "brand": {"id": 9}},
     "id:1,2; name:Ann, Bo"),
    ({"authors": [{"id": None, "name": None}], "brand": {"id": 9, "name": "B"}}, "id:None; name:None"),
    ({"authors": [], "brand": {"id": 9, "name": "B"}}, "id:9; name:B"),
    ({"brand": {"id": 9}}, "id:9; name:None"),
    ({"authors": None}, ""),
    ({}, ""),
])
def test_brand_or_author(spark, detail, expected):
    assert flat(spark, DETAIL, detail, payload.brand_or_author) == expected


@pytest.mark.parametrize("detail, expected", [
    ({"tracking_info": {"amplitude": {"is_authentic": True, "return_reason": "x"}}},
     "is_authentic:True; is_freeship_xtra:None; is_hero:None; is_top_brand:None; return_reason:x"),
    ({"tracking_info": {"amplitude": {}}},
     "is_authentic:None; is_freeship_xtra:None; is_hero:None; is_top_brand:None; return_reason:None"),
    ({"tracking_info": {}}, ""),
    ({"tracking_info": None}, ""),
])
def test_tracking(spark, detail, expected):
    assert flat(spark, DETAIL, detail, payload.tracking) == expected


@pytest.mark.parametrize("categories, expected", [
    ({"id": 1, "name": "A", "is_leaf": True}, "id:1; name:A; is_leaf:True"),
    ([{"id": 1}, {"id": 2, "name": "B", "is_leaf": False}], "id:2; name:B; is_leaf:False"),
    ([{"id": 1}, 5], ""), ([], ""), (None, ""), ("text", ""),
])
def test_category(spark, categories, expected):
    assert flat(spark, DETAIL, {"categories": categories}, lambda d: payload.category(d["categories"])) == expected


@pytest.mark.parametrize("benefits, expected", [([1, 2], 2), ({"a": 1}, 1), ([], 0), ({}, 0), (None, 0), (7, 0)])
def test_benefits(spark, benefits, expected):
    assert flat(spark, DETAIL, {"benefits": benefits}, lambda d: payload.benefits_count(d["benefits"])) == expected


@pytest.mark.parametrize("review, expected", [
    ({"rating_average": 4.5, "reviews_count": 3, "rating_summary": {"rating_average": 1.0}}, (4.5, 3)),
    ({"rating_average": 0, "reviews_count": None, "rating_summary": {"reviews_count": 7}}, (None, 7)),
    ({"rating_average": None, "reviews_count": 0, "rating_summary": {"rating_average": 2.5, "reviews_count": 9}}, (2.5, 9)),
    ({"rating_average": 0, "reviews_count": None}, (0.0, None)),
    ({}, (None, None)),
])
def test_rating_pair(spark, review, expected):
    pair = flat(spark, REVIEW, review, lambda r: F.struct(*[
        c.alias(n) for c, n in zip(payload.rating_pair(r), ("a", "c"))
    ]))
    assert (pair.a, pair.c) == expected


@pytest.mark.parametrize("review, expected", [
    ({"stars": {"1": {"count": 2, "percent": 9}, "2": {"count": 3}, "3": {"count": None, "percent": None}, "4": {},
                "5": 6}}, "1:count_2,percent_9;2:count_3,percent_None;5:count_6,percent_None"),
    ({"stars": {"1": 0, "2": None}}, ""),
    ({"stars": {}, "rating_summary": {"stars": {"1": 4}}}, ""),
    ({"stars": [1], "rating_summary": {"stars": {"1": 4}}}, "1:count_4,percent_None"),
    ({"rating_summary": {"stars": {"5": {"count": 0, "percent": 0}}}}, "5:count_0,percent_0"),
    ({}, ""),
])
def test_star_packing(spark, review, expected):
    assert flat(spark, REVIEW, review, payload.stars) == expected


@pytest.mark.parametrize("value, expected", [
    ('{"text":"x","value":12}', 12.0), ("7", 7.0), ('{"text":"x"}', None), (None, None), ("many", None),
])
def test_sold_quantity(value_of, value, expected):
    assert value_of(payload.sold_quantity, value) == expected


@pytest.mark.parametrize("value, expected", [
    ("<TITLE lang='x'>\n A &amp; B &eacute;&#233; </title>", "A & B éé"),
    ("<title></title>", ""), ("<html><titles>x</titles>", "No title"), (None, "No title"),
    ("<title>a &lt;b &amp</title>", "a <b &"), ("<!-- <title>old</title> --><title>new</title>", "new"),
    ("<script>var t = '<title>no</title>';</script><title>&copy 1 &#x41;&#233;</title>", "© 1 Aé"),
    ("<STYLE>/* <title>no</title> */</STYLE >", "No title"), ("<!-- <title>open</title>", "No title"),
    ("<title>a</title><!-- b -->", "a"), ("<title>&amp;lt;</title>", "&lt;"),
    ("<title>one</title><title>two</title>", "one"),
])
def test_page_title(value_of, value, expected):
    assert value_of(payload.page_title, value) == expected
