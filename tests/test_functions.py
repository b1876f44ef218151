"""The rules for texts, numbers, dates and messages, one case each."""

import json
import zlib
from base64 import b64encode
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import coerce, labels, maps, text
from tidemark.sources import changes as src


def value(spark, expression, given=None, kind="string"):
    df = spark.createDataFrame([(given,)], f"v {kind}")
    return df.select(expression.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "given, want",
    [(" 102 421 ", [102, 421]), ("102", [102]), ("", []), (None, []), ("null", []), (" 5  6 ", [5, 6])],
)
def test_id_list(spark, given, want):
    assert value(spark, text.id_list("v"), given) == want


def test_token_needs_no_outer_spaces(spark):
    assert value(spark, text.has_token("v", 102), "102")
    assert value(spark, text.has_token("v", 102), " 1 102 ")
    assert not value(spark, text.has_token("v", 10), " 102 110 ")


def test_names(spark):
    assert value(spark, text.base_type("v"), "Pdmarticlestructure") == "Pdmarticle"
    assert value(spark, text.capitalised("v"), "mamFile") == "MamFile"
    assert value(spark, text.store_name("v"), "User") == "export_user"
    assert value(spark, text.store_name("v", F.lit("reference")), "User") == "export_reference"
    assert value(spark, text.store_name("v", F.lit("Mapping")), "Pdmarticlestructure") == "export_pdmarticle_mapping"
    assert value(spark, text.document_set("v", F.lit(2)), "User") == "export_user_2"
    assert value(spark, text.document_set("v", F.lit(2), searchable=True), "User") == "export_user_search_2"
    assert value(spark, text.document_set("v", F.lit(2)), "MamfileContent") == "export_mamfilecontent"


def test_html(spark):
    page = "<html><style>p{}</style><script>var t='</p>';</script><!-- x --><p>A&amp;B<br>c &lt;d&gt;</p>\n e</html>"
    assert value(spark, text.html_text("v"), page) == "A&B c <d> e"
    assert value(spark, text.search_tokens("v"), "<b>Hello</b> WORLD ") == ["hello", "world"]
    assert value(spark, text.search_tokens("v"), "<p></p>") == []
    assert value(spark, text.html_text("v"), "caf&eacute; &#8364;5 &#x1F600; &amp;lt; &bogus; &#0; &nbsp;x") == (
        "caf\u00e9 \u20ac5 \U0001f600 &lt; &bogus; &#0; x"
    )
    assert value(spark, text.html_text("v"), "a < b and c > d <b>e</b>") == "a < b and c > d e"
    assert value(spark, text.html_text("v"), "1<2 & 3>2") == "1<2 & 3>2"
    assert value(spark, text.html_text("v"), None) is None


def test_long_values(spark):
    exact, long = "x" * 10922, "a" * 6000 + "b" * 6000
    assert value(spark, text.big_value("v"), exact) == exact
    assert value(spark, text.big_value("v"), long) == "a" * 5461 + "b" * 5461
    assert value(spark, text.content_excerpt("v"), "y" * 200) == "y" * 200
    assert value(spark, text.content_excerpt("v"), "a" * 150 + "b" * 150) == "a" * 100 + " " + "b" * 100
    assert value(spark, text.raw_keyword("v"), "ABC") == "abc"
    assert value(spark, text.raw_keyword("v"), "x" * 10923) is None


@pytest.mark.parametrize(
    "given, kind, want",
    [("", "int", 0), (None, "bigint", 0), ("null", "float", 0.0), ("7", "int", 7), ("2.5", "double", 2.5)],
)
def test_numbers(spark, given, kind, want):
    assert value(spark, coerce.number("v", kind), given) == want


def test_a_malformed_number_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, coerce.number("v", "int"), "7x")


@pytest.mark.parametrize(
    "given, want",
    [
        ("0000-00-00 00:00:00", None), ("", None), ("null", None), (None, None),
        ("2018-03-28", datetime(2018, 3, 28)), ("2018-03-28 19:05:56", datetime(2018, 3, 28, 19, 5, 56)),
        ("toTimestamp(now())", datetime(2024, 1, 1)),
    ],
)
def test_times(spark, given, want):
    assert value(spark, coerce.timestamp("v", F.lit("2024-01-01").cast("timestamp")), given) == want


@pytest.mark.parametrize(
    "given, want",
    [
        ("2018", datetime(2018, 1, 1)), ("2018-03", datetime(2018, 3, 1)), ("2018-03-28", datetime(2018, 3, 28)),
        ("2018-03-28T10:11", datetime(2018, 3, 28, 10, 11)), ("1522231556000", datetime(2018, 3, 28, 10, 5, 56)),
        ("2018/03/28 10:11:12", datetime(2018, 3, 28, 10, 11, 12)), ("28/03/2018 10:11", datetime(2018, 3, 28, 10, 11)),
        ("28.03.2018", datetime(2018, 3, 28)), ("03/28/18", datetime(2018, 3, 28)), ("2018.03.28", datetime(2018, 3, 28)),
        ("31-02-2018", None), ("soon", None), ("", None), (None, None),
    ],
)
def test_date_shadow(spark, given, want):
    assert value(spark, coerce.date_shadow("v"), given) == want


def test_strict_dates(spark):
    assert value(spark, coerce.date_valid("v", "yyyy-MM-dd"), "2020-02-29")
    assert not value(spark, coerce.date_valid("v", "yyyy-MM-dd"), "2021-02-29")
    assert not value(spark, coerce.date_valid("v", "yyyy-MM-dd"), None)


def test_numeric_shadow(spark):
    assert value(spark, coerce.numeric_shadow("v"), "1.5") == 1.5
    assert value(spark, coerce.numeric_shadow("v"), "1,5") is None


@pytest.mark.parametrize(
    "given, want", [(0, "0 Bytes"), (1023, "1023 Bytes"), (1024, "1 KB"), (1048575, "1023 KB"), (5 << 40, "5 TB"), (-5, "-5 Bytes")]
)
def test_byte_size(spark, given, want):
    assert value(spark, labels.byte_size("v"), given, "bigint") == want


def test_duration(spark):
    assert value(spark, labels.duration("v"), 3_723_004, "bigint") == "1h 2m 3s 4ms"


def test_priorities(spark):
    assert value(spark, labels.effective_priority("v", F.lit("Item")), 0, "int") == 7
    assert value(spark, labels.effective_priority("v", F.lit("Mapping")), 0, "int") == 8
    assert value(spark, labels.effective_priority("v", F.lit("FileContent")), 0, "int") == 6
    assert value(spark, labels.effective_priority("v", F.lit("Item")), 3, "int") == 3
    assert value(spark, labels.operation_label("v", F.lit(9), F.lit("Item")), 2, "int") == "InitialItem"
    assert value(spark, labels.operation_label("v", F.lit(4), F.lit("Item")), 2, "int") == "DeleteItem"


@pytest.mark.parametrize(
    "message, want",
    [
        ('{"Record":[]}', "Record"), ('{"Record":null,"Reindex":{}}', "Record"), ('{"DebugMode":"OFF","Reindex":{}}', "DebugMode"),
        ('{"Reindex":{}}', "Reindex"), ('{"Item":[]}', "Item"), ("not json", "Item"), (None, "Item"),
    ],
)
def test_message_kind(spark, message, want):
    assert value(spark, src.message_kind("v"), message) == want


def test_payload(spark):
    packed = b64encode(zlib.compress("grüße €".encode())).decode()
    assert value(spark, src.decode_payload("v"), packed) == "grüße €"
    for plain in ("not packed!", "aGVsbG8=", "", None):
        assert value(spark, src.decode_payload("v"), plain) == plain


def test_envelope(spark):
    message = json.dumps(
        {"Item": [{"ID": 62, "LanguageID": "0", "13:Value": "ä", "26:Value": None}], "Reference": [{"AttributeID": "30"}]}
    )
    read = value(spark, src.read_envelope("v"), message)
    assert read["Item"][0] == {"ID": "62", "LanguageID": "0", "13:Value": "ä", "26:Value": None}
    assert read["Reference"] == [{"AttributeID": "30"}] and read["Subtable"] is None


def test_big_attributes(spark):
    listed = value(spark, src.big_attributes("v"), '{"_BigDataAttributes":[["a"],["b"],null,["a","c"]]}')
    assert {k: sorted(v) for k, v in listed.items()} == {"0": ["a"], "1": ["a", "b"], "2": ["a"], "3": ["a", "c"]}
    assert value(spark, src.big_attributes("v"), '{"_BigDataAttributes":{"1":["x"]}}') == {"1": ["x"]}
    assert value(spark, src.big_attributes("v"), "{}") == {}


def test_delete_messages(spark):
    read = lambda m: value(spark, src.read_delete(F.lit(9), "v"), m).asDict()
    assert read("") == {"ids": [9], "item_type": None, "field": None, "value": None}
    assert read("4, 5")["ids"] == [4, 5]
    assert read("4,5,6,7")["ids"] == [4, 5, 6, 7]
    assert read("7, Pdmarticle, StateID, 12") == {"ids": [7], "item_type": "Pdmarticle", "field": "StateID", "value": 12}


def test_operations(spark):
    read = lambda m, a: value(spark, src.read_operation("v", F.lit(a)), m)
    first = read('{"Item":"Pdmarticle, User","MVFields":{"user":["StateID"]}}', 4)
    assert (first["operation"], first["item_types"], first["lookup_fields"]) == (
        "initialize", ["Pdmarticle", "User"], {"user": ["StateID"]},
    )
    assert read('{"Item":"User"}', 1)["operation"] == "itemTypeAdded"
    assert read('{"Item":"User"}', 2)["operation"] == "itemTypeRemoved"
    again = read('{"Reindex":{"ItemType":"User","AffectedItemIDs":["1"],"SearchableFields":[13]}}', 1)
    assert (again["operation"], again["affected_ids"], again["searchable_fields"]) == ("Reindex", ["1"], ["13"])


def test_maps(spark):
    fields = {"13:Value": "a", "13:FormattedValue": "A", "-2:Value": "p", "Label": "l", "_Parents": "1", "X": None}
    kind = "map<string,string>"
    attrs = value(spark, maps.attributes_of("v"), fields, kind)
    assert {k: tuple(v) for k, v in attrs.items()} == {13: ("a", "A"), -2: ("p", None)}
    assert set(value(spark, maps.without_nulls("v"), fields, kind)) == set(fields) - {"X"}
    assert set(value(spark, maps.notice_language_part("v"), fields, kind)) == {
        "13:Value", "13:FormattedValue", "-2:Value", "Label",
    }
    assert set(value(spark, maps.notice_root_part("v"), fields, kind)) == {"X"}
    assert set(value(spark, maps.without_attributes("v", [13]), fields, kind)) == {"-2:Value", "Label", "_Parents", "X"}
    assert set(value(spark, maps.keep_paths("v", ["Label", "13:.*", "1"]), fields, kind)) == {"Label"}
    assert value(spark, maps.inverted("v"), {"1": "en"}, kind) == {"en": "1"}
    assert value(spark, maps.json_map("v"), '{"a":1,"b":null}') == {"a": "1", "b": None}
    assert value(spark, maps.json_map("v"), "") == {}
