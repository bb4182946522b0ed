"""The gram index: a gram begins at every place of a searched field, and needles of any length find what a scan finds."""

import pytest

from conftest import rows
from orderloom.operators import dashboard, search

SCHEMA = "order_no string, trade_name string, document string, center string, responsible string, codcli string, branch string"
HEADS = [("1", "Bar é", None, "", "Resp 1", "x", "north"), ("22", None, "CPF: 1", "CD-0", "", None, "south"),
         ("333", "ab", "cba", "b", "aé", "%_", None), (None, "abcabc", "ABC", "CD-0", "r", "22", "north")]


def test_a_gram_begins_at_every_place_of_a_field(spark):
    one = spark.createDataFrame([("12345", "abab", None, "", "é", "7", "north")], SCHEMA)
    assert [r.gram for r in search.grams(one).orderBy("gram").collect()] == sorted(
        ["123", "234", "345", "45", "5", "aba", "bab", "ab", "b", "é", "7"])


@pytest.mark.parametrize("needle", ["é", "b", "ab", "22", "2", "abc", "bcab", "cd-0", "%_", "resp", "c", "zz", "z", "a"])
def test_needles_of_every_length_find_what_a_scan_finds(spark, tmp_path, needle):
    heads = spark.createDataFrame(HEADS, SCHEMA)
    search.write_index(heads, str(tmp_path), parts=3)
    for branch in ("", "north"):
        got = search.search_indexed(heads, str(tmp_path), needle, branch, parts=3)
        want = dashboard.search_orders(heads.where("order_no is not null"), needle, branch)
        assert rows(got) == rows(want)
