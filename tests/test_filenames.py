"""Report file names, written by hand."""

import pytest

from caseledger.functions.filenames import read_name

CASES = {
    "MP 298 Cantor 24-May-26.pdf": ("MP", "298", "Cantor", "24-May-26", "2026-05-24", "2026", False, "", []),
    "sm58-acme-05_may_2016_0.pdf": ("SM", "58", "acme", "05_may_2016", "2016-05-05", "2016", False, "_0", []),
    "HI A 573 B Blue Oil 7july2020 (2).pdf": ("HI", "A 573 B", "Blue Oil", "7july2020", "2020-07-07", "2020", False, "(2)", []),
    "ei-100-north-may-24-2026-redacted": ("EI", "100", "north", "may-24-2026", "2026-05-24", "2026", True, "", []),
    "vk 12A 20170911 final report": ("VK", "12A", "", "20170911", "2017-09-11", "2017", False, "", ["no_operator_in_filename"]),
    "ST 27 x 12-20-2013 and 05-26-11": ("ST", "27 X", "and", "12-20-2013", "2013-12-20", "2013", False, "", ["multiple_date_tokens:2"]),
    "091219a-pdf": ("", "", "", "091219a-pdf", "2009-12-19", "2009", False, "", ["archive_yymmdd_filename", "no_area_block_in_filename"]),
    "999919": ("", "", "", "", "", "", False, "", ["archive_yymmdd_invalid", "no_area_block_in_filename", "no_operator_in_filename"]),
    "Acme & Sons ZZ 12 santized-v2": ("", "", "Acme & Sons ZZ", "", "", "", True, "-v2", ["no_date_token", "no_area_block_in_filename"]),
    "GC something 31-feb-2019": ("", "", "GC something", "feb-2019", "2019-02-20", "2019", False, "", ["no_area_block_in_filename"]),
    " .pdf": ("", "", "", "", "", "", False, "", ["empty_filename"]),
    None: ("", "", "", "", "", "", False, "", ["empty_filename"]),
}


@pytest.mark.parametrize("name", list(CASES))
def test_names(name):
    assert read_name(name) == CASES[name]
