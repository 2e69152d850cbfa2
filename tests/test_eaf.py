"""ELAN files that another program may write."""

import pytest
from parlance.sources import files

EAF = """<?xml version="1.0" encoding="UTF-8"?>
<!-- <TIER TIER_ID="no"> -->
<ANNOTATION_DOCUMENT AUTHOR='' xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:noNamespaceSchemaLocation="http://www.mpi.nl/tools/elan/EAFv3.0.xsd">
<HEADER TIME_UNITS="milliseconds"/>
<TIME_ORDER><TIME_SLOT TIME_SLOT_ID='ts1'/><TIME_SLOT TIME_VALUE='1500' TIME_SLOT_ID="ts2"/><TIME_SLOT TIME_SLOT_ID="ts3" TIME_VALUE="700"></TIME_SLOT></TIME_ORDER>
<TIER LINGUISTIC_TYPE_REF="default" TIER_ID='A &amp; B'>
<ANNOTATION><ALIGNABLE_ANNOTATION ANNOTATION_ID="a1" TIME_SLOT_REF2="ts2" TIME_SLOT_REF1="ts3"><ANNOTATION_VALUE><![CDATA[ <b> & "c" ]]></ANNOTATION_VALUE></ALIGNABLE_ANNOTATION></ANNOTATION>
<ANNOTATION><ALIGNABLE_ANNOTATION ANNOTATION_ID='a2' TIME_SLOT_REF1='ts1' TIME_SLOT_REF2='ts2'><ANNOTATION_VALUE>id:7 perch&#xE9; &#39;&lt;&#60;
x</ANNOTATION_VALUE></ALIGNABLE_ANNOTATION></ANNOTATION>
</TIER>
<TIER TIER_ID="empty"/>
<TIER TIER_ID="A_it" PARENT_REF="A"><ANNOTATION><REF_ANNOTATION ANNOTATION_ID="a3" ANNOTATION_REF="a1"><ANNOTATION_VALUE/></REF_ANNOTATION></ANNOTATION></TIER>
</ANNOTATION_DOCUMENT>
"""


def test_any_well_formed_file(spark, tmp_path):
    (tmp_path / "one.eaf").write_text("﻿" + EAF, encoding="utf-8")
    got = files.read_eaf(spark, f"{tmp_path}/*.eaf").orderBy("tu_id").collect()
    assert [(r.transcript_id, r.tu_id, r.old_id, r.speaker, r.start, r.end, r.text, r.parent_tu_id) for r in got] == [
        ("one", 0, 7, "A & B", 0.0, 1.5, "perché '<<\nx", None), ("one", 1, None, "A & B", 0.7, 1.5, ' <b> & "c" ', None), ("one", 2, None, "A_it", 0.7, 1.5, "", 1),
    ]


def test_a_file_that_is_cut_off_is_an_error(spark, tmp_path):
    (tmp_path / "one.eaf").write_text(EAF[:900], encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed|xml"):
        files.read_eaf(spark, f"{tmp_path}/*.eaf").collect()
