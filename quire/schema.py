"""Schemas of all inputs and outputs; nothing is inferred."""

from __future__ import annotations

AYAT = "edition_id int, surah int, ayah int, text string, page int"
PRINTED_LINES = "edition_id int, line_no bigint, text string"
PAGE_SEGMENTS = "edition_id int, segment_no int, xml string"

#: A line's end: a word (word, wordIndex) or a verse marker (number).
ENDPOINT = "struct<type:string,surah:int,ayah:int,word:string,wordIndex:int,number:int>"
LINE = f"struct<line:int,first_word:{ENDPOINT},end_word:{ENDPOINT}>"
PAGE = f"schema_version int, page int, surah_ids array<int>, font_family string, layout_source string, lines array<{LINE}>"
SURAH = f"schema_version int, surahId int, surahName string, startPage int, endPage int, totalPagesInSurah int, totalCompletedLines int, ayaCount int, font_family string, layout_source string, pages array<struct<page:int,lines:array<{LINE}>>>"

MAPPING = "edition_id int, surah int, ayah int, hafs_ayah int"
EDITIONS = "edition_id int, edition_key string, rawi string, ayah_count int, reference string"
METADATA = "key string, value string"
COUNTS = "_counting_system string, _total_ayahs int, surahs map<string,int>"

STYLE = "struct<font_family:string,font_size_half_points:int,rtl:boolean,bold:boolean,italic:boolean,hidden:boolean>"
#: Whole numbers; ``other`` holds what is none.
SPACING = "struct<before:int,after:int,line:int,lineRule:string,other:map<string,string>>"
INDENT = "struct<left:int,right:int,firstLine:int,hanging:int,other:map<string,string>>"
PROPS = f"struct<alignment:string,bidi:boolean,spacing:{SPACING},indent:{INDENT},widow_control:boolean,auto_space_de:boolean,auto_space_dn:boolean,adjust_right_ind:boolean>"
GEOMETRY = "struct<page_size_twips:struct<width:int,height:int>,margins_twips:struct<top:int,right:int,bottom:int,left:int,header:int,footer:int,gutter:int>,doc_grid:struct<line_pitch_twips:int,line_rule:string>>"
EVENTS = f"doc string, para_no int, event_no int, type string, value string, style {STYLE}"
PARAGRAPHS = f"doc string, para_no int, props {PROPS}"

VIOLATION = "rule string, key string, detail string"
