"""Schemas of the tables and files; explicit, never inferred."""

from __future__ import annotations

INDEX = "id int, vol string not null, leaf int not null, page_printed string, title string not null, context string, source string, place_type string, island string, judicial_district string, municipality string"
INDEX_RECORD = "vol string, leaf int, page_printed string, title string, context string, source string"
ENTRY = "title string, place_type string, island string, judicial_district string, municipality string, description string, description_raw string, stats map<string,double>, cross_references array<string>, confidence string"
LEAF = f"vol string, leaf int, page_printed string, window int, model string, note string, entries array<struct<{', '.join(f.replace(' ', ':', 1) for f in ENTRY.split(', '))}>>"
PAGE_MAP = "pages array<struct<leafNum:int,pageNumber:string>>"
GAZETTEER = "id string, spelling string, normalized string, tokens string, first_token string, municipality string, island string, local_type string, is_settlement boolean, lon double, lat double, source string"
WEB = "generated_with string, text_total int, entries array<map<string,string>>"
#: The table of linked entries: keys, the entry's own columns, where it came from and where it lies.
ENTRIES = f"id long, vol string not null, leaf int not null, page_printed string, entry_ordinal int, {ENTRY}, index_id int, model string, source_file string, lon double, lat double"
