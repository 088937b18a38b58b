"""Explicit record types (T1-T21); nothing is inferred from data."""

from __future__ import annotations

CONTEXT = "struct<parent_block:string,previous_block:string,parent_text:string,heading_above:string>"
ANCHOR = f"struct<pos:int,href:string,text:string,text_spaced:string,title:string,html_context:{CONTEXT}>"
RESOURCE = "struct<tag:string,tag_order:int,pos:int,href:string,text:string,title:string>"
PARSED = (
    f"struct<h1:string,h2:string,title:string,visible:string,readable:string,base:string,anchors:array<{ANCHOR}>,"
    f"resources:array<{RESOURCE}>,blocks:array<string>,code:array<string>>"
)
CLASSIFICATION = "struct<is_back_link:boolean,is_course_page:boolean,is_course_relevant:boolean,confidence:double,reasoning:string>"
VERIFICATION = (
    "struct<is_course_page:boolean,confidence:double,course_code:string,course_name:string,semester:string,reasoning:string,has_other_course_links:boolean>"
)
AI_FIELDS = (
    "struct<ai_page_type:string,ai_confidence:string,ai_reasoning:string,course_code:string,course_title:string,semester:string,year:string,"
    "has_notes:boolean,notes_type:string,notes_details:string,further_course_related_data_present:boolean,has_syllabus_or_logistics:boolean,is_useful:boolean>"
)
ITEM = "struct<link_index:int,item_type:string,title:string,snippet:string,file_url:string,confidence:string>"
MARK = "struct<index:int,mark:string,reason:string,suggestion:string>"
PAGES = "page_id bigint, url string, html string"

# The columns of the course table, in output order.
COURSE_COLUMNS = (
    "url course_code course_title semester year manual_page_type ai_page_type ai_confidence ai_reasoning has_notes notes_type notes_details "
    "further_course_related_data_present has_syllabus_or_logistics is_useful conflict_flag recheck_needed all_files_json all_internal_links_json"
).split()
BUCKETS = ("back_link", "course_page", "course_relevant", "irrelevant", "inaccessible")
