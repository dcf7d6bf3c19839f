"""Schemas of the landed sources and of the event table."""

from __future__ import annotations

ACTION = "struct<actionDate:string,text:string,type:string>"
BILLS_PAGE = "congress int, bill_type string, page int, bills array<struct<congress:int,type:string,number:string,title:string,updateDate:string>>, pagination struct<next:string>"
ACTIONS_PAGE = f"congress int, bill_type string, number string, actions array<{ACTION}>"
COMMITTEES_PAGE = "chamber string, page int, committees array<struct<systemCode:string,name:string,chamber:string,parent:struct<systemCode:string>>>, pagination struct<next:string>"
COMMITTEE_DETAIL = "systemCode string, committee struct<history:array<struct<officialName:string,libraryOfCongressName:string,endDate:string>>>"
PACKAGES_PAGE = "packages array<struct<packageId:string,dateIssued:string>>, nextPage string"
GRANULES_PAGE = "packageId string, page int, granules array<struct<granuleId:string,title:string,granuleClass:string>>, nextPage string"
SUMMARY = "granuleId string, title string, download struct<txtLink:string>, detailsLink string"
GRANULE_TEXT = "granuleId string, body string"
RENDITIONS = "congress int, bill_type string, number string, host string, stage string, format string, body string"
TERM = "struct<type:string,state:string,start:string,end:string,party:string>"
LEGISLATORS = (
    "id struct<bioguide:string>, name struct<first:string,middle:string,last:string,official_full:string>, bio struct<gender:string>, "
    f"other_names array<struct<last:string,end:string>>, terms array<{TERM}>"
)
CANDIDATES = f"seq long, bioguide string, surname_key string, states array<string>, first string, gender string, terms array<{TERM}>"

#: Nullable fields of every kind of source; the sink writes the ones of its type.
SOURCE_REF = "struct<type:string,number:string,stage:string,agreed_to_date:string,congress_gov_url:string,govinfo_xml_url:string,page:string,granule_id:string,signed_date:string,url:string>"
REF_FIELDS = {
    "resolution": ("type", "number", "stage", "agreed_to_date", "congress_gov_url", "govinfo_xml_url"),
    "record": ("type", "page", "granule_id", "signed_date", "url"),
}
EVENT_FIELDS = (
    "congress", "chamber", "change_type", "committee", "system_code", "gpo_code", "member_name", "member_name_raw", "bioguide_id", "party_rank", "date", "source", "source_ref",
)
EVENTS = (
    "congress string, chamber string, change_type string, committee string, system_code string, gpo_code string, member_name string, member_name_raw string, "
    f"bioguide_id string, party_rank int, date string, source string, source_ref {SOURCE_REF}, doc_seq long, block_pos int, member_pos int"
)
PAIRS = "array<struct<clean:string,raw:string>>"
