"""Field catalogues of journal, issue, document, citation and paragraph records.

All values are fixed: they are the tags and subfields of the records' format. A line is name, tag, and how the
field is read: ``1`` one text, ``*`` all texts, ``1 code=name,...`` one map, ``* code=name,...`` all maps.
"""

from __future__ import annotations

JOURNAL = """
cnn_code 020 1
secs_code 037 1
current_status 050 1
status_history 051 * a=in_date,b=in_status,c=out_date,d=out_status
copyright_holder 062 1
publisher_address 063 *
publisher_email 064 1
acronym 068 1
institutional_url 069 1
controlled_vocabulary 085 1
title 100 1
subtitle 110 1
editorial_standard 117 1
sponsors 140 *
abbreviated_title 150 1
abbreviated_iso_title 151 1
parallel_titles 230 *
other_titles 240 *
first_year 301 1
first_volume 302 1
first_number 303 1
last_year 304 1
last_volume 305 1
last_number 306 1
publisher_country 310 1
publisher_state 320 1
publication_level 330 1
languages 350 *
abstract_languages 360 *
periodicity 380 1
issn_id 400 1
title_nlm 421 1
typed_issns 435 * _=value,t=type
subject_descriptors 440 *
subject_areas 441 *
index_coverage 450 *
publisher_name 480 *
publisher_city 490 1
license_code 541 1
license_texts 540 * t=html,l=language
previous_title 610 1
domain 690 1
submission_url 692 1
publishing_model 699 1
next_title 710 1
is_indexed_in_scie 851 1
wos_citation_indexes 851 *
is_indexed_in_ssci 852 1
is_indexed_in_ahci 853 1
wos_subject_areas 854 *
mission_lines 901 * _=text,l=language
current_issn 935 1
issn_type 035 1
creation_date 940 1
update_date 941 1
collection_acronym 992 1
"""

ISSUE = """
journal 035 1
assets_code 004 1
volume 031 1
number 032 1
titles 033 1
order 036 1
is_press_release 041 1
bibliographic_legends 043 1
bibliographic_strip 043 * t=short_title,v=volume,n=number,s=suppl,l=language,c=city,a=year,m=months
sections 049 * l=language,t=text,c=code
publication_date 065 1
controlled_vocabulary 085 1
update_date 091 1
creation_date 093 1
editorial_standard 117 1
total_documents 122 1
supplement_volume 131 1
supplement_number 132 1
is_marked_up 200 1
license_code 541 1
license_texts 540 * t=html,l=language
domain 690 1
publisher_id 880 1
collection_acronym 992 1
"""

DOCUMENT = """
pid_v1_raw 002 1
assets_code 004 1
authors 010 * 1=xref,k=orcid,l=lattes,n=given_names,p=prefix,r=role,s=surname
corporative_authors 011 *
article_titles 012 * s=subtitle,_=text,l=language
page 014 1 e=elocation,f=start,l=end,s=sequence
volume 031 1
issue_number 032 1
journal_id 035 1
illustrative_material 038 *
original_language 040 1
is_press_release 041 1
section_code 049 1
thesis_degree 051 1
thesis_organization 052 1
project_sponsor 058 *
project_name 059 *
contract 060 *
issue_publication_date 065 1
affiliations 070 * d=div1,1=div1,2=div2,3=div3,o=orgname,_=orgname,c=city,e=email,i=id,p=country,s=state
document_type 071 1
abstracts 083 * _=text,a=text,l=language
keywords 085 * k=text,s=subkey,l=language
update_date 091 1
creation_date 093 1
receive_date_iso 112 1
acceptance_date_iso 114 1
review_date_iso 116 1
data_model_version 120 1
internal_sequence_id 121 1
vol_suppl 131 1
num_suppl 132 1
document_publication_date 223 1
doi 237 1
normalized_affiliations 240 * i=id,p=country
doi_with_lang 337 * d=doi,l=language
any_issn 435 * _=value,t=type
license_code 541 1
license_html 540 * t=html,l=language
languages 601 *
domain 690 1
file_code 702 1
pid_v2 880 1
aop_pid 881 1
pid_v3 885 1
collection_acronym 992 1
"""

CITATION = """
analytic_person_authors 010 * _=anonymous,n=given_names,p=prefix,r=role,s=surname
analytic_corporative_authors 011 * _=name,d=division
article_title 012 1 _=text,l=language
pages_range 014 1 _=range,e=elocation
monographic_person_authors 016 * _=anonymous,n=given_names,p=prefix,r=role,s=surname
monographic_corporative_authors 017 * _=name,d=division
monographic_title 018 1 _=text,l=language
size 020 1 _=size,u=unit
tome 022 1
coltitle 025 1
colvolid 026 1
serial_person_authors 028 * _=anonymous,n=given_names,p=prefix,r=role,s=surname
serial_corporative_authors 029 * _=name,d=division
journal_title 030 1 _=text,l=language
volume 031 1
issue 032 1 n=number,s=suppl
issue_title 033 1
issue_part 034 1
issn 035 1
ext_link 037 1
thesis_date 044 1
thesis_date_iso 045 1
thesis_location 046 1 _=city,e=state
thesis_country 047 1
thesis_organization 050 1 _=name,d=division
thesis_degree 051 1
conference_organization 052 1 _=name,d=division
conferences 053 * _=name,n=number
conference_date 054 1
conference_date_iso 055 1
conference_location 056 1 _=city,e=state
conference_country 057 1
project_sponsor 058 1 _=name,d=division
project_name 059 1
project_number 060 1
notes 061 *
publisher_name 062 1
edition 063 1
year 064 1
publication_date_iso 065 1
publisher_location 066 1 _=city,e=state
publisher_country 067 1
isbn 069 1
publication_type_raw 071 1
version 095 1
access_date 109 1
access_date_iso 110 1
label 118 1
patent 150 1 _=country,a=id,b=date,c=date_iso,d=organization
doi 237 1
pmid 238 1
pmcid 239 1
pages 514 * e=elocation,f=first,l=last,r=range
index_number 701 1
paragraph_text 704 1
etal 810 1
"""

PARAGRAPH = """
record_type_index 701 1
paragraph_text 704 1
record_type 706 1
reference_index 888 1
"""
