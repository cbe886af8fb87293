"""Fixed schemas, as DDL text: change files, landed JSON pages and target tables.

Integer columns that may be empty arrive as ``5236.0`` in the change files, so they are read as
double and cast later. Names with dots are quoted.
"""

from __future__ import annotations

from collections.abc import Sequence


def _ddl(text: str) -> str:
    """``name type`` pairs, one per line or comma, with every name quoted."""
    fields = [f.split(None, 1) for f in text.replace("\n", ",").split(",") if f.strip()]
    return ", ".join(f"`{name}` {kind.strip()}" for name, kind in fields)


#: Fixed value: the mark of the institution in its codes.
INSTITUTION = "203"

# Fixed formats: columns of the change files, in file order.
CHANGE_FILES: dict[str, str] = {
    "enrollments": _ddl("""
        key.id bigint, value.user_id bigint, value.course_id bigint, value.type string
        value.created_at timestamp, value.updated_at timestamp, value.start_at timestamp, value.end_at timestamp
        value.workflow_state string, value.total_activity_time double, value.last_activity_at timestamp"""),
    "pseudonyms": _ddl("""
        key.id bigint, value.deleted_at timestamp, value.integration_id string, value.user_id bigint
        value.created_at timestamp, value.updated_at timestamp, value.workflow_state string, value.account_id bigint
        value.sis_batch_id double, value.unique_id string, value.login_count bigint
        value.failed_login_count bigint, value.last_request_at timestamp, value.last_login_at timestamp
        value.current_login_at timestamp, value.last_login_ip string, value.current_login_ip string
        value.sis_user_id string, value.authentication_provider_id double, value.position double
        meta.ts timestamp, meta.action string"""),
    "users": _ddl("""
        key.id bigint, value.deleted_at timestamp, value.storage_quota double, value.lti_context_id string
        value.created_at timestamp, value.updated_at timestamp, value.workflow_state string
        value.sortable_name string, value.avatar_image_url string, value.avatar_image_source string
        value.avatar_image_updated_at timestamp, value.short_name string, value.last_logged_out timestamp
        value.pronouns string, value.merged_into_user_id double, value.locale string, value.name string
        value.time_zone string, value.uuid string, value.school_name string, value.school_position string
        value.public string, meta.ts timestamp, meta.action string"""),
    "access_tokens": _ddl("""
        key.id bigint, value.developer_key_id bigint, value.user_id bigint, value.real_user_id double
        value.last_used_at timestamp, value.expires_at timestamp, value.purpose string
        value.created_at timestamp, value.updated_at timestamp, value.scopes string, value.workflow_state string"""),
    "account_users": _ddl("""
        key.id bigint, value.user_id bigint, value.created_at timestamp, value.updated_at timestamp
        value.workflow_state string, value.account_id bigint, value.role_id bigint"""),
    "accounts": _ddl("""
        value.name string, key.id bigint, value.deleted_at timestamp, value.parent_account_id double
        value.current_sis_batch_id double, value.storage_quota double, value.default_storage_quota double
        value.default_locale string, value.default_user_storage_quota double
        value.default_group_storage_quota double, value.integration_id string, value.lti_context_id string
        value.consortium_parent_account_id double, value.course_template_id double, value.created_at timestamp
        value.updated_at timestamp, value.workflow_state string, value.default_time_zone string
        value.uuid string, value.sis_source_id string"""),
    "roles": _ddl("key.id bigint, value.name string"),
    "enrollment_terms": _ddl("key.id bigint, value.name string, value.sis_source_id string, value.term_code string"),
    "calendar_events": _ddl("""
        key.id bigint, value.title string, value.start_at timestamp, value.end_at timestamp
        value.location_name string, value.description string, value.context_code string
        value.workflow_state string"""),
}

# Fixed formats: columns and keys of the target tables.
TARGETS: dict[str, tuple[Sequence[str], str]] = {
    "watermark": (["tabell"], "tabell string, sist_oppdatert timestamp"),
    "user_id_link": (["user_id"], "user_id bigint, sis_user_id string"),
    "timetable": (["id"], "id bigint, title string, start_at timestamp, end_at timestamp, location_name string, "
                          "description string, context_code string, teacher string, timeedit_id string"),
    "study_programme": (["studieprogramkode"],
                        "studieprogramkode string, studieprogramnavn string, fakultetsnummer string, "
                        "instituttnummer string, instituttnavn string, prosentAvHeltid int, studieniva string, "
                        "undervisningsorganisering string, finansieringstype string, vekting double, "
                        "vektingstype string, nuskode string, prosentEgenfinansiering int"),
    "course_catalogue": (["unik_kode"],
                         "emnekode string, versjonskode string, unik_kode string, emnenavn_nob string, "
                         "emnenavn_nno string, emnenavn_eng string, fag string, fakultetsnummer string, "
                         "instituttnummer string, instituttnavn string, emnetype string, vekting double, "
                         "vektingstype string, LUB_NNO string, LUB_NOB string, LUB_ENG string, ARB_NNO string, "
                         "ARB_NOB string, ARB_ENG string"),
    "course_responsible": (["unik_kode"], "unik_kode string, emneansvarlege string"),
    "programme_right": (["plnr"], "plnr string, studieprogram string, campus string, `år` int, termin string"),
    "term": (["term_id"], "term_id bigint, name string, start_at timestamp, end_at timestamp, created_at timestamp"),
    "user": (["user_id"], "user_id bigint, sis_user_id string, created_at timestamp, root_account string, "
                          "last_login timestamp"),
    "course": (["course_id"],
               "course_id bigint, name string, course_code string, sis_course_id string, enrollment_term_id bigint, "
               "account_id bigint, start_at timestamp, conclude_at timestamp, created_at timestamp, "
               "updated_at timestamp, root_account_id bigint, workflow_state string, login_id string, "
               "emnekode string, versjonskode string"),
    "enrollment": (["enrollment_id"],
                   "enrollment_id bigint, user_id bigint, sis_user_id string, course_id bigint, type string, "
                   "created_at timestamp, updated_at timestamp, start_at timestamp, end_at timestamp, "
                   "enrollment_state string, total_activity_time bigint, last_activity_at timestamp"),
    "student_summary": (["id", "course_id"],
                        "page_views int, id bigint, max_page_views int, page_views_level int, participations int, "
                        "max_participations int, participations_level int, course_id bigint, missing int, late int, "
                        "on_time int, floating int, total int"),
    "module_item": (["module_id", "module_item_id"],
                    "items_count int, items_url string, module_id bigint, course_id bigint, type string, "
                    "module_item_id bigint, title string, parent_module_id bigint, external_url string, "
                    "item_published boolean, name string, published boolean"),
    "history": ([], "visited_at timestamp, visited_url string, asset_readable_category string, user_id bigint"),
    "course_programme": (["programEmneKode"],
                         "Emnekode string, Versjonskode string, Studieprogramkode string, Undervises_forste_ar int, "
                         "Undervises_forste_termin string, Undervises_siste_ar int, Undervises_siste_termin string, "
                         "Emnekode2 string, programEmneKode string"),
}

_TERM = "struct<arstall:int,betegnelse:struct<kode:string>>"
_PAGE_INFO = "pageInfo:struct<endCursor:string,hasNextPage:boolean>"
_ERRORS = "errors array<struct<message:string>>"


def _connection(root: str, node: str) -> str:
    """Pages of a cursor listing are landed with ``after``, the cursor they were asked for (none: the first)."""
    return f"after string, data struct<{root}:struct<{_PAGE_INFO},nodes:array<struct<{node}>>>>, {_ERRORS}"


def _course_page(path: str, node: str) -> str:
    return (f"course_id bigint, after string, data struct<course:struct<{path}:struct<{_PAGE_INFO},nodes:array<struct<{node}>>>>>, "
            f"{_ERRORS}")


def _items_page(item: str) -> str:
    """Numbered pages are landed as one object per page, with the listing under ``items`` and, where the
    answer told, whether another page follows."""
    return f"page int, has_next boolean, items array<struct<{item}>>, {_ERRORS}"


# Fixed formats: landed pages, and where their list of records is.
PAGES: dict[str, tuple[str, str]] = {
    "course_links": (_connection("emner", (
        "kode:string,versjonskode:string,"
        f"studieprogramkoblinger:array<struct<periode:struct<fraTermin:{_TERM},tilTermin:{_TERM}>,"
        "studieprogram:struct<kode:string>>>,"
        f"undervisesIPeriode:struct<forsteTermin:{_TERM},sisteTermin:{_TERM}>")), "data.emner.nodes"),
    "course_catalogue": (_connection("emner", (
        "kode:string,versjonskode:string,navnAlleSprak:struct<nn:string,en:string,nb:string>,"
        "organisasjonsenhet:struct<administrativtAnsvarlig:struct<fakultet:struct<fakultetsnummer:string,"
        "navn:struct<nb:string>>,instituttnummer:string,navnAlleSprak:struct<nb:string>>>,"
        "fagkoblinger:struct<viktigsteFag:struct<navnAlleSprak:struct<nob:string>>>,emnetype:string,"
        "vekting:struct<emnevekting:struct<vektingstype:struct<kode:string>,verdi:double>>,"
        "beskrivelser:array<struct<innhold:string,sprak:struct<iso6392Kode:string>,"
        "tekstkategori:struct<kode:string>>>,"
        "personroller:array<struct<personProfil:struct<navn:struct<etternavn:string,fornavn:string>>,"
        "fagperson:struct<feideBruker:string>>>")), "data.emner.nodes"),
    "study_programmes": (_connection("studieprogram", (
        "navnAlleSprak:struct<nb:string>,kode:string,prosentHeltid:string,"
        "organisasjonsenhet:struct<studieansvarlig:struct<fakultet:struct<fakultetsnummer:string>,"
        "instituttnummer:string,navnAlleSprak:struct<nb:string>>>,studieniva:struct<navnAlleSprak:struct<nb:string>>,"
        "undervisningsorganisering:struct<navnAlleSprak:struct<und:string>>,"
        "vekting:struct<vektingstype:struct<kode:string>,verdi:string>,"
        "finansieringstype:struct<navn:struct<und:string>>,prosentEgenfinansiering:string,nusKode:string")),
        "data.studieprogram.nodes"),
    "programme_rights": (_connection("programStudieretter", (
        "personProfil:struct<personlopenummer:string>,studieprogram:struct<kode:string>,"
        "campus:struct<navnAlleSprak:struct<nb:string>>,"
        "kull:struct<termin:struct<arstall:int,betegnelse:struct<navnAlleSprak:struct<nb:string>>>>")),
        "data.programStudieretter.nodes"),
    "study_rights": (_connection("studenter", (
        "studieprogramISemester:array<struct<studieprogram:struct<kode:string,vekting:struct<verdi:double>>,"
        f"termin:{_TERM}>>,personProfil:struct<personlopenummer:string>,studentnummer:string")),
        "data.studenter.nodes"),
    "enrollments": (_course_page("enrollmentsConnection", (
        "_id:string,type:string,state:string,totalActivityTime:double,lastActivityAt:string,"
        "user:struct<_id:string,sisId:string,createdAt:string,updatedAt:string,name:string>")),
        "data.course.enrollmentsConnection.nodes"),
    "summaries_nested": (_course_page("usersConnection", (
        "_id:string,sisId:string,summaryAnalytics:struct<pageViews:struct<total:int,level:int,max:int>,"
        "participations:struct<level:int,max:int,total:int>,"
        "tardinessBreakdown:struct<late:int,missing:int,onTime:int,total:int>>")),
        "data.course.usersConnection.nodes"),
    "summaries": ("course_id bigint, " + _items_page(
        "id:bigint,page_views:int,max_page_views:int,page_views_level:int,participations:int,"
        "max_participations:int,participations_level:int,"
        "tardiness_breakdown:struct<missing:int,late:int,on_time:int,floating:int,total:int>"), "items"),
    "modules": ("course_id bigint, " + _items_page(
        "id:bigint,name:string,published:boolean,items_count:int,items_url:string,"
        "items:array<struct<id:bigint,title:string,type:string,module_id:bigint,published:boolean,"
        "external_url:string>>"), "items"),
    "page_views": ("user_id bigint, " + _items_page(
        "visited_at:timestamp,visited_url:string,asset_readable_category:string"), "items"),
    "terms": (_items_page("id:bigint,name:string,start_at:timestamp,end_at:timestamp,created_at:timestamp"), "items"),
    "users": (_items_page("id:bigint,sis_user_id:string,created_at:timestamp,root_account:string,"
                          "last_login:timestamp"), "items"),
    "courses": (_items_page(
        "id:bigint,name:string,course_code:string,sis_course_id:string,enrollment_term_id:bigint,"
        "account_id:bigint,start_at:timestamp,end_at:timestamp,created_at:timestamp,updated_at:timestamp,"
        "root_account_id:bigint,workflow_state:string,login_id:string"), "items"),
}
