"""The table jobs on made-up landed files."""

import datetime as dt
import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from sluice import session
from sluice.operators import lookup
from sluice.plans.jobs import IncompletePages, Jobs
from sluice.plans.queries import QUERIES
from sluice.schemas import CHANGE_FILES
from sluice.sources import get_watermark, id_ranges, snapshot_path
from sluice.sources.change_files import schema_of

AS_OF = dt.datetime(2024, 10, 2, 6)


@pytest.fixture
def jobs(spark, folder):
    return Jobs(spark, folder + "/tables", AS_OF, buckets=2, failed_pages="skip")


def change_file(folder, kind, rows, name="part.csv.gz"):
    """Rows as dicts of plain names; every other column stays empty."""
    names = schema_of(CHANGE_FILES[kind]).names
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wt", encoding="utf-8") as f:
        f.write(",".join(names) + "\n")
        for r in rows:
            cells = [r.get(n.split(".", 1)[1]) for n in names]
            f.write(",".join("" if c is None else '"' + str(c).replace('"', '""') + '"' for c in cells) + "\n")
    return folder


def land(folder, *pages):
    os.makedirs(folder, exist_ok=True)
    for i, page in enumerate(pages):
        path = os.path.join(folder, f"page{i}.json")
        with open(path, "w", encoding="utf-8") as f:
            json.dump(page, f, ensure_ascii=False, indent=1)
        os.utime(path, (1000 + i, 1000 + i))
    return folder


def connection(root, nodes, more=False):
    return {"data": {root: {"pageInfo": {"endCursor": "c", "hasNextPage": more}, "nodes": nodes}}}


def rows_of(table, *columns):
    df = table.read()
    if columns:
        df = df.select(*[F.col(c).cast("string") if c.endswith(("_at", "_login")) else F.col(c) for c in columns])
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_user_id_link(jobs, folder):
    def p(user, sis, created, ts="2024-10-02T00:00:00Z", state="active"):
        return {"id": user or 0, "user_id": user, "sis_user_id": sis, "created_at": created, "ts": ts,
                "workflow_state": state, "action": "U"}

    path = change_file(folder + "/in", "pseudonyms", [
        p(1, "s1", "2024-10-01T08:00:00Z"), p(2, None, "2024-10-01T08:00:00Z"), p(3, "s3", "2024-09-30T23:59:59Z"),
        p(4, "old", "2024-10-01T08:00:00Z", "2024-10-02T01:00:00Z"), p(4, "new", "2024-10-01T08:00:00Z", "2024-10-02T02:00:00Z"),
        p(5, "s5", "2024-10-01T00:00:00.123Z", state="deleted"), p(6, "s6", "2024-10-01T00:00:00Z")])
    until = dt.datetime(2024, 10, 2, 5)
    table = jobs.user_id_link(path, until)  # the watermark defaults to the day before
    assert rows_of(table) == [(1, "s1"), (4, "new"), (5, "s5")]
    assert get_watermark(jobs.control, "pseudonyms", AS_OF) == until
    again = change_file(folder + "/in2", "pseudonyms", [p(1, "s1b", "2024-10-02T04:00:00Z"), p(7, "s7", "2024-10-02T06:00:00Z")])
    assert rows_of(jobs.user_id_link(again, until)) == [(1, "s1"), (4, "new"), (5, "s5"), (7, "s7")]


def test_new_users(spark, jobs, folder):
    def u(user, name, created="2024-10-01T08:00:00Z"):
        return {"id": user, "name": name, "created_at": created, "ts": created, "action": "U"}

    path = change_file(folder + "/in", "users", [
        u(1, "Teacher One"), u(2, "A STUDENT"), u(3, "No Id"), u(4, "Old", "2024-09-30T08:00:00Z"),
        u(5, "On The Line", "2024-10-01T00:00:00Z")])
    links = spark.createDataFrame([(1, "s1"), (2, "s2"), (5, "s5")], "user_id bigint, sis_user_id string")
    table = jobs.new_users(path, links, AS_OF, folder + "/snap")
    assert rows_of(table) == [(1, "s1"), (3, None), (5, "s5")]
    copy = spark.read.option("header", True).csv(snapshot_path(folder + "/snap/users", AS_OF))
    assert copy.columns == schema_of(CHANGE_FILES["users"]).names and copy.count() == 3


def test_changed_enrollments(spark, jobs, folder):
    def e(i, updated, **more):
        return {"id": i, "user_id": 10 + i, "course_id": 1, "type": "StudentEnrollment", "updated_at": updated,
                "created_at": updated, "workflow_state": "active", **more}

    path = change_file(folder + "/in", "enrollments", [
        e(1, "2024-10-01T08:00:00Z", total_activity_time="5236.0"), e(1, "2024-09-01T08:00:00Z", total_activity_time="1.0"),
        e(2, "2024-09-01T08:00:00Z")])
    table = jobs.changed_enrollments(path, AS_OF, folder + "/snap")
    assert rows_of(table, "enrollment_id", "user_id", "sis_user_id", "updated_at", "start_at", "total_activity_time") == [
        (1, 11, None, "2024-10-01 08:00:00", None, 5236), (2, 12, None, "2024-09-01 08:00:00", None, 0)]
    assert spark.read.option("header", True).csv(snapshot_path(folder + "/snap/enrollments", AS_OF)).count() == 1


def test_timetable(jobs, folder):
    def ev(i, state="active", start="2024-01-01T08:00:00Z", **more):
        return {"id": i, "title": f"t{i}", "start_at": start, "workflow_state": state, **more}

    first = change_file(folder + "/in", "calendar_events", [
        ev(1, description="A. Teacher<br>ID: 12345<br>", location_name='R101 <a href="x">'),
        ev(2, description="no marker", location_name="plain"), ev(3), ev(4, "deleted"), ev(5, start="2022-12-31T23:00:00Z")],
        "a.csv.gz")
    change_file(first, "calendar_events", [ev(6, description="line\nbreak<br>")], "b.csv.gz")
    table = jobs.timetable(first)
    assert rows_of(table, "id", "location_name", "teacher", "timeedit_id") == [
        (1, "R101", "A. Teacher", "12345"), (2, "plain", "no marker", None), (3, None, None, None),
        (6, None, "line\nbreak", None)]


@pytest.mark.parametrize("kind", ["access_tokens", "account_users", "accounts", "roles", "enrollment_terms"])
def test_snapshots(spark, jobs, folder, kind):
    path = change_file(folder + "/in", kind, [{"id": 1, "name": "n"}, {"id": 2}])
    written = jobs.snapshot(kind, path, AS_OF, folder + "/snap")
    assert written == snapshot_path(f"{folder}/snap/{kind}", AS_OF)
    found = spark.read.option("header", True).csv(written)
    assert found.columns == schema_of(CHANGE_FILES[kind]).names and found.count() == 2
    assert get_watermark(jobs.control, kind, AS_OF + dt.timedelta(days=9)) == AS_OF


def course(i, term, sis=None, **more):
    return {"id": i, "name": f"c{i}", "course_code": "x", "sis_course_id": sis, "enrollment_term_id": term,
            "account_id": 1, "start_at": None, "end_at": "2024-12-31T00:00:00Z", "created_at": "2024-01-01T00:00:00Z",
            "root_account_id": 1, "workflow_state": "available", **more}


@pytest.fixture
def running(jobs, folder):
    """Terms and courses; courses 1 and 2 run in autumn 2024."""
    names = {1: "Standardsemester", 2: "2024 HØST", 3: "2024 VÅR", 4: "2023 HØST-2025 VÅR", 5: "2024HØST"}
    items = [{"id": i, "name": n, "created_at": "2023-05-01T06:14:37Z"} for i, n in names.items()]
    jobs.terms(land(folder + "/terms", {"page": 1, "items": items[:3]}, {"page": 2, "items": items[3:]},
                    {"page": 3, "items": []}))
    jobs.courses(land(folder + "/courses", {"page": 1, "items": [
        course(1, 2, "UE_203_ABC100_1_2024_HØST"), course(2, 4), course(3, 3), course(4, 1), course(5, 5), course(6, None)]}))
    return jobs


def test_terms_and_courses(running):
    assert [r[0] for r in rows_of(running.table("term"))] == [1, 2, 3, 4, 5]
    found = rows_of(running.table("course"), "course_id", "emnekode", "versjonskode", "conclude_at", "login_id")
    assert found[:2] == [(1, "ABC100", "1", "2024-12-31 00:00:00", None), (2, " ", " ", "2024-12-31 00:00:00", None)]
    assert sorted(r["course_id"] for r in running._running().collect()) == [1, 2]


def test_users_last_page_wins(jobs, folder):
    def u(i, login):
        return {"id": i, "sis_user_id": f"s{i}", "created_at": "2024-01-01T00:00:00Z", "last_login": login}

    table = jobs.users(land(folder + "/u", {"page": 1, "items": [u(1, "2024-10-01T00:00:00Z"), u(2, None), u(None, None)]},
                            {"page": 2, "items": [u(1, "2024-09-01T00:00:00Z")]}, {"errors": [{"message": "no"}]}))
    assert rows_of(table, "user_id", "last_login", "root_account") == [(1, "2024-09-01 00:00:00", None), (2, None, None)]


def enrollment(i, user, active=None, **more):
    return {"_id": str(i), "type": "StudentEnrollment", "state": "active", "totalActivityTime": 12.0, "lastActivityAt": active,
            "user": user and {"_id": str(user), "sisId": f"s{user}", "createdAt": "2024-01-01T00:00:00Z",
                              "updatedAt": "bad", "name": "N"}, **more}


def course_page(course_id, *nodes):
    return {"course_id": course_id, "data": {"course": {"enrollmentsConnection": {"nodes": list(nodes)}}}}


def test_enrollments_of_running_courses(running, spark, folder):
    # an older row with start_at, which this source does not bring
    running.changed_enrollments(change_file(folder + "/cf", "enrollments", [
        {"id": 100, "user_id": 1, "course_id": 1, "start_at": "2024-08-01T00:00:00Z", "updated_at": "2024-08-01T00:00:00Z"}]),
        AS_OF)
    path = land(folder + "/e", course_page(1, enrollment(100, 7, "2024-10-01T09:00:00Z"), None, enrollment(101, 8)),
                course_page(3, enrollment(300, 9)), {"course_id": 2, "errors": [{"message": "no"}]})
    table = running.enrollments(path)
    assert rows_of(table, "enrollment_id", "user_id", "course_id", "start_at", "created_at", "updated_at", "last_activity_at") == [
        (100, 7, 1, "2024-08-01 00:00:00", "2024-01-01 00:00:00", None, "2024-10-01 09:00:00"),
        (101, 8, 1, None, "2024-01-01 00:00:00", None, None)]
    assert sorted(map(tuple, running.enrollment_counts(path).collect())) == [(1, 2), (2, 0)]


def test_student_summaries(running, folder):
    def s(i, views, floating=4):
        return {"id": i, "page_views": views, "max_page_views": 9, "page_views_level": 1, "participations": 2,
                "max_participations": 3, "participations_level": 1,
                "tardiness_breakdown": {"missing": 1, "late": 2, "on_time": 3, "floating": floating, "total": 10}}

    table = running.student_summaries(land(
        folder + "/s", {"course_id": 1, "page": 1, "items": [s(1, 5), s(2, 6)]}, {"course_id": 1, "page": 2, "items": [s(1, 7)]},
        {"course_id": 2, "page": 1, "items": [s(1, 8)]}, {"course_id": 3, "page": 1, "items": [s(1, 9)]},
        {"course_id": 2, "page": 2, "errors": [{"message": "x"}]}))
    assert rows_of(table, "id", "course_id", "page_views", "floating") == [(1, 1, 7, 4), (1, 2, 8, 4), (2, 1, 6, 4)]

    def nested(i, views):
        analytics = None if views is None else {
            "pageViews": {"total": views, "level": 1, "max": 2}, "participations": {"level": 1, "max": 2, "total": 3},
            "tardinessBreakdown": {"late": 1, "missing": 2, "onTime": 3, "total": 6}}
        return {"_id": str(i), "sisId": "s", "summaryAnalytics": analytics}

    table = running.student_summaries(land(folder + "/n", {"course_id": 1, "data": {"course": {"usersConnection": {
        "nodes": [nested(1, 70), nested(2, None), nested(3, 30)]}}}}), nested=True)
    assert rows_of(table, "id", "course_id", "page_views", "floating", "on_time") == [
        (1, 1, 70, 4, 3), (1, 2, 8, 4, 3), (2, 1, 6, 4, 3), (3, 1, 30, None, 3)]


def test_module_items(running, folder):
    def m(i, *items, **more):
        return {"id": i, "name": f"m{i}", "published": True, "items_count": len(items), "items_url": "u", "items": list(items),
                **more}

    def it(i, title, **more):
        return {"id": i, "title": title, "type": "Page", "module_id": 1, "published": False, **more}

    table = running.module_items(land(folder + "/m", {"course_id": 1, "page": 1, "items": [
        m(1, it(11, "a"), it(12, "b", external_url="http://x.example"), it(11, "c")), m(2)]},
        {"course_id": 4, "page": 1, "items": [m(3, it(31, "z"))]}))
    assert rows_of(table, "module_id", "module_item_id", "title", "external_url", "item_published", "published") == [
        (1, 11, "c", None, False, True), (1, 12, "b", "http://x.example", False, True)]


def test_history(running, folder):
    running.users(land(folder + "/u", {"page": 1, "items": [
        {"id": 1, "last_login": "2024-10-01T00:00:00Z"}, {"id": 2, "last_login": "2024-01-01T00:00:00Z"},
        {"id": 3, "last_login": None}]}))
    running.enrollments(land(folder + "/e", course_page(1, enrollment(1, 1), enrollment(2, 2), enrollment(
        3, 3, "2024-10-01T12:00:00Z"))))

    def views(user, *urls):
        return {"user_id": user, "page": 1, "items": [{"visited_url": u, "visited_at": "2024-10-01T01:00:00Z"} for u in urls]}

    path = land(folder + "/h", views(1, "a", "b"), views(2, "c"), views(3, "d"))
    running.history(path)
    table = running.history(path)  # a second run replaces the first
    assert rows_of(table, "user_id", "visited_url", "asset_readable_category") == [
        (1, "a", None), (1, "b", None), (3, "d", None)]


def term(year, code="VÅR"):
    return {"arstall": year, "betegnelse": {"kode": code}}


def test_course_programmes(jobs, folder):
    def link(programme, first=None, last=None):
        return {"studieprogram": {"kode": programme}, "periode": {"fraTermin": first, "tilTermin": last}}

    def c(code, links, first=None, last=None, version="1"):
        return {"kode": code, "versjonskode": version, "studieprogramkoblinger": links,
                "undervisesIPeriode": {"forsteTermin": first, "sisteTermin": last}}

    page1 = connection("emner", [
        c("A", [link("P1", term(2020), term(2022, "HØST")), link("P2"), None], term(2018), term(2024)),
        c("B", [], term(2018)), c("C", [link("P1")], term(2010), term(2016))], True)
    page2 = connection("emner", [c("D", [None], term(2019)), c("E", [link("P3", term(2021))]),
                                 c("A", [link("P1", term(2021))], term(2018))])
    table = jobs.course_programmes(land(folder + "/l", page1, page2))
    assert rows_of(table, "programEmneKode", "Emnekode2", "Studieprogramkode", "Undervises_forste_ar",
                   "Undervises_siste_ar", "Undervises_siste_termin") == sorted([
        ("P1_A_1", "A_1", "P1", 2021, None, ""), ("P2_A_1", "A_1", "P2", 2018, 2024, "VÅR"),
        ("P3_E_1", "E_1", "P3", 2021, None, ""), ("", "D_1", "", 2019, None, "")], key=repr)
    jobs.course_programmes(folder + "/l")
    assert table.read().count() == 4


def catalogue(code, version="1", **more):
    names = {"nb": "nb", "nn": "nn", "en": "en"}
    return {"kode": code, "versjonskode": version, "navnAlleSprak": names,
            "organisasjonsenhet": {"administrativtAnsvarlig": {
                "fakultet": {"fakultetsnummer": "1", "navn": {"nb": "f"}}, "instituttnummer": "2", "navnAlleSprak": {"nb": "i"}}},
            "fagkoblinger": {"viktigsteFag": {"navnAlleSprak": {"nob": "fag"}}}, "emnetype": "E",
            "vekting": {"emnevekting": {"vektingstype": {"kode": "SP"}, "verdi": 7.5}}, "beskrivelser": [], "personroller": [],
            **more}


def test_course_catalogue(jobs, folder):
    def text(kind, language, content):
        return {"innhold": content, "sprak": {"iso6392Kode": language}, "tekstkategori": {"kode": kind}}

    def person(first, last, user):
        return {"personProfil": {"navn": {"etternavn": last, "fornavn": first}}, "fagperson": user and {"feideBruker": user}}

    page = connection("emner", [
        catalogue("A", beskrivelser=[text("EBLUB", "NNO", "old"), text("EBLUB", "NNO", "new"), text("EBARB", "ENG", "work")],
                  personroller=[person("Åse", "Ø", "u1"), person("Bo", "B", "u2")]),
        catalogue("B", personroller=[person("Åse", "Ø", "u1"), person("Bo", "B", None)]), catalogue("C", beskrivelser=None),
        catalogue("D", fagkoblinger={"viktigsteFag": None}), catalogue("E", version=None)])
    courses, people = jobs.course_catalogue(land(folder + "/c", page))
    no = "Ikkje registrert"
    assert rows_of(courses, "unik_kode", "vekting", "fag", "LUB_NNO", "ARB_ENG", "ARB_NOB") == [
        ("A_1", 7.5, "fag", "new", "work", no), ("B_1", 7.5, "fag", no, no, no), ("C_1", 7.5, "fag", no, no, no)]
    assert rows_of(people) == [("A_1", '[["Åse", "Ø", "u1"], ["Bo", "B", "u2"]]'), ("B_1", f'"{no}"'), ("C_1", "[]")]


def test_study_programmes(jobs, folder):
    node = {"kode": "P1", "navnAlleSprak": {"nb": "n"}, "prosentHeltid": 100, "prosentEgenfinansiering": 0,
            "organisasjonsenhet": {"studieansvarlig": {"fakultet": {"fakultetsnummer": "1"}, "instituttnummer": "2",
                                                       "navnAlleSprak": {"nb": "i"}}},
            "studieniva": None, "undervisningsorganisering": {"navnAlleSprak": {"und": "o"}},
            "vekting": {"verdi": 180, "vektingstype": {"kode": "SP"}}, "finansieringstype": {"navn": {"und": "x"}}, "nusKode": "7"}
    page = connection("studieprogram", [node, {**node, "kode": "P2", "vekting": None, "nusKode": None}])
    assert rows_of(jobs.study_programmes(land(folder + "/p", page)), "studieprogramkode", "prosentAvHeltid", "studieniva", "vekting",
                   "vektingstype", "nuskode") == [("P1", 100, "", 180.0, "SP", "7"), ("P2", 100, "", None, "", "")]


def test_programme_rights(jobs, folder):
    def r(plnr, programme, year=2020):
        return {"personProfil": plnr and {"personlopenummer": plnr}, "studieprogram": {"kode": programme},
                "campus": None, "kull": {"termin": {"arstall": year, "betegnelse": {"navnAlleSprak": {"nb": "vår"}}}}}

    path = land(folder + "/r", connection("programStudieretter", [r(1, "A"), r(None, "X"), r(2, "B")], True),
                connection("programStudieretter", [r(1, "C", None), r(None, "Y")]))
    assert rows_of(jobs.programme_rights(path)) == [
        ("", "Y", "", 2020, "vår"), ("1", "C", "", None, "vår"), ("2", "B", "", 2020, "vår")]


def test_study_rights(spark, jobs, folder):
    def s(plnr, *programmes):
        return {"personProfil": {"personlopenummer": plnr}, "studentnummer": "1", "studieprogramISemester": [
            {"studieprogram": {"kode": c, "vekting": {"verdi": w}}, "termin": term(y, "HØST")} for c, w, y in programmes]}

    path = land(folder + "/s", connection("studenter", [s("1", ("A", 60.0, 2024), ("B", 5.0, 2023)), s("2")]))
    written = jobs.study_rights(path, folder + "/snap")
    rows = spark.read.option("header", True).option("escape", '"').csv(written).collect()
    assert [(r["plnr"], json.loads(r["programmes"])) for r in rows] == [("1", [
        {"code": "A", "weight": 60.0, "semester": "2024_HØST"}, {"code": "B", "weight": 5.0, "semester": "2023_HØST"}])]


def test_json_lines(spark, folder):
    jobs = Jobs(spark, folder + "/tables", AS_OF, buckets=2, lines=True)
    os.makedirs(folder + "/t")
    with open(folder + "/t/pages.jsonl", "w", encoding="utf-8") as f:
        for i in range(3):
            f.write(json.dumps({"page": i, "items": [{"id": 1, "name": f"n{i}"}]}) + "\n")
    assert rows_of(jobs.terms(folder + "/t"), "term_id", "name") == [(1, "n2")]


def test_mixed_headers(spark, folder):
    jobs = Jobs(spark, folder + "/tables", AS_OF, buckets=2, mixed_headers=True)
    path = change_file(folder + "/in", "enrollments", [{"id": 1, "user_id": 2, "updated_at": "2024-10-01T08:00:00Z"}])
    with gzip.open(path + "/other.csv.gz", "wt", encoding="utf-8") as f:
        f.write("value.user_id,key.id,value.unknown\n9,3,x\n")
    assert rows_of(jobs.changed_enrollments(path, AS_OF), "enrollment_id", "user_id", "course_id") == [
        (1, 2, None), (3, 9, None)]


def test_unreadable_rows_are_put_aside(spark, jobs, folder):
    def ev(i, start="2024-01-01T08:00:00Z"):
        return {"id": i, "title": f"t{i}", "start_at": start, "workflow_state": "active"}

    path = change_file(folder + "/in", "calendar_events", [ev(1), ev("2.0"), ev("x"), ev(4, "no time")])
    assert rows_of(jobs.timetable(path), "id") == [(1,)]
    bad = jobs.quarantine("calendar_events").collect()
    assert sorted((r["raw"]["key.id"], r["bad_columns"]) for r in bad) == [
        ("2.0", ["key.id"]), ("4", ["value.start_at"]), ("x", ["key.id"])]
    assert all("/in/" in r["arrival"]["file"] for r in bad)


def test_failed_pages_stop_a_job_unless_skipped(spark, folder):
    path = land(folder + "/t", {"page": 1, "items": [{"id": 1, "name": "a"}]}, {"errors": [{"message": "no"}]})
    with open(f"{path}/cut.json", "w") as file:
        file.write('{"page": 3, "items": [{"id": 2, "na')
    strict = Jobs(spark, folder + "/tables", AS_OF, buckets=2)
    with pytest.raises(IncompletePages, match="unreadable"):
        strict.terms(path)
    lax = Jobs(spark, folder + "/tables", AS_OF, buckets=2, failed_pages="skip")
    assert rows_of(lax.terms(path), "term_id") == [(1,)]
    assert sorted(r["reason"] for r in lax.quarantine("terms").collect()) == ["no list", "unreadable"]
    with pytest.raises(ValueError):
        Jobs(spark, folder, AS_OF, failed_pages="ignore")


def test_two_slices_of_a_date_stand_side_by_side(spark, jobs, folder):
    for hour, i in ((5, 1), (17, 2)):
        path = change_file(f"{folder}/in{hour}", "roles", [{"id": i, "name": "n"}])
        jobs.snapshot("roles", path, dt.datetime(2024, 10, 2, hour), folder + "/snap")
    found = [spark.read.option("header", True).csv(snapshot_path(f"{folder}/snap/roles", dt.datetime(2024, 10, 2, h)))
             for h in (5, 17)]
    assert [[r["key.id"] for r in f.collect()] for f in found] == [["1"], ["2"]]


def test_jobs_want_utc_and_record_metrics(spark, jobs, folder):
    jobs.terms(land(folder + "/t", {"page": 1, "items": [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}]}))
    lines = spark.read.option("header", True).csv(folder + "/tables/metrics").collect()
    assert [(r["stage"], r["rows"]) for r in lines] == [("term", "2")]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            Jobs(spark, folder, AS_OF)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_target_has_its_own_layout(spark, folder):
    """With ranges of ids, a batch of young ids leaves the old folders untouched."""
    jobs = Jobs(spark, folder + "/tables", AS_OF, layouts={"term": id_ranges(100)})
    jobs.terms(land(folder + "/a", {"page": 1, "items": [{"id": i, "name": "old"} for i in range(1, 400, 30)]}))
    jobs.terms(land(folder + "/b", {"page": 1, "items": [{"id": 391, "name": "new"}, {"id": 395, "name": "new"}]}))
    assert jobs.table("term")._state().held == {0: 1, 1: 1, 2: 1, 3: 2}
    assert jobs.table("term").read().count() == 15


def test_lookup_takes_one_id_per_key(spark):
    ids = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (None, "x")], "user_id bigint, sis_user_id string")
    rows = spark.createDataFrame([(1,), (2,), (None,)], "user_id bigint")
    assert sorted(map(tuple, lookup(rows, ids, "user_id").collect()), key=repr) == [(1, "b"), (2, None), (None, None)]


def test_catalogue_writes_little_more_than_its_texts(spark, folder, monkeypatch):
    """Landed pages, their parsed copy and both tables: less than twice the texts, which are in each page twice."""
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(3, 9))) for _ in range(3000)]
    texts = ["\n".join(" ".join(rnd.choices(words, k=12)) for _ in range(30)) for _ in range(2100)]
    spark.createDataFrame([(i, t, "nn", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_chars long") \
        .coalesce(1).write.parquet(f"{folder}/sf/documents.parquet")
    monkeypatch.setattr(session, "shared_dir", lambda spark: f"{folder}/shared")
    found = QUERIES["job_course_catalogue"](spark, f"{folder}/sf").collect()
    assert {r.unik_kode: json.loads(r.emneansvarlege) for r in found} == {
        f"D{i}_1": [[line, "nn", None] for line in t.split("\n")] for i, t in enumerate(texts)}
    files = [os.path.join(d, f) for d, _, names in os.walk(f"{folder}/shared") for f in names if not f.startswith((".", "_"))]
    assert sum(map(os.path.getsize, files)) < 2 * sum(map(len, texts))
    # no file is more than a task's work
    assert len([f for f in files if "/landed/" in f]) == 2
