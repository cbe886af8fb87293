"""Table jobs: what a user calls to bring one target table up to date.

Every job is one lazy plan from landed files to an upsert, and saves its watermark only after the
data is in place. Input is whatever has landed: change files or JSON pages.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nested import descriptions, get_or, people_json, programme_list
from ..functions.text import code_part, joined_key, room_name, teacher, timeedit_id
from ..functions.times import whole_number
from ..operators.filters import (
    accepted,
    active_terms,
    checked,
    exclude_text,
    fill_text,
    plain,
    quarantined,
    quoted,
    recent_active_events,
    since,
)
from ..operators.joins import in_active_terms, lookup, of_courses, recent_users, rows_per_course
from ..operators.nested import (
    course_enrollments,
    course_programmes,
    module_items,
    semester_of,
    summaries_flat,
    summaries_nested,
)
from ..schemas import CHANGE_FILES, INSTITUTION, PAGES, TARGETS
from ..session import settled
from ..sources.change_files import ARRIVAL, CORRUPT, read_texts, schema_of
from ..sources.control import RunMetrics, advance_watermark, control_table, get_watermark
from ..sources.pages import failed_pages, page_faults, page_nodes, read_pages
from ..sources.snapshots import RECORD, proved_snapshot, write_snapshot
from ..sources.tables import CODEC, Layout, Table

Paths = str | Sequence[str]
PLACE = [ARRIVAL, "place"]


# -- rows of the targets, as plans over landed records --------------------------------------------


def link_rows(pseudonyms: DataFrame, after: dt.datetime) -> DataFrame:
    """(user_id, sis_user_id) of pseudonyms created after the watermark that have a registry id."""
    new = since(pseudonyms, "value.created_at", after).na.drop(subset=["`value.sis_user_id`"])
    return new.select(
        quoted("value.user_id").alias("user_id"), quoted("value.sis_user_id").alias("sis_user_id"),
        quoted("meta.ts").alias("ts"), ARRIVAL,
    )


def new_user_rows(users: DataFrame, links: DataFrame, after: dt.datetime, exclude: str = "student") -> DataFrame:
    """Users created since the watermark (inclusive) whose record does not mention ``exclude``."""
    ids = new_users_slice(users, after, exclude).select(quoted("key.id").alias("user_id"), quoted("meta.ts").alias("ts"), ARRIVAL)
    return lookup(ids, links, "user_id")


def new_users_slice(users: DataFrame, after: dt.datetime, exclude: str = "student") -> DataFrame:
    """The whole records of such users."""
    new = since(users, "value.created_at", after, inclusive=True)
    return exclude_text(new, exclude, [c for c in users.columns if c != ARRIVAL])


def changed_enrollment_rows(changes: DataFrame) -> DataFrame:
    """Enrollments from change files; the registry id is not known there."""
    rows = plain(changes, {
        "key.id": "enrollment_id", "value.user_id": "user_id", "value.course_id": "course_id", "value.type": "type",
        "value.created_at": "created_at", "value.updated_at": "updated_at", "value.start_at": "start_at",
        "value.end_at": "end_at", "value.workflow_state": "enrollment_state",
        "value.total_activity_time": "total_activity_time", "value.last_activity_at": "last_activity_at",
        ARRIVAL: ARRIVAL,
    })
    return rows.withColumn("total_activity_time", whole_number(F.col("total_activity_time"))).withColumn(
        "sis_user_id", F.lit(None).cast("string"))


def running_courses(courses: DataFrame, terms: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Courses of the terms that run at ``as_of``."""
    return in_active_terms(courses, active_terms(terms, as_of))


def timetable_rows(events: DataFrame, after: dt.datetime) -> DataFrame:
    rows = plain(recent_active_events(events, after, "value.start_at", "value.workflow_state"), [
        "key.id", "value.title", "value.start_at", "value.end_at", "value.location_name", "value.description",
        "value.context_code", ARRIVAL,
    ])
    return rows.select(
        "id", "title", "start_at", "end_at", room_name(F.col("location_name")).alias("location_name"), "description",
        "context_code", teacher(F.col("description")).alias("teacher"),
        timeedit_id(F.col("description")).alias("timeedit_id"), ARRIVAL,
    )


def study_programme_rows(nodes: DataFrame) -> DataFrame:
    n = F.col("node")
    unit = n["organisasjonsenhet"]["studieansvarlig"]

    def whole(c: Column) -> Column:
        return c.try_cast("double").try_cast("int")

    return nodes.select(
        n["kode"].alias("studieprogramkode"),
        n["navnAlleSprak"]["nb"].alias("studieprogramnavn"),
        unit["fakultet"]["fakultetsnummer"].alias("fakultetsnummer"),
        unit["instituttnummer"].alias("instituttnummer"),
        unit["navnAlleSprak"]["nb"].alias("instituttnavn"),
        whole(n["prosentHeltid"]).alias("prosentAvHeltid"),
        get_or(n["studieniva"]["navnAlleSprak"]["nb"]).alias("studieniva"),
        n["undervisningsorganisering"]["navnAlleSprak"]["und"].alias("undervisningsorganisering"),
        get_or(n["finansieringstype"]["navn"]["und"]).alias("finansieringstype"),
        n["vekting"]["verdi"].try_cast("double").alias("vekting"),
        get_or(n["vekting"]["vektingstype"]["kode"]).alias("vektingstype"),
        get_or(n["nusKode"]).alias("nuskode"),
        whole(n["prosentEgenfinansiering"]).alias("prosentEgenfinansiering"),
        *PLACE,
    )


def complete_courses(nodes: DataFrame) -> DataFrame:
    """Catalogue records that have every part a row is made of; the others are not loaded."""
    n = F.col("node")
    unit = n["organisasjonsenhet"]["administrativtAnsvarlig"]
    parts = [
        n["kode"], n["versjonskode"], n["navnAlleSprak"], n["fagkoblinger"]["viktigsteFag"]["navnAlleSprak"],
        unit["fakultet"], unit["navnAlleSprak"], n["vekting"]["emnevekting"]["vektingstype"],
    ]
    keep = F.lit(True)
    for part in parts:
        keep = keep & part.isNotNull()
    return nodes.filter(keep)


def catalogue_rows(nodes: DataFrame) -> DataFrame:
    n = F.col("node")
    unit = n["organisasjonsenhet"]["administrativtAnsvarlig"]
    weight = n["vekting"]["emnevekting"]
    texts = descriptions(
        n["beskrivelser"], lambda e: e["tekstkategori"]["kode"], lambda e: e["sprak"]["iso6392Kode"],
        lambda e: e["innhold"],
    )
    return complete_courses(nodes).select(
        n["kode"].alias("emnekode"),
        n["versjonskode"].alias("versjonskode"),
        joined_key(n["kode"], n["versjonskode"]).alias("unik_kode"),
        n["navnAlleSprak"]["nb"].alias("emnenavn_nob"),
        n["navnAlleSprak"]["nn"].alias("emnenavn_nno"),
        n["navnAlleSprak"]["en"].alias("emnenavn_eng"),
        n["fagkoblinger"]["viktigsteFag"]["navnAlleSprak"]["nob"].alias("fag"),
        unit["fakultet"]["fakultetsnummer"].alias("fakultetsnummer"),
        unit["instituttnummer"].alias("instituttnummer"),
        unit["navnAlleSprak"]["nb"].alias("instituttnavn"),
        n["emnetype"].alias("emnetype"),
        weight["verdi"].alias("vekting"),
        weight["vektingstype"]["kode"].alias("vektingstype"),
        *[text.alias(key) for key, text in texts.items()],
        *PLACE,
    )


def responsible_rows(nodes: DataFrame) -> DataFrame:
    n = F.col("node")

    def names(p: Column) -> list[Column]:
        name = p["personProfil"]["navn"]
        return [name["fornavn"], name["etternavn"], p["fagperson"]["feideBruker"]]

    def whole(p: Column) -> Column:
        return p["personProfil"]["navn"].isNotNull() & p["fagperson"].isNotNull()

    return complete_courses(nodes).select(
        joined_key(n["kode"], n["versjonskode"]).alias("unik_kode"),
        people_json(n["personroller"], names, whole).alias("emneansvarlege"),
        *PLACE,
    )


def programme_right_rows(nodes: DataFrame) -> DataFrame:
    n = F.col("node")
    term = n["kull"]["termin"]
    return nodes.select(
        get_or(n["personProfil"]["personlopenummer"]).alias("plnr"),
        get_or(n["studieprogram"]["kode"]).alias("studieprogram"),
        get_or(n["campus"]["navnAlleSprak"]["nb"]).alias("campus"),
        term["arstall"].alias("år"),
        get_or(term["betegnelse"]["navnAlleSprak"]["nb"]).alias("termin"),
        *PLACE,
    )


def study_right_rows(nodes: DataFrame) -> DataFrame:
    """Students with at least one study programme, and their (code, weight, semester) records."""
    listed = programme_list(
        F.col("node.studieprogramISemester"), lambda e: e["studieprogram"]["kode"],
        lambda e: e["studieprogram"]["vekting"]["verdi"], lambda e: semester_of(e["termin"]),
    )
    rows = nodes.select(F.col("node.personProfil.personlopenummer").alias("plnr"), listed.alias("programmes"))
    return rows.filter(F.size("programmes") > 0)


def term_rows(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.col("node.id").alias("term_id"), *[
        F.col(f"node.{c}").alias(c) for c in ("name", "start_at", "end_at", "created_at")], *PLACE)


def user_rows(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.col("node.id").alias("user_id"), *[
        F.col(f"node.{c}").alias(c) for c in ("sis_user_id", "created_at", "root_account", "last_login")], *PLACE)


def course_rows(nodes: DataFrame) -> DataFrame:
    """Courses with the course code and version cut out of the registry id."""
    same = ("name", "course_code", "sis_course_id", "enrollment_term_id", "account_id", "start_at")
    after = ("created_at", "updated_at", "root_account_id", "workflow_state", "login_id")
    sis_id = F.col("node.sis_course_id")
    return nodes.select(
        F.col("node.id").alias("course_id"), *[F.col(f"node.{c}").alias(c) for c in same],
        F.col("node.end_at").alias("conclude_at"), *[F.col(f"node.{c}").alias(c) for c in after],
        code_part(sis_id, 2, INSTITUTION).alias("emnekode"), code_part(sis_id, 3, INSTITUTION).alias("versjonskode"), *PLACE,
    )


def page_view_rows(nodes: DataFrame) -> DataFrame:
    return nodes.select(*[
        F.col(f"node.{c}").alias(c) for c in ("visited_at", "visited_url", "asset_readable_category")], "user_id")


# -- jobs -----------------------------------------------------------------------------------------


class IncompletePages(RuntimeError):
    """A set of landed pages that is not whole."""


class Jobs:
    """The table jobs over one folder of target tables, at one reference date.

    ``lines`` tells that pages were landed as JSON lines, one page per line. Change files of a set
    are read by their column names; with ``mixed_headers=False`` they must all have the same header,
    which spares a pass over their first lines. ``layouts`` gives the layout of targets, by name; the
    others have ``buckets`` hash buckets. The session's time zone must be UTC.

    No landed row is lost. Change rows with a value that cannot be read go to
    ``<base>/quarantine/<kind>``, with the texts, the file and the columns at fault, and the others
    are loaded. A page set fails the job if a page is cut off or holds no list, if a page is missing
    (a number, or a cursor that was given and not followed) or if its end is, unless ``failed_pages``
    is ``skip``: then such pages and what is missing go to the quarantine and the others are loaded.
    Numbered sets of which no page tells whether another follows, and none is empty, pass as they
    are, unless ``require_end``. A job run again over the same input at the same date replaces what it
    put aside. Each job appends its seconds and rows to ``<base>/metrics``.
    """

    def __init__(self, spark: SparkSession, base: str, as_of: dt.datetime, *, buckets: int = 16, lines: bool = False,
                 mixed_headers: bool = True, layouts: Mapping[str, Layout] | None = None, failed_pages: str = "fail",
                 require_end: bool = False):
        if failed_pages not in ("fail", "skip"):
            raise ValueError(f"failed_pages must be 'fail' or 'skip', not {failed_pages!r}")
        zone = spark.conf.get("spark.sql.session.timeZone")
        if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
            raise ValueError(f"the session's time zone must be UTC, not {zone}")
        self.layouts = dict(layouts or {})
        self.failed_pages = failed_pages
        self.require_end = require_end
        self.metrics = RunMetrics(spark)
        self.spark = spark
        self.base = base.rstrip("/")
        self.as_of = as_of
        self.buckets = buckets
        self.lines = lines
        self.mixed_headers = mixed_headers
        self.control = control_table(spark, base)

    def table(self, name: str) -> Table:
        return Table.target(self.spark, self.base, name, buckets=self.buckets, layout=self.layouts.get(name))

    def quarantine(self, kind: str) -> DataFrame:
        """What was put aside of a kind so far."""
        return self.spark.read.json(f"{self.base}/quarantine/{kind}")

    def _put_aside(self, kind: str, paths: Paths, what: str, bad: DataFrame) -> None:
        """Writes under the names of the date and the input, so that a retry replaces its own rows."""
        listed = "\n".join([paths] if isinstance(paths, str) else sorted(paths))
        run = f"{self.as_of.isoformat().replace(':', '-')}-{hashlib.sha256(listed.encode()).hexdigest()[:12]}"
        path = f"{self.base}/quarantine/{kind}/run={run}/what={what}"
        if bad.isEmpty():
            try:
                self.spark.read.text(path)
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                return  # nothing to put aside and nothing from an earlier try
        bad.withColumnRenamed(CORRUPT, RECORD).write.mode("overwrite").json(path)

    def changes(self, kind: str, paths: Paths) -> DataFrame:
        """The readable rows of change files; the others go to the quarantine. Files are parsed once."""
        schema = schema_of(CHANGE_FILES[kind])
        casts = {f.name: f.dataType.simpleString() for f in schema.fields if f.dataType.typeName() != "string"}
        texts = read_texts(self.spark, paths, schema, mixed=self.mixed_headers)
        rows = settled(checked(texts, casts), kind)
        unfit = F.col(CORRUPT).isNotNull()
        fault = F.when(unfit, F.array(F.lit("record"))).otherwise(F.col("bad_columns"))
        self._put_aside(kind, paths, "rows", quarantined(rows.withColumn("bad_columns", fault)))
        return accepted(rows.filter(~unfit)).drop(CORRUPT)

    def _pages(self, kind: str, paths: Paths) -> DataFrame:
        """The pages of a set, parsed once; see the class for those that hold no list."""
        schema, nodes = PAGES[kind]
        pages = settled(read_pages(self.spark, paths, schema, lines=self.lines), kind, CODEC)
        bad = failed_pages(pages, nodes).select(F.col(ARRIVAL), "reason", CORRUPT)
        missing = settled(page_faults(pages, nodes, require_end=self.require_end), "faults")
        if self.failed_pages == "fail":
            found = [f"{r['file']}: {r['reason']}" for r in bad.select(f"{ARRIVAL}.file", "reason").limit(20).collect()]
            found += [f"set {r['page_set']}: {r['reason']} {r['at'] or ''}".rstrip() for r in missing.limit(20).collect()]
            if found:
                raise IncompletePages(f"{kind}: " + "; ".join(found))
        self._put_aside(kind, paths, "pages", bad)
        self._put_aside(kind, paths, "sets", missing)
        return pages

    def _nodes(self, kind: str, paths: Paths, keep: Sequence[str] = ()) -> DataFrame:
        return page_nodes(self._pages(kind, paths), PAGES[kind][1], [*keep, ARRIVAL])

    def _course_nodes(self, kind: str, paths: Paths) -> DataFrame:
        """Records of the running courses; whole pages are selected before they are unfolded."""
        return page_nodes(of_courses(self._pages(kind, paths), self._running()), PAGES[kind][1], ["course_id", ARRIVAL])

    def _merge(self, name: str, rows: DataFrame, order: Sequence[str], table: Table | None = None, **options) -> Table:
        table = table or self.table(name)
        with self.metrics.stage(name) as stage:
            table.upsert(stage.watch(rows), order, **options)
        self.metrics.save(f"{self.base}/metrics")
        return table

    def _running(self) -> DataFrame:
        return running_courses(self.table("course").read(), self.table("term").read(), self.as_of)

    # change files

    def user_id_link(self, paths: Paths, until: dt.datetime, order: Sequence[str] = ("ts", ARRIVAL)) -> Table:
        after = get_watermark(self.control, "pseudonyms", self.as_of)
        rows = link_rows(self.changes("pseudonyms", paths), after)
        table = self._merge("user_id_link", rows, order, null_keys="reject")
        advance_watermark(self.control, "pseudonyms", until)
        return table

    def new_users(self, paths: Paths, links: DataFrame, until: dt.datetime, snapshots: str | None = None,
                  exclude: str = "student") -> Table:
        """New users whose record does not mention ``exclude``; ``links`` gives the registry ids."""
        after = get_watermark(self.control, "users", self.as_of)
        changes = self.changes("users", paths)
        rows = new_user_rows(changes, links, after, exclude)
        table = self._merge("user_id_link", rows, ["ts", ARRIVAL], null_keys="reject")
        if snapshots:
            write_snapshot(new_users_slice(changes, after, exclude).drop(ARRIVAL), f"{snapshots}/users", until)
        advance_watermark(self.control, "users", until)
        return table

    def changed_enrollments(self, paths: Paths, until: dt.datetime, snapshots: str | None = None) -> Table:
        """All enrollments of the slice; the snapshot holds those created since the watermark."""
        after = get_watermark(self.control, "enrollments", self.as_of)
        changes = self.changes("enrollments", paths)
        table = self._merge("enrollment", changed_enrollment_rows(changes), ["updated_at", ARRIVAL],
                            null_keys="reject")
        if snapshots:
            new = since(changes, "value.created_at", after, inclusive=True)
            write_snapshot(new.drop(ARRIVAL), f"{snapshots}/enrollments", until)
        advance_watermark(self.control, "enrollments", until)
        return table

    def timetable(self, paths: Paths, after: dt.datetime = dt.datetime(2023, 1, 1)) -> Table:
        rows = timetable_rows(self.changes("calendar_events", paths), after)
        return self._merge("timetable", rows, [ARRIVAL], null_keys="reject")

    def snapshot(self, kind: str, paths: Paths, until: dt.datetime, snapshots: str) -> str:
        """Dated copy of a slice of one change-file table, every value as it arrived.

        Records that do not fit the header are kept as raw text beside it; sums of both are in a
        manifest, and the files are held against it before the watermark is saved.
        """
        texts = read_texts(self.spark, paths, CHANGE_FILES[kind], mixed=self.mixed_headers).drop(ARRIVAL)
        with self.metrics.stage(f"snapshot {kind}") as stage:
            rows = settled(stage.watch(texts), kind)  # parsed once
            written = proved_snapshot(rows, f"{snapshots}/{kind}", until)
        self.metrics.save(f"{self.base}/metrics")
        advance_watermark(self.control, kind, until)
        return written

    # pages of the courses that run now

    def enrollments(self, paths: Paths) -> Table:
        nodes = self._course_nodes("enrollments", paths)
        return self._merge("enrollment", course_enrollments(nodes, PLACE), PLACE, null_keys="reject")

    def enrollment_counts(self, paths: Paths) -> DataFrame:
        """Number of enrollments of every running course, zero included."""
        running = self._running()
        return rows_per_course(running, self._nodes("enrollments", paths, ["course_id"]))

    def student_summaries(self, paths: Paths, nested: bool = False) -> Table:
        kind, shape = ("summaries_nested", summaries_nested) if nested else ("summaries", summaries_flat)
        nodes = self._course_nodes(kind, paths)
        return self._merge("student_summary", shape(nodes, PLACE), PLACE)

    def module_items(self, paths: Paths) -> Table:
        nodes = self._course_nodes("modules", paths)
        return self._merge("module_item", module_items(nodes, PLACE), [*PLACE, "item_place"])

    def history(self, paths: Paths, login_days: int = 4, active_days: int = 2) -> Table:
        """Page views of recently active users; replaces the table."""
        recent = recent_users(
            self.table("user").read(), self.table("enrollment").read(),
            self.as_of - dt.timedelta(days=login_days), self.as_of - dt.timedelta(days=active_days),
        )
        pages = self._pages("page_views", paths).join(recent, "user_id", "left_semi")
        table = self.table("history")
        with self.metrics.stage("history") as stage:
            table.reload(stage.watch(page_view_rows(page_nodes(pages, PAGES["page_views"][1], ["user_id"]))))
        self.metrics.save(f"{self.base}/metrics")
        return table

    # registry pages

    def course_programmes(self, paths: Paths, blank_keys: bool = True) -> Table:
        """``blank_keys`` turns missing texts to ``''``, so rows without a programme share one key."""
        rows = course_programmes(self._nodes("course_links", paths), PLACE)
        if blank_keys:
            rows = fill_text(rows)
        return self._merge("course_programme", rows, [*PLACE, "item_place"])

    def course_catalogue(self, paths: Paths) -> tuple[Table, Table]:
        nodes = self._nodes("course_catalogue", paths)
        # complete courses have both parts of the key, so none is rejected
        return (self._merge("course_catalogue", catalogue_rows(nodes), PLACE, null_keys="reject"),
                self._merge("course_responsible", responsible_rows(nodes), PLACE, null_keys="reject"))

    def study_programmes(self, paths: Paths) -> Table:
        return self._merge("study_programme", study_programme_rows(self._nodes("study_programmes", paths)), PLACE)

    def programme_rights(self, paths: Paths, keys: Sequence[str] = ("plnr",)) -> Table:
        """One right per person, the last one; other keys keep more."""
        table = Table(self.spark, f"{self.base}/programme_right", TARGETS["programme_right"][1], keys,
                      buckets=self.buckets, layout=self.layouts.get("programme_right"))
        return self._merge("programme_right", programme_right_rows(self._nodes("programme_rights", paths)), PLACE, table)

    def study_rights(self, paths: Paths, snapshots: str) -> str:
        """Study programmes per student, as a dated CSV with the list as JSON text."""
        rows = study_right_rows(self._nodes("study_rights", paths))
        with self.metrics.stage("study_rights") as stage:
            written = write_snapshot(stage.watch(rows.withColumn("programmes", F.to_json("programmes"))),
                                     f"{snapshots}/study_rights", self.as_of)
        self.metrics.save(f"{self.base}/metrics")
        return written

    def terms(self, paths: Paths) -> Table:
        return self._merge("term", term_rows(self._nodes("terms", paths)), PLACE, null_keys="reject")

    def users(self, paths: Paths) -> Table:
        return self._merge("user", user_rows(self._nodes("users", paths)), PLACE, null_keys="reject")

    def courses(self, paths: Paths) -> Table:
        return self._merge("course", course_rows(self._nodes("courses", paths)), PLACE, null_keys="reject")
