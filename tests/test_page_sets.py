"""Completeness of landed page sets, against plain walks over the same pages, and in the jobs."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from sluice.plans.jobs import IncompletePages, Jobs
from sluice.sources import cursor_faults, number_faults
from sluice.sources.pages import followed

CURSORS = "s string, after string, fin string, more boolean, came int"


def cursor_pages(spark, rows):
    df = spark.createDataFrame(rows, CURSORS).repartition(3)
    found = cursor_faults(df, F.col("s"), F.col("after"), F.col("fin"), F.col("more"), F.col("came"))
    return sorted(((r["page_set"], r["reason"], r["at"]) for r in found.collect()), key=repr)


def walk(rows):
    """The same by following each set page by page."""
    sets = {}
    for s, after, end, more, came in sorted((r for r in rows if r[3] is not None), key=lambda r: (r[4], r[3], r[2] or "")):
        sets.setdefault(s, {})[after] = (more, end)
    out = []
    for s, pages in sets.items():
        linked, begun = any(a is not None for a in pages), None in pages
        if not any(not more for more, _ in pages.values()):
            out.append((s, "missing end", None))
        if not linked:
            continue
        out += [(s, "missing page", e) for more, e in pages.values() if more and e not in pages]
        if not begun:
            out.append((s, "missing page", None))
        on = set()
        for start in pages:
            seen, at = [], start
            while at in pages and at not in seen and pages[at][0]:
                seen.append(at)
                at = pages[at][1]
            if at in seen:
                on.add(start)
            elif start is None and len(seen) + (at in pages) < len(pages):
                out.append((s, "unreached", str(len(pages) - len(seen) - (at in pages))))
        if on:
            out.append((s, "circle", min((a or "") for a in on)))
    return sorted(out, key=repr)


def chain(s, n, more_at_end=False):
    return [(s, f"c{i}" if i else None, f"c{i + 1}", i < n - 1 or more_at_end, i) for i in range(n)]


def test_cursor_sets(spark):
    rows = chain("whole", 9) + chain("one", 1) + chain("open", 3, True) + chain("single open", 1, True)
    rows += [r for r in chain("gap", 9) if r[1] != "c4"] + chain("late", 5)[1:] + chain("cut", 5)[:-1]
    rows += chain("again", 4) + [("again", "c2", "c3", True, 99)]  # landed twice
    rows += chain("circle", 3) + [("circle", "x1", "x2", True, 1), ("circle", "x2", "x1", True, 2)]
    rows += [("silent", None, None, None, 1), ("silent", None, None, None, 2)]
    rows += [("no cursors", None, "c", True, 1), ("no cursors", None, "c", False, 2)]
    found = cursor_pages(spark, rows)
    assert found == walk([r for r in rows if r[0] != "circle"] + [r for r in rows if r[0] == "circle"])
    by_set = {s: {r for t, r, _ in found if t == s} for s in {r[0] for r in rows}}
    assert by_set["whole"] == by_set["one"] == by_set["again"] == by_set["silent"] == by_set["no cursors"] == set()
    assert by_set["gap"] == {"missing page", "unreached"} and by_set["late"] == {"missing page"}
    assert by_set["cut"] == {"missing page", "missing end"} and by_set["single open"] == {"missing end"}
    assert "circle" in by_set["circle"]
    assert ("gap", "missing page", "c4") in found and ("gap", "unreached", "4") in found


@pytest.mark.parametrize("seed", range(3))
def test_cursor_sets_with_random_losses(spark, seed):
    rng = random.Random(seed)
    rows = [r for k in range(40) for r in chain(f"s{k}", rng.randrange(1, 25), rng.random() < 0.1) if rng.random() < 0.93]
    assert cursor_pages(spark, rows) == walk(rows)


def test_pointers_double(spark):
    """A chain of 300 pages is followed in nine rounds, not in 300."""
    links = spark.createDataFrame([("s", f"c{i}" if i else "", f"c{i + 1}" if i < 299 else None) for i in range(300)],
                                  "page_set string, at string, to string")
    assert sorted(r["steps"] for r in followed(links).collect()) == list(range(1, 301))


NUMBERS = "s string, p int, more boolean, xs array<int>, came int"


def numbered(spark, rows, **options):
    df = spark.createDataFrame(rows, NUMBERS).repartition(3)
    found = number_faults(df, F.col("s"), F.col("p"), F.col("more"), F.col("xs"), F.col("came"), **options)
    return sorted(((r["page_set"], r["reason"], r["at"]) for r in found.collect()), key=repr)


def test_numbered_sets(spark):
    def pages(s, numbers, last=None, empty_end=False):
        rows = [(s, n, None if last is None else n != numbers[-1] or last == "open", [1], n) for n in numbers]
        return rows + ([(s, numbers[-1] + 1, None, [], 9)] if empty_end else [])

    rows = pages("told", [1, 2, 3], "end") + pages("empty end", [0, 1, 2], empty_end=True) + pages("unknown", [1, 2])
    rows += pages("gap", [1, 2, 5, 6], "end") + pages("late", [3, 4], "end") + pages("open", [1, 2], "open")
    rows += [("failed end", 1, True, [1], 1), ("failed end", 2, None, None, 2)]
    rows += pages("behind the end", [1, 2], "end") + [("behind the end", 7, None, None, 8), ("told", 2, False, [1], -1)]
    rows += [("no number", None, None, [1], 1)]
    expected = [("gap", "missing page", "3"), ("late", "missing page", "1"), ("open", "missing page", "3"),
                ("failed end", "missing end", "3")]
    assert numbered(spark, rows) == sorted(expected, key=repr)
    assert numbered(spark, rows, require_end=True) == sorted([*expected, ("unknown", "missing end", "3")], key=repr)
    assert numbered(spark, [], require_end=True) == []


AS_OF = dt.datetime(2024, 10, 2, 6)


def land(folder, *pages):
    os.makedirs(folder, exist_ok=True)
    for i, page in enumerate(pages):
        with open(f"{folder}/p{i}.json", "w", encoding="utf-8") as f:
            json.dump(page, f)
        os.utime(f"{folder}/p{i}.json", (1000 + i, 1000 + i))
    return folder


def listing(root, after, end, more, nodes=()):
    return {"after": after, "data": {root: {"pageInfo": {"endCursor": end, "hasNextPage": more}, "nodes": list(nodes)}}}


def course_pages(path, root):
    def page(after, end, more):
        return {"course_id": 1, "after": after, "data": {"course": {path: {"pageInfo": {"endCursor": end, "hasNextPage": more}, "nodes": []}}}}

    return page


#: Each page job: its kind, and how its pages are made from (after, end, more) or (number, has_next).
CURSOR_JOBS = {
    "course_programmes": ("course_links", lambda *a: listing("emner", *a)),
    "course_catalogue": ("course_catalogue", lambda *a: listing("emner", *a)),
    "study_programmes": ("study_programmes", lambda *a: listing("studieprogram", *a)),
    "programme_rights": ("programme_rights", lambda *a: listing("programStudieretter", *a)),
    "study_rights": ("study_rights", lambda *a: listing("studenter", *a)),
    "enrollments": ("enrollments", course_pages("enrollmentsConnection", None)),
}
NUMBER_JOBS = {"terms": "terms", "users": "users", "courses": "courses", "student_summaries": "summaries", "module_items": "modules",
               "history": "page_views"}


def run(jobs, name, path, folder):
    return getattr(jobs, name)(path, folder + "/snap") if name == "study_rights" else getattr(jobs, name)(path)


@pytest.mark.parametrize("name", [*CURSOR_JOBS, *NUMBER_JOBS])
def test_every_page_job_notices_gaps_and_missing_ends(spark, folder, name):
    if name in CURSOR_JOBS:
        kind, page = CURSOR_JOBS[name]
        whole = [page(None, "a", True), page("a", "b", True), page("b", None, False)]
    else:
        kind = NUMBER_JOBS[name]
        whole = [{"course_id": 1, "user_id": 1, "page": n, "has_next": n < 3, "items": []} for n in (1, 2, 3)]
        for p in whole[:2]:
            p["items"] = [{"id": 7}]
    strict = Jobs(spark, folder + "/strict", AS_OF, buckets=1)
    run(strict, name, land(f"{folder}/whole", *whole), folder)
    for what, pages, reason in (("gap", [whole[0], whole[2]], "missing page"), ("end", whole[:2], "missing page" if name in NUMBER_JOBS else "missing end")):
        with pytest.raises(IncompletePages, match=reason):
            run(strict, name, land(f"{folder}/{what}", *pages), folder)


@pytest.mark.parametrize("name", ["programme_rights", "terms"])
def test_skipped_gaps_are_recorded_once(spark, folder, name):
    """With ``skip`` what is missing is put aside; a retry replaces what the first try put aside."""
    if name in CURSOR_JOBS:
        kind, page = CURSOR_JOBS[name]
        path = land(folder + "/in", page(None, "a", True), page("b", None, False))
    else:
        kind = NUMBER_JOBS[name]
        path = land(folder + "/in", {"page": 1, "items": [{"id": 1}]}, {"page": 3, "has_next": False, "items": []})
    lax = Jobs(spark, folder + "/tables", AS_OF, buckets=1, failed_pages="skip")
    for _ in range(2):
        run(lax, name, path, folder)
    found = sorted(r["reason"] for r in lax.quarantine(kind).collect())
    assert found == (["missing page", "unreached"] if name in CURSOR_JOBS else ["missing page"])


def test_metrics_of_every_page_job(spark, folder):
    jobs = Jobs(spark, folder + "/t", AS_OF, buckets=1)
    for name in ("programme_rights", "study_rights"):
        _, page = CURSOR_JOBS[name]
        run(jobs, name, land(f"{folder}/{name}", page(None, None, False)), folder)
    lines = spark.read.option("header", True).csv(folder + "/t/metrics").collect()
    assert {(r["stage"], r["rows"]) for r in lines} == {("programme_right", "0"), ("study_rights", "0")}
