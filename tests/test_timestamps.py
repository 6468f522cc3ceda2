import datetime

import pytest

from civicgrain.operators.timestamps import resolve_meeting_moments

CASES = [
    ("Agenda 2024-06-10T00:30+01:00", "", None, "2024-06-09T23:30:00Z"),
    ("20261201T030018Z Meeting", "", None, "2026-12-01T03:00:18Z"),
    ("3/8/2026 2:30 a.m. ET", "", None, "2026-03-08T07:30:00Z"),  # skipped hour moves on
    ("11/1/2026 1:30 a.m. ET", "", None, "2026-11-01T05:30:00Z"),  # repeated hour: the earlier
    ("16/11/2022 Board Packet", "", None, "2022-11-16"),
    ("6.24.23 Meeting", "", None, "2023-06-24"),
    ("Acta, 6 de abril de 2020", "", None, "2020-04-06"),
    ("September 2024 Minutes", "/2020-01-02/x.pdf", None, "2024-09"),
    ("01/2020 minutes", "", None, "2020-01"),
    ("23 May 2021, 19.00 hrs", "", None, "2021-05-23T23:00:00Z"),
    ("Work (posted 2022-05-11 22:45:33.231)", "", None, "2022-05-12T02:45:33Z"),
    ("Minutes 6/12", "http://x.example/sy/2025-2026/a.pdf", None, "2026-06-12"),
    ("Minutes, Oct 16", "http://x.example/agendas/2026-27/a.pdf", None, "2026-10-16"),
    ("January 13", "http://x.example/board/2022/a.pdf", None, "2022-01-13"),
    ("Agenda 6/18", "http://x.example/d/a.pdf", datetime.date(2025, 6, 18), "2025-06-18"),
    ("View", "http://x.example/d/a.pdf?t=1751065200000", None, "2025-06-27T23:00:00Z"),
    (None, "http://x.example/minutes/11-11-2019/a.pdf", None, "2019-11-11"),
    ("February 30, 2024", "", None, None),
    ("2026-27 Budget", "http://x.example/uploads/2024/05/a.pdf", None, None),
    ("Bid 2026-014 addendum", "", None, None),
    ("Room 10-12 floor plan", None, None, None),
    ("Agenda 6/18", "", None, None),
    ("", "", datetime.date(2024, 1, 1), None),
    (None, None, None, None),
]


def test_cascade(spark):
    rows = spark.createDataFrame([(i, *c[:3], "clash") for i, c in enumerate(CASES)], "doc_id long, link_text string, source_url string, meeting_date date, resolved string")
    got = {r.doc_id: r.resolved for r in resolve_meeting_moments(rows).collect()}
    assert got == {i: c[3] for i, c in enumerate(CASES) if c[3]}


def test_zone_of_a_source(spark):
    rows = spark.createDataFrame([(1, "2024-01-02 10:00", "", None, "west"), (2, "2024-01-02 10:00", "", None, None)], "doc_id long, link_text string, source_url string, meeting_date date, source string")
    got = {r.doc_id: r.resolved for r in resolve_meeting_moments(rows, {"west": "America/Los_Angeles"}).collect()}
    assert got == {1: "2024-01-02T18:00:00Z", 2: "2024-01-02T15:00:00Z"}


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/Chicago"])
def test_session_zone_does_not_matter(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(1, "2024-07-01T00:30Z", "", None)] * 2, "doc_id long, link_text string, source_url string, meeting_date date")
        assert [r.resolved for r in resolve_meeting_moments(rows).collect()] == ["2024-07-01T00:30:00Z"] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty_table(spark):
    assert resolve_meeting_moments(spark.createDataFrame([], "doc_id long, link_text string, source_url string, meeting_date date")).count() == 0


@pytest.mark.parametrize("skipped,repeated,want", [
    ("later", "earlier", ("2026-03-08T07:30:00Z", "2026-11-01T05:30:00Z")), ("earlier", "later", ("2026-03-08T06:30:00Z", "2026-11-01T06:30:00Z")), ("null", "null", ("2026-03-08", "2026-11-01")),
])
def test_policy_of_skipped_and_repeated_hours(spark, skipped, repeated, want):
    """Other times, offsets and zones without a season stay as they are under any policy."""
    texts = ["3/8/2026 2:30 a.m.", "11/1/2026 1:30 a.m.", "3/8/2026 3:30 a.m.", "11/1/2026 2:30 a.m.", "11/1/2026 1:30 a.m. EST", "7/4/2026 10:00 PT"]
    rows = spark.createDataFrame([(i, t, "", None) for i, t in enumerate(texts)], "doc_id long, link_text string, source_url string, meeting_date date")
    got = {r.doc_id: r.resolved for r in resolve_meeting_moments(rows, skipped=skipped, repeated=repeated).collect()}
    assert got == {0: want[0], 1: want[1], 2: "2026-03-08T07:30:00Z", 3: "2026-11-01T07:30:00Z", 4: "2026-11-01T06:30:00Z", 5: "2026-07-04T17:00:00Z"}
    with pytest.raises(ValueError, match="skipped is one of"):
        resolve_meeting_moments(rows, skipped="never")
