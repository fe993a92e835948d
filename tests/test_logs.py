"""Parsing, splitting, visits and bounces on hand-worked records."""

import json
import random

import pytest

from martflow import schemas
from martflow.operators import logs, stats, visits
from martflow.plans import visitors

DAY = 86_400_000


def page(mid, ts, page_id="home", last=None, is_new="0", during=None, item=None, **more):
    return {
        "common": {"mid": mid, "vc": "v1", "ch": "web", "ar": "a1", "is_new": is_new},
        "page": {"page_id": page_id, "last_page_id": last, "item": item, "during_time": during},
        "displays": more.get("displays"),
        "start": more.get("start"),
        "ts": ts,
    }


def frame(spark, records):
    return spark.createDataFrame(records, schemas.PAGE)


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


def found(df):
    return sorted((r["common"]["mid"], r["ts"]) for r in df.collect())


# The sample: device 101 leaves after one page, device 102 goes on.
SAMPLE = [
    page("101", 10000),
    page("102", 12000),
    page("102", 15000, "good_list", "home"),
    page("102", 30000, "good_list", "detail"),
]


def test_sample_has_one_bounce(spark):
    assert found(visits.user_jump(frame(spark, SAMPLE))) == [("101", 10000)]


@pytest.mark.parametrize(
    ("gap", "bounce"), [(10_000, True), (9_999, False), (1, False), (10_001, True), (25_000, True)]
)
@pytest.mark.parametrize("start", [0, 1, 4_321, 9_999])
def test_bounce_limit(spark, gap, bounce, start):
    pages = [page("a", start), page("a", start + gap, "good_list", "home")]
    expected = [("a", start)] if bounce else []
    assert found(visits.user_jump(frame(spark, pages))) == expected


def test_two_entries_and_trailing_entry(spark):
    pages = [page("a", 1000), page("a", 3000), page("b", 5000, "x", "y"), page("b", 7000)]
    assert found(visits.user_jump(frame(spark, pages))) == [("a", 3000), ("b", 7000)]


def brute_bounces(records, limit):
    by_mid = {}
    for r in records:
        by_mid.setdefault(r["common"]["mid"], []).append(r)
    out = []
    for mid, rows in by_mid.items():
        rows.sort(key=lambda r: r["ts"])
        for row, following in zip(rows, rows[1:] + [None]):
            late = following is None or following["ts"] - row["ts"] >= limit
            if not row["page"]["last_page_id"] and late:
                out.append((mid, row["ts"]))
    return sorted(out)


def test_bounces_match_brute_force_with_a_hot_device(spark):
    rng = random.Random(7)
    stamps = rng.sample(range(0, 3_000_000), 900)
    records = [
        page("hot" if rng.random() < 0.4 else f"d{rng.randrange(40)}", ts, "p",
             rng.choice([None, "", "q"]))
        for ts in stamps
    ]
    expected = brute_bounces(records, 10_000)
    assert found(visits.user_jump(frame(spark, records))) == expected
    rng.shuffle(records)
    shuffled = frame(spark, records).repartition(5)
    assert found(visits.user_jump(shuffled)) == expected


def test_parse_keeps_good_lines_and_returns_the_others(spark):
    good = {"common": {"mid": 7, "is_new": 1}, "page": {"page_id": "home", "during_time": "12"}, "ts": "99"}
    no_page = {"common": {"mid": "8"}, "start": {"entry": "icon", "n": 3}, "ts": 5}
    bad = ["{", "", "[]", '{"common":{},"ts":1}', '{"common":{"mid":"1"},"ts":"x"}', '{"ts":1}']
    df = lines(spark, [json.dumps(good), json.dumps(no_page), *bad])
    rows = {r["common"]["mid"]: r for r in logs.parse_log(df).collect()}
    assert set(rows) == {"7", "8"}
    assert rows["7"]["common"]["is_new"] == "1"
    assert (rows["7"]["page"]["during_time"], rows["7"]["ts"]) == (12, 99)
    assert rows["8"]["page"] is None and rows["8"]["start"] == {"entry": "icon", "n": "3"}
    assert sorted(r["value"] for r in logs.rejected_lines(df).collect()) == sorted(bad)


def test_unreadable_duration_is_null(spark):
    text = '{"common":{"mid":"1"},"page":{"page_id":"p","during_time":"soon"},"ts":4}'
    assert logs.parse_log(lines(spark, [text])).first()["page"]["during_time"] is None


def test_splits(spark):
    shown = [{"item": "3", "item_type": "sku_id"}, {"item": "9", "item_type": "activity_id"}]
    records = frame(spark, [
        page("a", 1, displays=shown),
        page("b", 2, start={"entry": "icon"}, displays=shown),
        page("c", 3, start={}, displays=[]),
    ])
    assert found(logs.split_start(records)) == [("b", 2)]
    assert found(logs.split_page(records)) == [("a", 1), ("c", 3)]
    displays = [tuple(r) for r in logs.split_display(records).collect()]
    assert sorted(displays) == [("3", "sku_id", "home"), ("9", "activity_id", "home")]
    assert logs.split_display(records).columns == ["item", "item_type", "page_id"]


def test_new_flag_is_kept_on_the_first_day_only(spark):
    records = [
        page("a", 2 * DAY, is_new="0"),
        page("a", 3 * DAY, is_new="1"),
        page("a", 3 * DAY + 5, is_new="1"),
        page("a", 5 * DAY, is_new="1"),
        page("b", 9 * DAY, is_new="1"),
        page("c", 9 * DAY, is_new=None),
    ]
    fixed = visits.fix_is_new(frame(spark, records))
    flags = sorted((r["common"]["mid"], r["ts"] // DAY, r["common"]["is_new"] or "-") for r in fixed.collect())
    assert flags == [
        ("a", 2, "0"), ("a", 3, "1"), ("a", 3, "1"), ("a", 5, "0"), ("b", 9, "1"), ("c", 9, "-"),
    ]


def test_unique_visit_is_the_first_entry_of_a_day(spark):
    records = [
        page("a", 100, last="x"), page("a", 200), page("a", 300, last=""),
        page("a", DAY + 1, last=""), page("b", 50),
    ]
    assert found(visits.session_entries(frame(spark, records))) == [
        ("a", 200), ("a", 300), ("a", DAY + 1), ("b", 50),
    ]
    assert found(visits.unique_visit(frame(spark, records))) == [("a", 200), ("a", DAY + 1), ("b", 50)]


def test_visitor_stats_counts_null_duration_as_zero(spark):
    pages = [page("a", 1000, during=None), page("a", 2000, last="home", during=70)]
    row = visitors.visitor_stats(frame(spark, pages)).collect()
    assert len(row) == 1
    assert row[0].asDict() == {
        "stt": "1970-01-01 00:00:00", "edt": "1970-01-01 00:00:10", "vc": "v1", "ch": "web",
        "ar": "a1", "is_new": "0", "uv_ct": 1, "pv_ct": 2, "sv_ct": 1, "uj_ct": 0,
        "dur_sum": 70, "ts": 1000,
    }


def test_visitor_pipeline_equals_the_stages_one_by_one(spark):
    rng = random.Random(3)
    records = frame(spark, [
        page(f"d{rng.randrange(6)}", ts, "p", rng.choice([None, "q"]), rng.choice(["0", "1"]),
             rng.randrange(100), start={"e": "1"} if rng.random() < 0.1 else None)
        for ts in rng.sample(range(0, 3 * DAY, 1000), 300)
    ])
    pages = logs.split_page(visits.fix_is_new(records))
    measures = stats.visitor_union(pages, visits.unique_visit(pages), visits.user_jump(pages))
    expected = sorted(map(tuple, stats.visitor_stats(measures, "1 hour").collect()))
    assert sorted(map(tuple, visitors.visitor_stats(records, "1 hour").collect())) == expected
    assert sum(r[6] for r in expected) > 10 and sum(r[9] for r in expected) > 10


def test_windows_start_at_multiples_and_exclude_their_end(spark):
    pages = frame(spark, [page("a", 9_999), page("a", 10_000, last="x")])
    stats_rows = stats.visitor_stats(stats.page_measures(pages)).orderBy("stt").collect()
    assert [(r.stt[-2:], r.edt[-2:], r.pv_ct) for r in stats_rows] == [("00", "10", 1), ("10", "20", 1)]


def test_hot_device_needs_no_ranking(spark):
    plans = [
        visits.user_jump(frame(spark, SAMPLE)),
        visits.unique_visit(frame(spark, SAMPLE)),
        visits.fix_is_new(frame(spark, SAMPLE)),
    ]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window [" not in plan and "partial_" in plan


def test_input_order_does_not_matter(spark):
    rng = random.Random(11)
    records = [
        page(f"d{rng.randrange(4)}", ts, "p", rng.choice([None, "q"]), rng.choice(["0", "1"]), 5)
        for ts in rng.sample(range(0, 2 * DAY, 500), 200)
    ]
    frames = frame(spark, records), frame(spark, rng.sample(records, len(records))).repartition(7)
    for operator in (visits.fix_is_new, visits.unique_visit, visitors.visitor_stats):
        one, two = (sorted(map(str, operator(f).collect())) for f in frames)
        assert one == two and one


def test_a_line_is_parsed_and_cast_once(spark):
    lines = spark.createDataFrame([("{}",)], "value STRING")
    for df in (
        logs.parse_log(lines).where("ts > 5").select("common.mid", "page.*", "ts"),
        logs.rejected_lines(lines),
    ):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1
        assert plan.lower().count("cast(from_json(") == 1


def test_visitor_statistics_parse_text_once(spark):
    """What they read more than once is a written table of the columns they need."""
    lines = spark.createDataFrame([("{}",)], "value STRING")
    found = visitors.visitor_stats(logs.parse_log(lines))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json(" not in plan and "displays" not in plan
