"""Warehouse jobs end to end on a few courses."""

import json
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

import pytest
from conftest import rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.operators.shape import deduplicate, gathered
from starloom.operators.staging_area import stage
from starloom.plans import checks, dashboard, extract, history, semantic, star
from starloom.plans.rules import CLOUD, DEFAULT, LOCAL
from starloom.plans.staging import COURSERA, UDACITY, UDEMY, align_feed, combine_feeds, stage_feed, stage_feeds
from starloom.plans.standardize import standardize_courses
from starloom.queries import courses as course_queries
from starloom.queries import registry

UDEMY_SCHEMA = (
    "course_id string, Course_Title string, Course_URL string, Language string, Description string, Skills string, Level string, "
    "Programming_Instructor string, Domain_Name string, Last_Update string, Duration string, No_of_Reviews string, rate string, "
    "Price string, `price model` string, No_of_Students string, offering_Type string"
)


def udemy(course_id, title="T", updated="1/2/2024", **over):
    row = dict(
        course_id=course_id, title=f" {title} ", url="/u", language="en", description=" d ", skills=" a | b ", level="Beginner Level",
        instructor="Ann", domain="Dev", updated=updated, duration="5 hours", reviews="10", rating="4.5", price="499.99",
        model="one time", students="100", kind="Course",
    )
    return tuple({**row, **over}.values())


@pytest.fixture(scope="module")
def feeds(frame):
    u = frame(
        [
            udemy("1", "old", "1/2/2024"), udemy("1", "new", "3/4/2024"), udemy("1", "undated", None),
            udemy("x9", "not a number"), udemy("2", "free", price="0", instructor=None, level=None, students=None),
            udemy("3", "odd", "31/31/2024", rating="5.5", duration="20 minutes", kind=None, domain=None),
        ],
        UDEMY_SCHEMA,
    )
    c = frame(
        [("1", " C ", "/c", "Farsi", "d", "s", "mixed", "Bo", "Dev", "12/31/2023", "Approx 5 hours", 5, 4.0, 5000.0, "subscription", 50, None),
         (None, "lost", "/c", "en", "d", "s", "mixed", "Bo", "Dev", "12/31/2023", "5", 5, 4.0, 5000.0, "subscription", 50, None)],
        "course_id string, Course_Title string, Course_URL string, Language string, Description string, Skill string, Level string, "
        "Instructor string, Domain_Name string, Last_Update string, Duration string, `No. of Reviews` int, Rating double, Price double, "
        "Price_Model string, `No. of Students enrolled` int, Type_of_Course string",
    )
    d = frame(
        [("ud1", "D", "/d", "xx", "d", "s", "guru", "Ann", "Data", "2024-05-06 10:00:00", "45 hours", None, 4.9, 100.0, "Monthly_Subscription", 2000, "Nanodegree"),
         ("ud1", "late", "/d", "xx", "d", "s", "guru", "Ann", "Data", "2024-05-06 11:00:00", "45 hours", 40, 4.9, 100.0, "Monthly_Subscription", 2000, "Nanodegree")],
        "course_id string, Course_Title string, Course_URL string, Language string, Description string, Skill string, Level string, "
        "`Programming Instructor` string, Best_Category string, `Last Update` string, Duration_Hours string, Review_Count int, Avg_Rating double, "
        "monthly_price double, Price_Model string, enrolled_students int, offering_type string",
    )
    return c, d, u


@pytest.fixture(scope="module")
def courses(feeds):
    c, d, u = feeds
    combined = combine_feeds(stage_feed(c, COURSERA), stage_feed(d, UDACITY), stage_feed(u, UDEMY))
    return stage(standardize_courses(combined), "courses")


@pytest.mark.parametrize("rules", [DEFAULT, replace(LOCAL, lenient_dates=True), replace(CLOUD, lenient_dates=True)])
def test_feeds_staged_together_are_as_those_staged_alone(feeds, rules):
    """One pass over all feeds under the canonical names against one staging per feed and their union."""
    raw, alone = [], []
    for df, feed in zip(feeds, (COURSERA, UDACITY, UDEMY)):
        named = {c: next(n for n in names if n in df.columns) for c, names in feed.columns.items()}
        raw.append(df.select(F.lit(feed.platform).alias("platform"), *[F.col(f"`{n}`").cast("string").alias(c) for c, n in named.items()]))
        alone.append(stage_feed(df, feed, rules))
    together = reduce(DataFrame.unionByName, [*raw, raw[0].withColumn("platform", F.lit("Other"))])
    got, want = stage_feeds(together, "platform", rules), combine_feeds(*alone)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert rows(got) == rows(want)


@pytest.mark.parametrize("rules", [DEFAULT, replace(LOCAL, lenient_dates=True), replace(CLOUD, lenient_dates=True)])
def test_picked_rows_are_completed_after_the_pick(feeds, rules):
    """Narrow rows picked and then completed against whole rows staged; completing sees the picked rows only."""
    named, narrow, wide = [], [], []
    for df, feed in zip(feeds, (COURSERA, UDACITY, UDEMY)):
        spelled = {c: next(n for n in names if n in df.columns) for c, names in feed.columns.items()}
        df = df.withColumn("line", F.monotonically_increasing_id())
        few = df.select(spelled["course_id"], spelled["last_updated"], "line")
        rest = df.drop(spelled["course_id"], spelled["last_updated"])
        seen = []

        def complete(rows):
            seen.append(rows.count())
            return rows.join(rest, "line")

        tie = [F.asc("line")]
        assert rows(stage_feed(few, feed, rules, tie, complete)) == rows(stage_feed(df, feed, rules, tie))
        assert seen == [stage_feed(df, feed, rules, tie).count()] and seen[0] <= df.count()
        whole = df.select(F.lit(feed.platform).alias("platform"), "line", *[F.col(f"`{n}`").cast("string").alias(c) for c, n in spelled.items()])
        named.append(whole)
        narrow.append(whole.select("platform", "line", "course_id", "last_updated"))
        wide.append(whole.drop("course_id", "last_updated"))
    narrow, wide, whole = (reduce(DataFrame.unionByName, frames) for frames in (narrow, wide, named))
    got = stage_feeds(narrow, "platform", rules, [F.asc("line")], complete=lambda picked: picked.join(wide, ["platform", "line"]))
    assert rows(got) == rows(stage_feeds(whole, "platform", rules, [F.asc("line")]))


def test_raw_feed_queries_pick_before_they_look_up(spark, tmp_path):
    """Lines of unknown parts or suppliers are left out first, parts listed twice give one row, and the rows to pick from hold no text of a part."""
    def write(name, data):
        spark.createDataFrame(data, registry.SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")

    def line(order, part, supplier, flag, day):
        return (order, part, supplier, 1, 3.0, 10.0, 0.0, 0.0, flag, "O", datetime(2024, 1, day))

    write("part", [(1, "bolt", "Brand#1", "SMALL", 1, 5.0), (1, "bolt", "Brand#1", "SMALL", 1, 5.0), (2, "nut", "Brand#2", "LARGE", 2, 6.0), (None, "x", "y", "z", 3, 7.0)])
    write("supplier", [(3, "Ann", 1, 0.0), (2, None, 1, 0.0)])
    write("lineitem", [
        line(1, 1, 3, "R", 5), line(2, 1, 9, "R", 9), line(3, 1, 2, "R", 7), line(4, 2, 3, "A", 1), line(5, 2, 3, "A", 2),
        line(6, 5, 3, "N", 1), line(7, None, 3, "N", 1), line(8, 2, None, "N", 3), line(9, 2, 2, "N", 2)])
    got = {(r["platform"], r["course_id"]): r for r in course_queries.combined(spark, str(tmp_path)).collect()}
    assert {k: (r["title"], r["instructor"], r["last_updated"]) for k, r in got.items()} == {
        ("Udemy", "1"): ("bolt 1", None, date(2024, 1, 7)), ("Coursera", "2"): ("nut 2", "Ann", date(2024, 1, 2)), ("Udacity", "ud2"): ("nut 2", None, date(2024, 1, 2))}
    whole = course_queries.staged(spark, str(tmp_path), UDEMY, whole=True)
    assert sorted((r["course_id"], r["last_updated"]) for r in whole.collect()) == [("1", date(2024, 1, 7)), ("2", date(2024, 1, 2))]
    assert {"course_id", "last_updated", "platform"} == set(course_queries.raw_feeds(spark, str(tmp_path)).columns) - {*course_queries.TIES, *course_queries._CARRIED}
    assert set(course_queries.raw_feed(spark, str(tmp_path), UDEMY).columns) == {"course_id", "Last_Update", *course_queries.TIES, *course_queries._CARRIED}


def test_gathered_rows_of_a_hot_key(frame):
    df = frame([(None if i % 3 else f"k{i % 7}", i) for i in range(300)], "k string, v int")
    assert rows(gathered(df, ["k"])) == rows(df)
    assert rows(deduplicate(gathered(df, ["k"]), ["k"], [F.desc("v")])) == rows(deduplicate(df, ["k"], [F.desc("v")]))


def test_latest_row_per_id(feeds):
    _, d, u = feeds
    got = {r["course_id"]: r for r in stage_feed(u, UDEMY).collect()}
    assert set(got) == {"1", "2", "3"}
    one = got["1"]
    assert (one["title"], one["last_updated"], one["skills"], one["platform"]) == ("new", date(2024, 3, 4), "a, b", "Udemy")
    assert (one["duration_hours"], one["review_count"], one["rating"], one["price"]) == (5.0, 10, 4.5, 499.99)
    assert got["3"]["last_updated"] is None
    assert [r["title"] for r in stage_feed(d, UDACITY).collect()] == ["late"]


def test_rules_decide_dirty_rows(feeds):
    c, _, u = feeds
    assert stage_feed(c, COURSERA, DEFAULT).count() == 1 and stage_feed(c, COURSERA, LOCAL).count() == 2
    assert stage_feed(c, COURSERA, CLOUD).first()["duration_hours"] == 0.0
    with pytest.raises(Exception, match="(?i)parse"):
        stage_feed(u, UDEMY, LOCAL).collect()


def test_other_dialect_column_names(feeds):
    c, _, _ = feeds
    renamed = c.withColumnsRenamed({"No. of Reviews": "No__of_Reviews", "No. of Students enrolled": "No__of_Students_enrolled"})
    assert rows(stage_feed(renamed, COURSERA)) == rows(stage_feed(c, COURSERA))
    with pytest.raises(ValueError, match="Duration"):
        stage_feed(c.drop("Duration"), COURSERA)


def test_standardized_rows(courses):
    got = {(r["platform"], r["course_id"]): r for r in courses.collect()}
    c, d, u2, u3 = got["Coursera", "1"], got["Udacity", "ud1"], got["Udemy", "2"], got["Udemy", "3"]
    assert (c["language"], c["level"], c["price_category"], c["offering_type"]) == ("Persian", "All Levels", "Premium", "Unknown")
    assert (d["language"], d["level"], d["duration_category"], d["estimated_total_cost"]) == ("Other / Unknown", "Unknown", "Long", 200.0)
    assert (u2["price_category"], u2["level"], u2["popularity_score"], u2["value_score"]) == ("Free", "Unknown", None, None)
    # The score sees the rating as delivered, the row the one in range.
    assert u3["rating"] is None and u3["popularity_score"] == 25.38 and u3["value_score"] is None


def test_align_udemy(frame):
    scraped = frame(
        [(0, "1", " Free ", 5), (1, "1", "$9", 6), (2, "2", "0", 7)], "`Unnamed: 0` int, course_id string, Price string, No_of_Students_enrolled int"
    )
    got = align_feed(scraped, UDEMY, F.col("`Unnamed: 0`"))
    assert set(got.columns) == {"course_id", "Price", "No_of_Students", "offering_Type", "rate", "price model"}
    assert rows(got.select("course_id", "No_of_Students", "price model", "offering_Type")) == [
        ("1", 6, "One Time", "Course"), ("2", 7, "Free", "Course")
    ]


# --- history ------------------------------------------------------------------------------------

def version(frame, *items):
    return frame(
        [(k, "P", t, None, "s", "/u", n) for k, t, n in items],
        "course_id string, platform string, title string, description string, skills string, course_url string, n int",
    )


def test_a_null_key_is_merged_once(frame):
    days = [datetime(2024, m, 1) for m in (1, 2, 3)]
    held = history.first_snapshot(version(frame, (None, "A", 1), ("b", "B", 1)), days[0])
    for day in days[1:]:
        held = history.merge_snapshot(held, version(frame, (None, "A", 1), ("b", "B", 1)), day)
    assert held.count() == 2


def test_several_rows_for_a_key_stop_the_merge(frame):
    first = history.first_snapshot(version(frame, ("a", "A", 1)), datetime(2024, 1, 1))
    with pytest.raises(Exception, match="several rows for one key"):
        history.merge_snapshot(first, version(frame, ("a", "B", 1), ("a", "C", 1)), datetime(2024, 2, 1)).collect()


def test_versions_of_changes_equal_repeated_merges(frame):
    days = [datetime(2024, 1, d) for d in (1, 2, 3, 4)]
    states = [("k", "A"), ("k", "A"), ("k", "B"), ("k", "A")]
    log = frame([(k, t, d) for (k, t), d in zip(states, days)], "key string, title string, at timestamp_ntz")
    got = history.versions_of_changes(log, ["key"], "at", ["title"]).select("key", "title", "valid_from", "valid_to")
    held = None
    for (k, t), day in zip(states, days):
        now = frame([(k, t)], "key string, title string")
        held = history.first_snapshot(now, day) if held is None else history.merge_snapshot(held, now, day, ["key"], ["title"])
    assert rows(got) == rows(held)


def test_snapshot_cycle(frame):
    t1, t2, t3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
    first = history.first_snapshot(version(frame, ("a", "A", 1), ("b", "B", 1), ("c", None, 1)), t1)
    incoming = version(frame, ("a", "A", 2), ("b", "B2", 2), ("c", None, 2), ("d", "D", 2))
    second = history.merge_snapshot(first, incoming, t2)
    got = rows(second.select("course_id", "title", "n", "valid_from", "valid_to"))
    assert got == sorted([
        ("a", "A", 1, t1, None), ("b", "B", 1, t1, t2), ("b", "B2", 2, t2, None), ("c", None, 1, t1, None), ("d", "D", 2, t2, None),
    ], key=repr)
    assert rows(history.merge_snapshot(second, incoming, t2)) == rows(second)
    third = history.merge_snapshot(second, version(frame, ("b", "B", 3)), t3)
    assert third.filter("valid_to is null").count() == 4 and third.filter("course_id = 'b'").count() == 3
    failing = quality.mutually_exclusive_ranges(
        third.withColumn("valid_to", F.coalesce("valid_to", F.lit(datetime(9999, 1, 1)))), "valid_from", "valid_to", "course_id", "not_allowed"
    )
    assert failing.count() == 0


def test_publish_keeps_earlier_versions(frame, tmp_path):
    first = history.first_snapshot(version(frame, ("a", "A", 1)), datetime(2024, 1, 1))
    one = history.publish_snapshot(first, str(tmp_path), "1")
    two = history.publish_snapshot(history.merge_snapshot(one, version(frame, ("a", "B", 2)), datetime(2024, 2, 1)), str(tmp_path), "2")
    assert one.count() == 1 and two.count() == 2


# --- star ------------------------------------------------------------------------------------------

def test_star_schema(courses):
    log = history.first_snapshot(courses, datetime(2024, 1, 1))
    tables = star.build_star(courses, log)
    fact = tables["fact_offerings"]
    assert fact.count() == courses.count() == 5
    for which, (_, key, _) in star.DIMENSIONS.items():
        dim = tables[f"dim_{which}"]
        assert quality.unique(dim, key).count() == 0
        assert quality.not_null(fact, key).count() == 0
        assert quality.relationships(fact, key, dim, key).count() == 0
        numbers = sorted(r[0] for r in dim.select(key).collect())
        assert numbers == [-1, *range(1, len(numbers))]
    assert quality.relationships(fact, "date_id", tables["dim_date"], "date_id").count() == 0
    assert quality.relationships(fact, "offering_sk", tables["dim_offering"], "offering_sk").count() == 0
    assert fact.filter("date_id = -1").count() == 1
    assert fact.filter("instructor_id = -1").count() == 1
    # The same id on two platforms gives two offerings and no fan-out.
    assert tables["dim_offering"].filter("offering_id = '1'").count() == 2


def test_local_rules_leave_null_keys_and_gaps(courses):
    dim = star.build_dimension(courses, "instructor", LOCAL)
    assert rows(dim) == [(-1, "Unknown Instructor"), (1, "Ann"), (2, "Bo")]
    domain = star.build_dimension(courses, "domain", LOCAL)
    assert rows(domain) == [(1, "Data"), (2, "Dev"), (3, None)]
    fact = star.build_fact(courses, {"domain": stage(domain, "d"), "instructor": stage(dim, "d")}, rules=LOCAL)
    assert fact.filter("domain_id is null").count() == 1 and fact.filter("instructor_id = -1").count() == 1


def test_date_dimension(courses):
    got = rows(star.date_dimension(courses))
    assert (20240304, date(2024, 3, 4), 4, 3, 1, 2024) in got and (-1, None, None, None, None, None) in got


# --- reports ------------------------------------------------------------------------------------------

def test_reports_cover_all_courses(courses):
    assert semantic.platform_performance(courses).agg(F.sum("total_courses")).first()[0] == 5
    tiers = semantic.quality_tiers(courses)
    assert tiers.agg(F.sum("course_count")).first()[0] == 5
    assert all(abs(r[1] - 100) < 0.5 for r in tiers.groupBy("platform").agg(F.sum("pct_of_platform")).collect())
    pricing = semantic.pricing_analysis(courses)
    assert [r["price_category"] for r in pricing.collect()] == ["Free", "Cheap", "Premium"]
    assert pricing.agg(F.sum("pct_of_total")).first()[0] == 100.0
    trends = semantic.domain_trends(courses).collect()
    assert trends[0]["domain_name"] == "Data" and {r["domain_name"] for r in trends} == {"Data", "Dev", None}


def test_instructor_rankings(courses):
    got = semantic.instructor_rankings(courses).collect()
    assert [(r["instructor"], r["course_count"], r["overall_rank"], r["decile"], r["platforms"]) for r in got] == [
        ("Ann", 3, 1, 1, "Udacity, Udemy")
    ]


def test_dashboard(courses):
    dims = {w: stage(star.build_dimension(courses, w), w) for w in ("platform", "level")}
    fact = star.build_fact(courses, dims)
    chart = dashboard.enrolled_by(fact, dims["platform"], "platform_id", "platform_name")
    assert [tuple(r) for r in chart.collect()] == [("Udacity", 2000), ("Udemy", 200), ("Coursera", 50)]
    picked = dashboard.slicer(
        fact, {"platform_name": (dims["platform"], "platform_id")}, {"platform_name": ["Udemy"], "price_category": ["Cheap"]}
    )
    assert picked.count() == 2
    assert dashboard.cards(fact).first()["total_enrolled"] == 2250
    top = dashboard.top_n_filter(courses, "title", F.sum("enrolled_students"), 1)
    assert [r["title"] for r in top.collect()] == ["late"]
    assert [tuple(r) for r in dashboard.count_by_member(fact, dims["platform"], "platform_id", "platform_name", 1).collect()] == [("Udemy", 3)]


# --- extraction ------------------------------------------------------------------------------------------

def test_listing_rows(frame):
    course = {
        "title": "T", "urlCourseLanding": "/t", "updatedOn": "2024-01-01", "isFree": True, "durationInSeconds": 5400, "level": "All",
        "locale": {"title": "English"}, "rating": {"count": 7}, "instructors": [{"name": " Ann "}, {"name": ""}, {"name": "Bo"}],
        "headline": "Learn SQL",
    }
    detail = {"description": "<b>Go</b>", "num_subscribers": 9, "instructional_level": "Expert", "content_info": "2 total hours",
              "primary_subcategory": {"title": "Dev"}, "topics": [{"title": " Web "}, "Data"]}
    courses = frame([("1", json.dumps(course)), ("2", json.dumps({"id": 2, "headline": "Learn SQL"}))], "course_id string, json string")
    details = frame([("1", json.dumps(detail))], "course_id string, json string")
    prices = frame([("1", json.dumps({"price": {"price_string": "$5"}}))], "course_id string, json string")
    one, two = extract.listing_rows(courses, details, prices).orderBy("course_id").collect()
    assert tuple(one) == ("1", "T", "/t", "Udemy", "English", "Go", "Web | Data", "Expert", "$5", 7, 9, "Ann, Bo", "2024-01-01", "Dev", "2 total hours")
    assert tuple(two) == ("2", "", "", "Udemy", "", "", "SQL", "", "", 0, None, "", "", "", "")


def test_api_page_rows(frame):
    api = {"slug": "ml", "name": "ML", "primaryLanguages": ["fr"], "description": "api", "courseType": "s12n", "instructorIds": ["2", "9", "1"],
           "domainTypes": [{"subdomainId": "data-science"}, {"domainId": "it"}, {"subdomainId": "data-science"}]}
    html = (
        '<script type="application/ld+json">{"@type":"Course","description":"page","aggregateRating":{"ratingValue":"4.8","reviewCount":"12"},'
        '"offers":{"category":"Free"},"educationalLevel":"Beginner level"}</script><script>{"estimatedWorkload": "3 h\\u002Fweek",'
        '"updatedAt":"2024-02-03T00:00:00Z"}</script><p>1,234 already enrolled</p>'
    )
    got = extract.api_page_rows(
        frame([("1", json.dumps(api)), ("2", "{}")], "course_id string, json string"), frame([("1", html)], "course_id string, html string"),
        frame([("1", "Ann"), ("2", "Bo")], "id string, name string"), "https://x/learn",
    ).orderBy("course_id").collect()
    assert tuple(got[0]) == (
        "1", "ML", "https://x/learn/ml", "Coursera", "French", "page", "Data Science, It", "Beginner", "Free", 12, 1234, "Bo, Ann",
        "2024-02-03", "Specialization", "3 h/week",
    )
    assert tuple(got[1])[3:] == ("Coursera", "", "", "", "Unknown", "Free (Audit) / Paid (Certificate)", None, None, "", "", "Course", "")


def test_nested_records_are_read_by_many_tasks(frame):
    """The joined records of one split are dealt out before they are parsed, and every one of them is read."""
    hits = frame([(f"s{i}", json.dumps({"title": f"T{i}"})) for i in range(40)], "slug string, hit string").coalesce(1)
    pages = frame([(f"s{i}", json.dumps({"pageProps": {"duration": f"{i} weeks"}})) for i in range(20)], "slug string, page string").coalesce(1)
    got = extract.nested_rows(hits, pages, "https://s.org")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("regexp_extract_all") < plan.index("RepartitionByExpression") < plan.index("Join")
    assert sorted((r["Course_Title"], r["Duration"]) for r in got.collect()) == sorted((f"T{i}", f"{i} weeks" if i < 20 else None) for i in range(40))


def test_nested_rows(frame):
    hit = {"id": "k1", "name": "N", "catalogUrl": "https://site.org/course/n", "isProgramFree": True, "skills": ["SQL", "taxonomy:1"],
           "rating": 4.5, "instructors": [{"name": "Ann"}]}
    page = {"pageProps": {"reviewCount": 8, "programSummary": {"duration": "3 weeks"}, "deep": {"taughtSkill": {"name": "Go"}, "studentTotal": 55},
                          "mentors": [{"name": "Cy"}]}}
    got = extract.nested_rows(
        frame([("n", json.dumps(hit)), ("m", json.dumps({"title": "M"}))], "slug string, hit string"),
        frame([("n", json.dumps(page))], "slug string, page string"), "https://site.org",
    ).orderBy("Course_Title").collect()
    assert tuple(got[1]) == (
        "k1", "N", "https://site.org/course/n", "Udacity", None, None, "Go, SQL", None, "Free", "8 (avg 4.5)", "55", "Ann, Cy", None, None, "3 weeks"
    )
    assert tuple(got[0])[:3] == ("m", "M", "https://site.org/course/m")


def test_hit_slug(values):
    given = ['{"slug":"s"}', '{"u":"https://x/school/abc?z"}', '{"u":"/none"}']
    assert values(extract.hit_slug, given) == ["s", "abc", None]


OBSERVED = checks.TableChecks(
    not_null=["a", "b"], accepted={"b": ["x", "y"]}, ranges=[("n", 0, 5, "warn"), ("n", None, 3, "error")], keys=[("a",)])


@pytest.mark.parametrize("data", [[(1, "x", 2), (None, "z", 9), (2, None, -1), (2, "y", None)], [], [(1, "x", 1)]])
def test_checks_counted_while_writing(frame, data):
    df = frame(data, "a int, b string, n int").repartition(3)
    observer = checks.Observer({"t": OBSERVED})
    written = stage(observer.watch(df, "t"), "observed")
    seen = checks.run_table_checks("t", {"t": written}, OBSERVED, observer.failures("t"))
    assert rows(seen) == rows(checks.run_table_checks("t", {"t": written}, OBSERVED))
    assert observer.failures("u") is None and observer.watch(df, "u") is df


def test_observed_checks_read_no_table_for_row_tests(frame):
    written = stage(frame([(1, "x", 2)], "a int, b string, n int"), "observed")
    only_rows = checks.TableChecks(not_null=["a"], accepted={"b": ["x"]})
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation")
    assert scans(checks.run_table_checks("t", {"t": written}, only_rows)) == 1
    assert scans(checks.run_table_checks("t", {"t": written}, only_rows, [0, 0])) == 0
