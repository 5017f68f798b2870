"""Column functions on small inputs, results worked out by hand."""

import html
import json
import math
import random
import re
import time
from datetime import date
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from starloom.functions.core import exact_avg, exact_sum, whole_number
from starloom.functions import arith, fixed, keys, records, scores, standard, text, times, urls


def test_language(values):
    given = ["en-US", "Farsi", "nb-NO", " en ", None, "ENGLISH", "tlh"]
    assert values(standard.standardize_language, given) == [
        "English", "Persian", "Norwegian", "Other / Unknown", None, "English", "Other / Unknown"
    ]


def test_every_language_code(values):
    given = [(c, n) for n, codes in fixed.LANGUAGES.items() for c in codes]
    assert values(standard.standardize_language, [c for c, _ in given]) == [n for _, n in given]
    assert len(fixed.LANGUAGES) == 31


@pytest.mark.parametrize("raw, hours", [
    ("20 minutes", 0.33), ("5 hours", 5.0), ("2 hr", 2.0), ("7.5", 7.5), ("", None), ("  ", None), (None, None),
    ("3 weeks", None), ("5 hours 30 minutes", 0.08), ("Approx. 5 hours", None), ("Approx 5 hours", 5.0), ("1.2.3", None),
])
def test_duration(values, raw, hours):
    assert values(times.parse_duration, [raw]) == [hours]


def test_duration_variants(values):
    leading = lambda c: times.parse_duration(c, leading_only=True)
    assert values(leading, ["5 hours", "Approx 5 hours", "30 min", "8", "x"]) == [5.0, 0.0, 0.5, 8.0, None]
    strict = lambda c: times.parse_duration(c, strict=True)
    assert values(strict, ["5 hours 30 minutes", "30 minutes", "2 hours"]) == [5.5, 0.5, 2.0]


def test_levels_and_models(values):
    assert values(standard.standardize_level, [" Beginner Level ", "EXPERT", "mixed", "guru", None]) == [
        "Beginner", "Advanced", "All Levels", "Unknown", "Unknown"
    ]
    assert values(standard.standardize_price_model, ["Subscription", "monthly_subscription", "one time", " one time", None]) == [
        "Subscription", "Subscription", "One Time", "Unknown", "Unknown"
    ]


def test_bands(values):
    prices = [0.0, 499.99, 500.0, 1999.99, 2000.0, 5000.0, None, -1.0]
    assert values(standard.price_band, prices, "double") == [
        "Free", "Cheap", "Medium", "Medium", "Expensive", "Premium", "Unknown", "Cheap"
    ]
    assert values(standard.duration_band, [4.9, 5.0, 20.0, 50.0, 0.0, None], "double") == [
        "Short", "Medium", "Long", "Extensive", "Short", "Unknown"
    ]
    clamp = lambda c: standard.clamp_to_null(c, 0, 5)
    assert values(clamp, [-1.0, 0.0, 5.0, 5.1, None], "double") == [None, 0.0, 5.0, None, None]


def test_scores(frame):
    df = frame(
        [(4.5, 1000, 50, 2000.0, 45.0, "Subscription"), (4.5, None, None, None, 0.0, "one time"), (None, 0, 5, 10.0, None, "one time")],
        "rating double, enrolled int, reviews int, price double, hours double, model string",
    )
    got = df.select(
        scores.popularity_score("rating", "enrolled"), scores.popularity_score("rating", "enrolled", True),
        scores.engagement_rate_pct("reviews", "enrolled"), scores.weighted_rating("rating", "reviews"),
        scores.cost_per_hour("price", "hours"), scores.estimated_total_cost("price", "hours", "model"),
        scores.estimated_total_cost("price", "hours", "model", needs_hours=False),
    ).collect()
    assert tuple(got[0]) == (31.09, 31.09, 5.0, 17.69, 44.44, 4000.0, 4000.0)
    assert tuple(got[1]) == (None, 0.0, None, 0.0, None, None, None)
    assert tuple(got[2]) == (None, None, None, None, None, None, 10.0)


def test_engagement_without_reviews(frame):
    df = frame([(None, 10), (None, 0), (3, None)], "reviews int, enrolled int")
    local = [r[0] for r in df.select(scores.engagement_rate_pct("reviews", "enrolled")).collect()]
    cloud = [r[0] for r in df.select(scores.engagement_rate_pct("reviews", "enrolled", False)).collect()]
    assert local == [0.0, None, None] and cloud == [None, None, None]


def test_value_score_signs(frame):
    df = frame([(4.0, 99, 0.0), (4.0, 99, -2.0), (4.0, 99, 2.0), (4.0, 99, None)], "r double, e int, c double")
    guarded = [r[0] for r in df.select(scores.value_score("r", "e", "c")).collect()]
    free = [r[0] for r in df.select(scores.value_score("r", "e", "c", positive_cost_only=False)).collect()]
    assert guarded == [None, None, 9.21, None] and free == [None, -9.21, 9.21, None]


def test_safe_arithmetic(frame):
    df = frame([(1, 2, 3), (1, None, 3), (None, 2, 2), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(arith.safe_add(["a", "b", "c"])).collect()] == [6, 4, 4, 0]
    df = frame([(3, 2, 1), (4, None, 3), (None, 2, None), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(arith.safe_subtract(["a", "b", "c"])).collect()] == [0, 1, -2, 0]
    df = frame([(6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, None), (None, 9), (0, 5)], "n int, d int")
    assert [r[0] for r in df.select(arith.safe_divide("n", "d")).collect()] == [None, 2, None, None, None, None, None, 0]
    with pytest.raises(ValueError):
        arith.safe_add("a")


def test_width_bucket(values):
    amounts = [190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 610000.0, 600000.0]
    bucket = lambda c: arith.width_bucket(c, 200000, 600000, 4)
    assert values(bucket, amounts, "double") == [0, 1, 2, 2, 3, 3, 4, 5, 5]


def test_haversine(frame):
    df = frame([(48.864716, 2.349014, 52.379189, 4.899431)], "a double, b double, c double, d double")
    miles, km = df.select(
        F.round(arith.haversine_distance("a", "b", "c", "d"), 0), F.round(arith.haversine_distance("a", "b", "c", "d", "km"), 0)
    ).first()
    assert (miles, km) == (267, 430)
    with pytest.raises(ValueError):
        arith.haversine_distance("a", "b", "c", "d", "ly")


def test_exact_sums(spark):
    rng = random.Random(5)
    given = [round(rng.uniform(-10**6, 10**6), rng.randrange(7)) for _ in range(3000)] + [None, 0.0, -0.25, 1e11]
    rows = [(i % 3, x) for i, x in enumerate(given)]
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "k int, x double").repartition(parts)
        got = {r[0]: (r[1], r[2]) for r in df.groupBy("k").agg(exact_sum("x"), exact_avg("x")).collect()}
        for k, (total, mean) in got.items():
            members = [Decimal(repr(x)) for i, x in rows if i == k and x is not None]
            assert total == float(sum(members)) and mean == float(sum(members)) / len(members)
    assert spark.range(0).agg(exact_avg(F.lit(1.0))).first()[0] is None


@pytest.mark.parametrize(("given", "mean"), [
    ([4e-7], 4e-7), ([1e13, 3e13], 2e13), ([1e25, 3e25], 2e25), ([1e-30, 3e-30], 2e-30), ([float("inf"), 1.0], float("inf")), ([None], None)])
def test_averages_of_tiny_and_huge_values(frame, given, mean):
    assert frame([(x,) for x in given], "x double").agg(exact_avg("x")).first()[0] == mean


def test_average_with_nan(frame):
    assert math.isnan(frame([(1.0,), (float("nan"),)], "x double").agg(exact_avg("x")).first()[0])


def test_whole_numbers_with_a_point(values):
    given = ["12", "12.0", " 7.5 ", "-7.5", "1e3", "x", "", None, "99999999999"]
    assert values(whole_number, given) == [12, 12, 8, -8, 1000, None, None, None, None]


def test_visible_text_leaves_out_scripts(values):
    page = "<script>var a='5 students here'</script><!-- 6 students --><style>7 students</style><p>9 students</p>"
    assert values(text.visible_text, [page, None]) == ["9 students", ""]
    assert values(records.enrolment_count, [page]) == [9]


def test_surrogate_key(frame):
    df = frame([("a", "b", "c"), (None, "b", None)], "x string, y string, z string")
    got = [r[0] for r in df.select(keys.surrogate_key(["x", "y", "z"])).collect()]
    import hashlib

    token = fixed.SURROGATE_NULL
    assert got == ["7b193b3d33184464106f41ddf733783b", hashlib.md5(f"{token}-b-{token}".encode()).hexdigest()]
    empty = df.select(keys.surrogate_key(["x", "y", "z"], nulls_as_empty=True)).collect()[1][0]
    assert empty == hashlib.md5(b"-b-").hexdigest()


def test_urls(values):
    hosts = {
        "shop.example.co.uk?utm_source=a&b=c": "shop.example.co.uk", "http://blog.example.com/2018/01/x/": "blog.example.com",
        "android-app://m.example.com/": "m.example.com", "docs.example.com/a?b": "docs.example.com",
    }
    assert values(urls.url_host, list(hosts)) == list(hosts.values())
    paths = {
        "shop.example.co.uk?utm_source=a&b=c": "", "http://blog.example.com/2018/01/x/": "2018/01/x/",
        "https://blog.example.com/2018/x?u=v": "2018/x", "nothing": "nothing",
    }
    assert values(urls.url_path, list(paths)) == list(paths.values())
    medium = lambda c: urls.url_parameter(c, "utm_medium")
    assert values(medium, ["http://a.b/c?utm_medium=organic", "a?xutm_medium=z&b=1", "a?utm_medium=&b", "a", None]) == [
        "organic", "z", None, None, None
    ]
    slugs = {"https://x/course/abc/?q#f": "abc", "/degree/d1#x": "d1", "https://x/school/s/": "s", "https://x/y": None,
             "/course/a/course/b": "a"}
    assert values(urls.url_slug, list(slugs)) == list(slugs.values())


def test_feed_dates(values):
    assert values(times.parse_feed_date, ["1/2/2024", "12/31/2023", "2024-01-02", "13/1/2024", None]) == [
        date(2024, 1, 2), date(2023, 12, 31), None, None, None
    ]
    assert values(times.parse_iso_date, ["2024-01-02", "2024-01-02 10:00:00", "soon", None]) == [
        date(2024, 1, 2), date(2024, 1, 2), None, None
    ]


def test_page_dates(values):
    given = {
        "2024-03-05T10:11:12.345Z": "2024-03-05", "2024-03-05T10:11:12Z": "2024-03-05", "2024-03-05T10:11:12": "2024-03-05",
        "2024-03-05": "2024-03-05", "March 5, 2024": "2024-03-05", " Mar 5, 2024 ": "2024-03-05",
        "on 2024-03-05 at noon": "2024-03-05", "yesterday": None, "2024-3-5": "2024-03-05",
    }
    assert values(times.parse_page_date, list(given)) == list(given.values())


def test_hours_text_rounds_like_formatting(values):
    seconds = list(range(1, 40000, 7)) + [180 * k for k in range(1, 2000)] + [None, 0, 10**9 + 180]
    expected = ["" if not s else f"{s / 3600:.1f} hours" for s in seconds]
    assert values(times.hours_text, seconds, "bigint") == expected


def test_iso_durations(values):
    given = {
        "PT1H30M": "1 hour, 30 minutes", "P2W": "2 weeks", "P1Y2M": "1 year, 2 months", "PT45S": "45 seconds",
        "P1DT1M": "1 day, 1 minute", "about a day ": "about a day", "P": "P",
    }
    assert values(times.iso_duration_words, list(given)) == list(given.values())


def test_unescape_agrees_with_the_html_rules(values):
    rng = random.Random(7)
    pieces = ["&amp;", "&lt;", "&notit;", "&copy 2024", "&#233;", "&#x1F600;", "&#128;", "&#0;", "&#xD800;", "&#1114112;", "&#99999999999;",
              "&", "&;", "&unknown;", "text", "&ampamp;", "&CounterClockwiseContourIntegral;", "&#13;", "&#1;", "&nbsp;x", "é&eacute", "&#x;", "&&amp;"]
    texts = ["".join(rng.choices(pieces, k=6)) for _ in range(60)] + pieces
    assert values(text.unescape_html, texts) == [html.unescape(t) for t in texts]


def test_html_to_text(values):
    raw = "<p>Tom &amp; <b>Jerry</b> &lt;3</p>\n\n\t<br/>end "
    assert values(text.html_to_text, [raw, None, ""]) == ["Tom & Jerry <3 end", "", ""]


def _tags(words):
    """The rule, word by word."""
    low = words.lower()
    found = []
    for skill in fixed.SKILLS:
        if re.search(r"\b" + re.escape(skill.lower()) + r"\b", low) and skill not in found:
            found.append(skill)
    return found


def test_keyword_tags_agree_with_the_rule(values):
    rng = random.Random(3)
    glue = [" ", ", ", "-", "", "é", "_", "/", "."]
    texts = [
        "".join(w for s in rng.choices(fixed.SKILLS, k=8) for w in (s if rng.random() < 0.5 else s.upper(), rng.choice(glue)))
        for _ in range(300)
    ]
    texts += ["C++ and C#", "C++11 C#7", "react native", "Power BI", "r", "", "nothing here"]
    got = values(text.keyword_tags, texts)
    assert got == [_tags(t) for t in texts]


def test_skill_list(frame):
    df = frame(
        [([" Web ", "", "x" * 41], "Docker", "SQL"), (["x" * 41], "Docker", "SQL"), (None, "", "SQL"), (None, None, None)],
        "t array<string>, d string, h string",
    )
    assert [r[0] for r in df.select(text.skill_list("t", "d", "h")).collect()] == [["Web"], ["Docker"], ["SQL"], []]


def test_names(frame):
    uuid = "0a1b2c3d-0000-4000-8000-000000000000"
    df = frame([([" SQL", "sql", uuid, "Taxonomy:1", "", None, "Go"],)], "n array<string>")
    assert df.select(text.clean_names("n")).first()[0] == ["SQL", "Go"]
    df = frame([(["Ann, Instructor", "Bo ,Ann", "mentor", None],)], "n array<string>")
    assert df.select(text.clean_people("n")).first()[0] == ["Ann", "Bo"]


def test_slug_titles(values):
    assert values(lambda c: text.slug_to_title(F.col(c)), ["data-science", "web-3d", "o'neil-MBA"]) == [
        s.replace("-", " ").title() for s in ["data-science", "web-3d", "o'neil-MBA"]
    ]


def test_free_text(values):
    assert values(text.is_free_text, [" Free ", "0", "", "$9", None]) == [True, True, True, False, False]


def test_first_non_blank(frame):
    df = frame([(None, " ", "c"), ("a", "b", "c"), (None, None, " ")], "a string, b string, c string")
    assert [r[0] for r in df.select(text.first_non_blank("a", "b", "c")).collect()] == ["c", "a", None]


def test_page_vocabularies(values):
    assert values(records.page_level, ["Beginner friendly", "INTERMEDIATE level", "?", None]) == [
        "Beginner", "Intermediate", "Unknown", "Unknown"
    ]
    assert values(records.course_type, ["s12n", " Guided Project ", "other", None]) == [
        "Specialization", "Guided Project", "Course", "Course"
    ]
    assert values(records.page_language, ["en", "xx-YY", "", None]) == ["English", "Xx-yy", "", ""]
    assert values(records.page_price, ["$5", "", None]) == ["$5", fixed.DEFAULT_PRICE, fixed.DEFAULT_PRICE]
    assert values(records.locale_name, ['{"simpleEnglishTitle":"English"}', '{"locale":"fr_FR"}', "German", None]) == [
        "English", "fr_FR", "German", ""
    ]


@pytest.mark.parametrize(("record", "names"), [
    ('{"skills":["SQL","C [adv]"]}', ["SQL", "C [adv]"]),
    ('{"skills":["a",["b"]]}', ["a"]),
    ('{"skills":[{"name":"P","meta":{"k":["z"]}},"Q"]}', ["P", "Q"]),
    ('{"x":[[{"mainSkill":{"title":" ","label":"L","sub":{"skillTag":"deep"}}}]]}', ["L", "deep"]),
    ('{"t":"\\"skill\\": \\"no\\"","skill":"a \\"q\\" \\u0041"}', ['a "q" A']),
    ('{"skill":null,"Skill2":7,"skill3":[],"skill4":{}}', []),
    ("", []), ("no json", []), (None, None),
])
def test_json_collect(frame, record, names):
    got = frame([(record,)], "j string").select(records.json_collect("j", ["skill"])).first()[0]
    assert got == names


def test_names_of_people_and_plain_texts(frame):
    df = frame([('{"p":[{"fullName":"Ann","l":[1]},"Bo",["x"]],"q":{"title":"T"},"s":" solo ","skills":["a","a",{"name":"b"}," c "]}',)], "j string")
    people = lambda path, lists: records.json_names("j", path, records.PERSON_NAMES, lists)
    got = df.select(people("$.p", True), people("$.q", False), people("$.s", False), people("$.q", True), people("$.none", False),
                    records.json_plain_texts("j", "$.skills")).first()
    assert list(got) == [["Ann", "Bo"], ["T"], [" solo "], [], [], ["a", "a", " c "]]


def test_json_find(values):
    find = lambda c: records.json_find(c, ["lang"])
    given = {
        '{"a":{"userLang":null,"x":[{"LANGUAGE":"fr"}]},"lang":"en"}': "fr",
        '{"lang":{"z":1},"b":{"lang2":7}}': "7",
        '{"lang":" ","say":"\\"lang\\": \\"no\\"","langs":"a\\"b"}': 'a"b',
        '{"x":1}': None,
    }
    assert values(find, list(given)) == list(given.values())


def test_offer_prices(values):
    given = {
        '{"price":"49"}': "$49.00", '{"price":10.5,"priceCurrency":"EUR"}': "10.50 EUR", '{"price":"0"}': "Free",
        '{"price":"0.0"}': "Free", '{"price":"ask"}': "ask", '{"category":"Partially Free"}': fixed.DEFAULT_PRICE,
        '{"category":" Paid "}': "Paid (Subscription)", '{"category":"Rent"}': "Rent", "{}": "Free",
    }
    assert values(records.offer_price, list(given)) == list(given.values())


def test_json_ld_choice(values):
    def page(*blocks):
        return "<html>" + "".join(f'<script type="application/ld+json">{b}</script>' for b in blocks) + "</html>"

    kind = lambda c: records.json_text(records.json_ld(c), "$.name")
    given = [
        page('{"@type":"BreadcrumbList"}', '{"@type":"Course","name":"a"}'),
        page("not json", '[{"@type":"Organization"},{"@type":"Product","name":"b"}]'),
        page('[{"@type":"WebPage","name":"x"}]', '{"@type":"WebPage","name":"c"}'), "<html></html>",
    ]
    assert values(kind, given) == ["a", "b", "c", None]


def test_audience(values):
    given = ["<b>1,234</b> already enrolled", "12 Students and 5 enrolled", "7 learners", "none"]
    assert values(records.enrolment_count, given) == [1234, 5, 7, None]


def plain_walk(value, words):
    """(key found, value) of every key that contains a word, at any depth, in document order."""
    if isinstance(value, dict):
        for k, v in value.items():
            if any(w in k.lower() for w in words):
                yield v
            yield from plain_walk(v, words)
    elif isinstance(value, list):
        for v in value:
            yield from plain_walk(v, words)


def some_json(rng, depth=0):
    kind = rng.randrange(9 if depth < 5 else 6)
    if kind < 2:
        return rng.choice(["", " ", "plain", 'q"uo\\te', "a: {b", "]}", "ünï ☃", "line\nbreak", "\\", 'x":'])
    if kind < 4:
        return rng.choice([0, -1, 2.5, 10**12, True, False])
    if kind == 4:
        return None
    if kind == 5:
        return rng.choice([{}, []])
    if kind == 6:
        return [some_json(rng, depth + 1) for _ in range(rng.randrange(5))]
    return {rng.choice(["lang", "LANGuage ", "x", "na\"me", "skill[", "}", "name", "skillName", "title"]) + str(i): some_json(rng, depth + 1)
            for i in range(rng.randrange(5))}


def test_json_walk_equals_a_plain_one(frame):
    rng = random.Random(21)
    records_ = [some_json(rng) for _ in range(600)]
    texts = [json.dumps(x, ensure_ascii=i % 2 == 0, indent=rng.choice([None, 1]), separators=rng.choice([(",", ":"), (" , ", " : ")]))
             for i, x in enumerate(records_)]
    got = frame(list(enumerate(texts)), "i int, j string").select(
        "i", records.json_values("j", ["lang", "skill"]).alias("v"), records.json_find("j", ["lang"]).alias("f")).orderBy("i").collect()
    for record, r in zip(records_, got, strict=True):
        want = list(plain_walk(record, ["lang", "skill"]))
        assert len(r.v) == len(want)
        for x, w in zip(r.v, want):
            if isinstance(w, (dict, list)):
                assert x.kind in "{[" and json.loads(x.value) == w
            elif isinstance(w, str):
                assert (x.kind, x.value or "") == ('"', w)
            else:
                assert w is None and x.value is None or json.loads(x.value) == w
        plain = [w for w in plain_walk(record, ["lang"]) if not isinstance(w, (dict, list)) and w is not None and str(w).strip()]
        assert r.f == (None if not plain else plain[0] if isinstance(plain[0], str) else json.dumps(plain[0]))


def test_json_walk_of_records_that_are_none(values):
    for broken in ("", "   ", "no json", '{"lang"', '{"lang":', '{"lang": [1, 2', '{"lang": "open', "}}]]", None):
        assert values(lambda c: records.json_find(c, ["lang"]), [broken]) == [None]
        assert values(lambda c: F.size(records.json_collect(c, ["lang"])), [broken])[0] in (0, None, -1)


def test_json_walk_grows_with_the_record(frame):
    """Four times the keys take about four times the time, not sixteen times."""
    def seconds(n):
        record = json.dumps([{"skills": [{"name": f"n{i}"}, "t"], "lang": ""} for i in range(n)])
        df = frame([(record,)], "j string").select(F.size(records.json_collect("j", ["skill"])), records.json_find("j", ["lang"]))
        times = []
        for _ in range(3):
            begun = time.perf_counter()
            assert df.first()[0] == 2 * n
            times.append(time.perf_counter() - begun)
        return min(times)

    seconds(1000)
    small, large = seconds(8000), seconds(32_000)
    assert large < 8 * small + 1


def test_exact_sums_of_any_sizes_under_any_partitioning(spark):
    rng = random.Random(9)
    given = [rng.choice([-1, 1]) * rng.uniform(1, 10) * 10.0 ** rng.choice([-10, -3, 0, 6, 13, 20]) for _ in range(4000)] + [1e-10, 1e13, 1e20, 1 / 3]
    rows = [(i % 3, x) for i, x in enumerate(given)] + [(3, 1e20), (3, 1e-10), (3, -1e20), (4, -1 / 3), (4, 1e13), (4, -1e13), (5, None), (6, -0.0)]
    found = set()
    for parts in (1, 3, 16):
        df = spark.createDataFrame(rows, "k int, x double").repartition(parts)
        found.add(tuple(sorted((r[0], r[1]) for r in df.groupBy("k").agg(exact_sum("x")).collect())))
    assert len(found) == 1
    for k, total in found.pop():
        members = [Fraction(x) for i, x in rows if i == k and x is not None]
        want = float(sum(members)) if members else None
        assert total == want or abs(total - want) <= 1e-15 * abs(want)
