"""Raw course records of the three sites to the 15-column raw row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import records
from ..functions.core import blank_to_null, col
from ..functions.text import (
    clean_names, clean_people, first_non_blank, html_to_text, is_opaque_id, skill_list, slug_to_title,
)
from ..functions.times import hours_text
from ..functions.urls import url_site_path, url_slug
from ..operators.joins import names_for_ids

TEXTS = "array<string>"


# --- site with a course list, a details call and a price call ---------------------------------

COURSE_SCHEMA = (
    "title string, urlCourseLanding string, updatedOn string, isFree boolean, durationInSeconds string, level string, "
    "locale string, rating struct<count: string>, instructors array<struct<name: string>>, headline string"
)
DETAIL_SCHEMA = (
    "description string, num_subscribers string, instructional_level string, content_info string, "
    "primary_subcategory struct<title: string>, topics array<string>"
)
PRICE_SCHEMA = "price struct<price_string: string>"


def _parsed(df: DataFrame, key: str, source: str, schema: str, name: str) -> DataFrame:
    """Key and record parsed once with the fields that are used."""
    return df.select(key, F.from_json(source, schema).alias(name))


def listing_rows(courses: DataFrame, details: DataFrame, prices: DataFrame) -> DataFrame:
    """Merge three raw JSON tables ``(course_id, json)`` to raw rows.

    Every listed course gives a row; details and prices fill in where they exist.
    """
    merged = (
        _parsed(courses, "course_id", "json", COURSE_SCHEMA, "c")
        .join(_parsed(details, "course_id", "json", DETAIL_SCHEMA, "d"), "course_id", "left")
        .join(_parsed(prices, "course_id", "json", PRICE_SCHEMA, "p"), "course_id", "left")
    )
    names = F.transform(F.col("c.instructors"), lambda i: F.trim(i["name"]))
    # A topic is an object with a title or plain text.
    titles = F.transform(
        F.col("d.topics"),
        lambda t: F.when(F.startswith(t, F.lit("{")), records.json_text(t, "$.title")).otherwise(t),
    )
    return merged.select(
        "course_id",
        F.coalesce("c.title", F.lit("")).alias("Course_Title"),
        F.coalesce("c.urlCourseLanding", F.lit("")).alias("Course_URL"),
        F.lit("Udemy").alias("Platform"),
        records.locale_name("c.locale").alias("Language"),
        html_to_text("d.description").alias("Description"),
        F.array_join(skill_list(titles, "d.description", "c.headline"), " | ").alias("Skills"),
        F.coalesce(blank_to_null("d.instructional_level"), "c.level", F.lit("")).alias("Level"),
        F.coalesce("p.price.price_string", F.when(F.col("c.isFree"), "Free").otherwise("")).alias("Price"),
        F.coalesce(F.col("c.rating.count").try_cast("long"), F.lit(0)).alias("No_of_Reviews"),
        F.col("d.num_subscribers").try_cast("long").alias("No_of_Students_enrolled"),
        F.coalesce(F.array_join(F.filter(names, lambda n: n != ""), ", "), F.lit("")).alias("Programming_Instructor"),
        F.coalesce("c.updatedOn", F.lit("")).alias("Last_Update"),
        F.coalesce("d.primary_subcategory.title", F.lit("")).alias("Type_of_Course"),
        F.coalesce(
            blank_to_null("d.content_info"), hours_text(F.col("c.durationInSeconds").try_cast("long"))
        ).alias("Duration"),
    )


# --- site with an API record and a course page ----------------------------------------------------

API_SCHEMA = (
    "slug string, name string, primaryLanguages array<string>, description string, courseType string, "
    "instructorIds array<string>, domainTypes array<struct<domainId: string, subdomainId: string>>"
)


def page_rows(pages: DataFrame, key: str = "course_id", html: str = "html") -> DataFrame:
    """Fields of course pages: JSON-LD first, embedded state second, visible text last."""
    parsed = pages.select(key, html, records.json_ld(html).alias("__text")).select(
        key, html, records.parse_json_ld("__text").alias("__ld")
    )
    ld = records.page_json_ld_fields("__ld")
    state = records.embedded_state_fields(html)
    return parsed.select(
        key, ld["description"].alias("description"), ld["avg_rating"].alias("avg_rating"),
        F.coalesce(ld["rating_count"], state["rating_count"]).alias("rating_count"),
        ld["price"].alias("price"),
        F.coalesce(ld["last_update"], state["last_update"]).alias("last_update"),
        F.coalesce(ld["duration"], state["duration"]).alias("duration"),
        ld["level"].alias("level"), records.enrolment_count(html).alias("enrollment_count"),
    )


def api_page_rows(api: DataFrame, pages: DataFrame, instructors: DataFrame, page_base: str) -> DataFrame:
    """Merge API records ``(course_id, json)`` with pages ``(course_id, html)`` to raw rows.

    ``instructors`` holds ``(id, name)``; names come in the order of the record's ids.
    """
    page = page_rows(pages)
    page = page.select("course_id", F.struct(*[c for c in page.columns if c != "course_id"]).alias("page"))
    merged = _parsed(api, "course_id", "json", API_SCHEMA, "a").withColumn("__ids", F.col("a.instructorIds"))
    merged = names_for_ids(merged, "course_id", "__ids", instructors, "id", "name", "__instructors")
    skills = F.transform(
        F.col("a.domainTypes"), lambda t: slug_to_title(F.coalesce(blank_to_null(t["subdomainId"]), t["domainId"]))
    )
    named = F.array_distinct(F.filter(skills, lambda s: s != ""))
    return merged.join(page, "course_id", "left").select(
        "course_id",
        F.coalesce("a.name", F.lit("")).alias("Course_Title"),
        F.coalesce(F.concat(F.lit(f"{page_base}/"), blank_to_null("a.slug")), F.lit("")).alias("Course_URL"),
        F.lit("Coursera").alias("Platform"),
        records.page_language(F.try_element_at("a.primaryLanguages", F.lit(1))).alias("Language"),
        F.coalesce("page.description", blank_to_null("a.description"), F.lit("")).alias("Description"),
        F.coalesce(F.array_join(named, ", "), F.lit("")).alias("Skill"),
        records.page_level("page.level").alias("Level"),
        records.page_price("page.price").alias("Price"),
        F.col("page.rating_count").alias("No. of Reviews / Ratings"),
        F.col("page.enrollment_count").alias("No. of Students enrolled"),
        F.col("__instructors").alias("Programming Instructor"),
        F.coalesce("page.last_update", F.lit("")).alias("Last_Update"),
        records.course_type("a.courseType").alias("Type_of_Course"),
        F.coalesce("page.duration", F.lit("")).alias("Duration"),
    )


# --- site with a search hit and a nested page record -----------------------------------------------

# The lists of a hit, and the fields read of every object.
_LISTS = ["skills", "skillNames", "allSkills", "relatedSkills", "taughtSkills"]
_HIT_FIELDS = [
    "key", "id", "title", "name", "url", "catalogUrl", "path", "courseUrl", "programUrl", "absolute_url",
    "reviewCount", "reviewStarsAverage", "rating", "description", "summary", "language", "locale", "lang",
    "enrollment", "enrollmentCount", "studentCount", "studentsEnrolled", "learnerCount", "lastUpdated",
    "updatedAt", "lastModified", "semanticType", "type", "duration", "difficulty", "level", "isFree",
    "isProgramFree", "instructors",
]
_DETAIL_FIELDS = [
    "title", "programKey", "courseId", "reviewCount", "reviewStarsAverage", "description", "summary",
    "language", "locale", "enrollmentCount", "studentCount", "lastUpdated", "updatedAt", "semanticType",
    "duration", "difficulty", "isFree", "isProgramFree",
]
_SUMMARY_FIELDS = [
    "key", "language", "enrollmentCount", "studentCount", "lastUpdated", "semanticType", "duration",
    "difficultyLevel",
]
_PAGE_FIELDS = [
    "title", "programKey", "programId", "courseId", "reviewCount", "reviewStarsAverage", "description",
    "language", "locale", "lang", "enrollmentCount", "studentCount", "studentsEnrolled", "learnerCount",
    "lastUpdated", "updatedAt", "lastModified", "semanticType", "courseType", "duration",
    "difficultyLevel", "isFree", "isProgramFree",
]


def _texts(names: list[str]) -> str:
    return ", ".join(f"{n}: string" for n in names)


HIT_SCHEMA = f"struct<{_texts(_HIT_FIELDS)}>"
NESTED_SCHEMA = (
    f"struct<pageProps: struct<{_texts(_PAGE_FIELDS)}, "
    f"staticProgramDetailsSectionProps: struct<{_texts(_DETAIL_FIELDS)}>, "
    f"programSummary: struct<{_texts(_SUMMARY_FIELDS)}>, "
    "catalogProgramProps: struct<title: string, duration: string>, "
    "seoProps: struct<title: string, description: string, inLanguage: string>>>"
)


def _pick(places: Sequence[str], *last: Column) -> Column:
    """First non-blank of several places."""
    return first_non_blank(*places, *last)


def nested_rows(hits: DataFrame, pages: DataFrame, site: str) -> DataFrame:
    """Merge search hits ``(slug, hit)`` with nested page records ``(slug, page)`` to raw rows.

    Every field is looked for along a chain of places; language, students and last update
    fall back to the first matching key anywhere in the record. Hits without a page record
    give the shorter fallback row.
    """
    none = F.array().cast(TEXTS)
    # Reading a record costs far more than moving it: a small file is one split, and would be read by one task.
    merged = hits.join(pages, "slug", "left").select("slug", "hit", "page").repartition("slug", "hit", "page")
    parsed = merged.select(
        "slug", "hit", "page", records.json_tokens("page").alias("tokens"), F.from_json("hit", HIT_SCHEMA).alias("h"),
        F.from_json("page", NESTED_SCHEMA).getField("pageProps").alias("g"),
    )
    # Every nested object under a short name: h hit, g page, d details, s summary, c catalogue, e search text.
    both = parsed.select(
        "slug", "hit", "page", "tokens", "h", "g", F.col("g.staticProgramDetailsSectionProps").alias("d"),
        F.col("g.programSummary").alias("s"), F.col("g.catalogProgramProps").alias("c"), F.col("g.seoProps").alias("e"),
        records.json_names("hit", "$.instructors", records.PERSON_NAMES, lists_only=False).alias("people"),
    )
    known = F.col("page").isNotNull()
    path = url_site_path(
        ["h.url", "h.catalogUrl", "h.path", "h.courseUrl", "h.programUrl", "h.absolute_url"], site,
        F.concat(F.lit("/course/"), F.col("slug")),
    )
    reviews = _pick(["h.reviewCount", "g.reviewCount", "d.reviewCount"])
    rating = _pick(["h.reviewStarsAverage", "h.rating", "g.reviewStarsAverage", "d.reviewStarsAverage"])
    listed = F.filter(records.json_plain_texts("hit", "$.skills"), lambda s: ~is_opaque_id(s))
    skills = clean_names(F.concat(
        F.coalesce(records.collect_in("tokens", ["skill"]), none), *[records.json_names("hit", f"$.{n}", records.SKILL_NAMES) for n in _LISTS]
    ))
    everyone = F.concat(
        "people", F.coalesce(records.collect_in("tokens", ["instructor", "mentor"], records.PERSON_NAMES), none))
    # The places of every field, in the order they are tried.
    return both.select(
        _pick(["h.key", "h.id", "g.programKey", "g.programId", "g.courseId", "d.programKey", "d.courseId", "s.key"], F.col("slug")
        ).alias("course_id"),
        _pick(["h.title", "h.name", "g.title", "d.title", "c.title", "e.title"]).alias("Course_Title"),
        F.concat(F.lit(site), path).alias("Course_URL"),
        F.lit("Udacity").alias("Platform"),
        _pick([
            "h.language", "h.locale", "h.lang", "g.language", "g.locale", "g.lang", "d.language", "d.locale",
            "e.inLanguage", "s.language",
        ],
            records.find_in("tokens", ["language", "locale", "lang"]),
        ).alias("Language"),
        F.trim(_pick(["h.description", "h.summary", "g.description", "d.description", "d.summary", "e.description"])).alias("Description"),
        blank_to_null(F.array_join(F.when(known, skills).otherwise(listed), ", ")).alias("Skill"),
        _pick(["h.difficulty", "h.level", "g.difficultyLevel", "d.difficulty", "s.difficultyLevel"]).alias("Level"),
        F.when(
            _pick(["h.isFree", "h.isProgramFree", "g.isFree", "g.isProgramFree", "d.isFree", "d.isProgramFree"]) == "true", "Free"
        ).alias("Price"),
        F.when(
            known,
            F.when(reviews.isNotNull() & rating.isNotNull(), F.concat(reviews, F.lit(" (avg "), rating, F.lit(")")))
            .otherwise(reviews),
        ).otherwise(_pick(["h.reviewCount", "h.rating"])).alias("No. of Reviews / Ratings"),
        _pick([
            "h.enrollment", "h.enrollmentCount", "h.studentCount", "h.studentsEnrolled", "h.learnerCount",
            "g.enrollmentCount", "g.studentCount", "g.studentsEnrolled", "g.learnerCount", "d.enrollmentCount",
            "d.studentCount", "s.enrollmentCount", "s.studentCount",
        ],
            records.find_in("tokens", ["enroll", "student", "learner"]),
        ).alias("No. of Students enrolled"),
        blank_to_null(F.array_join(F.when(known, clean_people(everyone)).otherwise(F.col("people")), ", "))
        .alias("Programming Instructor"),
        _pick([
            "h.lastUpdated", "h.updatedAt", "h.lastModified", "g.lastUpdated", "g.updatedAt", "g.lastModified",
            "d.lastUpdated", "d.updatedAt", "s.lastUpdated",
        ],
            records.find_in("tokens", ["updated", "modified"]),
        ).alias("Last Update"),
        _pick(["h.semanticType", "h.type", "g.semanticType", "g.courseType", "d.semanticType", "s.semanticType"]).alias("Type of Course"),
        _pick(["d.duration", "s.duration", "c.duration", "g.duration", "h.duration"]).alias("Duration"),
    )


def hit_slug(hit: Column | str) -> Column:
    """Slug of a search hit: its own, else from the first course, school or degree URL in it."""
    values = F.regexp_extract_all(col(hit), F.lit(r'"[^"]*"\s*:\s*"([^"]*/(?:course|school|degree)/[^"]*)"'), F.lit(1))
    return F.coalesce(blank_to_null(records.json_text(hit, "$.slug")), url_slug(F.try_element_at(values, F.lit(1))))


