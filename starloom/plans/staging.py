"""Raw course feeds to canonical rows: rename, cast, trim, keep the latest row per id."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.core import whole_number
from ..functions.standard import standardize_language
from ..functions.text import is_free_text, rewrite_delimiter
from ..functions.times import parse_duration, parse_feed_date, parse_iso_date
from ..operators.shape import align_schema, deduplicate, gathered, keep_last, union_by_name
from .rules import DEFAULT, Rules


@dataclass(frozen=True)
class Feed:
    """How one feed names its columns. Every entry lists the accepted names, first found wins."""

    platform: str
    columns: Mapping[str, tuple[str, ...]]
    iso_dates: bool = False
    skill_delimiter: str | None = None
    numeric_ids_only: bool = False
    id_required: bool = False
    # Alignment of the scraped file to the feed contract.
    rename: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)


# --- fixed values: the feed contracts, names of either dialect -----------------------------
COURSERA = Feed(
    platform="Coursera",
    columns={
        "course_id": ("course_id",),
        "title": ("Course_Title",),
        "course_url": ("Course_URL",),
        "language": ("Language",),
        "description": ("Description",),
        "skills": ("Skill",),
        "level": ("Level",),
        "instructor": ("Instructor",),
        "domain_name": ("Domain_Name",),
        "last_updated": ("Last_Update",),
        "duration_raw": ("Duration",),
        "review_count": ("No. of Reviews", "No__of_Reviews"),
        "rating": ("Rating",),
        "price": ("Price",),
        "price_model": ("Price_Model",),
        "enrolled_students": ("No. of Students enrolled", "No__of_Students_enrolled"),
        "offering_type": ("Type_of_Course",),
    },
    id_required=True,
    rename={
        "No. of Reviews / Ratings": "Review_Count",
        "No. of Students enrolled": "enrolled_students",
        "Type_of_Course": "offering_type",
        "Duration": "Duration_Hours",
        "Price": "Price_Model",
    },
    defaults={"monthly_price": "", "offering_type": "Course", "Best_Category": ""},
)

UDACITY = Feed(
    platform="Udacity",
    columns={
        "course_id": ("course_id",),
        "title": ("Course_Title",),
        "course_url": ("Course_URL",),
        "language": ("Language",),
        "description": ("Description",),
        "skills": ("Skill",),
        "level": ("Level",),
        "instructor": ("Programming Instructor", "Programming_Instructor"),
        "domain_name": ("Best_Category",),
        "last_updated": ("Last Update", "Last_Update"),
        "duration_raw": ("Duration_Hours",),
        "review_count": ("Review_Count",),
        "rating": ("Avg_Rating",),
        "price": ("monthly_price",),
        "price_model": ("Price_Model",),
        "enrolled_students": ("enrolled_students",),
        "offering_type": ("offering_type",),
    },
    iso_dates=True,
    rename={
        "No. of Reviews / Ratings": "Review_Count",
        "No. of Students enrolled": "enrolled_students",
        "Type of Course": "offering_type",
        "Duration": "Duration_Hours",
        "Price": "Price_Model",
    },
    defaults={
        "monthly_price": "", "offering_type": "Course", "Avg_Rating": "", "Review_Count": "",
        "Best_Category": "",
    },
)

UDEMY = Feed(
    platform="Udemy",
    columns={
        "course_id": ("course_id",),
        "title": ("Course_Title",),
        "course_url": ("Course_URL",),
        "language": ("Language",),
        "description": ("Description",),
        "skills": ("Skills",),
        "level": ("Level",),
        "instructor": ("Programming_Instructor",),
        "domain_name": ("Domain_Name",),
        "last_updated": ("Last_Update",),
        "duration_raw": ("Duration",),
        "review_count": ("No_of_Reviews",),
        "rating": ("rate",),
        "price": ("Price",),
        "price_model": ("price model", "price_model"),
        "enrolled_students": ("No_of_Students",),
        "offering_type": ("offering_Type",),
    },
    skill_delimiter=" | ",
    numeric_ids_only=True,
    rename={"No_of_Students_enrolled": "No_of_Students"},
    defaults={"offering_Type": "Course", "rate": ""},
)

FEEDS = {"coursera": COURSERA, "udacity": UDACITY, "udemy": UDEMY}

# Adds the columns to picked rows that picking them does not need.
Complete = Callable[[DataFrame], DataFrame]


def align_feed(df: DataFrame, feed: Feed, ingest_order: Column | None = None) -> DataFrame:
    """A scraped file to its feed contract: columns renamed and completed, last row per id.

    The price model is inferred from the price text where the feed lacks it.
    ``ingest_order`` is the order in which rows were scraped; without it nothing is
    deduplicated.
    """
    defaults = dict(feed.defaults)
    if feed.numeric_ids_only and "Price" in df.columns:
        defaults["price model"] = F.when(is_free_text("Price"), "Free").otherwise("One Time")
    if ingest_order is not None:
        df = keep_last(df, ["course_id"], ingest_order)
    return align_schema(df, feed.rename, defaults)


def stage_feed(
    df: DataFrame, feed: Feed, rules: Rules = DEFAULT, tiebreak: Sequence[Column] | None = None, complete: Complete | None = None,
) -> DataFrame:
    """One feed to canonical rows, the latest per id.

    ``tiebreak`` orders rows of one id and date (first wins); by default a hash of the
    whole row, which is arbitrary but reproducible. Numbers that do not parse are NULL.

    Where the other columns are looked up or built, ``df`` may hold the id, the date and what the tiebreak and the lookups need;
    ``complete`` gets the picked rows and returns them with all columns of the feed. Narrow rows are picked in pieces that fit in memory.
    """
    present = set(df.columns)

    def raw(name: str) -> Column:
        for candidate in feed.columns[name]:
            if candidate in present:
                return F.col(f"`{candidate}`")
        raise ValueError(f"{feed.platform} feed lacks a column for {name}: {feed.columns[name]}")

    def text(name: str) -> Column:
        return raw(name).cast("string")

    def number(name: str, kind: str) -> Column:
        return whole_number(raw(name), kind) if kind == "int" else raw(name).try_cast(kind)

    rows = df
    if feed.numeric_ids_only:
        rows = rows.filter(whole_number(text("course_id")).isNotNull())
    if feed.id_required and rules.drop_null_ids:
        rows = rows.filter(raw("course_id").isNotNull())

    if feed.iso_dates:
        updated = parse_iso_date(text("last_updated"))
        latest = text("last_updated").try_cast("timestamp_ntz")
    else:
        strict = F.to_date(text("last_updated"), fixed.FEED_DATE_FORMAT)
        updated = parse_feed_date(text("last_updated")) if rules.lenient_dates else strict
        latest = updated
    if tiebreak is None:
        tiebreak = [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).asc()]
    # The latest raw row per id is picked first, so that only kept rows are parsed.
    key = [feed.columns["course_id"][0]]
    kept = deduplicate(gathered(rows, key) if complete else rows, key, [latest.desc_nulls_last(), *tiebreak])
    if complete:
        kept = complete(kept)
        present = set(kept.columns)
    skills = text("skills")
    return kept.select(
        text("course_id").alias("course_id"),
        F.trim(text("title")).alias("title"),
        text("course_url").alias("course_url"),
        F.lit(feed.platform).alias("platform"),
        standardize_language(text("language")).alias("language"),
        F.trim(text("description")).alias("description"),
        (rewrite_delimiter(skills, feed.skill_delimiter) if feed.skill_delimiter else F.trim(skills)).alias("skills"),
        text("level").alias("level"),
        F.trim(text("instructor")).alias("instructor"),
        text("domain_name").alias("domain_name"),
        text("offering_type").alias("offering_type"),
        updated.alias("last_updated"),
        text("duration_raw").alias("duration_raw"),
        parse_duration(text("duration_raw"), leading_only=rules.leading_number_only).alias("duration_hours"),
        number("review_count", "int").alias("review_count"),
        number("rating", "double").alias("rating"),
        number("price", "double").alias("price"),
        text("price_model").alias("price_model"),
        number("enrolled_students", "int").alias("enrolled_students"),
    )


def stage_feeds(
    df: DataFrame, platform: str = "platform", rules: Rules = DEFAULT, tiebreak: Sequence[Column] | None = None,
    feeds: Sequence[Feed] = (COURSERA, UDACITY, UDEMY), complete: Complete | None = None,
) -> DataFrame:
    """Several feeds to canonical rows in one pass: one scan and one shuffle, however many feeds there are.

    ``df`` holds the raw rows of all feeds under the canonical names, told apart by a column with the platform. The result is
    that of :func:`stage_feed` on each feed and :func:`combine_feeds`; rows of other platforms are left out. Where feeds differ
    (ids, dates, delimiters) the rule is chosen per row. ``complete`` as there.
    """
    def per_feed(value: Callable[[Feed], Column]) -> Column:
        chosen = None
        for feed in feeds:
            own = F.col(platform) == feed.platform
            chosen = F.when(own, value(feed)) if chosen is None else chosen.when(own, value(feed))
        return chosen

    def text(name: str) -> Column:
        return F.col(name).cast("string")

    def kept_id(feed: Feed) -> Column:
        numeric = whole_number(text("course_id")).isNotNull() if feed.numeric_ids_only else F.lit(True)
        return numeric & (F.col("course_id").isNotNull() if feed.id_required and rules.drop_null_ids else F.lit(True))

    def day(feed: Feed) -> Column:
        if feed.iso_dates:
            return parse_iso_date(text("last_updated"))
        strict = F.to_date(text("last_updated"), fixed.FEED_DATE_FORMAT)
        return parse_feed_date(text("last_updated")) if rules.lenient_dates else strict

    def latest(feed: Feed) -> Column:
        return text("last_updated").try_cast("timestamp_ntz") if feed.iso_dates else day(feed).cast("timestamp_ntz")

    if tiebreak is None:
        tiebreak = [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).asc()]
    rows = df.filter(per_feed(kept_id))
    key = [platform, "course_id"]
    kept = deduplicate(gathered(rows, key) if complete else rows, key, [per_feed(latest).desc_nulls_last(), *tiebreak])
    if complete:
        kept = complete(kept)
    skills = per_feed(lambda f: rewrite_delimiter(text("skills"), f.skill_delimiter) if f.skill_delimiter else F.trim(text("skills")))
    columns = {
        "course_id": text("course_id"), "title": F.trim(text("title")), "course_url": text("course_url"), "platform": F.col(platform),
        "language": standardize_language(text("language")), "description": F.trim(text("description")), "skills": skills,
        "level": text("level"), "instructor": F.trim(text("instructor")), "domain_name": text("domain_name"),
        "offering_type": text("offering_type"), "last_updated": per_feed(day), "duration_raw": text("duration_raw"),
        "duration_hours": parse_duration(text("duration_raw"), leading_only=rules.leading_number_only),
        "review_count": whole_number("review_count"), "rating": F.col("rating").try_cast("double"),
        "price": F.col("price").try_cast("double"), "price_model": text("price_model"), "enrolled_students": whole_number("enrolled_students"),
    }
    return kept.select(*[columns[c].alias(c) for c in fixed.CANONICAL_COLUMNS])


def combine_feeds(*staged: DataFrame) -> DataFrame:
    """All staged feeds as one table, columns matched by name."""
    return union_by_name(*staged).select(*fixed.CANONICAL_COLUMNS)
