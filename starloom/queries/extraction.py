"""Record extraction on whole tables of pages, documents and derived JSON records."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, records, text, times, urls
from ..operators import tagging
from ..plans import extract
from .registry import query, table
from .scalars import scalar

# --- text ------------------------------------------------------------------------------------

_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_html_to_text(c: str) -> str:
    """For the references that occur in the given pages."""
    bare = f"regexp_replace({c}, '<[^>]+>', ' ', 'g')"
    for entity, char in {"&copy;": "©", "&middot;": "·", "&quot;": '"'}.items():
        bare = f"replace({bare}, '{entity}', '{char}')"
    bare = f"regexp_replace({bare}, '&amp;?', '&', 'g')"
    collapsed = f"regexp_replace({bare}, '{_WS}+', ' ', 'g')"
    return f"trim({collapsed})"


scalar("ext_1_html_to_text", "pages", ["page_id"], {"text": (lambda: text.html_to_text("html"), sql_html_to_text("html"))})

_ESCAPED = (
    "'a &lt;b&gt; &amp;lt; &#' || cast(233 + page_id % 300 as string) || '; &#x' || 'e' || cast(page_id % 10 as string) "
    "|| '; &copy 2024 &notanentity; AT&T &amp'"
)
scalar(
    "ext_1_unescape_html", "pages", ["page_id"],
    {"plain": (
        lambda: text.unescape_html("raw"),
        "'a <b> &lt; ' || chr(cast(233 + page_id % 300 as integer)) || ' ' || chr(cast(224 + page_id % 10 as integer)) "
        "|| ' © 2024 ¬anentity; AT&T &'",
    )},
    {"raw": _ESCAPED},
)

_LEARN = {
    "learn": "text || case doc_id % 7 when 0 then ' React Native, C++11 and node.js!' when 1 then ' Learn C# / C++ (C#7).' "
             "when 2 then ' machine learning with Scikit-Learn, PyTorch & SQL' when 3 then ' go_lang Go-lang GO' "
             "when 4 then ' Vue.js Express.js HTML5 html ASP.NET' when 5 then ' RESTful APIs, éR rest CI/CD' else '' end",
}


def sql_keywords(c: str) -> str:
    def found(keyword: str) -> str:
        inner = re.escape(keyword.lower()).replace("'", "''")
        after = r"[\pL\pN_]" if not keyword[-1].isalnum() else r"(?:$|[^\pL\pN_])"
        return f"case when regexp_matches(t, '(?:^|[^\\pL\\pN_]){inner}{after}') then '{keyword}' end"

    items = ", ".join(found(k) for k in fixed.SKILLS)
    return f"(select array_to_string(list_filter([{items}], lambda x: x is not null), ' | ') from (select lower({c}) as t) as low)"


scalar(
    "ext_2_keyword_tags", "documents", ["doc_id"],
    {"skills": (lambda: F.array_join(text.keyword_tags("learn"), " | "), sql_keywords("learn"))}, _LEARN,
)


@query(
    "ext_2_vocabulary_tags",
    r"""
    with words as (select min(c) as keyword from (select unnest([p_brand, p_type, p_name, split_part(p_name, ' ', 1)]) as c from part) as t
                   where c <> '' group by lower(c)),
    texts as (select l_orderkey, string_agg(p_name || case when l_linenumber % 2 = 0 then '-' else ', ' end || upper(p_brand), '; ' order by l_linenumber)
              || ' ' as body from lineitem join part on l_partkey = p_partkey group by 1),
    -- keywords hold letters, digits, blanks and # here: whole words are surrounded by other characters
    padded as (select l_orderkey, ' ' || lower(body) || ' ' as t from texts),
    hits as (select l_orderkey, keyword from padded, words where contains(t, lower(keyword))
             and regexp_matches(t, '[^a-z0-9_]' || lower(keyword) || '[^a-z0-9_]'))
    select l_orderkey, coalesce(string_agg(keyword, ' | ' order by keyword), '') as tags
    from texts left join hits using (l_orderkey) group by 1
    """,
)
def vocabulary_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    names = F.array("p_brand", "p_type", "p_name", F.split_part("p_name", F.lit(" "), F.lit(1)))
    words = part.select(F.explode(names).alias("keyword")).filter("keyword <> ''").distinct()
    lines = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    mark = F.when(F.col("l_linenumber") % 2 == 0, "-").otherwise(", ")
    said = F.struct("l_linenumber", F.concat("p_name", mark, F.upper("p_brand")).alias("said"))
    texts = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(said)).alias("all")).select(
        "l_orderkey", F.concat(F.array_join("all.said", "; "), F.lit(" ")).alias("body"))
    found = tagging.vocabulary_tags(texts, ["l_orderkey"], "body", words)
    return found.select("l_orderkey", F.array_join("tags", " | ").alias("tags"))


@query(
    "ext_3_skill_list",
    f"""
    select doc_id, case when len(short) > 0 then array_to_string(short, ' | ') else {sql_keywords('described')} end as skills from (
        select *, list_filter(list_transform(topics, lambda x: trim(x)), lambda x: x <> '' and length(x) <= 40) as short,
               coalesce(nullif(description, ''), headline, '') as described
        from (
            select doc_id, case when doc_id % 3 = 0 then [' ' || source || ' ', '', lang, repeat('long ', 9)]
                                when doc_id % 3 = 1 then ['', repeat('long ', 9)] end as topics,
                   case when doc_id % 2 = 0 then '' else {_LEARN['learn']} end as description,
                   'Learn Python and SQL, Go' as headline
            from documents
        ) as raw
    ) as t
    """,
)
def skill_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = (
        "case when doc_id % 3 = 0 then array(' ' || source || ' ', '', lang, repeat('long ', 9)) "
        "when doc_id % 3 = 1 then array('', repeat('long ', 9)) end"
    )
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.expr(topics).alias("topics"),
        F.expr(f"case when doc_id % 2 = 0 then '' else {_LEARN['learn']} end").alias("description"),
        F.lit("Learn Python and SQL, Go").alias("headline"),
    )
    return rows.select("doc_id", F.array_join(text.skill_list("topics", "description", "headline"), " | ").alias("skills"))


scalar(
    "ext_4_durations", "events", ["event_id"],
    {
        "hours": (
            lambda: times.hours_text("seconds"),
            "case when seconds is null or seconds = 0 then '' else printf('%.1f', cast(seconds as double) / 3600) || ' hours' end",
        ),
        "words": (
            lambda: times.iso_duration_words("iso"),
            "case event_id % 4 when 0 then cast(user_id % 3 as varchar) || case when user_id % 3 = 1 then ' hour, ' else ' hours, ' end "
            "|| cast(event_id % 60 as varchar) || case when event_id % 60 = 1 then ' minute' else ' minutes' end "
            "when 1 then cast(user_id as varchar) || case when user_id = 1 then ' week' else ' weeks' end when 2 then 'about a day' end",
        ),
    },
    {
        "seconds": "case when event_id % 100 = 99 then null else event_id * 36 % 90000 end",
        "iso": "case event_id % 4 when 0 then 'PT' || cast(user_id % 3 as string) || 'H' || cast(event_id % 60 as string) || 'M' "
               "when 1 then 'P' || cast(user_id as string) || 'W' when 2 then ' about a day ' end",
    },
)

_STAMP = "cast(year(ts) as string) || '-' || lpad(cast(month(ts) as string), 2, '0') || '-' || lpad(cast(day(ts) as string), 2, '0')"
scalar(
    "ext_7_page_dates", "events", ["event_id"],
    {"day": (
        lambda: times.parse_page_date("raw"),
        "case when event_id % 7 = 6 then null when event_id % 7 = 5 then '2024-99-99' else strftime(ts, '%Y-%m-%d') end",
    )},
    {"raw": f"case event_id % 7 when 0 then {_STAMP} || 'T10:20:30.123Z' when 1 then {_STAMP} || 'T10:20:30Z' when 2 then {_STAMP} "
            f"when 3 then ' January ' || cast(day(ts) as string) || ', 2024' when 4 then 'Updated ' || {_STAMP} || ' UTC' "
            "when 5 then '2024-99-99' else 'yesterday' end"},
)

_MAPS = {
    "level": "case o_orderstatus when 'F' then ' Beginner friendly' when 'O' then 'MIXED levels' else o_orderpriority end",
    "kind": "case o_orderpriority when '1-URGENT' then 's12n' when '2-HIGH' then ' Guided Project ' when '3-MEDIUM' then 'degree' else o_orderstatus end",
    "code": "case o_orderkey % 5 when 0 then 'en' when 1 then 'xx-ABC' when 2 then '' when 3 then null else 'sv' end",
    "price": "case o_orderkey % 4 when 0 then '' when 1 then null else '$' || cast(o_orderkey as string) end",
    "locale": "case o_orderkey % 4 when 0 then '{\"simpleEnglishTitle\":\"\",\"title\":\"T' || cast(o_custkey as string) || '\"}' "
              "when 1 then '{\"locale\":\"fr_FR\"}' when 2 then 'German' end",
}
scalar(
    "ext_8_vocabulary_maps", "orders", ["o_orderkey"],
    {
        "level_name": (lambda: records.page_level("level"),
                       "case o_orderstatus when 'F' then 'Beginner' when 'O' then 'Mixed' else 'Unknown' end"),
        "type_name": (lambda: records.course_type("kind"),
                      "case o_orderpriority when '1-URGENT' then 'Specialization' when '2-HIGH' then 'Guided Project' "
                      "when '3-MEDIUM' then 'Degree' else 'Course' end"),
        "language": (lambda: records.page_language("code"),
                     "case o_orderkey % 5 when 0 then 'English' when 1 then 'Xx-abc' when 4 then 'Swedish' else '' end"),
        "price_text": (lambda: records.page_price("price"), "coalesce(nullif(price, ''), 'Free (Audit) / Paid (Certificate)')"),
        "locale_name": (lambda: records.locale_name("locale"),
                        "case o_orderkey % 4 when 0 then 'T' || cast(o_custkey as varchar) when 1 then 'fr_FR' when 2 then 'German' else '' end"),
    },
    _MAPS,
)

_SLUGGED = {"link": "case page_id % 5 when 0 then 'https://x.org/course/' || cast(page_id as string) || '/?a=b#c' when 1 then "
                    "'https://x.org/school/s-' || cast(page_id as string) || '#top' when 2 then '/degree//d' || cast(page_id as string) || '/' "
                    "when 3 then url end"}
scalar(
    "ext_11_url_slug", "pages", ["page_id"],
    {"slug": (
        lambda: urls.url_slug("link"),
        "case page_id % 5 when 0 then cast(page_id as varchar) when 1 then 's-' || cast(page_id as varchar) "
        "when 2 then 'd' || cast(page_id as varchar) end",
    )},
    _SLUGGED,
)


# --- pages with JSON-LD and embedded state -----------------------------------------------------------

def _key(name: str, value: str) -> str:
    return f"'\"{name}\":\"' || {value} || '\",'"


_LD_BODY = (
    "'{\"@type\":\"' || case page_id % 4 when 0 then 'Course' when 1 then 'Organization' when 2 then 'Product' else 'WebPage' end || '\",' || "
    + _key("description", "'About ' || cast(page_id as string)") + " || "
    + "'\"aggregateRating\":{\"ratingValue\":\"' || cast(page_id % 5 as string) || '.5\",\"ratingCount\":' || cast(page_id % 3 * 10 as string) "
      "|| '.0,\"reviewCount\":7},' || "
    + "case page_id % 3 when 0 then '\"offers\":{\"price\":\"' || cast(page_id as string) || '\",\"priceCurrency\":\"EUR\"},' "
      "when 1 then '\"offers\":[{\"category\":\"Partially Free\"},{\"price\":1}],' else '' end || "
    + _key("dateModified", "'2024-03-' || lpad(cast(page_id % 28 + 1 as string), 2, '0') || 'T01:02:03Z'") + " || "
    + "'\"timeRequired\":\"PT' || cast(page_id % 9 + 2 as string) || 'H\",\"educationalLevel\":\"Level ' || cast(page_id % 3 as string) || '\"}'"
)
_LD_PAGE = {
    "page": "case when page_id % 8 = 7 then html else html || '<script type=\"application/ld+json\">{\"@type\":\"BreadcrumbList\"}</script>"
            "<script type=\"application/ld+json\">' || case when page_id % 6 = 0 then '[{\"@type\":\"Organization\"},' || "
            f"{_LD_BODY} || ']' else {_LD_BODY} end || '</script>' end"
}
# Which pages carry a usable object: listed types; inside arrays only Course and Product.
_USABLE = (
    "page_id % 8 <> 7 and page_id % 4 <> 1 and not (page_id % 6 = 0 and page_id % 4 not in (0, 2))"
)


def _usable(value: str) -> str:
    return f"case when {_USABLE} then {value} end"


@query(
    "ext_5_json_ld",
    f"""
    select page_id, {_usable("'About ' || cast(page_id as varchar)")} as description,
           {_usable("cast(page_id % 5 as double) + 0.5e0")} as avg_rating,
           cast({_usable("case when page_id % 3 = 0 then 7 else page_id % 3 * 10 end")} as bigint) as rating_count,
           {_usable('''case page_id % 3 when 0 then case when page_id = 0 then 'Free' else printf('%.2f', cast(page_id as double)) || ' EUR' end
                       when 1 then 'Free (Audit) / Paid (Certificate)' end''')} as price,
           {_usable("'2024-03-' || lpad(cast(page_id % 28 + 1 as varchar), 2, '0')")} as last_update,
           {_usable("cast(page_id % 9 + 2 as varchar) || ' hours'")} as duration,
           {_usable("'Level ' || cast(page_id % 3 as varchar)")} as level
    from pages
    """,
)
def json_ld(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.expr(_LD_PAGE["page"]).alias("page"))
    found = pages.select("page_id", records.json_ld("page").alias("text"))
    parsed = found.select("page_id", records.parse_json_ld("text").alias("ld"))
    return parsed.select("page_id", *records.as_columns(records.page_json_ld_fields("ld")))


_STATE = {
    "page": "html || case page_id % 4 when 0 then '<script>{\"ratingCount\": ' || cast(page_id as string) || ',\"estimatedWorkload\": \"3 h\\u002Fweek\"}</script>' "
            "when 1 then '<script>{\"totalDuration\": \"PT' || cast(page_id as string) || 'M\",\"updatedAt\":\"2023-01-0' || cast(page_id % 9 + 1 as string) || 'T00:00:00Z\"}</script>' "
            "when 2 then '<p><b>1,' || lpad(cast(page_id % 1000 as string), 3, '0') || '</b> already  Enrolled</p><p>77 learners</p>' "
            "else '<script>var a=\"8 students here\"</script><!-- 9 students --><p>5 Learners and ' || cast(page_id as string) || ' students</p>' end",
}


@query(
    "ext_6_embedded_state",
    """
    select page_id, case when page_id % 4 = 0 then page_id end as rating_count,
           case when page_id % 4 = 0 then '3 h/week' when page_id % 4 = 1 then cast(page_id as varchar) || case when page_id = 1 then ' minute' else ' minutes' end end as duration,
           case when page_id % 4 = 1 then '2023-01-0' || cast(page_id % 9 + 1 as varchar) end as last_update,
           case when page_id % 4 = 2 then 1000 + page_id % 1000 when page_id % 4 = 3 then page_id end as enrollment_count
    from pages
    """,
)
def embedded_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _STATE["page"].replace("\\u002F", "\\\\u002F")  # one backslash less inside a Spark literal
    pages = table(spark, sf_dir, "pages").select("page_id", F.expr(state).alias("page"))
    return pages.select(
        "page_id", *records.as_columns(records.embedded_state_fields("page")), records.enrolment_count("page").alias("enrollment_count")
    )


# --- nested records --------------------------------------------------------------------------------------

@query(
    "ext_9_json_fallback_chain",
    """
    select event_id, json_extract_string(props, '$.k') as k,
           coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k'), event_type) as picked
    from events
    """,
)
def json_fallback_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    picked = F.coalesce(records.json_first("props", "$.missing", "$.k"), F.col("event_type"))
    return events.select("event_id", records.json_text("props", "$.k").alias("k"), picked.alias("picked"))


_UUID = "'0a1b2c3d-0000-4000-8000-' || lpad(cast(p_partkey as string), 12, '0')"
_NAMES = "array(' ' || p_type || ' ', lower(p_type), {uuid}, 'taxonomy:x' || p_brand, p_name, '', upper(p_name), p_brand)".format(uuid=_UUID)
_PEOPLE = "array(p_name || ', Instructor', p_brand || ' , ' || p_name, 'Mentor', p_type)"


@query(
    "ext_10_clean_lists",
    """
    select p_partkey, array_to_string([p_type, p_name, p_brand], ', ') as skills,
           array_to_string([p_name, p_brand, p_type], ', ') as people,
           upper(p_type[1:1]) || lower(p_type[2:]) || ' ' || upper(p_name[1:1]) || '3D' as title
    from part
    """,
)
def clean_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    title = text.slug_to_title(F.expr("lower(p_type) || '-' || lower(substr(p_name, 1, 1)) || '3d'"))
    return part.select(
        "p_partkey", F.array_join(text.clean_names(F.expr(_NAMES)), ", ").alias("skills"),
        F.array_join(text.clean_people(F.expr(_PEOPLE)), ", ").alias("people"), title.alias("title"),
    )


_DEEP = (
    "'{\"a\":{\"b\":[{\"x\":1},{\"' || case o_orderkey % 3 when 0 then 'userLanguage' when 1 then 'LOCALE_code' else 'other' end "
    "|| '\":' || case o_orderkey % 4 when 0 then 'null' when 1 then '\" \"' when 2 then '\"l' || cast(o_custkey as string) || '\"' "
    "else cast(o_custkey as string) end || '}]},\"note\":\"the \\\"lang\\\": x\",\"language\":{\"z\":2' "
    "|| case o_orderkey % 5 when 0 then ',\"deep\":[[{\"lang\":\"d' || cast(o_orderkey as string) || ' [x]\"}]]' else '' end "
    "|| '},\"lang2\":\"last\"}'"
)


_LISTED = (
    "'{\"title\":\"' || p_name || '\",\"mainSkill\":\"' || p_type || '\",\"skills\":[\"SQL\",\"C [' || p_brand || ']\",[\"inner\"],{\"name\":\"' || p_name "
    "|| '\",\"meta\":{\"k\":[\"z\"],\"skillTag\":' || case p_size % 3 when 0 then '{\"label\":\"L' || cast(p_size as string) || '\"}' when 1 then '[7,null,true]' "
    "else '[{\"title\":\"\",\"text\":\"T\"},\"}{\"]' end || '}}],\"note\":\"skills: {[\",\"other\":{\"SKILLS\":' "
    "|| case when p_size % 4 = 0 then 'null' else '[]' end || '}}'"
)


@query(
    "ext_10_json_names",
    f"""
    with tree as (
        select p_partkey, t.id, t.parent, t.key, t.type, json_extract_string(t.value, '$') as text, t.value
        from (select p_partkey, {_LISTED} as record from part) as p, json_tree(p.record) as t
    ), hits as (select * from tree where lower(key) like '%skill%'),
    items as (
        select p_partkey, id as hit, id, type, text, value from hits where type in ('VARCHAR', 'OBJECT')
        union all select h.p_partkey, h.id, t.id, t.type, t.text, t.value from hits h join tree t
        on h.p_partkey = t.p_partkey and t.parent = h.id where h.type = 'ARRAY' and t.type in ('VARCHAR', 'OBJECT')
    ), named as (
        select p_partkey, hit, id, case when type = 'VARCHAR' then text else coalesce(
            nullif(trim(value->>'$.name'), ''), nullif(trim(value->>'$.title'), ''), nullif(trim(value->>'$.displayName'), ''),
            nullif(trim(value->>'$.label'), ''), nullif(trim(value->>'$.skillName'), ''), nullif(trim(value->>'$.text'), '')) end as name
        from items
    )
    select p_partkey, string_agg(name, ' | ' order by hit, id) as names from named where name is not null group by 1
    """,
)
def json_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.expr(_LISTED).alias("record"))
    return part.select("p_partkey", F.array_join(records.json_collect("record", ["skill"]), " | ").alias("names"))


@query(
    "ext_14_json_find",
    f"""
    with walked as (
        select o_orderkey, t.id, t.type, json_extract_string(t.value, '$') as value
        from (select o_orderkey, {_DEEP} as record from orders) as o, json_tree(o.record) as t
        where regexp_matches(lower(t.key), 'language|locale|lang')
    )
    select o_orderkey, language from orders left join (
        select o_orderkey, arg_min(value, id) as language from walked
        where type not in ('OBJECT', 'ARRAY', 'NULL') and trim(value) <> '' group by 1
    ) as found using (o_orderkey)
    """,
)
def json_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_DEEP.replace("\\", "\\\\")).alias("record"))
    return orders.select("o_orderkey", records.json_find("record", ["language", "locale", "lang"]).alias("language"))


# --- whole raw rows -----------------------------------------------------------------------------------------

_COURSE = (
    "'{\"title\":\"' || p_name || '\",\"urlCourseLanding\":\"/c/' || cast(p_partkey as string) || '\",\"updatedOn\":\"2024-01-01\",\"isFree\":' "
    "|| case when p_size % 3 = 0 then 'true' else 'false' end || ',\"durationInSeconds\":' || cast(p_size * 600 as string) "
    "|| ',\"level\":\"' || p_type || '\",\"locale\":{\"title\":\"English\"},\"rating\":{\"count\":' || cast(p_size as string) "
    "|| '},\"headline\":\"Learn SQL and Python\",\"instructors\":[{\"name\":\" ' || p_brand || ' \"},{\"name\":\"\"},{\"name\":\"B\"}]}'"
)
_DETAIL = (
    "'{\"description\":\"<p>Docker &amp; ' || p_name || '</p>\",\"num_subscribers\":' || cast(p_partkey as string) "
    "|| ',\"instructional_level\":\"' || case when p_size % 2 = 0 then '' else 'All Levels' end || '\",\"content_info\":\"' "
    "|| case when p_size % 5 = 0 then '9.5 total hours' else '' end || '\",\"primary_subcategory\":{\"title\":\"' || p_type || '\"},\"topics\":' "
    "|| case p_size % 3 when 0 then '[]' when 1 then '[{\"title\":\" Web \"},\"Data\"]' else 'null' end || '}'"
)


@query(
    "ext_12_listing_rows",
    """
    select cast(p_partkey as varchar) as course_id, p_name as "Course_Title", '/c/' || cast(p_partkey as varchar) as "Course_URL",
           'Udemy' as "Platform", 'English' as "Language", case when d then 'Docker & ' || p_name else '' end as "Description",
           case when d and p_size % 3 = 1 then 'Web | Data' when d then 'Docker' else 'Python | SQL' end as "Skills",
           case when d and p_size % 2 = 1 then 'All Levels' else p_type end as "Level",
           case when p_retailprice > 950 then '$' || cast(p_size as varchar) when p_size % 3 = 0 then 'Free' else '' end as "Price",
           cast(p_size as bigint) as "No_of_Reviews", case when d then p_partkey end as "No_of_Students_enrolled",
           p_brand || ', B' as "Programming_Instructor", '2024-01-01' as "Last_Update",
           case when d then p_type else '' end as "Type_of_Course",
           case when d and p_size % 5 = 0 then '9.5 total hours' else printf('%.1f', p_size * 600 / 3600.0e0) || ' hours' end as "Duration"
    from (select *, p_type <> 'SMALL' as d from part) as t
    """,
)
def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string").alias("course_id")
    courses = part.select(key, F.expr(_COURSE).alias("json"))
    details = part.filter("p_type <> 'SMALL'").select(key, F.expr(_DETAIL).alias("json"))
    price = F.expr("'{\"price\":{\"price_string\":\"$' || cast(p_size as string) || '\"}}'")
    prices = part.filter("p_retailprice > 950").select(key, price.alias("json"))
    return extract.listing_rows(courses, details, prices)


_API = (
    "'{\"slug\":\"' || case when page_id % 5 = 0 then '' else 's' || cast(page_id as string) end || '\",\"name\":\"Course ' || cast(page_id as string) "
    "|| '\",\"primaryLanguages\":[\"fr\",\"en\"],\"description\":\"api text\",\"courseType\":\"v2.ondemand\",\"instructorIds\":[\"' "
    "|| cast(page_id % 30 as string) || '\",\"3\"],\"domainTypes\":[{\"subdomainId\":\"data-science\",\"domainId\":\"d\"},"
    "{\"domainId\":\"computer-science\"},{\"subdomainId\":\"data-science\"}]}'"
)


@query(
    "ext_12_api_page_rows",
    f"""
    select cast(page_id as varchar) as course_id, 'Course ' || cast(page_id as varchar) as "Course_Title",
           case when page_id % 5 = 0 then '' else 'https://x.org/learn/s' || cast(page_id as varchar) end as "Course_URL",
           'Coursera' as "Platform", 'French' as "Language",
           case when u then 'About ' || cast(page_id as varchar) else 'api text' end as "Description",
           'Data Science, Computer Science' as "Skill", 'Unknown' as "Level",
           case when not u then 'Free (Audit) / Paid (Certificate)' when page_id % 3 = 0 then case when page_id = 0 then 'Free'
                else printf('%.2f', cast(page_id as double)) || ' EUR' end else 'Free (Audit) / Paid (Certificate)' end as "Price",
           cast(case when u then case when page_id % 3 = 0 then 7 else page_id % 3 * 10 end when ld then n end as bigint) as "No. of Reviews / Ratings",
           cast(null as bigint) as "No. of Students enrolled",
           case when page_id % 30 < 25 then 'NATION_' || cast(page_id % 30 as varchar) || ', ' else '' end || 'NATION_3' as "Programming Instructor",
           case when u then '2024-03-' || lpad(cast(page_id % 28 + 1 as varchar), 2, '0') else '' end as "Last_Update",
           'Course' as "Type_of_Course", case when u then cast(page_id % 9 + 2 as varchar) || ' hours' else '' end as "Duration"
    from (select *, url like 'https:%' and {_USABLE} as u, url like 'https:%' and page_id % 8 <> 7 as ld,
                 case when page_id % 3 * 10 > 0 or true then page_id % 3 * 10 end as n from pages) as t
    """,
)
def api_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    key = F.col("page_id").cast("string").alias("course_id")
    api = pages.select(key, F.expr(_API).alias("json"))
    html = pages.filter("url like 'https:%'").select(key, F.expr(_LD_PAGE["page"]).alias("html"))
    people = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))
    return extract.api_page_rows(api, html, people, "https://x.org/learn")


_HIT = (
    "'{\"key\":\"' || case when p_size % 4 = 0 then '' else 'k' || cast(p_partkey as string) end || '\",\"title\":\"' || p_name || '\",\"url\":\"' "
    "|| case p_size % 3 when 0 then 'https://site.org/course/x' when 1 then '/school/y' else 'z' end || '\",\"isFree\":' "
    "|| case when p_size % 2 = 0 then 'true' else 'false' end || ',\"skills\":[\"SQL\",\"taxonomy:1\",\" sql \",{\"name\":\"Go [x]\"},[\"no\"]],\"reviewCount\":' "
    "|| cast(p_size as string) || ',\"rating\":4.5,\"instructors\":[{\"fullName\":\"Ann\",\"tags\":[\"t\"]},{\"name\":\"Bo\"}],\"difficulty\":\"' || p_type || '\"}'"
)
_NESTED = (
    "'{\"pageProps\":{\"programId\":\"id' || cast(p_partkey as string) || '\",\"staticProgramDetailsSectionProps\":{\"duration\":\"3 weeks\","
    "\"description\":\" About ' || p_name || ' \",\"teaches\":{\"skillTags\":[{\"name\":\"Python\",\"meta\":{\"k\":[\"z\"]}},\"SQL\",\"taxonomy:9\",\"C [adv]\"]}},"
    "\"programSummary\":{\"semanticType\":\"Course\"},\"meta\":{\"content_language\":\"en\",\"total_learners\":' || cast(p_partkey as string) "
    "|| ',\"page_modified\":\"2024-05-05\"},\"instructorList\":[{\"name\":\"Cy\"},{\"name\":\"Ann\"}]}}'"
)


@query(
    "ext_9_nested_rows",
    """
    select case when p_size % 4 <> 0 then 'k' || cast(p_partkey as varchar) when g then 'id' || cast(p_partkey as varchar) else slug end as course_id,
           p_name as "Course_Title",
           'https://site.org' || case p_size % 3 when 0 then '/course/x' when 1 then '/school/y' else '/course/' || slug end as "Course_URL",
           'Udacity' as "Platform", case when g then 'en' end as "Language", case when g then 'About ' || p_name end as "Description",
           case when g then 'Python, SQL, C [adv], Go [x]' else 'SQL,  sql ' end as "Skill", p_type as "Level", case when p_size % 2 = 0 then 'Free' end as "Price",
           case when g then cast(p_size as varchar) || ' (avg 4.5)' else cast(p_size as varchar) end as "No. of Reviews / Ratings",
           case when g then cast(p_partkey as varchar) end as "No. of Students enrolled",
           case when g then 'Ann, Bo, Cy' else 'Ann, Bo' end as "Programming Instructor",
           case when g then '2024-05-05' end as "Last Update", case when g then 'Course' end as "Type of Course",
           case when g then '3 weeks' end as "Duration"
    from (select *, 's' || cast(p_partkey as varchar) as slug, p_type <> 'ECONOMY' as g from part) as t
    """,
)
def nested_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    slug = F.expr("'s' || cast(p_partkey as string)").alias("slug")
    hits = part.select(slug, F.expr(_HIT).alias("hit"))
    pages = part.filter("p_type <> 'ECONOMY'").select(slug, F.expr(_NESTED).alias("page"))
    return extract.nested_rows(hits, pages, "https://site.org")


@query(
    "ext_13_fallback_rows",
    """
    select case when p_size % 4 <> 0 then 'k' || cast(p_partkey as varchar) else 's' || cast(p_partkey as varchar) end as course_id,
           p_name as "Course_Title", 'SQL,  sql ' as "Skill", cast(p_size as varchar) as "No. of Reviews / Ratings",
           'Ann, Bo' as "Programming Instructor", cast(null as varchar) as "Duration"
    from part
    """,
)
def fallback_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    slug = F.expr("'s' || cast(p_partkey as string)").alias("slug")
    hits = part.select(slug, F.expr(_HIT).alias("hit"))
    none = spark.createDataFrame([], "slug string, page string")
    rows = extract.nested_rows(hits, none, "https://site.org")
    return rows.select("course_id", "Course_Title", "Skill", F.col("`No. of Reviews / Ratings`"), F.col("`Programming Instructor`"), "Duration")
