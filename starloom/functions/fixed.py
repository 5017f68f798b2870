"""Fixed values. These must equal the published vocabularies for right results."""

# --- fixed values: language names and the codes that mean them ----------------
LANGUAGES: dict[str, list[str]] = {
    "English": ["english", "en", "en-us", "en-gb", "en-in", "en-au", "en-ca"],
    "Spanish": ["spanish", "es", "es-es", "es-la", "es-mx", "es-cl", "es-co", "es-ve", "es-ar"],
    "Portuguese": ["portuguese", "pt", "pt-br", "pt-pt"],
    "French": ["french", "fr", "fr-fr", "fr-ca"],
    "German": ["german", "de", "de-de"],
    "Arabic": ["arabic", "ar", "ar-sa", "ar-eg"],
    "Chinese": ["chinese", "zh", "zh-cn", "zh-tw", "zh-hk"],
    "Japanese": ["japanese", "ja", "ja-jp"],
    "Korean": ["korean", "ko", "ko-kr"],
    "Russian": ["russian", "ru", "ru-ru"],
    "Italian": ["italian", "it", "it-it"],
    "Turkish": ["turkish", "tr", "tr-tr"],
    "Dutch": ["dutch", "nl", "nl-nl", "nl-be"],
    "Hindi": ["hindi", "hi", "hi-in"],
    "Polish": ["polish", "pl", "pl-pl"],
    "Swedish": ["swedish", "sv", "sv-se"],
    "Indonesian": ["indonesian", "id", "id-id"],
    "Vietnamese": ["vietnamese", "vi", "vi-vn"],
    "Thai": ["thai", "th", "th-th"],
    "Hebrew": ["hebrew", "he", "he-il"],
    "Greek": ["greek", "el", "el-gr"],
    "Czech": ["czech", "cs", "cs-cz"],
    "Ukrainian": ["ukrainian", "uk", "uk-ua"],
    "Persian": ["persian", "farsi", "fa", "fa-ir"],
    "Urdu": ["urdu", "ur", "ur-pk"],
    "Bengali": ["bengali", "bn", "bn-in"],
    "Romanian": ["romanian", "ro", "ro-ro"],
    "Hungarian": ["hungarian", "hu", "hu-hu"],
    "Danish": ["danish", "da", "da-dk"],
    "Finnish": ["finnish", "fi", "fi-fi"],
    "Norwegian": ["norwegian", "no", "nb-no", "nn-no"],
}
OTHER_LANGUAGE = "Other / Unknown"

# --- fixed values: difficulty levels -------------------------------------------
LEVELS: dict[str, list[str]] = {
    "Beginner": ["beginner", "beginner level", "introductory"],
    "Intermediate": ["intermediate", "intermediate level"],
    "Advanced": ["advanced", "expert", "advanced level"],
    "All Levels": ["all levels", "all", "mixed"],
}

# --- fixed values: price models -------------------------------------------------
SUBSCRIPTION_MODELS = ["subscription", "monthly_subscription"]
ONE_TIME_MODEL = "one time"

# --- fixed values: band edges (upper bound exclusive, first match wins) ----------
PRICE_BANDS = [(500, "Cheap"), (2000, "Medium"), (5000, "Expensive")]
PRICE_BAND_TOP = "Premium"
DURATION_BANDS = [(5, "Short"), (20, "Medium"), (50, "Long")]
DURATION_BAND_TOP = "Extensive"
# Tier, least rating, least enrolment, least engagement (None: any), tried in this order.
QUALITY_TIERS = [("Premium", 4.5, 1000, 1.0), ("High", 4.0, 500, None), ("Medium", 3.0, None, None)]
UNRATED_TIER, LOWEST_TIER = "Unrated", "Low"

# --- fixed values: business order of the reported bands and tiers ----------------
PRICE_BAND_ORDER = ["Free", "Cheap", "Medium", "Expensive", "Premium"]
TIER_ORDER = ["Premium", "High", "Medium", "Low"]

# --- fixed values: surrogate keys, provenance, unknown members ---------------------
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SOURCE_COLUMN = "_dbt_source_relation"
UNKNOWN_KEY = -1

# --- fixed values: great-circle radius in miles, kilometres per mile ---------------
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934

# --- fixed values: skills looked for in descriptions, in reported order -------------
SKILLS = [
    "Python", "JavaScript", "Java", "C++", "C#", "PHP", "Ruby", "Swift", "Kotlin",
    "TypeScript", "Go", "Rust", "R", "MATLAB", "Scala", "Perl", "Dart", "Lua",
    "Shell", "Bash",
    "HTML", "HTML5", "CSS", "CSS3", "React", "React.js", "Vue", "Vue.js", "Angular",
    "jQuery", "Bootstrap", "Tailwind", "Flexbox", "Grid", "SASS", "LESS", "webpack",
    "Redux", "Next.js", "Nuxt.js", "Gatsby", "Svelte",
    "Node.js", "Express", "Express.js", "Django", "Flask", "FastAPI", "Spring",
    "Laravel", "Rails", "ASP.NET", "GraphQL", "REST", "RESTful", "API", "APIs",
    "SQL", "MySQL", "PostgreSQL", "SQLite", "MongoDB", "Redis", "Firebase",
    "DynamoDB", "Oracle", "NoSQL", "Elasticsearch", "Cassandra",
    "AWS", "Azure", "GCP", "Docker", "Kubernetes", "Linux", "Git", "GitHub", "CI/CD",
    "Jenkins", "Terraform", "Ansible", "Nginx", "Apache",
    "Machine Learning", "Deep Learning", "TensorFlow", "PyTorch", "Keras", "Pandas",
    "NumPy", "Scikit-learn", "OpenCV", "NLP", "Computer Vision", "Data Science",
    "Data Analysis", "Power BI", "Tableau", "Excel",
    "Android", "iOS", "Flutter", "React Native", "Xamarin",
    "Blockchain", "Web3", "Solidity", "NFT", "Cybersecurity", "Networking", "EJS",
    "NPM", "Authentication", "OAuth", "JWT",
]
SKILL_MAX_LENGTH = 40

# --- fixed values: page vocabularies -------------------------------------------------
PAGE_LEVELS = {
    "beginner": "Beginner", "introductory": "Beginner", "intermediate": "Intermediate",
    "mixed": "Mixed", "advanced": "Advanced",
}
COURSE_TYPES = {
    "v1.session": "Course", "v2.ondemand": "Course", "v2.capstone": "Course",
    "course": "Course", "s12n": "Specialization", "specialization": "Specialization",
    "professional certificate": "Professional Certificate",
    "professional-certificate": "Professional Certificate",
    "guided project": "Guided Project", "project": "Guided Project",
    "rhyme project": "Guided Project", "degree": "Degree",
}
PAGE_LANGUAGES = {
    "en": "English", "ar": "Arabic", "fr": "French", "es": "Spanish", "de": "German",
    "pt": "Portuguese", "zh": "Chinese", "ja": "Japanese", "ko": "Korean",
    "ru": "Russian", "it": "Italian", "tr": "Turkish", "hi": "Hindi", "nl": "Dutch",
    "pl": "Polish", "sv": "Swedish",
}
DEFAULT_PRICE = "Free (Audit) / Paid (Certificate)"
PAID_PRICE = "Paid (Subscription)"
FREE_TEXTS = ["free", "0", ""]

# --- fixed values: date formats, tried in this order ---------------------------------
PAGE_DATE_FORMATS = ["yyyy-M-d", "MMMM d, yyyy", "MMM d, yyyy"]
FEED_DATE_FORMAT = "M/d/yyyy"

# --- fixed values: the canonical course row -------------------------------------------
CANONICAL_COLUMNS = [
    "course_id", "title", "course_url", "platform", "language", "description", "skills",
    "level", "instructor", "domain_name", "offering_type", "last_updated",
    "duration_raw", "duration_hours", "review_count", "rating", "price", "price_model",
    "enrolled_students",
]
