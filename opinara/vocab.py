"""Word lists, ordered taxonomies, phrases, expected columns, thresholds.

Everything here is data that must equal the published pipeline for results to
agree. The order of a taxonomy is part of its meaning: the first match wins.
"""

# Brand taxonomy, key -> keywords, tested in this order.
BRANDS = {
    "apple": ["apple", "iphone", "iphones", "airpods", "macbook", "macbooks"],
    "samsung": ["samsung", "galaxy"],
    "google": ["google", "pixel"],
    "xiaomi": ["xiaomi"],
    "oneplus": ["oneplus"],
    "motorola": ["motorola"],
    "huawei": ["huawei"],
    "honor": ["honor"],
    "realme": ["realme"],
    "oppo": ["oppo"],
    "vivo": ["vivo"],
    "nvidia": ["nvidia", "rtx"],
    "amd": ["amd", "ryzen"],
    "intel": ["intel"],
    "lenovo": ["lenovo", "thinkpad"],
    "dell": ["dell", "alienware"],
    "asus": ["asus"],
    "acer": ["acer"],
    "hp": ["hp"],
    "razer": ["razer"],
    "msi": ["msi"],
    "microsoft": ["microsoft", "surface"],
    "sony": ["sony"],
    "bose": ["bose"],
    "jbl": ["jbl"],
    "anker": ["anker"],
    "logitech": ["logitech"],
    "corsair": ["corsair"],
    "steelseries": ["steelseries"],
    "fitbit": ["fitbit"],
    "garmin": ["garmin"],
    "amazfit": ["amazfit"],
    "oura": ["oura"],
}

# Product taxonomy.
PRODUCTS = {
    "iphone": ["iphone", "iphones"],
    "galaxy": ["galaxy"],
    "pixel": ["pixel"],
    "macbook": ["macbook", "macbooks"],
    "thinkpad": ["thinkpad"],
    "surface": ["surface"],
    "rtx": ["rtx"],
    "ryzen": ["ryzen"],
    "airpods": ["airpods"],
    "earbuds": ["earbuds"],
    "headphones": ["headphones"],
    "galaxy_watch": ["galaxy watch"],
    "apple_watch": ["apple watch"],
    "oura_ring": ["oura ring"],
}

# Topic taxonomy.
TOPICS = {
    "battery": ["battery", "battery life", "mah", "charging speed"],
    "camera": ["camera", "photo", "photography", "video", "megapixel", "lens"],
    "performance": ["performance", "speed", "fps", "lag", "benchmark", "fast", "slow"],
    "display": ["display", "screen", "oled", "amoled", "refresh rate", "brightness"],
    "charging": ["charging", "charger", "fast charge", "wireless charge"],
    "software": ["software", "android", "ios", "update", "ui", "os", "bug"],
    "price": ["price", "cost", "expensive", "cheap", "worth it", "value"],
    "audio": ["audio", "sound", "speaker", "microphone", "anc", "noise cancel"],
    "connectivity": ["bluetooth", "wifi", "5g", "connectivity", "signal"],
    "design": ["design", "build", "quality", "premium", "plastic", "glass", "weight"],
    "foldable": ["fold", "foldable", "flip"],
    "ai": ["ai", "artificial intelligence", "galaxy ai", "on-device ai"],
    "ev": ["electric vehicle", "ev", "car", "yu7"],
    "smartwatch": ["watch", "smartwatch", "wearable"],
}

# Brand keywords of the exploratory mention counts.
EDA_BRANDS = {
    "apple": ["apple", "iphone", "ios", "macbook", "ipad", "airpods"],
    "samsung": ["samsung", "galaxy"],
    "xiaomi": ["xiaomi", "redmi", "poco"],
    "huawei": ["huawei", "honor"],
    "google": ["google", "pixel", "android"],
    "motorola": ["motorola", "moto g", "moto "],
    "oneplus": ["oneplus", "one plus"],
    "sony": ["sony", "xperia"],
}

# Phrases that mark a text as personal experience.
EXPERIENCE_PHRASES = [
    "i bought", "i got", "i've been using", "my experience",
    "daily driver", "worth it", "happy with", "not worth it",
]

# Short sentiment lexicon (per-token score).
POSITIVE_WORDS = [
    "good", "great", "excellent", "amazing", "awesome", "love", "like", "happy", "positive",
]
NEGATIVE_WORDS = ["bad", "worse", "worst", "poor", "hate", "sad", "negative"]

# Bilingual sentiment lexicon; extends the short one.
POSITIVE_WORDS_BILINGUAL = POSITIVE_WORDS + [
    "best", "win", "success", "perfect", "bonito", "bueno", "excelente", "genial",
    "feliz", "mejor", "gracias", "positivo",
]
NEGATIVE_WORDS_BILINGUAL = NEGATIVE_WORDS + [
    "fail", "error", "problem", "issue", "terrible", "awful", "malo", "peor", "falla",
    "fallo", "problema", "triste", "negativo",
]

# Spark's default English stop words (StopWordsRemover, "english").
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what
which who whom this that these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for
with about against between into through during before after above below to from up
down in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so than too
very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't
wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought
that's there's what's when's where's who's why's would
""".split()

# Extra bilingual stop words.
EXTRA_STOP_WORDS = """
a an and are as at be but by con de del el en es for from http https i la las le lo
los me mi my na no not of on or para pero por que rt si sin the to un una y
""".split()

STOP_WORDS = sorted(set(ENGLISH_STOP_WORDS) | set(EXTRA_STOP_WORDS))

# Function words voted on by the language detector.
LANGUAGE_WORDS = {
    "en": ["the", "and", "is", "to", "of", "in", "for", "you"],
    "es": ["que", "la", "el", "los", "las", "y", "de", "para"],
}
SPANISH_ACCENTS = "áéíóúñ"

# Placeholder texts and the quoted-reply prefix seen in comments.
NOISE_TEXTS = ["deleted"]
QUOTED_REPLY_PREFIX = r"^[^,\n]+, \d+ (?:minutes?|hours?|days?) ago"

# Columns the two governance tables are expected to have.
GOVERNANCE_TWEETS_COLUMNS = [
    "tweet_id", "date_day", "week", "author_userName", "author_followers", "text", "lang",
    "total_engagement", "likeCount", "replyCount", "retweetCount", "quoteCount", "brand",
    "product", "topic", "sentiment", "sentiment_score", "experience_type",
]
GOVERNANCE_NEWS_COLUMNS = [
    "newsLink", "date_day", "week", "comment_text", "brand", "product", "topic",
    "sentiment", "sentiment_score",
]

# Metrics whose outliers the governance report counts.
DASHBOARD_OUTLIER_METRICS = ["likeCount", "replyCount", "retweetCount", "quoteCount", "author_followers"]

# Critical columns for the overall null rate.
CRITICAL_TWEETS_COLUMNS = [
    "tweet_id", "date_day", "author_userName", "text", "sentiment", "sentiment_score",
]
CRITICAL_NEWS_COLUMNS = ["newsLink", "date_day", "comment_text", "sentiment", "sentiment_score"]

# KPI thresholds and the status a KPI gets when it misses one.
KPI_RULES = [
    # kpi, comparison that passes, threshold, status on a miss
    ("total_records", None, None, None),
    ("null_rate", "<", 5.0, "FAIL"),
    ("duplicate_rate", "<", 2.0, "WARNING"),
    ("schema_compliance", ">", 95.0, "FAIL"),
    ("unique_languages", None, None, None),
    ("total_engagement", None, None, None),
]

# Severity bands of the KPI cards.
RATE_BANDS = {"null_rate": (2.0, 5.0), "duplicate_rate": (1.0, 2.0)}
COMPLIANCE_BANDS = (98.0, 95.0)

# Natural keys of the two Silver tables.
NATURAL_KEYS = {"tweets": ["id"], "news": ["newsLink"]}

# Required fields of a Silver row.
REQUIRED_FIELDS = {
    "tweets": ["id", "text", "createdAt", "lang", "author_userName"],
    "news": ["newsLink", "comments", "snapshot_date"],
}

# Engagement counters of a tweet.
ENGAGEMENT_PARTS = ["likeCount", "replyCount", "retweetCount", "quoteCount"]
OUTLIER_METRICS = ["retweetCount", "replyCount", "likeCount", "quoteCount", "viewCount"]

# Sentence templates of the story; {…} is filled per row.
EXECUTIVE_SUMMARY = (
    "{brand} fue la marca más mencionada durante la semana con {mentions} referencias entre "
    "redes sociales y comentarios de noticias."
)
BRAND_NARRATIVE = (
    "During the current week, the brand {brand} accumulated a total volume of {mentions} mentions "
    "across the monitored channels. General consumer perception is {tone} with a net sentiment "
    "score of {score}. Specifically, {positive}% of discussions were positive, while {negative}% "
    "showed negative consumer feedback. A detailed breakdown of the products and discussion "
    "categories driving this behavior is displayed below."
)
SPIKE_SENTENCE = (
    "[{severity}] Negative Spike — {brand}: Negative sentiment jumped from {previous}% to "
    "{current}% (+{delta} pp)"
)
RECOVERY_SENTENCE = (
    "[{severity}] Positive Recovery — {brand}: Positive sentiment recovered from {previous}% to "
    "{current}% (+{delta} pp)"
)
