"""DuckDB SQL that states what each query means, over the same tables."""

from __future__ import annotations

from opinara import vocab
from opinara.functions.text import (
    KEYWORD_NOISE, MENTION, SPACE, TAG, TOKEN, URL_LOOSE, URL_STRICT, WORD,
)
from opinara.plans import tables as t

ORACLES: dict[str, str] = {}


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def words(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def add(name: str, sql: str, d: str = "", i: str = "", digits: int = 6) -> None:
    """Register a statement; ``d`` names its doubles, ``i`` its whole numbers."""
    replaced = [f"round({c}::DOUBLE, {digits}) + 0 AS {c}" for c in d.split()]
    replaced += [f"{c}::BIGINT AS {c}" for c in i.split()]
    head = f"SELECT * REPLACE ({', '.join(replaced)})" if replaced else "SELECT *"
    ORACLES[name] = f"{head} FROM ({sql.strip()}) AS q"


# ---- shared pieces ---------------------------------------------------------

def sub(col: str, *steps: tuple[str, str]) -> str:
    for pattern, new in steps:
        col = f"regexp_replace({col}, {lit(pattern)}, {lit(new)}, 'g')"
    return col


COLLAPSE = (f"[{SPACE}]+", " ")


def clean(col: str, profile: str) -> str:
    text = f"coalesce({col}, '')"
    if profile == "nlp":
        return f"trim({sub(text, (URL_LOOSE, ''), (TAG, ''), (MENTION, ''), COLLAPSE)})"
    if profile == "eda":
        return f"trim({sub(text, (URL_STRICT, ' '), (MENTION, ' '), ('#', ' '), COLLAPSE)})"
    steps = [(URL_STRICT, " "), (MENTION, " "), (f"[^{WORD}{SPACE}']", " "), COLLAPSE]
    plain = f"trim({sub(f'lower({text})', *steps)})"
    return (f"array_to_string(list_filter(string_split({plain}, ' '), lambda w: "
            f"lower(w) NOT IN {words(vocab.ENGLISH_STOP_WORDS)}), ' ')")


def tokens(col: str) -> str:
    return f"regexp_extract_all(lower({col}), {lit(TOKEN)})"


def keyword_tokens(col: str) -> str:
    plain = sub(f"lower({col})", (KEYWORD_NOISE, " "), ("[^a-zA-ZÀ-ÿ0-9]+", " "))
    return f"list_filter(string_split({plain}, ' '), lambda w: w <> '')"


def hits(list_sql: str, vocabulary) -> str:
    return f"len(list_filter({list_sql}, lambda w: w IN {words(vocabulary)}))"


def per_token(col: str) -> str:
    tk = tokens(col)
    return (f"CASE WHEN len({tk}) = 0 THEN 0.0 ELSE ({hits(tk, t.TEST_POSITIVE)} - "
            f"{hits(tk, t.TEST_NEGATIVE)})::DOUBLE / len({tk}) END")


def label(score: str, up: float = 0.05, down: float = -0.05, inclusive: bool = True) -> str:
    eq = "=" if inclusive else ""
    return (f"CASE WHEN {score} >{eq} {up}::DOUBLE THEN 'positive' "
            f"WHEN {score} <{eq} {down}::DOUBLE THEN 'negative' ELSE 'neutral' END")


def hit(col: str, keywords) -> str:
    return "(" + " OR ".join(f"contains(lower({col}), {lit(k)})" for k in keywords) + ")"


def first(col: str, taxonomy, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {hit(col, kws)} THEN {lit(key)}" for key, kws in taxonomy.items())
    return f"CASE {whens} ELSE {default} END"


def day(col: str) -> str:
    return f"(DATE '2024-01-01' + ({col} % 30)::INTEGER)"


TAGS = lambda col: (f"{first(col, t.TEST_BRANDS)} AS brand, {first(col, t.TEST_PRODUCTS)} AS product, "
                    f"{first(col, t.TEST_TOPICS)} AS topic")

TWEETS = f"""
tw0 AS (SELECT doc_id::VARCHAR AS tweet_id, text, lang, source AS author_userName,
          doc_id % 1000 AS author_followers, n_chars AS likeCount, doc_id % 7 AS replyCount,
          doc_id % 11 AS retweetCount, doc_id % 5 AS quoteCount,
          n_chars + doc_id % 7 + doc_id % 11 + doc_id % 5 AS total_engagement,
          {day('doc_id')} AS date_day, {TAGS('text')}, {per_token('text')} AS sentiment_score
        FROM documents),
tw AS (SELECT *, {label('sentiment_score')} AS sentiment FROM tw0)"""

NEWS = f"""
nw0 AS (SELECT 'conv/' || conv_id AS newsLink, text AS comment_text, {day('conv_id')} AS date_day,
          {TAGS('text')}, {per_token('text')} AS sentiment_score FROM conversations),
nw AS (SELECT *, {label('sentiment_score')} AS sentiment FROM nw0)"""

BOTH = f"""{TWEETS}, {NEWS},
al AS (SELECT 'tweets' AS source_type, date_day AS event_date, text, brand, product, topic,
         sentiment, sentiment_score, total_engagement FROM tw
       UNION ALL
       SELECT 'news', date_day, comment_text, brand, product, topic, sentiment, sentiment_score, NULL FROM nw)"""

RAW = """rw AS (SELECT 'tweets' AS source_type, text FROM documents
       UNION ALL SELECT 'news', text FROM conversations)"""

PCTS = """100.0::DOUBLE * count(*) FILTER (sentiment = 'positive') / count(*) AS positive_pct,
  100.0::DOUBLE * count(*) FILTER (sentiment = 'negative') / count(*) AS negative_pct,
  100.0::DOUBLE * count(*) FILTER (sentiment = 'neutral') / count(*) AS neutral_pct,
  avg(sentiment_score) AS avg_score"""
PCT_COLS = "positive_pct negative_pct neutral_pct avg_score"

LABELLED = "lb AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"

BRANDS = f"""{BOTH},
br AS (SELECT brand, count(*) FILTER (source_type = 'tweets') AS mentions_twitter,
         count(*) FILTER (source_type = 'news') AS mentions_news, count(*) AS total_mentions,
         coalesce(sum(total_engagement), 0) AS total_engagement, {PCTS}
       FROM al WHERE brand IS NOT NULL GROUP BY brand)"""
BRAND_INTS = "mentions_twitter mentions_news total_mentions total_engagement"

TOPICS = f"""tp AS (SELECT topic, count(*) AS mentions, {PCTS} FROM al WHERE topic IS NOT NULL GROUP BY topic)"""


def products(source: str, extra: str = "") -> str:
    return f"""{extra}pb AS (SELECT product, brand, count(*) AS n FROM {source}
         WHERE product IS NOT NULL AND brand IS NOT NULL GROUP BY ALL),
pm AS (SELECT product, brand FROM (SELECT *, row_number() OVER (PARTITION BY product ORDER BY n DESC, brand) AS rn
         FROM pb) WHERE rn = 1),
pr AS (SELECT x.product, any_value(pm.brand) AS brand, count(*) AS mentions, {PCTS}
         FROM {source} x LEFT JOIN pm USING (product) WHERE x.product IS NOT NULL GROUP BY x.product)"""


REP = """r0 AS (SELECT brand, sentiment, left(text, 300) AS c, row_number() OVER (
         PARTITION BY brand, sentiment ORDER BY abs(sentiment_score) DESC, text) AS rn
       FROM al WHERE brand IS NOT NULL AND length(text) > 20),
rp AS (SELECT brand, max(c) FILTER (sentiment = 'positive' AND rn = 1) AS best_comment,
         max(c) FILTER (sentiment = 'negative' AND rn = 1) AS worst_comment FROM r0 GROUP BY brand)"""


def capital(col: str) -> str:
    return f"(upper(left({col}, 1)) || lower(substr({col}, 2)))"


MS = "epoch_ms(ts)::VARCHAR"

# ---- scans, lineage, unions ------------------------------------------------

add("latest_snapshot", """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""", d="value")
add("latest_doc", "SELECT doc_id, source, n_chars FROM documents ORDER BY n_chars DESC, doc_id DESC LIMIT 1")
add("latest_doc_per_source", """SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (
  PARTITION BY source ORDER BY n_chars DESC, doc_id DESC) AS rn FROM documents) WHERE rn = 1""")
add("union_sources", """SELECT doc_id::VARCHAR AS record_id, length(text) AS chars, lang, NULL::VARCHAR AS role,
  'documents' AS source_type FROM documents
  UNION ALL SELECT conv_id || '/' || turn, length(text), NULL, role, 'conversations' FROM conversations""", i="chars")
add("source_family", """SELECT page_id, CASE WHEN contains(lower(url), '/en/') THEN 'english'
  WHEN contains(lower(url), '/fr/') THEN 'french' WHEN contains(lower(url), '/de/') THEN 'german'
  WHEN contains(lower(url), '/es/') THEN 'spanish' ELSE 'unknown' END AS family FROM pages""")
add("rows_per_file", """SELECT 'documents.parquet' AS source_file, count(*) AS rows, count(lang) AS non_null_lang,
  0 AS non_null_role FROM documents
  UNION ALL SELECT 'conversations.parquet', count(*), 0, count(role) FROM conversations""",
    i="rows non_null_lang non_null_role")
add("validate_read", """WITH f AS (SELECT 'documents.parquet' AS source_file, count(*) AS rows_read FROM documents
  UNION ALL SELECT 'conversations.parquet', count(*) FROM conversations
  UNION ALL SELECT 'pages.parquet', count(*) FROM pages)
  SELECT source_file, rows_read, 1 AS columns_read, (SELECT sum(rows_read) FROM f) AS rows_total FROM f""",
    i="rows_read columns_read rows_total")
add("dataset_sizes", " UNION ALL ".join(
    f"SELECT {lit(n)} AS dataset, (SELECT count(*) FROM {n}) AS rows, "
    f"(SELECT count(*) FROM (DESCRIBE {n})) AS columns" for n in t.TABLES), i="rows columns")

# ---- projection and nested data ----------------------------------------------

add("flatten_struct", """SELECT event_id, event_type, value AS event_detail_amount,
  (props->>'$.k')::BIGINT AS event_detail_props_k FROM events""", d="event_detail_amount")
add("nested_to_json", """SELECT conv_id, turn, to_json(struct_pack(role := role,
  later := CASE WHEN turn > 0 THEN turn END))::VARCHAR AS meta,
  to_json(string_split(text, chr(10)))::VARCHAR AS lines FROM conversations""")
add("explode_children", """WITH l AS (SELECT doc_id, lang, string_split(text, chr(10)) AS x FROM documents)
  SELECT doc_id AS snapshot_id, lang AS snapshot_lang, i AS line_no, length(x[i + 1]) AS line_chars
  FROM l, unnest(range(len(x))) AS u(i)""", i="line_no line_chars")
add("expand_entities", """SELECT 'tweet' AS record_type, doc_id AS snapshot, doc_id::VARCHAR AS tweet_id,
    NULL::VARCHAR AS news_newsLink, text AS tweet_text, NULL::VARCHAR AS comment_text FROM documents
  UNION ALL SELECT 'news', conv_id, NULL, conv_id || '/' || turn, NULL, NULL FROM conversations
  UNION ALL SELECT 'news_comment', conv_id, NULL, conv_id || '/' || turn, NULL, c
    FROM (SELECT *, unnest(string_split(text, chr(10))) AS c FROM conversations)
  UNION ALL SELECT 'snapshot', doc_id, NULL, NULL, NULL, NULL FROM labels""")
add("coerce_lenient", """SELECT doc_id, try_cast(source AS BIGINT) AS whole, substr(source, 4)::BIGINT AS suffix,
  (substr(source, 4) || '.5')::DOUBLE AS ratio, CASE WHEN lang = 'en' THEN true END AS flag FROM documents""",
    d="ratio")
add("canonicalise", "SELECT doc_id AS tweet_id, lang AS detected_lang, n_chars FROM documents")
add("first_available", f"""WITH {LABELLED} SELECT doc_id, coalesce(quality, toxic, -1) AS label,
  CASE WHEN quality IS NULL THEN source ELSE lang END AS name FROM lb""", i="label")
add("row_completeness", f"""WITH {LABELLED} SELECT doc_id, 5 + (quality IS NOT NULL)::INT + (toxic IS NOT NULL)::INT
  AS completeness FROM lb""", i="completeness")
add("engagement_total", """SELECT l_returnflag, sum(l_quantity + l_extendedprice + l_discount + l_tax)
  AS total_engagement, max(l_quantity + l_extendedprice + l_discount + l_tax) AS max_engagement
  FROM lineitem GROUP BY 1""", d="total_engagement max_engagement")
add("to_text", """SELECT conv_id, turn, array_to_string(string_split(text, chr(10)), ' ') AS joined,
  turn::VARCHAR AS turn_text FROM conversations""")

MIXED = f"""mx AS (
  SELECT doc_id::VARCHAR AS gold_record_id, 'tweet' AS gold_entity, {day('doc_id')} AS gold_event_date,
    text AS gold_text_raw, {clean('text', 'eda')} AS gold_text_clean, n_chars AS tweet_likeCount FROM documents
  UNION ALL SELECT conv_id || '/' || turn, 'news_comment', {day('conv_id')}, text, text, NULL FROM conversations
  UNION ALL SELECT url, 'unknown', NULL, html, html, NULL FROM pages)"""
add("multimodal_records", f"""WITH {MIXED} SELECT *, length(coalesce(gold_text_clean, '')) > 0 AS gold_has_text,
  'record_level_multimodal' AS gold_grain FROM mx""")

# ---- filters and null policy ---------------------------------------------------

add("iso_week_filter", """SELECT event_id, event_type, value FROM events
  WHERE isoyear(ts) = 2024 AND weekofyear(ts) = 3""", d="value")
add("drop_blank", f"WITH {LABELLED} SELECT doc_id, lang AS note FROM lb WHERE quality = 1 AND trim(text) <> ''")
add("min_length", "SELECT conv_id, turn, length(text) AS chars FROM conversations WHERE length(text) > 200", i="chars")
add("entity_split", """SELECT 'tweets' AS source_type, count(*) AS n, sum(length(text)) AS chars FROM documents
  UNION ALL SELECT 'news', count(*), sum(length(text)) FROM conversations""", i="n chars")
add("slice_source", f"""WITH {TWEETS} SELECT tweet_id, sentiment FROM tw
  WHERE author_userName = 'src3' AND brand = 'alpha'""")
add("null_policy", f"""WITH {LABELLED} SELECT doc_id, lang AS createdAt, coalesce(quality, 0) AS quality,
  coalesce(toxic, 0) AS toxic, CASE WHEN quality = 1 THEN source ELSE 'anonymous' END AS author
  FROM lb WHERE lang <> 'es' AND text IS NOT NULL""", i="quality toxic")
add("cap_p99", """SELECT o_orderkey, o_totalprice, o_custkey,
  least(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.99) FROM orders)) AS o_totalprice_capped,
  least(o_custkey::DOUBLE, (SELECT quantile_cont(o_custkey::DOUBLE, 0.99) FROM orders)) AS o_custkey_capped
  FROM orders""", d="o_totalprice o_totalprice_capped o_custkey_capped")


def noise(text: str, lang: str, source: str) -> str:
    return f"""SELECT count(*) AS records,
  avg(regexp_matches({text}, 'https?://|www\\.')::INT) AS url_share,
  avg(regexp_matches({text}, {lit(MENTION)})::INT) AS mention_share,
  avg(({lang} <> 'en')::INT) AS other_language_share FROM {source}"""


add("noise_rates", noise("text", "lang", "documents"), d="url_share mention_share other_language_share")
add("noise_rates_pages", noise("html", "regexp_extract(url, '\\.[a-z]+/([a-z]+)/', 1)", "pages"),
    d="url_share mention_share other_language_share")
add("drop_noise", """SELECT conv_id, turn, role, regexp_replace(text, '^[^.\\n]{1,40}\\. ', '') AS text
  FROM conversations WHERE lower(trim(text)) <> 'deleted'""")

# ---- dates ---------------------------------------------------------------------

add("safe_date", """SELECT event_id, k AS kind, CASE WHEN k = 'bad' THEN NULL ELSE ts::DATE END AS day
  FROM events, (VALUES ('ms'), ('iso'), ('bad')) AS v(k)""")
add("normalize_event_date", """SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'error') THEN ts::DATE
  ELSE date_trunc('month', ts)::DATE END AS event_date FROM events""")
add("parse_mixed_datetime", """SELECT event_id,
  CASE WHEN event_type <> 'error' THEN ts::DATE END AS from_ms,
  CASE WHEN event_type <> 'error' THEN ts::DATE END AS from_iso FROM events""")
add("first_datetime", """SELECT event_id, strftime(CASE WHEN event_type IN ('click', 'view', 'error') THEN ts
  ELSE date_trunc('month', ts) END, '%Y-%m-%d') AS event_day FROM events""")
add("iso_week_volume", """SELECT isoyear(o_orderdate) AS iso_year, weekofyear(o_orderdate) AS iso_week,
  count(*) AS n_records FROM orders GROUP BY 1, 2""", i="iso_year iso_week")
add("coerce_datetimes", """SELECT event_id, CASE WHEN event_type IN ('click', 'view')
    THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS created,
  strftime(CASE WHEN event_type = 'error' THEN ts ELSE date_trunc('month', ts) END, '%Y-%m-%d') AS snapshot
  FROM events""")

# ---- text ----------------------------------------------------------------------

add("clean_text_nlp", f"SELECT doc_id, {clean('text', 'nlp')} AS cleaned FROM documents")
add("clean_text_pages", f"SELECT page_id, {clean('html', 'nlp')} AS cleaned FROM pages")
add("clean_text_eda", f"SELECT doc_id, {clean('text', 'eda')} AS cleaned FROM documents")
add("clean_text_full", f"SELECT doc_id, {clean('text', 'full')} AS cleaned FROM documents")
add("token_counts", f"""SELECT doc_id, len({keyword_tokens('text')}) AS keyword_tokens,
  len({tokens('text')}) AS word_tokens FROM documents""", i="keyword_tokens word_tokens")


def stats(length: str, source: str, by: str) -> str:
    return f"""SELECT {by}, avg({length}) AS avg_length, quantile_disc({length}, 0.5) AS median_length,
  min({length}) AS min_length, max({length}) AS max_length, count(*) AS sample_size FROM {source} GROUP BY {by}"""


STAT_INTS = "median_length min_length max_length sample_size"
add("text_length_stats", stats("length(text)", "documents", "lang"), d="avg_length", i=STAT_INTS)
add("text_coverage", f"""WITH h AS (SELECT lang, {clean('text', 'full')} AS cleaned FROM documents)
  SELECT lang, count(*) FILTER (length(cleaned) > 0) AS with_text, count(*) AS n FROM h GROUP BY lang""")
add("lexicon_sentiment", f"""WITH s AS (SELECT doc_id, {per_token('text')} AS sentiment_score FROM documents)
  SELECT doc_id, sentiment_score, abs(sentiment_score) AS sentiment_intensity,
  {label('sentiment_score')} AS sentiment FROM s""", d="sentiment_score sentiment_intensity")
add("lexicon_polarity", f"""WITH w AS (SELECT doc_id, list_distinct(string_split_regex(lower(text), {lit(f'[{SPACE}]+')})) AS ws
    FROM documents),
  c AS (SELECT doc_id, {hits('ws', t.TEST_POSITIVE)} AS p, {hits('ws', t.TEST_NEGATIVE)} AS n FROM w),
  s AS (SELECT doc_id, CASE WHEN p + n = 0 THEN 0.0 ELSE (p - n)::DOUBLE / (p + n) END AS sentiment_score FROM c)
  SELECT doc_id, sentiment_score, {label('sentiment_score', 0.2, -0.2, False)} AS sentiment FROM s""",
    d="sentiment_score")
_weight = "CASE w " + " ".join(f"WHEN {lit(w)} THEN {x}::DOUBLE" for w, x in t.TEST_WEIGHTS.items()) + " ELSE 0.0 END"
add("compound_sentiment", f"""WITH k AS (SELECT doc_id, unnest({tokens('text')}) AS w FROM documents),
  z AS (SELECT doc_id, sum({_weight}) AS x FROM k GROUP BY doc_id),
  s AS (SELECT d.doc_id, coalesce(x / sqrt(x * x + 15), 0.0) AS sentiment_score FROM documents d LEFT JOIN z USING (doc_id))
  SELECT doc_id, sentiment_score, {label('sentiment_score')} AS sentiment FROM s""", d="sentiment_score")
add("compound_sentiment_from_table", f"""WITH b AS (SELECT DISTINCT unnest({tokens('text')}) AS w FROM benchmark),
  k AS (SELECT doc_id, unnest({tokens('text')}) AS w FROM documents),
  z AS (SELECT doc_id, sum((length(w) - 4) / 10.0::DOUBLE) AS x FROM k JOIN b USING (w) GROUP BY doc_id),
  s AS (SELECT d.doc_id, coalesce(x / sqrt(x * x + 15), 0.0) AS sentiment_score FROM documents d LEFT JOIN z USING (doc_id))
  SELECT doc_id, sentiment_score, {label('round(sentiment_score, 12)')} AS sentiment FROM s""", d="sentiment_score")


def every(col: str, taxonomy) -> str:
    parts = ", ".join(f"CASE WHEN {hit(col, kws)} THEN {lit(k)} END" for k, kws in taxonomy.items())
    return f"array_to_string(list_filter([{parts}], lambda k: k IS NOT NULL), ',')"


ANY_RING = {**t.PART_KINDS, "any_ring": ["ring", "gear"]}
add("taxonomy_all", f"SELECT doc_id, {every('text', t.TEST_BRANDS)} AS brands FROM documents")
add("taxonomy_all_parts", f"SELECT p_partkey, {every('p_name', ANY_RING)} AS kinds FROM part")
add("taxonomy_first", f"SELECT doc_id, {TAGS('text')} FROM documents")
_edge, _nonword = f"(?:^|[^{WORD}])", f"(?:$|[^{WORD}])"
add("taxonomy_first_word", f"""SELECT doc_id, CASE
  WHEN regexp_matches(lower(text), {lit(_edge + '(?:of the|und)' + _nonword)}) THEN 'one'
  WHEN regexp_matches(lower(text), {lit(_edge + '(?:que la|des)' + _nonword)}) THEN 'two'
  WHEN regexp_matches(lower(text), {lit(_edge + 'the' + _nonword)}) THEN 'three' ELSE 'other' END AS tag FROM documents""")
add("taxonomy_reference_lists", f"""SELECT doc_id, {first('text', vocab.BRANDS)} AS brand,
  {first('text', vocab.TOPICS)} AS topic, {first('text', vocab.PRODUCTS)} AS product FROM documents""")
add("taxonomy_table_first", f"SELECT doc_id, {TAGS('text')} FROM documents")
add("taxonomy_table_all", f"SELECT doc_id, {every('text', t.TEST_BRANDS)} AS brands FROM documents")
add("taxonomy_table_parts", """WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS key FROM part),
  k AS (SELECT key, ascii(key) AS number, unnest([key, key[1:4], key[2:4]]) AS keyword FROM w),
  h AS (SELECT DISTINCT doc_id, number, key FROM documents JOIN k ON contains(lower(text), keyword)),
  g AS (SELECT doc_id, list(key ORDER BY number, key) AS keys FROM h GROUP BY doc_id)
  SELECT doc_id, coalesce(keys[1], 'none') AS first, coalesce(array_to_string(keys, ','), '') AS every
  FROM documents LEFT JOIN g USING (doc_id)""")
add("experience_type", f"""SELECT conv_id, turn, CASE WHEN {hit('text', t.TEST_PHRASES)}
  THEN 'personal_experience' ELSE 'opinion' END AS experience_type FROM conversations""")


def terms(source: str, score: str = "") -> str:
    extra = f", {score}" if score else ""
    kept = f"list_filter({keyword_tokens('text')}, lambda w: w NOT IN {words(vocab.STOP_WORDS)})"
    return f"""tk AS (SELECT source_type{extra}, {kept} AS ks FROM {source}),
kw AS (SELECT * FROM (SELECT source_type{extra}, unnest(ks) AS term FROM tk) WHERE length(term) > 2),
bg AS (SELECT source_type, ks[i] || ' ' || ks[i + 1] AS term FROM tk, unnest(range(1, greatest(len(ks), 1)::BIGINT)) AS u(i))"""


ORDER = "mentions DESC, term, source_type"
add("keyword_frequency", f"""WITH {RAW}, {terms('rw')} SELECT source_type, term, count(*) AS mentions
  FROM kw GROUP BY 1, 2""")


def language(col: str) -> str:
    padded = f"(' ' || lower({col}) || ' ')"

    def total(lang: str) -> str:
        return " + ".join(
            f"(length({padded}) - length(replace({padded}, {lit(f' {w} ')}, ''))) // {len(w) + 2}"
            for w in vocab.LANGUAGE_WORDS[lang])
    return f"""CASE WHEN {col} = '' THEN 'unknown'
  WHEN ({total('en')}) = 0 AND ({total('es')}) = 0 THEN
    CASE WHEN regexp_matches({padded}, '[{vocab.SPANISH_ACCENTS}]') THEN 'es' ELSE 'unknown' END
  WHEN ({total('en')}) >= ({total('es')}) THEN 'en' ELSE 'es' END"""


add("language_vote", f"SELECT doc_id, {language('text')} AS detected FROM documents")
add("language_confusion", f"""WITH c AS (SELECT lang, {clean('text', 'eda')} AS x FROM documents),
  v AS (SELECT lang AS declared, {language('x')} AS detected FROM c)
  SELECT declared, detected, declared = 'en' OR detected = 'en' AS is_english, declared = detected AS lang_match,
  count(*) AS rows FROM v GROUP BY ALL""")
add("text_agreement", f"""WITH c AS (SELECT text, {clean('text', 'eda')} AS x FROM documents)
  SELECT avg((text = x)::INT) AS equal_ratio, avg((text IS NULL)::INT) AS a_null_rate,
  avg((x = '')::INT) AS b_missing_rate FROM c""", d="equal_ratio a_null_rate b_missing_rate")

# ---- arrays and JSON -------------------------------------------------------------

add("explode_comments", """SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS comment FROM conversations""")
add("parse_comments", """SELECT conv_id, turn, CASE WHEN role = 'user' THEN len(string_split(text, chr(10))) ELSE 0 END
  AS n_comments FROM conversations""", i="n_comments")
add("explode_outer_comments", """SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS comment
  FROM conversations WHERE role = 'user'
  UNION ALL SELECT conv_id, turn, NULL FROM conversations WHERE role <> 'user'""")
add("comment_count_stats", stats("len(string_split(text, chr(10)))", "documents", "lang"), d="avg_length", i=STAT_INTS)
add("story_records", f"""WITH {BRANDS} SELECT to_json(list(struct_pack(brand := brand, total_mentions := total_mentions,
  mentions_news := mentions_news) ORDER BY total_mentions DESC, brand))::VARCHAR AS records FROM br""")
_R1 = "SELECT * REPLACE (round(positive_pct, 1) AS positive_pct, round(negative_pct, 1) AS negative_pct) FROM"
add("story_row", f"""WITH {BRANDS}, {TOPICS}, {products('al')},
  b AS ({_R1} br), o AS ({_R1} tp)
  SELECT {capital('top_brand')} || ' fue la marca más mencionada durante la semana con ' || n ||
    ' referencias entre redes sociales y comentarios de noticias.' AS executive_summary,
  top_brand, best_brand, worst_brand, top_positive_topics, top_negative_topics, top_products FROM (SELECT
    (SELECT brand FROM b ORDER BY total_mentions DESC, brand LIMIT 1) AS top_brand,
    (SELECT max(total_mentions) FROM b)::VARCHAR AS n,
    (SELECT brand FROM b ORDER BY positive_pct DESC, brand LIMIT 1) AS best_brand,
    (SELECT brand FROM b ORDER BY negative_pct DESC, brand LIMIT 1) AS worst_brand,
    (SELECT to_json(list(topic ORDER BY positive_pct DESC, topic)[1:3])::VARCHAR FROM o) AS top_positive_topics,
    (SELECT to_json(list(topic ORDER BY negative_pct DESC, topic)[1:3])::VARCHAR FROM o) AS top_negative_topics,
    (SELECT to_json(list(product ORDER BY mentions DESC, product)[1:5])::VARCHAR FROM pr) AS top_products)""")

# ---- identity ---------------------------------------------------------------------

add("latest_with_summary", """WITH s AS (SELECT doc_id, 2 AS silver_rows,
    CASE WHEN quality = 1 THEN 0.0 ELSE 0.5 END AS silver_text_missing FROM labels)
  SELECT d.doc_id, d.source, silver_rows, silver_text_missing FROM documents d LEFT JOIN s USING (doc_id)""",
    d="silver_text_missing", i="silver_rows")
add("distinct_labels", """SELECT lang AS key FROM documents UNION SELECT event_type FROM events
  UNION SELECT role FROM conversations""")
add("dedup_keep_last", "SELECT max(doc_id) AS doc_id, arg_max(source, doc_id) AS source FROM documents GROUP BY text")
add("dedup_keep_first", """SELECT min(doc_id) AS doc_id, lang, source, arg_min(n_chars, doc_id) AS n_chars
  FROM documents GROUP BY lang, source""")
add("surrogate_id", """SELECT 'surrogate_' || md5(trim(text) || '|' || trim(lang) || '|' || trim(source)) AS tweet_id,
  'surrogate_hash' AS tweet_id_origin, n_chars FROM documents""")
add("surrogate_id_blank", """SELECT CASE WHEN lang = 'fr' THEN 'surrogate_' || md5(source || '|' || n_chars)
  ELSE doc_id::VARCHAR END AS tweet_id,
  CASE WHEN lang = 'fr' THEN 'surrogate_hash' ELSE 'native_column' END AS tweet_id_origin, source FROM documents""")
add("duplicate_ids", "SELECT md5(text) AS key, count(*) AS rows FROM documents GROUP BY text HAVING count(*) > 1")
add("duplicate_share", """WITH c AS (SELECT text, count(*) AS n FROM documents GROUP BY text)
  SELECT count(*) FILTER (n > 1) AS duplicate_ids, coalesce(sum(n) FILTER (n > 1), 0) AS duplicate_rows,
  coalesce(sum(n) FILTER (n > 1), 0)::DOUBLE / sum(n) AS duplicate_row_share FROM c""",
    d="duplicate_row_share", i="duplicate_ids duplicate_rows")
add("upsert_keep_last", """SELECT doc_id AS id, 'q' || quality AS tag, toxic::BIGINT AS at FROM labels
  UNION ALL SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")

# ---- sentiment roll-ups ---------------------------------------------------------------

add("sentiment_pcts", f"WITH {TWEETS} SELECT lang, count(*) AS mentions, {PCTS} FROM tw GROUP BY lang", d=PCT_COLS)
add("sentiment_pcts_overall", f"WITH {TWEETS} SELECT count(*) AS mentions, {PCTS} FROM tw", d=PCT_COLS)
add("brand_analytics", f"WITH {BRANDS} SELECT * FROM br", d=PCT_COLS, i=BRAND_INTS)
ORACLES["brand_analytics_presented"] = f"""WITH {BRANDS} SELECT * REPLACE (total_engagement::BIGINT AS total_engagement,
  round(positive_pct, 1) AS positive_pct, round(negative_pct, 1) AS negative_pct,
  round(neutral_pct, 1) AS neutral_pct, round(avg_score, 4) + 0 AS avg_score) FROM br"""
add("topic_analytics", f"WITH {BOTH}, {TOPICS} SELECT * FROM tp", d=PCT_COLS)
add("product_analytics", f"WITH {BOTH}, {products('al')} SELECT * FROM pr", d=PCT_COLS)
PARTS = f"""pa AS (SELECT *, p_brand AS brand, {first('p_name', t.PART_KINDS)} AS product,
  (p_size - 25) / 25.0::DOUBLE AS sentiment_score FROM part),
pq AS (SELECT *, {label('sentiment_score')} AS sentiment FROM pa)"""
add("product_analytics_parts", f"WITH {PARTS}, {products('pq')} SELECT * FROM pr", d=PCT_COLS)


def influencers(source: str, author: str, followers: str, engagement: str, label_col: str, brand: str) -> str:
    return f"""g AS (SELECT {brand} AS brand, {author} AS author_userName, max({followers})::DOUBLE AS followers,
    sum({engagement})::DOUBLE AS engagement, count(*) AS tweet_count FROM {source} WHERE {brand} IS NOT NULL GROUP BY 1, 2),
  m AS (SELECT brand, author_userName, s FROM (SELECT {brand} AS brand, {author} AS author_userName, {label_col} AS s,
    row_number() OVER (PARTITION BY {brand}, {author} ORDER BY count(*) DESC, {label_col}) AS rn
    FROM {source} GROUP BY {brand}, {author}, {label_col}) WHERE rn = 1)
  SELECT g.*, m.s AS sentiment FROM g JOIN m USING (brand, author_userName)
  ORDER BY engagement DESC, brand, author_userName LIMIT 20"""


add("top_influencers", f"WITH {TWEETS}, " + influencers(
    "tw", "author_userName", "author_followers", "total_engagement", "sentiment", "brand"), d="followers engagement")
add("top_influencers_customers", """WITH oc AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'positive'
    WHEN 'O' THEN 'negative' ELSE 'neutral' END AS st FROM orders JOIN customer ON o_custkey = c_custkey), """
    + influencers("oc", "c_name", "c_acctbal", "o_totalprice", "st", "c_mktsegment"), d="followers engagement")
add("representative_comments", f"WITH {BOTH}, {REP} SELECT * FROM rp")
add("sentiment_distribution", f"""WITH {BOTH} SELECT sentiment, count(*) AS sentiment_count,
  avg(sentiment_score) AS avg_sentiment, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS sentiment_pct
  FROM al GROUP BY sentiment""", d="avg_sentiment sentiment_pct")
add("sentiment_distribution_by_day", f"""WITH {BOTH} SELECT event_date, sentiment, count(*) AS sentiment_count,
  avg(sentiment_score) AS avg_sentiment,
  100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY event_date) AS sentiment_pct
  FROM al GROUP BY event_date, sentiment""", d="avg_sentiment sentiment_pct")
for _name, _grain in (("sentiment_trend", "day"), ("sentiment_trend_weekly", "week")):
    add(_name, f"""WITH {BOTH} SELECT source_type, date_trunc('{_grain}', event_date)::DATE AS period,
  avg(sentiment_score) AS avg_sentiment, count(*) AS n_records FROM al GROUP BY 1, 2""", d="avg_sentiment")
add("source_comparison", f"""WITH {TWEETS} SELECT author_userName, avg(sentiment_score) AS avg_sentiment,
  count(*) AS n_records FROM tw GROUP BY 1""", d="avg_sentiment")
add("source_comparison_by_label", f"""WITH {BOTH} SELECT source_type, sentiment, avg(sentiment_score) AS avg_sentiment,
  count(*) AS n_records FROM al GROUP BY 1, 2""", d="avg_sentiment")
DAILY = "dv AS (SELECT ts::DATE AS period, event_type, count(*) AS n_records FROM events GROUP BY 1, 2)"
add("volume_trend", f"WITH {DAILY} SELECT * FROM dv")
add("cumulative_volume", f"""WITH {DAILY} SELECT *, sum(n_records) OVER (PARTITION BY event_type ORDER BY period)
  AS cumulative_records FROM dv""", i="cumulative_records")
KWC = "kc AS (SELECT source_type, term, count(*) AS mentions FROM kw GROUP BY 1, 2)"
add("top_keywords", f"""WITH {RAW}, {terms('rw')}, {KWC} SELECT source_type, term AS keyword, mentions AS keyword_count
  FROM (SELECT * FROM kc ORDER BY {ORDER} LIMIT 25)""")
add("top_keywords_per_source", f"""WITH {RAW}, {terms('rw')}, {KWC} SELECT source_type, term AS keyword,
  mentions AS keyword_count FROM (SELECT *, row_number() OVER (PARTITION BY source_type ORDER BY {ORDER}) AS rn FROM kc)
  WHERE rn <= 25""")
KWS = """ks AS (SELECT source_type, term, count(*) AS mentions, sum(sentiment_score) / count(*) AS a FROM kw GROUP BY 1, 2)"""
add("keyword_sentiment", f"""WITH {BOTH}, {terms('al', 'sentiment_score')}, {KWS}
  SELECT source_type, term AS keyword, a AS avg_sentiment, mentions, CASE WHEN a > 0 THEN 'positive'
  WHEN a < 0 THEN 'negative' ELSE 'neutral' END AS polarity
  FROM (SELECT * FROM ks WHERE mentions >= 5 ORDER BY {ORDER} LIMIT 25)""", d="avg_sentiment")
add("top_bigrams", f"""WITH {RAW}, {terms('rw')}, bc AS (SELECT source_type, term, count(*) AS mentions FROM bg GROUP BY 1, 2)
  SELECT source_type, term AS bigram, mentions AS bigram_count FROM (SELECT * FROM bc ORDER BY {ORDER} LIMIT 25)""")
add("topic_terms", f"""WITH {RAW}, {terms('rw')}, {KWC} SELECT source_type, term, mentions AS keyword_count
  FROM (SELECT * FROM kc ORDER BY {ORDER} LIMIT 10)""")
add("kpi_share", f"""WITH {BOTH} SELECT sentiment, count(*)::DOUBLE / sum(count(*)) OVER () AS percentage
  FROM al GROUP BY sentiment""", d="percentage")
add("kpi_score", f"""WITH {BOTH} SELECT sentiment, avg(sentiment_score) AS mean, stddev_samp(sentiment_score) AS std
  FROM al GROUP BY sentiment""", d="mean std")
add("topic_kpi", f"""WITH {BOTH} SELECT topic, avg(sentiment_score) AS avg_score, count(*) AS count
  FROM al WHERE topic IS NOT NULL GROUP BY topic""", d="avg_score")
add("trend_kpi", f"""WITH {BOTH} SELECT event_date AS date_only, sentiment, count(*) AS count FROM al GROUP BY 1, 2""")


def mentions(col: str, source: str, taxonomy) -> str:
    return " UNION ALL ".join(
        f"SELECT {lit(k)} AS key, count(*) FILTER ({hit(col, kws)}) AS mentions, "
        f"100.0::DOUBLE * count(*) FILTER ({hit(col, kws)}) / count(*) AS share_pct FROM {source}"
        for k, kws in taxonomy.items())


add("mention_counts", mentions("text", "documents", t.TEST_BRANDS), d="share_pct")
add("mention_counts_published", mentions("text", """(SELECT ['Galaxy', 'iPhone', 'moto g', 'Redmi', 'radio'][p_partkey % 5 + 1]
  || ' ' || p_name AS text FROM part)""", vocab.EDA_BRANDS), d="share_pct")
add("mention_counts_parts", mentions("p_name", "part", ANY_RING), d="share_pct")
add("reach_by_brand", f"""SELECT {first('p_name', t.PART_KINDS)} AS brand, avg(l_extendedprice) AS avg_reach
  FROM part JOIN lineitem ON p_partkey = l_partkey WHERE {first('p_name', t.PART_KINDS)} IS NOT NULL GROUP BY 1""",
    d="avg_reach")
add("daily_entity_summary", """SELECT ts::DATE AS gold_event_date, event_type AS gold_entity,
  count(DISTINCT user_id) AS unique_records, avg((value > 20)::INT) AS text_coverage_ratio,
  sum(value) AS total_tweet_likeCount FROM events GROUP BY 1, 2""", d="text_coverage_ratio total_tweet_likeCount")
add("daily_entity_summary_mixed", f"""WITH {MIXED} SELECT gold_event_date, gold_entity,
  count(DISTINCT gold_record_id) AS unique_records, avg((length(gold_text_clean) > 0)::INT) AS text_coverage_ratio,
  sum(tweet_likeCount) AS total_tweet_likeCount FROM mx GROUP BY 1, 2""",
    d="text_coverage_ratio", i="total_tweet_likeCount")
add("topic_polarity", f"""WITH {BOTH} SELECT topic, count(*) FILTER (sentiment = 'positive') AS positive_mentions,
  count(*) FILTER (sentiment = 'negative') AS negative_mentions, count(*) AS mentions
  FROM al WHERE topic IS NOT NULL GROUP BY topic""")

# ---- story ------------------------------------------------------------------------------


def mood(source: str) -> str:
    return f"""SELECT *, CASE WHEN positive > negative AND positive > neutral THEN 'Positive'
  WHEN negative > positive AND negative > neutral THEN 'Negative' ELSE 'Neutral' END AS dominant FROM (
  SELECT coalesce(sum(total_mentions * positive_pct / 100), 0) AS positive,
    coalesce(sum(total_mentions * neutral_pct / 100), 0) AS neutral,
    coalesce(sum(total_mentions * negative_pct / 100), 0) AS negative FROM {source})"""


add("mood_snapshot", f"WITH {BRANDS} {mood('br')} UNION ALL {mood('br WHERE brand = ' + lit('beta'))}",
    d="positive neutral negative")


def long(source: str, key: str, count: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, {lit(m)} AS sentiment, {count} * {m.lower()}_pct / 100 AS mentions FROM {source}"
        for m in ("Positive", "Neutral", "Negative"))


add("brand_sentiment_long", f"WITH {BRANDS} {long('br', 'brand', 'total_mentions')}", d="mentions")
add("product_sentiment_long", f"""WITH {PARTS}, {products('pq')}, p5 AS (SELECT * FROM pr ORDER BY mentions DESC, product LIMIT 5)
  {long('p5', 'product', 'mentions')}""", d="mentions")
add("channel_breakdown", f"""WITH {BRANDS} SELECT brand, 'mentions_twitter' AS channel, mentions_twitter AS mentions
  FROM br WHERE brand = 'alpha' UNION ALL SELECT brand, 'mentions_news', mentions_news FROM br WHERE brand = 'alpha'""")
add("topic_drilldown", f"""WITH {TWEETS} SELECT topic, count(*) AS mentions, avg(sentiment_score) AS avg_score FROM tw
  WHERE brand = 'alpha' AND topic IS NOT NULL GROUP BY topic ORDER BY mentions DESC, topic LIMIT 12""", d="avg_score")
add("engagement_points", f"""WITH {TWEETS} SELECT tweet_id, brand, topic, sentiment, sentiment_score,
  total_engagement::DOUBLE AS total_engagement, author_followers::DOUBLE AS followers FROM tw""",
    d="sentiment_score total_engagement followers")
add("brand_narrative", f"""WITH {BRANDS} SELECT brand, 'During the current week, the brand ' || {capital('brand')} ||
  ' accumulated a total volume of ' || format('{{:,}}', total_mentions) ||
  ' mentions across the monitored channels. General consumer perception is ' ||
  CASE WHEN avg_score > 0.05 THEN 'mostly positive' WHEN avg_score < -0.05 THEN 'mostly critical' ELSE 'mostly neutral' END ||
  ' with a net sentiment score of ' || CASE WHEN round(avg_score, 4) >= 0 THEN '+' ELSE '' END ||
  printf('%.4f', round(avg_score, 4)) || '. Specifically, ' || printf('%.1f', round(positive_pct, 1)) ||
  '% of discussions were positive, while ' || printf('%.1f', round(negative_pct, 1)) ||
  '% showed negative consumer feedback. A detailed breakdown of the products and discussion categories ' ||
  'driving this behavior is displayed below.' AS narrative FROM br""")
_quote = lambda c: (f"CASE WHEN {c} IS NULL OR lower(trim({c})) IN ('', 'none', 'nan') THEN NULL WHEN length({c}) > 260 "
                    f"THEN '\"' || left({c}, 260) || '...\"' ELSE '\"' || {c} || '\"' END")
add("comment_quotes", f"""WITH {BOTH}, {REP} SELECT * FROM (SELECT {capital('brand')} AS brand,
  {_quote('best_comment')} AS best_quote, {_quote('worst_comment')} AS worst_quote FROM rp)
  WHERE best_quote IS NOT NULL OR worst_quote IS NOT NULL""")

# ---- trends and windows ------------------------------------------------------------------

EVENT_DAYS = f"""ev AS (SELECT ts::DATE AS date_day, event_type AS brand, 'events' AS source, value AS sentiment_score,
  CASE WHEN value >= 60 THEN 'positive' WHEN value <= 20 THEN 'negative' ELSE 'neutral' END AS sentiment FROM events),
ds AS (SELECT date_day, source, brand, count(*) AS mentions, {PCTS} FROM ev GROUP BY 1, 2, 3)"""
TEXT_DAYS = f"""{BOTH},
dt AS (SELECT event_date AS date_day, CASE source_type WHEN 'tweets' THEN 'Twitter' ELSE 'News' END AS source, brand,
  count(*) AS mentions, {PCTS} FROM al WHERE brand IS NOT NULL GROUP BY 1, 2, 3)"""
add("daily_sentiment", f"WITH {EVENT_DAYS} SELECT * FROM ds", d=PCT_COLS)
add("daily_sentiment_texts", f"WITH {TEXT_DAYS} SELECT * FROM dt", d=PCT_COLS)
add("daily_trend_all", f"""WITH {EVENT_DAYS} SELECT date_day, source, avg(positive_pct) AS positive_pct,
  avg(negative_pct) AS negative_pct, avg(neutral_pct) AS neutral_pct, sum(mentions) AS mentions FROM ds GROUP BY 1, 2""",
    d="positive_pct negative_pct neutral_pct", i="mentions")
add("daily_trend_all_weighted", f"""WITH {EVENT_DAYS} SELECT date_day, source,
  count(*) FILTER (sentiment = 'positive') * 100.0::DOUBLE / count(*) AS positive_pct,
  count(*) FILTER (sentiment = 'negative') * 100.0::DOUBLE / count(*) AS negative_pct,
  count(*) FILTER (sentiment = 'neutral') * 100.0::DOUBLE / count(*) AS neutral_pct,
  count(*) AS mentions FROM ev GROUP BY 1, 2""", d="positive_pct negative_pct neutral_pct")


def alerts(calendar: bool) -> str:
    keep = "WHERE date_day - pd = 1" if calendar else ""
    return f"""a0 AS (SELECT brand, source, date_day, round(negative_pct, 1) AS cn, round(positive_pct, 1) AS cp,
    lag(round(negative_pct, 1)) OVER w AS pn, lag(round(positive_pct, 1)) OVER w AS pp, lag(date_day) OVER w AS pd
    FROM dt WINDOW w AS (PARTITION BY brand, source ORDER BY date_day)),
  a1 AS (SELECT *, round(cn - pn, 6) AS dn, round(cp - pp, 6) AS dp FROM a0 {keep}),
  sa AS (SELECT brand, source, date_day AS date, pn AS prev_pct, cn AS curr_pct, round(dn, 1) AS delta,
      'negative_spike' AS type, CASE WHEN dn >= 25 THEN 'critical' ELSE 'warning' END AS severity FROM a1 WHERE dn >= 15
    UNION ALL SELECT brand, source, date_day, pp, cp, round(dp, 1), 'positive_recovery', 'info'
      FROM a1 WHERE dp >= 15 AND pp < 40)"""


add("sentiment_alerts", f"WITH {TEXT_DAYS}, {alerts(False)} SELECT * FROM sa", d="prev_pct curr_pct delta")
add("sentiment_alerts_calendar", f"WITH {TEXT_DAYS}, {alerts(True)} SELECT * FROM sa", d="prev_pct curr_pct delta")
add("alert_sentences", f"""WITH {TEXT_DAYS}, {alerts(False)},
  o AS (SELECT * FROM sa ORDER BY CASE severity WHEN 'critical' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END,
    date, brand, source, type LIMIT 10)
  SELECT date, severity, '[' || upper(severity) || '] ' || CASE type WHEN 'negative_spike' THEN 'Negative Spike'
    ELSE 'Positive Recovery' END || ' — ' || {capital('brand')} || ': ' || CASE type WHEN 'negative_spike'
    THEN 'Negative sentiment jumped from ' ELSE 'Positive sentiment recovered from ' END ||
    printf('%.1f', prev_pct) || '% to ' || printf('%.1f', curr_pct) || '% (+' || printf('%.1f', delta) || ' pp)'
    AS sentence FROM o""")
add("snapshot_rank", """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)
  AS snapshot_rank FROM events""")
add("latest_per_key", """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""", d="value")
add("top_k_per_group", """SELECT o_orderpriority, o_orderkey, o_totalprice, rn AS rank FROM (SELECT *, row_number() OVER (
  PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 5""", d="o_totalprice")
add("top_topics", f"""WITH {BOTH}, {TOPICS} SELECT * FROM tp ORDER BY round(positive_pct, 6) DESC, topic LIMIT 3""", d=PCT_COLS)
add("moving_average", f"""WITH {DAILY} SELECT *, avg(n_records) OVER (PARTITION BY event_type ORDER BY period
  ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg FROM dv""", d="moving_avg")
add("peak_days", """SELECT ts::DATE AS period, count(*) AS n_records,
  100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS share_pct FROM events GROUP BY 1
  ORDER BY n_records DESC, period LIMIT 10""", d="share_pct")
add("tumbling_volume", """SELECT ts::DATE AS period, event_type, count(*) AS n_records, sum(value) AS score_sum,
  avg(value) AS avg_score FROM events GROUP BY 1, 2""", d="score_sum avg_score")

# ---- governance ------------------------------------------------------------------------------

DUP = """total_records, distinct_records, total_records - distinct_records AS duplicate_rows,
  100.0::DOUBLE * (total_records - distinct_records) / total_records AS duplicate_rate"""
add("duplicate_rate", f"""SELECT {DUP} FROM (SELECT count(*) AS total_records, count(DISTINCT text) AS distinct_records
  FROM documents)""", d="duplicate_rate")
add("duplicate_rate_null_as_value", f"""WITH {LABELLED} SELECT {DUP} FROM (SELECT count(*) AS total_records,
  (SELECT count(*) FROM (SELECT DISTINCT quality, toxic, lang FROM lb)) AS distinct_records FROM lb)""", d="duplicate_rate")
add("row_compliance", f"""WITH {LABELLED} SELECT count(*) AS total_records, count(quality) AS compliant_rows,
  100.0::DOUBLE * count(quality) / count(*) AS compliance_rate FROM lb""", d="compliance_rate")
_blank = {"text": "trim(text) = '' OR text IS NULL", "lang": "lang IS NULL", "quality": "quality IS NULL",
          "toxic": "toxic IS NULL", "note": "lang = 'fr'"}
add("null_rates", f"WITH {LABELLED} " + " UNION ALL ".join(
    f"SELECT {lit(f)} AS field, count(*) FILTER ({c}) AS null_count, "
    f"100.0::DOUBLE * count(*) FILTER ({c}) / count(*) AS null_rate, count(*) AS sample_size FROM lb"
    for f, c in _blank.items()), d="null_rate")
add("text_stats", f"WITH {RAW} " + stats("length(text)", "rw", "source_type"), d="avg_length", i=STAT_INTS)
add("language_distribution", """SELECT CASE WHEN lang <> 'es' THEN lang ELSE 'unknown' END AS lang,
  count(*) AS language_count, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS language_pct
  FROM documents GROUP BY 1""", d="language_pct")


def outliers(source: str, cols, quantile: str) -> str:
    return " UNION ALL ".join(f"""SELECT * FROM (WITH b AS (SELECT {quantile}({c}::DOUBLE, 0.25) AS q1,
    {quantile}({c}::DOUBLE, 0.75) AS q3 FROM {source})
  SELECT {lit(c)} AS metric, any_value(q1 - 1.5 * (q3 - q1)) AS lower, any_value(q3 + 1.5 * (q3 - q1)) AS upper,
    count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers, count(*) AS sample_size,
    100.0::DOUBLE * count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / count(*) AS outlier_rate
  FROM {source}, b WHERE {c} IS NOT NULL)""" for c in cols)


OUT = "lower upper outlier_rate"
add("outlier_rate_approx", outliers("lineitem", ["l_quantity", "l_discount", "l_tax"], "quantile_disc"), d=OUT)
add("outlier_rate_approx_texts", f"WITH {TWEETS} " + outliers(
    "tw", ["likeCount", "replyCount", "total_engagement"], "quantile_disc"), d=OUT)
add("outlier_rate_exact", outliers("lineitem", ["l_quantity", "l_extendedprice", "l_discount"], "quantile_cont"), d=OUT)
add("outlier_rate_exact_events", outliers("events", ["value"], "quantile_cont"), d=OUT)

SILVER = f"""{LABELLED},
si AS (SELECT doc_id::VARCHAR AS id, text, quality::VARCHAR AS createdAt, lang, source AS author_userName,
  toxic AS retweetCount, n_chars AS likeCount, {day('doc_id')} AS event_date FROM lb),
sn AS (SELECT 'conv/' || conv_id AS newsLink, string_split(text, chr(10)) AS comments,
  CASE WHEN role = 'user' THEN '2024-01-01' END AS snapshot_date, {day('conv_id')} AS event_date FROM conversations)"""


def metric(section, source, name, label_sql, value, pct="NULL", sample="NULL", period="NULL", notes="NULL", tail=""):
    return f"""SELECT {lit(section)} AS section, {source} AS source_type, {lit(name)} AS metric_name,
  {label_sql}::VARCHAR AS metric_label, {period}::VARCHAR AS period, ({value})::DOUBLE AS metric_value,
  ({pct})::DOUBLE AS metric_pct, ({sample})::BIGINT AS sample_size, {notes}::VARCHAR AS notes {tail}"""


def source_metrics(tab, tag, key, required, length, length_name, length_label, langs, metrics) -> list[str]:
    src, parts = lit(tag), []
    parts.append(metric("summary", src, "total_records", "'total_records'", "count(*)", sample="count(*)", tail=f"FROM {tab}"))
    parts.append(metric("summary", src, "duplicate_rows", lit(key), f"count(*) - count(DISTINCT {key})",
                        f"100.0::DOUBLE * (count(*) - count(DISTINCT {key})) / count(*)", "count(*)", tail=f"FROM {tab}"))
    ok = " AND ".join(f"{f} IS NOT NULL" for f in required)
    parts.append(metric("summary", src, "schema_compliance_rate", lit(",".join(required)), f"count(*) FILTER ({ok})",
                        f"100.0::DOUBLE * count(*) FILTER ({ok}) / count(*)", "count(*)", tail=f"FROM {tab}"))
    for f in required:
        miss = f"{f} IS NULL" if f == "comments" else f"{f} IS NULL OR trim({f}) = ''"
        parts.append(metric("null_rates", src, "null_rate", lit(f), f"count(*) FILTER ({miss})",
                            f"100.0::DOUBLE * count(*) FILTER ({miss}) / count(*)", "count(*)", tail=f"FROM {tab}"))
    parts.append(metric("volume_trend", src, "records_per_day", src, "count(*)", period="strftime(event_date, '%Y-%m-%d')",
                        tail=f"FROM {tab} GROUP BY event_date"))
    parts.append(metric("text_stats", src, length_name, lit(length_label), f"avg({length})", sample="count(*)",
                        notes=f"('median=' || quantile_disc({length}, 0.5) || ', min=' || min({length}) || ', max=' || max({length}))",
                        tail=f"FROM {tab}"))
    if langs:
        parts.append(metric("language_distribution", src, "language_count", "lang", "count(*)",
                            "100.0::DOUBLE * count(*) / sum(count(*)) OVER ()", tail=f"FROM {tab} GROUP BY lang"))
    for name, expr in metrics.items():
        parts.append(metric("outlier_rate", src, "outlier_rate", lit(name), "outliers", "outlier_rate", "sample_size",
                            notes="('IQR bounds [' || lower || ', ' || upper || ']')",
                            tail=f"FROM ({outliers(f'(SELECT {expr} AS {name} FROM {tab})', [name], 'quantile_disc')})"))
    return parts


GOVERNANCE = f"""{SILVER}, gs AS (""" + " UNION ALL ".join(
    source_metrics("si", "tweets", "id", vocab.REQUIRED_FIELDS["tweets"], "length(text)", "text_length", "tweets_text",
                   True, {"retweetCount": "retweetCount", "likeCount": "likeCount"})
    + source_metrics("sn", "news", "newsLink", vocab.REQUIRED_FIELDS["news"], "len(comments)", "comment_count",
                     "news_comments", False, {"comment_count": "len(comments)"})) + ")"
add("governance_summary", f"WITH {GOVERNANCE} SELECT * FROM gs", d="metric_value metric_pct")
add("governance_kpi_view", f"""WITH {GOVERNANCE} SELECT metric_name || ':' || metric_label AS kpi_name,
  coalesce(metric_pct, metric_value) AS kpi_value, source_type AS source, period AS period_start, period AS period_end,
  '2024-01-31' AS computed_at FROM gs""", d="kpi_value")

_n = "(SELECT count(*) FROM al)"
_iso = "strftime(event_date, '%Y-%m-%d')"
add("storytelling_summary", f"""WITH {BOTH}, {terms('al', 'sentiment_score')}, {KWS},
  bc AS (SELECT source_type, term, count(*) AS mentions FROM bg GROUP BY 1, 2),
  k25 AS (SELECT * FROM ks ORDER BY {ORDER} LIMIT 25), k10 AS (SELECT * FROM ks ORDER BY {ORDER} LIMIT 10),
  b25 AS (SELECT * FROM bc ORDER BY {ORDER} LIMIT 25) """ + " UNION ALL ".join([
    metric("sentiment_distribution", "'all'", "sentiment_count", "sentiment", "count(*)",
           f"100.0::DOUBLE * count(*) / {_n}", _n,
           notes="('avg_sentiment=' || printf('%.4f', round(avg(sentiment_score), 4) + 0))", tail="FROM al GROUP BY sentiment"),
    metric("sentiment_trend", "source_type", "avg_daily_sentiment", "NULL", "avg(sentiment_score)", sample="count(*)",
           period=_iso, tail="FROM al GROUP BY source_type, event_date"),
    metric("source_comparison", "source_type", "avg_sentiment", "'all_text'", "avg(sentiment_score)", sample="count(*)",
           tail="FROM al GROUP BY source_type"),
    metric("volume_trend", "source_type", "records_per_day", "NULL", "count(*)", sample=_n, period=_iso,
           tail="FROM al GROUP BY source_type, event_date"),
    metric("top_keywords", "source_type", "keyword_frequency", "term", "mentions", sample=_n, tail="FROM k25"),
    metric("keyword_sentiment", "source_type", "avg_sentiment_by_keyword", "term", "a", sample="mentions", tail="FROM k25"),
    metric("top_bigrams", "source_type", "bigram_frequency", "term", "mentions", sample=_n, tail="FROM b25"),
    metric("topic_insights", "source_type", "top_topic_term", "term", "mentions", sample=_n, notes="'proxy topic term'",
           tail="FROM k10"),
]), d="metric_value metric_pct")

GOV = f"""{BOTH}, gt AS (SELECT tw.* REPLACE (CASE WHEN l.quality IS NOT NULL THEN author_userName END AS author_userName)
  FROM tw LEFT JOIN labels l ON l.doc_id::VARCHAR = tw.tweet_id)"""


def cells(extra: int) -> str:
    return f"""nc AS (SELECT (SELECT count(*) FILTER (author_userName IS NULL) FROM gt) + {extra} * (SELECT count(*) FROM nw)
    AS null_cells, 6 * (SELECT count(*) FROM gt) + {5 + extra} * (SELECT count(*) FROM nw) AS cells)"""


add("critical_null_rate", f"""WITH {GOV}, {cells(1)} SELECT *, 100.0::DOUBLE * null_cells / cells AS null_rate FROM nc""",
    d="null_rate", i="null_cells cells")
add("null_profile", f"WITH {LABELLED} " + " UNION ALL ".join(
    f"SELECT {lit(c)} AS column, 100.0::DOUBLE * count(*) FILTER ({c} IS NULL) / count(*) AS null_pct FROM lb"
    for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")), d="null_pct")
add("combined_dup_rate", """SELECT d AS duplicate_rows, n AS total_records, 100.0::DOUBLE * d / n AS duplicate_rate FROM (
  SELECT (SELECT count(*) - count(DISTINCT text) FROM documents) + (SELECT count(*) FROM conversations) -
    (SELECT count(*) FROM (SELECT DISTINCT conv_id, role FROM conversations)) AS d,
  (SELECT count(*) FROM documents) + (SELECT count(*) FROM conversations) AS n)""", d="duplicate_rate")
add("column_compliance", """SELECT count(*) AS n, 100.0::DOUBLE * 16 / 18 AS tweets_pct, 100.0::DOUBLE * 8 / 9 AS news_pct,
  'brand,date_day,product,sentiment,sentiment_intensity,sentiment_score,topic' AS shared FROM documents""",
    d="tweets_pct news_pct")
add("diversity", f"""WITH {TWEETS} SELECT count(DISTINCT lang) AS unique_languages, sum(total_engagement) AS total_engagement
  FROM tw""", i="unique_languages total_engagement")
METRICS = f"""{GOV}, {cells(0)}, mt AS (SELECT (SELECT count(*) FROM gt) + (SELECT count(*) FROM nw) AS total_records,
  (SELECT 100.0::DOUBLE * null_cells / cells FROM nc) AS null_rate,
  100.0::DOUBLE * ((SELECT count(*) FROM nw) - (SELECT count(*) FROM (SELECT DISTINCT newsLink, comment_text FROM nw)))
    / ((SELECT count(*) FROM gt) + (SELECT count(*) FROM nw)) AS duplicate_rate,
  (100.0::DOUBLE * 16 / 18 + 100.0::DOUBLE * 8 / 9) / 2 AS schema_compliance,
  (SELECT count(DISTINCT lang) FROM gt) AS unique_languages, (SELECT sum(total_engagement) FROM gt) AS total_engagement)"""
add("kpi_table", f"""WITH {METRICS} SELECT 'total_records' AS kpi, total_records::DOUBLE AS value, 'N/A' AS threshold,
    'INFO' AS status FROM mt
  UNION ALL SELECT 'null_rate', null_rate, '< 5', CASE WHEN null_rate < 5 THEN 'PASS' ELSE 'FAIL' END FROM mt
  UNION ALL SELECT 'duplicate_rate', duplicate_rate, '< 2', CASE WHEN duplicate_rate < 2 THEN 'PASS' ELSE 'WARNING' END FROM mt
  UNION ALL SELECT 'schema_compliance', schema_compliance, '> 95',
    CASE WHEN schema_compliance > 95 THEN 'PASS' ELSE 'FAIL' END FROM mt
  UNION ALL SELECT 'unique_languages', unique_languages::DOUBLE, 'N/A', 'INFO' FROM mt
  UNION ALL SELECT 'total_engagement', total_engagement::DOUBLE, 'N/A', 'INFO' FROM mt""", d="value")
add("kpi_bands", f"""WITH {METRICS} SELECT 'null_rate' AS kpi, null_rate AS value, CASE WHEN null_rate < 2 THEN 'Optimal'
    WHEN null_rate < 5 THEN 'Warning' ELSE 'Critical' END AS band FROM mt
  UNION ALL SELECT 'duplicate_rate', duplicate_rate, CASE WHEN duplicate_rate < 1 THEN 'Optimal'
    WHEN duplicate_rate < 2 THEN 'Warning' ELSE 'Critical' END FROM mt
  UNION ALL SELECT 'schema_compliance', schema_compliance, CASE WHEN schema_compliance >= 98 THEN 'Compliant'
    WHEN schema_compliance >= 95 THEN 'Minor Drift' ELSE 'Critical' END FROM mt""", d="value")
add("length_box", f"""WITH {RAW} SELECT source_type, count(*) AS sample_size, min(length(text)) AS min_length,
  quantile_cont(length(text)::DOUBLE, 0.25) AS q1, quantile_cont(length(text)::DOUBLE, 0.5) AS median,
  quantile_cont(length(text)::DOUBLE, 0.75) AS q3, max(length(text)) AS max_length FROM rw GROUP BY 1""",
    d="min_length q1 median q3 max_length")

# ---- profiling ----------------------------------------------------------------------------------


def audit(source: str, cols: dict[str, str | None]) -> str:
    kind = lambda k: f"{lit(k)} AS dtype, " if k else ""
    return " UNION ALL ".join(
        f"SELECT {lit(c)} AS column, {kind(k)}1 - count({c})::DOUBLE / count(*) AS missing_ratio, "
        f"count({c}) AS non_null_count, count(DISTINCT {c}) AS nunique FROM {source}" for c, k in cols.items())


LB_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint",
            "quality": "int", "toxic": "int"}
add("column_audit", f"WITH {LABELLED} " + audit("lb", LB_TYPES), d="missing_ratio")
add("column_audit_orders", audit("orders", dict.fromkeys(
    ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])), d="missing_ratio")
_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
add("describe_numeric", " UNION ALL ".join(f"""SELECT {lit(c)} AS metric, count({c}) AS count, avg({c}) AS mean,
  stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max, quantile_cont({c}, 0.25) AS q1,
  quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM lineitem""" for c in _NUM),
    d="mean std min max q1 median q3", digits=4)
_QS = {
    "rows": "count(*)", "columns": "max(5)",
    "duplicate_rows": "count(*) - (SELECT count(*) FROM (SELECT DISTINCT source, text, lang, n_chars, quality FROM lb))",
    "duplicate_rate": "1 - (SELECT count(*) FROM (SELECT DISTINCT source, text, lang, n_chars, quality FROM lb))::DOUBLE / count(*)",
    "id_null_rate": "1 - count(source)::DOUBLE / count(*)",
    "id_unique_rate": "count(DISTINCT source)::DOUBLE / count(*)",
    "text_missing_rate": "count(*) FILTER (text IS NULL OR text = '')::DOUBLE / count(*)",
    "avg_text_length": "avg(length(coalesce(text, '')))", "date_missing_rate": "1 - count(quality)::DOUBLE / count(*)",
}
add("quality_summary", f"WITH {LABELLED} " + " UNION ALL ".join(
    f"SELECT {lit(k)} AS metric, ({v})::DOUBLE AS value FROM lb" for k, v in _QS.items()), d="value")
add("top_values", f"""WITH {LABELLED} SELECT coalesce(quality::VARCHAR, 'Unknown') AS value, count(*) AS rows FROM lb
  GROUP BY 1 ORDER BY rows DESC, value LIMIT 10""")
add("top_values_source", """SELECT source AS value, count(*) AS rows FROM documents GROUP BY 1
  ORDER BY rows DESC, value LIMIT 10""")
add("candidate_columns", f"""WITH {LABELLED} SELECT "column", missing_ratio FROM ({audit('lb', LB_TYPES)})
  WHERE missing_ratio <= 0.35""", d="missing_ratio")
_CAT = {  # column: source column (None: all null), family, recommendation while filled, and by sparsity
    "_id": ("doc_id", "lineage", "Keep as lineage"), "clean_text": ("text", "text_nlp", "Keep"),
    "detected_lang": ("lang", "text_nlp", "Keep"), "tweet_author_name": ("source", "author", "Keep"),
    "tweet_likeCount": ("n_chars", "tweet", "Keep"), "tweet_quoted_tweet_text": ("quality", "quote", "Review"),
    "news_newsLink": ("toxic", "text_nlp", "Keep"), "record_type": ("doc_id", "grain", "Keep"),
    "tweet_author_coverPicture": ("quality", "author", "Review"),
    "news_comments_raw": (None, "news", "Drop for Gold"), "tweet_place": (None, "tweet", "Review"),
    "event_date": ("quality", "time", "Keep"), "misc": ("lang", "other", "Review"),
}
CATALOG = f"{LABELLED}, ct AS (" + " UNION ALL ".join(
    f"SELECT {lit(c)} AS column, " + (f"1 - count({src})::DOUBLE / count(*)" if src else "1 - 0 * count(*)::DOUBLE")
    + f" AS missing_ratio, {lit(fam)} AS family, {lit(rec)} AS recommendation FROM lb"
    for c, (src, fam, rec) in _CAT.items()) + ")"
add("column_catalog", f"WITH {CATALOG} SELECT * FROM ct", d="missing_ratio")
add("column_catalog_families", f"WITH {CATALOG} SELECT family, recommendation, count(*) AS columns FROM ct GROUP BY 1, 2")
add("corr_matrix", " UNION ALL ".join(f"SELECT {lit(a)} AS a, {lit(b)} AS b, corr({a}, {b}) AS corr FROM lineitem"
                                      for a in _NUM for b in _NUM), d="corr")
_WIDE = "wi AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in t.WIDE_COLUMNS.items()) + " FROM lineitem)"
add("corr_matrix_wide", f"WITH {_WIDE}, wr AS (SELECT " + ", ".join(
    f"corr({a}, {b}) AS {a}{b}" for a in t.WIDE_COLUMNS for b in t.WIDE_COLUMNS if a <= b) + """ FROM wi), wu AS (UNPIVOT wr ON COLUMNS(*) INTO NAME p VALUE corr)
  SELECT p[1:3] AS a, p[4:6] AS b, corr FROM wu UNION ALL SELECT p[4:6], p[1:3], corr FROM wu WHERE p[1:3] <> p[4:6]""", d="corr")
ENG = "en AS (SELECT l_quantity, l_extendedprice, CASE WHEN l_returnflag <> 'R' THEN l_tax END AS l_tax FROM lineitem)"
add("engagement_summary", f"WITH {ENG} " + " UNION ALL ".join(f"""SELECT {lit(c)} AS metric,
  1 - count({c})::DOUBLE / count(*) AS missing_ratio, avg({c}) AS mean, avg(ln(1 + {c})) AS mean_log1p,
  quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.95) AS p95, quantile_cont({c}, 0.99) AS p99 FROM en"""
  for c in ("l_quantity", "l_extendedprice", "l_tax")), d="missing_ratio mean mean_log1p median p95 p99", digits=4)
add("crosstab", """SELECT coalesce(lang, 'Unknown') AS lang, coalesce(source, 'Unknown') AS source, count(*) AS n
  FROM documents GROUP BY 1, 2""")
add("null_structure", f"""WITH {LABELLED}, m AS (SELECT 'tweet' AS record_type, text, quality AS parsed, doc_id,
    NULL::VARCHAR AS role FROM lb
  UNION ALL SELECT 'news_comment', text, CASE WHEN turn > 0 THEN turn END, NULL, role FROM conversations)
  SELECT record_type, count(*) AS rows, avg((length(coalesce(text, '')) > 0)::INT) AS has_text_ratio,
  avg((length(coalesce(text, '')) = 0)::INT) AS null_text_ratio, avg((parsed IS NULL)::INT) AS null_datetime_ratio,
  avg((doc_id IS NULL)::INT) AS doc_id_null_ratio, avg((role IS NULL)::INT) AS role_null_ratio FROM m GROUP BY 1""",
    d="has_text_ratio null_text_ratio null_datetime_ratio doc_id_null_ratio role_null_ratio")
add("entity_mix", f"""WITH {MIXED} SELECT gold_entity AS entity, count(*) AS records,
  avg((length(coalesce(gold_text_clean, '')) > 0)::INT) AS text_coverage, min(gold_event_date) AS first_date,
  max(gold_event_date) AS last_date, count(gold_event_date) AS dated,
  100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS share_pct FROM mx GROUP BY 1""", d="text_coverage share_pct")
CAPTURES = "cp AS (SELECT user_id, count(*) AS captures FROM events GROUP BY 1)"
add("snapshot_multiplicity", f"""WITH {CAPTURES} SELECT captures, count(*) AS ids,
  100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS share_pct FROM cp GROUP BY 1""", d="share_pct")
add("multiplicity_summary", f"""WITH {CAPTURES} SELECT count(*) AS ids, count(*) FILTER (captures > 1) AS repeated_ids,
  100.0::DOUBLE * count(*) FILTER (captures > 1) / count(*) AS repeated_pct, max(captures) AS max_captures FROM cp""",
    d="repeated_pct")
_CR = {
    "rows_in": "(SELECT count(*) FROM documents)", "null_text_dropped": "(SELECT count(*) FROM documents WHERE trim(text) = '')",
    "duplicates_removed": "(SELECT sum(n - 1) FROM g)", "valid_records": "(SELECT count(*) FROM g)",
    "duplicate_rate_before": "(SELECT 100.0::DOUBLE * sum(n - 1) / sum(n) FROM g)", "duplicate_rate_after": "(SELECT 100.0::DOUBLE * (count(*) - count(DISTINCT text)) / count(*) FROM g)",
    "target_language_share": "(SELECT avg(tl) FROM g)", "avg_chars": "(SELECT avg(length(text)) FROM g)",
    "avg_tokens": f"(SELECT avg(len({tokens('text')})) FROM g)",
}
add("cleaning_report", """WITH g AS (SELECT text, count(*) AS n, arg_max((lang = 'en')::INT, doc_id) AS tl FROM documents
  WHERE trim(text) <> '' GROUP BY text) """ + " UNION ALL ".join(
    f"SELECT {lit(k)} AS metric, ({v})::DOUBLE AS value" for k, v in _CR.items()), d="value")

# ---- written and read back --------------------------------------------------------------------

add("snapshot_json", f"""SELECT doc_id::VARCHAR AS id, {clean('text', 'nlp')} AS text_cleaned,
  length({clean('text', 'nlp')}) AS text_length, source AS author_userName, doc_id AS author_followers,
  n_chars AS likeCount, {day('doc_id')} AS day FROM documents""", i="text_length")
add("latest_file", "SELECT doc_id, text FROM documents")
WEEKLY = """wo AS (SELECT o_orderkey, o_custkey, o_totalprice, isoyear(o_orderdate) AS iso_year,
  weekofyear(o_orderdate) AS iso_week FROM orders)"""
add("read_silver_weeks", f"""WITH {WEEKLY} SELECT * FROM wo WHERE (iso_year = 1995 AND iso_week = 1)
  OR (iso_year = 1996 AND iso_week = 52)""", d="o_totalprice", i="iso_year iso_week")
add("write_weekly_replaces", f"""WITH {WEEKLY} SELECT iso_year, iso_week, count(*) AS n,
  sum(CASE WHEN iso_year = 1995 AND iso_week = 10 THEN 0.0 ELSE o_totalprice END) AS total FROM wo GROUP BY 1, 2""",
    d="total", i="iso_year iso_week")
_lost = {"user_id": "user_id IS NULL OR event_id % 11 = 0", "value": "value IS NULL OR event_id % 7 = 0",
         "event_type": "trim(event_type) = '' OR event_type IS NULL OR event_id % 5 = 0",
         "props": "trim(props) = '' OR props IS NULL"}
add("write_weekly_observed", " UNION ALL ".join(
    f"SELECT {m} AS measure, {f} AS field, count(*) FILTER ({c}) AS hits, "
    f"100.0::DOUBLE * count(*) FILTER ({c}) / count(*) AS rate, count(*) AS rows_written, count(*) AS rows_stored FROM events"
    for m, f, c in [*[("'null_rate'", lit(f), c) for f, c in _lost.items()],
                    ("'row_compliance'", "NULL", f"event_id IS NOT NULL AND NOT ({_lost['user_id']} OR {_lost['value']})")]), d="rate")
add("read_latest_artifact", f"""WITH {WEEKLY} SELECT * FROM wo WHERE iso_year * 100 + iso_week =
  (SELECT max(iso_year * 100 + iso_week) FROM wo)""", d="o_totalprice", i="iso_year iso_week")
add("csv_round_trip", """SELECT doc_id, text, to_json(string_split(source, 'c'))::VARCHAR AS parts FROM documents""")
add("read_silver_merged", """SELECT doc_id::VARCHAR AS id, lang, n_chars AS likeCount, NULL::BIGINT AS viewCount,
    NULL::VARCHAR AS newsLink, NULL::VARCHAR AS comments, 'tweets' AS source_type FROM documents
  UNION ALL SELECT 'b' || doc_id, NULL, doc_id, n_chars, NULL, NULL, 'tweets' FROM documents
  UNION ALL SELECT NULL, NULL, NULL, NULL, conv_id::VARCHAR, to_json(string_split(text, chr(10)))::VARCHAR, 'news'
    FROM conversations""")
add("upsert_weekly_undated", """WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS day,
    CASE WHEN o_orderkey % 5 = 0 THEN 3 WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS round FROM orders)
  SELECT o_orderkey, round, isoyear(day) AS iso_year, weekofyear(day) AS iso_week FROM d""", i="round iso_year iso_week")
add("select_by_pattern", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders", d="o_totalprice")
add("user_scorer", f"""WITH s AS (SELECT doc_id, round(len(regexp_extract_all(text, '[aeiou]'))::DOUBLE
    / greatest(length(text), 1) - 0.4, 6) + 0 AS sentiment_score FROM documents)
  SELECT doc_id, sentiment_score, {label('sentiment_score')} AS sentiment FROM s""", d="sentiment_score")
add("weekly_brands", f"""WITH wt AS (SELECT 't' AS k, {clean('text', 'nlp')} AS x, n_chars AS e, {day('doc_id')} AS dd FROM documents),
  wc AS (SELECT 'n' AS k, unnest(string_split(text, chr(10))) AS y, {day('conv_id')} AS dd FROM conversations),
  wa AS (SELECT k, x, e FROM wt WHERE isoyear(dd) = 2024 AND weekofyear(dd) = 3
    UNION ALL SELECT k, {clean('y', 'nlp')}, NULL FROM wc WHERE isoyear(dd) = 2024 AND weekofyear(dd) = 3),
  ws AS (SELECT *, {first('x', t.TEST_BRANDS)} AS brand, {per_token('x')} AS sentiment_score FROM wa),
  wl AS (SELECT *, {label('sentiment_score')} AS sentiment FROM ws),
  wb AS (SELECT brand, count(*) FILTER (k = 't') AS mentions_twitter, count(*) FILTER (k = 'n') AS mentions_news,
    count(*) AS total_mentions, coalesce(sum(e), 0)::BIGINT AS total_engagement, {PCTS}
    FROM wl WHERE brand IS NOT NULL GROUP BY brand)
  SELECT * REPLACE (round(positive_pct, 1) AS positive_pct, round(negative_pct, 1) AS negative_pct,
    round(neutral_pct, 1) AS neutral_pct, round(avg_score, 4) AS avg_score), 2024 AS iso_year, 3 AS iso_week FROM wb""",
    d=PCT_COLS, i="iso_year iso_week")

_SIZES = {"min_length": "min(n)", "q1": "quantile_cont(n, 0.25)", "median": "quantile_cont(n, 0.5)",
          "q3": "quantile_cont(n, 0.75)", "max_length": "max(n)"}
add("weekly_governance", f"""WITH wt AS (SELECT 'Twitter' AS source, {clean('text', 'nlp')} AS x, length(text) AS n, n_chars, doc_id, {day('doc_id')} AS dd FROM documents),
  wc AS (SELECT 'News' AS source, unnest(string_split(text, chr(10))) AS y, {day('conv_id')} AS dd FROM conversations),
  wa AS (SELECT source, x, n, dd, n_chars, doc_id FROM wt WHERE isoyear(dd) = 2024 AND weekofyear(dd) = 3
    UNION ALL SELECT source, {clean('y', 'nlp')}, length({clean('y', 'nlp')}), dd, NULL, NULL FROM wc WHERE isoyear(dd) = 2024 AND weekofyear(dd) = 3),
  wg AS (SELECT *, {first('x', t.TEST_BRANDS)} AS brand, {first('x', t.TEST_PRODUCTS)} AS product,
    {first('x', t.TEST_TOPICS)} AS topic FROM wa)""" + " UNION ALL ".join(
    [f" SELECT 'governance_nulls' AS frame, source, '{c}' AS label, 100 - 100 * count({c})::DOUBLE / count(*) AS value, NULL::BIGINT AS sample_size FROM wg GROUP BY source"
     for c in ("brand", "product", "topic")]
    + [" SELECT 'governance_volume', source, strftime(dd, '%Y-%m-%d'), count(*)::DOUBLE, NULL FROM wg GROUP BY source, dd"]
    + [f""" SELECT 'governance_outliers', 'Twitter', '{name}', 100 * count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))::DOUBLE
  / count({c}), count({c}) FROM wg, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM wg)"""
       for name, c in (("likeCount", "n_chars"), ("author_followers", "doc_id"))]
    + [f" SELECT 'governance_lengths', source, '{k}', ({e})::DOUBLE, count(n) FROM wg GROUP BY source" for k, e in _SIZES.items()]), d="value")

# ---- streams ------------------------------------------------------------------------------------

# days the watermark, two days behind the newest event, has closed
add("stream_volume", """SELECT ts::DATE AS period, event_type, count(*) AS n_records, sum(value) AS score_sum,
  avg(value) AS avg_score FROM events WHERE ts::DATE + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY
  GROUP BY 1, 2""", d="score_sum avg_score")
add("stream_volume_open", """SELECT ts::DATE AS period, event_type, count(*) AS n_records, sum(value) AS score_sum,
  avg(value) AS avg_score FROM events GROUP BY 1, 2""", d="score_sum avg_score")
add("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
add("stream_upsert", """SELECT user_id, isoyear(ts) AS iso_year, weekofyear(ts) AS iso_week,
  arg_max(event_id, struct_pack(ts := ts, e := event_id)) AS event_id,
  arg_max(value, struct_pack(ts := ts, e := event_id)) AS value FROM events GROUP BY 1, 2, 3""",
    d="value", i="iso_year iso_week")
add("stream_silver", f"""SELECT doc_id::VARCHAR AS id, {clean('text', 'nlp')} AS text_cleaned, n_chars AS likeCount,
  isoyear({day('doc_id')}) AS iso_year, weekofyear({day('doc_id')}) AS iso_week FROM documents""", i="iso_year iso_week")
add("stream_alerts", f"""WITH {TEXT_DAYS}, {alerts(False)} SELECT * FROM sa""", d="prev_pct curr_pct delta")
add("stream_refresh_weeks", f"""WITH {WEEKLY} SELECT iso_year, iso_week, count(*) AS n FROM wo WHERE iso_year = 1995
  GROUP BY 1, 2""", i="iso_year iso_week")

add("stream_weekly_rollup", f"WITH {EVENT_DAYS} SELECT * FROM ds", d=PCT_COLS)
add("weekly_rollup_added", """SELECT isoyear(ts) AS iso_year, weekofyear(ts) AS iso_week, event_type, count(*) AS n,
  sum(value) AS total, min(value) AS low, max(value) AS high FROM events GROUP BY 1, 2, 3""", d="total low high", i="iso_year iso_week")
add("distinct_sketch_weeks", """SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, true AS within_error
  FROM events GROUP BY event_type""")
