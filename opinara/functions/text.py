"""Text cleaning, tokens, n-grams, language vote, quotes. Column in, Column out."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from opinara import vocab

# Character classes that mean the same to Java and RE2 regexes and cover Unicode:
# the plain \s and \w of those engines are ASCII only.
SPACE = r"\s\p{Z}\x0B\x1C-\x1F\x{85}"
WORD = r"\p{L}\p{N}_"
TOKEN = r"[A-Za-zÀ-ÿ0-9_]+"
KEYWORD = r"[a-zA-ZÀ-ÿ0-9]+"

# Fixed patterns of the cleaning profiles.
URL_LOOSE = rf"http[^{SPACE}]+|www\.[^{SPACE}]+"
URL_STRICT = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
MENTION = rf"@[{WORD}]+"
TAG = r"<[^\n]*?>"
KEYWORD_NOISE = r"http[^ \t\n\x0B\f\r]+|www[^ \t\n\x0B\f\r]+|<[^>]+>|[@#][A-Za-z0-9_]+"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``.

    Catalyst does not share common sub-expressions with the arguments of
    higher-order functions, so a token array read twice would be built twice.
    """
    return F.transform(F.array(value), use)[0]


def _replace_if(col: Column, markers: Iterable[str], pattern: str, replacement: str) -> Column:
    """Replace a pattern in the texts that hold one of the literals every match starts
    with. Looking for a literal is far cheaper than running the regex over each text."""
    def step(value: Column) -> Column:
        found = F.lit(False)
        for marker in markers:
            found = found | value.contains(marker)
        return F.when(found, F.regexp_replace(value, pattern, replacement)).otherwise(value)
    return bind(col, step)


def _collapse(col: Column) -> Column:
    """Every run of white space to one blank. One character class is the fastest form:
    with alternatives the regex engine cannot skip ahead."""
    return F.trim(F.regexp_replace(col, f"[{SPACE}]+", " "))


def clean_text(col: Column | str, profile: str = "nlp",
               stop_words: Iterable[str] = vocab.ENGLISH_STOP_WORDS) -> Column:
    """Clean a text. Null becomes the empty string.

    ``nlp``  removes URLs, tags and mentions;
    ``eda``  blanks URLs, mentions and the hash sign;
    ``full`` lower-cases, removes URLs, mentions and punctuation except the
             apostrophe, keeps hashtag words, drops stop words.
    """
    text = F.coalesce(_col(col), F.lit(""))
    if profile == "nlp":
        text = _replace_if(text, ["http", "www."], URL_LOOSE, "")
        text = _replace_if(text, ["<"], TAG, "")
        return _collapse(_replace_if(text, ["@"], MENTION, ""))
    if profile == "eda":
        text = _replace_if(text, ["http", "www."], URL_STRICT, " ")
        text = _replace_if(text, ["@"], MENTION, " ")
        return _collapse(F.replace(text, F.lit("#"), F.lit(" ")))
    if profile == "full":
        text = _replace_if(F.lower(text), ["http", "www."], URL_STRICT, " ")
        text = _replace_if(text, ["@"], MENTION, " ")
        plain = _collapse(F.regexp_replace(text, rf"[^{WORD}{SPACE}']", " "))
        return F.array_join(remove_stop_words(F.split(plain, " "), stop_words, lowered=True), " ")
    raise ValueError(f"unknown profile {profile!r}")


def word_tokens(col: Column | str) -> Column:
    """Lower-cased runs of letters, digits and underscore."""
    return F.regexp_extract_all(F.lower(_col(col)), F.lit(TOKEN), F.lit(0))


def keyword_tokens(col: Column | str) -> Column:
    """Tokens for keyword statistics: URLs, tags, mentions and hashtags removed, then the
    runs of letters and digits that are left. No token is empty."""
    plain = _replace_if(F.lower(_col(col)), ["http", "www", "<", "@", "#"], KEYWORD_NOISE, " ")
    return F.regexp_extract_all(plain, F.lit(KEYWORD), F.lit(0))


def remove_stop_words(tokens: Column, stop_words: Iterable[str] = vocab.STOP_WORDS,
                      lowered: bool = False) -> Column:
    """Keep the tokens that are not stop words, duplicates and order intact."""
    words = sorted(stop_words)
    return F.filter(tokens, lambda t: ~(t if lowered else F.lower(t)).isin(words))


def ngrams(tokens: Column, n: int = 2) -> Column:
    """Runs of ``n`` neighbouring tokens joined by a blank."""
    def runs(ts: Column) -> Column:
        count = F.greatest(F.size(ts) - (n - 1), F.lit(0))
        joined = F.slice(ts, F.lit(1), count)
        for step in range(1, n):
            joined = F.zip_with(joined, F.slice(ts, F.lit(step + 1), count),
                                lambda a, b: F.concat(a, F.lit(" "), b))
        return joined
    return bind(tokens, runs)


def text_length(col: Column | str) -> Column:
    """Number of characters; null counts as empty."""
    return F.length(F.coalesce(_col(col), F.lit(""))).cast("bigint")


def has_text(col: Column | str) -> Column:
    return text_length(col) > 0


def first_text(*cols: Column | str) -> Column:
    """First value that is neither null nor blank."""
    return F.coalesce(*[F.when(F.trim(_col(c)) != "", _col(c)) for c in cols])


def to_text(col: Column | str, is_array: bool = False) -> Column:
    """Any value as text: a list is joined by blanks (nulls skipped), null is empty."""
    value = _col(col)
    if is_array:
        return F.coalesce(F.array_join(value.cast("array<string>"), " "), F.lit(""))
    return F.coalesce(value.cast("string"), F.lit(""))


def count_of(col: Column, needle: str) -> Column:
    """Non-overlapping occurrences of a literal string. Sizes in bytes are known, sizes
    in characters would have to be counted."""
    gone = F.replace(col, F.lit(needle), F.lit(""))
    size = len(needle.encode())
    return ((F.octet_length(col) - F.octet_length(gone)) / size).cast("bigint")


def detect_language(col: Column | str) -> Column:
    """English or Spanish by a vote of function words; accents break a silent vote."""
    text = F.coalesce(_col(col), F.lit(""))
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))

    def vote(s: Column) -> Column:
        def total(lang: str) -> Column:
            counts = [count_of(s, f" {w} ") for w in vocab.LANGUAGE_WORDS[lang]]
            return sum(counts[1:], counts[0])

        def decide(votes: Column) -> Column:
            en, es = votes[0], votes[1]
            return (
                F.when((en == 0) & (es == 0),
                       F.when(s.rlike(f"[{vocab.SPANISH_ACCENTS}]"), "es").otherwise("unknown"))
                .when(en >= es, "en")
                .otherwise("es")
            )
        return bind(F.array(total("en"), total("es")), decide)

    return F.when(text == "", "unknown").otherwise(bind(padded, vote))


def capitalize(col: Column | str) -> Column:
    """First letter upper, the rest lower."""
    value = _col(col)
    return F.concat(F.upper(F.substring(value, 1, 1)),
                    F.lower(F.substring(value, 2, 2147483647)))


def quote(col: Column | str, n: int = 260) -> Column:
    """A quotable text: junk values become null, long ones are cut and marked."""
    value = _col(col)
    junk = F.lower(F.trim(value)).isin("", "none", "nan")
    return F.when(value.isNull() | junk, F.lit(None).cast("string")).when(
        F.length(value) > n, F.concat(F.lit('"'), F.left(value, F.lit(n)), F.lit('..."'))
    ).otherwise(F.concat(F.lit('"'), value, F.lit('"')))


def fill(template: str, **values: Column) -> Column:
    """A sentence template with its ``{name}`` places filled by columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if p])
