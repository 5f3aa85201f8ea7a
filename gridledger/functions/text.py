"""Text expressions: slugs, link ids, printing of points, question words."""

from pyspark.sql import functions as F

from gridledger import fixed_values as fv

# (?d): only a newline ends what '.' can match.
_UNIX_LINES = "(?d)"


def slugify(column):
    """Lower case, every run of other characters one hyphen, none at the ends."""
    return F.regexp_replace(
        F.regexp_replace(F.lower(column), "[^a-z0-9]+", "-"), "^-+|-+$", ""
    )


def id_from_href(column):
    """Last path segment of a link, without ``.htm``."""
    return F.replace(F.substring_index(column, "/", -1), F.lit(".htm"), F.lit(""))


def strip(column):
    return F.regexp_replace(column, r"^\s+|\s+$", "")


def squeeze(column):
    return strip(F.regexp_replace(column, r"\s+", " "))


def words(column):
    """Whitespace-separated words; an empty text has none."""
    return F.filter(F.split(column, r"\s+"), lambda w: w != "")


def points_text(points):
    """Points the way they are quoted in sentences: 374.8, 337.0, 20.25."""
    exact = points.cast("decimal(20,2)").cast("string")
    return F.regexp_replace(exact, "0$", "")


def one_decimal(points):
    """Points in hundredths printed with one decimal, halves away from zero."""
    return F.round(points.cast("decimal(20,2)"), 1).cast("string")


def contains_any(column, needles):
    found = F.lit(False)
    for needle in needles:
        found = found | F.contains(column, F.lit(needle))
    return found


def first_match(column, words_by_value, default):
    """The first value whose words occur in the text, in the order given."""
    chain = None
    for value, needles in words_by_value.items():
        needles = [needles] if isinstance(needles, str) else needles
        hit = contains_any(column, needles)
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain.otherwise(F.lit(default).cast("string"))


def detect_position(text, with_te=False):
    """QB, RB, WR (and TE for the older parser), by substring, first wins."""
    kept = {p: w for p, w in fv.POSITION_WORDS.items() if with_te or p != "TE"}
    return first_match(F.lower(text), kept, None)


def detect_metric(text):
    lowered = F.lower(text)
    chain = None
    for word, column in fv.METRIC_WORDS.items():
        hit = F.contains(lowered, F.lit(word))
        chain = F.when(hit, column) if chain is None else chain.when(hit, column)
    return chain.otherwise(fv.METRIC_DEFAULT)


def detect_season(text, current=2025, year_pattern=fv.YEAR_PATTERN):
    """An explicit year, else "last year" / "two years ago", else the current one."""
    year = F.regexp_extract(text, f"({year_pattern})", 1)
    lowered = F.lower(text)
    return (
        F.when(year != "", year.try_cast("int"))
        .when(F.contains(lowered, F.lit("last year")), current - 1)
        .when(F.contains(lowered, F.lit("two years ago")), current - 2)
        .otherwise(current)
        .cast("int")
    )


def answer_intent(text):
    return first_match(F.lower(text), fv.ANSWER_INTENT_WORDS, fv.ANSWER_INTENT_DEFAULT)


def classify_intent(text):
    """ranking, compare, search or unknown, by ordered pattern groups."""
    lowered = strip(F.lower(text))
    chain = None
    for intent, patterns in fv.INTENT_PATTERNS.items():
        hit = F.rlike(lowered, F.lit(_UNIX_LINES + "|".join(f"(?:{p})" for p in patterns)))
        chain = F.when(hit, intent) if chain is None else chain.when(hit, intent)
    return chain.otherwise("unknown")


def trade_side(text, side):
    """Group 1 (given) or 2 (received) of a trade request, '' if it is none."""
    return strip(F.regexp_extract(F.lower(text), _UNIX_LINES + fv.TRADE_PATTERN, side))


def is_trade(text):
    return F.rlike(F.lower(text), F.lit(_UNIX_LINES + fv.TRADE_PATTERN))


def stop_word_patterns():
    """Stop words as few patterns: plain words together, others on their own.

    Words removed earlier can change what touches a later question mark, so
    the listed order is kept between the groups.
    """
    groups = [[]]
    for word in fv.STOP_WORDS:
        if word.isalnum():
            groups[-1].append(word)
        else:
            groups += [[word], []]
    return [r"\b(?:" + "|".join(g) + r")\b" for g in groups if g]


def name_chunks(text):
    """Candidate names: split at the first delimiter kind present, drop stop words.

    A question mark is only dropped where word characters touch it on both
    sides, so a trailing one stays.
    """
    lowered = strip(F.lower(text))
    parts = None
    for delimiter in fv.NAME_DELIMITERS:
        cut = F.split(lowered, delimiter)
        hit = F.contains(lowered, F.lit(delimiter))
        parts = F.when(hit, cut) if parts is None else parts.when(hit, cut)
    parts = parts.otherwise(F.array(lowered))

    def without_stop_words(part):
        for pattern in stop_word_patterns():
            part = F.regexp_replace(part, "(?U)" + pattern, " ")
        return squeeze(part)

    cleaned = F.transform(parts, without_stop_words)
    return F.filter(cleaned, lambda chunk: F.length(chunk) > 1)
