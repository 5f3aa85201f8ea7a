"""Documents with every odd case, and plain Python versions of shared rules."""

import random
import re

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
_UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    """Runs of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_UPPER))


def sentence(rng, count, letters="etaoinshrdlu"):
    return " ".join(
        "".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(count)
    )


def odd_documents(seed=3):
    """(doc_id, text, lang, source, n_chars): NULLs in every column, empty and long
    texts, copies, near copies, repeated rows and repeated ids."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(1, 120)) for _ in range(40)]
    rows = []
    for i, text in enumerate(base):
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
    long_text = sentence(rng, 20_000)
    near = base[5].split() + sentence(rng, 60).split()
    rows += [
        (40, base[1], "en", "s1", None),
        (41, base[1], "fr", "s2", 3),
        (42, " ".join(near), "en", "s0", 1),
        (43, " ".join(near + ["more"]), "en", "s0", 1),
        (44, " ".join(["Less", *near]).upper(), "en", None, 1),
        (45, "", "en", "s3", 0),
        (46, "", "en", "s3", 0),
        (47, None, "en", "s3", None),
        (48, None, None, None, None),
        (49, " \n\t .,;", "de", "s3", 8),
        (50, long_text, "en", "s2", len(long_text)),
        (51, long_text + " end", "en", "s2", 1),
        (52, "Éa éa ñandú", "es", "s\U0001f600", 11),
        (53, "word", "en", "s1", 4),
        (54, "Word.", "en", "s1", 5),
        (55, "repeated row of several words here", "en", "s1", 9),
        (55, "repeated row of several words here", "en", "s1", 9),
        (55, "another text under the same id", "en", "s1", 9),
        (None, "no id at all but some words", "en", "s2", 9),
        (None, "no id at all but some words", "en", "s2", 9),
        (None, None, None, None, None),
        (2**62, "a large id " * 30, "en", "s0", 9),
        (-7, "x" * 5000, "en", "s0", 5000),
    ]
    return rows


#: Extra columns whose names the operators use themselves.
CLASHING = (
    "row_key", "_row_key", "text_key", "size", "shard", "slot", "times", "_times", "_range", "_place",
    "root", "node", "_unit", "w", "n", "at", "score", "draw", "word", "url_key", "digest", "place",
)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)])
