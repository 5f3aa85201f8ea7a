"""URL filters: host and path rules, then logistic regression on hashed character
n-grams of host and path, native (Spark ML and column functions).

Defined cases: a URL that is NULL or has no ``://`` has an empty host and path and no
rule; the longest fitting rule wins, a block rule before an allow rule of the same
length; equal rows get equal results; extra columns do not matter.
"""

import re
import zlib

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gridledger.llm import common

ALLOW, BLOCK = "allow", "block"
#: (verdict, host and path).
RULES = (
    (ALLOW, "org/"),
    (BLOCK, "example.org/es/"),
    (BLOCK, "example.org/en/1"),
    (ALLOW, "com/fr/"),
    (BLOCK, "com/de/"),
)
#: Rules become one expression; more of them belong in a table joined on the host.
MAX_RULES = 1_000
FEATURES = 1 << 18
NGRAMS = (3, 4, 5)
#: Score from which a URL is blocked: the likelier side, not chosen on any table.
CUT = 0.5
#: Penalty of the weights; like SITES and NAMES by the error on left-out words.
REG = 0.004

# Parts of the labelled URLs. None is taken from a table that is judged. Words of
# unwanted sites go by the subjects of public block lists (gambling, adult, drugs and
# pills, loans, warez and hacking, malware and phishing, advertising and tracking,
# spam and fakes); words of wanted ones by the subjects of web directories. No word
# holds another, so that one left out of the training is in none of its URLs.
BLOCK_WORDS = (
    "casino poker jackpot bet slots roulette lottery gambl blackjack bingo wager baccarat "
    "xxx porn nude adult escort camgirl erotic hentai milf fetish sexy hookup stripper hardcore "
    "viagra pills steroid cialis xanax tramadol pharma cannabis opioid weightloss enlarge "
    "payday cashloan quickcredit forex getrich cheap discount "
    "torrent warez keygen crack serialz nulled hack cheats piracy "
    "malware phish trojan botnet ransom spyware exploit rootkit virus keylog "
    "popunder ads banner clicktrack doubleclick affiliate popup retarget beacon pixel "
    "spam gift replica fake scam prize bonus clickbait lucky winner"
).split()
ALLOW_WORDS = (
    "news library university school science history recipes garden travel weather museum "
    "research guide forum journal archive health sports music nature local council gazette "
    "language teaching books poetry theatre hospital church family kitchen software "
    "physics biology chemistry painting cinema photo radio railway airport hotel bakery farm "
    "market village river mountain animal football cycling sailing chess charity law "
    "parliament economy energy climate engineer design fashion jewel furniture bicycle"
).split()
#: Paths as web servers and common publishing software make them.
PLAIN_PATHS = [
    "/", "/index.html", "/about/", "/contact.php", "/2019/07/first-post/", "/category/general/page/2",
    "/node/4711", "/wiki/Main_Page", "/viewtopic.php", "/product/81",
]
#: Paths of common advertising servers.
BLOCK_PATHS = ["/adclick.php", "/www/delivery/ck.php", "/popunder.js"]
#: What stands before and after the name of a site.
LEADS = ["", "", "www.", "m.", "blog.", "shop."]
ENDS = [".com", ".net", ".org", ".info", ".io", ".de", ".fr", ".co.uk", ".github.io", ".wordpress.com"]
#: Names without meaning: joined function words of the languages Spark ships lists for.
LANGUAGES = (
    "danish dutch english finnish french german hungarian italian norwegian portuguese spanish swedish"
).split()
NAMES = 10_000
#: Sites of a word.
SITES = 210
#: Parts of the words, each of which is left out once to measure the error.
PARTS = 5


def split_url(url):
    """(host, path) columns."""
    found = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(
        F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz",
    )
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(found, host).otherwise(""), F.when(found, path).otherwise("")


def fitting_rule(host, path, rules=RULES):
    """(rule, verdict) columns of the longest rule that fits, else NULL."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    ranked = sorted(rules, key=lambda r: (-len(r[1]), r[0] == ALLOW, r[1]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in reversed(ranked):
        rule_host, slash, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def ngrams(host, path, sizes=NGRAMS):
    """Character n-grams of ^host$ and ^path$, marked by where they come from."""

    def of(column, mark, n):
        framed = F.concat(F.lit("^"), column, F.lit("$"))
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(framed) - (n - 1), F.lit(1))),
            lambda i: F.concat(F.lit(mark), F.substring(framed, i, F.lit(n))),
        )

    return F.concat(*[of(host, "h", n) for n in sizes], *[of(path, "p", n) for n in sizes])


def neutral_words():
    """Function words of two to six letters, sorted."""
    lists = map(StopWordsRemover.loadDefaultStopWords, LANGUAGES)
    return sorted({w for words in lists for w in words if re.fullmatch("[a-z]{2,6}", w)})


def part(word):
    """The part of the words it is left out with."""
    return zlib.crc32(word.encode()) % PARTS


def site_names(word, other, second):
    """Names of sites with a word, beside another without or with a meaning."""
    return [
        word, f"{word}{other}", f"{other}{word}", f"{word}-{other}", f"{other}-{word}",
        f"{word}{second}", f"{word}-{second}",
    ]


def labelled_sites(left_out=None, only=None):
    """(name, label) of the sites; without the words of one part,
    or of that part only. Neutral words are parted likewise."""

    def mine(words):
        return [w for w in words if part(w) != left_out and only in (None, part(w))]

    def pick(values, *seed):
        return values[zlib.crc32(repr(seed).encode()) % len(values)]

    neutral, out = mine(neutral_words()), {}
    for words, label in ((mine(BLOCK_WORDS), 1.0), (mine(ALLOW_WORDS), 0.0)):
        for word in words:
            for k in range(SITES):
                names = site_names(word, pick(neutral, word, k), pick(words, k, word))
                out[names[k % len(names)]] = label
    # Every other name is of reversed words, as names need not be of any language.
    for k in range(NAMES):
        parts = [pick(neutral, k, i)[:: 1 - k % 2 * 2] for i in range(1 + k % 4)]
        out.setdefault(("-" if k % 3 == 0 else "").join(parts), 0.0)
    gone = [] if left_out is None else [w for w in BLOCK_WORDS + ALLOW_WORDS if part(w) == left_out]
    return sorted((n, label) for n, label in out.items() if not any(w in n for w in gone))


def labelled_urls(spark, left_out=None, only=None):
    """The small training table: url, label (1.0: block). Sites are a word beside one
    without a meaning or another of its kind, on all sorts of pages, so that the words
    decide and not how a site or page is called otherwise."""
    rows, neutral = [], [w for w in neutral_words() if part(w) != left_out]
    for name, label in labelled_sites(left_out, only):
        draw = zlib.crc32(name.encode())
        lead, end = LEADS[draw % len(LEADS)], ENDS[(draw >> 8) % len(ENDS)]
        one, two = neutral[(draw >> 4) % len(neutral)], neutral[(draw >> 12) % len(neutral)]
        paths = PLAIN_PATHS + [f"/{one}", f"/{one}/{two}", f"/{one}/{draw % 1000}", f"/{one}-{two}.html"] * 3
        paths += BLOCK_PATHS if label else []
        rows.append((f"http://{lead}{name}{end}{paths[(draw >> 16) % len(paths)]}", label))
    return spark.createDataFrame(rows, "url string, label double")


def _hashed(df):
    host, path = split_url(F.col("url"))
    df = df.withColumns({"_host": host, "_path": path})
    df = df.withColumn("_grams", ngrams(F.col("_host"), F.col("_path")))
    return HashingTF(
        numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="_features"
    ).transform(df)


def train(spark, left_out=None):
    """The regression, fitted on the labelled URLs; without the words of one part."""
    table = _hashed(labelled_urls(spark, left_out)).select("_features", "label").coalesce(2)
    # Both kinds weigh the same together: most sites are wanted, which is no reason
    # to let an unwanted word pass.
    blocked, rows = table.agg(F.sum("label"), F.count(F.lit(1))).first()
    table = table.withColumn(
        "_weight", F.when(F.col("label") == 1, F.lit((rows - blocked) / blocked)).otherwise(1.0)
    )
    return LogisticRegression(
        featuresCol="_features", labelCol="label", weightCol="_weight", regParam=REG, maxIter=30,
        probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
    ).fit(table)


def judge(pages, model, rules=RULES, cut=CUT):
    """page_id, host, path, rule, verdict and block_score of every row."""
    pages = common.with_columns(pages, {"page_id": "bigint", "url": "string"})
    scored = model.transform(_hashed(pages.select("page_id", "url")))
    score = vector_to_array("_probability")[1]
    rule, verdict = fitting_rule(F.col("_host"), F.col("_path"), rules)
    return scored.select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), rule.alias("rule"),
        F.coalesce(verdict, F.when(score >= cut, BLOCK).otherwise(ALLOW)).alias("verdict"),
        F.round(score, 6).alias("block_score"),
    )
