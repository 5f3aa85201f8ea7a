"""Registered queries of the corpus operators, and their SQL where it can be said."""

from pyspark.sql import functions as F

from gridledger.llm import (
    common,
    decontamination,
    html_text,
    imatch,
    language,
    line_runs,
    mixing,
    near_join,
    periodic,
    prefix_trie,
    sharding,
    token_rollup,
    urls,
    warc,
)
from gridledger.session import scratch_dir
from gridledger.sources.tables import materialize

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_sharding(spark, sf_dir):
    placed = sharding.place(common.read(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op2_source_mix(spark, sf_dir):
    mixed = mixing.mix(common.read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_html_text(spark, sf_dir):
    return html_text.extract(common.read(spark, sf_dir, "pages"), html_text.train(spark))


@query
def op4_near_duplicates(spark, sf_dir):
    return near_join.classes(common.read(spark, sf_dir, "documents"))


@query
def op5_decontamination(spark, sf_dir):
    return decontamination.report(
        common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark")
    )


@query
def op6_imatch(spark, sf_dir):
    return imatch.compare_edited(common.read(spark, sf_dir, "documents"))


@query
def op7_language(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


@query
def op8_url_filter(spark, sf_dir):
    return urls.judge(common.read(spark, sf_dir, "pages"), urls.train(spark))


def first_snapshot(counted, version):
    """The documents as they might have come in: about a quarter each with their
    language as source, without a language, and with an estimate only; the rest as
    they stay. All come once more under an id that is withdrawn later."""
    kind = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(4))
    came = counted.select(
        "doc_id", F.when(kind == 0, F.col("lang")).otherwise(F.col("source")).alias("source"),
        F.when(kind != 1, F.col("lang")).alias("lang"),
        F.when(kind < 3, F.col("estimate")).otherwise(F.col(version)).alias("tokens"),
    )
    return came.unionByName(came.withColumn("doc_id", -1 - F.col("doc_id")))


@query
def op9_token_rollup(spark, sf_dir):
    """Documents come in, most with estimates; later they are counted, some are moved
    to another source or language and some withdrawn. Both batches are committed twice,
    as after a failure, and folded into a base in between."""
    counted = materialize(
        token_rollup.counts(common.read(spark, sf_dir, "documents")), "token-counts"
    )
    root = scratch_dir(spark, "token-rollup")
    batches = {"load": None, "count": None}
    for version in (token_rollup.WORDS, token_rollup.BYTE_BPE):
        before = first_snapshot(counted, version)
        after = counted.select("doc_id", "source", "lang", F.col(version).alias("tokens"))
        loaded = token_rollup.changes(before.filter("false"), before, version)
        moved = token_rollup.changes(before, after, version)
        for batch, rows in (("load", loaded), ("count", moved)):
            batches[batch] = rows if batches[batch] is None else batches[batch].unionByName(rows)
    for again in (False, True):
        for batch in ("load", "count"):
            token_rollup.commit(root, batch, batches[batch])
        if not again:
            token_rollup.fold(spark, root)
    return token_rollup.totals(spark, root)


@query
def op10_warc(spark, sf_dir):
    records = warc.round_trip(common.read(spark, sf_dir, "pages"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def with_planted_runs(docs):
    """Texts of which one in ten, by the CRC-32 of the id, repeats a period of its own
    words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words, n, a, p = F.col("_words"), F.col("_n"), F.col("_a"), F.col("_p")
    block = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(block, F.lit(1), n - a)), " ")
    pattern = F.lit(f"({mixing.WORD})")
    return (
        docs.withColumn("_words", F.when(h % 10 == 0, F.regexp_extract_all("text", pattern, F.lit(1))))
        .withColumns({"_n": F.size("_words"), "_g": F.floor(h / 10)})
        .withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
        .withColumn("_p", (1 + F.floor((n - a) / (3 + F.col("_g") % 8))).cast("int"))
        .withColumn("text", F.when(n > 0, changed).otherwise(F.col("text")))
        .drop("_words", "_n", "_g", "_a", "_p")
    )


@query
def op11_periodic_runs(spark, sf_dir):
    docs = with_planted_runs(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.detect(docs).withColumn("best", periodic.strongest(F.col("runs")))
    best = F.col("best")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.call_function("div", 1000 * best["length"], best["period"]).alias("exponent_milli"),
        F.sha2(periodic.listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_line_dedup(spark, sf_dir):
    marked = line_runs.marked(common.read(spark, sf_dir, "documents"))
    return marked.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


#: The rebuilt conversations take up to so many turns of another one, of a hundred ids.
MOST_GIVEN, GIVEN_EVERY = 5, 100


def rebuilt(turns):
    """Hashed turns with the first h of each conversation replaced by those of the
    conversation that its hundred of ids starts with; h is taken from the id."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_GIVEN + 1)
    head = F.col("conv_id") - F.col("conv_id") % GIVEN_EVERY
    rows = prefix_trie.numbered(turns)
    said = ["t1", "t2", "n_chars"]
    own = rows.filter(F.col("number") > h).select("conv_id", F.col("number").alias("turn"), *said)
    heads = rows.filter((F.col("conv_id") == head) & (F.col("number") <= MOST_GIVEN))
    heads = heads.select(F.col("conv_id").alias("_head"), "number", *said)
    # At most MOST_GIVEN turns a head, and a hundred ids on either side of zero.
    ids = rows.select("conv_id").distinct().withColumn("_head", head)
    given = ids.join(heads, "_head").filter(F.col("number") <= h).select(
        "conv_id", (F.col("number") - 1 - MOST_GIVEN).alias("turn"), *said
    )
    return own.unionByName(given)


@query
def op13_prefix_trie(spark, sf_dir):
    turns = common.read(spark, sf_dir, "conversations")
    return prefix_trie.nodes(rebuilt(prefix_trie.digested(turns)), turns.select("conv_id"))


# --- SQL --------------------------------------------------------------------

_MIX = """
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || doc_id) AS shuffle,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS n, 2 * source_size AS most FROM totals
), weighed AS (
  SELECT *, CASE (n - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM numbered
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(most) OVER (ORDER BY most / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY most / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), filled AS (
  SELECT *, least(most::DOUBLE, coalesce(
      (SELECT max(level) FROM levels x WHERE x.most > x.level * x.w) * w, most::DOUBLE)) AS target
  FROM levels
), queued AS (
  SELECT s.doc_id, s.size, f.n, f.w, f.source_size, f.target,
    sum(s.size) OVER (PARTITION BY f.n ORDER BY s.shuffle, s.doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS done
  FROM sized s JOIN filled f ON s.source IS NOT DISTINCT FROM f.source
), readings AS (
  SELECT doc_id, size, sum(size) OVER (
      ORDER BY (done + pass * source_size) / w, n, pass
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
  FROM queued, (VALUES (0), (1)) passes(pass) WHERE size > 0
), taken AS (
  SELECT doc_id, count(*) AS times FROM readings
  WHERE total <= 1.5::DOUBLE * (SELECT sum(size) FROM sized) GROUP BY doc_id
)
SELECT q.doc_id, q.size, q.source_size, q.target,
  (coalesce(t.times, 0) * q.size)::BIGINT AS taken
FROM queued q LEFT JOIN taken t ON q.doc_id = t.doc_id
"""

_WORDS = (
    "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

_CONTAMINATION = f"""
WITH item AS (
  SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL
), gram AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT len(g) AS l FROM gram), doc AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE {_WORDS.format('text')} END AS w FROM documents
), spot AS (
  SELECT doc_id, i, l, list_slice(w, i, i + l - 1) AS g
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM doc, lengths WHERE len(w) >= l)
), hit AS (
  SELECT DISTINCT s.doc_id, s.i, s.l, m.item_id FROM spot s JOIN gram m ON s.g = m.g
), word AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + l)) AS k FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN word ON d.doc_id = word.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

_WARC = """
WITH page AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), first AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS low FROM page
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND low <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND low <> page_id THEN low END AS refers_to
FROM first
"""

_LINES = """
WITH line AS (
  SELECT doc_id, unnest(range(1, len(l) + 1)) AS n, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.doc_id, k.n, k.line, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone
  FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_CRC32 = (
    "(xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, "
    "list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), "
    "lambda acc, c: list_reduce(list_prepend(xor(acc, c), range(8)), "
    "lambda v, bit: xor(v >> 1, 3988292384 * (v & 1))))))"
)

_TRIE = f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT conv_id, conv_id - conv_id % 100 AS head, {_CRC32.format('conv_id')} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own)
), said AS (
  SELECT c.conv_id, 0 AS part, o.n, o.role, o.text
  FROM conv c JOIN own o ON o.conv_id = c.head AND o.n <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.n, o.role, o.text FROM conv c JOIN own o ON o.conv_id = c.conv_id AND o.n > c.h
), seq AS (
  SELECT c.conv_id, coalesce(s.turns, []) AS turns FROM conv c LEFT JOIN (
    SELECT conv_id, list(to_json([role, text])::VARCHAR ORDER BY part, n) AS turns FROM said GROUP BY conv_id
  ) s ON s.conv_id = c.conv_id
), member AS (
  SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM seq
), node AS (
  SELECT turns[:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = len(turns)) AS ends
  FROM member GROUP BY ALL
), child AS (
  SELECT path[:depth - 1] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL
), own_sums AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children,
    CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * length(json_extract_string(n.path[-1], '$[1]')) END AS saved
  FROM node n LEFT JOIN child c ON n.path = c.path
), above AS (
  SELECT path[:d] AS path, saved, n_children FROM (
    SELECT path, saved, n_children, unnest(range(depth + 1)) AS d FROM own_sums)
), sums AS (
  SELECT path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM above GROUP BY path
)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves,
  s.saved_tokens, sha256(coalesce(o.ends, '')) AS ends_sha256
FROM own_sums o JOIN sums s ON o.path = s.path
LEFT JOIN node p ON o.depth > 0 AND p.path = o.path[:o.depth - 1]
"""

#: The others are tested against brute force: SQL has no CRC-32, xxHash, zstandard,
#: trees, regression or tokenizer, and no union of overlapping pairs that ends.
SQL = {
    "op2_source_mix": _MIX,
    "op5_decontamination": _CONTAMINATION,
    "op10_warc": _WARC,
    "op12_line_dedup": _LINES,
    "op13_prefix_trie": _TRIE,
}
