"""The registered queries of the operators, with DuckDB statements where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanpanel.llm import (
    bpe,
    centroids,
    chat,
    licenses,
    mixing,
    neardup,
    neighbours,
    periodic_runs,
    quality_knn,
    rules,
    secret_scan,
    toxicity,
    warc,
)
from loanpanel.llm.common import held_out, table

RANKS = "byte_bpe_multi_50k.tiktoken"
PROBE = "</s>[INST] ok [/INST]"


def hex_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    docs = table(spark, sf_dir, "documents")
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep_ids=False, digests=True)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    turns = chat.format_turns(rows.unionByName(probe))
    written = chat.assemble(turns).withColumn("turns", chat.read_back(F.col("formatted")))
    learned = F.transform(
        "loss_spans",
        lambda s: chat.unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["chars"]), chat.INSTRUCT),
    )
    written = written.withColumn("learned", F.array_join(learned, ""))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return written.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        hex_of(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        hex_of(F.col("learned")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


_CONTROLS = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[/TURN]")


def _written(column: str) -> str:
    """Code points of an escaped text."""
    counts = " + ".join(
        f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in (*_CONTROLS, "␛")
    )
    return f"(length({column}) + {counts})"


OP2_SQL = f"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}'
  UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'
), steps AS (
  SELECT *, coalesce(lag(role) OVER o, 'start') AS state,
    lead(role) OVER o IS NULL AS is_last
  FROM rows_ WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({_written('text')} + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
    ELSE 20 + {_written('role')} END) AS BIGINT) AS formatted_chars,
  bool_and(state IN ('start', 'system', 'assistant') AND role = 'user'
    OR state = 'start' AND role = 'system' OR state = 'user' AND role = 'assistant')
    AND bool_or(is_last AND role = 'assistant') AS valid
FROM steps GROUP BY conv_id
"""


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def _op3_sql() -> str:
    phrases = ", ".join(f"(['{p.replace(' ', chr(39) + ', ' + chr(39))}'], '{x}')" for p, x in licenses.PHRASES.items())
    notices = ", ".join(
        f"({i}, [{', '.join(repr(w) for w in sorted(set(t.split())))}], '{x}')" for i, (t, x) in enumerate(licenses.TEMPLATES)
    )
    vocabulary = ", ".join(sorted({repr(w) for t, _ in licenses.TEMPLATES for w in t.split()}))
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), words AS (
  SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM docs
), phrases(p, label) AS (VALUES {phrases}
), places AS (
  SELECT d.r, w.i, p.label FROM words w JOIN phrases p ON w.w = p.p[1] JOIN docs d ON d.r = w.r
  WHERE d.ws[w.i + 1 : w.i + len(p.p)] = p.p
), base AS (
  SELECT r, count(*) AS n, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY r
), notices(t, ts, label) AS (VALUES {notices}
), blocks AS (
  SELECT DISTINCT r, w, unnest([i // {licenses.STRIDE}, greatest(i // {licenses.STRIDE} - 1, 0)]) AS b
  FROM words WHERE w IN ({vocabulary})
), tokens AS (SELECT t, label, len(ts) AS n, unnest(ts) AS w FROM notices
), shared AS (
  SELECT r, b, t, label, n, count(*) AS k FROM blocks JOIN tokens USING (w) GROUP BY ALL
), matches AS (
  SELECT r, list(DISTINCT label) AS labels, max(k / n) AS best FROM shared
  WHERE k >= ceil({licenses.THRESHOLD} * n - 1e-9) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(b.n, 0) AS n_base,
  CAST(b.first_word AS BIGINT) AS first_word, CAST(b.last_word AS BIGINT) AS last_word,
  array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
  CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(m.best, 0.0::DOUBLE) END AS score
FROM docs d LEFT JOIN base b ON b.r = d.r LEFT JOIN matches m ON m.r = d.r
"""


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=2, percent=80)


OP5_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
    ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS gram FROM docs
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM grams a JOIN grams b USING (gram) GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)
), reached AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), classes AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
  d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM docs d LEFT JOIN sizes s USING (doc_id) LEFT JOIN classes c ON c.a = d.doc_id
"""


def _scored(docs: DataFrame, score: Column, threshold: float) -> DataFrame:
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op6_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_knn.fit(docs, table(spark, sf_dir, "labels"))
    return _scored(docs, quality_knn.score(F.col("text"), model, spark), 0.3)


POLICY = "v1"


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = rules.ledger(table(spark, sf_dir, "documents"))
    return entries.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~rules.passes("base")).alias("base_failed"),
        (rules.passes("base") & rules.passes(POLICY)).alias("kept"),
        "fails",
    )


def _op7_sql() -> str:
    bits = " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in rules.RULES)
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), words AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM docs
), marked AS (
  SELECT r, i, w, lag(w) OVER o = w AS same, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w, w1, w2) AS n FROM marked WHERE w2 IS NOT NULL
), inside AS (
  SELECT r, count(DISTINCT k) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM windows WHERE n >= 2) GROUP BY r
), sums AS (
  SELECT r, sum(length(w)) AS word_chars, count(*) FILTER (same) AS n_stutter,
    count(*) FILTER (regexp_matches(w, '[A-Z]') AND NOT regexp_matches(w, '[a-z]')) AS n_shouted
  FROM marked GROUP BY r
), lines AS (
  SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r, line
), line_sums AS (SELECT r, sum(n) AS n_lines, sum(n) - count(*) AS n_dup_lines FROM lines GROUP BY r
), measured AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '{rules.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(n_stutter, 0) AS n_stutter, coalesce(n_shouted, 0) AS n_shouted
  FROM docs LEFT JOIN sums USING (r) LEFT JOIN inside USING (r) LEFT JOIN line_sums USING (r)
), entries AS (SELECT *, CAST({bits} AS BIGINT) AS fails FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  fails & {rules.mask("base")} != 0 AS base_failed, fails & {rules.mask("base") | rules.mask(POLICY)} = 0 AS kept, fails
FROM entries
"""


def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lays all pages out as an archive and audits a replica of it. In the replica, the
    last byte of a 256th of the records is another one, and a 256th are lost; both by
    record hash. One row per different record, with what the audit found."""
    text = warc.record(F.col("page_id"), F.col("url"), F.col("html"))
    pages = table(spark, sf_dir, "pages").select("page_id", text.alias("record"))
    fate = F.substring(F.md5(F.col("record").cast("binary")), 1, 2)
    spoiled = F.concat(F.expr("left(record, length(record) - 1)"), F.lit("!"))
    hashed = pages.select(
        "page_id",
        hex_of(F.col("record")).alias("sha"),
        F.octet_length("record").cast("long").alias("bytes"),
        F.when(fate == "00", hex_of(spoiled)).when(fate != "01", hex_of(F.col("record"))).alias("replica"),
    )
    archive = warc.layout(hashed, extra="replica")
    replica = archive.where("replica IS NOT NULL").select("file", "offset", F.col("replica").alias("sha"))
    found = warc.audit(archive.select("file", "offset", "sha"), replica)
    return archive.join(found, ["file", "offset"], "left").select(
        "page_id",
        "copies",
        "file",
        "offset",
        "bytes",
        "sha",
        F.coalesce("status", F.lit("ok")).alias("status"),
    )


OP8_SQL = f"""
WITH records AS (
  SELECT page_id, 'WARC/1.0' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <' || name || '>' || e
    || 'WARC-Date: 1970-01-01T00:00:00Z' || e || 'WARC-Target-URI: '
    || coalesce(nullif(replace(replace(url, chr(13), '%0D'), chr(10), '%0A'), ''), name) || e
    || 'Content-Type: text/html' || e || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || e || e
    || coalesce(html, '') || e || e AS record
  FROM (SELECT *, 'urn:page:' || coalesce(CAST(page_id AS VARCHAR), '') AS name, chr(13) || chr(10) AS e FROM pages)
), once AS (
  SELECT page_id, sha256(record) AS sha, octet_length(encode(record)) AS bytes, left(md5(record), 2) AS fate,
    count(*) AS copies FROM records GROUP BY ALL
), files AS (SELECT greatest(1, ceil(count(*) / {warc.RECORDS_PER_FILE}))::BIGINT AS n FROM once
), placed AS (SELECT once.*, CAST('0x' || left(sha, 8) AS BIGINT) % n AS file FROM once, files)
SELECT page_id, copies, file,
  CAST(coalesce(sum(bytes) OVER (PARTITION BY file ORDER BY page_id NULLS FIRST, sha
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
  CAST(bytes AS BIGINT) AS bytes, sha, CASE fate WHEN '00' THEN 'changed' WHEN '01' THEN 'missing' ELSE 'ok' END AS status
FROM placed
"""


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mix = mixing.Mix()
    taken = mixing.mixed(docs, mixing.cuts(docs, mix), mix)
    return taken.select(
        "doc_id",
        *mixing.leaf_of(mix),
        mixing.n_tokens(F.col("text")).alias("n_tokens"),
        "copies",
    )


def _op9_sql() -> str:
    mix = mixing.Mix()
    ctes, up = [], None
    for depth in range(1, len(mixing.LEVELS) + 1):
        path, parents = mixing.LEVELS[:depth], mixing.LEVELS[: depth - 1]
        cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mix.weights[path[-1]].items())
        weight = f"CASE {path[-1]} {cases} ELSE {mixing.OTHER} END" if cases else str(mixing.OTHER)
        by = f"PARTITION BY {', '.join(parents)}" if parents else ""
        budget = (
            f"(SELECT least(sum(tokens) * {mix.percent} // 100, sum(tokens) * {mix.max_epochs}) FROM leaves)"
            if up is None
            else "u.budget"
        )
        source = "leaves" if up is None else f"leaves JOIN {up} u USING ({', '.join(parents)})"
        extra = "" if up is None else ", u.budget"
        ctes.append(f"""nodes{depth} AS (
  SELECT {', '.join(path)}, sum(tokens) * {mix.max_epochs} AS cap, {budget} AS budget, {weight} AS weight
  FROM {source} GROUP BY {', '.join(path)}{extra}
), ordered{depth} AS (
  SELECT *, row_number() OVER o AS k,
    budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rem,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM nodes{depth} WINDOW o AS ({by} ORDER BY CAST(cap AS DOUBLE) / weight, {path[-1]})
), level{depth} AS (
  SELECT {', '.join(path)}, CASE WHEN cap * rest <= rem * weight THEN cap
    ELSE min_by(rem, k) FILTER (cap * rest > rem * weight) OVER ({by}) * weight
      // min_by(rest, k) FILTER (cap * rest > rem * weight) OVER ({by}) END AS budget
  FROM ordered{depth}
)""")
        up = f"level{depth}"
    bulk = ", ".join(f"'{s}'" for s in mix.bulk)
    return f"""
WITH docs AS (
  SELECT doc_id, CASE WHEN coalesce(source, '') IN ({bulk}) THEN 'crawl' ELSE 'curated' END AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n FROM documents
), leaves AS (SELECT domain, lang, source, sum(n) AS tokens FROM docs GROUP BY ALL
), {', '.join(ctes)}, goals AS (
  SELECT l.*, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS epochs FROM leaves l JOIN {up} USING (domain, lang, source)
), goals2 AS (SELECT g.*, b.budget - epochs * tokens AS open FROM goals g JOIN {up} b USING (domain, lang, source)
), placed AS (
  SELECT d.*, epochs, open, md5('{mix.seed}:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM docs d JOIN goals2 USING (domain, lang, source)
), summed AS (
  SELECT *, sum(n) OVER (PARTITION BY domain, lang, source ORDER BY place) AS upto FROM placed
), cut AS (
  SELECT domain, lang, source, min(place) AS cut FROM summed WHERE open > 0 AND upto > open GROUP BY ALL
)
SELECT doc_id, domain, lang, source, n AS n_tokens, CAST(epochs + CASE WHEN place < cut THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM placed LEFT JOIN cut USING (domain, lang, source)
WHERE epochs + CASE WHEN place < cut THEN 1 ELSE 0 END > 0
"""


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _scored(docs, toxicity.score(F.col("text"), model, spark), 0.5)


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


def _op11_sql() -> str:
    rounds = 3
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT r, unnest(min_by(struct_pack(c := c, distance := distance), struct_pack(d := distance, c := c)))
  FROM (SELECT r, c, CAST(list_sum(list_transform(list_zip(x.v, y.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)
    AS distance FROM vectors x, centres{i} y) GROUP BY r
)""")
        if i < rounds:
            steps.append(f"""centres{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.v, y.v) AS v FROM centres{i} y LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n FROM (
        SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{i} JOIN vectors USING (r)) GROUP BY c, i
    ) GROUP BY c) m USING (c)
)""")
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), centres0 AS MATERIALIZED (
  SELECT row_number() OVER o - 1 AS c, v FROM vectors
  WINDOW o AS (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) QUALIFY c < 16
), {', '.join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(y.v, ',')) AS centroid_sha256
FROM near{rounds} JOIN vectors USING (r) JOIN centres{rounds} y USING (c)
"""


WORD = r"[^\x20\x09-\x0D]+"


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32(doc_id) % 10 = 0, the words from one on repeat with a
    period, both by the same checksum."""
    ws, n = F.col("ws"), F.size("ws")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    rows = docs.select("doc_id", "text", h.alias("h"), g.alias("g"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("ws", words)
    rows = rows.withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int")))
    period = 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))
    rows = rows.withColumn("p", period.cast("int"))
    word = lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get(ws, F.col("a") + F.pmod(i - F.col("a"), F.col("p"))))
    planted = F.array_join(F.transform(ws, word), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.periodic_runs(with_planted_runs(docs))


#: The checksum, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(
    string_split({0}, ''), lambda x: CAST(ascii(x) AS UBIGINT))), lambda acc, x: list_reduce(
    [xor(acc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))))"""

OP12_SQL = f"""
WITH given AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
    CASE WHEN doc_id IS NULL THEN 0 ELSE {_CRC32.format("CAST(doc_id AS VARCHAR)")} END AS h FROM documents
), placed AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN CAST((h // 10) % len(ws) AS BIGINT) END AS a FROM given
), docs AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(len(ws)), lambda i:
    ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % CAST(1 + (len(ws) - a) // (3 + (h // 10) % 8) AS BIGINT) END]) END AS ws
  FROM placed
), words AS MATERIALIZED (
  SELECT r, i, w, n, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2
  FROM (SELECT r, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM docs)
  WINDOW o AS (PARTITION BY r ORDER BY i)
), same AS (
  SELECT x.r, x.i, y.i - x.i AS p FROM words x JOIN words y USING (r, w, w1, w2) WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n
), stretches AS (
  SELECT r, p, min(i) AS start, count(*) + 2 + p AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM same) GROUP BY r, p, island
), runs AS MATERIALIZED (
  SELECT r, start, length, min(p) AS period FROM stretches WHERE length >= greatest(6, 4 * p) GROUP BY ALL
), digests AS (
  SELECT r, count(*) AS n_runs, first(struct_pack(s := start, n := length, p := period)
      ORDER BY length * 1.0::DOUBLE / period DESC, start, period) AS best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY r
), dropped AS (
  SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
  SELECT r, string_agg(w, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (r, i) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.n AS BIGINT) AS length,
  CAST(best.p AS BIGINT) AS period, CAST(1000 * best.n // best.p AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM docs LEFT JOIN digests USING (r) LEFT JOIN collapsed USING (r)
"""


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.fit(docs))
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"] != secret_scan.ADDED)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        hex_of(F.array_join(F.transform(base, line), ",")).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"),
    )


def _op13_sql() -> str:
    """Matches with their places: the pieces between matches tell them. A score is the sum of
    whole numbers, as in the operator."""
    signs = f"[{secret_scan.SIGNS[:-2].replace('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789', 'A-Za-z0-9')}_=-]+"
    patterns = {k: (p.replace("'", "''"), "(?i)" if flags & 2 else "", least) for k, p, flags, least in secret_scan.PATTERNS}

    def places(name: str, kind: str, pattern: str, groups: str, source: str = "docs", at: str = "0") -> str:
        return f"""{name} AS (
  SELECT r, '{kind}' AS kind, m AS value, g AS inner_value,
    {at} + CAST(sum(len(piece) + len(before)) OVER (PARTITION BY r, part ORDER BY k) AS BIGINT) AS start FROM (
    SELECT r, {at} AS at, part, unnest(ms) AS m, unnest(gs) AS g, unnest(list_prepend('', ms[:-2])) AS before,
      unnest(string_split_regex(text, '{pattern}')[:-2]) AS piece, generate_subscripts(ms, 1) AS k
    FROM (SELECT *, regexp_extract_all(text, '{pattern}') AS ms, {groups} AS gs FROM {source}))
)"""

    assign, fold, assign_least = patterns["assign"]
    ctes = [
        places("assigned", "assign", fold + assign, f"regexp_extract_all(text, '{fold}{assign}', 2)"),
        places("access", "access", patterns["access"][0], "ms"),
        places("hexed", "hex", patterns["hex"][0], "ms"),
        places("strings", secret_scan.ADDED, signs, "ms"),
    ]
    size = len(secret_scan.SIGNS) + 1
    each = int(1000 * secret_scan.NATS_EACH)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, 0 AS part, doc_id, coalesce(text, '') AS text FROM documents
), {', '.join(ctes)}, base AS MATERIALIZED (
  SELECT r, kind, 0 AS k, start, start + len(value) AS stop, inner_value FROM assigned WHERE len(inner_value) >= {assign_least}
  UNION ALL SELECT r, kind, 1, start, start + len(value), value FROM access WHERE len(value) >= {patterns["access"][2]}
  UNION ALL SELECT r, kind, 2, start, start + len(value), value FROM hexed WHERE len(value) >= {patterns["hex"][2]}
), free AS MATERIALIZED (
  SELECT row_number() OVER () AS s, r, start, start + len(value) AS stop, value FROM strings x
  WHERE len(value) >= {secret_scan.SAMPLE} AND NOT EXISTS (
    SELECT 1 FROM base b WHERE b.r = x.r AND b.start < x.start + len(x.value) AND b.stop > x.start)
), candidates AS MATERIALIZED (
  SELECT s, r, start, stop, value FROM free WHERE len(value) >= {secret_scan.CANDIDATE}
    AND CAST(regexp_matches(value, '[0-9]') AS INT) + CAST(regexp_matches(value, '[a-z]') AS INT)
      + CAST(regexp_matches(value, '[A-Z]') AS INT) >= 2
), samples AS (
  SELECT 0 AS label, value FROM free ANTI JOIN candidates USING (s)
  UNION ALL SELECT 1, v FROM (SELECT unnest(regexp_extract_all(inner_value, '{signs}')) AS v FROM base) WHERE len(v) >= {secret_scan.SAMPLE}
), steps AS (
  SELECT label, unnest(string_split(chr(10) || value, '')) AS a, unnest(string_split(value || chr(10), '')) AS b FROM samples
), counts AS (SELECT label, a, b, count(*) AS n FROM steps GROUP BY ALL
), totals AS (SELECT label, a, sum(n) AS total FROM counts GROUP BY ALL
), states AS (SELECT unnest(string_split('{secret_scan.SIGNS}' || chr(10), '')) AS c
), ratios AS (
  SELECT x.c AS a, y.c AS b, CAST(round_even(1000 * (
      ln((coalesce(r1.n, 0) + 1.0::DOUBLE) / (coalesce(t1.total, 0) + {size}))
      - ln((coalesce(r0.n, 0) + 1.0::DOUBLE) / (coalesce(t0.total, 0) + {size}))), 0) AS BIGINT) AS ratio
  FROM states x CROSS JOIN states y
  LEFT JOIN counts r0 ON r0.label = 0 AND r0.a = x.c AND r0.b = y.c LEFT JOIN counts r1 ON r1.label = 1 AND r1.a = x.c AND r1.b = y.c
  LEFT JOIN totals t0 ON t0.label = 0 AND t0.a = x.c LEFT JOIN totals t1 ON t1.label = 1 AND t1.a = x.c
), scored AS (
  SELECT s, sum(ratio) AS score FROM (
    SELECT s, unnest(string_split(chr(10) || value, '')) AS a, unnest(string_split(value || chr(10), '')) AS b FROM candidates
  ) JOIN ratios USING (a, b) GROUP BY s
), spans AS (
  SELECT r, kind, k, start, stop FROM base
  UNION ALL SELECT r, '{secret_scan.ADDED}', 3, start, stop FROM candidates JOIN scored USING (s)
  WHERE score >= greatest({int(1000 * secret_scan.NATS)}, {each} * len(value))
), lines AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (k < 3) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN lines USING (r)
"""


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_byte_bpe, op2_chat_format, op3_license_scan, op4_nearest_neighbours, op5_near_duplicates, op6_quality_knn, op7_quality_rules, op8_warc_fixity, op9_source_mix, op10_toxicity, op11_centroid_clusters, op12_periodic_runs, op13_secret_scan)
}
ORACLES: dict[str, str] = {
    "op2_chat_format": OP2_SQL,
    "op3_license_scan": _op3_sql(),
    "op5_near_duplicates": OP5_SQL,
    "op7_quality_rules": _op7_sql(),
    "op8_warc_fixity": OP8_SQL,
    "op9_source_mix": _op9_sql(),
    "op11_centroid_clusters": _op11_sql(),
    "op12_periodic_runs": OP12_SQL,
    "op13_secret_scan": _op13_sql(),
}
