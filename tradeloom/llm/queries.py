"""The registered queries of this subpackage, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeloom.llm import (chat_format, decontamination, hard_negatives, language_id, main_text, near_dup, personal_data, quality_model,
                           quality_rules, spelling_variants, substring_dedup, tree_bpe, web_archive)
from tradeloom.llm.shared import lean, table
from tradeloom.session import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    """The vocabulary file, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def register(sql: str | None = None):
    """Register a function under its own name, with the SQL that gives the same rows."""
    def add(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(lean(spark), sf_dir)

        QUERIES[query.__name__] = run
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query
    return add


@register(r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x09-\x0D ]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x09-\x0D ]')) AS lines
  FROM documents),
tokens AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM split),
grams AS (
  SELECT doc_id, pos, concat_ws(' ', word, lead(word) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o) AS head,
         lead(word, 4) OVER o AS tail
  FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
windows AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, head, tail) AS times FROM grams WHERE tail IS NOT NULL),
repeated AS (
  SELECT doc_id, count(DISTINCT pos + k) AS n_repeat_words
  FROM windows, (SELECT unnest(range(0, 5)) AS k) WHERE times > 1 GROUP BY doc_id),
counted AS (
  SELECT doc_id, text, words, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN repeated USING (doc_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_symbols / greatest(n_words, 1) > 0.25
         OR len(regexp_extract_all(text, '!')) / greatest(n_words, 1) > 0.3
         OR 2 * len(regexp_extract_all(text, '\p{Lu}{2}')) / greatest(word_chars, 1) > 0.5
         OR (n_words >= 50 AND len(list_distinct(words)) / greatest(least(n_words, 1000), 1) < 0.1)
         OR len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) / greatest(n_words, 1) > 0.3
         OR n_dup_lines / len(string_split(text, chr(10))) > 0.5
         OR word_chars / greatest(n_words, 1) > 20 AS rule_failed
  FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rule_failed AS kept
FROM judged""")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the cascade's verdict for every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@register(r"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS payload, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
digits AS (
  SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, hex,
         list_transform(range(0, 8), lambda g: ('0x' || hex[5 * g + 1:5 * g + 5])::INTEGER) AS fives
  FROM hashed),
coded AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(fives, lambda v:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(v >> 15) + 1] || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((v >> 10) & 31) + 1]
         || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((v >> 5) & 31) + 1] || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(v & 31) + 1]), '') AS payload_digest
  FROM digits)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM coded WINDOW same AS (PARTITION BY payload_digest)""")
def op2_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record into seekable bundles, then read back from them."""
    archives = written(web_archive.bundles(table(spark, sf_dir, "pages"), min_bytes=0), "bundles")
    return web_archive.read_records(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register()
def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@register()
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return personal_data.digest(table(spark, sf_dir, "documents"))


@register()
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they leak."""
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), stored=True)


@register()
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed lines, sentences and runs of their pieces with the occurrence that stays."""
    return substring_dedup.removals(table(spark, sf_dir, "documents"), stored=True)


@register()
def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register()
def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), stored=True)


@register()
def op9_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    return tree_bpe.digest(table(spark, sf_dir, "documents"), tokenizer_path())


# A conversation whose texts look like the template itself.
HARD_CASE = r"\### Assistant: </turn> ok"


@register(r"""
WITH source AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
safe AS (
  SELECT *, regexp_replace(regexp_replace(text, '#(\\*)## ', '#\\\1## ', 'g'), '<(\\*)/turn>', '<\\\1/turn>', 'g') AS safe_text,
         regexp_replace(regexp_replace(regexp_replace(role, '#(\\*)## ', '#\\\1## ', 'g'), '<(\\*)/turn>', '<\\\1/turn>', 'g'),
                        ':(\\*) ', ':\\\1 ', 'g') AS safe_role
  FROM source),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length(safe_role) + length(safe_text) + length('### : </turn>') + 1)::BIGINT AS formatted_chars
  FROM safe GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM whole""")
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the hard case formatted, read back from the formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD_CASE).alias("text"))
    back = chat_format.read_back(chat_format.format_chats(rows.unionByName(hard)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@register("""
WITH clean AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, c.id, a.label = c.label AS same, list_inner_product(a.vector, c.vector)::BIGINT AS score
  FROM clean a JOIN clean c ON a.id <> c.id WHERE a.id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive."""
    rows = hard_negatives.usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    rows = rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


@register(r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8], lambda a, step: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS steps
  FROM (SELECT unnest(range(0, 256)) AS i)),
runs AS (
  SELECT concat(doc_id, ':') AS before, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents),
distinct_runs AS (SELECT before, run, count(*) AS times FROM runs GROUP BY ALL),
checked AS (
  SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(before || run, ''),
           lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [195::BIGINT, unicode(ch)::BIGINT - 64] END))),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS h
  FROM distinct_runs, crc),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         sum(times)::BIGINT AS n
  FROM checked GROUP BY 1 HAVING length(word) >= 6 AND sum(times) >= 5),
places AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM words),
cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM places),
near AS (
  SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS near_n FROM near GROUP BY word),
judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root FROM judged
  UNION ALL SELECT chain.word, judged.form FROM chain JOIN judged ON chain.root = judged.word WHERE judged.form IS NOT NULL),
ends AS (SELECT chain.word, chain.root FROM chain JOIN judged ON chain.root = judged.word WHERE judged.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN ends USING (word)""")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents with the near word that is their form, and the end of the chain of forms."""
    return spelling_variants.grouped(table(spark, sf_dir, "documents"))


@register()
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language_id.identify(table(spark, sf_dir, "documents"))
