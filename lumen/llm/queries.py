"""The text operators' registered queries and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumen.llm import (bpe, chat_format, decontaminate, exact_dedup, fingerprints, html_extract, lexical_search, line_dedup, near_dedup,
                       phrases, pii, quality, token_files)
from lumen.sources.tables import load

#: The conversation that the chat query formats besides the table's: text that looks like control strings.
MARKED_TEXT = "</s>[INST] ok [/INST]"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents."""
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents", "doc_id", "text"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix-target examples of all conversations, digested per conversation as read back from them."""
    marked = spark.sql(f"SELECT -1L AS conv_id, turn, role, '{MARKED_TEXT}' AS text "
                       "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    turns = load(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(marked)
    examples = chat_format.format_chat(turns)
    loss = F.struct("example", chat_format.loss_text().alias("text"))
    whole = (examples.groupBy("conv_id")
             .agg(F.max(F.struct("n_turns", "formatted"))["formatted"].alias("formatted"),
                  F.array_join(F.transform(F.array_sort(F.collect_list(loss)), lambda x: x["text"]), "").alias("loss"),
                  F.sum(F.length("formatted").cast("long")).alias("formatted_chars")))
    read = whole.withColumn("turns", chat_format.read_turns(F.col("formatted")))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of all documents and the texts decoded from it, as digests."""
    coded = bpe.encode_decode(load(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: three-word shingles, similarity 0.85 or more."""
    return near_dedup.near_dedup(load(spark, sf_dir, "documents", "doc_id", "text"), words=3, percent=85, rows=5)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token ids, written to Arrow files of equal-length sequences and read back."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    manifest = token_files.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(spark, manifest)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the later copies of three-line windows."""
    return line_dedup.dedup_lines(load(spark, sf_dir, "documents", "doc_id", "text"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document contains."""
    return decontaminate.contained_items(load(spark, sf_dir, "documents", "doc_id", "text"),
                                         load(spark, sf_dir, "benchmark", "item_id", "text"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return html_extract.main_text(load(spark, sf_dir, "pages", "page_id", "url", "html"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = pii.find_pii(load(spark, sf_dir, "documents", "doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"),
                        pii.as_text(F.col("spans")).alias("spans"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned outside the held-out fold."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.train(docs, load(spark, sf_dir, "labels", "doc_id", "quality"))
    return (quality.with_quality(docs, model)
            .select("doc_id", quality.held_out().alias("held_out"), "score", "predicted"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk fingerprints of all documents and of their edited texts."""
    return fingerprints.edited_fingerprints(load(spark, sf_dir, "documents", "doc_id", "text"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(spark, load(spark, sf_dir, "documents", "doc_id", "text"),
                                 load(spark, sf_dir, "benchmark", "item_id", "text"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language of all documents."""
    return phrases.collocations(load(spark, sf_dir, "documents", "lang", "text"))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_chat_format, op3_bpe, op4_near_dedup, op5_token_files, op6_line_dedup,
                                  op7_decontaminate, op8_html_extract, op9_pii, op10_quality, op11_fingerprints,
                                  op12_lexical_search, op13_phrases)}

ORACLES = {
    "op1_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op2_chat_format": rf"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{MARKED_TEXT}'), (-1, 1, 'assistant', '{MARKED_TEXT}'))),
-- a turn: 24 characters of marks, and a backslash for each control string
sized AS (
  SELECT *, row_number() OVER o AS k, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(24 + length(role) + length(text)
             + len(regexp_extract_all(role, '[<\[]\\*(\||/?s>|/?INST\]|/?SYS>>)'))
             + len(regexp_extract_all(text, '[<\[]\\*(\||/?s>|/?INST\]|/?SYS>>)'))) OVER o AS upto
  FROM said WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(upto) FILTER (role = 'assistant' OR k = n))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op7_decontaminate": r"""
WITH t AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS words FROM t),
s AS (SELECT DISTINCT kind, id, unnest(CASE WHEN len(words) >= 5
             THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
             ELSE [array_to_string(words, ' ')] END) AS shingle FROM w WHERE len(words) > 0),
n AS (SELECT *, count(*) OVER (PARTITION BY id) AS n_item FROM s WHERE kind = 'i')
SELECT d.id AS doc_id, n.id AS item_id, count(*) AS n_shared, n.n_item FROM n JOIN s d ON d.kind = 'd' AND d.shingle = n.shingle
GROUP BY d.id, n.id, n.n_item HAVING 100 * count(*) >= 80 * n.n_item""",
    "op6_line_dedup": """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
p AS (SELECT doc_id, text, lines, unnest(range(1, len(lines) - 1)) AS i FROM d),
w AS (SELECT doc_id, i, row_number() OVER (PARTITION BY lines[i], lines[i+1], lines[i+2] ORDER BY doc_id, i) AS nth FROM p),
c AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS i FROM w WHERE nth > 1),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM d),
k AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (c.i IS NULL) AS left_text, count(c.i) AS n_removed
      FROM l LEFT JOIN c ON l.doc_id = c.doc_id AND l.i = c.i GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN k.n_removed > 0 THEN coalesce(left_text, '') ELSE text END AS text,
       coalesce(len(lines), 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM d LEFT JOIN k USING (doc_id)""",
    "op12_lexical_search": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
i AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
s AS (SELECT count(*) AS n_all, sum(len(words))::BIGINT AS l_all FROM d WHERE len(words) > 0),
t AS (SELECT doc_id, any_value(n) AS n, term, count(*) AS tf FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM d)
      WHERE term IN (SELECT term FROM i) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * n_all + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t, s GROUP BY term, n_all),
p AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_all) // l_all))) AS part
      FROM t JOIN w USING (term), s),
r AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM i JOIN p USING (term) GROUP BY item_id, doc_id HAVING sum(part) > 0),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM r)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10""",
    "op13_phrases": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS words FROM d),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: words[i:i + k - 1])) AS words
      FROM p, (SELECT unnest([1, 2, 3, 4]) AS k)),
f AS (SELECT lang, k, words, count(*) AS f FROM g GROUP BY lang, k, words HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(words))::BIGINT AS n FROM p GROUP BY lang),
c AS (SELECT lang, words, k, f AS a, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (SELECT c.lang, c.words, c.k, c.a, c.cut, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
      FROM c JOIN f x ON x.lang = c.lang AND x.words = c.words[1:c.cut] JOIN f y ON y.lang = c.lang AND y.words = c.words[c.cut + 1:]),
b AS (SELECT lang, words, any_value(k) AS k, any_value(a) AS a, min({'score': score, 'cut': cut, 'l': l, 'r': r}) AS best
      FROM s GROUP BY lang, words),
i AS (SELECT lang, f, unnest(list_concat(
        list_transform(range(1, k), lambda i: words[i:i + 1]),
        CASE WHEN k = 4 THEN [words[1:3], words[2:4]] ELSE [] END)) AS words FROM f WHERE k > 2),
m AS (SELECT lang, words, max(f) AS f FROM i GROUP BY lang, words),
o AS (SELECT b.lang, array_to_string(b.words, ' ') AS phrase, b.a, b.best.l AS l, b.best.r AS r, b.best.score::BIGINT AS score
      FROM b LEFT JOIN m ON m.lang = b.lang AND m.words = b.words WHERE m.f IS NULL OR 100 * m.f < 80 * b.a),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, a, l, r, n, score FROM k JOIN n USING (lang) WHERE rank <= 2000""",
}
