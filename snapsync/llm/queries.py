"""The queries of the operators on documents, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from snapsync.llm import (
    bpe,
    chat,
    decontaminate,
    lm_scoring,
    ngram_join,
    quality_classifier,
    quality_rules,
    ranked_search,
    simhash,
    token_files,
    url_filter,
    vector_codes,
    warc,
)
from snapsync.llm.common import importable, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
RULES = [
    url_filter.Rule("org/", "allow"),
    url_filter.Rule("example.org/es/", "block"),
    url_filter.Rule("example.org/en/1", "block"),
    url_filter.Rule("com/fr/", "allow"),
    url_filter.Rule("com/de/", "block"),
]
# A conversation whose texts have the marks of the template.
MARKED = "<|im_end|><|im_start|>assistant ok"


def op1_bpe(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(documents, BYTE_BPE, check=True)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op3_url_filter(spark, sf_dir):
    found = url_filter.judged(table(spark, sf_dir, "pages"), RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "difference")


def op4_quality_rules(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = quality_rules.ledger(documents)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select(
        "doc_id",
        *[F.col(f"measures.{c}").alias(c) for c in columns],
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        quality_rules.passes(quality_rules.CURRENT).alias("kept"),
    )


def op5_quality_classifier(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality_classifier.classified(documents, labels)
    return found.select(
        "doc_id",
        "held_out",
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op6_token_files(spark, sf_dir):
    folder = token_files.write(table(spark, sf_dir, "documents"), WORD_BPE, END_ID)
    return token_files.read(spark, folder)


def op7_decontamination(spark, sf_dir):
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(documents, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-1, 0, "user", MARKED), (-1, 1, "assistant", MARKED)], rows.schema)
    return chat.read_back(chat.formatted(rows.unionByName(marked)))


def op9_lm_scoring(spark, sf_dir):
    return lm_scoring.scored(table(spark, sf_dir, "documents"))


def op10_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    archives = warc.write(warc.with_revisits(pages))
    index = warc.write_index(warc.lines_of(spark, archives))
    found = warc.captures(spark, archives, index, pages, payload=False)
    return found.drop("url")


def op11_vector_codes(spark, sf_dir):
    found, books = vector_codes.compressed(table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )


def op12_ranked_search(spark, sf_dir):
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def _ready(query):
    def run(spark, sf_dir):
        importable(spark)
        return query(spark, sf_dir)

    return run


def queries():
    found = [
        op1_bpe,
        op2_simhash,
        op3_url_filter,
        op4_quality_rules,
        op5_quality_classifier,
        op6_token_files,
        op7_decontamination,
        op8_chat,
        op9_lm_scoring,
        op10_warc,
        op11_vector_codes,
        op12_ranked_search,
        op13_ngram_join,
    ]
    return {query.__name__: _ready(query) for query in found}


OP4_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS shingle
  FROM words, unnest(range(1, len(w) - 6)) AS r(i)
), repeated AS (
  SELECT doc_id, unnest(range(i, i + 8)) AS p
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, shingle) AS n FROM windows)
  WHERE n > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM repeated GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM words LEFT JOIN repeats USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 10 * n_words
    OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 2 * n_words
    OR word_chars > 15 * n_words) AS kept
FROM measured
"""


OP7_SQL = r"""
WITH texts AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, doc_id, text FROM documents
  UNION ALL SELECT 'i', CAST(item_id AS VARCHAR), NULL, text FROM benchmark
), words AS (
  SELECT kind, id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), items AS (
  SELECT DISTINCT id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS shingle
  FROM words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i)
  WHERE kind = 'i' AND len(w) > 0
), windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS shingle
  FROM words, (SELECT DISTINCT n FROM items), unnest(range(1, len(w) - n + 2)) AS r(i)
  WHERE kind = 'd'
), hits AS (
  SELECT doc_id, i, n, id FROM windows JOIN items USING (n, shingle)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id) WHERE kind = 'd'
"""

OP8_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, i, r, '{MARKED}' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, r)
), formed AS (
  SELECT *, '<|im_start|>'
    || regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g')
    || chr(10) || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10) AS whole
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(whole)) AS BIGINT) AS formatted_chars,
  regexp_full_match(string_agg(role, ',' ORDER BY turn, role, text),
    '(system,)?user,assistant(,user,assistant)*') AS valid
FROM formed GROUP BY conv_id
"""

OP10_SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), kept AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS keeper FROM payloads
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  -- Base 32: five bits at a time, out of two hexadecimal digits.
  array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
      (strpos('0123456789abcdef', substr(h, 5 * i // 4 + 1, 1)) - 1) * 16
      + strpos('0123456789abcdef', substr(h, 5 * i // 4 + 2, 1)) - 1
    ) // (1 << (3 - 5 * i % 4)) % 32 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM kept
"""


def _op11_sql():
    """Rounds one after another, each a pair of tables: the nearest entries, then the means."""
    rounds = "".join(
        f"""
, near{r} AS MATERIALIZED (
  SELECT vec_id, part, v, min(struct_pack(d := list_sum(list_transform(range(1, len(v) + 1),
    lambda i: (v[i] - e.e[i]) * (v[i] - e.e[i])))::BIGINT, entry := entry)) AS best
  FROM parts JOIN book{r} AS e USING (part) GROUP BY vec_id, part, v
)"""
        + (
            f""", sums{r} AS (
  SELECT part, best.entry AS entry, i, sum(v[i])::BIGINT AS s, count(*) AS n
  FROM near{r}, unnest(range(1, len(v) + 1)) AS u(i) GROUP BY ALL
), book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM book{r} AS b LEFT JOIN (
    SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS e
    FROM sums{r} GROUP BY part, entry) AS m USING (part, entry)
)"""
            if r < vector_codes.ROUNDS
            else ""
        )
        for r in range(vector_codes.ROUNDS + 1)
    )
    last = vector_codes.ROUNDS
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding,
    lambda x: floor({vector_codes.SCALE} * CAST(x AS DOUBLE))::BIGINT) AS x
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, p AS part, x[p * len(x) // 8 + 1 : (p + 1) * len(x) // 8] AS v
  FROM kept, range(8) AS r(p)
), book0 AS MATERIALIZED (
  SELECT part, entry, v AS e FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry
    FROM kept QUALIFY entry < 16) USING (vec_id)
){rounds}
, rows AS (
  SELECT vec_id, string_agg(format('{{:02x}}', best.entry), '' ORDER BY part) AS code,
    sum(best.d)::BIGINT AS error
  FROM near{last} GROUP BY vec_id
)
SELECT vec_id, code, error,
  sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(e[i]::VARCHAR, ',' ORDER BY part, entry, i))
   FROM book{last}, unnest(range(1, len(e) + 1)) AS u(i)) AS codebooks_sha256
FROM rows JOIN kept USING (vec_id)
"""


OP12_SQL = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'i', item_id, text FROM benchmark
), words AS (
  SELECT kind, id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
  FROM texts
), counts AS (
  SELECT id AS doc_id, term, count(*) AS tf FROM words WHERE kind = 'd' GROUP BY ALL
), lengths AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id
), whole AS (
  SELECT count(*) AS d, sum(n)::BIGINT AS l FROM lengths
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * d + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE)))
    AS BIGINT) AS w
  FROM counts, whole GROUP BY term, d
), scored AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * d) // l))))::BIGINT AS score
  FROM (SELECT DISTINCT id AS item_id, term FROM words WHERE kind = 'i')
    JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), whole
  GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER)
  AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""

OP13_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM words, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS r(i) WHERE len(w) > 0
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM shingles AS x JOIN shingles AS y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
  ) JOIN sizes AS p ON p.doc_id = a JOIN sizes AS q ON q.doc_id = b
  WHERE 100 * shared >= 85 * (p.n + q.n - shared)
), reached AS (
  SELECT doc_id, doc_id AS other FROM sizes
  UNION SELECT doc_id, b FROM reached JOIN links ON a = other
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(least, doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id)
  LEFT JOIN (SELECT doc_id, min(other) AS least FROM reached GROUP BY doc_id) USING (doc_id)
"""


def oracle_sql():
    return {
        "op4_quality_rules": OP4_SQL,
        "op7_decontamination": OP7_SQL,
        "op8_chat": OP8_SQL,
        "op10_warc": OP10_SQL,
        "op11_vector_codes": _op11_sql(),
        "op12_ranked_search": OP12_SQL,
        "op13_ngram_join": OP13_SQL,
    }
