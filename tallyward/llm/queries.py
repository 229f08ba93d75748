"""The registered queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import bpe, chat, decontaminate, line_dedup, neighbours, pii, quality_classifier, quality_rules, runs, simhash, suffix_dedup, toxicity, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; -1 without an id, which is in no fold."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts, F.lit(-1))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return checked.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), digest, "contaminated")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), usable=fold(4) != 2)
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        (fold(4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("spots").cast("long").alias("n_spots"),
        F.array_join("spots", ",").alias("spots"),
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_strings(table(spark, sf_dir, "documents"), digest=True)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"), usable=fold(3) != 1)
    scored = quality_classifier.score(docs, model)
    return scored.select(
        "doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, spark.conf.get("spark.tallyward.pii.key", "a key for tests").encode())


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.cascade(table(spark, sf_dir, "documents")).drop("rejected_by")  # depends on measured costs


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


def tokenizer(name: str) -> str:
    """The settings of a public tokenizer, read from where its package keeps them."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text()


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), digest=True)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", trap), (-7, 1, "assistant", trap)], rows.schema)
    settings = tokenizer("byte_bpe_50k.json")
    back = chat.read_chats(chat.format_chats(rows.union(extra), settings), settings)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(table(spark, sf_dir, "documents"), plant=True)


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_quality_rules": op2_quality_rules,
    "op3_decontaminate": op3_decontaminate,
    "op4_toxicity": op4_toxicity,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_line_dedup": op7_line_dedup,
    "op8_bpe": op8_bpe,
    "op9_simhash": op9_simhash,
    "op10_chat": op10_chat,
    "op11_whitening": op11_whitening,
    "op12_runs": op12_runs,
    "op13_neighbours": op13_neighbours,
}

ORACLE: dict[str, str] = {
    "op2_quality_rules": r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 2) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3)),
repeated AS (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS place
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM repeated GROUP BY doc_id),
base AS (
  SELECT s.doc_id, t, w, lines, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 2 * n_dup_lines > len(lines)
            OR word_chars / n_words < 2 OR word_chars / n_words > 15
            OR 10 * len(list_filter(w, lambda x: regexp_matches(x, '\pL'))) < 7 * n_words
            OR 10 * len(regexp_extract_all(t, '[!?;:,]{2,}')) > n_words
            OR 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^[ \t]*[-*•‣·]'))) > 9 * len(lines)
            OR 10 * len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\r]*$'))) > 3 * len(lines)) AS kept
FROM base""",
    "op3_decontaminate": r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(f.n, 0)::BIGINT AS n_items,
       sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words h ON d.doc_id = h.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id""",
    "op7_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
numbered AS (SELECT doc_id, i, l[i] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM lines)),
worded AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM numbered WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
windows AS (
  SELECT a.doc_id, a.k, a.line AS x, b.line AS y, c.line AS z
  FROM worded a JOIN worded b ON a.doc_id = b.doc_id AND b.k = a.k + 1 JOIN worded c ON a.doc_id = c.doc_id AND c.k = a.k + 2),
late AS (
  SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, k) AS n FROM windows) WHERE n > 1),
runs AS (
  SELECT doc_id, count(*) AS n
  FROM (SELECT doc_id, k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS gap FROM late) WHERE gap IS NULL OR gap > 3 GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest([k, k + 1, k + 2]) AS k FROM late),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
places AS (SELECT w.doc_id, w.i FROM worded w JOIN gone g ON w.doc_id = g.doc_id AND w.k = g.k),
kept AS (
  SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.i) AS t
  FROM numbered n LEFT JOIN places p ON n.doc_id = p.doc_id AND n.i = p.i WHERE p.i IS NULL GROUP BY n.doc_id),
sizes AS (SELECT doc_id, count(*) AS n FROM worded GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_lines, coalesce(r.n, 0)::BIGINT AS n_removed, coalesce(u.n, 0)::BIGINT AS n_runs,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM lines d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN removed r ON d.doc_id = r.doc_id
LEFT JOIN runs u ON d.doc_id = u.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id""",
    "op10_chat": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '(\\|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|\[ROLE\]|\[:\]|\[/ROLE\])'))
         + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
           ELSE 16 + length(role) + len(regexp_extract_all(role, '(\\|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|\[ROLE\]|\[:\]|\[/ROLE\])'))
           END AS chars
  FROM turns),
whole AS (
  SELECT conv_id, count(*) AS n, sum(chars) AS chars,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS t,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS loss
  FROM sized GROUP BY conv_id)
SELECT conv_id, n::BIGINT AS n_turns, sha256(t) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       chars::BIGINT AS formatted_chars
FROM whole""",
}
