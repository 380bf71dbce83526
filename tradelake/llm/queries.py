"""The queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import (
    bpe,
    infill,
    minhash,
    quality,
    resharding,
    rollups,
    rules,
    secrets_scan,
    spelling,
    substrings,
    suffixes,
    toxicity,
    winnowing,
)
from tradelake.session import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ranks_path() -> str:
    """The rank file of the tokenizer package installed on the driver."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), ranks_path(), with_tokens=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op4_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the files the table has to eight shards of equal bytes."""
    docs = resharding.file_shards(table(spark, sf_dir, "documents").select("doc_id", "text", "_metadata"))
    dealt = resharding.reshard(docs, 8, row=resharding.ROW_IN_FILE)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    narrow = dealt.select("doc_id", resharding.size_of(F.col("text")).alias("size"), crc, "shard", "block", "base")
    return resharding.slots(narrow, "doc_id", "text_crc32").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


TOKENIZERS = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after a load, a second tokenizer, a takedown of one source of which one language comes back, another source
    that was counted anew under a new name by one tokenizer, and batches that were sent twice."""
    import public_tokenizers as public

    versions = {name: (public.path(name), public.PATTERN) for name in TOKENIZERS}
    counts = stage(rollups.count_tokens(table(spark, sf_dir, "documents"), versions), "counts")
    first, second = (counts.filter(F.col("version") == v) for v in TOKENIZERS)
    leaving, renamed = counts.filter("source = 'src1'"), first.filter("source = 'src0'")
    totals = rollups.Rollup(spark)
    totals.commit("load", rollups.inserted(first))
    totals.commit("second tokenizer", rollups.inserted(second))
    totals.commit("takedown", rollups.deleted(leaving))
    totals.commit("second tokenizer", rollups.inserted(second))
    totals.commit("renamed", rollups.revised(renamed, renamed.withColumn("source", F.lit("renamed"))))
    totals.compact()
    again = rollups.Rollup(spark, totals.path)
    again.commit("takedown", rollups.deleted(leaving))
    again.commit("appeal", rollups.inserted(leaving.filter("lang = 'de'")))
    return again.totals()


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.repeated_windows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("int").alias("grade"))
    sample = toxicity.with_severity(toxicity.labelled(docs, labels))
    return toxicity.graded(docs, toxicity.train(sample))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, _ = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.counted(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.repeated_strings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = infill.infilled(table(spark, sf_dir, "documents"))
    whole = infill.restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(whole.cast("binary"), 256).alias("restored_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    out = secrets_scan.secrets(table(spark, sf_dir, "documents"), ranks_path())
    return out.select("doc_id", *(secrets_scan.number_of(spans, k).alias(f"n_{k}") for k in secrets_scan.KINDS[:3]),
                      F.sha2(secrets_scan.written(secrets_scan.base_of(spans)), 256).alias("base_sha256"),
                      secrets_scan.written(spans).alias("spans"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_resharding": op4_resharding,
    "op5_token_counts": op5_token_counts,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_quality_rules": op9_quality_rules,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_infill": op11_infill,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_secret_scan": op13_secret_scan,
}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP9_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
g AS (SELECT row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
      FROM d, unnest(generate_series(1, len(w) - 2)) AS t(i)),
r AS (SELECT row, i FROM g QUALIFY count(*) OVER (PARTITION BY row, gram) > 1),
n AS (SELECT row, count(DISTINCT i + j) AS n FROM r, (VALUES (0), (1), (2)) AS o(j) GROUP BY row),
l AS (SELECT row, count(*) - count(DISTINCT line) AS n
      FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row),
c AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(n.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN n USING (row) LEFT JOIN l USING (row)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND NOT (n_symbols > n_words OR 10 * n_dup_lines > n_words
                                   OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept FROM b
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id,
                  regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS span
      FROM b, unnest(generate_series(1, greatest(1, len(w) - 12))) AS t(i) WHERE len(w) > 0),
k AS (SELECT DISTINCT n FROM s),
p AS (SELECT row, i, n, array_to_string(w[i:i + n - 1], ' ') AS span
      FROM d, k, unnest(generate_series(1, len(w) - n + 1)) AS t(i)),
f AS (SELECT p.row, p.i, p.n, s.item_id FROM p JOIN s USING (n, span)),
h AS (SELECT row, count(DISTINCT i + j)::BIGINT AS n_hit FROM f, unnest(generate_series(0, n - 1)) AS t(j) GROUP BY row),
m AS (SELECT row, count(*)::BIGINT AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT row, item_id::VARCHAR AS item_id FROM f) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (row) LEFT JOIN m USING (row)
"""

OP6_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {WORDS} AS w FROM documents),
p AS (SELECT row, doc_id, i, array_to_string(w[i:i + 12], ' ') AS span FROM d, unnest(generate_series(1, len(w) - 12)) AS t(i)),
f AS (SELECT row, i FROM p QUALIFY min(doc_id) OVER (PARTITION BY span) < doc_id),
c AS (SELECT DISTINCT row, i + j AS i FROM f, unnest(generate_series(0, 12)) AS t(j)),
u AS (SELECT row, i, w[i] AS word, c.i IS NOT NULL AS gone
      FROM (SELECT row, w, unnest(generate_series(1, len(w))) AS i FROM d) LEFT JOIN c USING (row, i)),
k AS (SELECT row, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM u GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (row)
"""

OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                  sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
r AS (SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR regexp_matches(text, '<P>|<S>|<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM r),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
"""

OP12_SQL = r"""
WITH RECURSIVE t AS (SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_concat([i::BIGINT], range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i))),
r AS (SELECT doc_id, run, count(*) AS n FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    GROUP BY ALL),
b AS (SELECT run, n, list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda x:
        CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END))) AS bytes FROM r),
h AS (SELECT run, n, xor(4294967295, list_reduce(bytes, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]))) AS h FROM b, t),
w AS (SELECT CASE WHEN h % 199 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, sum(n)::BIGINT AS n
      FROM h GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
g AS (SELECT word, n, word[1:i - 1] AS head, word[i + 1:] AS tail FROM w, unnest(generate_series(1, length(word))) AS u(i)),
e AS (SELECT x.word, y.word AS other FROM g AS x JOIN g AS y ON x.head = y.head AND x.tail = y.tail AND x.word <> y.word
      UNION SELECT g.word, w.word FROM g JOIN w ON w.word = g.head || g.tail
      UNION SELECT w.word, g.word FROM g JOIN w ON w.word = g.head || g.tail),
k AS (SELECT e.word, count(*) AS n_near, arg_min(e.other, struct_pack(a := -w.n, b := e.other)) AS best, max(w.n) AS best_n
      FROM e JOIN w ON w.word = e.other GROUP BY e.word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form,
             CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n FROM w LEFT JOIN k USING (word)),
s AS (SELECT word, word AS root FROM f UNION ALL SELECT s.word, f.form FROM s JOIN f ON f.word = s.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n
FROM f JOIN s USING (word) JOIN f AS last ON last.word = s.root WHERE last.form IS NULL
"""

ORACLE: dict[str, str] = {
    "op11_infill": OP11_SQL,
    "op12_spelling_variants": OP12_SQL,
    "op3_decontamination": OP3_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op9_quality_rules": OP9_SQL,
}
