"""Each operator over its whole table, with production parameters."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontaminate, dialogue, linededup, merkle, packing, quality, repeats, sharding, simhash, suffixes, toxicity, urllists, warc
from .catalog import query, table
from .shared import written
from .vocabulary import RANKS, TOKENIZER


@query("op7_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query("op9_substring_dedup")
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.repeated_words(table(spark, folder, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op3_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), TOKENIZER, capacity=packing.Capacity(tokens=2048), ranks=RANKS)


@query("op6_sampled_splitters")
def sampled_splitters(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents").select("doc_id", "source", F.octet_length(text).cast("long").alias("bytes"), F.crc32(text).alias("text_crc32"))
    found = sharding.shards(docs, 40, ["source", "doc_id"], F.col("bytes") + 16)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op8_risk_controlled_quality")
def risk_controlled_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.verdicts(table(spark, folder, "documents"), table(spark, folder, "labels"), F.col("quality") == 1)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


URL_LISTS_SQL = r"""
WITH page AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST((page_id * 7919) % 36 AS INTEGER) AS DATE) AS day,
    lower(regexp_replace(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:@]+)', 1), '\.$', '')) AS host,
    list_filter(string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS seg
  FROM pages),
entry AS (
  SELECT e.event_type AS list, CAST(e.ts AS DATE) AS day, e.value >= 30 AS added,
    CASE e.event_id % 3 WHEN 0 THEN p.host
      WHEN 1 THEN regexp_replace(p.host, '^[^.]+\.', '')
      ELSE p.host || '/' || coalesce(p.seg[1], '') END AS pattern
  FROM events e JOIN page p ON e.user_id = p.page_id),
change AS (
  SELECT list, pattern, day, max(CAST(added AS INTEGER)) AS added FROM entry GROUP BY ALL),
span AS (
  SELECT list, pattern, added, day AS since, lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS until FROM change),
key AS (
  SELECT page_id, day, array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.') AS pattern
  FROM page, (SELECT unnest(range(1, 40)) AS i) WHERE host <> '' AND i <= greatest(len(string_split(host, '.')) - 1, 1)
  UNION
  SELECT page_id, day, host || '/' || array_to_string(list_slice(seg, 1, k), '/')
  FROM page, (SELECT unnest(range(1, 200)) AS k) WHERE host <> '' AND k <= len(seg)),
hit AS (
  SELECT page_id, list FROM key JOIN span USING (pattern)
  WHERE added = 1 AND since <= key.day AND (until IS NULL OR key.day < until)),
verdict AS (
  SELECT page_id, array_to_string(list_sort(list(DISTINCT list)), ',') AS lists, count(*) AS n_entries,
    bool_or(list <> 'signup') AND NOT bool_or(list = 'signup') AS blocked
  FROM hit GROUP BY page_id)
SELECT page_id, CAST(day AS VARCHAR) AS day, coalesce(lists, '') AS lists, CAST(coalesce(n_entries, 0) AS BIGINT) AS n_entries,
  coalesce(blocked, false) AS blocked
FROM page LEFT JOIN verdict USING (page_id)
"""


@query("op4_temporal_url_lists", URL_LISTS_SQL)
def temporal_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    """The tables have no lists and no fetch times: events are the dated entries, for patterns of the page whose number is the
    user's, and the day of a fetch comes from the page's number."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(36)).cast("int"))
    pages = table(spark, folder, "pages").select("page_id", "url", day.alias("day"))
    host = urllists.host_of(F.col("url"))
    kind = F.col("event_id") % 3
    first = F.coalesce(F.get(urllists.segments_of(F.col("url")), F.lit(0)), F.lit(""))
    pattern = F.when(kind == 0, host).when(kind == 1, F.regexp_replace(host, r"^[^.]+\.", "")).otherwise(F.concat(host, F.lit("/"), first))
    events = table(spark, folder, "events").join(pages.select(F.col("page_id").alias("user_id"), "url"), "user_id")
    entries = events.select(F.col("event_type").alias("list"), pattern.alias("pattern"), F.to_date("ts").alias("day"), (F.col("value") >= 30).alias("added"))
    found = urllists.judged(pages, entries, allow="signup")
    return found.select("page_id", F.col("day").cast("string").alias("day"), F.array_join("lists", ",").alias("lists"), "n_entries", "blocked")


@query("op5_warc_normaliser")
def warc_normaliser(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write_archives(table(spark, folder, "pages"), least=0)
    read = warc.read_records(warc.normalise(archives))
    # Read back once; only the numbers are kept.
    rows = written(read.select(F.col("page").alias("page_id"), F.col("type").alias("record_type"), F.octet_length("payload").cast("long").alias("bytes"), "payload_digest", "refers_to"), "read")
    # A revisit has the length of the payload that it names.
    sizes = rows.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("bytes").alias("full"))
    return rows.join(sizes, "payload_digest", "left").select("page_id", F.coalesce("bytes", "full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


@query("op10_recurrent_toxicity")
def recurrent_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    net = toxicity.train(docs, table(spark, folder, "labels"))
    found = toxicity.scored(docs, net)
    return found.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op1_line_dedup")
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = linededup.similar_lines(table(spark, folder, "documents"), least=0.8)
    return found.select("doc_id", "line", F.col("class_key").alias("class_doc_id"), "class_line", "links", "removed")


@query("op2_latent_decontamination")
def latent_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def crc32_sql(text: str) -> str:
    """DuckDB expression of the unsigned CRC-32 of an ASCII text: a byte is taken in, then eight bits are shifted out."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    shift = "xor(a >> 1, 3988292384 * (a & 1))"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE {shift} END))"


MERKLE_SQL = f"""
WITH RECURSIVE field AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('=' || source, '') AS tree, text,
    concat_ws('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head
  FROM documents),
leaf AS (
  SELECT row, doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {crc32_sql("doc_id::VARCHAR")} % 5 = 0
      THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
      ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS changed
  FROM field),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaf),
low AS (
  SELECT tree, 0 AS lvl, pos, n, leaf AS node FROM ranked
  UNION ALL
  SELECT tree, lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY tree, lvl, pos // 16, n),
top AS (
  SELECT 0 AS lvl, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, node FROM low WHERE n = 1
  UNION ALL
  SELECT lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 16, n),
beside AS (
  SELECT tree, lvl, pos,
    coalesce(string_agg(node, '') OVER (PARTITION BY tree, lvl, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(node, '') OVER (PARTITION BY tree, lvl, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM low WHERE n > 1
  UNION ALL
  SELECT NULL, lvl, pos,
    coalesce(string_agg(node, '') OVER (PARTITION BY lvl, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
    coalesce(string_agg(node, '') OVER (PARTITION BY lvl, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')
  FROM top WHERE n > 1),
up AS (
  SELECT row, tree, 0 AS lvl, pos, changed AS node, '' AS proof FROM ranked
  UNION ALL
  SELECT row, up.tree, up.lvl + 1, up.pos // 16, sha256(l || node || r), proof || l || r FROM up JOIN beside b ON b.tree = up.tree AND b.lvl = up.lvl AND b.pos = up.pos),
under AS (SELECT row, tree, node, proof FROM up QUALIFY row_number() OVER (PARTITION BY row ORDER BY lvl DESC) = 1),
tops AS (SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos FROM low WHERE n = 1),
final AS (
  SELECT row, subroot, 0 AS lvl, pos, node, proof FROM under JOIN tops USING (tree)
  UNION ALL
  SELECT row, subroot, f.lvl + 1, f.pos // 16, sha256(l || node || r), proof || l || r FROM final f JOIN beside b ON b.tree IS NULL AND b.lvl = f.lvl AND b.pos = f.pos),
done AS (SELECT row, subroot, node, proof FROM final QUALIFY row_number() OVER (PARTITION BY row ORDER BY lvl DESC) = 1)
SELECT doc_id, leaf, subroot, (SELECT node FROM top WHERE n = 1) AS root, sha256(proof) AS proof_sha256, node AS folded_root,
  node = (SELECT node FROM top WHERE n = 1) AS verified
FROM done JOIN ranked USING (row)
"""


@query("op12_merkle_manifest", MERKLE_SQL)
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    # Null where the leaf stays what it is.
    changed = F.when(tampered, merkle.leaf_of(*head, lower))
    found = merkle.manifest(docs, merkle.leaf_of(*head, F.col("text")), carry={"changed": changed})
    fold = merkle.folded(F.coalesce("changed", "leaf"), F.col("path"))
    out = found.select("doc_id", "leaf", "subroot", "root", merkle.proof_of(F.col("path")).alias("proof_sha256"), fold.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _damaged(rows: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user, by the hash of their number."""
    blank = F.lit(" ")
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), blank) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    kind = F.crc32(name) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


@query("op11_conversation_repair")
def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    found = dialogue.repaired(_damaged(rows)).summary
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = found.select(F.col("conv_id").alias("__conv"), *counts, "audit", "repaired_sha256")
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts]
    return every.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(dialogue.EMPTY_SHA256)).alias("repaired_sha256"))


@query("op13_bucket_pointer_dedup")
def bucket_pointer_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.repeated_bytes(table(spark, folder, "documents"), width=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
