"""One query per operator, over the whole of its table and with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hailgrid.llm.binary_packing import binary_packed
from hailgrid.llm.chat import PROBE_ID, PROBE_TEXT, chat_digest
from hailgrid.llm.clusters import cluster_digest
from hailgrid.llm.decontaminate import contamination
from hailgrid.llm.language import languages
from hailgrid.llm.minhash import edited_fingerprints
from hailgrid.llm.packing import packed
from hailgrid.llm.pages import page_texts
from hailgrid.llm.pii import pii_digest
from hailgrid.llm.registry import query, table
from hailgrid.llm.resample import resampled
from hailgrid.llm.shards import shard_digest
from hailgrid.llm.simhash import simhash_groups
from hailgrid.llm.substrings import substring_digest


@query("op1_pii")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return pii_digest(table(spark, sf, "documents"))


CHAT_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {PROBE_ID}, 0, 'user', '{PROBE_TEXT}'
  UNION ALL SELECT {PROBE_ID}, 1, 'assistant', '{PROBE_TEXT}'
), sized AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
    length('<|im_start|><|im_end|>') + 2 + length(role) + length(regexp_replace(text, '<(\\*n?)\|', '<\\\1|', 'g')) AS size
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
  sha256(string_agg(loss, '' ORDER BY turn)) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query("op2_chat", CHAT_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return chat_digest(table(spark, sf, "conversations"))


@query("op3_minhash")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf, "documents"))


@query("op4_language")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return languages(table(spark, sf, "documents"))


CONTAMINATION_SQL = r"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT item, least(10, len(words)) AS size, list_slice(words, k, k + least(10, len(words)) - 1) AS win
  FROM (SELECT item, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS k FROM item_words WHERE len(words) > 0)
), doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), starts AS (
  SELECT doc_id, size, k, list_slice(words, k, k + size - 1) AS win
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS k
        FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)
), found AS (
  SELECT doc_id, item, starts.size AS size, k FROM starts JOIN windows USING (size, win)
), hit AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS w FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op5_decontaminate", CONTAMINATION_SQL)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op6_shards")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return shard_digest(table(spark, sf, "documents"))


@query("op7_packing")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return packed(table(spark, sf, "documents"))


SUBSTRING_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, k, list_slice(words, k, k + 34) AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS k FROM split WHERE len(words) >= 35)
), repeated AS (
  SELECT win FROM starts GROUP BY win HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS w FROM starts JOIN repeated USING (win)
), word AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS w FROM split
), kept AS (
  SELECT word.doc_id, count(gone.w) AS n_removed, string_agg(word, ' ' ORDER BY word.w) FILTER (WHERE gone.w IS NULL) AS kept
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.w = gone.w GROUP BY word.doc_id
)
SELECT split.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN kept ON split.doc_id = kept.doc_id
"""


@query("op8_substring_dedup", SUBSTRING_SQL)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return substring_digest(table(spark, sf, "documents"))


@query("op9_simhash")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op10_pages")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return page_texts(table(spark, sf, "pages"))


def clusters_sql(rounds: int = 3) -> str:
    """Every round measures all distances; sums and means are whole numbers."""
    steps = [
        """kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), vec_id, v) - 1 AS cluster, v AS c
  FROM kept QUALIFY cluster < 16
)"""
    ]
    for k in range(rounds + 1):
        steps.append(f"""d{k} AS (
  SELECT r, cluster, list_sum(list_transform(list_zip(v, c), lambda p: CAST((p[1] - p[2]) * (p[1] - p[2]) AS BIGINT))) AS d FROM kept, c{k}
), a{k} AS (
  SELECT r, cluster, d FROM d{k} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, cluster) = 1
)""")
        if k < rounds:
            steps.append(f"""m{k} AS (
  SELECT cluster, i, sum(x) AS s, count(*) AS n
  FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{k} JOIN kept USING (r)) GROUP BY cluster, i
), c{k + 1} AS (
  SELECT c{k}.cluster, coalesce(m.c, c{k}.c) AS c FROM c{k} LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM m{k} GROUP BY cluster
  ) m ON m.cluster = c{k}.cluster
)""")
    return (
        f"WITH {', '.join(steps)}"
        + f"""
SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (r) JOIN c{rounds} c ON c.cluster = a.cluster
"""
    )


@query("op11_clusters", clusters_sql())
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return cluster_digest(table(spark, sf, "embeddings"))


@query("op12_binary_packing")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return binary_packed(table(spark, sf, "documents"))


# The checksum bit by bit: every byte is joined in, and eight steps divide. Ranks are doubles: a frame of whole
# numbers with gaps reads back as doubles on the other side too.
RESAMPLE_SQL = r"""
WITH texts AS (
  SELECT TRUE AS own, doc_id, text, row_number() OVER () AS r FROM documents
  UNION ALL SELECT FALSE, 0, text, row_number() OVER () FROM benchmark
), split AS (
  SELECT own, doc_id, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts
), features AS (
  SELECT own, r, unnest(words) AS feature FROM split
  UNION ALL SELECT own, r, unnest(list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) FROM split
), named AS (
  SELECT own, r, feature, count(*) AS n FROM features GROUP BY own, r, feature
), hex AS (
  SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM named)
), hashed AS (
  SELECT feature, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, 4 * len(h)), lambda k: CASE WHEN k % 8 = 0
        THEN CAST((instr('0123456789ABCDEF', h[k // 4 + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[k // 4 + 2]) - 1 AS BIGINT) ELSE 0 END)),
      lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) % 10000 AS bucket FROM hex
), found AS (
  SELECT own, r, bucket, n FROM named JOIN hashed USING (feature)
), counted AS (
  SELECT b.bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM (SELECT unnest(range(10000)) AS bucket) b
  LEFT JOIN (SELECT bucket, sum(n) FILTER (WHERE own) AS s, sum(n) FILTER (WHERE NOT own) AS t FROM found GROUP BY bucket) f ON f.bucket = b.bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM counted
), weighed AS (
  SELECT r, sum(n) AS n, sum(n * gain) AS g FROM found JOIN gains USING (bucket) WHERE own GROUP BY r
), noisy AS (
  SELECT r, doc_id, len(words) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
    CAST(coalesce((g - ((g % n) + n) % n) // n, 0) AS BIGINT) AS weight,
    CAST('0x' || substr(sha256('7:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h
  FROM split LEFT JOIN weighed USING (r) WHERE own
), scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM noisy
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id, n_features) AS place, count(*) FILTER (WHERE n_words >= 20) OVER () AS able FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * able // 100 THEN CAST(place AS DOUBLE) END AS rank FROM ordered
"""


@query("op13_resample", RESAMPLE_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return resampled(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
