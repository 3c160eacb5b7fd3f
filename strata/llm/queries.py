"""The queries ``opN_<name>``: each applies its operator, with production parameters, to its
whole table. ``QUERIES`` maps names to callables, ``ORACLES`` to DuckDB SQL where SQL can
express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import ship
from strata.sources.tables import scan as table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def llm_query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return deco


# ------------------------------------------------------------------ 1 n-gram Jaccard join

@llm_query("op1_ngram_jaccard_join")
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.jaccard_join import join

    documents, _, _ = join(table(spark, sf_dir, "documents", ["doc_id", "text"]), n=5, percent=75)
    return documents.select("doc_id", "n_shingles", "component_id")


# ------------------------------------------------------------------ 2 mixing sources

OP2_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
named AS (
  SELECT source, sum(size)::DOUBLE AS s,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source),
-- reshare round by round: sources above their limit stop there, the rest share what is left
rounds AS (
  SELECT 0 AS r, source, s, w, false AS stopped, (SELECT sum(s) FROM named) AS pool,
         (SELECT sum(w) FROM named) AS open_w FROM named
  UNION ALL
  SELECT r + 1, source, s, w, stopped OR now_stopped,
         (SELECT sum(s) FROM named) - coalesce(sum(CASE WHEN stopped OR now_stopped THEN 3 * s END) OVER (), 0),
         sum(CASE WHEN NOT (stopped OR now_stopped) THEN w ELSE 0 END) OVER ()
  FROM (SELECT *, NOT stopped AND pool * w > 3 * s * open_w AS now_stopped,
               bool_or(NOT stopped AND pool * w > 3 * s * open_w) OVER () AS go FROM rounds)
  WHERE go),
goal AS (
  SELECT source, s AS source_size, CASE WHEN stopped OR open_w = 0 THEN 3 * s ELSE pool * w / open_w END AS target
  FROM rounds WHERE r = (SELECT max(r) FROM rounds)),
place AS (
  SELECT d.*, g.source_size::BIGINT AS source_size, g.target,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
-- the golden-ratio schedule: which slot takes which block of 64 words of which source
shares AS (
  SELECT source, source_size, floor(target) AS words, ceil(floor(target) / 64) AS blocks,
         coalesce(sum(target) OVER (ORDER BY encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(target) OVER () AS lo,
         sum(target) OVER (ORDER BY encode(source) NULLS LAST ROWS UNBOUNDED PRECEDING) / sum(target) OVER () AS hi FROM goal),
size_of AS (SELECT CAST(coalesce(sum(blocks), 0) AS BIGINT) AS slots FROM shares WHERE words > 0),
points AS (SELECT slot, slot * 0.6180339887498949::DOUBLE - floor(slot * 0.6180339887498949::DOUBLE) AS u FROM size_of, range(slots) r(slot)),
hits AS (SELECT source, blocks, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS block
         FROM points JOIN shares ON words > 0 AND u >= lo AND u < hi),
had AS (SELECT source, count(*) AS n FROM hits GROUP BY source),
slots AS (
  SELECT source, block, slot FROM hits WHERE block < blocks
  UNION ALL
  SELECT source, block, slots + block FROM (
    SELECT s.source, unnest(range(CAST(coalesce(h.n, 0) AS BIGINT), CAST(s.blocks AS BIGINT))) AS block FROM shares s LEFT JOIN had h ON h.source IS NOT DISTINCT FROM s.source
    WHERE s.words > 0), size_of),
laps AS (
  SELECT p.source, p.doc_id, p.start, start + lap * p.source_size AS a, least(start + lap * p.source_size + size, floor(target)) AS z
  FROM place p, (VALUES (0), (1), (2)) l(lap) WHERE size > 0 AND start + lap * p.source_size < floor(target)),
held AS (
  SELECT l.source, l.doc_id, l.start, min(s.slot) AS first_slot, max(s.slot) AS last_slot
  FROM (SELECT *, unnest(range(CAST(floor(a / 64) AS BIGINT), CAST(floor((z - 1) / 64) AS BIGINT) + 1)) AS block FROM laps) l
  JOIN slots s ON s.source IS NOT DISTINCT FROM l.source AND s.block = l.block GROUP BY 1, 2, 3),
taken AS (
  SELECT doc_id, source, size, source_size, target, start,
         CAST(sum(greatest(0, least(start + size + lap * source_size, floor(target)) - (start + lap * source_size))) AS BIGINT) AS taken
  FROM place, (VALUES (0), (1), (2)) laps(lap)
  GROUP BY doc_id, h, source, size, source_size, target, start)
SELECT t.doc_id, size, source_size, round(target, 6) AS target, taken, first_slot, last_slot
FROM taken t LEFT JOIN held h ON h.doc_id IS NOT DISTINCT FROM t.doc_id AND h.source IS NOT DISTINCT FROM t.source AND h.start = t.start
"""


@llm_query("op2_mix_sources", OP2_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.mixing import taken_words

    docs = table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    mixed = taken_words(docs, weights=(5, 2, 1), max_repeat=3, block_tokens=64)
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 6).alias("target"), "taken",
                        "first_slot", "last_slot")


# ------------------------------------------------------------------ 3 language ID

@llm_query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.language_id import held_out, identify, train

    docs = table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    model = train(docs.where(~held_out()).select("text", "lang"))
    labelled = identify(docs.select("doc_id", "text"), model)
    return labelled.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


# ------------------------------------------------------------------ 4 packing

@llm_query("op4_pack_documents")
def op4_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.packing import PACKING_LIMITS, digest, pack_documents

    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return digest(pack_documents(docs, tokens=2048, **PACKING_LIMITS))


# ------------------------------------------------------------------ 5 quality classifier

@llm_query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.boosted_trees import document_features, score, train
    from strata.llm.common import written
    from strata.llm.language_id import held_out

    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = table(spark, sf_dir, "labels", ["doc_id", "quality"])
    featured = written(document_features(docs).drop("text"), "op5-features")
    trees = train(featured.where(~held_out()), labels, "doc_id", "quality")
    scored = score(featured, trees)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


# ------------------------------------------------------------------ 6 document fingerprints

@llm_query("op6_document_fingerprints")
def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.ibl_sketch import versions

    return versions(table(spark, sf_dir, "documents", ["doc_id", "text"]))


# ------------------------------------------------------------------ 7 sharding

@llm_query("op7_shard_documents")
def op7_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents", ["doc_id", "text"]), shards=40)


# ------------------------------------------------------------------ 8 quality rules

@llm_query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import written
    from strata.llm.quality_rules import judge, measure

    docs = table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"])
    measured = written(measure(docs).drop("text"), "op8-counts")
    return judge(measured).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                  "base_failed", "kept")


# ------------------------------------------------------------------ 9 WARC

@llm_query("op9_warc_round_trip")
def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.warc import page_id_of, round_trip

    back = round_trip(spark, table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return back.select(page_id_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       page_id_of(F.col("refers_to_id")).alias("refers_to"))


# ------------------------------------------------------------------ 10 secret scans

@llm_query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.secret_scan import BASE_KINDS, digest, scan

    found = scan(table(spark, sf_dir, "documents", ["doc_id", "text"]))
    spans = F.col("secret_spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = digest(F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS)))
    return found.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(F.encode(base, "UTF-8"), 256).alias("base_sha256"),
                        digest(spans).alias("spans"))


# ------------------------------------------------------------------ 11 substring dedup

OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
word AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) AS s FROM d)),
later AS (
  SELECT doc_id, s FROM windows
  QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, s) > 1),
covered AS (
  SELECT DISTINCT doc_id, s + k AS p FROM later, range(20) r(k)),
kept AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.p) AS text, count(*) AS n
  FROM word w ANTI JOIN covered c ON w.doc_id = c.doc_id AND w.p = c.p GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@llm_query("op11_substring_dedup", OP11_SQL)
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.suffix_trees import remove_repeats

    kept = remove_repeats(table(spark, sf_dir, "documents", ["doc_id", "text"]), words=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


# ------------------------------------------------------------------ 12 cross-tokenizer alignment

@llm_query("op12_cross_tokenizer_alignment")
def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.token_alignment import align

    documents, _ = align(table(spark, sf_dir, "documents", ["doc_id", "text"]), digest=True)
    return documents.withColumnRenamed("groups", "groups_sha256")


# ------------------------------------------------------------------ 13 phrase collocation mining

OP13_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
seq AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
size AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM seq GROUP BY lang),
spot AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM seq),
gram AS (
  SELECT lang, m AS words, array_to_string(w[p:p + m - 1], ' ') AS phrase, count(*) AS f
  FROM spot, (VALUES (1), (2), (3), (4)) v(m) WHERE p + m - 1 <= len(w)
  GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM gram WHERE words > 1),
cut AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r,
         CAST(2000000 AS HUGEINT) * c.f // (l.f + r.f) AS score
  FROM (SELECT *, unnest(range(1, words)) AS k FROM cand) c
  JOIN gram l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN gram r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[o:o + s - 1], ' ') AS phrase, max(f) AS longer
  FROM cand, (VALUES (2), (3)) v(s), (VALUES (1), (2), (3)) u(o)
  WHERE s < words AND o + s - 1 <= words GROUP BY ALL),
kept AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
  FROM best b LEFT JOIN inside i ON b.lang = i.lang AND b.phrase = i.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 80 * a)
SELECT k.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       n, CAST(score AS BIGINT) AS score
FROM kept k JOIN size s ON k.lang = s.lang WHERE rank <= 2000
"""


@llm_query("op13_phrase_collocations", OP13_SQL)
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents", ["text", "lang"]), least=30, top=2000, covered=80)
