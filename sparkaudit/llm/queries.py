"""The operators on the given tables, with production parameters, and their SQL twins."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, decontamination, fingerprints, language_model, merkle, neardup, pieces, pii, quality, runs, secrets, sharding, toxicity,
)
from .batches import cut

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def digest(text) -> F.Column:
    """Lower-case hex of the SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(F.encode(text, "utf-8"), 256)


@query("op2_bpe_prefix")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode_texts(table(spark, folder, "documents"), path, keep=["doc_id"])
    decoded = bpe.decode_ids(encoded, path)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


#: Words, windows and whole short items as strings, joined on equality; hit words are counted by position.
OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
m AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query("op5_decontamination", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_matches(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), width=10, keep=["doc_id"]
    )
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return found.withColumn("items", items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        digest(F.array_join("items", ",")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


#: CRC-32 by bytes over the table of its polynomial; ranks and cuts as plain windows.
OP7_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT 0 AS k, i AS b, i AS c FROM range(256) r(i)
  UNION ALL
  SELECT k + 1, b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS tab FROM bits WHERE k = 8),
rows AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda x: CAST('0x' || x AS BIGINT))), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
    md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw,
    coalesce('=' || source, '') AS s
  FROM documents, crc),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY s ORDER BY draw, size, text_crc32) - 1
    + CAST(CAST('0x' || substr(md5(s), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0) / count(*) OVER (PARTITION BY s) AS place
  FROM rows),
cut AS (SELECT *, row_number() OVER (ORDER BY place, draw, size, text_crc32) - 1 AS pos, count(*) OVER () AS n FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
  CAST(pos * 8 // n AS INTEGER) AS shard, CAST(pos - ((pos * 8 // n) * n + 7) // 8 AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""


@query("op7_interleave", OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    narrow = table(spark, folder, "documents").select(
        "doc_id", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )
    dealt = sharding.interleave(narrow, 8, ties=["size", "text_crc32"])
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op4_quality_ordinal")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    graded = quality.grade(docs, model, keep=["doc_id"])
    return graded.withColumn("kept", F.col("tail_probability") >= 0.5)


@query("op10_compression_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3))
    model = toxicity.fit(docs, table(spark, folder, "labels").where(fold != 1))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id", (fold == 1).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"),
    )


def span_list(spans) -> F.Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def span_digest(found: DataFrame, spans: str, kinds: list[str]) -> DataFrame:
    """Counts of base spans by kind, digest of the base spans, list of all spans."""
    base = F.filter(spans, lambda s: s["base"])
    found_kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(found_kinds) - F.size(F.array_remove(found_kinds, k))).cast("bigint").alias(f"n_{k}") for k in kinds
    ]
    return found.select("doc_id", *counts, digest(span_list(base)).alias("base_sha256"), span_list(F.col(spans)).alias("spans"))


@query("op6_guess_cost_secrets")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = secrets.find_secrets(docs, secrets.common_words(docs), keep=["doc_id"])
    return span_digest(found, "secrets", ["assign", "access", "hex"])


@query("op1_bilstm_crf_pii")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return span_digest(pii.find_pii(docs, pii.fit(docs), keep=["doc_id"]), "pii", list(pii.KINDS))


@query("op9_weighted_sampling")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


@query("op8_chosen_path_neardup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.find_duplicates(table(spark, folder, "documents"), width=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op3_suffix_tree")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) == 2
    scored = language_model.score(docs, docs.where(~held_out), keep=["doc_id"])
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): where crc32(doc_id) ends in 0, the words from a hashed one on repeat with a hashed period.

    Rows without doc_id stay as they are.
    """

    def plant(key: int | None, text: str | None) -> str | None:
        h = zlib.crc32(str(key).encode()) if key is not None else 1
        if h % 10 or not text or not (words := text.encode("utf-8", "surrogatepass").split()):
            return text
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        period = words[a : a + p]
        repeats = -(-(n - a) // p)
        return b" ".join(words[:a] + (period * repeats)[: n - a]).decode("utf-8", "surrogatepass")

    def run(parts):
        for whole in parts:
            for part in cut(whole, 1, runs.SLICE_BYTES):
                keys, texts = part.column(0), part.column(1).to_pylist()
                made = pa.array([plant(k, t) for k, t in zip(keys.to_pylist(), texts)], pa.string())
                yield pa.RecordBatch.from_arrays([keys, made], names=["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, docs.select("doc_id", "text").schema)


@query("op11_periodic_runs")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_runs(table(spark, folder, "documents")), 24, 3, keep=["doc_id"])
    greater = "r.length * best.period > best.length * r.period"
    best = F.expr(f"aggregate(runs, runs[0], (best, r) -> if({greater}, r, best))")
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        digest(listed).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"),
    )


@query("op12_chunk_table_pieces")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces.encode_texts(table(spark, folder, "documents"), path, keep=["doc_id"])
    decoded = pieces.decode_ids(encoded, path)
    listed = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id", "n_tokens", digest(listed).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256")
    )


#: Levels and proofs by recursion: three neighbours a node, then the path of each row with its own node replaced.
OP13_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT 0 AS k, i AS b, i AS c FROM range(256) r(i)
  UNION ALL
  SELECT k + 1, b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS tab FROM bits WHERE k = 8),
shown AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    text, replace(text, chr(10), '') AS cut,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'),
      lambda x: CAST('0x' || x AS BIGINT))), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM documents, crc),
hashed AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN h % 2 = 0 THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-'))
      ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS claimed
  FROM shown),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS idx,
    count(*) OVER (PARTITION BY tree) AS n FROM hashed),
nodes AS (
  SELECT tree, 0 AS level, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1
  GROUP BY tree, level, idx // 3, n),
tops AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS level, idx, n, h FROM tops
  UNION ALL
  SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM upper WHERE n > 1
  GROUP BY level, idx // 3, n),
up AS (
  SELECT tree, idx AS spot, 0 AS level, idx, n, claimed AS f, '' AS siblings FROM leaves
  UNION ALL
  SELECT p.tree, p.spot, p.level + 1, p.idx // 3, (p.n + 2) // 3,
    sha256(string_agg(CASE WHEN m.idx = p.idx THEN p.f ELSE m.h END, '' ORDER BY m.idx)),
    p.siblings || coalesce(string_agg(m.h, '' ORDER BY m.idx) FILTER (m.idx <> p.idx), '')
  FROM up p JOIN nodes m ON m.tree = p.tree AND m.level = p.level AND m.idx // 3 = p.idx // 3 WHERE p.n > 1
  GROUP BY p.tree, p.spot, p.level, p.idx, p.n, p.f, p.siblings),
across AS (
  SELECT up.tree, spot, 0 AS level, tops.idx, tops.n, f, siblings, tops.h AS subroot FROM up JOIN tops USING (tree) WHERE up.n = 1
  UNION ALL
  SELECT p.tree, p.spot, p.level + 1, p.idx // 3, (p.n + 2) // 3,
    sha256(string_agg(CASE WHEN m.idx = p.idx THEN p.f ELSE m.h END, '' ORDER BY m.idx)),
    p.siblings || coalesce(string_agg(m.h, '' ORDER BY m.idx) FILTER (m.idx <> p.idx), ''), p.subroot
  FROM across p JOIN upper m ON m.level = p.level AND m.idx // 3 = p.idx // 3 WHERE p.n > 1
  GROUP BY p.tree, p.spot, p.level, p.idx, p.n, p.f, p.siblings, p.subroot),
root AS (SELECT h AS root FROM upper WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, f AS folded_root, f = root AS verified
FROM across JOIN leaves ON leaves.tree = across.tree AND leaves.idx = across.spot, root WHERE across.n = 1
"""


@query("op13_octopus_manifest", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    odd = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 != 0, F.lit(True))
    seen = F.when(odd, F.col("text")).otherwise(F.replace("text", F.lit("\n"), F.lit("")))
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    claimed = merkle.row_hash([*[F.col(c) for c in columns[:-1]], seen])
    proven = merkle.prove(merkle.build(docs, columns, claimed=claimed))
    return proven.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )
