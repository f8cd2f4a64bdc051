"""The registered queries opN_<name>, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from . import align, chat, chunks, decontaminate, exact, language, licenses, lines, packing, runs, shards, simhash, topk
from .common import WHITESPACE, prepare, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: run(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_tokenizer() -> str:
    return tokenizer_file("word_bpe_49k.json")


SHARD_KEY = 20240607


@query("op1_token_shards")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    count = shards.write_shards(table(spark, sf_dir, "documents"), path, word_tokenizer(), SHARD_KEY)
    return shards.read_shards(spark, path, count, SHARD_KEY)


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    ranked = F.transform("matches", lambda m: F.struct(m["score"], (-m["first_line"]).alias("up"), m["license"]))
    return found.select("doc.doc_id", "matches", F.array_max(ranked).alias("best")).select(
        "doc_id", F.size("matches").alias("n_matches"), F.col("best.license").alias("license"), F.col("best.score").alias("score"), "matches"
    )


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs), keep=["doc_id"])
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, len(w[s : s + 9]) AS size, array_to_string(w[s : s + 9], ' ') AS win
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (SELECT doc_id, s, size, array_to_string(w[s : s + size - 1], ' ') AS win
          FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, s, size, item_id FROM grams JOIN windows USING (size, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM (SELECT DISTINCT doc_id, s, size FROM hits)) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN names USING (doc_id)
"""


@query("op4_decontaminate", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["hi"] - s["lo"])
    return found.select("doc.doc_id", "n_words", hit.alias("n_hit"), "items").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op6_chat_format")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], given.schema)
    done = chat.read_back(chat.format_chats(chat.events_of(given.union(own))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op7_substring_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = chunks.with_repeats(table(spark, sf_dir, "documents"))
    cut = F.aggregate("spans", F.lit(0), lambda a, s: a + s["hi"] - s["lo"])
    return done.select("doc.doc_id", F.col("rest").alias("text"), "spans", cut.alias("bytes_cut"), (cut > 0).alias("repeats"))


@query("op8_pack")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


@query("op9_exact_dedup", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"), carry={"text_sha256": F.sha2("norm", 256)})


# One edit apart, by lines with the same words (or, of short lines, characters) but one:
# equal without the same place (replaced), or the longer one without a place equal to
# the shorter one.
OP10_SQL = r"""
WITH l AS (SELECT doc_id, line, list_filter(regexp_split_to_array(lower(content), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
           FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS content,
                        generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents)),
u AS (SELECT array_to_string(w, ' ') AS t, any_value(w) AS w, min((doc_id, line)) AS spot FROM l WHERE len(w) > 0 GROUP BY 1),
v AS (SELECT t, spot, len(w) AS n, i, array_to_string(list_concat(w[1 : i - 1], w[i + 1 : len(w)]), ' ') AS rest
      FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM u WHERE len(w) >= 8)),
c AS (SELECT t, spot FROM u WHERE len(w) < 8 AND length(t) >= 16),
x AS (SELECT t, spot, length(t) AS n, i, substr(t, 1, i - 1) || substr(t, i + 1) AS rest
      FROM (SELECT *, unnest(range(1, length(t) + 1)) AS i FROM c)),
near AS (SELECT a.t FROM v a JOIN v b ON a.n = b.n AND a.i = b.i AND a.rest = b.rest AND b.spot < a.spot
         UNION SELECT a.t FROM v a JOIN u b ON a.rest = b.t AND len(b.w) >= 7 AND b.spot < a.spot
         UNION SELECT a.t FROM u a JOIN v b ON b.rest = a.t AND len(a.w) >= 7 AND b.spot < a.spot
         UNION SELECT a.t FROM x a JOIN x b ON a.n = b.n AND a.i = b.i AND a.rest = b.rest AND b.spot < a.spot
         UNION SELECT a.t FROM x a JOIN c b ON a.rest = b.t AND b.spot < a.spot
         UNION SELECT a.t FROM c a JOIN x b ON b.rest = a.t AND b.spot < a.spot),
gone AS (SELECT l.doc_id, l.line FROM l JOIN u ON array_to_string(l.w, ' ') = u.t
         WHERE len(l.w) > 0 AND ((l.doc_id, l.line) <> u.spot OR u.t IN (SELECT t FROM near))),
pieces AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS content,
                  generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents),
rest AS (SELECT p.doc_id, string_agg(p.content, chr(10) ORDER BY p.line) AS text
         FROM pieces p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.line = g.line WHERE g.line IS NULL GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.text, '') END AS text,
       coalesce(len(string_split(d.text, chr(10))), 0)::INTEGER AS n_lines,
       (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id)::INTEGER AS n_dropped
FROM documents d LEFT JOIN rest r ON r.doc_id = d.doc_id
"""


@query("op10_line_dedup", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.with_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc.doc_id", F.col("rest").alias("text"), "n_lines", "n_dropped")


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = align.align(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    return done.select(
        "doc.doc_id",
        "n_a",
        "n_b",
        F.col("n_links").alias("n_groups"),  # a group ends with its one link
        "n_links",
        "n_best",
        "count_sum",
        F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"),
    )


def with_planted_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``; a text whose key's CRC-32 is a multiple of ten repeats a stretch of its words to its end."""
    words = F.filter(F.split(text, WHITESPACE), lambda w: w != "")
    h = F.crc32(F.col(key).cast("string"))
    g = F.floor(h / 10)
    planted = docs.select("*", F.when((h % 10 == 0), words).alias("plant_words"), g.alias("plant_g"))
    n = F.size("plant_words").cast("long")
    a = F.when(n > 0, F.col("plant_g") % n)
    p = 1 + F.floor((n - a) / (3 + F.col("plant_g") % 8))
    changed = F.transform(
        "plant_words",
        lambda w, i: F.when(i < F.col("plant_a"), w).otherwise(
            F.get("plant_words", (F.col("plant_a") + F.pmod(i - F.col("plant_a"), F.col("plant_p"))).cast("int"))
        ),
    )
    done = planted.select("*", a.alias("plant_a"), p.alias("plant_p"))
    new = F.when(F.col("plant_a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col(text))
    return done.withColumn(text, new).select(*docs.columns)


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    done = runs.periodic_runs(docs)
    # Runs come by start, then period, so a later one has to be greater.
    better = lambda a, r: a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"])
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda a, r: F.when(better(a, r), r).otherwise(a))
    lines_of = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return done.select("doc.doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines_of, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP13_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


@query("op13_top_k", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
