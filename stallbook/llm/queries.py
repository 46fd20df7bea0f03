"""One query per operator, over its whole table; those that SQL can express have their SQL beside them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm import (
    chat, conversation_repair, decontaminate, exact_dedup, fingerprints, hard_negatives, html_text,
    lm_scoring, near_dedup, piece_codes, quality, token_files, toxicity,
)
from stallbook.llm.common import prepare, table, training_fold

LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_BPE = "word_bpe_49k.json"
WORD_BPE_SIZE = 49_408
PIECES = "piece_bpe_32k.model"


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(prepare(spark), folder)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return build

    return register


def scored(documents: DataFrame, threshold: float) -> DataFrame:
    return documents.select(
        "doc_id",
        F.coalesce(~training_fold("doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


@query("op1_lm_scoring")
def op1_lm_scoring(spark, folder):
    """Target: the documents labelled good and not toxic."""
    good = table(spark, folder, "labels").where("quality = 1 AND toxic = 0")
    return lm_scoring.scores(table(spark, folder, "documents"), good)


@query("op2_near_dedup", rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER_SQL}, '[^\x20\x09-\x0D]+') AS words FROM documents),
    sh AS (SELECT DISTINCT doc_id, md5(array_to_string(words[i : i + 4], ' ')) AS h
           FROM w, unnest(range(1, greatest(len(words) - 3, 2))) t(i) WHERE len(words) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b USING (h) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    edges AS (SELECT a, b FROM common JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
    reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
    least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM documents JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)""")
def op2_near_dedup(spark, folder):
    return near_dedup.near_duplicates(table(spark, folder, "documents"), percent=85)


@query("op3_toxicity")
def op3_toxicity(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(documents, table(spark, folder, "labels"))
    return scored(toxicity.score(documents, model), 0.5)


@query("op4_chat", """
    WITH t AS (SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
               FROM conversations WHERE conv_id IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos,
                 count(*) OVER (PARTITION BY conv_id) AS n FROM t),
    p AS (SELECT *, string_agg(sha256(role || chr(1) || text), '') OVER (PARTITION BY conv_id ORDER BY pos) AS h FROM r),
    f AS (SELECT min(conv_id) AS conv_id, h, n FROM p WHERE pos = n GROUP BY h, n),
    k AS (SELECT f.conv_id, f.n FROM f ANTI JOIN (SELECT h FROM p WHERE pos < n) q ON f.h = q.h)
    SELECT conv_id, CAST(floor(turn / 512) AS BIGINT) AS chunk, k.n AS n_turns, count(*) AS chunk_turns,
           string_agg('<|im_start|>' || role || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
    FROM r JOIN k USING (conv_id) GROUP BY ALL""")
def op4_chat(spark, folder):
    return chat.chat_texts(table(spark, folder, "conversations"))


@query("op5_quality")
def op5_quality(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(documents, table(spark, folder, "labels"))
    return scored(quality.score(documents, model), 0.3)


@query("op6_pieces")
def op6_pieces(spark, folder):
    import public_tokenizers

    return piece_codes.round_trip(table(spark, folder, "documents"), public_tokenizers.path(PIECES))


@query("op7_token_files")
def op7_token_files(spark, folder):
    import public_tokenizers

    documents = table(spark, folder, "documents")
    manifest, root = token_files.write_tokens(
        documents, public_tokenizers.path(WORD_BPE), end_id=1, vocabulary_size=WORD_BPE_SIZE
    )
    return token_files.read_tokens(manifest, root)


@query("op9_decontamination", rf"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    windows AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[k : k + 12], ' ') AS g
                FROM i, unnest(range(1, greatest(len(w) - 11, 2))) t(k) WHERE len(w) > 0),
    hits AS (SELECT DISTINCT r, s, l.n, item FROM d, (SELECT DISTINCT n FROM windows) l, unnest(range(1, len(d.w) - l.n + 2)) t(s), windows v
             WHERE v.n = l.n AND v.g = array_to_string(d.w[s : s + l.n - 1], ' ')),
    covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(s, s + n)) t(p) GROUP BY r),
    items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)""")
def op9_decontamination(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_fingerprints")
def op8_fingerprints(spark, folder):
    return fingerprints.fingerprints(table(spark, folder, "documents"))


@query("op10_html_text")
def op10_html_text(spark, folder):
    pages = table(spark, folder, "pages")
    return html_text.extract(pages, html_text.train(pages))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults: by a hash of id and turn, rows are dropped, emptied, cut, repeated or given to the user."""
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"]).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = conversations.select("conv_id", "turn", spaced["role"].alias("role"), spaced["text"].alias("text"), kind.alias("kind"))
    rows = rows.where("kind <> 0").withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


@query("op13_conversation_repair")
def op13_conversation_repair(spark, folder):
    conversations = table(spark, folder, "conversations")
    report = conversation_repair.repair_report(damaged(conversations)).withColumnRenamed("conv_id", "id")
    everyone = conversations.select("conv_id").distinct()
    rows = everyone.join(report, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op12_exact_dedup", """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
    SELECT doc_id, keep_id, group_size, row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(text) AS text_sha256
    FROM d JOIN g USING (text)""")
def op12_exact_dedup(spark, folder):
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


@query("op11_hard_negatives", """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
               FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    r AS (SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                 vec_id AS negative_id, positive_score, score AS negative_score
          FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
    SELECT * FROM r WHERE rank <= 10""")
def op11_hard_negatives(spark, folder):
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", label), F.col("id") % 100 == 0)
