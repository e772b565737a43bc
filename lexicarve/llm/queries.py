"""Registered queries of the operators in this subpackage, and their DuckDB text where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann_postings, chat_template, fm_decontam, langid_viterbi, line_minhash, pareto_mix, pii_skipcrf, ring_sharding, secret_battery, simhash_mih, source_audit, toxicity_cnn, whitening
from .common import id_mod, read_table


def counted(kinds: list[str]) -> list[Column]:
    """How many base spans of each kind: n_<kind>."""
    def of(i: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == i)).cast("long")
    return [of(i).alias(f"n_{k}") for i, k in enumerate(kinds)]


def op1_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity_cnn.train(docs, toxicity_cnn.learnable(read_table(spark, sf_dir, "labels")))
    out = toxicity_cnn.score(docs, model)
    return out.select("doc_id", (id_mod("doc_id", 5) == 0).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op2_ann_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_postings.search(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op3_line_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_minhash.dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_kept", F.array_join("kept", ",").alias("kept_lines"))


def op4_langid_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid_viterbi.train(langid_viterbi.learnable(docs))
    out = langid_viterbi.label_languages(docs, model)
    return out.select("doc_id", (id_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "n_spans")


def op5_simhash_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_mih.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_battery.secrets(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *counted(secret_battery.KINDS[:3]), F.sha2(secret_battery.spelled(F.col("base")), 256).alias("base_sha256"),
                        secret_battery.spelled(F.col("spans")).alias("spans"))


def op7_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_sharding.assign(read_table(spark, sf_dir, "documents"))


def op8_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix.mix(read_table(spark, sf_dir, "documents"))


def op9_fm_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fm_decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      fm_decontam.is_contaminated().alias("contaminated"))


def op10_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ok = "SELECT -1L AS conv_id, {}L AS turn, '{}' AS role, '</s>[INST] ok [/INST]' AS text"
    rows = rows.unionByName(spark.sql(ok.format(0, "user"))).unionByName(spark.sql(ok.format(1, "assistant")))
    return chat_template.read_back(chat_template.format_conversations(rows))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(read_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"))


def op13_pii_skipcrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_skipcrf.personal_data(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *counted(pii_skipcrf.KINDS), F.sha2(pii_skipcrf.spelled(F.col("base")), 256).alias("base_sha256"),
                        pii_skipcrf.spelled(F.col("spans")).alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity_cnn": op1_toxicity_cnn,
    "op2_ann_postings": op2_ann_postings,
    "op3_line_minhash": op3_line_minhash,
    "op4_langid_viterbi": op4_langid_viterbi,
    "op5_simhash_mih": op5_simhash_mih,
    "op6_secret_battery": op6_secret_battery,
    "op7_ring_sharding": op7_ring_sharding,
    "op8_pareto_mix": op8_pareto_mix,
    "op9_fm_decontam": op9_fm_decontam,
    "op10_chat_template": op10_chat_template,
    "op11_source_audit": op11_source_audit,
    "op12_whitening": op12_whitening,
    "op13_pii_skipcrf": op13_pii_skipcrf,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# a backslash and each control string get one more character when escaped, a line break in a role too
_CONTROL = r"'\\\\|<\||<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'"

ORACLE: dict[str, str] = {
    "op11_source_audit": r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (SELECT rid, lang, source, term, count(*) AS n FROM (SELECT rid, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term FROM c GROUP BY lang, term HAVING count(*) >= 10),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
gc AS (SELECT lang, source, term, sum(n)::HUGEINT AS n FROM c JOIN k USING (lang, term) GROUP BY ALL),
gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN gc ON gc.lang = g.lang AND gc.source = g.source GROUP BY ALL),
p AS (SELECT gn.lang, gn.source, k.term, coalesce(n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v) AS p
      FROM gn JOIN k ON k.lang = gn.lang JOIN v ON v.lang = gn.lang
      LEFT JOIN gc ON gc.lang = gn.lang AND gc.source = gn.source AND gc.term = k.term),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // (max(total) + 2 * max(v)) AS q
      FROM (SELECT k.lang, k.term, coalesce(n, 0) AS n FROM k LEFT JOIN gc ON gc.lang = k.lang AND gc.term = k.term)
      JOIN (SELECT lang, sum(total) AS total FROM gn GROUP BY lang) USING (lang) JOIN v USING (lang) GROUP BY lang, term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
term AS (SELECT p.lang, source, 'term' AS part, p.term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
         FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM every UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank::INT AS rank FROM r WHERE part = 'pair' OR rank <= 10""",
    "op10_chat_template": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(16 + length(role) + length(text) + len(regexp_extract_all(role, {_CONTROL})) + len(regexp_extract_all(text, {_CONTROL}))
           + length(role) - length(replace(role, chr(10), '')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id""",
    "op8_pareto_mix": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, md5(coalesce(text, '')) AS text_md5,
                  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
b AS (SELECT *, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src, length(bin(size + 1)) - 1 AS cls,
             CASE WHEN count(*) OVER (PARTITION BY doc_id) > 1 THEN '#' || text_md5 || '#'
                  || (row_number() OVER (PARTITION BY doc_id, text_md5, source ORDER BY rid) - 1) ELSE '' END AS more FROM d),
c AS (SELECT *, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || more || '-17'), 1, 13))::BIGINT + 0.5) / 4503599627370496::DOUBLE AS u FROM b),
s AS (SELECT src, sum(size)::DOUBLE AS source_size FROM c GROUP BY src),
w AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY src) - 1) % 3 + 1]::DOUBLE AS w, 2 * source_size AS most,
             sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, (1.5 * total - coalesce(sum(most) OVER (ORDER BY most / w, w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY most / w, w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM w),
t AS (SELECT src, source_size, CASE WHEN most <= w * lv THEN most
             ELSE w * max(CASE WHEN most > w * lv THEN lv END) OVER () END AS target FROM l),
k AS (SELECT c.src, cls, target, sum(size)::DOUBLE AS words FROM c JOIN t USING (src) WHERE size > 0 GROUP BY c.src, cls, target),
kw AS (SELECT *, words / (16.0 + cls) AS w, 2 * words AS most FROM k),
kl AS (SELECT *, (target - coalesce(sum(most) OVER (PARTITION BY src ORDER BY most / w, w
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (PARTITION BY src ORDER BY most / w, w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM kw),
e AS (SELECT src, cls, words, least(CASE WHEN most <= w * lv THEN most
             ELSE w * max(CASE WHEN most > w * lv THEN lv END) OVER (PARTITION BY src) END / words, 2.0) AS copies FROM kl),
rest AS (SELECT src, sum((copies - floor(copies)) * words) AS rest FROM e GROUP BY src),
p AS (SELECT c.*, copies, copies - floor(copies) AS p FROM c JOIN e USING (src, cls) WHERE size > 0),
r AS (SELECT rid, sum(size) OVER (PARTITION BY src ORDER BY (u / (1 - u)) / (p / (1 - p)), doc_id
             ROWS UNBOUNDED PRECEDING) - size / 2.0 <= rest AS more_copies FROM p JOIN rest USING (src) WHERE p > 0),
n AS (SELECT p.rid, floor(copies)::INT + CASE WHEN coalesce(more_copies, false) THEN 1 ELSE 0 END AS n FROM p LEFT JOIN r USING (rid))
SELECT c.doc_id, c.size, source_size::BIGINT AS source_size, target::DOUBLE AS target,
       (c.size * coalesce(n, 1))::BIGINT AS taken, coalesce(n, 1)::INT AS n_copies
FROM c JOIN t USING (src) LEFT JOIN n USING (rid)""",
    "op9_fm_decontam": f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS p
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS p
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
             FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, s, iw.n AS n FROM dw JOIN iw USING (n, p)),
hw AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
       FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM hit) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)""",
}
