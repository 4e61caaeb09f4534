"""The operators over the driver's tables, one query each, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontaminate, embeddings, infill, language, licenses, minhash, mixing, packing, sharding, suffix, token_counts, toxicity
from .staging import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, table(spark, sf_dir, "documents"), words=2)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(spark, table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(spark, docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.deduplicate(spark, docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(spark, table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(spark, docs, vocabulary("piece_bpe_32k.model")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contamination(spark, docs, table(spark, sf_dir, "benchmark")).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(spark, table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = infill.infill(table(spark, sf_dir, "documents"))
    digest = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(infill.restored(F.col("output"), F.col("form")), 256)}
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *[d.alias(c) for c, d in digest.items()])


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, table(spark, sf_dir, "documents")).taken().select("doc_id", "size", "source_size", "target", "taken")


def _damaged(turns: DataFrame) -> DataFrame:
    """Rows dropped, emptied, left without end marks, repeated or given the user's role by the CRC of conversation and turn."""
    space = F.lit(" ")
    k = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return turns.select(
        "conv_id",
        F.when(k != 0, F.col("turn")).alias("turn"),
        F.when(k == 0, "").when(k == 4, "user").otherwise(role).alias("role"),
        F.when(k.isin(0, 1), "").when(k == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(k == 0, 0).when(k == 3, 2).otherwise(1).alias("copies"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = conversations.repair(spark, _damaged(turns), copies="copies").conversations
    return done.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_minhash_near_dedup,
        op3_best_fit_packing,
        op4_toxicity,
        op5_suffix_dedup,
        op6_language_id,
        op7_license_scan,
        op8_token_counts,
        op9_decontamination,
        op10_sharding,
        op11_fill_in_middle,
        op12_mixing,
        op13_conversation_repair,
    )
}
_COMPONENTS = """reach(id, root) AS (SELECT id, id FROM nodes UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id),
comp AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)"""
_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""WITH RECURSIVE usable AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
nodes AS (SELECT vec_id AS id FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.98),
{_COMPONENTS}, n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept FROM comp LEFT JOIN n ON a = id"""

# pairs share one of the rarest shingles of either's prefix, or they cannot reach four fifths
OP2 = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [array_to_string(w, chr(1))] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || chr(1) || w[i + 1])) END AS s FROM w),
sizes AS (SELECT doc_id, len(s) AS n FROM sets), nodes AS (SELECT doc_id AS id FROM documents),
x AS (SELECT doc_id, unnest(s) AS s FROM sets), f AS (SELECT s, count(*) AS f FROM x GROUP BY s),
ranked AS (SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS rn FROM x JOIN f USING (s) JOIN sizes USING (doc_id)),
pre AS (SELECT doc_id, s, n FROM ranked WHERE rn <= n - (80 * n + 99) // 100 + 1),
cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM pre a JOIN pre b ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
hit AS (SELECT c.a, c.b, any_value(na + nb) AS total, count(*) AS k FROM cand c JOIN x p ON p.doc_id = c.a JOIN x q ON q.doc_id = c.b AND q.s = p.s GROUP BY c.a, c.b),
half AS (SELECT a, b FROM hit WHERE 100 * k >= 80 * (total - k)), links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
{_COMPONENTS}
SELECT id AS doc_id, n AS n_shingles, component_id, id = component_id AS kept FROM comp JOIN sizes ON doc_id = id"""

OP9 = f"""WITH d AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
grams AS (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, lens WHERE len(w) >= n)),
occ AS (SELECT doc_id, k, grams.n, item_id FROM grams JOIN win ON grams.g = win.g AND grams.n = win.n),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM occ) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP11 = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h, regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS w FROM documents),
r AS (SELECT *, len(w)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM r),
c AS (SELECT *, array_to_string(w[1:lo], '') AS p, array_to_string(w[lo + 1:hi], '') AS m, array_to_string(w[hi + 1:], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM c"""

OP12 = """WITH RECURSIVE d AS (SELECT doc_id, coalesce('s' || source, 't') AS q, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
  sha256('42:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')))[1:16] AS draw FROM documents),
s AS (SELECT q, sum(size)::BIGINT AS source_size, ([1, 2, 3])[(row_number() OVER (ORDER BY encode(q)) - 1) % 3 + 1]::BIGINT AS weight FROM d GROUP BY q),
total AS (SELECT sum(source_size)::BIGINT AS budget, sum(weight)::BIGINT AS weights FROM s),
levels AS (SELECT 0 AS k, budget / weights AS level, 0::BIGINT AS limited FROM total
  UNION ALL SELECT k + 1, (budget - limits) / free, n FROM (SELECT any_value(k) AS k, any_value(l.limited) AS limited, any_value(budget) AS budget, sum(CASE WHEN weight * level > 3 * source_size THEN 3 * source_size ELSE 0 END)::BIGINT AS limits,
    sum(CASE WHEN weight * level > 3 * source_size THEN 0 ELSE weight END)::BIGINT AS free, count(*) FILTER (weight * level > 3 * source_size) AS n FROM levels l, s, total) WHERE n > limited),
t AS (SELECT q, source_size, weight, least(3.0::DOUBLE * source_size, weight * (SELECT arg_max(level, k) FROM levels)) AS target FROM s),
p AS (SELECT d.*, source_size, weight, target, least(3 * source_size, floor(target)::BIGINT) AS cut, sum(size) OVER (PARTITION BY q ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS pre,
  row_number() OVER (PARTITION BY q ORDER BY draw, doc_id, size) AS place FROM d JOIN t USING (q)),
e AS (SELECT q, place, draw, doc_id, turn, weight, turn * source_size + pre AS lo, least(turn * source_size + pre + size, cut) AS hi FROM p, range(3) r(turn) WHERE size > 0 AND turn * source_size + pre < cut),
o AS (SELECT q, place, hi - lo AS words, sum(hi - lo) OVER (ORDER BY hi / weight, draw, doc_id, turn ROWS UNBOUNDED PRECEDING) - (hi - lo) AS pre FROM e),
k AS (SELECT q, place, sum(greatest(least(words, budget - pre), 0))::BIGINT AS taken FROM o, total GROUP BY q, place)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM p LEFT JOIN k USING (q, place)"""



def _op13() -> str:
    def go(frm: str, cost: str, letter: str, line: str = "''") -> str:
        return f"CASE WHEN {frm} IS NOT NULL THEN {{'c': {frm}.c + {cost}, 'a': {frm}.a || '{letter}', 'r': {frm}.r || {line}}} END"

    def least(*options: str) -> str:
        return f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))"

    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    inserted = [
        "s0",
        "s1",
        least("s2", *(go(f"s{i}", "2", "I", user) for i in (0, 1, 3))),
        least("s3", go("s2", "2", "I", assistant), *(go(f"s{i}", "4", "II", f"{user} || {assistant}") for i in (0, 1))),
    ]
    own = "chr(10) || role || ':' || text"

    def stays(frm: str, initial: str, new: str | None) -> list[str]:
        keep = f"CASE WHEN fault < 2 AND role[1] = '{initial}' THEN {go(frm, 'fault', 'K', own)} END"
        return [keep, *([f"CASE WHEN fault < 2 THEN {go(frm, '2 + fault', 'R', f'{new} || text')} END"] if new else [])]

    gone = [go(f"c{i}", "3", "D") for i in range(4)]
    after = [
        gone[0],
        least(gone[1], *stays("c0", "s", None)),
        least(gone[2], *(x for i in (0, 1, 3) for x in stays(f"c{i}", "u", user))),
        least(gone[3], *stays("c2", "a", assistant)),
    ]
    closed = ", ".join(f"{e} AS c{i}" for i, e in enumerate(inserted))
    steps = ", ".join(f"{e} AS s{i}" for i, e in enumerate(after))
    return f"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
crc AS (SELECT conv_id, turn, role, text, xor(4294967295::BIGINT, list_reduce(list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT),
  lambda c, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[], lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(c, b)), 4294967295::BIGINT)) % 20 AS k FROM k),
d AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE k WHEN 3 THEN 2 ELSE 1 END)) FROM crc WHERE k <> 0),
o AS (SELECT *, row_number() OVER w AS p, lag(role[1]) OVER w AS was FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 3 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 2 WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 1 ELSE 0 END AS fault FROM o),
convs AS (SELECT DISTINCT conv_id FROM conversations),
scan AS (SELECT conv_id, 0::BIGINT AS p, {{'c': 0::BIGINT, 'a': '', 'r': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR) AS s1, NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR) AS s3 FROM convs
  UNION ALL SELECT conv_id, p, {steps} FROM (SELECT f.conv_id, f.p, role, text, fault, {closed} FROM scan JOIN f ON f.conv_id IS NOT DISTINCT FROM scan.conv_id AND f.p = scan.p + 1)),
ends AS (SELECT conv_id, {least('c0', 'c3')} AS e FROM (SELECT conv_id, {closed} FROM scan QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY p DESC) = 1)),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 3) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
  count(*) FILTER (p > 1 AND was || role[1] NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT ends.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.c AS cost, e.a AS audit, sha256(e.r[2:]) AS repaired_sha256
FROM ends LEFT JOIN counts ON ends.conv_id IS NOT DISTINCT FROM counts.conv_id"""


OP13 = _op13()

#: The others learn, tokenise, fingerprint bytes or match with errors, which SQL cannot express.
ORACLES: dict[str, str] = {
    "op1_embedding_near_dedup": OP1,
    "op2_minhash_near_dedup": OP2,
    "op9_decontamination": OP9,
    "op11_fill_in_middle": OP11,
    "op12_mixing": OP12,
    "op13_conversation_repair": OP13,
}
